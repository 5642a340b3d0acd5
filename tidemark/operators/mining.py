"""Frequent playbook sets, connected artifacts, and the campaigns that they show."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import text as T
from .rollups import least_members

#: Sets, and transactions, that a task compares at once; pairs of items that it counts at once.
PART, PAIRS = 4096, 1 << 21


def bags(sessions: DataFrame) -> DataFrame:
    """Per address its set of playbooks, the number of its sessions with one, their first and last time."""
    known = sessions.where(F.col("source_ip").isNotNull() & F.col("playbook_id").isNotNull())
    return known.groupBy("source_ip").agg(
        F.array_sort(F.collect_set("playbook_id")).alias("items"), F.count("*").alias("session_count"), F.min("start_ts").alias("first_seen"), F.max("start_ts").alias("last_seen")
    )


def _weighed(transactions: DataFrame, items: str = "items") -> DataFrame:
    """(items, n): the distinct sets of items of the transactions, and how many hold just these."""
    own = transactions.select(F.array_sort(F.array_distinct(F.array_compact(items))).alias("items"))
    return own.where(F.size("items") > 0).groupBy("items").agg(F.count("*").alias("n"))


def _pairs(known: list | None):
    """(items, n) of the pairs of items in each batch of weighed transactions; known: only these items count."""

    def pairs(batches):
        for batch in batches:
            held, n = batch["items"], batch["n"].to_numpy()
            flat = pc.list_flatten(held)
            items = pc.unique(flat)
            own, row = pc.index_in(flat, items).to_numpy(), pc.list_parent_indices(held).to_numpy()
            if known is not None:
                kept = pc.is_in(items, pa.array(known, items.type)).to_numpy(zero_copy_only=False)[own]
                own, row = own[kept], row[kept]
            ends = np.searchsorted(row, row, "right")
            later = ends - np.arange(len(row)) - 1  # an item's pairs with those after it
            cuts = np.searchsorted(np.cumsum(later), np.arange(0, later.sum() + 1, PAIRS), "right") if len(later) else []
            for a, b in zip(cuts, [*cuts[1:], len(later)]):
                first = np.repeat(np.arange(a, b), later[a:b])
                second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(later[a:b]) - later[a:b], later[a:b])
                pair, place = np.unique(own[first].astype("i8") * len(items) + own[second], return_inverse=True)
                total = np.zeros(len(pair), "i8")
                np.add.at(total, place, n[row[first]])
                both = items.take(pa.array(np.stack(np.divmod(pair, len(items)), 1).ravel()))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(pair) + 1, 2, dtype="i4")), both), pa.array(total)], names=["items", "n"])

    return pairs


def _grown(level: DataFrame, size: int) -> DataFrame:
    """Sets of `size` items all of whose parts of one item less are in the level."""
    start, last = F.slice("items", 1, size - 2), F.col("items")[size - 2]
    a, b = level.select(start.alias("start"), last.alias("x")), level.select(start.alias("start"), last.alias("y"))
    sets = a.join(b, "start").where("x < y").select(F.concat("start", F.array("x", "y")).alias("items"))
    for k in range(size - 2):
        part = F.concat(F.slice("items", 1, k), F.slice("items", k + 2, size))
        sets = sets.withColumn("part", part).join(level.select(F.col("items").alias("part")), "part", "left_semi").drop("part")
    return sets


def itemsets(transactions: DataFrame, support: int = DEFAULT.itemset_support, least: int = DEFAULT.itemset_least, most: int = DEFAULT.itemset_most, items: str = "items") -> DataFrame:
    """(items, support) of all sets of that many items that stand in at least `support` transactions.

    Level by level: pairs come from the transactions, larger sets from those one item smaller, and
    the distinct transactions are compared with them by bits.
    """
    rows = _weighed(transactions, items).persist()
    enough = lambda found: found.groupBy("items").agg(F.sum("n").alias("support")).where(F.col("support") >= support).persist()
    levels = [enough(rows.select(F.explode("items").alias("x"), "n").select(F.array("x").alias("items"), "n"))]
    while len(levels) < most and (n := levels[-1].count()):
        if len(levels) == 1:
            known = [r[0] for r in levels[0].select(F.col("items")[0]).collect()] if n <= PAIRS // 100 else None
            levels.append(enough(rows.mapInArrow(_pairs(known), rows.schema)))
        else:
            wanted = _grown(levels[-1], len(levels) + 1).persist()
            levels.append(enough(_compared(wanted, rows, "items", _counted, "n long")))
            levels[-1].count()
            wanted.unpersist()
    levels[-1].count()
    rows.unpersist()
    return reduce(DataFrame.unionByName, levels[least - 1 :] or [levels[0].limit(0)])


def closed(sets: DataFrame) -> DataFrame:
    """Without sets of which a larger one has the same support."""
    smaller, larger = sets.alias("s"), sets.select(F.col("items").alias("more"), F.col("support").alias("l_support"), F.explode("items").alias("first")).alias("l")
    inside = (F.col("l.l_support") == F.col("s.support")) & (F.col("l.first") == F.col("s.items")[0]) & (F.size("l.more") > F.size("s.items")) & (F.size(F.array_except("s.items", "l.more")) == 0)
    return smaller.join(larger, inside, "left_anti")


def _held(sets: pa.Table, rows: pa.Table) -> np.ndarray:
    """A row of bits for each set: which of the transactions hold it."""
    wanted, held = sets["items"].combine_chunks(), rows["items"].combine_chunks()
    named = pc.list_flatten(wanted)
    items = pc.unique(named)
    code = lambda x: pc.fill_null(pc.index_in(x, items, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
    bits = np.zeros((len(items) + 1, -(-len(rows) // 8)), "u1")  # the last row, of no item, stays empty
    own, row = code(pc.list_flatten(held)), pc.list_parent_indices(held).to_numpy()
    own, row = own[own >= 0], row[own >= 0]
    np.bitwise_or.at(bits, (own, row >> 3), (1 << (row & 7)).astype("u1"))
    starts = np.cumsum(np.append(0, pc.list_value_length(wanted).to_numpy()))[:-1]
    return np.bitwise_and.reduceat(bits[code(named)], starts, axis=0)


def _nullable(sets: pa.Table) -> pa.ChunkedArray:
    return sets["items"].cast(pa.list_(sets.schema.field("items").type.value_type))


def _counted(sets: pa.Table, rows: pa.Table) -> pa.Table:
    total = np.zeros(len(sets), "i8")
    if len(sets) and len(rows):
        held, n = _held(sets, rows), rows["n"].to_numpy()
        for a in range(0, len(sets), 256):
            total[a : a + 256] = np.unpackbits(held[a : a + 256], axis=1, count=len(rows), bitorder="little") @ n.astype("f8")
    return pa.table({"items": _nullable(sets), "n": total}).filter(pa.array(total > 0))


def _listed(sets: pa.Table, rows: pa.Table) -> pa.Table:
    places = [np.flatnonzero(np.unpackbits(x, bitorder="little")).astype("i4") for x in _held(sets, rows)] if len(sets) and len(rows) else [np.zeros(0, "i4")] * len(sets)
    ends = np.cumsum([0, *map(len, places)]).astype("i4")
    keys = rows["key"].combine_chunks().take(pa.array(np.concatenate([np.zeros(0, "i4"), *places])))
    return pa.table({"items": _nullable(sets), "keys": pa.ListArray.from_arrays(pa.array(ends), keys)})


def _compared(sets: DataFrame, transactions: DataFrame, key: str, compare, column: str) -> DataFrame:
    """(items, column) of each part of the sets with each part of the transactions, which meet in one task: no row is made for an item.

    key tells transactions apart and deals them out.
    """
    n_sets, n_rows = (-(-df.count() // PART) or 1 for df in (sets, transactions))
    part = lambda col, n: F.pmod(F.xxhash64(col), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    wanted = sets.where(F.size("items") > 0).select("items", part("items", n_sets).alias("i"), every(n_rows).alias("j"))
    held = transactions.where(F.size("items") > 0).select("*", part(key, n_rows).alias("j"), every(n_sets).alias("i"))
    return wanted.groupBy("i", "j").cogroup(held.groupBy("i", "j")).applyInArrow(compare, f"items {dict(sets.dtypes)['items']}, {column}")


def holders(sets: DataFrame, transactions: DataFrame, key: str = "source_ip") -> DataFrame:
    """(items, key) of the transactions that hold a set; a key is that of one transaction."""
    found = _compared(sets, transactions.select(F.col(key).alias("key"), "items"), "key", _listed, f"keys array<{dict(transactions.dtypes)[key]}>")
    return found.select("items", F.explode("keys").alias(key))


def holder_counts(sets: DataFrame, transactions: DataFrame) -> DataFrame:
    """(items, holders) of the sets that any transaction holds: counted where they are found, so that holders are never listed."""
    rows = _weighed(transactions).persist()
    return _compared(sets, rows, "items", _counted, "n long").groupBy("items").agg(F.sum("n").alias("holders"))


def behaviour_campaigns(sessions: DataFrame, support: int = DEFAULT.itemset_support) -> DataFrame:
    """Closed playbook sets that enough addresses run, with the addresses and all their playbook sessions."""
    by_ip = bags(sessions)
    sets = closed(itemsets(by_ip, support))
    members = holders(sets, by_ip).join(by_ip.drop("items"), "source_ip")
    out = members.groupBy("items").agg(F.count("*").alias("ip_count"), F.sum("session_count").alias("session_count"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    out = out.join(least_members(members, "items", "source_ip", 50, "member_source_ips"), "items")
    return out.select(T.campaign_id(F.col("items")).alias("campaign_id"), F.lit("behaviour").alias("kind"), F.col("items").alias("member_playbook_ids"), F.col("ip_count").alias("support"), "ip_count", "session_count", "first_seen", "last_seen", "member_source_ips")


def components(edges: DataFrame, a: str = "a", b: str = "b", checkpoint: bool = True) -> DataFrame:
    """(node, component): component is the least node reachable.

    Labels take the least among the neighbours' and then that label's own label, until nothing
    changes, so long chains halve with each round. Lineage is cut by checkpoint() where the session
    names a folder for it.
    """
    spark = edges.sparkSession
    keep = (lambda df: df.checkpoint()) if checkpoint and spark.sparkContext.getCheckpointDir() else (lambda df: df.persist())
    both = keep(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(F.col(b), F.col(a))).distinct())
    labels = keep(both.groupBy("x").agg(F.least(F.min("y"), F.min("x")).alias("l")).withColumnRenamed("x", "node"))
    before = labels
    while True:
        near = both.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("l").alias("m"))
        hooked = labels.join(near, F.col("node") == F.col("x")).select("node", "l", F.least("l", "m").alias("new"))
        top = hooked.select(F.col("node").alias("t"), F.col("new").alias("t_new"))
        step = keep(hooked.join(top, F.col("new") == F.col("t")).select("node", F.col("t_new").alias("l"), (F.col("t_new") != F.col("l")).alias("moved")))
        moved = step.where("moved").count()  # all of it is there from now on
        before.unpersist()
        labels, before = step.select("node", "l"), step
        if not moved:
            both.unpersist()
            return labels.select("node", F.col("l").alias("component"))


def artifact_weights(session_artifacts: DataFrame) -> DataFrame:
    """(kind, value, df, idf) over the sessions that have any artifact."""
    n = session_artifacts.select("session_id").distinct().count()
    df = session_artifacts.groupBy("kind", "value").agg(F.countDistinct("session_id").alias("df"))
    return df.withColumn("idf", F.log(F.lit(n + 1.0)) - F.log(F.col("df") + 1.0) if n else F.lit(0.0))


def infrastructure_campaigns(session_artifacts: DataFrame, min_sessions: int = DEFAULT.infra_sessions, min_ips: int = DEFAULT.infra_ips, top: int = DEFAULT.fingerprint_artifacts) -> DataFrame:
    """Sessions that hang together by artifacts that at least two of them share.

    session_artifacts: (session_id, source_ip, kind, value) and, if known, start_ts and end_ts of the
    session. Sessions and artifacts are the nodes of a star graph, so no pairs of sessions are made. The lead
    of a campaign is the first URL among its ranked artifacts, or else the first one.
    """
    timed = "start_ts" in session_artifacts.columns
    rows = session_artifacts.select("session_id", "source_ip", "kind", "value").distinct()
    weights = artifact_weights(rows)
    shared = rows.join(weights.where("df >= 2"), ["kind", "value"])
    node = F.concat_ws("\x1f", F.lit("artifact"), "kind", "value")
    found = components(shared.select(F.concat(F.lit("s\x1f"), "session_id").alias("a"), node.alias("b")))
    members = found.where(F.col("node").startswith("s\x1f")).select(F.substring("node", 3, 1 << 20).alias("session_id"), "component")
    own = ["session_id", "source_ip", *(["start_ts", "end_ts"] if timed else [])]
    placed = session_artifacts.select(*own).distinct().join(members, "session_id")
    times = [F.min("start_ts").alias("first_seen"), F.max("end_ts").alias("last_seen")] if timed else [F.lit(None).cast("timestamp").alias(c) for c in ("first_seen", "last_seen")]
    groups = placed.groupBy("component").agg(F.countDistinct("session_id").alias("session_count"), F.countDistinct("source_ip").alias("ip_count"), *times)
    groups = groups.where((F.col("session_count") >= min_sessions) & (F.col("ip_count") >= min_ips))
    groups = groups.join(least_members(placed, "component", "source_ip", 50, "member_source_ips"), "component")
    best = ranked_artifacts(shared.join(members, "session_id"), "component", top)
    ranked = F.array_sort(F.collect_list(F.struct("rank", "kind", "value", "n")))
    prints = best.groupBy("component").agg(ranked.alias("ranked"))
    out = groups.join(prints, "component")
    named = lambda x: F.concat_ws("=", x["kind"], x["value"])
    fingerprint = F.transform("ranked", named)
    urls = F.filter("ranked", lambda x: x["kind"] == "url")
    lead = F.when(F.size(urls) > 0, F.get(urls, F.lit(0))["value"]).otherwise(F.get(F.col("ranked"), F.lit(0))["value"])
    return out.select(
        F.concat(F.lit("cmp-inf-"), T.hash16(F.array_join(fingerprint, "|"))).alias("campaign_id"), F.lit("infrastructure").alias("kind"), "session_count", "ip_count", "member_source_ips",
        fingerprint.alias("fingerprint"), lead.alias("lead"), F.concat(F.lit("Shared artifact: "), T.label(lead)).alias("name"),
        F.format_string("%d sessions of %d addresses hang together by %d shared artifacts", "session_count", "ip_count", F.size("ranked")).alias("rationale"), "first_seen", "last_seen",
    )


def ranked_artifacts(shared: DataFrame, key: str, top: int = DEFAULT.fingerprint_artifacts) -> DataFrame:
    """(key, kind, value, n, rank): each key's artifacts by sessions times inverse document frequency, the first ones."""
    tally = shared.groupBy(key, "kind", "value").agg(F.countDistinct("session_id").alias("n"), F.first("idf").alias("idf"))
    order = Window.partitionBy(key).orderBy(F.desc(F.round(F.col("n") * F.col("idf"), 9)), "kind", "value")
    return tally.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("idf")


def model_artifacts(iocs: DataFrame, commands: DataFrame) -> DataFrame:
    """(command_hash, kind, value): what a model names in a command, as far as the command bears it out.

    iocs: (command_hash, urls, hashes); commands: (command_hash, command_line, ts), of which the first seen
    is the sample. A URL must be one as a whole; a hash must have a digest's length and stand in a command that
    makes or checks digests.
    """
    sample = commands.groupBy("command_hash").agg(F.min_by("command_line", F.struct("ts", "command_line")).alias("sample"))
    known = iocs.join(sample, "command_hash", "left")
    pairs = T.validated_iocs(F.col("urls"), F.col("hashes"), F.coalesce("sample", F.lit("")))
    return known.select("command_hash", F.explode(pairs).alias("a")).select("command_hash", "a.kind", "a.value").distinct()


def all_artifacts(from_text: DataFrame, runs: DataFrame, from_model: DataFrame) -> DataFrame:
    """(session_id, source_ip, kind, value): artifacts of the texts and, by the commands that sessions ran, those of the model."""
    of_model = runs.select("session_id", "source_ip", "command_hash").distinct().join(from_model, "command_hash").select("session_id", "source_ip", "kind", "value")
    return from_text.select("session_id", "source_ip", "kind", "value").unionByName(of_model).distinct()


def campaigns(kind: str, sessions: DataFrame, artifacts: DataFrame) -> list[DataFrame]:
    """Campaigns of one kind (behaviour, infrastructure) or of all."""
    makers = {"behaviour": lambda: behaviour_campaigns(sessions), "infrastructure": lambda: infrastructure_campaigns(artifacts)}
    if kind not in (*makers, "all"):
        raise ValueError(f"unknown kind of campaign: {kind}")
    return [make() for name, make in makers.items() if kind in (name, "all")]
