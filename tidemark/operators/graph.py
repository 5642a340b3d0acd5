"""The graph of everything: typed nodes `kind:id`, typed edges, neighbours of any anchor, expansion hop by hop."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of nodes that can be an anchor.
ANCHORS = ("ip", "session", "command", "command_cluster", "session_cluster", "ip_cluster", "playbook", "campaign", "asn", "country", "technique", "tactic")
#: How many siblings a hop adds for each node, by depth (fixed values).
FAN_OUT = (50, 30, 20)
EDGE = ["source", "target", "kind", "n"]


@dataclass(frozen=True)
class Tables:
    """What the graph is made of; a table that is missing has no edges.

    sessions: (session_id, source_ip, cluster_id, playbook_id); runs: (session_id, command_hash, n); commands:
    (command_hash, cluster_id, techniques, tactics); addresses: (source_ip, asn, country, cluster_id);
    campaigns: (campaign_id, session_ids, playbook_ids).
    """

    sessions: DataFrame | None = None
    runs: DataFrame | None = None
    commands: DataFrame | None = None
    addresses: DataFrame | None = None
    campaigns: DataFrame | None = None


def node(kind: str, ident: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), ident.cast("string"))


def _edges(rows: DataFrame, source: Column, target: Column, kind: str, n: Column | None = None) -> DataFrame:
    there = rows.select(source.alias("source"), target.alias("target"), F.lit(kind).alias("kind"), (F.lit(1) if n is None else n).cast("long").alias("n"))
    return there.where(F.col("source").isNotNull() & F.col("target").isNotNull()).groupBy("source", "target", "kind").agg(F.sum("n").alias("n"))


def edges(t: Tables) -> DataFrame:
    """(source, target, kind, n) over all tables: one scan each, no pairs of rows."""
    c, parts = F.col, []
    if t.sessions is not None:
        parts += [
            _edges(t.sessions, node("ip", c("source_ip")), node("session", c("session_id")), "saw"),
            _edges(t.sessions, node("session", c("session_id")), node("session_cluster", c("cluster_id")), "in_cluster"),
            _edges(t.sessions, node("session_cluster", c("cluster_id")), node("playbook", c("playbook_id")), "playbook_of"),
        ]
    if t.runs is not None:
        parts.append(_edges(t.runs, node("session", c("session_id")), node("command", c("command_hash")), "ran", c("n")))
    if t.commands is not None:
        parts.append(_edges(t.commands, node("command", c("command_hash")), node("command_cluster", c("cluster_id")), "in_cluster"))
        for kind in ("technique", "tactic"):
            each = t.commands.select("command_hash", F.explode(f"{kind}s").alias("x"))
            parts.append(_edges(each, node("command", c("command_hash")), node(kind, F.upper("x")), "shows"))
    if t.addresses is not None:
        parts += [_edges(t.addresses, node("ip", c("source_ip")), node(kind, c(col)), name) for kind, col, name in (("asn", "asn", "of_network"), ("country", "country", "of_country"), ("ip_cluster", "cluster_id", "in_cluster"))]
    if t.campaigns is not None:
        for kind, col in (("session", "session_ids"), ("playbook", "playbook_ids")):
            each = t.campaigns.select("campaign_id", F.explode(col).alias("x"))
            parts.append(_edges(each, node("campaign", c("campaign_id")), node(kind, c("x")), "has"))
    if not parts:
        raise ValueError("a graph needs a table")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _checked(anchor: str) -> str:
    if anchor.split(":")[0] not in ANCHORS or ":" not in anchor:
        raise ValueError(f"not an anchor: {anchor}")
    return anchor


def neighbours(graph: DataFrame, anchor: str, limit: int = 50) -> DataFrame:
    """The edges of an anchor of any kind, in both directions, most events first."""
    _checked(anchor)
    return graph.where((F.col("source") == anchor) | (F.col("target") == anchor)).orderBy(F.desc("n"), "source", "target", "kind").limit(limit)


def neighbours_of(graph: DataFrame, anchors: list[str], limit: int = 50) -> DataFrame:
    """(anchor, source, target, kind, n): the strongest edges of each of several anchors, in one scan of the graph."""
    wanted = F.array(*[F.lit(_checked(a)) for a in anchors])
    met = graph.where(F.col("source").isin(*anchors) | F.col("target").isin(*anchors))
    each = met.withColumn("anchor", F.explode(F.array_intersect(F.array("source", "target"), wanted)))
    order = Window.partitionBy("anchor").orderBy(F.desc("n"), "source", "target", "kind")
    return each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit).select("anchor", *EDGE)


def expanded(graph: DataFrame, anchor: str, depth: int = 3, fan_out: tuple[int, ...] = FAN_OUT) -> DataFrame:
    """(node, hop, role): what lies around an anchor, at most fan_out[hop - 1] new nodes for each node of a hop.

    A node is an anchor, a mini anchor (its own neighbours are there as well), or a leaf of the last hop.
    Each hop is one join of the frontier with the edges; the strongest edges come first.
    """
    _checked(anchor)
    if not 0 <= depth <= len(fan_out):
        raise ValueError(f"depth is from 0 to {len(fan_out)}")
    both = graph.select(F.col("source").alias("x"), F.col("target").alias("y"), "n").unionByName(graph.select(F.col("target").alias("x"), F.col("source").alias("y"), "n"))
    both = both.groupBy("x", "y").agg(F.sum("n").alias("n"))
    seen = graph.sparkSession.createDataFrame([(anchor, 0)], "node string, hop int")
    front = seen
    for hop in range(1, depth + 1):
        order = Window.partitionBy("x").orderBy(F.desc("n"), "y")
        fresh = both.join(front.select(F.col("node").alias("x")), "x").join(seen.select(F.col("node").alias("y")), "y", "left_anti")
        best = fresh.withColumn("place", F.row_number().over(order)).where(F.col("place") <= fan_out[hop - 1])
        front = best.select(F.col("y").alias("node")).distinct().withColumn("hop", F.lit(hop))
        seen = seen.unionByName(front)
    role = F.when(F.col("hop") == 0, "anchor").when(F.col("hop") < depth, "mini_anchor").otherwise("leaf")
    return seen.withColumn("role", role)


def sessions_and_addresses(graph: DataFrame, campaign: str) -> DataFrame:
    """(session, ip) of a campaign's sessions with the addresses that they came from."""
    members = graph.where((F.col("source") == F.lit(f"campaign:{campaign}")) & F.col("target").startswith("session:")).select(F.col("target").alias("session"))
    saw = graph.where("kind = 'saw'").select(F.col("target").alias("session"), F.col("source").alias("ip"))
    return members.join(saw, "session")


def playbooks_of_addresses(graph: DataFrame) -> DataFrame:
    """(ip, n): how many playbooks each address's sessions lead to."""
    saw = graph.where("kind = 'saw'").select(F.col("source").alias("ip"), F.col("target").alias("session"))
    into = graph.where("kind = 'in_cluster'").select(F.col("source").alias("session"), F.col("target").alias("cluster"))
    book = graph.where("kind = 'playbook_of'").select(F.col("source").alias("cluster"), F.col("target").alias("playbook"))
    reached = saw.join(into, "session").join(book, "cluster").select("ip", "playbook").distinct()
    return reached.groupBy("ip").agg(F.count("*").alias("n"))


def united_nodes(nodes: DataFrame) -> DataFrame:
    """(node, attributes): of several descriptions of a node the one with most attributes, of equal ones the first in order."""
    order = Window.partitionBy("node").orderBy(F.desc(F.size("attributes")), F.to_json("attributes"))
    return nodes.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def united_edges(edges: DataFrame, order: str = "seq") -> DataFrame:
    """One edge for each (source, target, kind), the last one by `order`."""
    last = Window.partitionBy("source", "target", "kind").orderBy(F.desc(order))
    return edges.withColumn("place", F.row_number().over(last)).where("place = 1").drop("place")


def node_size(n: Column, base: float = 24.0, scale: float = 8.0) -> Column:
    """What a node measures on screen by its number of events (fixed values)."""
    held = F.coalesce(n.cast("double"), F.lit(0.0))
    return F.when(held > 0, base + scale * F.log10(1 + held)).otherwise(F.lit(base))


def named_techniques(ids: Column, names: Column) -> Column:
    """array<struct<id,name>> of ids with the names at their places, the first name where there are fewer; empty ids go."""
    text = F.array().cast("array<string>")
    ids, names = F.coalesce(ids, text), F.coalesce(names, text)
    paired = F.transform(ids, lambda x, i: F.struct(x.alias("id"), F.coalesce(F.get(names, i), F.get(names, F.lit(0))).alias("name")))
    return F.filter(paired, lambda p: F.coalesce(p["id"], F.lit("")) != "")


def highlighted(sets: Column, chosen: list[str], all_of: bool) -> Column:
    """Whether a member of these sets lights up: in all of the chosen sets, or in any of them."""
    wanted = F.array(*[F.lit(c) for c in chosen])
    return F.size(F.array_except(wanted, sets)) == 0 if all_of else F.arrays_overlap(wanted, sets)
