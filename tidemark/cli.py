"""Batch verbs over a folder of tables.

    python -m tidemark.cli TARGET VERB [options]

Events are the table `events` below TARGET; each verb reads what earlier ones have written there.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config, load
from .operators import campaign_text, clustering, commands, dashboard, features, findings, intel, mining, naming, rollups, scans, store, worker
from .plans import layers

#: Tables that exist from the start, with their columns.
SCHEMAS = {
    "events": "event_id long, ts timestamp, source_ip string, session_id string, action string, command_line string",
    "findings": findings.STORED,
    "queue": worker.QUEUE,
    "providers": worker.STATE,
    "calls": "ts timestamp, n_in long, n_out long",
    "cache": "command_hash string, llm_config_hash string, embed_config_hash string",
    "watermarks": "key string, at timestamp",
}


class Run:
    """One call of a verb: where the tables are, under which settings, and as of when."""

    def __init__(self, spark: SparkSession, target: str, config: Config, as_of: str | None = None, models: layers.Models = layers.Models()):
        self.spark, self.target, self.config, self.models = spark, target.rstrip("/"), config, models
        self.as_of = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")

    @property
    def live(self) -> str:
        return campaign_text.fingerprint(vars(self.config))

    def path(self, name: str) -> str:
        return f"{self.target}/{name}"

    def table(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return store.ensure(self.spark, self.path(name), SCHEMAS[name])
        return self.spark.read.parquet(self.path(name))

    def put(self, df: DataFrame, name: str) -> int:
        return store.swap(df, self.path(name))


def healthcheck(run: Run, args) -> dict:
    """Which tables there are."""
    names = [*SCHEMAS, "commands", "session_rollup", "sessions", "addresses", "behaviour", "infrastructure"]
    return {n: store.exists(run.spark, run.path(n)) for n in names}


def bootstrap(run: Run, args) -> dict:
    """Makes the tables that are missing."""
    return {n: run.table(n).limit(1).count() >= 0 for n in SCHEMAS}


def reset(run: Run, args) -> dict:
    """Drops the derived tables, or the named ones; events stay unless named."""
    names = args.tables or ["commands", "session_rollup", "sessions", "addresses", "behaviour", "infrastructure", "cache", "_done"]
    store.remove(run.spark, *[run.path(n) for n in names])
    return {"dropped": names}


def budget(run: Run, args) -> dict:
    """What the calls of each day cost."""
    return {str(r["day"]): r["usd"] for r in intel.spend(run.table("calls")).orderBy("day").collect()}


def enrich(run: Run, args) -> dict:
    return {"commands": run.put(layers.command_layer(run.table("events"), run.models, run.config), "commands")}


def rollup(run: Run, args) -> dict:
    """Sessions, or addresses from clustered sessions; only sessions that have closed, if asked for."""
    if args.layer == "addresses":
        return {"addresses": run.put(rollups.addresses(run.table("sessions")), "addresses")}
    events = run.table("events")
    if args.closed:
        events = scans.events_of(events, scans.closed_sessions(events, args.closed))
    return {"session_rollup": run.put(layers.session_layer(events, run.table("commands")), "session_rollup")}


def cluster(run: Run, args) -> dict:
    if args.layer == "sessions":
        run.put(layers.clustered(run.table("session_rollup"), run.config), "sessions")
    rows = run.table({"sessions": "sessions", "commands": "commands"}[args.layer])
    return features.run_summary(rows.where("cluster_id IS NOT NULL")).first().asDict()


def name(run: Run, args) -> dict:
    """Playbooks by their intent and leading commands; equal names get the ends of their ids."""
    sessions = run.table("sessions").where("playbook_id IS NOT NULL")
    top = rollups.dominant(dashboard.playbook_commands(run.table("events"), sessions), "playbook_id", "command_line", 2)
    heads = top.groupBy("playbook_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "command_line"))), lambda x: x["command_line"]).alias("heads"))
    intent = rollups.dominant(sessions, "playbook_id", "dominant_intent", 1).select("playbook_id", F.col("dominant_intent").alias("intent"))
    books = heads.join(intent, "playbook_id", "left").withColumn("intent", F.coalesce("intent", F.lit("unknown")))
    named = naming.disambiguated(books.withColumn("playbook_name", naming.default_name(F.col("heads"), F.col("intent"))))
    return {"playbooks": run.put(named.select("playbook_id", "playbook_name", "intent"), "playbooks")}


def mine(run: Run, args) -> dict:
    """Campaigns of a kind or of all, and findings with their earlier status."""
    sessions, out = run.table("sessions"), {}
    made = dict(zip(("behaviour", "infrastructure") if args.kind == "all" else (args.kind,), mining.campaigns(args.kind, sessions, layers.session_artifacts(run.table("events"), sessions))))
    for kind, df in made.items():
        out[kind] = run.put(df, kind)
    mined = layers.mined_findings(sessions, *[run.table(k) for k in made])
    return out | {"findings": run.put(findings.upsert(run.table("findings"), mined), "findings")}


def escalate(run: Run, args) -> dict:
    """Novel, unsure commands within the budget."""
    wanted = scans.novel_local(run.table("commands").withColumn("provider", F.lit("local")), run.config.novel_at, 1, args.confidence).withColumn("cost", F.lit(args.cost))
    if wanted.limit(1).count() == 0:
        return {"escalated": 0}
    return {"escalated": run.put(commands.escalations(wanted, "cost", args.budget), "escalations")}


def reembed(run: Run, args) -> dict:
    rows = run.table("commands")
    again = scans.to_embed_again(rows).withColumn("embedding", run.models.embed(F.col("command_line")))
    rest = rows.where("embedding IS NULL")
    return {"commands": run.put(again.unionByName(rest), "commands")}


def re_enrich_stale(run: Run, args) -> dict:
    """Enriches anew what was enriched under other settings."""
    rows = run.table("commands")
    held = rows.join(run.table("cache").select("command_hash", "llm_config_hash"), "command_hash", "left")
    stale = commands.stale(held, run.live).select("command_hash", "stale")
    fresh = run.models.enrich(rows.join(stale.select("command_hash"), "command_hash", "left_semi")).select("command_hash", "intent", "confidence")
    n = run.put(stale, "stale")  # before the commands change
    return {"stale": n, "commands": run.put(findings.patched(rows, fresh, "command_hash"), "commands")}


def re_triage(run: Run, args) -> dict:
    """Reasons anew; those that only a run can give stay. Commands outside the window keep theirs."""
    rows = run.table("commands")
    again = scans.to_triage_again(rows, run.as_of, args.days)
    fired = commands.triage_reasons(F.col("command_line"), F.col("confidence"), F.col("novelty_score"), config=run.config)
    patch = again.select("command_hash", commands.retriaged(F.col("triage_reasons"), fired).alias("triage_reasons"))
    return {"commands": run.put(findings.patched(rows, patch, "command_hash"), "commands")}


def bless_cache(run: Run, args) -> dict:
    """Marks all commands as made under today's settings."""
    stamped = store.stamped(run.table("cache"), run.table("commands"), {"llm_config_hash": run.live, "embed_config_hash": run.live})
    return {"cache": run.put(stamped, "cache")}


def refresh_intel(run: Run, args) -> dict:
    """Queues the addresses that are most urgent."""
    a = run.table("addresses")
    found = a.select(F.lit("ip").alias("kind"), F.col("source_ip").alias("value"), F.col("mean_novelty_score").alias("novelty"), F.lit(None).cast("int").alias("confidence"), F.col("total_sessions").alias("n"), F.col("last_seen"))
    urgent = intel.queue(found, run.as_of, args.limit, config=run.config).select("kind", "value", "priority")
    return {"queue": run.put(worker.enqueued(run.table("queue"), urgent, run.as_of), "queue")}


def pipeline(run: Run, args) -> dict:
    return {n: df.count() for n, df in layers.run_all(run.spark, run.table("events"), run.target, run.models, run.config, args.run_id).items()}


VERBS: dict[str, Callable] = {
    "healthcheck": healthcheck, "bootstrap": bootstrap, "init-indexes": bootstrap, "reset": reset, "budget": budget, "enrich": enrich, "rollup": rollup, "cluster": cluster, "name": name,
    "mine": mine, "escalate": escalate, "reembed": reembed, "re-enrich-stale": re_enrich_stale, "re-triage": re_triage, "bless-cache": bless_cache, "intel": refresh_intel, "pipeline": pipeline,
}


#: Verbs that change nothing, so they need no lock.
READS = ("healthcheck", "budget")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("target")
    p.add_argument("verb", choices=sorted(VERBS))
    p.add_argument("--config", action="append", default=[], help="a JSON file of settings; may be given several times")
    p.add_argument("--as-of")
    p.add_argument("--layer", choices=["commands", "sessions", "addresses"], default="sessions")
    p.add_argument("--closed", help="the action that closes a session: only closed ones are rolled up")
    p.add_argument("--kind", choices=["behaviour", "infrastructure", "all"], default="all")
    p.add_argument("--tables", nargs="*")
    p.add_argument("--days", type=int)
    p.add_argument("--budget", type=float, default=5.0)
    p.add_argument("--cost", type=float, default=0.01)
    p.add_argument("--confidence", type=int, default=6)
    p.add_argument("--limit", type=int, default=1000)
    p.add_argument("--run-id")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run = Run(spark, args.target, load(*args.config), args.as_of)
    if args.verb in READS:
        found = VERBS[args.verb](run, args)
    else:
        with store.locked(spark, run.path("_lock")):
            found = VERBS[args.verb](run, args)
    print(found)
    return found


if __name__ == "__main__":
    main()
