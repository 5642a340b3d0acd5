"""Queries of the intel, naming, grounding, store and search operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import network as N
from ..functions import text as T
from ..functions import verdicts as R
from ..operators import commands, grounding, intel, naming, rollups, search, store
from ..sources import adapters as A
from ..sources.adapters import EV, table
from .queries import AS_OF, SES, query, sql_stamp, stamp


@query("SELECT t.command_line, (SELECT count(*) FROM ev e WHERE e.command_line = t.command_line) AS occurrence_count FROM (SELECT DISTINCT command_line FROM ev) t WHERE substr(sha256(t.command_line), 1, 1) NOT IN ('0', '1', '2', '3')", (EV,))
def skip_if_fresh(spark, d):
    c = commands.dedup(A.events(spark, d))
    cache = c.where(F.substring("command_hash", 1, 1).isin(*"0123")).select("command_hash", F.lit("live").alias("embed_config_hash"))
    return naming.unembedded(c, cache, "live").select("command_line", "occurrence_count")


@query("SELECT command_line, CASE WHEN length(command_line) % 3 = 0 THEN 'legacy' ELSE 'changed' END AS stale FROM (SELECT DISTINCT command_line FROM ev) WHERE length(command_line) % 3 < 2", (EV,))
def stale_commands(spark, d):
    n = F.length("command_line") % 3
    c = commands.dedup(A.events(spark, d)).withColumn("llm_config_hash", F.when(n == 1, "old").when(n == 2, "live"))
    return commands.stale(c, "live").select("command_line", "stale")


@query(f"SELECT source_ip, count(*) AS n FROM ev WHERE ts > (SELECT min(ts) + INTERVAL 10 DAY FROM ev) GROUP BY 1", (EV,))
def since_watermark(spark, d):
    ev = A.events(spark, d)
    state = ev.agg((F.min("ts") + F.expr("INTERVAL 10 DAYS")).alias("at")).select(F.lit("ips").alias("key"), "at")
    return store.since(ev, state, "ips").groupBy("source_ip").agg(F.count("*").alias("n"))


@query("SELECT key, count(*) FILTER (NOT old) AS renamable, count(*) FILTER (old) AS frozen FROM (SELECT lower(p_name) AS key, p_partkey % 3 = 0 AS old FROM part) GROUP BY 1 HAVING count(*) > 1 AND count(*) FILTER (NOT old) >= 1")
def name_collisions(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("playbook_id"), F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")).alias("playbook_name"), (F.col("p_partkey") % 3 == 0).alias("old"))
    return naming.collisions(p.where("NOT old"), p.where("old"))


@query("SELECT custkey, max_by(orderpriority, (o_orderdate, orderpriority)) AS playbook_name, list_sort(list(DISTINCT o_orderstatus)) AS samples FROM (SELECT CAST(o_custkey AS VARCHAR) AS custkey, o_orderpriority AS orderpriority, o_orderdate, o_orderstatus FROM orders) GROUP BY 1")
def newest_names(spark, d):
    runs = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("playbook_id"), F.col("o_orderpriority").alias("playbook_name"), F.col("o_orderdate").alias("ts"), F.array("o_orderstatus").alias("samples"))
    return naming.newest_names(runs).withColumnRenamed("playbook_id", "custkey")


@query("SELECT event_type AS token, CAST(count(*) AS BIGINT) AS n, CASE event_type WHEN 'click' THEN 'denied' WHEN 'view' THEN 'curated' WHEN 'error' THEN 'tldr_only' ELSE 'needs_def' END AS bucket FROM ev GROUP BY 1", (EV,))
def coverage_buckets(spark, d):
    denied = spark.createDataFrame([("Click",)], "token string")
    curated = spark.createDataFrame([("view", "looks", {"-x": "fast"})], "command string, description string, flags map<string,string>")
    pages = spark.createDataFrame([("view", {"linux": "l"}), ("error", {"common": "c"})], "command string, by_os map<string,string>")
    counts = grounding.token_counts(commands.dedup(A.events(spark, d)), denied)
    return grounding.coverage(counts, grounding.dictionary(curated, pages)).select("token", "n", "bucket")


@query("SELECT kind, value, malicious, override, n_malicious FROM (SELECT 'ip' AS kind, CAST(doc_id AS VARCHAR) AS value, CASE WHEN toxic = 1 THEN true WHEN quality = 1 THEN false ELSE true END AS malicious, CASE WHEN toxic = 1 THEN 'direct_malicious' WHEN quality = 1 THEN 'authoritative_clean' ELSE '' END AS override, CAST(1 + toxic AS INTEGER) AS n_malicious FROM labels)")
def intel_refresh(spark, d):
    lab = table(spark, d, "labels").withColumn("ip", F.col("doc_id").cast("string"))
    providers = [
        intel.Provider("direct", ("ip",), 1, None, intel.listed(lab.where("toxic = 1"), R.verdict(True, "d", 9, direct=True))),
        intel.Provider("clean", ("ip",), 3, None, intel.listed(lab.where("quality = 1"), R.verdict(False, "c", 8, clean=True))),
        intel.Provider("list", ("ip",), 7, None, intel.listed(lab, R.verdict(True, "l", 8))),
    ]
    found = intel.refreshed(lab.select(F.lit("ip").alias("kind"), F.col("ip").alias("value"), F.lit(0.0).alias("priority")), providers, F.lit(AS_OF).cast("timestamp"))
    judged = intel.judged(intel.merged(found.limit(0), found))
    return judged.select("kind", "value", *[F.col(f"consensus.{c}").alias(c) for c in ("malicious", "override", "n_malicious")])


@query("SELECT 'ip' AS kind, count(*) FILTER (toxic = 1) AS changed, count(*) AS n FROM labels")
def reapplied_rules(spark, d):
    lab = table(spark, d, "labels")
    t = F.lit(AS_OF).cast("timestamp")
    blocks = lab.select(F.lit("ip").alias("kind"), F.col("doc_id").cast("string").alias("value"), F.lit("noise").alias("provider"), F.when(F.col("toxic") == 1, R.verdict(True, "m", 9, direct=True)).otherwise(R.verdict()).alias("verdict"), t.alias("fetched_at"), t.alias("ttl_expires_at"))
    after = intel.reapplied(blocks, {"noise": R.verdict(None, "unsure", 5)})
    return intel.consensus_changes(intel.judged(blocks), intel.judged(after))


@query("SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, round(sum((k * 3.0 + user_id * 15.0) / 1e6), 6) AS usd FROM (SELECT ts, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1")
def daily_spend(spark, d):
    calls = table(spark, d, "events").select("ts", F.get_json_object("props", "$.k").cast("int").alias("n_in"), F.col("user_id").alias("n_out"))
    return intel.spend(calls).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1")
def url_hosts(spark, d):
    u = N.url_parts(N.canonical_url(F.col("url")))
    return table(spark, d, "pages").groupBy(u["domain"].alias("host")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, length(text) > 80 AS cut, CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '…' ELSE text END AS label FROM documents")
def text_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", (F.length("text") > 80).alias("cut"), T.label(F.col("text")).alias("label"))


@query("SELECT conv_id, greatest(count(*) - count(*) FILTER (role = 'user'), 0) AS others, max(turn) - min(turn) AS span FROM conversations GROUP BY 1")
def conversation_rollup(spark, d):
    c = table(spark, d, "conversations")
    return c.groupBy("conv_id").agg(F.greatest(F.count("*") - F.count_if(F.col("role") == "user"), F.lit(0)).alias("others"), (F.max("turn") - F.min("turn")).alias("span"))


@query("SELECT action, CASE WHEN action LIKE 'login%' THEN 'authentication' WHEN action = 'command.input' THEN 'process' ELSE 'file' END AS category, CASE action WHEN 'login.failed' THEN 'failure' WHEN 'login.success' THEN 'success' END AS outcome, count(*) AS n FROM ev GROUP BY ALL", (EV,))
def ingest_projection(spark, d):
    from ..sources import feeds

    ev = A.events(spark, d)
    eventid = F.when(F.col("action") == "file_download", "cowrie.session.file_download").otherwise(F.concat(F.lit("cowrie."), "action"))
    lines = ev.select(F.to_json(F.struct(eventid.alias("eventid"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.col("source_ip").alias("src_ip"), F.col("session_id").alias("session"), F.col("command_line").alias("input"))).alias("value"))
    fields = "eventid string, timestamp string, src_ip string, src_port string, dst_ip string, dst_port string, session string, protocol string, username string, password string, input string, version string, url string, destfile string, shasum string, duration double, message string"
    out = feeds.project_log(lines, "value", fields)
    action = F.regexp_replace(F.regexp_replace("action", "^cowrie[.]", ""), "^session[.]", "")
    return out.groupBy(action.alias("action"), "category", "outcome").agg(F.count("*").alias("n"))


@query("SELECT page_id, 'GET' AS method, CAST(80 + page_id % 3 AS INTEGER) AS destination_port, lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS domain, 'GET ' || url AS message, CAST(octet_length(encode(url)) AS INTEGER) AS body_bytes FROM pages")
def web_projection(spark, d):
    from ..sources import web

    p = table(spark, d, "pages")
    row = F.struct(F.col("page_id").cast("string").alias("sip"), F.lit("get").alias("method"), "url", (80 + F.col("page_id") % 3).cast("string").alias("dport"), F.col("url").alias("body"), F.lit("HTTP/1.1").alias("version"))
    out = web.project(p.select(F.to_json(row).alias("value")))
    return out.select(F.col("source_ip").cast("long").alias("page_id"), "method", "destination_port", F.lower("domain").alias("domain"), "message", "body_bytes")


@query("SELECT 'command' AS kind, command_line AS id, CAST(CASE WHEN contains(command_line, 'click k=77') THEN 1 ELSE 0 END + 2 * (CASE WHEN event_type = 'click' THEN 1 ELSE 0 END + 1 + CASE WHEN k = 77 THEN 1 ELSE 0 END) AS DOUBLE) AS score FROM (SELECT DISTINCT command_line, event_type, k FROM ev) ORDER BY score DESC, id LIMIT 20", (EV,))
def free_text_search(spark, d):
    c = commands.dedup(A.events(spark, d))
    return search.hits(c, "command", "command_line", ["command_line"], "click k=77").select("kind", "id", "score").orderBy(F.desc("score"), "id").limit(20)


@query(f"SELECT {sql_stamp('min(ts)')} AS first, {sql_stamp('max(ts)')} AS last, count(DISTINCT session_id) AS sessions FROM ev", (EV,))
def timeline_bounds(spark, d):
    return A.events(spark, d).agg(stamp(F.min("ts")).alias("first"), stamp(F.max("ts")).alias("last"), F.countDistinct("session_id").alias("sessions"))


@query("SELECT source_ip, n FROM (SELECT source_ip, CAST(sum(command_count) AS BIGINT) AS n FROM ses GROUP BY 1) ORDER BY n DESC, source_ip LIMIT 20", (EV, SES))
def dashboard_top_ips(spark, d):
    s = rollups.sessions(A.events(spark, d))
    return s.groupBy("source_ip").agg(F.sum("command_count").alias("n")).orderBy(F.desc("n"), "source_ip").limit(20)


@query("SELECT command_line, spent FROM (SELECT command_line, CAST(sum(1) OVER (ORDER BY nov DESC, h ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent FROM (SELECT command_line, round(1.0 / count(*), 9) AS nov, substr(sha256(command_line), 1, 16) AS h FROM ev GROUP BY 1)) WHERE spent <= 25", (EV,))
def budgeted_escalations(spark, d):
    c = commands.dedup(A.events(spark, d)).withColumns({"novelty_score": F.round(1.0 / F.col("occurrence_count"), 9), "cost": F.lit(1)})
    return commands.escalations(c, "cost", 25).select("command_line", "spent")
