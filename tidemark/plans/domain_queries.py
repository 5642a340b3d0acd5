"""Queries of scans, feature blocks, search, graph, panels and worker state, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import clustering, commands, dashboard, features, findings, graph, mining, naming, rollups, scans, search, worker
from ..sources import adapters as A
from ..sources.adapters import EV, VEC, table
from .queries import AS_OF, CEN, SES, query, sql_stamp, stamp

def now():
    return F.lit(AS_OF).cast("timestamp")


#: Sessions with a cluster, a playbook, an intent and a country, worked out from their counts.
DOM = """dom AS (SELECT *, CASE WHEN command_count % 5 = 0 THEN 'outlier' ELSE CAST(command_count % 5 AS VARCHAR) END AS cluster_id,
  CASE WHEN command_count % 5 > 0 THEN 'p' || (command_count % 5) // 2 END AS playbook_id, CASE WHEN unique_commands % 4 > 0 THEN 'i' || unique_commands % 4 END AS intent,
  ['US', 'CN', 'DE'][1 + CAST(source_ip AS BIGINT) % 3] AS country, CAST(source_ip AS BIGINT) % 7 AS asn FROM ses)"""


def dom(spark, d):
    n, ip = F.col("command_count") % 5, F.col("source_ip").cast("long")
    return rollups.sessions(A.events(spark, d)).withColumns(
        {
            "cluster_id": F.when(n == 0, "outlier").otherwise(n.cast("string")), "playbook_id": F.when(n > 0, F.concat(F.lit("p"), F.floor(n / 2).cast("string"))),
            "intent": F.when(F.col("unique_commands") % 4 > 0, F.concat(F.lit("i"), (F.col("unique_commands") % 4).cast("string"))),
            "country": F.element_at(F.array(F.lit("US"), F.lit("CN"), F.lit("DE")), (1 + ip % 3).cast("int")), "asn": ip % 7,
        }
    )


@query(f"SELECT session_id, count(*) AS events, {sql_stamp('max(c)')} AS closed_at FROM (SELECT *, max(ts) FILTER (action = 'file_download') OVER (PARTITION BY session_id) AS c FROM ev) WHERE c IS NOT NULL GROUP BY 1", (EV,))
def closed_sessions(spark, d):
    ev = A.events(spark, d)
    closed = scans.closed_sessions(ev, "file_download")
    rolled = scans.events_of(ev, closed).groupBy("session_id").agg(F.count("*").alias("events"))
    return rolled.join(closed, "session_id").select("session_id", "events", stamp("closed_at").alias("closed_at"))


@query("SELECT session_id, command_line, count(*) AS n FROM ev WHERE action = 'command.input' GROUP BY ALL", (EV,))
def session_commands(spark, d):
    ev = A.events(spark, d)
    names = commands.dedup(ev).select("command_hash", "command_line")
    return scans.commands_of_sessions(ev).join(names, "command_hash").select("session_id", "command_line", "n")


@query(f"SELECT command_line, n FROM (SELECT command_line, count(*) AS n, max(ts) AS l FROM ev GROUP BY 1) WHERE l >= date_trunc('day', TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY)", (EV,))
def commands_to_triage_again(spark, d):
    return scans.to_triage_again(commands.dedup(A.events(spark, d)), now(), 3).select("command_line", F.col("occurrence_count").alias("n"))


@query("SELECT command_line, confidence FROM (SELECT command_line, CAST(length(command_line) % 10 AS INTEGER) AS confidence, round(1.0 / count(*), 6) AS nov FROM ev GROUP BY 1) WHERE nov >= 0.01 AND confidence BETWEEN 8 AND 9", (EV,))
def novel_local_commands(spark, d):
    c = commands.dedup(A.events(spark, d)).withColumns({"provider": F.lit("local"), "novelty_score": F.round(1.0 / F.col("occurrence_count"), 6), "confidence": (F.length("command_line") % 10).cast("int")})
    return scans.novel_local(c, 0.01, 8, 9).select("command_line", "confidence")


@query("SELECT event_type AS command_hash, count(*) = count(*) FILTER (CAST(source_ip AS BIGINT) <= 900) AS complete FROM (SELECT DISTINCT event_type, source_ip FROM ev) GROUP BY 1", (EV,))
def addresses_with_intel(spark, d):
    ev = A.events(spark, d)
    known = ev.where(F.col("source_ip").cast("long") <= 900).select("source_ip")
    return scans.all_have_intel(ev.select(F.col("event_type").alias("command_hash"), "source_ip"), known)


@query("SELECT intent, CASE WHEN intent IN ('reconnaissance', 'initial_access', 'execution', 'persistence', 'privilege_escalation', 'defense_evasion', 'credential_access', 'discovery', 'lateral_movement', 'collection', 'command_and_control', 'exfiltration', 'impact', 'cryptomining', 'benign') THEN intent ELSE 'unknown' END AS kept, CAST(5 AS INTEGER) AS confidence FROM (SELECT unnest(['reconnaissance', 'initial_access', 'execution', 'persistence', 'privilege_escalation', 'defense_evasion', 'credential_access', 'discovery', 'lateral_movement', 'collection', 'command_and_control', 'exfiltration', 'impact', 'cryptomining', 'benign', 'unknown', 'sabotage', 'none']) AS intent)")
def closed_intents(spark, d):
    given = spark.createDataFrame([(i,) for i in (*naming.INTENTS, "sabotage", "none")], "intent string")
    reply = F.concat(F.lit('{"intent": " '), F.upper("intent"), F.lit('", "confidence": 5}'))
    checked = naming.validated(reply, F.array().cast("array<string>"))
    return given.select("intent", checked["intent"].alias("kept"), checked["confidence"].alias("confidence"))


@query("SELECT session_id, round(avg(nov), 4) AS mean_novelty_score, round(max(nov), 4) AS max_novelty_score, round(avg(conf), 2) AS mean_confidence FROM (SELECT DISTINCT session_id, command_line FROM ev) JOIN (SELECT command_line, 1.0 / count(*) AS nov, length(command_line) % 10 AS conf FROM ev GROUP BY 1) USING (command_line) GROUP BY 1", (EV,))
def session_novelty(spark, d):
    ev = A.events(spark, d)
    c = commands.dedup(ev).select("command_hash", (1.0 / F.col("occurrence_count")).alias("novelty_score"), (F.length("command_line") % 10).alias("confidence"))
    runs = commands.with_hash(ev).select("session_id", "command_hash").distinct()
    return rollups.command_scores(runs.join(c, "command_hash"))


@query("SELECT command_line, CAST(('0x' || substr(sha256(command_line), 17, 6))::UBIGINT AS BIGINT) < 4194304 AS sampled FROM (SELECT DISTINCT command_line FROM ev)", (EV,))
def sampled_commands(spark, d):
    from dataclasses import replace

    from ..config import DEFAULT

    c = commands.dedup(A.events(spark, d))
    reasons = commands.triage_reasons(F.col("command_line"), F.lit(9), config=replace(DEFAULT, sample_rate=0.25))
    return c.select("command_line", F.array_contains(reasons, "sample").alias("sampled"))


@query("SELECT low, high, (SELECT count(*) FROM pairs WHERE similarity >= low AND similarity < high) AS n FROM (SELECT unnest([-1.0, 0.0, 0.5, 0.7, 0.8, 0.85, 0.9, 0.92, 0.94, 0.96, 0.98, 0.99])::DOUBLE AS low, unnest([0.0, 0.5, 0.7, 0.8, 0.85, 0.9, 0.92, 0.94, 0.96, 0.98, 0.99, 1.0001])::DOUBLE AS high)", (VEC, CEN))
def similarity_bands(spark, d):
    from ..functions import vectors as V

    return clustering.similarity_bands(clustering.pair_similarity(V.centroids(A.vectors(spark, d))))


@query("SELECT a, b FROM (SELECT *, round(similarity, 9) AS s FROM pairs) ORDER BY s DESC, a, b LIMIT 20", (VEC, CEN))
def closest_clusters(spark, d):
    from ..functions import vectors as V

    return clustering.closest_pairs(clustering.pair_similarity(V.centroids(A.vectors(spark, d)))).select("a", "b")


@query("SELECT count(*) AS documents, count(DISTINCT cluster_id) FILTER (cluster_id <> 'outlier') AS clusters, count(*) FILTER (cluster_id = 'outlier') AS outliers FROM dom", (EV, SES, DOM))
def run_summary(spark, d):
    return features.run_summary(dom(spark, d))


@query("SELECT source_ip, round(least(greatest(ln(1 + count(*)) / ln(1 + 1e5), 0), 1) * 0.05, 6) AS f_sessions, round(count(*) FILTER (login_success_count > 0) / count(*), 6) AS f_success, CASE WHEN CAST(source_ip AS BIGINT) % 2 = 0 THEN 0.7 ELSE 0.0 END AS intel_confidence, CAST(source_ip AS BIGINT) % 2 = 0 AS intel_malicious FROM ses GROUP BY 1", (EV, SES))
def address_scalar_block(spark, d):
    a = rollups.addresses(rollups.sessions(A.events(spark, d)))
    intel = a.where(F.col("source_ip").cast("long") % 2 == 0).select("source_ip", F.lit(7).alias("confidence"), F.lit(True).alias("malicious"))
    return features.address_scalars(a, intel).select("source_ip", F.round("f_sessions", 6).alias("f_sessions"), F.round("f_success", 6).alias("f_success"), "intel_confidence", "intel_malicious")


@query("SELECT c_custkey, list_transform(top, lambda k: CAST(k = c_nationkey AS INTEGER)) || [CAST(NOT list_contains(top, c_nationkey) AS INTEGER)] AS hot FROM customer, (SELECT list(c_nationkey ORDER BY n DESC, c_nationkey) AS top FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1 LIMIT 4))")
def nation_one_hot(spark, d):
    return features.one_hot(table(spark, d, "customer"), "c_nationkey", 4).select("c_custkey", F.col("c_nationkey_hot").alias("hot"))


@query(f"SELECT playbook_id, count(*) AS n_sessions, count(DISTINCT source_ip) AS n_ips, {sql_stamp('min(start_ts)')} AS first_seen, count(*) FILTER (start_ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND start_ts <= TIMESTAMP '{AS_OF}') AS last_24h, count(*) FILTER (start_ts > TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR AND start_ts <= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR) AS prior_24h FROM dom WHERE playbook_id IS NOT NULL GROUP BY 1", (EV, SES, DOM))
def playbook_totals(spark, d):
    return dashboard.playbook_totals(dom(spark, d), now()).drop("last_seen").withColumn("first_seen", stamp("first_seen"))


TOP = "SELECT playbook_id, {c}, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY playbook_id ORDER BY n DESC, {c}) AS rank FROM (SELECT playbook_id, {e} AS {c}, count(*) AS n FROM dom WHERE playbook_id IS NOT NULL GROUP BY ALL)) WHERE rank <= {n}"


@query(TOP.format(c="country", e="country", n=5), (EV, SES, DOM))
def playbook_countries(spark, d):
    return dashboard.playbook_top(dom(spark, d), "country", 5)


@query(TOP.format(c="intent", e="coalesce(intent, 'unknown')", n=3), (EV, SES, DOM))
def playbook_intents(spark, d):
    return dashboard.playbook_top(dom(spark, d), "intent", 3, "unknown")


@query("SELECT playbook_id, command_line, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY playbook_id ORDER BY n DESC, command_line) AS rank FROM (SELECT playbook_id, substr(command_line, 1, 120) AS command_line, count(*) AS n FROM ev JOIN (SELECT playbook_id, session_id FROM (SELECT *, row_number() OVER (PARTITION BY playbook_id ORDER BY command_count DESC, session_id) AS place FROM dom WHERE playbook_id IS NOT NULL) WHERE place <= 20) USING (session_id) WHERE action = 'command.input' GROUP BY ALL)) WHERE rank <= 5", (EV, SES, DOM))
def playbook_commands(spark, d):
    return dashboard.playbook_commands(A.events(spark, d), dom(spark, d))


@query("SELECT cluster_id, n, intent FROM (SELECT cluster_id, count(*) AS n FROM dom WHERE cluster_id <> 'outlier' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) LEFT JOIN (SELECT cluster_id, intent FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, intent) AS r FROM (SELECT cluster_id, intent, count(*) AS n FROM dom WHERE intent IS NOT NULL GROUP BY ALL)) WHERE r = 1) USING (cluster_id)", (EV, SES, DOM))
def top_session_clusters(spark, d):
    return dashboard.top_clusters(dom(spark, d), "cluster_id", "intent")


@query("SELECT cluster_id, n, coalesce(b, 0) AS n_playbooks FROM (SELECT cluster_id, count(*) AS n FROM adr WHERE cluster_id <> 'outlier' GROUP BY 1) LEFT JOIN (SELECT a.cluster_id, count(DISTINCT playbook_id) AS b FROM adr a JOIN dom d ON a.source_ip = d.source_ip WHERE playbook_id IS NOT NULL GROUP BY 1) USING (cluster_id) ORDER BY n DESC, cluster_id LIMIT 10", (EV, SES, DOM, "adr AS (SELECT DISTINCT source_ip, CASE WHEN CAST(source_ip AS BIGINT) % 4 = 0 THEN 'outlier' ELSE CAST(CAST(source_ip AS BIGINT) % 4 AS VARCHAR) END AS cluster_id FROM ev)"))
def top_address_clusters(spark, d):
    s = dom(spark, d)
    k = F.col("source_ip").cast("long") % 4
    adr = s.select("source_ip").distinct().withColumn("cluster_id", F.when(k == 0, "outlier").otherwise(k.cast("string")))
    return dashboard.address_clusters(adr, s)


@query("SELECT source_ip, playbook_id, count(*) AS n, any_value('name ' || playbook_id) AS playbook_name FROM dom WHERE playbook_id IS NOT NULL GROUP BY 1, 2", (EV, SES, DOM))
def named_playbooks_for_ip(spark, d):
    s = dom(spark, d)
    names = s.where("playbook_id IS NOT NULL").select("playbook_id", F.concat(F.lit("name "), "playbook_id").alias("playbook_name")).distinct()
    return dashboard.playbooks_of(s, names)


@query("SELECT playbook_id, count(DISTINCT source_ip) AS n_ips, count(*) AS n_sessions FROM dom WHERE playbook_id IS NOT NULL GROUP BY 1", (EV, SES, DOM))
def addresses_for_playbook(spark, d):
    return dashboard.addresses_of(dom(spark, d))


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN toxic = 1 THEN 'confirmed' ELSE 'new' END AS status FROM labels) GROUP BY 1")
def findings_by_status(spark, d):
    return dashboard.counts_by(table(spark, d, "labels").select(F.when(F.col("toxic") == 1, "confirmed").otherwise("new").alias("status")), "status")


@query("SELECT 'pages' AS name, (SELECT count(*) FROM pages) AS n UNION ALL SELECT 'events', (SELECT count(*) FROM events)")
def table_counts(spark, d):
    return dashboard.table_counts({n: table(spark, d, n) for n in ("pages", "events")})


@query("SELECT command_line, count(*) AS n FROM ev WHERE session_id IN (SELECT session_id FROM dom WHERE cluster_id = '1') AND action = 'command.input' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", (EV, SES, DOM))
def cluster_top_commands(spark, d):
    ev = A.events(spark, d).where("action = 'command.input'")
    return dashboard.top_commands(ev, dom(spark, d).where("cluster_id = '1'"))


@query("SELECT session_id, country, greatest(login_fail_count + login_success_count - login_success_count, 0) AS failed FROM (SELECT DISTINCT session_id FROM ev WHERE event_type = 'error') LEFT JOIN dom USING (session_id)", (EV, SES, DOM))
def hydrated_sessions(spark, d):
    ids = A.events(spark, d).where("event_type = 'error'").select("session_id")
    out = dashboard.hydrated(ids, dom(spark, d), "session_id", ["country", "login_fail_count", "login_success_count"])
    return out.select("session_id", "country", dashboard.failed_sessions(F.col("login_fail_count") + F.col("login_success_count"), F.col("login_success_count")).alias("failed"))


# --- graph

GRAPH = """edges AS (SELECT 'ip:' || source_ip AS source, 'session:' || session_id AS target, 'saw' AS kind, 1 AS n FROM dom
UNION ALL SELECT 'session:' || session_id, 'session_cluster:' || cluster_id, 'in_cluster', 1 FROM dom
UNION ALL SELECT 'session_cluster:' || cluster_id, 'playbook:' || playbook_id, 'playbook_of', count(*) FROM dom WHERE playbook_id IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'session:' || session_id, 'command:' || substr(sha256(command_line), 1, 16), 'ran', count(*) FROM ev WHERE action = 'command.input' GROUP BY ALL
UNION ALL SELECT 'command:' || h, 'command_cluster:' || length(c) % 3, 'in_cluster', 1 FROM cmd
UNION ALL SELECT 'command:' || h, 'technique:T' || 1000 + length(c), 'shows', 1 FROM cmd
UNION ALL SELECT 'command:' || h, 'tactic:TA000' || length(c) % 4, 'shows', 1 FROM cmd
UNION ALL SELECT DISTINCT 'ip:' || source_ip, 'asn:' || asn, 'of_network', 1 FROM dom
UNION ALL SELECT DISTINCT 'ip:' || source_ip, 'country:' || country, 'of_country', 1 FROM dom
UNION ALL SELECT DISTINCT 'ip:' || source_ip, 'ip_cluster:' || asn % 2, 'in_cluster', 1 FROM dom
UNION ALL SELECT 'campaign:' || country, 'session:' || session_id, 'has', 1 FROM dom
UNION ALL SELECT DISTINCT 'campaign:' || country, 'playbook:' || playbook_id, 'has', 1 FROM dom WHERE playbook_id IS NOT NULL)"""
CMD = "cmd AS (SELECT DISTINCT substr(sha256(command_line), 1, 16) AS h, command_line AS c FROM ev WHERE action = 'command.input')"
BASE = (EV, SES, DOM, CMD, GRAPH)


def the_graph(spark, d):
    ev, s = A.events(spark, d), dom(spark, d)
    size = F.length("command_line")
    c = commands.dedup(ev.where("action = 'command.input'")).select(
        "command_hash", (size % 3).alias("cluster_id"), F.array(F.concat(F.lit("t"), (1000 + size).cast("string"))).alias("techniques"), F.array(F.concat(F.lit("TA000"), (size % 4).cast("string"))).alias("tactics")
    )
    a = s.select("source_ip", "asn", "country", (F.col("asn") % 2).alias("cluster_id")).distinct()
    k = s.groupBy(F.col("country").alias("campaign_id")).agg(F.collect_set("session_id").alias("session_ids"), F.collect_set("playbook_id").alias("playbook_ids"))
    return graph.edges(graph.Tables(s, scans.commands_of_sessions(ev), c, a, k))


@query("SELECT kind, count(*) AS edges, CAST(sum(n) AS BIGINT) AS n FROM edges GROUP BY 1", BASE)
def graph_edges(spark, d):
    return the_graph(spark, d).groupBy("kind").agg(F.count("*").alias("edges"), F.sum("n").alias("n"))


#: One anchor of each kind.
ANCHORS = ["ip:7", "session:7-20240101", "command_cluster:1", "session_cluster:2", "ip_cluster:1", "playbook:p1", "campaign:DE", "asn:3", "country:CN", "technique:T1009", "tactic:TA0001"]


@query(" UNION ALL ".join(f"SELECT '{a}' AS anchor, source, target, kind, n FROM (SELECT * FROM edges WHERE source = '{a}' OR target = '{a}' ORDER BY n DESC, source, target, kind LIMIT 50)" for a in ANCHORS), BASE)
def graph_anchors(spark, d):
    return graph.neighbours_of(the_graph(spark, d), ANCHORS)


@query("SELECT source, target, kind, n FROM edges WHERE source = 'playbook:p1' OR target = 'playbook:p1' ORDER BY n DESC, source, target, kind LIMIT 50", BASE)
def graph_of_playbook(spark, d):
    return graph.neighbours(the_graph(spark, d), "playbook:p1")


@query("""SELECT node, hop, CASE hop WHEN 0 THEN 'anchor' WHEN 2 THEN 'leaf' ELSE 'mini_anchor' END AS role FROM (SELECT 'asn:3' AS node, 0 AS hop UNION ALL SELECT node, 1 FROM one
UNION ALL SELECT DISTINCT y, 2 FROM (SELECT x, y, row_number() OVER (PARTITION BY x ORDER BY n DESC, y) AS place FROM both_ways JOIN one ON x = node WHERE y <> 'asn:3' AND y NOT IN (SELECT node FROM one)) WHERE place <= 30)""", (*BASE, "both_ways AS (SELECT x, y, sum(n) AS n FROM (SELECT source AS x, target AS y, n FROM edges UNION ALL SELECT target, source, n FROM edges) GROUP BY ALL)", "one AS (SELECT y AS node FROM both_ways WHERE x = 'asn:3' ORDER BY n DESC, y LIMIT 50)"))
def graph_expansion(spark, d):
    return graph.expanded(the_graph(spark, d), "asn:3", 2)


@query("SELECT 'session:' || session_id AS session, 'ip:' || source_ip AS ip FROM dom WHERE country = 'DE'", (EV, SES, DOM))
def campaign_addresses(spark, d):
    return graph.sessions_and_addresses(the_graph(spark, d), "DE")


@query("SELECT 'ip:' || source_ip AS ip, count(DISTINCT playbook_id) AS n FROM dom WHERE playbook_id IS NOT NULL GROUP BY 1", (EV, SES, DOM))
def playbook_breadth(spark, d):
    return graph.playbooks_of_addresses(the_graph(spark, d))


@query("SELECT source_ip, round(24 + 8 * log10(1 + count(*)), 6) AS size FROM ev GROUP BY 1", (EV,))
def graph_node_sizes(spark, d):
    return A.events(spark, d).groupBy("source_ip").agg(F.round(graph.node_size(F.count("*")), 6).alias("size"))


# --- search

@query("""SELECT kind, id, CAST(score AS DOUBLE) AS score FROM (SELECT 'command' AS kind, substr(sha256(command_line), 1, 16) AS id, max(CASE WHEN contains(lower(command_line), 'click k=7') THEN 1 ELSE 0 END + 2 * (CASE WHEN event_type = 'click' THEN 1 ELSE 0 END + 1 + CASE WHEN k = 7 THEN 1 ELSE 0 END)) AS score FROM ev GROUP BY ALL
UNION ALL SELECT 'playbook', CAST(p_partkey AS VARCHAR), 2 * len(list_intersect(list_distinct(regexp_split_to_array(lower(p_name), '[^a-z0-9]+')), ['click', 'k', '7'])) FROM part WHERE p_size = (SELECT max(p_size) FROM part)
UNION ALL SELECT 'campaign', 'c1', 7 UNION ALL SELECT 'cluster', CAST(n_nationkey AS VARCHAR), 2 * len(list_intersect(regexp_split_to_array(lower(n_name), '[^a-z0-9]+'), ['click', 'k', '7'])) FROM nation) WHERE score > 0 ORDER BY score DESC, kind, id LIMIT 20""", (EV,))
def search_everything(spark, d):
    c = commands.dedup(A.events(spark, d)).withColumn("description", F.lit(None).cast("string"))
    p = table(spark, d, "part").select(F.col("p_size").cast("string").alias("run_id"), F.col("p_size").alias("ts"), F.col("p_partkey").cast("string").alias("playbook_id"), F.col("p_name").alias("playbook_name"))
    k = spark.createDataFrame([("c1", "a spree", "Sundry CLICK k=7"), ("c2", "other", "none")], "campaign_id string, name string, rationale string")
    n = table(spark, d, "nation").select(F.lit("r").alias("run_id"), F.lit(1).alias("ts"), F.col("n_nationkey").alias("cluster_id"), F.col("n_name").alias("label"))
    return search.search("click k=7", c, p, k, n).select("kind", "id", "score")


# --- worker

@query(f"SELECT 'ip' AS kind, CAST(doc_id AS VARCHAR) AS value, CASE WHEN toxic = 1 THEN 9.0 ELSE 1.0 END AS priority, CASE WHEN toxic = 1 THEN '{AS_OF}' ELSE '2024-01-01 00:00:00' END AS enqueued_at, CAST(2 AS INTEGER) AS attempts FROM labels WHERE quality = 1 OR toxic = 1")
def worker_queue(spark, d):
    lab = table(spark, d, "labels").select(F.lit("ip").alias("kind"), F.col("doc_id").cast("string").alias("value"), "toxic", "quality")
    stored = lab.select("kind", "value", F.lit(1.0).alias("priority"), F.lit("2024-01-01").cast("timestamp").alias("enqueued_at"), F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error"))
    q = worker.enqueued(stored, lab.where("toxic = 1").select("kind", "value", F.lit(9.0).alias("priority")), now())
    q = worker.done(q, lab.where("coalesce(quality, 0) <> 1 AND coalesce(toxic, 0) <> 1"))
    q = worker.failed(q, q.select("kind", "value", F.lit("timeout").alias("error")))
    return q.select("kind", "value", "priority", stamp("enqueued_at").alias("enqueued_at"), "attempts")


@query(f"SELECT event_type AS provider, CAST(count(*) FILTER (CAST(ts AS DATE) = DATE '{AS_OF[:10]}') AS INTEGER) AS spent, CAST(count(*) FILTER (ts > coalesce(ok, TIMESTAMP '1970-01-01')) AS INTEGER) AS failures FROM (SELECT *, max(CASE WHEN k % 3 > 0 THEN ts END) OVER (PARTITION BY event_type) AS ok FROM ev) GROUP BY 1", (EV,))
def worker_state(spark, d):
    calls = A.events(spark, d).select(F.col("event_type").alias("provider"), (F.col("k") % 3 > 0).alias("ok"), "ts")
    return worker.charged(spark.createDataFrame([], worker.STATE), calls, now()).select("provider", "spent", "failures")


@query("SELECT session_id, len(list_distinct(list(command_line))) AS n FROM ev WHERE command_line LIKE 'click%' GROUP BY 1", (EV,))
def model_indicators(spark, d):
    """A model names a command as a URL and a hash; only what the command bears out stays."""
    ev = commands.with_hash(A.events(spark, d)).where(F.col("command_line").isNotNull())
    is_click = F.col("command_line").startswith("click")
    url = F.concat(F.lit(" http://h/"), "command_hash", F.lit(" "))
    named = ev.select("command_hash", F.when(is_click, F.array(url, F.lit("bare.example"))).alias("urls"), F.array(F.lit("d" * 32), F.lit("ff")).alias("hashes")).distinct()
    found = mining.model_artifacts(named, ev)
    runs = mining.all_artifacts(spark.createDataFrame([], "session_id string, source_ip string, kind string, value string"), ev, found)
    return runs.groupBy("session_id").agg(F.count("*").alias("n"))


@query("SELECT doc_id, len(list_filter(list_distinct(string_split(text, ' ')), lambda w: regexp_full_match(lower(rtrim(trim(w), '.')), '([a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?\\.)+[a-z]{2,63}'))) AS domains, len(list_filter(list_distinct(string_split(text, ' ')), lambda w: regexp_full_match(w, '(?i)(https?|ftps?|tftp)://(.|\\n)+'))) AS urls FROM documents")
def listed_indicators(spark, d):
    words = F.array_distinct(F.split("text", " "))
    return table(spark, d, "documents").select("doc_id", F.size(T.listed_iocs("domains", words)).cast("long").alias("domains"), F.size(T.listed_iocs("urls", words)).cast("long").alias("urls"))


@query("SELECT finding_id, status, CAST(len AS INTEGER) AS history FROM (SELECT 'find-pla-' || substr(sha256('playbook:' || playbook_id), 1, 16) AS finding_id, CASE WHEN playbook_id = 'p1' THEN 'triaged' ELSE 'new' END AS status, CASE WHEN playbook_id = 'p1' THEN 1 ELSE 0 END AS len FROM dom WHERE playbook_id IS NOT NULL GROUP BY playbook_id)", (EV, SES, DOM))
def findings_over_runs(spark, d):
    """Mined, judged by an analyst, and mined again."""
    from .layers import mined_findings

    s = dom(spark, d).withColumn("mean_novelty_score", F.lit(0.5))
    first = findings.upsert(spark.createDataFrame([], findings.STORED), mined_findings(s))
    p1 = s.where("playbook_id = 'p1'").select(T.finding_id("playbook", F.col("playbook_id")).alias("finding_id"), F.lit("triaged").alias("to_status"), F.lit("n").alias("note")).distinct()
    again = findings.upsert(findings.set_status(first, p1, now()), mined_findings(s))
    return again.select("finding_id", "status", F.size("status_history").alias("history"))


@query("SELECT playbook_id, n || ' sessions' AS label, 'Playbook of ' || n || ' sessions from ' || ips || ' addresses' AS narrative, CASE playbook_id WHEN 'p1' THEN 'accept_split' ELSE 'marginal_split' END AS verdict FROM (SELECT playbook_id, count(*) AS n, count(DISTINCT source_ip) AS ips FROM dom WHERE playbook_id IS NOT NULL GROUP BY 1)", (EV, SES, DOM))
def narratives(spark, d):
    from ..operators import campaign_text as C

    t = dashboard.addresses_of(dom(spark, d))
    verdict = C.closed_verdict(F.when(F.col("playbook_id") == "p1", " Accept_Split ").otherwise("whatever"))
    return t.select("playbook_id", F.format_string("%d sessions", "n_sessions").alias("label"), C.finding_narrative(F.lit("playbook"), F.col("n_sessions"), F.col("n_ips")).alias("narrative"), verdict.alias("verdict"))


@query("SELECT 'T' || length(command_line) AS technique, count(*) AS n FROM (SELECT DISTINCT command_line FROM ev) GROUP BY 1", (EV,))
def technique_counts(spark, d):
    from ..operators import campaign_text as C

    c = commands.dedup(A.events(spark, d))
    return C.technique_counts(c.withColumn("techniques", F.array(F.concat(F.lit("T"), F.length("command_line").cast("string")))))


@query("SELECT lower(p_brand) AS token, CASE WHEN p_brand LIKE '%1' THEN 'new' ELSE 'old' END AS rationale FROM (SELECT DISTINCT replace(p_brand, '#', '') AS p_brand FROM part) WHERE p_brand NOT LIKE '%2'")
def deny_list(spark, d):
    from ..operators import campaign_text as C

    brands = table(spark, d, "part").select(F.replace("p_brand", F.lit("#"), F.lit("")).alias("token")).distinct()
    stored = brands.select(F.lower("token").alias("token"), F.lit("old").alias("rationale"))
    add = brands.where("token LIKE '%1'").withColumn("rationale", F.lit("new")).unionByName(spark.createDataFrame([("two words", "x"), ("", "x"), ('"q"', "x")], "token string, rationale string"))
    return C.denied(stored, add, brands.where("token LIKE '%2'"))


@query("SELECT session_id, CASE cluster_id WHEN '1' THEN 'Brute force' ELSE 'old' END AS playbook_name FROM dom", (EV, SES, DOM))
def renamed_playbooks(spark, d):
    from ..operators import campaign_text as C

    names = spark.createDataFrame([("1", ' "Brute force." ')], "cluster_id string, playbook_name string")
    return C.renamed_playbooks(dom(spark, d).withColumn("playbook_name", F.lit("old")), names).select("session_id", "playbook_name")


@query("SELECT cluster_id, playbook_id, 'n' || playbook_id AS playbook_name FROM (SELECT cluster_id, min(playbook_id) AS playbook_id FROM dom WHERE playbook_id IS NOT NULL GROUP BY 1)", (EV, SES, DOM))
def playbook_of_cluster(spark, d):
    s = dom(spark, d)
    runs = s.select(F.lit("new").alias("run_id"), F.lit(2).alias("ts"), "cluster_id", "playbook_id", F.concat(F.lit("n"), "playbook_id").alias("playbook_name"))
    old = runs.withColumns({"run_id": F.lit("old"), "ts": F.lit(1), "playbook_id": F.lit("a")})
    return dashboard.book_of_cluster(runs.unionByName(old))


@query("SELECT doc_id, list_contains([source, lang], 'en') AS any_of, list_contains([source, lang], 'en') AND list_contains([source, lang], source) AS all_of FROM documents")
def highlighted_sets(spark, d):
    sets = F.array("source", "lang")
    docs = table(spark, d, "documents")
    return docs.select("doc_id", graph.highlighted(sets, ["en", "no"], False).alias("any_of"), graph.highlighted(sets, ["en"], True).alias("all_of"))


@query("SELECT event_type AS node, max(k) AS best FROM ev GROUP BY 1", (EV,))
def united_nodes(spark, d):
    """Of several descriptions of a node the one with most attributes stays."""
    ev = A.events(spark, d)
    pairs = F.map_from_entries(F.transform(F.sequence(F.lit(0), F.col("k")), lambda i: F.struct(i.cast("string"), i.cast("string"))))
    nodes = ev.select(F.col("event_type").alias("node"), "k").distinct().select("node", pairs.alias("attributes"))
    return graph.united_nodes(nodes).select("node", (F.size("attributes") - 1).alias("best"))


# --- documents and further panels

@query("SELECT session_id, command_count, arg_min(event_type, (ts, event_type)) AS event_type FROM ev JOIN ses USING (session_id) GROUP BY 1, 2", (EV, SES))
def session_documents(spark, d):
    return rollups.session_documents(A.events(spark, d), ["event_type"]).select("session_id", "command_count", "event_type")


@query("SELECT source_ip, total, country, credentials FROM (SELECT source_ip, count(*) AS total, any_value(country) AS country FROM dom GROUP BY 1) JOIN (SELECT source_ip, list_sort(list(DISTINCT event_type || ':' || k))[1:200] AS credentials FROM ev GROUP BY 1) USING (source_ip)", (EV, SES, DOM))
def address_documents(spark, d):
    ev = A.events(spark, d).withColumns({"user_name": F.col("event_type"), "password": F.col("k").cast("string")})
    out = rollups.address_documents(dom(spark, d), ev, ["country"])
    return out.select("source_ip", F.col("total_sessions").alias("total"), "country", "credentials")


@query("SELECT doc_id AS k, CASE doc_id % 4 WHEN 0 THEN 'narrow' WHEN 1 THEN 'half' WHEN 2 THEN 'wide' END AS place FROM documents")
def located_addresses(spark, d):
    ip = F.concat(F.lit("10."), (F.col("doc_id") % 4).cast("string"), F.lit(".0."), (F.col("doc_id") % 250).cast("string"))
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("k"), ip.alias("source_ip"))
    nets = spark.createDataFrame([("10.0.0.0/15", "half"), ("10.0.0.0/16", "narrow"), ("10.2.0.0/16", "wide"), ("11.0.0.0/8", "far")], "cidr string, place string")
    return rollups.located(rows, nets).select("k", "place")


@query("SELECT count(*) AS total, count(*) FILTER (command_count > 0) AS with_commands, count(*) FILTER (cluster_id = 'outlier') AS outliers, count(*) FILTER (login_success_count > 0 AND command_count > 0) AS intrusions FROM dom", (EV, SES, DOM))
def dashboard_metrics(spark, d):
    return dashboard.metrics(dom(spark, d))


@query(f"SELECT {sql_stamp("date_trunc('day', start_ts)")} AS at, count(*) AS n FROM ses GROUP BY 1", (EV, SES))
def sessions_over_time(spark, d):
    return dashboard.over_time(dom(spark, d)).withColumn("at", stamp("at"))


@query("SELECT coalesce(intent, 'unknown') AS intent, count(*) AS n, round(count(*) / (SELECT count(*) FROM dom), 6) AS share FROM dom GROUP BY 1", (EV, SES, DOM))
def intent_shares(spark, d):
    return dashboard.shares(dom(spark, d), "intent")


@query("SELECT session_id FROM dom ORDER BY CASE WHEN cluster_id <> 'outlier' THEN command_entropy END DESC NULLS LAST, session_id LIMIT 15", (EV, SES, DOM))
def most_novel_sessions(spark, d):
    s = dom(spark, d).withColumn("mean_novelty_score", F.when(F.col("cluster_id") != "outlier", F.col("command_entropy")))
    return dashboard.most_novel(s).select("session_id")


@query("SELECT cluster_id, n, CAST(row_number() OVER (ORDER BY CASE cluster_id WHEN 'outlier' THEN 2 WHEN 'none' THEN 1 ELSE 0 END, length(cluster_id), cluster_id) AS INTEGER) AS place FROM (SELECT coalesce(nullif(cluster_id, '3'), 'none') AS cluster_id, count(*) AS n FROM dom GROUP BY 1)", (EV, SES, DOM))
def timeline_clusters(spark, d):
    return dashboard.cluster_list(dom(spark, d).withColumn("cluster_id", F.nullif("cluster_id", F.lit("3"))))


@query(f"SELECT t.command_line, strftime(day, '%Y-%m-%d') AS day, count(e.event_id) AS n FROM (SELECT command_line FROM ev GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) t, (SELECT CAST(unnest(generate_series(DATE '{AS_OF[:10]}' - INTERVAL 13 DAY, DATE '{AS_OF[:10]}', INTERVAL 1 DAY)) AS DATE) AS day) LEFT JOIN ev e ON e.command_line = t.command_line AND CAST(e.ts AS DATE) = day GROUP BY ALL", (EV,))
def daily_of_largest(spark, d):
    return dashboard.daily_of_largest(A.events(spark, d), "command_line", AS_OF, 5).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT cluster_id, country, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, country) AS rank FROM (SELECT cluster_id, country, count(*) AS n FROM dom WHERE cluster_id <> 'outlier' GROUP BY ALL)) WHERE rank <= 2", (EV, SES, DOM))
def cluster_countries(spark, d):
    return dashboard.cluster_places(dom(spark, d), "country", 2)


@query("SELECT 'url' AS kind, count(DISTINCT url) AS n FROM pages UNION ALL SELECT 'id', count(DISTINCT page_id) FROM pages")
def discovered_artifacts(spark, d):
    p = table(spark, d, "pages")
    both = p.select(F.lit("url").alias("kind"), F.col("url").alias("value")).where("value IS NOT NULL").unionByName(p.select(F.lit("id").alias("kind"), F.col("page_id").cast("string").alias("value")))
    return dashboard.discovered(both)


@query("SELECT id, cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY id) AS place FROM vec WHERE cluster_id IN ('1', '2')) WHERE place <= 20", (VEC,))
def cluster_pair_members(spark, d):
    v = A.vectors(spark, d)
    runs = v.withColumns({"run_id": F.lit("b"), "ts": F.lit(2)}).unionByName(v.withColumns({"run_id": F.lit("a"), "ts": F.lit(1)}))
    return dashboard.pair_members(runs, "1", "2", 20).select("id", "cluster_id")


@query("SELECT provider, CASE WHEN n_rest THEN 0 ELSE greatest(b - spent, 0) END AS remaining FROM (SELECT event_type AS provider, CAST(900 AS INTEGER) AS b, CAST(count(*) AS INTEGER) AS spent, event_type = 'error' AS n_rest FROM ev GROUP BY 1)", (EV,))
def provider_budgets(spark, d):
    state = A.events(spark, d).groupBy(F.col("event_type").alias("provider")).agg(F.count("*").cast("int").alias("spent"))
    state = state.withColumns({"day": F.to_date(now()), "failures": F.lit(0), "open_until": F.when(F.col("provider") == "error", now() + F.expr("INTERVAL 1 HOUR"))})
    return worker.left_of(state.select("provider", F.lit(900).alias("budget")), state, now())


@query("SELECT 'ip' AS kind, CAST(doc_id AS VARCHAR) AS value FROM labels WHERE doc_id % 3 <> 0")
def artifacts_due(spark, d):
    rows = table(spark, d, "labels").select(F.lit("ip").alias("kind"), F.col("doc_id").cast("string").alias("value"), "doc_id")
    hours = F.when(F.col("doc_id") % 3 == 0, 1).otherwise(-1)
    blocks = rows.where("doc_id % 3 < 2").select("kind", "value", F.lit("p").alias("provider"), (now() + F.make_dt_interval(hours=hours)).alias("ttl_expires_at"))
    return worker.due(rows.select("kind", "value"), blocks, "p", now())


@query("SELECT 'ip' AS kind, CAST(doc_id AS VARCHAR) AS value, CASE WHEN quality = 1 THEN toxic = 1 END AS malicious FROM labels WHERE toxic IS NOT NULL AND quality IS NOT NULL")
def intel_summary(spark, d):
    rows = table(spark, d, "labels").where("toxic IS NOT NULL AND quality IS NOT NULL")
    verdicts = rows.select(F.lit("ip").alias("kind"), F.col("doc_id").cast("string").alias("value"), (F.col("toxic") == 1).alias("malicious"), F.lit(5).alias("confidence"), F.lit(1).alias("n_malicious"), (F.col("quality") == 0).alias("derived"))
    return worker.summary(verdicts).select("kind", "value", "malicious")


@query("SELECT user_id, CASE WHEN best >= 50 THEN true END AS malicious, CASE WHEN best >= 50 THEN 'threatfox_c2 server' ELSE 'threatfox_low' END AS label, CASE WHEN best >= 50 THEN CAST(least(greatest(5 + round_even((best - 50) / 10.0, 0), 5), 10) AS INTEGER) END AS confidence, CASE WHEN best >= 50 THEN 'threatfox_match,threatfox_type_c2_server,m' || best ELSE 'threatfox_low_confidence,m' || best END AS tags FROM (SELECT user_id, max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS best FROM events WHERE event_id % 9 < 2 GROUP BY 1)")
def threat_verdicts(spark, d):
    """The best of each address's entries speaks."""
    from ..functions import verdicts as R

    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, d, "events").where("event_id % 9 < 2").groupBy("user_id").agg(F.max(k).alias("best"))
    entry = lambda level: F.struct(level.cast("int").alias("confidence_level"), F.lit(" C2 Server ").alias("threat_type"), F.concat(F.lit("M"), level.cast("string")).alias("malware"), F.lit("NULL").alias("malware_alias"))
    v = rows.select("user_id", R.threat_entries(F.array(entry(F.col("best") - 1), entry(F.col("best")))).alias("v"))
    return v.select("user_id", "v.malicious", "v.label", "v.confidence", F.array_join("v.tags", ",").alias("tags"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN true END AS malicious, CASE WHEN page_id % 3 = 0 THEN CASE WHEN page_id % 2 = 0 THEN 'urlhaus_malware_download' ELSE 'urlhaus_unknown' END END AS label, CASE WHEN page_id % 3 <> 0 THEN '' WHEN page_id % 2 = 0 THEN 'urlhaus_match,urlhaus_threat_malware_download,elf' ELSE 'urlhaus_match,elf' END AS tags, rtrim(url, '/') || CASE WHEN url LIKE '%/' THEN '' ELSE '/' END AS other FROM pages")
def url_list_verdicts(spark, d):
    from ..functions import verdicts as R

    n = F.col("page_id")
    tags = F.array(F.lit(" ELF"), F.lit("None"), F.lit(""), F.lit(None))
    v = R.listed_url(n % 3 == 0, F.when(n % 2 == 0, "Malware_Download").otherwise("null"), tags)
    rows = table(spark, d, "pages").select("page_id", v.alias("v"), R.url_variants(F.col("url"))[1].alias("other"))
    return rows.select("page_id", "v.malicious", "v.label", F.array_join("v.tags", ",").alias("tags"), "other")


@query("SELECT command_line, CASE WHEN n < 3 THEN 'execution' END AS intent, CAST(least(n + 1, 3) AS INTEGER) AS tries FROM (SELECT command_line, length(command_line) % 4 AS n FROM (SELECT DISTINCT command_line FROM ev))", (EV,))
def model_retries(spark, d):
    """A model whose first replies are no JSON, as many as the command's length says."""
    c = commands.dedup(A.events(spark, d)).select("command_hash", "command_line")

    def ask(rows):
        rounds = F.length(F.coalesce("feedback", F.lit("")))
        good = F.lit('{"intent": "execution", "confidence": 7}')
        return rows.select("command_hash", F.when(rounds >= F.length("command_line") % 4, good).otherwise(F.concat(F.coalesce("feedback", F.lit("")), F.lit("x"))).alias("reply"))

    out = naming.asked_again(c, ask, F.array().cast("array<string>"))
    return out.join(c, "command_hash").select("command_line", F.col("enrichment.intent").alias("intent"), "tries")
