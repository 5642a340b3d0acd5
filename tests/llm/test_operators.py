"""Operators against plain versions of themselves, and their results for nulls, ties and empty tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import _common, graph, identifiers, imatch, queries, severity, shingle_join, substrings, url_rules, vector_passes

WORDS = [f"{a}{b}" for a in "ka lo mi nu pe ro sta tri vul wex".split() for b in "dan fel gor hin jup kes lam mot".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """Documents with columns whose names operators might use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], "doc_id long, text string, doc string, tie int, start double")


# --- substrings


def test_cuts_cover_and_resist_shifts():
    rng = random.Random(1)
    data = prose(rng, 900).encode()
    ends = substrings.cut_points(data)
    assert ends[-1] == len(data) and all(a < b for a, b in zip(ends, ends[1:])) and max(np.diff([0, *ends])) <= substrings.MAX_CHUNK + 3
    chunks = lambda d: {d[a:b] for a, b in zip([0, *substrings.cut_points(d)], substrings.cut_points(d))}
    moved = data[:1500] + b"an insertion" + data[1500:]
    assert len(chunks(data) & chunks(moved)) >= 0.9 * len(chunks(data))
    assert substrings.cut_points(b"") == [] and substrings.cut_points(b"short") == [5]
    umlauts = ("ä中" * 400).encode()
    assert all((umlauts[e : e + 1] or b"a")[0] & 0xC0 != 0x80 for e in substrings.cut_points(umlauts))


def test_cuts_are_those_of_a_byte_by_byte_loop():
    rng = random.Random(8)
    for data in (prose(rng, 300).encode(), ("ä中x " * 300).encode(), b"word " * 200, bytes(500), rng.randbytes(900).hex().encode()):
        h, hashes = 0, []
        for b in data:
            h = ((h << 1) + int(substrings._GEAR[b])) & 0xFFFF
            hashes.append(h)
        inside = lambda end: end < len(data) and data[end] & 0xC0 == 0x80
        want, last = [], 0
        while last < len(data):
            near = [e for e in range(last + substrings.MIN_CHUNK, min(len(data) - 1, last + substrings.MAX_CHUNK) + 1) if not inside(e)]
            end = next((e for e in near if hashes[e - 1] < 1 << (16 - substrings.MEAN_BITS)), None)
            if end is None:
                end = min(near, key=lambda e: (hashes[e - 1], e)) if len(data) - last > substrings.MAX_CHUNK else len(data)
            want.append(end)
            last = end
        assert substrings.cut_points(data) == want


def test_removal_is_that_of_plain_comparison(spark):
    """Marks from Spark are those of a dictionary of chunks; passages of 51 words are caught."""
    rng = random.Random(9)
    passages = [prose(rng, 51) for _ in range(20)]
    rows = [(k, f"{prose(rng, 30)} {passages[k % 20]} {prose(rng, 30)}") for k in range(60)] + [(None, prose(rng, 40)), (7, passages[3]), (70, "wort " * 60), (71, prose(rng, 3) + " wort" * 60)]
    rows += [(80, "文字の並び、" * 3 + "".join(chr(0x4E00 + (i * 37) % 900) for i in range(120))), (81, "前" + "".join(chr(0x4E00 + (i * 37) % 900) for i in range(120)) + "後 end")]
    got = {(r["doc_id"], r["tie_"]): r for r in substrings.dedup(frame(spark, rows).withColumn("tie_", F.xxhash64("text"))).collect()}
    keyed = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["tie_"]), r) for r in frame(spark, rows).withColumn("tie_", F.xxhash64("text")).collect())
    first, caught = {}, 0
    for _, r in keyed:
        data, start, marks = r["text"].encode(), 0, []
        for end in substrings.cut_points(data):
            if data[start:end] in first:
                marks.append((start << 10 | end - start, first[data[start:end]]))
            start = end
        start = 0
        for end in substrings.cut_points(data):
            first.setdefault(data[start:end], r["doc_id"] or 0)
            start = end
        text, spans = substrings.cut_out(data, marks)
        found = got[r["doc_id"], r["tie_"]]
        # a repeat within the text itself is none
        if not any(s[2] == r["doc_id"] for s in spans):
            assert found["text"] == text.decode() and [(s["start"], s["end"]) for s in found["removed_spans"]] == [s[:2] for s in spans]
        caught += bool(found["removed_spans"])
    assert caught >= 42 and got[81, [r["tie_"] for _, r in keyed if r["doc_id"] == 81][0]]["removed_spans"]


def test_dedup(spark):
    rng = random.Random(2)
    passage, own = prose(rng, 90), [prose(rng, 60) for _ in range(6)]
    rows = [(1, own[0]), (2, f"{own[1]} {passage} {own[2]}"), (3, f"{own[3]} {passage}"), (4, f"{passage} {own[4]}"), (5, own[0]), (5, own[0]), (6, None), (7, ""), (None, passage), (8, own[5]), (9, own[5][:20])]
    got = substrings.dedup(frame(spark, rows)).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "doc", "tie", "start", "removed_spans"}
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[None][0]["text"] == passage and by[1][0]["text"] == own[0] and by[8][0]["text"] == own[5] and by[9][0]["text"] == own[5][:20]
    for k in (2, 3, 4):  # the null id counts as earliest, so all three lose the passage
        text, spans = by[k][0]["text"], by[k][0]["removed_spans"]
        assert len(spans) == 1 and len(text) < len(dict(rows)[k]) - 0.6 * len(passage) and spans[0]["first_doc"] < k
    assert own[1].split()[:50] == by[2][0]["text"].split()[:50] and by[2][0]["text"].endswith(own[2])
    assert [len(r["text"].split()) < 20 for r in by[5]] == [True, True] and by[6][0]["text"] is None and by[7][0]["text"] == ""
    assert substrings.dedup(frame(spark, [])).count() == 0


def test_dedup_over_blocks_is_as_in_one(spark, monkeypatch):
    rng = random.Random(3)
    shared = [prose(rng, 60) for _ in range(5)]
    rows = [(k, prose(rng, 40) + " " + shared[rng.randrange(5)]) for k in range(60)]
    plain = {r["doc_id"]: r["text"] for r in substrings.dedup(frame(spark, rows)).collect()}
    spread = {r["doc_id"]: r["text"] for r in substrings.dedup(frame(spark, rows).repartition(13)).collect()}
    firsts = {}
    for k, t in rows:
        firsts.setdefault(next(i for i, s in enumerate(shared) if t.endswith(s)), k)
    assert plain == spread and all((plain[k] == t) == (k in firsts.values()) for k, t in rows)


# --- severity


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(2000):
        x = rng.integers(0, 2, 4)
        s = x @ np.array([2.0, 1.0, 0.0, -1.0]) + rng.logistic()
        rows.append(np.flatnonzero(x).tolist())
        grades.append(int(s > 0.5) + int(s > 2.0))
    w, cuts = severity.fit_ordinal(rows, np.array(grades), 4)
    assert np.allclose(w, [2, 1, 0, -1], atol=0.35) and np.allclose(cuts, [0.5, 2.0], atol=0.35)
    assert severity.fit_ordinal([], np.zeros(0, int), 3)[1].size == 0


def test_severity_held_out(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for k in range(600):
        bad = k % 6 == 0
        docs.append((k, prose(rng, 50) + (" Vile!! rotten" if bad else "") + " " + prose(rng, 10)))
        if k < 400:
            labels.append((k, 1, int(bad)))
    docs += [(1000, None), (1001, "")]
    labels += [(None, 1, 1), (3, None, None), (3, 1, 0)]
    graded = severity.grades_of(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    model = severity.fit(frame(spark, docs), graded)
    got = {r["doc_id"]: r for r in severity.score(frame(spark, docs), model).collect()}
    held = [(got[k]["toxic"], k % 6 == 0) for k in range(400, 600)]
    assert all(a == b for a, b in held) and not got[1000]["toxic"] and not got[1001]["toxic"]
    assert got[6]["expected_severity"] > got[7]["expected_severity"] and set(got[6].asDict()) == {"doc_id", "text", "doc", "tie", "start", "expected_severity", "severity", "toxic"}
    none = severity.fit(frame(spark, docs), graded.limit(0))
    assert none is None and not severity.score(frame(spark, docs[:3]), none).where("toxic or expected_severity > 0").count()
    assert severity.score(frame(spark, []), model).count() == 0


# --- identifiers

FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(FIXED.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": name == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(digits) <= 19 and identifiers.luhn(digits), "phone": 10 <= len(digits) <= 15}[name]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_are_the_patterns():
    rng = random.Random(5)
    assert identifiers.luhn("4111111111111111") and not identifiers.luhn("4111111111111112")
    fixed = ["a@b.com_x@c.org", "1.2.3.4.5.6.7.8", "@a.b x@@y.z", "a@b a@b.c.", "4111 1111 1111 1111", "+1 (555) 123-4567.", "999.1.1.1 1.1.1.255", "0000000001.2.3.4", "x" * 9000 + "@a.b", "é7@x-.-"]
    for text in fixed + ["".join(rng.choice("ab1204.@+-() _%é") for _ in range(rng.randint(0, 60))) for _ in range(4000)]:
        assert identifiers.base_spans(text) == plain_spans(text), text


def test_bootstrap_finds_what_the_patterns_miss(spark):
    rng = random.Random(6)
    rows = [(k, f"{prose(rng, 10)} please call number {'+' if k % 10 else ''}{rng.randint(10**10, 10**11 - 1)} today or later {prose(rng, 10)}") for k in range(120)]
    rows += [(500 + k, f"{prose(rng, 8)} order {rng.randint(10**10, 10**11 - 1)} was shipped {prose(rng, 4)}") for k in range(20)] + [(900, None), (901, ""), (None, "x a@b.cd y"), (902, "a@b.cd"), (902, "a@b.cd")]
    rows = [(k, t.replace("+", "+", 1) if t else t) for k, t in rows]
    found = {(r["doc"], r["tie"]): r for r in identifiers.found(frame(spark, rows), min_seeds=5).collect()}
    by = {}
    for (doc, _), r in found.items():
        by[doc] = r
    assert all(len(by[500 + k]["spans"]) == 0 for k in range(20)) and by[900]["spans"] == [] and by[901]["spans"] == [] and len(by[902]["spans"]) == 1
    for k in range(120):
        base = {tuple(s) for s in by[k]["base"]}
        spans = {tuple(s) for s in by[k]["spans"]}
        assert base == set(plain_spans(rows[k][1])) and base <= spans
        number = re.search(r"number (\+?[0-9]+) today", rows[k][1])
        assert spans == {(number.start(1), 3, number.end(1))}  # with or without +, and nothing else
    masked = {r["doc_id"]: r["text"] for r in identifiers.mask(frame(spark, rows)).collect()}
    assert masked[None] == "x <email> y" and masked[900] is None and "<phone>" in masked[1] and identifiers.mask(frame(spark, rows)).count() == len(rows)
    assert identifiers.found(frame(spark, [])).count() == 0 and identifiers.mask(frame(spark, [])).count() == 0


def test_bootstrap_adds_by_context(spark):
    """Shapes agree between seeds and what a pattern of the same place meets."""
    seeds = [(k, -1 if k >= 40 else 3, [1, 2, 3]) for k in range(43)] + [(100 + k, -1, [7, 8]) for k in range(5)] + [(200 + k, 3, [9]) for k in range(9)] + [(300, -1, [9])]
    seen = spark.createDataFrame(seeds, "instance long, kind int, patterns array<long>")
    assert sorted((r["instance"], r["kind"]) for r in identifiers.confident(seen).collect()) == [(40, 3), (41, 3), (42, 3)]


def test_bootstrap_finds_new_written_forms(spark):
    rng = random.Random(11)
    number = lambda: f"({rng.randint(0, 999):03}) {rng.randint(100, 999)}-{rng.randint(0, 9999):04}"
    rows = [(k, f"{prose(rng, 10)} please call number {'+' if k % 10 else ''}{rng.randint(10**10, 10**11 - 1)} today or later {prose(rng, 10)}") for k in range(120)]
    rows += [(200 + k, f"{prose(rng, 10)} ring me on {'+1 ' if k % 10 else ''}{number()} in the evening {prose(rng, 10)}") for k in range(120)]
    rows += [(500 + k, f"{prose(rng, 8)} order {rng.randint(10**10, 10**11 - 1)} was shipped {prose(rng, 4)}") for k in range(20)]
    rows += [(600 + k, f"{prose(rng, 8)} please call number 20{k:02} today or later {prose(rng, 4)}") for k in range(3)]
    spans = {r["doc"]: {text[s["start"] : s["end"]] for s in r["spans"]} for r in identifiers.found(frame(spark, rows)).collect() for text in [dict(rows)[r["doc"]]]}
    for k, text in rows:
        want = re.search(r"(?:number|on) (.*?) (?:today|in the)", text)[1] if k < 500 else None
        assert spans[k] == ({want} if want else set()), text


def test_secrets(spark):
    """Strings given to a key word are seeds; what else stands in their context is found, other long strings are not."""
    rng = random.Random(21)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(k, f'{prose(rng, 9)} token = "{some("0123456789abcdef", 40)}" {prose(rng, 9)}') for k in range(60)]
    rows += [(100 + k, f'{prose(rng, 9)} token = "{some("0123456789", 2)}-{some("0123456789abcdef", 37)}:{some("0123456789ab", 80)}" {prose(rng, 9)}') for k in range(5)]
    rows += [(200 + k, f"{prose(rng, 9)} build {some('0123456789abcdef', 40)} {prose(rng, 9)}") for k in range(30)]
    rows += [(300, f"token = {some('abc', 30)}"), (301, "the token: short1"), (302, f"api_key='{some('0123456789ABCdef', 24)}' x@y.zz")]
    found = {r["doc"]: r for r in identifiers.found(frame(spark, rows)).collect()}
    for k, text in rows:
        spans = {(text[s["start"] : s["end"]], s["kind"]) for s in found[k]["spans"]}
        if k < 60:
            assert spans == {(text.split('"')[1], identifiers.SECRET)}, text
        elif 200 <= k < 302:
            assert spans == set(), text
    assert {s["kind"] for s in found[302]["spans"]} == {0, identifiers.SECRET} and [s["kind"] for s in found[302]["base"]] == [0]
    assert all("<secret>" in r["text"] for r in identifiers.mask(frame(spark, rows[:60])).collect())


def test_confident_is_what_a_plain_walk_of_the_graph_gives(spark):
    rng = random.Random(22)
    seen = [(k, rng.choice([3, -1]), rng.sample(range(12), rng.randint(1, 4))) for k in range(150)]
    edges = {(i, kind, p) for i, kind, ps in seen for p in ps}
    n_all = {p: sum(e[2] == p for e in edges) for p in range(12)}
    good = {}
    for _ in range(3):
        weight = {p: (sum(1 for i, kind, q in edges if q == p and kind == 3), sum(1 for i, kind, q in edges if q == p and kind == 3)) for p in range(12)}
        for p in range(12):
            gained = [good[i] for i, kind, q in edges if q == p and kind < 0 and i in good]
            weight[p] = weight[p][0] + len(gained), weight[p][1] + sum(gained)
        beliefs = {}
        for i, kind, ps in seen:
            met = [p for p in set(ps) if weight[p][0] >= 5 and n_all[p] >= 5]
            doubt = np.prod([1 - min(weight[p][1] / (n_all[p] + 1), 0.999) for p in met])
            if kind < 0 and 1 - doubt >= 0.9 and (len(met) >= 2 or max(weight[p][0] for p in met) >= 20):
                beliefs[i] = 1 - doubt
        good = beliefs
    got = {r["instance"] for r in identifiers.confident(spark.createDataFrame(seen, "instance long, kind int, patterns array<long>")).collect()}
    assert got == set(good) and 0 < len(got) < sum(kind < 0 for _, kind, _ in seen)


def test_context_words_of_any_length():
    long = "w" * 500
    assert identifiers._nearest(f"a {long} {long} 12345", 1004, -1) == [long, long]
    assert identifiers._nearest(f"12345 {long} b c", 5, 1) == [long, "b"] and identifiers._nearest("12345", 0, -1) == []


def test_accepted_strings_induce_patterns(spark):
    seeds = [(k, 3, [1, 2, 3]) for k in range(60)] + [(100 + k, -1, [1, 2, 3, 4, 5, 6]) for k in range(6)] + [(200, -1, [4, 5, 6])]
    seen = spark.createDataFrame(seeds, "instance long, kind int, patterns array<long>")
    assert {r["instance"] for r in identifiers.confident(seen, rounds=1).collect()} == set(range(100, 106))
    assert {r["instance"] for r in identifiers.confident(seen).collect()} == {*range(100, 106), 200}


# --- I-Match


def test_imatch(spark):
    rng = random.Random(7)
    rows = [(k, prose(rng, 40)) for k in range(40)] + [(50, rows_text := prose(rng, 40)), (51, rows_text), (52, None), (53, ""), (None, "lone"), (54, "é" * 7)]
    docs = frame(spark, rows)
    known = imatch.lexicon(docs, low=0.05, high=0.9)
    share = {}
    for _, t in rows:
        for w in set((t or "").split()):
            share[w] = share.get(w, 0) + 1
    assert len(known) == sum(max(2, 0.05 * len(rows)) <= n <= 0.9 * len(rows) for n in share.values())
    got = {r["doc_id"]: r for r in imatch.edit_likeness(docs, known).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (k, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert got[k]["n_chars"] == len(t) and got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and 0 <= got[k]["near_next"] <= 1
        if edited == t:
            assert got[k]["near_edited"] == 1.0 and got[k]["fingerprint"] == got[k]["edited_fingerprint"]
    assert got[50]["fingerprint"] == got[51]["fingerprint"] and got[51]["near_next"] == 1.0 and got[52]["fingerprint"] == got[53]["fingerprint"]
    prints = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(docs, known).collect()}
    assert all(prints[k] == got[k]["fingerprint"] for k in prints)
    assert np.mean([got[k]["near_edited"] for k in range(40)]) > np.mean([got[k]["near_next"] for k in range(40)])
    assert imatch.edit_likeness(frame(spark, []), imatch.lexicon(frame(spark, []))).count() == 0
    alone = imatch.edit_likeness(frame(spark, [(1, "abcd")]), known).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_fingerprints_are_those_of_a_plain_loop(spark):
    """Each random subset of the band's terms, taken term by term, hashed in sorted order."""
    import xxhash

    rng = random.Random(17)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 60))) + rng.choice(["", " Solo!", " x9-y"])) for k in range(60)] + [(70, ""), (71, "unheard of"), (72, prose(rng, 30_000))]
    docs = frame(spark, rows)
    known = imatch.lexicon(docs, low=0.05, high=0.9)
    words = lambda t: {w.lower() for w in re.split(r"[^0-9A-Za-z\x80-\U0010ffff]+", t) if w}
    seen = {}
    for _, t in rows:
        for w in words(t):
            seen[w] = seen.get(w, 0) + 1
    band = {xxhash.xxh3_64_intdigest(w.encode()) for w, n in seen.items() if max(2, 0.05 * len(rows)) <= n <= 0.9 * len(rows)}
    assert sorted(band) == known.tolist()

    def plain(text):
        own = sorted(xxhash.xxh3_64_intdigest(w.encode()) for w in words(text))
        kept, out = [h for h in own if h in band], [0] * (imatch.LEXICONS + 1)
        pack = lambda hs: b"".join(h.to_bytes(8, "little") for h in hs)
        if not kept:
            out[-1] = xxhash.xxh32_intdigest(pack(own)) if own else 0
            return out
        for k, salt in enumerate(imatch._salts().tolist()):
            def place(h, salt=salt):
                m = (h ^ salt) * 0x9E3779B97F4A7C15 % 2**64
                return (m ^ m >> 29) * 0xBF58476D1CE4E5B9 % 2**64 >> 40
            part = [h for h in kept if place(h) < int(imatch.SHARES[k % len(imatch.SHARES)] * 2**24)]
            out[k] = xxhash.xxh32_intdigest(pack(part)) if part else 0
        return out

    want = {k: np.array(plain(t), "u4") for k, t in rows}
    got = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(docs, known).collect()}
    assert got == {k: v.tobytes().hex() for k, v in want.items()}
    for a, b in ((0, 1), (70, 71), (3, 3), (72, 5)):
        used = [(x, y) for x, y in zip(want[a].tolist(), want[b].tolist()) if x or y]
        assert imatch.likeness(want[a], want[b]) == (sum(x == y for x, y in used) / len(used) if used else 1.0)


# --- vectors


def brute_vectors(rows, least):
    forest, links = graph.Forest(), [0] * len(rows)
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, "f8") / np.linalg.norm(v) if ok else None)
    for i in range(len(rows)):
        forest.root(i)
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                forest.join(i, j)
    roots = [forest.root(i) for i in range(len(rows))]
    first = {}
    for (k, _), r in zip(rows, roots):
        first[r] = min(first.get(r, k), k)
    return sorted((k, n, first[r]) for (k, _), n, r in zip(rows, links, roots))


def test_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(300)]
    rows += [(1000 + k, (np.array(rows[k % 5][1]) + rng.normal(size=16) * 0.05).tolist()) for k in range(40)]
    rows += [(2000 + k, rows[7][1]) for k in range(50)] + [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [None] + [1.0] * 15), (3005, [float("inf")] + [1.0] * 15), (3006, [1.0, 2.0]), (3007, [2.0, 4.0])]
    table = spark.createDataFrame([(k, v, "c") for k, v in rows], "vec_id long, embedding array<double>, cls string")
    got = vector_passes.near_vectors(table).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute_vectors(rows, 0.95)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert vector_passes.near_vectors(table.limit(0)).count() == 0


def dense_links(rows, least):
    """n_links of usable vectors of one length, all pairs compared."""
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    return {k: int(n) for (k, _), n in zip(rows, (unit @ unit.T >= least).sum(1) - 1)}


@pytest.mark.parametrize("noise", [0.001, 0.018, 0.026])
def test_vectors_of_a_large_group(spark, monkeypatch, noise):
    monkeypatch.setattr(vector_passes, "TILE", 700)
    rng = np.random.default_rng(10)
    middle = rng.normal(size=64)
    middle /= np.linalg.norm(middle)
    rows = [(k, (middle + rng.normal(size=64) * noise).tolist()) for k in range(3000)] + [(4000 + k, rng.normal(size=64).tolist()) for k in range(200)]
    rows += [(5000 + k, rows[k][1]) for k in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in vector_passes.near_vectors(table).collect()}
    want = dense_links(rows, 0.95)
    assert sum(want.values()) > 1_000_000 and got == want


# --- shingles


def brute_shingles(rows):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    forest = graph.Forest()
    for i in range(len(rows)):
        forest.root(i)
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                forest.join(i, j)
    first = {}
    for i, (k, _) in enumerate(rows):
        r = forest.root(i)
        first[r] = min(first.get(r, k), k)
    return sorted((k, len(s), first[forest.root(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def test_shingle_join(spark):
    rng = random.Random(9)
    rows = []
    for group in range(12):
        base = prose(rng, 700 if group == 0 else rng.choice([3, 4, 5, 9, 40, 120, 600])).split()
        for _ in range(rng.choice([1, 3, 8])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            if rng.random() < 0.3:
                copy = copy[: max(1, len(copy) - rng.randint(0, len(copy) // 8))]
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    shared = prose(rng, 30)
    rows += [(len(rows) + k, f"{prose(rng, 20)} {shared}") for k in range(15)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (904, "ONE two"), (905, "Ünï cödé ẞ wörds hére nów"), (906, "ünï cödé ẞ wörds hére nów")]
    found = shingle_join.similar(frame(spark, rows).repartition(5))
    got = shingle_join.public_ids(found).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_shingles(rows)
    kept = sorted(r["doc_id"] for r in shingle_join.one_of_each(frame(spark, rows)).collect())
    assert kept == sorted({c for _, _, c in brute_shingles(rows)})
    nulls = shingle_join.public_ids(shingle_join.similar(frame(spark, [(None, "a b c"), (4, "a b c")]))).collect()
    assert {(r["doc_id"], r["component_id"]) for r in nulls} == {(None, None), (4, None)}
    assert shingle_join.similar(frame(spark, [])).count() == 0 and shingle_join.one_of_each(frame(spark, [])).count() == 0


def test_one_of_each_with_null_and_equal_ids(spark):
    rng = random.Random(12)
    texts = [prose(rng, 40) for _ in range(12)]
    rows = [(None, t) for t in texts[:6]] + [(7, t) for t in texts[6:]] + [(8, texts[0]), (9, texts[7]), (None, texts[1]), (None, ""), (None, None)]
    kept = [(r["doc_id"], r["text"]) for r in shingle_join.one_of_each(frame(spark, rows)).collect()]
    assert sorted(kept, key=str) == sorted([(None, t) for t in texts[:6]] + [(7, t) for t in texts[6:]] + [(None, ""), (None, None)], key=str)


def near_set(rng, a, n=1 << 60):
    return np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, n, rng.integers(0, 2 + len(a) // 12)).astype("u8")]))


def test_linked_sets_share_a_slice():
    rng = np.random.default_rng(11)
    found = 0
    for _ in range(3000):
        a = np.unique(rng.integers(0, 1 << 60, rng.integers(1, 300 if rng.random() < 0.3 else 30))).astype("u8")
        b = near_set(rng, a)
        if len(b) and shingle_join.linked(a, b) and a.tolist() != b.tolist():
            found += 1
            assert set(shingle_join.slices(a).tolist()) & set(shingle_join.slices(b).tolist())
    assert found > 500


def test_sets_that_no_way_of_dealing_suits(monkeypatch):
    """Even without a way of dealing they share the slice that is for them."""
    monkeypatch.setattr(shingle_join, "DEALS", 0)
    rng = np.random.default_rng(12)
    a = np.unique(rng.integers(0, 1 << 60, 50)).astype("u8")
    assert set(shingle_join.slices(a).tolist()) & set(shingle_join.slices(a[1:]).tolist())


def pairs_of(trees, left, right):
    out = []
    for x, y in trees.pairs(np.array(left), np.array(right)):
        out += list(zip(x.tolist(), y.tolist()))
    assert len(out) == len(set(out))
    return {(min(p), max(p)) for p in out}


def test_count_trees_drop_no_pair():
    rng = np.random.default_rng(10)
    sizes = rng.integers(5, 60, 700)
    points = np.stack([np.bincount(rng.integers(0, 16, n), minlength=16) for n in sizes]).astype("u1")
    segment, comp, rest = np.sort(rng.integers(0, 4, 700)), rng.integers(0, 30, 700), rng.integers(0, 3, 700)
    trees = shingle_join.CountTrees(segment, sizes, comp, points, rest)

    def wanted(i, j):
        bound = 9 * (np.minimum(points[i], points[j]).sum(dtype=int) + min(rest[i], rest[j])) >= 4 * (sizes[i] + sizes[j])
        return bound and comp[i] != comp[j] and 10 * min(sizes[i], sizes[j]) >= 8 * max(sizes[i], sizes[j])

    rows = [np.flatnonzero(segment == k).tolist() for k in range(4)]
    roots = trees.root(np.arange(4))
    assert pairs_of(trees, [roots[0]], [roots[0]]) == {(i, j) for i in rows[0] for j in rows[0] if i < j and wanted(i, j)}
    assert pairs_of(trees, [roots[1]], [roots[2]]) == {(min(i, j), max(i, j)) for i in rows[1] for j in rows[2] if wanted(i, j)}
    assert trees.visited > 0


def test_points_bound_the_overlap():
    """Also folded to fewer groups, and with counts beyond what a byte holds."""
    rng = np.random.default_rng(15)
    for n in (30, 700, 3000):
        a = np.unique(rng.integers(0, 1 << 40, n)).astype("u8")
        a = a if n < 3000 else a * np.uint64(4096)  # all in one group
        b = near_set(rng, a)
        raw, size = [shingle_join.point(x).tobytes() for x in (a, b)], np.array([len(a), len(b)])
        for groups in (16, min(map(len, raw))):
            counts, rest = shingle_join._points(raw, size, groups)
            assert np.minimum(*counts).sum(dtype=int) + rest.min() >= len(np.intersect1d(a, b))


def test_trees_over_the_documents():
    """The trees of all top nodes, over a whole table, let every link between different texts pass."""
    import pyarrow.parquet as pq

    texts = set(pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()) - {None}
    sets = {s.tobytes(): s for s in map(shingle_join.shingles, texts) if len(s)}.values()
    sets = list(sets)
    tops = {}
    for k, s in enumerate(sets):
        for sig in shingle_join.slices(s).tolist():
            tops.setdefault(sig, []).append(k)
    found, visited = set(), 0
    for members in tops.values():
        if len(members) > 1:
            raw, size = [shingle_join.point(sets[k]).tobytes() for k in members], np.array([len(sets[k]) for k in members])
            points, rest = shingle_join._points(raw, size, min(map(len, raw)))
            trees = shingle_join.CountTrees(np.zeros(len(members), int), size, np.array(members), points, rest)
            found |= {tuple(sorted((members[a], members[b]))) for a, b in pairs_of(trees, [0], [0])}
            visited += trees.visited
    links = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if shingle_join.linked(sets[i], sets[j])}
    assert links and links <= found and visited > 0 and len(found) <= 2 * len(links)


def test_many_that_share_a_passage(spark):
    """500 documents share half of their words; only those in pairs are linked."""
    rng = random.Random(14)
    shared, rows = prose(rng, 30), []
    for k in range(250):
        own = prose(rng, 30).split()
        rows += [(2 * k, " ".join([*own, shared])), (2 * k + 1, " ".join([own[0] + "x", *own[1:], shared]))]
    got = {r["doc_id"]: r["component_id"] for r in shingle_join.public_ids(shingle_join.similar(frame(spark, rows))).collect()}
    assert got == {k: k - k % 2 for k in range(500)}


def test_large_group_of_near_copies_over_tiles(spark, monkeypatch):
    """A star of copies that are linked by way of one text, more than a tile holds, beside pairs that only a tree brings together."""
    rng = random.Random(16)
    base, rows = prose(rng, 100).split(), []
    for k in range(60):
        copy = list(base)
        for at in rng.sample(range(100), 3):
            copy[at] = f"w{rng.random()}"
        rows.append((k, " ".join(copy)))
    rows.append((100, " ".join(base)))
    monkeypatch.setattr(shingle_join, "TILE", 16)
    got = shingle_join.public_ids(shingle_join.similar(frame(spark, rows))).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_shingles(rows)


def test_components(spark):
    rng = np.random.default_rng(12)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(6000, 6200)]
    forest = graph.Forest()
    for a, b in pairs:
        forest.join(a, b)
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long").repartition(7)).collect()}
    assert got == {x: forest.root(x) for x in got} and len(got) >= 300
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- URL rules

RULES = queries.URL_RULES


def test_hosts_and_rules(spark):
    urls = ["HTTP://Www.Example.COM/en/7x?q#f", "https://a.net/de/80", "https://x.example.net/de/8", "x://org/es/", "http://xorg/es/", None, "no scheme", "a://b?c://d/e", "http://É.org/es/1", "http://example.com/en", "http://example.com/en/1"]
    rows = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = [tuple(r)[2:6] for r in url_rules.judge(rows, spark.createDataFrame([], "page_id long, bad boolean"), RULES).orderBy("page_id").collect()]
    assert got == [
        ("www.example.com", "/en/7x", "example.com/en/7", "allow"), ("a.net", "/de/80", "net/de/", "allow"), ("x.example.net", "/de/8", "example.net/de/8", "block"), ("org", "/es/", "org/es/", "block"),
        ("xorg", "/es/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b", "", None, "allow"), ("É.org", "/es/1", "org/es/", "block"), ("example.com", "/en", None, "allow"), ("example.com", "/en/1", "com/en/", "block"),
    ]
    assert url_rules.judge(rows.limit(0), spark.createDataFrame([], "page_id long, bad boolean"), RULES).count() == 0


def test_mined_rules(spark):
    rng = random.Random(13)
    pages, labels = [], []
    for k in range(800):
        host, folder = rng.choice(["bad.test", "good.test", "other.test"]), rng.choice(["win", "news"])
        pages.append((k, f"http://{host}/{folder}/{k}.html"))
        labels.append((k, host == "bad.test" and folder == "win"))
    pages += [(9000, "http://bad.test/win/x"), (9001, "http://bad.test/news/x"), (9002, "http://good.test/win/x"), (9002, "http://good.test/win/x"), (None, "http://bad.test/win/y")]
    page_table = spark.createDataFrame(pages, "page_id long, url string")
    judged = url_rules.judge(page_table, spark.createDataFrame(labels + [(3, None)], "page_id long, bad boolean"), []).collect()
    assert len(judged) == len(pages)
    assert all((r["verdict"] == "block") == ("//bad.test/win/" in r["url"]) for r in judged)


def plain_rules(baskets, least, min_confidence, min_lift):
    """All sets of tokens, counted one by one: {items: (support, confidence)} of the rules that stay, and every token's count."""
    from itertools import combinations

    n, bad = len(baskets), sum(b for _, b in baskets)
    counts, hits, single = {}, {}, {}
    for items, is_bad in baskets:
        for t in items:
            single[t] = single.get(t, 0) + 1
        for size in range(1, len(items) + 1):
            for c in combinations(sorted(items), size):
                counts[c] = counts.get(c, 0) + 1
                hits[c] = hits.get(c, 0) + is_bad
    rules = {c: (h / n, h / counts[c]) for c, h in hits.items() if h >= least and h / counts[c] >= min_confidence and h / counts[c] / (bad / n) >= min_lift}
    return {c: r for c, r in rules.items() if not any(set(o) < set(c) and p[1] >= r[1] for o, p in rules.items())}, single


def test_mined_rules_are_those_of_counting(spark):
    rng = random.Random(31)
    pages = []
    for k in range(500):
        host, folders = rng.choice(["free-win.test", "a.test", "b.c.test"]), rng.sample(["x", "y", "z", "w", "v"], rng.randint(1, 4))
        bad = host == "free-win.test" and rng.random() < 0.9 or {"x", "y"} <= set(folders) and rng.random() < 0.8 or {"x", "z", "w", "v"} <= set(folders) and host == "a.test"
        pages.append((k, f"http://{host}/{'/'.join(folders)}/p?q={k % 3}", bool(bad)))
    table = spark.createDataFrame(pages, "page_id long, url string, bad boolean")
    rows = url_rules.parsed(table.drop("bad"))
    items = rows.select("page_id", url_rules.tokens(F.col("host"), F.col("path"), F.col("url")).alias("items")).join(table.select("page_id", "bad"), "page_id")
    baskets = [(frozenset(r["items"]), r["bad"]) for r in items.collect()]
    want, single = plain_rules(baskets, 20, 0.6, 1.5)
    got = {tuple(r["items"]): (r["support"], r["confidence"], r["token"]) for r in url_rules.mine(items.select("items", "bad")).collect()}
    assert got.keys() == want.keys() and len(want) >= 3 and max(map(len, want)) >= 2
    assert all(got[c][:2] == pytest.approx(want[c]) and got[c][2] == min(c, key=lambda t: (single[t], t)) for c in want)
    judged = {r["page_id"]: r["verdict"] for r in url_rules.judge(table.drop("bad"), table.select("page_id", "bad"), []).collect()}
    own = {r["page_id"]: set(r["items"]) for r in items.collect()}
    assert judged == {k: "block" if any(set(c) <= own[k] for c in want) else "allow" for k, _, _ in pages} and len(set(judged.values())) == 2


def test_content_labels(spark):
    rows = [(1, "<p>Casino night"), (2, "<p>casinos"), (3, None), (4, ""), (None, "ads")]
    got = url_rules.content_labels(spark.createDataFrame(rows, "page_id long, html string")).collect()
    assert sorted(map(str, ((r["page_id"], r["bad"]) for r in got))) == sorted(map(str, [(1, True), (2, False), (4, False), (None, True)]))


def test_native_plan(spark):
    import io
    from contextlib import redirect_stdout

    out = io.StringIO()
    rows = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    with redirect_stdout(out):
        url_rules.judge(rows, spark.createDataFrame([(1, True)], "page_id long, bad boolean"), RULES).explain()
    assert not re.search("Python|Arrow|Pandas", out.getvalue())


# --- pipeline


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, a clashing column; and empty tables."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(15)
    kinds = "doc_id long, text string, lang string, source string, n_chars long, label string, start long, key int"
    rows = [(k, prose(rng, 40), "en", "s", 9, "x", 1, 2) for k in range(20)]
    rows += [(None, None, None, None, None, None, None, None), (None, prose(rng, 30), None, "s", 1, "x", 1, 2), (None, prose(rng, 30), "en", None, None, "x", 1, 2), (30, "", "en", "s", 0, "x", 1, 2), (31, None, "en", "s", 0, "x", 1, 2)]
    rows += [(32, prose(rng, 60_000), "en", "s", 5, "x", 1, 2), (33, "y" * 300_000, "en", "s", 5, "x", 1, 2), rows[3], rows[3], (34, "a 1.2.3.4 b", "en", "s", 5, "x", 1, 2)]
    spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(20)] + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, some in (("full", rows), ("none", [])):
        now = spark.createDataFrame(some, kinds)
        for k, (stage_name, stage) in enumerate(pipeline.STAGES):
            stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}{k}")
            now = spark.read.parquet(f"{tmp_path}/{name}{k}")
            if k < 4:
                assert now.columns == pipeline.COLUMNS, stage_name
                kept = sorted((str(r["doc_id"]), (r["text"] or "")[:20]) for r in now.collect())
                want = sorted((str(r[0]), (r[1] or "")[:20]) for r in (some if k == 0 else set(some)))
                want = [(d, t.replace("a 1.2.3.4 b", "a <ip> b")) for d, t in want] if k == 3 else want
                assert kept == want, stage_name
        ids = {d["doc_id"] for r in now.collect() for d in r["documents"]}
        assert ids == {r[0] for r in some}


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(14)
    passage, same = prose(rng, 80), prose(rng, 70)
    texts = {k: prose(rng, 60) for k in range(300)}
    for k in range(0, 300, 6):
        texts[k] += " vile rotten"
    texts[1], texts[2], texts[3], texts[5] = same, same + " more", f"{texts[3]} {passage}", f"{texts[5]} {passage}"
    texts[7] += " mail a.b@c.de now"
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 6 == 0)) for k in texts], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now, sf = docs, str(tmp_path)
    for k, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, now, sf).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert now.columns == pipeline.COLUMNS, name
    left = {r["doc_id"]: r for r in now.collect()}
    assert set(left) == {k for k in texts if k % 6 and k != 2}
    assert passage in left[3]["text"] and passage not in left[5]["text"] and left[5]["text"].startswith(texts[5][:200])
    assert "a.b@c.de" not in left[7]["text"] and "<email>" in left[7]["text"] and all(r["n_chars"] == len(r["text"]) for r in left.values())
    untouched = [k for k in left if k not in (5, 7)]
    assert all(left[k]["text"] == texts[k] for k in untouched)
    before = _common.scratch_mark()
    packed = pipeline.run(spark, sf)
    assert _common.scratch_mark() - before <= 2  # the last stage's documents and its pieces
    assert packed.agg(F.max("n_tokens")).first()[0] <= 2048 and packed.select(F.explode("documents.doc_id")).distinct().count() == len(left)
