"""Personal data: fixed patterns, and further spans by bootstrapped contextual extraction.

The fixed patterns' finds are seeds. The words before and after a seed are a lexical pattern.
Patterns and the strings that they meet form a graph, over which confidence goes back and forth: a
pattern is as good as the strings it meets, a string as good as the patterns that meet it. Strings
that no fixed pattern found, but several good patterns meet, are added, and what stands beside these
are patterns in the next round. How a string is written isn't part of a pattern; its form only has
to be near that of known ones of the kind. Secrets are a kind of their own: their seeds are strings of
letters and digits that are given to a key word. Texts are read once; the graph holds only digests.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import order_id, written

#: The kinds of the fixed patterns, and what is found beyond them.
KINDS = ("email", "ip", "card", "phone", "secret")
SECRET = 4
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z").search
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_SECRET = re.compile(r"""(?i)(?<![a-z0-9])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)["']?[ \t]{0,4}[:=][ \t]{0,4}["']?([a-z0-9][a-z0-9+/_=.-]{15,})""").finditer
#: Strings that may be identifiers: with a digit run, or an @ written out.
_MAYBE = re.compile(r"[A-Za-z0-9+(][A-Za-z0-9@._%+():/=-]{5,}").finditer
#: Numbers in groups that spaces part.
_GROUPED = re.compile(r"(?<![\w@+])\(?[0-9]+(?:[().:/-]{0,2} ?[().:/-]{0,2}[0-9]+)+(?![\w@])").finditer
_WORD = re.compile(r"\w+")
#: What may stand between a key word and what is given to it.
_MARKS = " \t:=#<>\"'([{|"
_NOT_DIGIT = re.compile("[^0-9]+")
#: The form of strings with an @, and the least one of strings of letters and digits, which have their length's;
#: other forms are numbers of digits. Forms are near each other up to FORM_REACH - 1 apart.
AT_FORM, MIXED_FORM, FORM_REACH = 1000, 2000, 4


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; each kind's matches leftmost without overlap, failing ones dropped."""
    out, after = [], 0
    at = text.find("@")
    while at >= 0:
        low = max(after, at - 4096)
        start = _LOCAL(text, low, at).start()
        while start == low > after:  # a longer local part than was looked at
            low = max(after, at - 2 * (at - low))
            start = _LOCAL(text, low, at).start()
        if start < at and (m := _DOMAIN(text, at)):
            out.append((start, 0, m.end()))
            after = m.end()
        at = text.find("@", max(at + 1, after))
    for m in _IP(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def secrets(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, SECRET, end) of seeds: letters and digits given to a key word, outside the spans that are taken."""
    out = []
    for m in _SECRET(text):
        start, end = m.start(1), m.start(1) + len(m[1].rstrip("=.-"))
        found = text[start:end]
        if any(map(str.isdigit, found)) and any(map(str.isalpha, found)) and not any(a < end and start < b for a, _, b in taken):
            out.append((start, SECRET, end))
    return out


def form(found: str) -> int:
    if "@" in found:
        return AT_FORM
    digits = sum(map(str.isdigit, found))
    return MIXED_FORM + min(len(found), 4000) // 4 if 4 <= sum(map(str.isalpha, found)) and digits else min(digits, AT_FORM // 2)


def _digest(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(parts)) - (1 << 63)


def _nearest(text: str, at: int, step: int) -> list[str]:
    """The two words next before (step -1) or behind a place, in the order of the text."""
    reach = 60
    while True:
        part = text[max(0, at - reach) : at] if step < 0 else text[at : at + reach]
        found = _WORD.findall(part)
        # the outermost word may go on beyond what was looked at
        if len(found) > 2 or reach >= (at if step < 0 else len(text) - at):
            return [w.lower() for w in (found[-2:] if step < 0 else found[:2])]
        reach *= 4


def contexts(text: str, start: int, end: int) -> list[int]:
    """Digests of the lexical patterns around a span.

    Two words before it, two after, one on each side, and the word before it with the marks between, if
    there are some, as in: token = ".
    """
    before, behind = _nearest(text, start, -1), _nearest(text, end, 1)
    out = []
    if len(before) == 2:
        out.append(_digest("before", *before))
    if len(behind) == 2:
        out.append(_digest("behind", *behind))
    if before and behind:
        out.append(_digest("around", before[-1], behind[0]))
    lead = text[max(0, start - 8) : start]
    gap = lead[len(lead.rstrip(_MARKS)) :]
    if before and gap.strip() and len(gap) < 8:
        out.append(_digest("lead", before[-1], gap.strip()))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans outside the base ones that hold four digits or an @; a number in groups is one span."""
    out, taken = [], [(s, e) for s, _, e in base]
    for m in _GROUPED(text):
        s, e = m.span()
        if " " in m[0] and 7 <= sum(map(str.isdigit, m[0])) <= 19 and not any(a < e and s < b for a, b in taken):
            out.append((s, e))
    taken += out
    for m in _MAYBE(text):
        s, e = m.span()
        while e > s and text[e - 1] in ".:-/(":
            e -= 1
        if sum(map(str.isdigit, text[s:e])) >= 4 or "@" in text[s:e]:
            if not any(a < e and s < b for a, b in taken):
                out.append((s, e))
    return sorted(out)


_FOUND = pa.struct(
    [
        ("base", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))),
        ("seen", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("instance", pa.int64()), ("form", pa.int32()), ("patterns", pa.list_(pa.int64()))]))),
    ]
)
_FOUND_SQL = "struct<base:array<struct<start:long,kind:int,end:long>>,seen:array<struct<start:long,kind:int,end:long,instance:long,form:int,patterns:array<long>>>>"


def _read(texts: pa.Array) -> pa.Array:
    out = []
    for text in texts:
        text = text.as_py() or ""
        base = base_spans(text)
        seen = sorted(base + secrets(text, base))
        seen += [(s, -1, e) for s, e in candidates(text, seen)]
        out.append(
            {
                "base": [{"start": s, "kind": k, "end": e} for s, k, e in base],
                "seen": [{"start": s, "kind": k, "end": e, "instance": _digest(text[s:e]), "form": form(text[s:e]), "patterns": contexts(text, s, e)} for s, k, e in seen],
            }
        )
    return pa.array(out, _FOUND)


def _form_scores(known: DataFrame) -> DataFrame:
    """(p_kind, form, form_score): the share of a kind's known strings (p_kind, form, belief) whose form is near, nearer ones counting more."""
    reach = F.sequence(F.lit(1 - FORM_REACH), F.lit(FORM_REACH - 1))
    by_form = known.groupBy("p_kind", "form").agg(F.sum("belief").alias("n"))
    near = by_form.select("p_kind", "form", "n", F.explode(reach).alias("off")).select("p_kind", (F.col("form") + F.col("off")).alias("form"), (F.col("n") * (1 - F.abs("off") / FORM_REACH)).alias("n"))
    total = known.groupBy("p_kind").agg(F.sum("belief").alias("all"))
    return near.groupBy("p_kind", "form").agg(F.sum("n").alias("n")).join(F.broadcast(total), "p_kind").select("p_kind", "form", (F.col("n") / F.col("all")).alias("form_score"))


def confident(seen: DataFrame, rounds: int = 3, min_seeds: int = 5, least: float = 0.9, least_form: float = 0.1, strong: int = 20) -> DataFrame:
    """(instance, kind) of strings that good patterns found, from (instance, kind or -1, pattern, and form if there is one).

    A pattern takes part for a kind if it meets min_seeds different strings of it: seeds, or in later
    rounds strings accepted so far. Edges are made distinct first, so a string that a third of all
    documents repeat counts once for a pattern.
    """
    if "form" not in seen.columns:
        seen = seen.withColumn("form", F.lit(0))
    edges = seen.select("instance", "kind", "form", F.explode("patterns").alias("pattern")).distinct()
    total = edges.groupBy("pattern").agg(F.count("*").alias("n_all")).where(F.col("n_all") >= min_seeds)
    edges = written(edges.join(total, "pattern"), "edges")
    seeds = written(edges.where("kind >= 0").groupBy("pattern", F.col("kind").alias("p_kind")).agg(F.count("*").alias("n_seeds"), F.first("n_all").alias("n_all")), "seeds")
    seed_forms = written(seen.where("kind >= 0").select("instance", F.col("kind").alias("p_kind"), "form").distinct().groupBy("p_kind", "form").agg(F.count("*").cast("double").alias("belief")), "forms")
    open_edges = edges.where("kind < 0").select("instance", "form", "pattern", "n_all")
    accepted = None
    for _ in range(rounds):
        support, forms = seeds.select("pattern", "p_kind", F.col("n_seeds").alias("n"), F.col("n_seeds").cast("double").alias("weight")), seed_forms
        if accepted is not None:
            gained = open_edges.join(accepted.drop("form"), "instance").select("pattern", "p_kind", F.lit(1).cast("long").alias("n"), F.col("belief").alias("weight"))
            support = support.unionByName(gained).groupBy("pattern", "p_kind").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
            forms = forms.unionByName(accepted.select("p_kind", "form", "belief"))
        scored = open_edges.join(support.where(F.col("n") >= min_seeds), "pattern").withColumn("score", F.col("weight") / (F.col("n_all") + 1))
        doubt = F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999))))
        belief = scored.groupBy("instance", "form", "p_kind").agg((1 - F.exp(doubt)).alias("belief"), F.count("*").alias("n_patterns"), F.max("n").alias("support"))
        belief = belief.where((F.col("belief") >= least) & ((F.col("n_patterns") >= 2) | (F.col("support") >= strong))).join(_form_scores(forms), ["p_kind", "form"])
        accepted = written(belief.where(F.col("form_score") >= least_form).select("instance", "form", "p_kind", "belief"), "accepted")
    return accepted.groupBy("instance").agg(F.max_by(F.col("p_kind"), F.struct("belief", -F.col("p_kind"))).alias("kind"))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bootstrap) -> DataFrame:
    """(doc, tie, base, spans): arrays of (start, kind, end) in code points, by start and kind; a table in the shared folder.

    kind is a place in KINDS. tie tells texts with one id apart; rows that repeat id and text come
    once each. A null or empty text has no span; a text of any length is read as a whole. Spans that
    several kinds claim are given to the one with the highest belief, of equal ones to the first in
    KINDS. An empty table gives no row.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(order_id(F.col(f"`{id_col}`").cast("long")).alias("doc"), F.xxhash64(text).alias("tie"), F.arrow_udf(_read, _FOUND_SQL)(text).alias("found"))
    rows = written(rows.select("doc", "tie", "found.base", "found.seen"), "spans")
    seen = rows.select("doc", "tie", F.explode("seen").alias("s")).select("doc", "tie", "s.*")
    extra = confident(seen.select("instance", "kind", "form", "patterns"), **bootstrap).withColumnRenamed("kind", "new_kind")
    added = seen.where("kind < 0").join(extra, "instance").select("doc", "tie", F.struct("start", F.col("new_kind").alias("kind"), "end").alias("span"))
    added = added.unionByName(seen.where(F.col("kind") == SECRET).select("doc", "tie", F.struct("start", "kind", "end").alias("span")))
    added = added.groupBy("doc", "tie").agg(F.collect_set("span").alias("added"))
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:long,kind:int,end:long>>"))))
    return rows.join(added, ["doc", "tie"], "left").select("doc", "tie", "base", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bootstrap) -> DataFrame:
    """docs with every span replaced by its kind in angle brackets; all rows and columns stay, a null text stays null."""
    key = F.struct(order_id(F.col(f"`{id_col}`").cast("long")).alias("doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("tie"))
    spans = found(docs, id_col, text_col, **bootstrap).where(F.size("spans") > 0).select(F.struct("doc", "tie").alias("__tm_key"), F.col("spans").alias("__tm_spans")).dropDuplicates(["__tm_key"])

    @F.arrow_udf("string")
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts, spans.to_pylist()):
            text = text.as_py()
            if text is None or not own:
                out.append(text)
                continue
            parts, at = [], 0
            for s in own:
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"<{KINDS[s['kind']]}>"]
                at = max(at, s["end"])
            out.append("".join([*parts, text[at:]]))
        return pa.array(out, pa.string())

    both = docs.withColumn("__tm_key", key).join(spans, "__tm_key", "left")
    return both.select(*[masked(F.col(f"`{c}`"), F.col("__tm_spans")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
