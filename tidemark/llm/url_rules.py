"""URL filtering by association rules that FP-growth mines from labelled pages.

Everything here is DataFrame operations and Spark's own FP-growth. Given rules for hosts and
paths come first; where none fits, mined combinations of URL tokens decide.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD = "label:block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null or without '://'."""
    there = F.instr(url, "://")
    rest = F.when(there > 0, F.substr(url, there + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL: host labels and their parts between hyphens, directories, file ending, query keys with values, scheme, fragment."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    folders = F.split(path, "/")
    all_of = F.concat(
        named("host:", F.split(host, r"\.")),
        named("word:", F.array_except(F.split(host, "[.-]"), F.split(host, r"\."))),
        named("dir:", F.filter(F.slice(folders, 1, F.greatest(F.size(folders) - 1, F.lit(0))), lambda x: x != "")),
        named("ext:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)\z", 1))),
        named("query:", F.split(query, "&")),
        named("scheme:", F.array(F.regexp_extract(F.coalesce(url, F.lit("")), r"\A([A-Za-z][A-Za-z0-9+.-]*)://", 1))),
        named("part:", F.array(F.regexp_extract(F.coalesce(url, F.lit("")), r"#(.*)", 1))),
    )
    return F.array_distinct(all_of)


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    host, path = host_and_path(F.col(f"`{url_col}`"))
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), host.alias("host"), path.alias("path"))


def given_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest of the rules (verdict, host, path) that fits, as text, and its verdict; null without one."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


#: What unwanted pages speak of (a parameter of content_labels).
UNWANTED = ("casino", "bets", "pills", "adult", "spam", "ads")


def content_labels(pages: DataFrame, words: tuple[str, ...] = UNWANTED, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, bad): weak labels by whether a page's own content has one of the words; null content gives no label."""
    hit = F.col(f"`{html_col}`").rlike(rf"(?i)\b(?:{'|'.join(words)})\b")
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), hit.alias("bad")).where(F.col("bad").isNotNull())


def mine(labelled: DataFrame, min_support: float = 0.002, min_count: int = 20, min_confidence: float = 0.6, min_lift: float = 1.5) -> DataFrame:
    """Rules (items, support, confidence, token) whose tokens foretell BAD; labelled has (items, bad boolean).

    A rule must hold in a share of min_support and in min_count pages, together with BAD. Repeated rows
    count as often as they stand there; ties in confidence go to the shorter rule: rules that contain a rule
    with at least their confidence are pruned. token is the rule's rarest one. An empty table gives none.
    """
    baskets = labelled.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items"))
    support = max(min_support, min(1.0, min_count / max(1, baskets.count())))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") >= min_lift))
    rules = rules.select(F.array_sort("antecedent").alias("items"), "support", "confidence")
    known = F.explode("items").alias("token")
    freq = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = rules.select("items", known).join(freq, "token").groupBy("items").agg(F.min_by("token", F.struct("freq", "token")).alias("token"))
    rules = rules.join(rarest, "items")
    # a shorter rule is looked for under its rarest token, which a rule that contains it has as well
    short = rules.select(F.col("items").alias("less"), F.col("confidence").alias("less_confidence"), F.col("token").alias("anchor"))
    inside = (F.size("less") < F.size("items")) & (F.size(F.array_except("less", "items")) == 0) & (F.col("less_confidence") >= F.col("confidence"))
    pruned = rules.select("items", "confidence", F.explode("items").alias("anchor")).join(short, "anchor").where(inside).select("items").distinct()
    return rules.join(pruned, "items", "left_anti")


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (page_id, url) for which all tokens of some rule are there, by an inverted index.

    The index lists a rule under its rarest token, so a page meets it at most once, and tokens that nearly
    all pages have hold no rule unless that is all the rule has.
    """
    index = rules.select(F.col("items").alias("rule"), "token")
    seen = pages.select("page_id", "url", F.explode("items").alias("token"), F.col("items"))
    hit = seen.join(index, "token").where(F.size(F.array_except("rule", "items")) == 0)
    return hit.select("page_id", "url").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", **mining) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, mined) of every page; mined tells whether a mined rule fits where no given one does.

    labels: (page_id, bad). A null or broken URL has an empty host and path and no tokens, and is
    allowed. Repeated pages get the same verdict each; empty tables give no row, and without
    labels no rule is mined. Pages with a null id are judged as the others. URLs of any length are read
    as a whole; of given rules of one length the first in the list counts.
    """
    rows = parsed(pages, id_col, url_col)
    items = tokens(F.col("host"), F.col("path"), F.col("url"))
    wanted = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    baskets = rows.join(wanted.where(F.col("bad").isNotNull()), "page_id").select(items.alias("items"), "bad").where(F.size("items") > 0)
    found = mine(baskets, **mining)
    name, given = given_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("given", given)
    open_rows = rows.where(F.col("rule").isNull()).select(F.col("page_id"), "url", items.alias("items"))
    hits = matched(open_rows, found).select(F.col("page_id").alias("h_id"), F.col("url").alias("h_url"), F.lit(True).alias("hit"))
    out = rows.join(hits, F.col("page_id").eqNullSafe(F.col("h_id")) & (F.col("url") == F.col("h_url")), "left")
    verdict = F.coalesce("given", F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("hit", F.lit(False)).alias("mined"))
