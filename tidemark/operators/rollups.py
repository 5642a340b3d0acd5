"""Rollups of events to sessions and of sessions to source addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import text as T


def entropy(events: DataFrame, key: str = "session_id", item: str = "command_line") -> DataFrame:
    """(key, command_entropy): Shannon entropy in bits of the items' shares."""
    counts = events.groupBy(key, item).agg(F.count("*").alias("n"))
    sums = counts.groupBy(key).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("weighted"))
    return sums.select(key, (F.round(F.log2("total") - F.col("weighted") / F.col("total"), 4) + 0.0).alias("command_entropy"))


def sessions(events: DataFrame) -> DataFrame:
    """One row a session: counts by action, distinct commands, entropy, times, address.

    Items are counted per session first, so the second step sees one row for each distinct command.
    """
    is_command = F.col("action") == "command.input"
    per = events.groupBy("session_id", F.when(is_command, F.col("command_line")).alias("command")).agg(
        F.min("source_ip").alias("source_ip"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n"),
        *[F.count_if(F.col("action") == a).alias(c) for a, c in (("login.success", "ok"), ("login.failed", "bad"), ("file_download", "files"))],
    )
    commands = F.when(F.col("command").isNotNull(), F.col("n"))
    total = F.coalesce(F.sum(commands), F.lit(0))
    spread = F.sum(F.when(F.col("command").isNotNull(), F.col("n") * F.log2("n")))
    return per.groupBy("session_id").agg(
        F.min("source_ip").alias("source_ip"), F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), total.alias("command_count"), F.count("command").alias("unique_commands"),
        F.sum("ok").alias("login_success_count"), F.sum("bad").alias("login_fail_count"), F.sum("files").alias("file_download_count"),
        F.when(total > 0, F.round(F.log2(total.cast("double")) - spread / total, 4) + 0.0).alias("command_entropy"),
        (F.unix_micros(F.max("end_ts")) - F.unix_micros(F.min("start_ts"))).alias("duration_us"),
    )


def first_seen(events: DataFrame, columns: list[str], key: str = "session_id") -> DataFrame:
    """Per key each column's value in its earliest row that has one (ties by value)."""
    picks = [F.min(F.when(F.col(c).isNotNull(), F.struct("ts", c)))[c].alias(c) for c in columns]
    return events.groupBy(key).agg(*picks)


def last_event(events: DataFrame, action: str, key: str = "session_id") -> DataFrame:
    return events.where(F.col("action") == action).groupBy(key).agg(F.max(F.struct("ts", "event_id"))["event_id"].alias("event_id"))


def least_members(rows: DataFrame, key: str, member: str, n: int, name: str) -> DataFrame:
    """(key, name): the n least distinct members of each key, sorted.

    They are ranked by a window, which spills, so a key with very many members is never held.
    """
    distinct = rows.where(F.col(member).isNotNull()).select(key, member).distinct()
    ranked = distinct.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(member))).where(F.col("__rank") <= n)
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list(member)).alias(name))


def command_sequences(events: DataFrame, first: int = 15, key: str = "session_id") -> DataFrame:
    """(key, sequence, total): the first commands of each session in order, and how many it has.

    Commands are ranked by a window, which spills; only the first ones are collected.
    """
    rows = events.where(F.col("action") == "command.input")
    order = Window.partitionBy(key).orderBy("ts", "command_line")
    kept = rows.select(key, "ts", "command_line", F.row_number().over(order).alias("place")).where(F.col("place") <= first)
    begun = kept.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "command_line"))), lambda x: x["command_line"]).alias("sequence"))
    return begun.join(rows.groupBy(key).agg(F.count("*").alias("total")), key)


def command_scores(commands: DataFrame, key: str = "session_id") -> DataFrame:
    """Per key the mean and maximum novelty and the mean confidence of its commands (key, novelty_score, confidence)."""
    return commands.groupBy(key).agg(
        F.round(F.avg("novelty_score"), 4).alias("mean_novelty_score"), F.round(F.max("novelty_score"), 4).alias("max_novelty_score"), F.round(F.avg("confidence"), 2).alias("mean_confidence")
    )


def credentials(events: DataFrame, key: str = "session_id", cap: int = DEFAULT.credential_cap) -> DataFrame:
    pairs = events.withColumn("pair", T.credential(F.col("user_name"), F.col("password")))
    return events.select(key).distinct().join(least_members(pairs, key, "pair", cap, "credentials"), key, "left").select(key, F.coalesce("credentials", F.array().cast("array<string>")).alias("credentials"))


def addresses(rolled: DataFrame) -> DataFrame:
    """One row a source address over session rows; novelty's maximum is that of session means."""
    out = [
        F.count("*").alias("total_sessions"), F.count_if(F.col("login_success_count") > 0).alias("successful_sessions"), F.count_if(F.col("command_count") > 0).alias("command_sessions"),
        F.sum("command_count").alias("total_commands"), F.sum("file_download_count").alias("file_download_count"),
        F.round(F.avg(F.col("duration_us") / 1e6), 4).alias("mean_session_duration_s"), F.min("start_ts").alias("first_seen"), F.max("end_ts").alias("last_seen"),
    ]
    if "mean_novelty_score" in rolled.columns:
        out += [F.round(F.avg("mean_novelty_score"), 4).alias("mean_novelty_score"), F.max("mean_novelty_score").alias("max_novelty_score")]
    return rolled.groupBy("source_ip").agg(*out)


def dominant(rows: DataFrame, key: str, item: str, top: int = 3) -> DataFrame:
    """(key, item, n, rank): the most frequent items of each key, ties in lexical order."""
    counts = rows.where(F.col(item).isNotNull()).groupBy(key, item).agg(F.count("*").alias("n"))
    order = Window.partitionBy(key).orderBy(F.desc("n"), F.col(item))
    return counts.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def top_keys(rows: DataFrame, key: str, top: int) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(top)


def daily(rows: DataFrame, key: str, as_of, days: int = 14, ts: str = "ts") -> DataFrame:
    """(key, day, n) with a row for each of the last days up to as_of, 0 where nothing was."""
    last = F.to_date(F.lit(as_of).cast("timestamp"))
    spine = F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("day")
    counts = rows.where((F.to_date(ts) > F.date_sub(last, days)) & (F.to_date(ts) <= last)).groupBy(key, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
    return rows.select(key).distinct().select(key, spine).join(counts, [key, "day"], "left").select(key, "day", F.coalesce("n", F.lit(0)).alias("n"))


def session_documents(events: DataFrame, columns: list[str], cap: int = DEFAULT.credential_cap) -> DataFrame:
    """Sessions with the first value of each of these columns (destination, agent, fingerprint, ...) and their credentials."""
    out = sessions(events).join(first_seen(events, columns), "session_id", "left")
    if {"user_name", "password"} <= set(events.columns):
        out = out.join(credentials(events, cap=cap), "session_id", "left")
    return out


def with_commands(runs: DataFrame, commands: DataFrame) -> DataFrame:
    """(session, command) rows with what is known of the command; unknown commands stay, with nulls."""
    return runs.join(commands, "command_hash", "left")


def address_documents(rolled: DataFrame, events: DataFrame, places: list[str], cap: int = DEFAULT.credential_cap) -> DataFrame:
    """Addresses with the credentials of all their events and the first known value of each place column (country, network, ...)."""
    known = [F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in places]
    firsts = [F.min(F.when(k, F.struct("start_ts", "session_id", c)))[c].alias(c) for c, k in zip(places, known)]
    out = addresses(rolled).join(rolled.groupBy("source_ip").agg(*firsts), "source_ip") if places else addresses(rolled)
    return out.join(credentials(events, "source_ip", cap), "source_ip", "left")


def located(addresses: DataFrame, networks: DataFrame, ip: str = "source_ip") -> DataFrame:
    """Addresses with the columns of the narrowest network (cidr, ...) that holds them; nulls without one."""
    from ..functions import network as N

    hit = N.in_ranges(addresses.select(F.col(ip).alias("ip")).distinct(), networks.select("cidr")).withColumn("bits", F.when(F.col("cidr").contains("/"), F.substring_index("cidr", "/", -1).cast("int")).otherwise(F.lit(128)))
    best = hit.groupBy("ip").agg(F.max_by("cidr", F.struct("bits", "cidr")).alias("cidr"))
    return addresses.join(best.join(networks, "cidr").withColumnRenamed("ip", ip), ip, "left")
