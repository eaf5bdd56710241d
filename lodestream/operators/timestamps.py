"""Mixed timestamp formats and zones (problem 6): every value as one UTC instant.

A value's own offset or zone abbreviation is used as written. A value without one takes
the zone of its row; where the row has none, the zone of its feed (the mailbox, the
exporting system) is estimated: a zone is a whole history of offsets, and the candidate
is chosen under which the fewest values of the feed violate "written before it was
ingested, and not longer before than max_lag". Only then is anything converted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions.instants import local_of, local_to_utc_ms, with_utc_ms
from lodestream.functions.values import present
from lodestream.sources.tables import table

#: Zones that a feed without one may be in.
CANDIDATES = ("Asia/Kolkata", "Asia/Singapore", "Europe/London", "Europe/Berlin", "America/New_York", "UTC")


def epoch_ms(c: Column) -> Column:
    return F.floor(F.unix_micros(c.cast("timestamp")) / 1000).cast("bigint")


def estimate_zones(df: DataFrame, feed: str, text: str, seen_ms: Column, candidates: tuple[str, ...] = CANDIDATES, max_lag_ms: int = 3_600_000) -> DataFrame:
    """One row (feed, zone, n, bad) for each feed with a usable local time: its zone, from how many
    times, and how many of them violate it; and one of feed null, from all rows together.

    For every candidate the violations and the lag are plain sums, so the estimate is one
    aggregation with partial sums before its shuffle: a feed that holds a third of all
    rows costs no more than others. Ties go to the smaller lag, then to the
    candidate named first; a feed of one time is decided by that alone. Null feeds count for
    the row of all; rows without seen time take no part.
    """
    # only texts without an offset of their own are evidence
    bare = (F.col("text").rlike("(?i) [ap]m$") | ~F.col("text").rlike(r"(Z|[+-]\d{2}:?\d{2}|[A-Za-z]{3,5}|\])$")) & ~F.col("text").rlike(r"^\d{7,}$")
    clock = df.select(F.col(feed).cast("string").alias("feed"), F.col(text).alias("text"), seen_ms.alias("seen")).where(F.col("seen").isNotNull() & bare)
    clock = present(with_utc_ms(clock, "local", F.col("text"), F.lit("UTC")), "local")
    # each row votes on every candidate; the votes are summed before the shuffle
    votes = clock.select("feed", "local", "seen", F.posexplode(F.array(*[F.lit(z) for z in candidates])).alias("k", "zone"))
    votes = votes.withColumn("lag", F.col("seen") - local_to_utc_ms(F.col("local"), F.col("zone"))).withColumn("bad", (F.col("lag") < 0) | (F.col("lag") > max_lag_ms))
    votes = votes.groupBy("feed", "k", "zone").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("bad"), F.sum(F.when(~F.col("bad"), F.col("lag")).otherwise(max_lag_ms)).alias("lag"))
    everything = votes.groupBy("k", "zone").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("lag").alias("lag"))
    votes = votes.where("feed is not null").unionByName(everything.withColumn("feed", F.lit(None).cast("string")))
    return votes.groupBy("feed").agg(F.min_by(F.struct("zone", "n", "bad"), F.struct("bad", "lag", "k")).alias("x")).select("feed", "x.*")


def to_utc(df: DataFrame, text: str, zone: Column, out: str = "utc_ms", seen_ms: Column | None = None, feed: str | None = None, fallback: str | None = None) -> DataFrame:
    """df with ``out``: the instant of ``text`` in UTC milliseconds, null where it is none.

    With ``feed`` and ``seen_ms``, rows without a zone get that of their feed as
    estimate_zones() finds it; feeds without evidence that of all rows together, and
    ``fallback`` where there is no evidence at all. A null text, a blank,
    a placeholder, a date that doesn't exist: null. Repeated rows stay repeated; other
    columns are kept, and names starting with two underscores are used on the way.
    """
    if feed is None or seen_ms is None:
        return with_utc_ms(df, out, F.col(text), F.coalesce(zone, F.lit(fallback)), seen_ms)
    df = df.withColumn("__zone", zone).withColumn("__seen", seen_ms)
    known = with_utc_ms(df.where("__zone is not null"), out, F.col(text), F.col("__zone"), F.col("__seen"))
    lost = df.where("__zone is null").drop("__zone")
    found = estimate_zones(lost, feed, text, F.col("__seen"))
    own = found.where("feed is not null").select(F.col("feed").alias("__feed"), F.col("zone").alias("__zone"))
    general = found.where("feed is null").select(F.col("zone").alias("__general"), F.lit(1).alias("__one"))  # one row
    lost = lost.join(own, F.col(feed).cast("string") == F.col("__feed"), "left").drop("__feed").withColumn("__one", F.lit(1)).join(general, "__one", "left")
    lost = with_utc_ms(lost, out, F.col(text), F.coalesce("__zone", "__general", F.lit(fallback)), F.col("__seen")).drop("__general", "__one")
    return known.unionByName(lost).drop("__zone", "__seen")


def mail_times(spark: SparkSession, folder: str) -> DataFrame:
    """graph_id, received_date_time, mailbox_zone, feed (the first recipient's mailbox), seen."""
    return table(spark, folder, "outlook_messages").select("graph_id", "received_date_time", "mailbox_zone", F.lower(F.get("to_recipients", F.lit(0))).alias("feed"), epoch_ms(F.col("fetched_at")).alias("seen"))


def p6_zones(spark: SparkSession, folder: str) -> DataFrame:
    """feed, stated_zone, zone, n, bad: the zone of every mailbox as the estimate finds it with the
    stated one withheld, beside the stated one."""
    mails = mail_times(spark, folder).where("mailbox_zone is not null")
    mails = mails.withColumn("mailbox", F.to_json(F.struct(F.coalesce("feed", F.lit("")).alias("f"), F.col("mailbox_zone").alias("z"))))
    found = estimate_zones(mails, "mailbox", "received_date_time", F.col("seen")).where("feed is not null")
    return found.select(F.get_json_object("feed", "$.f").alias("feed"), F.get_json_object("feed", "$.z").alias("stated_zone"), "zone", "n", "bad")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """table_name, record_key, field_name, utc_ms of every valid time of the three fields."""
    mails = to_utc(mail_times(spark, folder), "received_date_time", F.col("mailbox_zone"), seen_ms=F.col("seen"), feed="feed", fallback="UTC")
    parts = [mails.select(F.lit("outlook_messages").alias("table_name"), F.col("graph_id").alias("record_key"), F.lit("received_date_time").alias("field_name"), "utc_ms")]
    for name, key, field in (("final_corrected_requirements", "job_id", "demand_received_date"), ("metaforge_requirements", "job_id", "created_at")):
        rows = to_utc(table(spark, folder, name).select(key, field), field, F.lit("Asia/Kolkata"))
        parts.append(rows.select(F.lit(name).alias("table_name"), F.col(key).alias("record_key"), F.lit(field).alias("field_name"), "utc_ms"))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return present(out.where("record_key is not null"), "utc_ms").distinct()
