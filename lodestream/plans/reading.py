"""Queries that count, search and watch (SURVEY L, A, S, T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.operators.alerts import DAY_MS, cooled, in_window
from lodestream.operators.slices import before
from lodestream.plans.base import query
from lodestream.plans.matching import demands, events, mails, stored, versions
from lodestream.plans.texts import LOWER
from lodestream.sources.tables import table

MS = "(epoch_us(ts) // 1000)"


def _ms(c="ts"):
    return F.unix_millis(F.col(c).cast("timestamp"))


@query("ledger_counts", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total FROM events GROUP BY 1")
def ledger_counts(spark, folder):
    """Counts and sums by group."""
    return events(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "ledger_reconcile",
    "SELECT (SELECT count(DISTINCT graph_id) FROM outlook_messages) AS fetched, (SELECT count(DISTINCT source_email_id) FROM jd_versions) AS recorded, (SELECT count(*) FROM (SELECT graph_id FROM outlook_messages WHERE graph_id IS NOT NULL EXCEPT SELECT source_email_id FROM jd_versions)) AS missing",
)
def ledger_reconcile(spark, folder):
    """What was fetched and not recorded."""
    m = mails(spark, folder).select(F.col("graph_id").alias("k")).where("k is not null").distinct().withColumn("f", F.lit(1))
    v = versions(spark, folder).select(F.col("source_email_id").alias("k")).where("k is not null").distinct().withColumn("r", F.lit(1))
    return m.join(v, "k", "full_outer").agg(F.count("f").alias("fetched"), F.count("r").alias("recorded"), F.count_if(F.col("f").isNotNull() & F.col("r").isNull()).alias("missing"))


@query("month_counts", "SELECT strftime(make_timestamp(epoch_ms(o_orderdate) * 1000), '%Y-%m') AS month, o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2")
def month_counts(spark, folder):
    """A2: counts by month and state."""
    o = table(spark, folder, "orders")
    return o.groupBy(F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM").alias("month"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("domain_counts", f"SELECT {LOWER.format('split_part(from_email, chr(64), 2)')} AS domain, count(*) AS n, count(DISTINCT conversation_id) AS conversations FROM outlook_messages WHERE from_email IS NOT NULL GROUP BY 1")
def domain_counts(spark, folder):
    """Mails by the sender's domain."""
    from lodestream.functions.text import ascii_lower

    m = mails(spark, folder).where("from_email is not null")
    return m.groupBy(ascii_lower(F.split_part("from_email", F.lit("@"), F.lit(2))).alias("domain")).agg(F.count("*").alias("n"), F.countDistinct("conversation_id").alias("conversations"))


@query("json_distinct", "SELECT payload_json->>'$.job_status' AS job_status, count(*) AS n FROM metaforge_requirements WHERE json_valid(payload_json) GROUP BY 1")
def json_distinct(spark, folder):
    """A5, SC20, V16: values inside JSON; damaged JSON takes no part."""
    m = stored(spark, folder).where(F.try_parse_json("payload_json").isNotNull())
    return m.groupBy(F.get_json_object("payload_json", "$.job_status").alias("job_status")).agg(F.count("*").alias("n"))


@query(
    "health_summary",
    "SELECT count(*) AS total, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS failed, round(1 - count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS success_rate, round(coalesce(sum(value), 0), 2) AS value_sum, max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000) AS span_ms FROM events",
)
def health_summary(spark, folder):
    """One row of operational figures."""
    bad = F.count_if(F.col("event_type") == "error")
    return events(spark, folder).agg(F.count("*").alias("total"), bad.alias("failed"), F.round(1 - F.try_divide(bad, F.count("*")), 6).alias("success_rate"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("value_sum"), (F.max(_ms()) - F.min(_ms())).alias("span_ms"))


@query(
    "alert_cooldown",
    f"WITH e AS (SELECT user_id, event_id, {MS} AS ms FROM events), l AS (SELECT *, ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS gap FROM e) SELECT user_id, event_id, ms FROM l WHERE gap IS NULL OR gap >= {3 * DAY_MS}",
)
def alert_cooldown(spark, folder):
    """Alerts after a quiet time of three days; suppressed ones count as the last alert."""
    e = events(spark, folder).select("user_id", "event_id", _ms().alias("ms"))
    return cooled(e, "user_id", "ms", 3 * DAY_MS, "event_id").select("user_id", "event_id", "ms")


@query(
    "failure_windows",
    f"""WITH e AS (SELECT event_id, event_type, {MS} AS ms FROM events), c AS (SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ms RANGE BETWEEN 1800000 PRECEDING AND CURRENT ROW) AS recent FROM e) SELECT event_id, recent FROM c WHERE recent >= 3""",
)
def failure_windows(spark, folder):
    """Events of a kind with two or more others in the half hour before."""
    e = events(spark, folder).select("event_id", "event_type", _ms().alias("ms"))
    return in_window(e, "event_type", "ms", 1_800_000, "recent").where("recent >= 3").select("event_id", "recent")


@query(
    "staleness_gaps",
    f"WITH m AS (SELECT DISTINCT mailbox_zone, epoch_ms(fetched_at) AS ms FROM outlook_messages), l AS (SELECT mailbox_zone, ms, ms - lag(ms) OVER (PARTITION BY mailbox_zone ORDER BY ms) AS gap FROM m) SELECT mailbox_zone, count(*) AS ticks, count(*) FILTER (WHERE gap > {DAY_MS})::BIGINT AS stale, max(gap) AS longest FROM l GROUP BY 1",
)
def staleness_gaps(spark, folder):
    """How often a feed was silent for more than a day."""
    m = mails(spark, folder).select("mailbox_zone", F.unix_millis("fetched_at").alias("ms")).distinct()
    m = before(m, ["mailbox_zone"], ["ms"], {"last": "ms"}).withColumn("gap", F.col("ms") - F.col("last"))
    return m.groupBy("mailbox_zone").agg(F.count("*").alias("ticks"), F.count_if(F.col("gap") > DAY_MS).alias("stale"), F.max("gap").alias("longest"))


@query(
    "search_sort_page",
    f"""SELECT job_id, job_title, location FROM (SELECT DISTINCT job_id, job_title, location FROM final_corrected_requirements WHERE contains({LOWER.format("concat_ws(' ', job_id, job_title, location, requirement_from, mandatory_skills)")}, 'engineer')) ORDER BY job_id DESC, job_title NULLS LAST, location NULLS LAST LIMIT 20 OFFSET 20""",
)
def search_sort_page(spark, folder):
    """The second page of a search, newest first (a page is the feature)."""
    from lodestream.functions.text import ascii_lower

    text = ascii_lower(F.concat_ws(" ", "job_id", "job_title", "location", "requirement_from", "mandatory_skills"))
    d = demands(spark, folder).where(text.contains("engineer")).select("job_id", "job_title", "location").distinct()
    return d.orderBy(F.desc("job_id"), F.asc_nulls_last("job_title"), F.asc_nulls_last("location")).offset(20).limit(20)


@query(
    "kpi_summary",
    f"SELECT count(*) AS total, count(*) FILTER (WHERE {LOWER.format('job_status')} = 'open')::BIGINT AS open, count(*) FILTER (WHERE {LOWER.format('job_status')} LIKE '%hold%')::BIGINT AS hold, count(*) FILTER (WHERE {LOWER.format('job_status')} = 'closed')::BIGINT AS closed, sum(number_of_positions)::BIGINT AS positions, count(internal_poc)::BIGINT AS assigned FROM final_corrected_requirements",
)
def kpi_summary(spark, folder):
    """Counts of states and sums in one pass."""
    from lodestream.functions.text import ascii_lower

    s = ascii_lower(F.col("job_status"))
    return demands(spark, folder).agg(F.count("*").alias("total"), F.count_if(s == "open").alias("open"), F.count_if(s.like("%hold%")).alias("hold"), F.count_if(s == "closed").alias("closed"), F.sum("number_of_positions").cast("bigint").alias("positions"), F.count("internal_poc").alias("assigned"))


@query("distinct_facets", " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, count(*) AS n FROM final_corrected_requirements WHERE {c} IS NOT NULL GROUP BY 2" for c in ("requirement_from", "job_status", "work_mode", "priority")))
def distinct_facets(spark, folder):
    """The values of four facets with counts, in one pass over the table."""
    facets = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("requirement_from", "job_status", "work_mode", "priority")])
    return demands(spark, folder).select(F.explode(facets).alias("x")).where("x.value is not null").groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


@query("id_suggestions", "SELECT DISTINCT job_id FROM metaforge_requirements WHERE contains(job_id, '03/1') ORDER BY job_id DESC LIMIT 10")
def id_suggestions(spark, folder):
    """The ten newest ids that hold a text (a top-k report)."""
    return stored(spark, folder).select("job_id").where(F.col("job_id").contains("03/1")).distinct().orderBy(F.desc("job_id")).limit(10)


@query(
    "multi_source_merge",
    """WITH u AS (SELECT c_nationkey AS k, 10 AS p, c_acctbal AS bal, c_name AS name FROM customer UNION ALL SELECT s_nationkey, 5, s_acctbal, s_name FROM supplier), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p DESC, bal DESC, name) AS rn FROM u)
        SELECT n.n_name, r.name, r.bal FROM r JOIN nation n ON n.n_nationkey = r.k WHERE rn = 1""",
)
def multi_source_merge(spark, folder):
    """S4, SC11: one record per key from several tables by priority, then value."""
    c = table(spark, folder, "customer").select(F.col("c_nationkey").alias("k"), F.lit(10).alias("p"), F.col("c_acctbal").alias("bal"), F.col("c_name").alias("name"))
    s = table(spark, folder, "supplier").select("s_nationkey", F.lit(5), "s_acctbal", "s_name")
    best = c.union(s).groupBy("k").agg(F.min_by(F.struct("name", "bal"), F.struct((-F.col("p")).alias("p"), (-F.col("bal")).alias("b"), "name")).alias("x"))
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return best.join(n, best.k == n.n_nationkey).select("n_name", "x.name", "x.bal")


@query(
    "open_durations",
    "SELECT o_orderkey, CASE WHEN d = 0 THEN 'today' WHEN d < 30 THEN d || 'd' WHEN d < 365 THEN (d // 30) || 'mo' ELSE (d // 365) || 'y' END AS open_since FROM (SELECT o_orderkey, (883612800000 - epoch_ms(o_orderdate)) // 86400000 AS d FROM orders WHERE o_orderstatus = 'O' AND epoch_ms(o_orderdate) < 883612800000)",
)
def open_durations(spark, folder):
    """How long an order has been open on a day, in words."""
    day = F.lit(883_612_800_000)
    o = table(spark, folder, "orders").where("o_orderstatus = 'O'").select("o_orderkey", F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("o_orderdate").cast("timestamp_ntz")).alias("ms")).where(F.col("ms") < day)
    d = F.floor((day - F.col("ms")) / 86_400_000).cast("bigint")
    text = F.when(d == 0, "today").when(d < 30, F.concat(d.cast("string"), F.lit("d"))).when(d < 365, F.concat(F.floor(d / 30).cast("string"), F.lit("mo"))).otherwise(F.concat(F.floor(d / 365).cast("string"), F.lit("y")))
    return o.select("o_orderkey", text.alias("open_since"))


@query(
    "pricing_summary",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def pricing_summary(spark, folder):
    """A1-A3 on the largest table: grouped sums with partial aggregation."""
    li = table(spark, folder, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.count("*").alias("n"))
