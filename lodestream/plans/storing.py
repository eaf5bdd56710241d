"""Queries on state: differences, merges, versions, numbering (SURVEY U, Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions.values import placeholder_list
from lodestream.operators import store as S
from lodestream.operators.slices import before
from lodestream.plans.base import query
from lodestream.plans.matching import demands, events, stored, versions
from lodestream.plans.texts import LOWER
from lodestream.sources.tables import table

_FIELDS = ("job_status", "location", "work_mode", "notice_period", "yearly_budget")


@query(
    "field_diffs",
    "WITH v AS (SELECT DISTINCT requirement_id, version_number, payload_json FROM jd_versions WHERE json_valid(payload_json)), l AS (SELECT requirement_id, version_number, payload_json AS n, lag(payload_json) OVER (PARTITION BY requirement_id ORDER BY version_number, payload_json) AS o FROM v), c AS ("
    + " UNION ALL ".join(f"SELECT requirement_id, version_number, '{f}' AS field, n->>'$.{f}' AS new_value, o->>'$.{f}' AS old_value FROM l WHERE o IS NOT NULL" for f in _FIELDS)
    + ") SELECT requirement_id, version_number, field, old_value, new_value FROM c WHERE new_value IS NOT NULL AND trim(new_value) <> '' AND trim(regexp_replace(new_value, '[ \\t\\n\\r]+', ' ', 'g')) IS DISTINCT FROM trim(regexp_replace(old_value, '[ \\t\\n\\r]+', ' ', 'g'))",
)
def field_diffs(spark, folder):
    """What each version changed against the one before it."""
    fields = F.create_map(*[x for f in _FIELDS for x in (F.lit(f), F.get_json_object("payload_json", f"$.{f}"))])
    v = versions(spark, folder).where(F.try_parse_json("payload_json").isNotNull()).select("requirement_id", "version_number", "payload_json").distinct()
    v = before(v, ["requirement_id"], ["version_number", "payload_json"], {"old_json": "payload_json"}).where("old_json is not null").withColumn("n", fields)
    v = v.withColumn("o", F.create_map(*[x for f in _FIELDS for x in (F.lit(f), F.get_json_object("old_json", f"$.{f}"))]))
    v = v.select("requirement_id", "version_number", F.explode(S.field_changes(F.col("o"), F.col("n"))).alias("field", "c"))
    return v.select("requirement_id", "version_number", "field", F.col("c.old").alias("old_value"), F.col("c.new").alias("new_value"))


@query(
    "merge_nonblank",
    f"""WITH d AS (SELECT DISTINCT client_jd_id, job_id, location, priority, notice_period FROM final_corrected_requirements WHERE client_jd_id IS NOT NULL AND job_id IS NOT NULL), """
    + ", ".join(f"{f}_ AS (SELECT client_jd_id, {fn}({f}, job_id) AS {f} FROM d WHERE {f} IS NOT NULL AND {LOWER.format(f'trim({f})')} NOT IN (SELECT placeholder FROM placeholder_values) GROUP BY 1)" for f, fn in (("location", "arg_max"), ("priority", "arg_max"), ("notice_period", "arg_min")))
    + " SELECT k.client_jd_id, l.location, p.priority, n.notice_period FROM (SELECT DISTINCT client_jd_id FROM d) k LEFT JOIN location_ l USING (client_jd_id) LEFT JOIN priority_ p USING (client_jd_id) LEFT JOIN notice_period_ n USING (client_jd_id)",
)
def merge_nonblank(spark, folder):
    """Of each field the latest real value, blank never over real; fixed fields keep the first."""
    d = demands(spark, folder).where("client_jd_id is not null and job_id is not null").select("client_jd_id", "job_id", "location", "priority", "notice_period").distinct()
    return S.merged(d, ["client_jd_id"], F.col("job_id"), ["location", "priority", "notice_period"], fixed=("notice_period",), placeholders=placeholder_list(table(spark, folder, "placeholder_values")))


@query(
    "snapshot_upsert",
    """WITH u AS (SELECT job_id, seq, 0 AS src FROM metaforge_requirements UNION ALL SELECT requirement_id, version_number, 1 FROM jd_versions), r AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC, src DESC) AS rn FROM u)
        SELECT job_id, seq::BIGINT AS seq FROM r WHERE rn = 1""",
)
def snapshot_upsert(spark, folder):
    """SK2, U6, U12, U19: a snapshot after an upsert; columns that one side lacks are null."""
    current = stored(spark, folder).select("job_id", "seq")
    incoming = versions(spark, folder).select(F.col("requirement_id").alias("job_id"), F.col("version_number").cast("bigint").alias("seq"))
    return S.upsert(current, incoming, ["job_id"], "seq")


@query(
    "version_lists",
    """SELECT requirement_id, count(DISTINCT version_number) AS versions, max(version_number)::BIGINT AS latest, (max(version_number) - count(DISTINCT version_number))::BIGINT AS missing, string_agg(DISTINCT version_number::VARCHAR, ',' ORDER BY version_number::VARCHAR) AS list FROM jd_versions GROUP BY 1""",
)
def version_lists(spark, folder):
    """The versions that are there, distinct and in order."""
    v = versions(spark, folder)
    numbers = F.array_join(F.array_sort(F.collect_set(F.col("version_number").cast("string"))), ",")
    return v.groupBy("requirement_id").agg(F.countDistinct("version_number").alias("versions"), F.max("version_number").cast("bigint").alias("latest"), (F.max("version_number") - F.countDistinct("version_number")).cast("bigint").alias("missing"), numbers.alias("list"))


@query(
    "status_transitions",
    """WITH e AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT before AS from_status, event_type AS to_status, count(*) AS n FROM e WHERE before IS NOT NULL AND before <> event_type GROUP BY 1, 2""",
)
def status_transitions(spark, folder):
    """Changes of state per entity."""
    e = events(spark, folder).select("user_id", "event_type", "event_id", "ts")
    e = before(e, ["user_id"], ["ts", "event_id"], {"before": "event_type"}, F.unix_micros(F.col("ts").cast("timestamp")))
    return e.where("before is not null and before <> event_type").groupBy(F.col("before").alias("from_status"), F.col("event_type").alias("to_status")).agg(F.count("*").alias("n"))


@query("sequence_daily", "SELECT job_id, req_date, row_number() OVER (PARTITION BY req_date ORDER BY seq, job_id) AS seq FROM metaforge_requirements")
def sequence_daily(spark, folder):
    """Gap-free numbers within a day."""
    rows = stored(spark, folder).select("job_id", "req_date", F.col("seq").alias("arrival"))
    return S.numbered(rows, "req_date", ["arrival", "job_id"]).select("job_id", "req_date", "seq")


@query(
    "sequence_gaps",
    """WITH l AS (SELECT req_date, seq, coalesce(lag(seq) OVER (PARTITION BY req_date ORDER BY seq), 0) AS before FROM (SELECT DISTINCT req_date, seq FROM metaforge_requirements)) SELECT req_date, before + 1 AS from_seq, seq - 1 AS to_seq FROM l WHERE seq > before + 1""",
)
def sequence_gaps(spark, folder):
    """Q4, Q5: the ranges of numbers that are missing."""
    return S.missing_numbers(stored(spark, folder), "req_date", "seq")


@query("date_audit", "SELECT job_id, req_date, substr(job_id, 1, 10) AS id_date FROM metaforge_requirements WHERE substr(job_id, 1, 10) <> req_date")
def date_audit(spark, folder):
    """Q7: ids whose date is not the day of arrival."""
    return stored(spark, folder).select("job_id", "req_date", F.substring("job_id", 1, 10).alias("id_date")).where("id_date <> req_date")
