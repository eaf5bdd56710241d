"""Queries that measure quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.functions import extract as X
from lodestream.functions.text import ascii_lower, normal_form
from lodestream.functions.values import is_real, placeholder_list
from lodestream.operators.resolve import greedy_matches
from lodestream.plans.base import query
from lodestream.plans.matching import demands, stored
from lodestream.plans.texts import LOWER
from lodestream.session import cut
from lodestream.sources.tables import table

_CHECKED = ("job_title", "location", "yearly_budget", "work_mode", "notice_period", "overall_experience", "mandatory_skills", "client_poc")


def _real(c: str) -> str:
    return f"({c} IS NOT NULL AND {LOWER.format(f'trim({c})')} NOT IN (SELECT placeholder FROM placeholder_values))"


@query("record_confidence", f"SELECT job_id, round(max(({' + '.join(f'{_real(c)}::INT' for c in _CHECKED)}) / {len(_CHECKED)}.0), 4) AS confidence FROM final_corrected_requirements GROUP BY 1")
def record_confidence(spark, folder):
    """The share of fields with a real value."""
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    have = sum((is_real(F.col(c), placeholders).cast("int") for c in _CHECKED), F.lit(0))
    return demands(spark, folder).groupBy("job_id").agg(F.round(F.max(have / len(_CHECKED)), 4).alias("confidence"))


@query("monitor_metrics", f"SELECT requirement_from AS client, count(*) AS records, {', '.join(f'round(avg({_real(c)}::INT), 4) AS {c}_share' for c in _CHECKED[:5])} FROM final_corrected_requirements WHERE requirement_from IS NOT NULL GROUP BY 1")
def monitor_metrics(spark, folder):
    """V6, V7: shares of real values by client."""
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    return demands(spark, folder).where("requirement_from is not null").groupBy(F.col("requirement_from").alias("client")).agg(F.count("*").alias("records"), *[F.round(F.avg(is_real(F.col(c), placeholders).cast("int")), 4).alias(f"{c}_share") for c in _CHECKED[:5]])


@query(
    "threshold_violations",
    "WITH m AS (" + " UNION ALL ".join(f"SELECT '{c}' AS metric, avg({_real(c)}::INT) AS value, {t} AS least FROM final_corrected_requirements" for c, t in (("job_title", 0.95), ("location", 0.9), ("yearly_budget", 0.5), ("client_poc", 0.95))) + ") SELECT metric, round(value, 4) AS value, least::DOUBLE AS least, value < least AS is_violation FROM m",
)
def threshold_violations(spark, folder):
    """Metrics against their thresholds."""
    limits = (("job_title", 0.95), ("location", 0.9), ("yearly_budget", 0.5), ("client_poc", 0.95))
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    one = demands(spark, folder).agg(*[F.avg(is_real(F.col(c), placeholders).cast("int")).alias(c) for c, _ in limits])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"), F.lit(t).alias("least")) for c, t in limits])).alias("x")).select("x.*")
    return rows.select("metric", F.round("value", 4).alias("value"), "least", (F.col("value") < F.col("least")).alias("is_violation"))


@query(
    "evidence_support",
    f"""WITH d AS (SELECT DISTINCT job_id, job_title, source_subject FROM final_corrected_requirements WHERE job_title IS NOT NULL AND source_subject IS NOT NULL), w AS (SELECT job_id, job_title, source_subject, list_distinct(list_filter(regexp_split_to_array({LOWER.format('job_title')}, '[^a-z0-9]+'), lambda x: length(x) >= 3)) AS t FROM d)
        SELECT job_id, job_title, source_subject, round(len(list_filter(t, lambda x: contains({LOWER.format('source_subject')}, x))) / len(t), 4) AS support FROM w WHERE len(t) > 0""",
)
def evidence_support(spark, folder):
    """The share of a title's words that its mail's subject holds."""
    d = demands(spark, folder).where("job_title is not null and source_subject is not null").select("job_id", "job_title", "source_subject").distinct()
    d = d.withColumn("t", F.filter(X.words(F.col("job_title")), lambda x: F.length(x) >= 3)).withColumn("s", ascii_lower(F.col("source_subject"))).where(F.size("t") > 0)
    return d.select("job_id", "job_title", "source_subject", F.round(F.size(F.filter("t", lambda x: F.contains(F.col("s"), x))) / F.size("t"), 4).alias("support"))


@query(
    "table_reconcile",
    """WITH m AS (SELECT job_id, payload_json->>'$.job_title' AS stored_title FROM metaforge_requirements WHERE json_valid(payload_json)), v AS (SELECT requirement_id, arg_max(payload_json, (version_number, id)) AS p FROM jd_versions WHERE json_valid(payload_json) GROUP BY 1)
        SELECT CASE WHEN v.p IS NULL THEN 'stored only' WHEN stored_title IS NOT DISTINCT FROM (v.p->>'$.job_title') THEN 'agree' WHEN stored_title IS NULL OR (v.p->>'$.job_title') IS NULL THEN 'one side' ELSE 'conflict' END AS verdict, count(*) AS n FROM m LEFT JOIN v ON v.requirement_id = m.job_id GROUP BY 1""",
)
def table_reconcile(spark, folder):
    """Two sources of one field: agree, one-sided or in conflict."""
    valid = F.try_parse_json("payload_json").isNotNull()
    m = stored(spark, folder).where(valid).select("job_id", F.get_json_object("payload_json", "$.job_title").alias("stored_title"))
    v = table(spark, folder, "jd_versions").where(valid).groupBy(F.col("requirement_id").alias("job_id")).agg(F.max_by("payload_json", F.struct("version_number", "id")).alias("p"))
    j = m.join(v, "job_id", "left").withColumn("t", F.get_json_object("p", "$.job_title"))
    verdict = F.when(F.col("p").isNull(), "stored only").when(F.col("stored_title").eqNullSafe(F.col("t")), "agree").when(F.col("stored_title").isNull() | F.col("t").isNull(), "one side").otherwise("conflict")
    return j.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("holdout_split", "SELECT lang IS NULL AS no_lang, abs(doc_id * 2654435761 % 1000) < 200 AS is_holdout, count(*) AS docs FROM documents GROUP BY 1, 2")
def holdout_split(spark, folder):
    """A holdout by a hash of the key, the same in every run and at every size."""
    held = F.abs((F.col("doc_id") * F.lit(2_654_435_761)) % 1000) < 200
    return table(spark, folder, "documents").groupBy(F.col("lang").isNull().alias("no_lang"), held.alias("is_holdout")).agg(F.count("*").alias("docs"))


#: Weights of a pair's fields, and the score under which a sample's field counts as low (fixed values).
WEIGHTS = {"job_title": 0.4, "experience": 0.2, "skills": 0.2, "location": 0.2}
LOW = 0.8
#: Fields compared as sets of tokens, and fields that may be invented: filled where the expected record has none.
SETS, INVENTED = ("skills", "location"), ("budget", "positions")


def _filled(c: str):
    return F.coalesce(normal_form(F.col(c)), F.lit(""))


def field_scores(expected: str, actual: str) -> dict:
    """Similarity of each field of two prefixed records: by edits, of SETS by tokens; 1 where both are empty."""

    def by_edits(f):
        a, b = _filled(f"{expected}{f}"), _filled(f"{actual}{f}")
        return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))

    by_tokens = lambda f: F.coalesce(X.jaccard(*[X.tokens(_filled(f"{x}{f}")) for x in (expected, actual)]), F.lit(1.0))
    return {f: by_tokens(f) if f in SETS else by_edits(f) for f in WEIGHTS}


def evaluated(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per sample of expected and actual (client, day, id and the fields of WEIGHTS and INVENTED):
    how many records each side has and how many were matched, each field's score, and where
    the sample fails.

    All records of a sample meet, are scored by the weighted fields and matched greedily.
    Scores are divided by the larger side, so what is left unmatched counts 0. A sample takes
    as many comparisons as its sides multiply to. Ids are unique within a sample's side.
    """
    key = ["client", "day"]
    side = lambda df, x: df.where("client is not null and day is not null and id is not null").select(F.concat_ws("|", "client", "day").alias("sample"), *key, *[F.col(c).alias(f"{x}_{c}") for c in ("id", *WEIGHTS, *INVENTED)])
    e, a = cut(side(expected, "e")), cut(side(actual, "a"))
    scores = field_scores("e_", "a_")
    # fields that the actual record has and the expected one lacks
    invented = lambda pre: sum(((_filled(f"a_{f}") != "") & (_filled(f"e_{f}") == "") if pre else _filled(f"a_{f}") != "").cast("int") for f in INVENTED)
    pairs = e.join(a.drop(*key), "sample").select("sample", "e_id", "a_id", F.col("e_job_title").alias("expected"), F.col("a_job_title").alias("actual"), *[s.alias(f) for f, s in scores.items()], invented(True).alias("invented"))
    pairs = cut(pairs.withColumn("score", sum(F.col(f) * w for f, w in WEIGHTS.items())))
    size = pairs.groupBy("sample").agg(F.count("*").alias("n"))
    # samples of one pair need no choice
    sized = pairs.join(size, "sample")
    matched = sized.where("n = 1").drop("n").unionByName(greedy_matches(sized.where("n > 1").drop("n"), "sample", "e_id", "a_id", "score"))
    matched = cut(matched)
    best = F.max_by(F.struct("expected", "actual"), F.struct("score", "e_id"))
    sums = matched.groupBy("sample").agg(F.count("*").alias("matched"), *[F.sum(f).alias(f) for f in WEIGHTS], F.sum("invented").alias("invented"), best.alias("best"))
    left = a.join(matched.select("sample", "a_id"), ["sample", "a_id"], "left_anti").groupBy("sample").agg(F.sum(invented(False)).alias("unmatched_invented"))
    n = e.groupBy("sample", *key).agg(F.count("*").alias("n_expected")).join(a.groupBy("sample", *key).agg(F.count("*").alias("n_actual")), ["sample", *key], "full")
    n = n.join(sums, "sample", "left").join(left, "sample", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    n = n.withColumns({c: zero(F.col(c)) for c in ("n_expected", "n_actual", "matched")})
    n = n.withColumns({f: F.round(F.coalesce(F.col(f), F.lit(0.0)) / F.greatest("n_expected", "n_actual"), 6) for f in WEIGHTS})
    n = n.withColumn("invented", zero(F.col("invented")) + zero(F.col("unmatched_invented"))).withColumn("low_fields", F.concat_ws(",", *[F.when(F.col(f) < LOW, f) for f in WEIGHTS]))
    return n.select(*key, "n_expected", "n_actual", "matched", *WEIGHTS, "invented", "low_fields", ((F.col("low_fields") != "") | (F.col("invented") > 0)).alias("is_failure"), F.col("best.expected").alias("expected"), F.col("best.actual").alias("actual"))


@query("greedy_eval")
def greedy_eval(spark, folder):
    """The demands of a client and day against the stored requirements of the same, matched greedily by four weighted fields; each sample's scores and whether it fails (no oracle: greedy choice; brute force in the tests)."""
    row = lambda *c: F.concat_ws("|", "job_id", F.xxhash64(*c))
    d = demands(spark, folder).where("job_id is not null").select("job_id", normal_form(F.col("requirement_from")).alias("client"), F.substring("source_received_time", 1, 10).alias("day"), "job_title", F.col("overall_experience").alias("experience"), F.col("mandatory_skills").alias("skills"), "location", F.col("yearly_budget").alias("budget"), F.col("number_of_positions").cast("string").alias("positions"))
    of = lambda f: F.get_json_object("payload_json", f"$.{f}")
    skills = F.coalesce(F.array_join(F.from_json(of("mandatory_skills"), "array<string>"), ","), of("mandatory_skills"))
    s = stored(spark, folder).where("job_id is not null").select("job_id", normal_form(of("requirement_from")).alias("client"), F.translate("req_date", "/", "-").alias("day"), of("job_title").alias("job_title"), of("overall_experience").alias("experience"), skills.alias("skills"), of("location").alias("location"), of("yearly_budget").alias("budget"), of("number_of_positions").alias("positions"))
    d, s = (df.distinct().withColumn("id", row(*[F.coalesce(F.col(c), F.lit("\0")) for c in df.columns])) for df in (d, s))
    return evaluated(d, s)


@query("greedy_eval_summary")
def greedy_eval_summary(spark, folder):
    """V5: means of greedy_eval over all samples (no oracle, as greedy_eval has none)."""
    r = greedy_eval(spark, folder)
    mean = lambda c, name: F.round(F.avg(c), 6).alias(name)
    return r.agg(F.count("*").alias("samples"), mean(sum(F.col(f) for f in WEIGHTS) / len(WEIGHTS), "overall_accuracy"), *[mean(f, f"{f}_accuracy") for f in WEIGHTS], mean("invented", "invented_rate"), F.count_if("is_failure").alias("failures"))
