"""Queries on pairs and groups of records: per-field scores, title families, histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions import extract as X
from lodestream.functions.text import normal_form
from lodestream.functions.values import placeholder_list, real_or_null
from lodestream.operators import resolve as R
from lodestream.operators.slices import before, id_place
from lodestream.plans.base import query
from lodestream.plans.matching import _NUMERIC, _TOKENS, _WORDS, _range_sql, demands, mails, stored, versions
from lodestream.plans.texts import LOWER, NORM
from lodestream.sources.tables import table

#: Words of titles that tell seniority, and words that tell nothing of the role.
SENIOR, NOISE = ("junior", "jr", "senior", "sr", "lead", "principal", "staff", "head", "trainee"), ("the", "a", "an", "of", "for", "and", "with", "in", "at", "role", "position", "job", "opening", "urgent")
_FILLED = ("location", "work_mode", "employment_type", "notice_period", "overall_experience", "yearly_budget", "mandatory_skills")


@query(
    "history_fields",
    f"""WITH d AS (SELECT DISTINCT job_id, {NORM.format('requirement_from')} AS client, {NORM.format('job_title')} AS title, {', '.join(_FILLED)} FROM final_corrected_requirements WHERE job_id IS NOT NULL),
        r AS (SELECT job_id, client, title, {', '.join(f"CASE WHEN {LOWER.format(f'trim({f})')} NOT IN (SELECT placeholder FROM placeholder_values) THEN {f} END AS {f}" for f in _FILLED)} FROM d WHERE client IS NOT NULL AND title IS NOT NULL),
        w AS (SELECT job_id, {', '.join(f'{f}, last_value({f} IGNORE NULLS) OVER w AS was_{f}' for f in _FILLED)} FROM r WINDOW w AS (PARTITION BY client, title ORDER BY job_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        """ + " UNION ALL ".join(f"SELECT job_id, '{f}' AS field, was_{f} AS filled, 0.65::DOUBLE AS confidence FROM w WHERE {f} IS NULL AND was_{f} IS NOT NULL" for f in _FILLED),
)
def history_fields(spark, folder):
    """Seven fields of a record from the latest earlier real value of the same client and title."""
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    d = demands(spark, folder).where("job_id is not null").select("job_id", normal_form(F.col("requirement_from")).alias("client"), normal_form(F.col("job_title")).alias("title"), *_FILLED).distinct()
    d = d.where("client is not null and title is not null").select("job_id", "client", "title", *[real_or_null(F.col(f), placeholders).alias(f) for f in _FILLED])
    d = before(d, ["client", "title"], ["job_id"], {f"was_{f}": f for f in _FILLED}, id_place(F.col("job_id")), real=True)
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.when(F.col(f).isNull(), F.col(f"was_{f}")).alias("filled")) for f in _FILLED])
    return d.select("job_id", F.explode(each).alias("x")).where("x.filled is not null").select("job_id", "x.field", "x.filled", F.lit(0.65).alias("confidence"))


@query(
    "merged_histories",
    """WITH k AS (SELECT requirement_id, arg_max(id, (version_number, id)) AS kept_id FROM jd_versions WHERE requirement_id IS NOT NULL GROUP BY 1)
        SELECT DISTINCT requirement_id, kept_id, created_at, source_email_id FROM k JOIN jd_versions USING (requirement_id)""",
)
def merged_histories(spark, folder):
    """The version that stays, with the changes of all versions merged, each (time, source) once; a row for each, so no history is gathered in one place."""
    v = versions(spark, folder).where("requirement_id is not null").select("requirement_id", "id", "version_number", "created_at", "source_email_id")
    kept = v.groupBy("requirement_id").agg(F.max_by("id", F.struct("version_number", "id")).alias("kept_id"))
    return v.join(kept, "requirement_id").select("requirement_id", "kept_id", "created_at", "source_email_id").distinct()


_PICK = "CASE WHEN contains(subject, client_jd_id) THEN 0 WHEN contains(" + LOWER.format("subject") + ", " + LOWER.format("title") + ") THEN 1 ELSE 2 END"


@query(
    "conversation_records",
    f"""WITH v AS (SELECT source_email_id AS graph_id, requirement_id AS ref, client_jd_id, CASE WHEN json_valid(payload_json) THEN payload_json->>'$.job_title' END AS title FROM jd_versions WHERE requirement_id IS NOT NULL),
        h AS (SELECT source_email_id AS graph_id, job_id AS ref, client_jd_id, title FROM (SELECT job_id, client_jd_id, CASE WHEN json_valid(payload_json) THEN payload_json->>'$.job_title' END AS title, unnest(regexp_extract_all(field_change_history, '"source_email_id": *"([^"]+)"', 1)) AS source_email_id FROM metaforge_requirements WHERE job_id IS NOT NULL)),
        m AS (SELECT DISTINCT graph_id, conversation_id, subject FROM outlook_messages WHERE conversation_id IS NOT NULL)
        SELECT conversation_id, count(DISTINCT ref) AS refs, arg_min(ref, ({_PICK}, ref)) AS picked FROM (SELECT * FROM v UNION ALL SELECT * FROM h) JOIN m USING (graph_id) GROUP BY 1""",
)
def conversation_records(spark, folder):
    """The records that came from a conversation's mails by versions or change histories, and one picked: by id in the subject, by title in it, else the first."""
    title = F.get_json_object("payload_json", "$.job_title")
    v = versions(spark, folder).where("requirement_id is not null").select(F.col("source_email_id").alias("graph_id"), F.col("requirement_id").alias("ref"), "client_jd_id", title.alias("title"))
    sources = F.explode(F.regexp_extract_all("field_change_history", F.lit('"source_email_id": *"([^"]+)"'), F.lit(1)))
    h = stored(spark, folder).where("job_id is not null").select(sources.alias("graph_id"), F.col("job_id").alias("ref"), "client_jd_id", title.alias("title"))
    m = mails(spark, folder).where("conversation_id is not null").select("graph_id", "conversation_id", "subject").distinct()
    from lodestream.functions.text import ascii_lower

    pick = F.when(F.contains("subject", "client_jd_id"), 0).when(F.contains(ascii_lower(F.col("subject")), ascii_lower(F.col("title"))), 1).otherwise(2)
    return v.unionByName(h).join(m, "graph_id").groupBy("conversation_id").agg(F.countDistinct("ref").alias("refs"), F.min_by("ref", F.struct(pick.alias("rank"), "ref")).alias("picked"))


_ROLE = f"list_filter({_WORDS.format('title')}, lambda x: NOT list_contains({list(SENIOR + NOISE)}, x))"


def _role(c):
    return F.filter(X.words(c), lambda x: ~x.isin(*SENIOR, *NOISE))


@query(
    "title_families",
    f"""WITH d AS (SELECT DISTINCT job_id, {NORM.format('requirement_from')} AS client, source_subject AS mail, {NORM.format('job_title')} AS title FROM final_corrected_requirements WHERE job_id IS NOT NULL AND source_subject IS NOT NULL AND requirement_from IS NOT NULL AND job_title IS NOT NULL),
        t AS (SELECT job_id, client, mail, {_ROLE} AS role FROM d),
        p AS (SELECT a.job_id, min(b.job_id) AS earlier FROM t a JOIN t b ON a.client = b.client AND a.mail = b.mail AND b.job_id < a.job_id AND len(list_intersect(a.role, b.role)) > 0
          AND (len(list_intersect(a.role, b.role)) = least(len(a.role), len(b.role)) OR len(list_intersect(a.role, b.role)) >= 0.5 * len(list_distinct(list_concat(a.role, b.role)))) GROUP BY 1)
        SELECT t.job_id, p.earlier, p.earlier IS NOT NULL AS collapses FROM t LEFT JOIN p USING (job_id)""",
)
def title_families(spark, folder):
    """Within one source mail and client, records whose titles are of one family with an earlier one: one's role words hold the other's, or half of both are common.

    Distinct role sets meet, on their rarest word against any word of the other: families share it, or
    share one of the rarest half."""
    d = demands(spark, folder).where("job_id is not null and source_subject is not null and requirement_from is not null and job_title is not null")
    t = d.select("job_id", F.struct(normal_form(F.col("requirement_from")).alias("client"), F.col("source_subject").alias("mail")).alias("grp"), F.array_sort(_role(normal_form(F.col("job_title")))).alias("role")).distinct()
    sets = t.groupBy("grp", "role").agg(F.min("job_id").alias("first")).withColumn("key", F.struct("grp", "role"))
    some = sets.where(F.size("role") > 0)
    # both sides by all words of a set that has few: a mail's sets are small and few words repeat
    words = some.select("grp", "role", "first", F.explode("role").alias("word"))
    rare = R.prefix_entries(some, "key", "grp", F.col("role"), F.size("role") - F.ceil(F.size("role") * 0.5) + 1).select(F.col("key.grp").alias("grp"), F.col("key.role").alias("role_a"), F.col("item").alias("word"))
    met = rare.join(words.select("grp", "word", F.col("role").alias("role_b"), F.col("first").alias("first_b")), ["grp", "word"]).select("grp", "role_a", "role_b", "first_b")
    both = met.unionByName(met.select("grp", F.col("role_b").alias("role_a"), F.col("role_a").alias("role_b"), F.lit(None).cast("string").alias("first_b"))).groupBy("grp", "role_a", "role_b").agg(F.max("first_b").alias("first_b"))
    both = both.drop("first_b").join(some.select("grp", F.col("role").alias("role_b"), F.col("first").alias("first_b")), ["grp", "role_b"])
    common = F.size(F.array_intersect("role_a", "role_b"))
    kin = both.where((common == F.least(F.size("role_a"), F.size("role_b"))) | (common >= 0.5 * F.size(F.array_union("role_a", "role_b"))))
    # a set is kin to itself, so its first record counts for the later ones
    firsts = kin.select("grp", F.col("role_a").alias("role"), "first_b").unionByName(some.select("grp", "role", F.col("first").alias("first_b"))).groupBy("grp", "role").agg(F.min("first_b").alias("first_b"))
    out = t.join(firsts, ["grp", "role"], "left")
    out = out.groupBy("job_id").agg(F.min(F.when(F.col("first_b") < F.col("job_id"), F.col("first_b"))).alias("earlier"))
    return out.select("job_id", "earlier", F.col("earlier").isNotNull().alias("collapses"))



def _side(key: str, ref: str, source: str) -> str:
    """SQL of one side of pair_scores."""
    j = lambda f: f"(payload_json->>'$.{f}')"
    return f"""SELECT DISTINCT {key} AS k, {ref} AS ref, {NORM.format(j('job_title'))} AS title, {j('mandatory_skills')} AS skills, {j('overall_experience')} AS years, {LOWER.format(j('work_mode'))} AS mode, try_cast({j('number_of_positions')} AS INT) AS n
        FROM (SELECT * FROM {source} WHERE json_valid(payload_json)) WHERE {key} IS NOT NULL"""


def _jac(a: str, b: str) -> str:
    return f"(len(list_intersect({a}, {b})) / nullif(len(list_distinct(list_concat({a}, {b}))), 0))"


_LA, _LB = _range_sql("a.years"), _range_sql("b.years")
_SENIORITY = "list_sort(list_filter({}, lambda x: list_contains(" + str(list(SENIOR)) + ", x)))"
_WA, _WB = _WORDS.format("a.title"), _WORDS.format("b.title")
_KA, _KB = _WORDS.format(LOWER.format("a.skills")), _WORDS.format(LOWER.format("b.skills"))
_PAIR_SQL = f"""WITH a AS ({_side('requirement_id', 'id', 'jd_versions')}), b AS ({_side('job_id', 'job_id', 'metaforge_requirements')}),
    p AS (SELECT a.ref AS version_id, b.ref AS job_id, coalesce({_jac(_WA, _WB)}, 0) AS words, 1 - levenshtein(a.title, b.title) / greatest(length(a.title), length(b.title), 1) AS edit, {_jac(_KA, _KB)} AS skill_words,
        {_SENIORITY.format(_WA)} = {_SENIORITY.format(_WB)} AS same_seniority, {_NUMERIC.format(_WA)} = {_NUMERIC.format(_WB)} AS same_numerals,
        CASE WHEN a.n > 0 AND b.n > 0 THEN least(a.n, b.n) / greatest(a.n, b.n) END AS positions, CASE WHEN a.mode IS NOT NULL AND b.mode IS NOT NULL THEN (a.mode = b.mode)::INT::DOUBLE END AS mode,
        {_LA[0]} AS l1, {_LA[1]} AS h1, {_LB[0]} AS l2, {_LB[1]} AS h2 FROM a JOIN b ON a.k = b.k WHERE a.title IS NOT NULL AND b.title IS NOT NULL)
    SELECT version_id, job_id, round(words, 4) AS words, round(edit, 4) AS edit, round(skill_words, 4) AS skill_words, same_seniority, same_numerals, round(positions, 4) AS positions, mode,
        round((coalesce(positions, 0) + coalesce(mode, 0)) / nullif((positions IS NOT NULL)::INT + (mode IS NOT NULL)::INT, 0), 4) AS others,
        round(CASE WHEN l1 IS NOT NULL AND l2 IS NOT NULL THEN greatest(0.0, (least(greatest(l1, coalesce(h1, l1 + {X.OPEN_YEARS})), greatest(l2, coalesce(h2, l2 + {X.OPEN_YEARS}))) - greatest(l1, l2) + 1) / (greatest(l1, coalesce(h1, l1 + {X.OPEN_YEARS}), l2, coalesce(h2, l2 + {X.OPEN_YEARS})) - least(l1, l2) + 1)) END, 4) AS years FROM p"""


@query("pair_scores", _PAIR_SQL)
def pair_scores(spark, folder):
    """The scores of each version and the stored record that it belongs to, field by field."""
    from lodestream.functions.text import ascii_lower

    j = lambda f: F.get_json_object("payload_json", f"$.{f}")

    def side(rows, key, ref, x):
        rows = rows.where(F.try_parse_json("payload_json").isNotNull() & F.col(key).isNotNull())
        return rows.select(F.col(key).alias("k"), F.col(ref[0]).alias(ref[1]), normal_form(j("job_title")).alias(f"t{x}"), j("mandatory_skills").alias(f"s{x}"), j("overall_experience").alias(f"y{x}"), ascii_lower(j("work_mode")).alias(f"m{x}"), j("number_of_positions").try_cast("int").alias(f"n{x}")).where(f"t{x} is not null").distinct()

    p = side(versions(spark, folder), "requirement_id", ("id", "version_id"), "a").join(side(stored(spark, folder), "job_id", ("job_id", "job_id"), "b"), "k")
    wa, wb = X.words(F.col("ta")), X.words(F.col("tb"))
    only = lambda w, keep: F.array_sort(F.filter(w, keep))
    seniority = lambda w: only(w, lambda x: x.isin(*SENIOR))
    numerals = lambda w: only(w, lambda x: x.rlike(R.NUMERAL))
    edit = 1 - F.levenshtein("ta", "tb") / F.greatest(F.length("ta"), F.length("tb"), F.lit(1))
    positions = F.when((F.col("na") > 0) & (F.col("nb") > 0), F.least("na", "nb") / F.greatest("na", "nb"))
    mode = F.when(F.col("ma").isNotNull() & F.col("mb").isNotNull(), (F.col("ma") == F.col("mb")).cast("int").cast("double"))
    ya, yb = X.number_range(F.col("ya")), X.number_range(F.col("yb"))
    others = F.try_divide(F.coalesce(positions, F.lit(0.0)) + F.coalesce(mode, F.lit(0.0)), positions.isNotNull().cast("int") + mode.isNotNull().cast("int"))
    r = lambda c: F.round(c, 4)
    return p.select(
        "version_id", "job_id", r(F.coalesce(X.jaccard(wa, wb), F.lit(0.0))).alias("words"), r(edit).alias("edit"), r(X.jaccard(X.words(F.col("sa")), X.words(F.col("sb")))).alias("skill_words"),
        (seniority(wa) == seniority(wb)).alias("same_seniority"), (numerals(wa) == numerals(wb)).alias("same_numerals"), r(positions).alias("positions"), mode.alias("mode"), r(others).alias("others"),
        r(X.overlap(ya["low"], ya["high"], yb["low"], yb["high"])).alias("years"),
    )


@query(
    "text_scores",
    f"""WITH v AS (SELECT DISTINCT requirement_id, id, version_number, {NORM.format('job_description')} AS t FROM jd_versions WHERE requirement_id IS NOT NULL AND job_description IS NOT NULL), l AS (SELECT *, lag(t) OVER (PARTITION BY requirement_id ORDER BY version_number, id) AS p FROM v)
        SELECT requirement_id, id, t = p AS is_equal, round(CASE WHEN t = p THEN 1 ELSE {_jac(_WORDS.format('t'), _WORDS.format('p'))} END, 4) AS score FROM l WHERE p IS NOT NULL""",
)
def text_scores(spark, folder):
    """The whole text of each version against the one before: 1 if their normal forms are equal, else the words they share."""
    v = versions(spark, folder).where("requirement_id is not null and job_description is not null").select("requirement_id", "id", "version_number", normal_form(F.col("job_description")).alias("t")).distinct()
    v = before(v, ["requirement_id"], ["version_number", "id"], {"p": "t"}).where("p is not null")
    equal = F.col("t") == F.col("p")
    return v.select("requirement_id", "id", equal.alias("is_equal"), F.round(F.when(equal, 1.0).otherwise(X.jaccard(X.words(F.col("t")), X.words(F.col("p")))), 4).alias("score"))
