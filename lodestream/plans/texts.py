"""Queries on texts: normal forms, gates, segmentation, extraction (SURVEY N, G, SG, X, C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestream.functions import extract as X
from lodestream.functions import text as N
from lodestream.functions.values import placeholder_list, real_or_null
from lodestream.plans.base import query
from lodestream.sources.tables import table

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NORM = "trim(regexp_replace(" + LOWER + ", '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"
PLACEHOLDERS = "(SELECT placeholder FROM placeholder_values)"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def mails(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "outlook_messages")


def demands(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "final_corrected_requirements")


@query("text_normalize", f"SELECT doc_id, {NORM.format('text')} AS norm FROM documents WHERE text IS NOT NULL")
def text_normalize(spark, folder):
    """One normal form of every text."""
    return documents(spark, folder).where("text is not null").select("doc_id", N.normal_form(F.col("text")).alias("norm"))


@query(
    "text_fingerprint_dedup",
    f"""WITH n AS (SELECT doc_id, lang, source, substr(sha256({NORM.format('text')}), 1, 16) AS fp FROM documents
        WHERE text IS NOT NULL AND regexp_matches(text, '(?i)(experience|skills|location|position|role|budget|notice)')),
        k AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY doc_id) AS rn FROM n)
        SELECT coalesce(lang, '') AS lang, source, count(*) AS docs FROM k WHERE rn = 1 GROUP BY ALL""",
)
def text_fingerprint_dedup(spark, folder):
    """Texts of the domain, the first of each fingerprint, by language and source.

    The first of a fingerprint is an aggregate, not a window, so copies meet combined."""
    d = documents(spark, folder).where("text is not null").where(F.col("text").rlike("(?i)(experience|skills|location|position|role|budget|notice)"))
    d = d.select("doc_id", "lang", "source", N.fingerprint(F.col("text")).alias("fp"))
    first = d.groupBy("fp").agg(F.min_by(F.struct("lang", "source"), "doc_id").alias("x"))
    return first.groupBy(F.coalesce("x.lang", F.lit("")).alias("lang"), F.col("x.source").alias("source")).agg(F.count("*").alias("docs"))


@query(
    "pii_scrub",
    f"""SELECT graph_id, md5(regexp_replace(regexp_replace(body_plain, '{N.EMAIL}', '[email]', 'g'), '{N.PHONE}', '[phone]', 'g')) AS scrubbed,
        len(list_distinct(regexp_extract_all(body_plain, '{N.EMAIL}')))::BIGINT AS addresses FROM outlook_messages WHERE body_plain IS NOT NULL""",
)
def pii_scrub(spark, folder):
    """Redacted bodies, and how many addresses they held."""
    found = F.array_distinct(F.regexp_extract_all("body_plain", F.lit(N.EMAIL), F.lit(0)))
    return mails(spark, folder).where("body_plain is not null").select("graph_id", F.md5(N.scrubbed(F.col("body_plain"))).alias("scrubbed"), F.size(found).cast("bigint").alias("addresses"))


_CORE = "trim(regexp_replace(" + LOWER.format(f"regexp_replace(subject, '{N.PREFIX}', '')") + ", '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"


@query(
    "subject_threads",
    f"""SELECT {_CORE} AS subject_core, count(*) AS mails, count(DISTINCT conversation_id) AS conversations, sum(CASE WHEN regexp_matches(subject, '(?i)^[ \\t]*(fw|fwd|wg|tr)[ \\t]*:') THEN 1 ELSE 0 END)::BIGINT AS forwards
        FROM outlook_messages WHERE subject IS NOT NULL AND length({_CORE}) >= 5 GROUP BY 1""",
)
def subject_threads(spark, folder):
    """Subjects without prefixes, and what they gather."""
    m = mails(spark, folder).where("subject is not null").withColumn("subject_core", N.subject_core(F.col("subject"))).where(F.length("subject_core") >= 5)
    forward = F.col("subject").rlike(r"(?i)^[ \t]*(fw|fwd|wg|tr)[ \t]*:")
    return m.groupBy("subject_core").agg(F.count("*").alias("mails"), F.countDistinct("conversation_id").alias("conversations"), F.sum(forward.cast("bigint")).alias("forwards"))


@query(
    "reply_history_cut",
    r"""SELECT graph_id, md5(regexp_replace(body_plain, '(?s)(^|\n)[>| ]*(From:|Von:|-----|_{10,}|Begin forwarded message).*$', '')) AS head FROM outlook_messages WHERE body_plain IS NOT NULL""",
)
def reply_history_cut(spark, folder):
    """Bodies up to the first header of quoted history."""
    return mails(spark, folder).where("body_plain is not null").select("graph_id", F.md5(N.unquoted_head(F.col("body_plain"))).alias("head"))


@query(
    "boilerplate_lines",
    f"""WITH l AS (SELECT doc_id, client_name, trim(regexp_replace(regexp_replace({LOWER.format('u.line')}, '[ \\t\\n\\r\\f]+', ' ', 'g'), '[0-9]+', '#', 'g'), ' ') AS line
        FROM documents, unnest(string_split(text, chr(10))) AS u(line) WHERE text IS NOT NULL)
        SELECT client_name, line, count(DISTINCT doc_id) AS docs FROM l WHERE length(line) >= 4 GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3""",
)
def boilerplate_lines(spark, folder):
    """Lines that three or more texts of a client share.

    Distinct (document, line) pairs are combined first, so a line in all texts is no hot key."""
    line = F.trim(F.regexp_replace(F.regexp_replace(N.ascii_lower(F.col("line")), N.SPACE + "+", " "), "[0-9]+", "#"))
    d = documents(spark, folder).where("text is not null").select("doc_id", "client_name", F.explode(N.lines(F.col("text"))).alias("line")).withColumn("line", line).where(F.length("line") >= 4)
    # the line's hash travels instead of its text; the text is the least one of the hash
    d = d.groupBy("client_name", F.xxhash64("line").alias("h"), "doc_id").agg(F.min("line").alias("line"))
    return d.groupBy("client_name", "h").agg(F.min("line").alias("line"), F.count("*").alias("docs")).where("docs >= 3").drop("h")


@query(
    "invisible_chars",
    "SELECT doc_id, (length(text) - length(translate(text, chr(8203) || chr(8204) || chr(8205) || chr(8288) || chr(65279) || chr(173), '')))::BIGINT AS removed FROM documents WHERE text IS NOT NULL",
)
def invisible_chars(spark, folder):
    """How many invisible characters a text holds."""
    t = F.col("text")
    return documents(spark, folder).where("text is not null").select("doc_id", (F.length(t) - F.length(N.visible(t))).cast("bigint").alias("removed"))


@query(
    "bullet_points",
    r"""WITH b AS (SELECT doc_id, list_transform(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[ \t]*[-*•][ \t]+[^ ]')), lambda x: trim(regexp_replace(x, '^[ \t]*[-*•][ \t]+', ''), ' ')) AS b FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, len(list_distinct(b))::BIGINT AS bullets, sum(length(x))::BIGINT AS chars FROM (SELECT doc_id, b, unnest(list_distinct(b)) AS x FROM b) GROUP BY doc_id, b""",
)
def bullet_points(spark, folder):
    """SG12, N16: distinct bullets of a text, all of them."""
    b = documents(spark, folder).where("text is not null").select("doc_id", N.bullets(F.col("text"), 1 << 30).alias("b")).where(F.size("b") > 0)
    return b.select("doc_id", F.size("b").cast("bigint").alias("bullets"), F.aggregate("b", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("chars"))


_MARKERS = [r"(?i)unsubscribe", r"(?i)newsletter", r"(?i)special offer", r"(?i)webinar", r"(?i)click here", r"(?i)limited (?:time|seats)", r"(?i)\bdiscounts?\b", r"(?i)view (?:this )?in (?:your )?browser"]

#: The domains of the addresses that are put in copy: those of the desk itself.
INTERNAL = f"(SELECT DISTINCT {LOWER.format('split_part(x, chr(64), 2)')} FROM (SELECT unnest(cc_recipients) AS x FROM outlook_messages) WHERE x LIKE '%@_%')"


def internal_domains(spark: SparkSession, folder: str) -> DataFrame:
    """domain: the same as a table."""
    x = mails(spark, folder).select(F.explode("cc_recipients").alias("x")).where("x like '%@_%'")
    return x.select(N.ascii_lower(F.split_part("x", F.lit("@"), F.lit(2))).alias("domain")).distinct()


@query(
    "gate_decisions",
    f"""WITH f AS (SELECT from_email, subject, coalesce(body_plain, '') AS b FROM outlook_messages), g AS (SELECT CASE
        WHEN from_email IS NULL OR NOT regexp_matches(from_email, '^{N.EMAIL}$') THEN 'malformed'
        WHEN {LOWER.format("split_part(from_email, '@', 2)")} IN {INTERNAL} AND NOT regexp_matches(coalesce(subject, ''), '(?i)^ *(fw|fwd) *:') THEN 'internal'
        WHEN {' + '.join(f"regexp_matches(b, '{m}')::INT" for m in _MARKERS)} >= 2 THEN 'marked'
        WHEN regexp_matches(b, '(?i)(experience|openings|positions|location)') THEN 'accepted' ELSE 'unstructured' END AS decision FROM f)
        SELECT decision, count(*) AS mails FROM g GROUP BY 1""",
)
def gate_decisions(spark, folder):
    """Ordered gates give each mail one decision; none is dropped, so the ledger stays complete."""
    b = F.coalesce("body_plain", F.lit(""))
    inner = F.coalesce("inner", F.lit(False))
    decision = (
        F.when(F.col("from_email").isNull() | ~F.col("from_email").rlike(f"^{N.EMAIL}$"), "malformed")
        .when(inner & ~F.coalesce("subject", F.lit("")).rlike("(?i)^ *(fw|fwd) *:"), "internal")
        .when(X.hits(b, _MARKERS) >= 2, "marked")
        .when(b.rlike("(?i)(experience|openings|positions|location)"), "accepted")
        .otherwise("unstructured")
    )
    m = mails(spark, folder).withColumn("domain", N.ascii_lower(F.split_part("from_email", F.lit("@"), F.lit(2))))
    m = m.join(internal_domains(spark, folder).withColumn("inner", F.lit(True)), "domain", "left")
    return m.groupBy(decision.alias("decision")).agg(F.count("*").alias("mails"))


_STATUS = [(r"(?i)\b(re-?open|reopened)\b", "reopen"), (r"(?i)\b(on hold|hold)\b", "hold"), (r"(?i)\b(closed|filled|cancelled)\b", "closed")]
_WHEN = " ".join(f"WHEN regexp_matches({{0}}, '{p}') THEN '{v}'" for p, v in _STATUS)


@query("status_keywords", f"SELECT graph_id, CASE {_WHEN.format('t')} ELSE 'none' END AS status FROM (SELECT graph_id, coalesce(subject, '') || ' ' || coalesce(body_plain, '') AS t FROM outlook_messages)")
def status_keywords(spark, folder):
    """A ladder of keywords, the first that fits."""
    t = F.concat(F.coalesce("subject", F.lit("")), F.lit(" "), F.coalesce("body_plain", F.lit("")))
    return mails(spark, folder).select("graph_id", F.coalesce(X.ladder(t, _STATUS), F.lit("none")).alias("status"))


@query(
    "digest_ids",
    r"""WITH i AS (SELECT graph_id, list_distinct(regexp_extract_all(coalesce(subject, '') || chr(10) || coalesce(body_plain, ''), '(?:demand|Demand|REQ|Req)[ #:-]*([0-9]{3,})', 1)) AS ids FROM outlook_messages)
        SELECT graph_id, len(ids)::BIGINT AS n_ids, list_aggregate(ids, 'min') AS least_id, len(ids) >= 2 AS is_digest FROM i WHERE len(ids) > 0""",
)
def digest_ids(spark, folder):
    """Request numbers in a mail; two or more make it a digest."""
    t = F.concat_ws("\n", F.coalesce("subject", F.lit("")), F.coalesce("body_plain", F.lit("")))
    m = mails(spark, folder).select("graph_id", F.array_distinct(F.regexp_extract_all(t, F.lit(r"(?:demand|Demand|REQ|Req)[ #:-]*([0-9]{3,})"), F.lit(1))).alias("ids")).where(F.size("ids") > 0)
    return m.select("graph_id", F.size("ids").cast("bigint").alias("n_ids"), F.array_min("ids").alias("least_id"), (F.size("ids") >= 2).alias("is_digest"))


@query(
    "numbered_blocks",
    r"""WITH l AS (SELECT graph_id, fetched_at, unnest(string_split(body_plain, chr(10))) AS line, generate_subscripts(string_split(body_plain, chr(10)), 1) AS n FROM outlook_messages WHERE body_plain IS NOT NULL)
        SELECT graph_id, n::BIGINT AS line_no, regexp_extract(line, '^[ \t]*([0-9]{1,3})[.)] +(.*[^ \r])', 1)::BIGINT AS block_no, regexp_extract(line, '^[ \t]*([0-9]{1,3})[.)] +(.*[^ \r])', 2) AS block_text
        FROM l WHERE regexp_matches(line, '^[ \t]*[0-9]{1,3}[.)] +.*[^ \r]')""",
)
def numbered_blocks(spark, folder):
    """SG1, SG6, X36: numbered items of a mail as rows."""
    p = r"^[ \t]*([0-9]{1,3})[.)] +(.*[^ \r])"
    m = mails(spark, folder).where("body_plain is not null").select("graph_id", F.posexplode(N.lines(F.col("body_plain"))).alias("n", "line")).where(F.col("line").rlike(p))
    return m.select("graph_id", (F.col("n") + 1).cast("bigint").alias("line_no"), F.regexp_extract("line", p, 1).cast("bigint").alias("block_no"), F.regexp_extract("line", p, 2).alias("block_text"))


_HEADERS = [("role|position|job title|title", "job_title"), ("city|location|work location", "location"), ("exp|experience|total experience", "experience"), ("count|openings|no. of positions", "positions"), ("budget", "budget"), ("notice|joining", "notice_period"), ("shift", "shift")]


@query(
    "pipe_table_fields",
    r"""WITH l AS (SELECT graph_id, unnest(string_split(body_plain, chr(10))) AS line FROM outlook_messages WHERE body_plain IS NOT NULL),
        c AS (SELECT graph_id, """ + LOWER.format(r"trim(regexp_extract(line, '^ *[|] *([A-Za-z. ]+?) *[|] *([^|]*[^| ]) *[|] *\r?$', 1))") + r""" AS k, regexp_extract(line, '^ *[|] *([A-Za-z. ]+?) *[|] *([^|]*[^| ]) *[|] *\r?$', 2) AS v FROM l
        WHERE regexp_matches(line, '^ *[|] *([A-Za-z. ]+?) *[|] *([^|]*[^| ]) *[|] *\r?$'))
        SELECT f.field, count(*) AS cells, count(DISTINCT graph_id) AS mails, count(DISTINCT v) AS values FROM c JOIN (VALUES """
    + ", ".join(f"('{name}', '{field}')" for names, field in _HEADERS for name in names.split("|"))
    + """) AS f(name, field) ON f.name = c.k GROUP BY 1""",
)
def pipe_table_fields(spark, folder):
    """SG2, SG4, H49: rows of tables in text, headers by synonyms from a small table."""
    p = r"^ *[|] *([A-Za-z. ]+?) *[|] *([^|]*[^| ]) *[|] *\r?$"
    m = mails(spark, folder).where("body_plain is not null").select("graph_id", F.explode(N.lines(F.col("body_plain"))).alias("line")).where(F.col("line").rlike(p))
    m = m.select("graph_id", N.ascii_lower(F.trim(F.regexp_extract("line", p, 1))).alias("k"), F.regexp_extract("line", p, 2).alias("v"))
    names = spark.createDataFrame([(n, f) for ns, f in _HEADERS for n in ns.split("|")], "k string, field string")
    return m.join(names, "k").groupBy("field").agg(F.count("*").alias("cells"), F.countDistinct("graph_id").alias("mails"), F.countDistinct("v").alias("values"))


_LABELS = {"location": ["Work location", "Location", "City"], "experience": ["Total experience", "Experience", "Exp"], "positions": ["No\\. of positions", "Openings", "Count"], "title": ["Job Title", "Position", "Role"]}


def _label_sql(labels: list[str]) -> str:
    one = "nullif(regexp_extract(body_plain, '(?i)(?:^|\\n)[ \\t*|>-]*{}[ \\t]*(?:[:=|]|-[ ])[ \\t]*([^\\n\\r|]*[^\\n\\r| ])', 1), '')"
    return "coalesce(" + ", ".join(one.format(x) for x in labels) + ")"


@query("label_values", "SELECT graph_id, " + ", ".join(f"{_label_sql(v)} AS {k}" for k, v in _LABELS.items()) + " FROM outlook_messages WHERE body_plain IS NOT NULL")
def label_values(spark, folder):
    """X1, X10, X11, X26, X37, SG13, SG15: the first value of each label, in the order of its synonyms."""
    lines = X.labelled_lines(F.col("body_plain"), [x for v in _LABELS.values() for x in v])
    m = mails(spark, folder).where("body_plain is not null").select("graph_id", lines.alias("lines"))
    return m.select("graph_id", *[X.label_value(F.col("lines"), v).alias(k) for k, v in _LABELS.items()])


_N = "([0-9]{1,2}(?:\\.[0-9])?)"
_RANGE = [f"regexp_extract(t, '{_N} *(?:-|–|to) *{_N}', {k})" for k in (1, 2)]
_LEAST = f"coalesce(nullif(regexp_extract(t, '{_N} *\\+', 1), ''), nullif(regexp_extract(t, '(?i)(?:min|minimum|at least|above|over)[a-z ]* {_N}', 1), ''))"
_MOST = f"nullif(regexp_extract(t, '(?i)(?:max|maximum|up ?to|below|under)[a-z ]* {_N}', 1), '')"


@query(
    "experience_ranges",
    f"""WITH x AS (SELECT DISTINCT overall_experience AS t FROM final_corrected_requirements WHERE overall_experience IS NOT NULL),
        p AS (SELECT t, try_cast(nullif({_RANGE[0]}, '') AS DOUBLE) AS lo, try_cast(nullif({_RANGE[1]}, '') AS DOUBLE) AS hi, try_cast({_LEAST} AS DOUBLE) AS le, try_cast({_MOST} AS DOUBLE) AS mo,
        try_cast(nullif(regexp_extract(t, '{_N}', 1), '') AS DOUBLE) AS one FROM x), r AS (
        SELECT t, CASE WHEN lo IS NOT NULL THEN lo WHEN le IS NOT NULL THEN le WHEN mo IS NULL THEN one END AS low, CASE WHEN lo IS NOT NULL THEN hi WHEN le IS NOT NULL THEN NULL WHEN mo IS NOT NULL THEN mo END AS high FROM p)
        SELECT t AS text, low, high, CASE WHEN low < 3 THEN 'Junior' WHEN low < 7 THEN 'Mid' WHEN low IS NOT NULL THEN 'Senior' END AS level FROM r""",
)
def experience_ranges(spark, folder):
    """Years from text, and their level."""
    d = demands(spark, folder).select(F.col("overall_experience").alias("text")).where("text is not null").distinct().withColumn("r", X.number_range(F.col("text")))
    return d.select("text", F.col("r.low").alias("low"), F.col("r.high").alias("high"), X.level_of_years(F.col("r.low")).alias("level"))


def _case(c: str, rungs) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN '{v}'" for p, v in rungs) + " END"


_ONE = "CASE WHEN " + " + ".join(f"regexp_matches(work_mode, '{p}')::INT" for p, _ in X.WORK_MODES) + f" = 1 THEN {_case('work_mode', X.WORK_MODES)} END"


@query(
    "vocabulary_fields",
    f"""SELECT job_id, {_ONE} AS work_mode, {_case('priority', X.PRIORITIES)} AS priority, {_case('employment_type', X.EMPLOYMENT)} AS employment_type, {_case('notice_period', X.NOTICE)} AS notice,
        CASE WHEN regexp_matches(notice_period, '(?i)^ *immediate *$') THEN 0 ELSE try_cast(nullif(regexp_extract(notice_period, '([0-9]{{1,3}}) *(?i:days?)', 1), '') AS INT) END AS notice_days
        FROM (SELECT DISTINCT job_id, work_mode, priority, employment_type, notice_period FROM final_corrected_requirements)""",
)
def vocabulary_fields(spark, folder):
    """Typed values as vocabulary."""
    d = demands(spark, folder).select("job_id", "work_mode", "priority", "employment_type", "notice_period").distinct()
    return d.select("job_id", X.only_one(F.col("work_mode"), X.WORK_MODES).alias("work_mode"), X.ladder(F.col("priority"), X.PRIORITIES).alias("priority"), X.ladder(F.col("employment_type"), X.EMPLOYMENT).alias("employment_type"), X.ladder(F.col("notice_period"), X.NOTICE).alias("notice"), X.notice_days(F.col("notice_period")).alias("notice_days"))


@query(
    "skill_counts",
    f"""WITH s AS (SELECT DISTINCT job_id, trim(regexp_replace({LOWER.format('u.s')}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ') AS skill FROM final_corrected_requirements, unnest(regexp_split_to_array(mandatory_skills, '[,;/|\\n•*]+')) AS u(s) WHERE mandatory_skills IS NOT NULL)
        SELECT skill, count(DISTINCT job_id) AS demands FROM s WHERE skill <> '' AND length(skill) <= 40 AND NOT regexp_matches(skill, '^[0-9 .+-]+$') GROUP BY 1""",
)
def skill_counts(spark, folder):
    """Lists in text as sets; noise left out."""
    d = demands(spark, folder).where("mandatory_skills is not null").select("job_id", F.explode(X.tokens(F.col("mandatory_skills"))).alias("skill"))
    d = d.where(F.length("skill") <= 40).where(~F.col("skill").rlike("^[0-9 .+-]+$")).distinct()
    return d.groupBy("skill").agg(F.count("*").alias("demands"))


@query(
    "tag_dictionary",
    f"""WITH t AS (SELECT tag FROM (SELECT DISTINCT job_id, trim(regexp_replace({LOWER.format('u.s')}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ') AS tag FROM final_corrected_requirements, unnest(regexp_split_to_array(mandatory_skills, '[,;/|\\n•*]+')) AS u(s) WHERE job_id IS NOT NULL) WHERE regexp_matches(tag, '^[a-z][a-z0-9+#]+$') GROUP BY 1 HAVING count(*) >= 5),
        d AS (SELECT doc_id, unnest(list_distinct(regexp_split_to_array({LOWER.format('text')}, '[^a-z0-9+#]+'))) AS tag FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)
        SELECT tag, count(*) AS docs FROM d JOIN t USING (tag) GROUP BY 1""",
)
def tag_dictionary(spark, folder):
    """A dictionary of technical words, those that five demands or more ask for, found in all texts by an equi-join on their words."""
    t = demands(spark, folder).where("job_id is not null").select("job_id", F.explode(X.tokens(F.col("mandatory_skills"))).alias("tag")).distinct()
    t = t.where(F.col("tag").rlike("^[a-z][a-z0-9+#]+$")).groupBy("tag").agg(F.count("*").alias("n")).where("n >= 5").select("tag")
    d = documents(spark, folder).where("text is not null and doc_id is not null").select(F.explode(F.array_distinct(F.split(N.ascii_lower(F.col("text")), "[^a-z0-9+#]+", -1))).alias("tag"))
    return d.groupBy("tag").agg(F.count("*").alias("docs")).join(t, "tag").select("tag", "docs")


@query(
    "placeholder_nulls",
    f"""SELECT count(*) AS n_rows, {', '.join(f"count(*) FILTER (WHERE {c} IS NOT NULL AND {LOWER.format(f'trim({c})')} NOT IN {PLACEHOLDERS})::BIGINT AS {c}" for c in ('location', 'job_title', 'yearly_budget', 'notice_period', 'client_poc', 'priority'))} FROM final_corrected_requirements""",
)
def placeholder_nulls(spark, folder):
    """How many real values each field has."""
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    return demands(spark, folder).agg(F.count("*").alias("n_rows"), *[F.count(real_or_null(F.col(c), placeholders)).alias(c) for c in ("location", "job_title", "yearly_budget", "notice_period", "client_poc", "priority")])


@query(
    "alias_coalesce",
    f"""SELECT job_id, coalesce(CASE WHEN {LOWER.format('trim(skills)')} NOT IN {PLACEHOLDERS} THEN skills END, CASE WHEN {LOWER.format('trim(mandatory_skills)')} NOT IN {PLACEHOLDERS} THEN mandatory_skills END) AS skills,
        coalesce(CASE WHEN {LOWER.format('trim(overall_experience)')} NOT IN {PLACEHOLDERS} THEN overall_experience END, CASE WHEN {LOWER.format('trim(experience_level)')} NOT IN {PLACEHOLDERS} THEN experience_level END) AS experience
        FROM (SELECT DISTINCT job_id, skills, mandatory_skills, overall_experience, experience_level FROM final_corrected_requirements)""",
)
def alias_coalesce(spark, folder):
    """The first real value of a field's aliases."""
    d = demands(spark, folder).select("job_id", "skills", "mandatory_skills", "overall_experience", "experience_level").distinct()
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    first = lambda *names: F.coalesce(*[real_or_null(F.col(n), placeholders) for n in names])
    return d.select("job_id", first("skills", "mandatory_skills").alias("skills"), first("overall_experience", "experience_level").alias("experience"))


_CITIES = [(r"(?i)navi ?mumbai", "navi mumbai"), (r"(?i)mumbai|bombay", "mumbai"), (r"(?i)bangalore|bengaluru|b.?lore", "bangalore"), (r"(?i)pune|poona", "pune"), (r"(?i)chennai|madras", "chennai"), (r"(?i)hyd(erabad)?\b", "hyderabad"), (r"(?i)greater ?noida", "greater noida"), (r"(?i)noida", "noida"), (r"(?i)gurgaon|gurugram", "gurgaon")]


@query("city_ladder", f"SELECT coalesce({_case('location', _CITIES)}, 'other') AS city, count(*) AS demands FROM final_corrected_requirements WHERE location IS NOT NULL GROUP BY 1")
def city_ladder(spark, folder):
    """The first class of a ladder of patterns."""
    return demands(spark, folder).where("location is not null").groupBy(F.coalesce(X.ladder(F.col("location"), _CITIES), F.lit("other")).alias("city")).agg(F.count("*").alias("demands"))


@query(
    "identifier_checks",
    r"""SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN c IS NULL OR trim(c) = '' THEN 'missing' WHEN NOT regexp_matches(c, '[0-9]') THEN 'no digit' WHEN regexp_matches(c, '^[ #]*[0-9]{1,2}[ ]*-[ ]*[0-9]{1,2}$') THEN 'range'
        WHEN regexp_matches(c, '^[ #]*[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN 'date' WHEN regexp_matches(c, '^[ #]*[0-9]{10}$') THEN 'phone' WHEN regexp_matches(c, '^[ #]*[0-9]{6}$') THEN 'pin' ELSE 'valid' END AS verdict
        FROM (SELECT client_jd_id AS c FROM metaforge_requirements)) GROUP BY 1""",
)
def identifier_checks(spark, folder):
    """An identifier's verdict by ordered tests."""
    c = F.col("client_jd_id")
    verdict = (
        F.when(c.isNull() | (F.trim(c) == ""), "missing").when(~c.rlike("[0-9]"), "no digit").when(c.rlike(r"^[ #]*[0-9]{1,2}[ ]*-[ ]*[0-9]{1,2}$"), "range")
        .when(c.rlike(r"^[ #]*[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "date").when(c.rlike(r"^[ #]*[0-9]{10}$"), "phone").when(c.rlike(r"^[ #]*[0-9]{6}$"), "pin").otherwise("valid")
    )
    return table(spark, folder, "metaforge_requirements").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("id_normal_form", r"SELECT job_id, upper(regexp_replace(client_jd_id, '[^A-Za-z0-9]', '', 'g')) AS id_key, regexp_replace(job_id, '^([0-9]{4})/([0-9]{2})/([0-9]{2})-0*([0-9]+)$', '\1\2\3:\4') AS display FROM metaforge_requirements")
def id_normal_form(spark, folder):
    """Identifiers in the form in which they are compared and shown."""
    return table(spark, folder, "metaforge_requirements").select("job_id", F.upper(F.regexp_replace("client_jd_id", "[^A-Za-z0-9]", "")).alias("id_key"), F.regexp_replace("job_id", "^([0-9]{4})/([0-9]{2})/([0-9]{2})-0*([0-9]+)$", "$1$2$3:$4").alias("display"))


@query(
    "arrival_days",
    """SELECT strftime(make_timestamp(epoch_ms(fetched_at) * 1000 + 19800000000), '%Y/%m/%d') AS day, count(*) AS mails, count(DISTINCT conversation_id) AS conversations, count(DISTINCT graph_id) AS distinct_mails FROM outlook_messages GROUP BY 1""",
)
def arrival_days(spark, folder):
    """Days of arrival in India, whatever the session's zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Kolkata"), F.timestamp_add("MILLISECOND", F.unix_millis("fetched_at"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")))
    return mails(spark, folder).groupBy(F.date_format(local, "yyyy/MM/dd").alias("day")).agg(F.count("*").alias("mails"), F.countDistinct("conversation_id").alias("conversations"), F.countDistinct("graph_id").alias("distinct_mails"))


@query(
    "demand_types",
    """WITH p AS (SELECT source_subject, count(DISTINCT job_id) AS n FROM final_corrected_requirements WHERE source_subject IS NOT NULL GROUP BY 1)
        SELECT CASE WHEN n = 1 THEN 'single' WHEN n <= 5 THEN 'multiple' ELSE 'bulk' END AS kind, count(*) AS subjects, sum(n)::BIGINT AS demands FROM p GROUP BY 1""",
)
def demand_types(spark, folder):
    """How many records one source brought."""
    p = demands(spark, folder).where("source_subject is not null").groupBy("source_subject").agg(F.countDistinct("job_id").alias("n"))
    return p.groupBy(F.when(F.col("n") == 1, "single").when(F.col("n") <= 5, "multiple").otherwise("bulk").alias("kind")).agg(F.count("*").alias("subjects"), F.sum("n").cast("bigint").alias("demands"))


@query(
    "recipient_lists",
    """SELECT lower(x) AS address, count(*) AS times, count(DISTINCT graph_id) AS mails FROM (SELECT graph_id, unnest(list_concat(coalesce(to_recipients, []), coalesce(cc_recipients, []))) AS x FROM outlook_messages) WHERE x IS NOT NULL GROUP BY 1""",
)
def recipient_lists(spark, folder):
    """SC4, SC5, X17, X40: recipients as rows."""
    both = F.concat(F.coalesce("to_recipients", F.array().cast("array<string>")), F.coalesce("cc_recipients", F.array().cast("array<string>")))
    m = mails(spark, folder).select("graph_id", F.explode(both).alias("x")).where("x is not null")
    return m.groupBy(F.lower("x").alias("address")).agg(F.count("*").alias("times"), F.countDistinct("graph_id").alias("mails"))


@query(
    "thread_best_chunk",
    r"""WITH c AS (SELECT graph_id, unnest(regexp_split_to_array(body_plain, '\n[>| ]*From:')) AS chunk FROM outlook_messages WHERE body_plain IS NOT NULL), s AS (SELECT graph_id, chunk,
        (regexp_matches(chunk, '(?i)experience|exp\b')::INT + regexp_matches(chunk, '(?i)skills|tech stack')::INT + regexp_matches(chunk, '(?i)location|city')::INT + regexp_matches(chunk, '(?i)openings|positions|count')::INT)::BIGINT AS score FROM c)
        SELECT graph_id, max(score) AS score, count(*) AS chunks FROM s GROUP BY 1""",
)
def thread_best_chunk(spark, folder):
    """SG3, SG7: parts of a thread and the best one's score."""
    c = mails(spark, folder).where("body_plain is not null").select("graph_id", F.explode(F.split("body_plain", r"\n[>| ]*From:")).alias("chunk"))
    score = X.hits(F.col("chunk"), [r"(?i)experience|exp\b", r"(?i)skills|tech stack", r"(?i)location|city", r"(?i)openings|positions|count"]).cast("bigint")
    return c.groupBy("graph_id").agg(F.max(score).alias("score"), F.count("*").alias("chunks"))


@query(
    "bare_line_runs",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents WHERE text IS NOT NULL),
        b AS (SELECT doc_id, n, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS run FROM l WHERE length(trim(line, ' ')) BETWEEN 1 AND 40 AND NOT regexp_matches(line, '[.:;?!|]'))
        SELECT doc_id, min(n)::BIGINT AS first_line, count(*) AS n_lines FROM b GROUP BY doc_id, run HAVING count(*) >= 3""",
)
def bare_line_runs(spark, folder):
    """Runs of three or more short bare lines, as gaps and islands within a text."""
    d = documents(spark, folder).where("text is not null").select("doc_id", F.posexplode(N.lines(F.col("text"))).alias("n", "line"))
    d = d.where(F.length(F.trim("line")).between(1, 40) & ~F.col("line").rlike("[.:;?!|]"))
    d = d.withColumn("run", F.col("n") - F.row_number().over(W.partitionBy("doc_id").orderBy("n")))
    return d.groupBy("doc_id", "run").agg((F.min("n") + 1).cast("bigint").alias("first_line"), F.count("*").alias("n_lines")).where("n_lines >= 3").drop("run")
