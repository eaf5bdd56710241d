"""Queries that build records from several strategies, reports and fuzzy lookups (SURVEY X, J, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions import extract as X
from lodestream.functions import text as N
from lodestream.operators.resolve import near_titles
from lodestream.plans.base import query
from lodestream.plans.matching import demands, mails, stored
from lodestream.plans.texts import INTERNAL, LOWER, NORM, internal_domains
from lodestream.sources.tables import table

_TABLE = r"(?:^|\n)[>| ]*\|? *(?:Role|Position|Job Title) *\| *([^|\n\r]*[^|\n\r ])"
_LABEL = r"(?:^|\n)[ *>|-]*(?:Role|Position|Job Title) *(?:[:=]|- ) *([^\n\r|]*[^\n\r| ])"
_SUBJECT = r"(?:Requirement|Urgent need|New demand [0-9]+) *[:-] *(.*[^ ])"


@query(
    "extraction_precedence",
    f"""WITH m AS (SELECT DISTINCT graph_id, nullif(regexp_extract(body_plain, '{_TABLE}', 1), '') AS t, nullif(regexp_extract(body_plain, '{_LABEL}', 1), '') AS l, nullif(regexp_extract(subject, '{_SUBJECT}', 1), '') AS s FROM outlook_messages)
        SELECT graph_id, coalesce(t, l, s) AS job_title, CASE WHEN t IS NOT NULL THEN 'table' WHEN l IS NOT NULL THEN 'label' WHEN s IS NOT NULL THEN 'subject' ELSE 'none' END AS strategy FROM m""",
)
def extraction_precedence(spark, folder):
    """A field by the first strategy that finds it, with the strategy's name kept beside it."""
    m = mails(spark, folder).select("graph_id", X.group(F.col("body_plain"), _TABLE).alias("t"), X.group(F.col("body_plain"), _LABEL).alias("l"), X.group(F.col("subject"), _SUBJECT).alias("s")).distinct()
    strategy = F.when(F.col("t").isNotNull(), "table").when(F.col("l").isNotNull(), "label").when(F.col("s").isNotNull(), "subject").otherwise("none")
    return m.select("graph_id", F.coalesce("t", "l", "s").alias("job_title"), strategy.alias("strategy"))


_PROBES = {"positions": r"(?i)\b([0-9]{1,3}) (?:positions?|openings?|seats?|profiles?|vacanc(?:y|ies))\b", "rate": r"(?i)\b([0-9]{1,3} ?k) (?:a|per|/) ?month\b", "years": r"(?i)\b([0-9]{1,2}) ?\+? ?(?:years?|yrs?)\b"}


@query("reply_probes", "SELECT graph_id, " + ", ".join(f"nullif(regexp_extract(body_plain, '{p}', 1), '') AS {k}" for k, p in _PROBES.items()) + " FROM outlook_messages WHERE in_reply_to IS NOT NULL AND (" + " OR ".join(f"regexp_matches(body_plain, '{p}')" for p in _PROBES.values()) + ")")
def reply_probes(spark, folder):
    """What a short answer changes: count, rate, years."""
    m = mails(spark, folder).where("in_reply_to is not null").select("graph_id", *[X.group(F.col("body_plain"), p).alias(k) for k, p in _PROBES.items()])
    return m.where("positions is not null or rate is not null or years is not null")


@query(
    "nearest_marker",
    """WITH p AS (SELECT graph_id, instr(body_plain, 'Budget') AS budget, instr(body_plain, 'Shift') AS shift, instr(body_plain, 'City') AS city FROM outlook_messages WHERE instr(body_plain, 'Budget') > 0)
        SELECT graph_id, budget::BIGINT AS at, CASE WHEN greatest(CASE WHEN shift < budget THEN shift ELSE 0 END, CASE WHEN city < budget THEN city ELSE 0 END) = 0 THEN 'none' WHEN (CASE WHEN shift < budget THEN shift ELSE 0 END) > (CASE WHEN city < budget THEN city ELSE 0 END) THEN 'Shift' ELSE 'City' END AS nearest FROM p""",
)
def nearest_marker(spark, folder):
    """The marker nearest above a place in the text."""
    at = lambda w: F.instr("body_plain", F.lit(w))
    m = mails(spark, folder).select("graph_id", at("Budget").alias("at"), at("Shift").alias("s"), at("City").alias("c")).where("at > 0")
    above = lambda c: F.when(F.col(c) < F.col("at"), F.col(c)).otherwise(0)
    best = F.array_max(F.array(F.struct(above("s").alias("p"), F.lit("Shift").alias("w")), F.struct(above("c").alias("p"), F.lit("City").alias("w"))))
    return m.withColumn("b", best).select("graph_id", F.col("at").cast("bigint").alias("at"), F.when(F.col("b.p") == 0, "none").otherwise(F.col("b.w")).alias("nearest"))


_SIM = "1 - levenshtein(a.title, b.title) / greatest(length(a.title), length(b.title), 1)"


@query(
    "fuzzy_title_lookup",
    f"""WITH d AS (SELECT DISTINCT {NORM.format('requirement_from')} AS client, {NORM.format('job_title')} AS title FROM final_corrected_requirements WHERE requirement_from IS NOT NULL AND length({NORM.format('job_title')}) >= 4),
        s AS (SELECT DISTINCT {NORM.format("(payload_json->>'$.requirement_from')")} AS client, {NORM.format("(payload_json->>'$.job_title')")} AS title FROM metaforge_requirements WHERE json_valid(payload_json) AND length({NORM.format("(payload_json->>'$.job_title')")}) >= 4)
        SELECT a.client, a.title, b.title AS stored_title, round({_SIM}, 4) AS score FROM d a JOIN s b ON a.client = b.client AND substr(a.title, 1, 4) = substr(b.title, 1, 4) WHERE {_SIM} >= 0.8""",
)
def fuzzy_title_lookup(spark, folder):
    """Titles of one client that begin alike and are nearly equal; distinct titles meet in blocks of client and beginning. Whatever the beginning: fuzzy_title_matches."""
    d = demands(spark, folder).select(N.normal_form(F.col("requirement_from")).alias("client"), N.normal_form(F.col("job_title")).alias("title"))
    s = stored(spark, folder).select(N.normal_form(F.get_json_object("payload_json", "$.requirement_from")).alias("client"), N.normal_form(F.get_json_object("payload_json", "$.job_title")).alias("stored_title"))
    d = d.where("client is not null and length(title) >= 4").distinct().withColumn("block", F.substring("title", 1, 4))
    s = s.where("client is not null and length(stored_title) >= 4").distinct().withColumn("block", F.substring("stored_title", 1, 4))
    score = 1 - F.levenshtein("title", "stored_title") / F.greatest(F.length("title"), F.length("stored_title"), F.lit(1))
    return d.join(s, ["client", "block"]).withColumn("score", score).where("score >= 0.8").select("client", "title", "stored_title", F.round("score", 4).alias("score"))


@query("fuzzy_title_matches")
def fuzzy_title_matches(spark, folder):
    """All titles of one client that are nearly equal by edits or by words (no oracle: the SQL above has its blocks; brute force in the tests)."""
    d = demands(spark, folder).select(N.normal_form(F.col("requirement_from")).alias("client"), N.normal_form(F.col("job_title")).alias("title"))
    s = stored(spark, folder).select(N.normal_form(F.get_json_object("payload_json", "$.requirement_from")).alias("client"), N.normal_form(F.get_json_object("payload_json", "$.job_title")).alias("title"))
    return near_titles(d, s).withColumn("score", F.round("score", 4))


_LINE = f"trim(regexp_replace({LOWER.format('u.line')}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"


@query(
    "known_line_filter",
    f"""WITH l AS (SELECT doc_id, {_LINE} AS line FROM documents, unnest(string_split(text, chr(10))) AS u(line) WHERE text IS NOT NULL), k AS (SELECT line FROM l WHERE length(line) >= 4 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE line IN (SELECT line FROM k))::BIGINT AS known FROM l GROUP BY 1""",
)
def known_line_filter(spark, folder):
    """How many lines of a text are known from two other texts or more.

    The lines' hashes travel, not their texts; a line of all texts is combined before it is
    counted, and joined back by its hash, where AQE splits what is hot."""
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", F.explode(N.lines(F.col("text"))).alias("line"))
    d = d.select("doc_id", N.normal_form(F.col("line")).alias("line")).select("doc_id", F.xxhash64("line").alias("h"), (F.length("line") >= 4).alias("counts"))
    per_doc = d.groupBy("doc_id", "h").agg(F.count("*").alias("times"), F.max("counts").alias("counts"))
    known = per_doc.where("counts").groupBy("h").agg(F.count("*").alias("docs")).where("docs >= 3").select("h", F.lit(True).alias("is_known"))
    j = per_doc.join(known, "h", "left")
    return j.groupBy("doc_id").agg(F.sum("times").alias("n_lines"), F.sum(F.when(F.col("is_known"), F.col("times")).otherwise(0)).cast("bigint").alias("known"))


@query(
    "report_rows",
    f"""SELECT DISTINCT job_id, coalesce(job_title, source_subject, '') AS role, coalesce(client_poc, client_lead_poc, '') AS contact, coalesce(overall_experience, experience_level, '') AS experience, CASE WHEN regexp_matches(coalesce(source_subject, ''), '(?i)urgent|immediate') THEN 'High' ELSE 'Medium' END AS urgency,
        coalesce(number_of_positions, 1)::BIGINT AS positions, CASE WHEN {LOWER.format('from_domain')} IN {INTERNAL} THEN 'internal' WHEN from_domain = '' THEN 'unknown' ELSE 'external' END AS origin FROM (SELECT *, coalesce(split_part(source_from_email, chr(64), 2), '') AS from_domain FROM final_corrected_requirements)""",
)
def report_rows(spark, folder):
    """X19, H16, SK6: rows of a flat report with its fallbacks."""
    domain = F.coalesce(F.split_part("source_from_email", F.lit("@"), F.lit(2)), F.lit(""))
    first = lambda *c: F.coalesce(*c, F.lit(""))
    urgency = F.when(F.coalesce("source_subject", F.lit("")).rlike("(?i)urgent|immediate"), "High").otherwise("Medium")
    origin = F.when(F.col("inner"), "internal").when(F.col("domain") == "", "unknown").otherwise("external")
    d = demands(spark, folder).withColumn("domain", N.ascii_lower(domain)).join(internal_domains(spark, folder).withColumn("inner", F.lit(True)), "domain", "left")
    return d.select("job_id", first("job_title", "source_subject").alias("role"), first("client_poc", "client_lead_poc").alias("contact"), first("overall_experience", "experience_level").alias("experience"), urgency.alias("urgency"), F.coalesce("number_of_positions", F.lit(1)).cast("bigint").alias("positions"), origin.alias("origin")).distinct()


@query(
    "rejected_listing",
    f"""SELECT graph_id, subject, epoch_ms(max(fetched_at)) AS fetched_ms FROM outlook_messages WHERE (from_email IS NULL OR NOT regexp_matches(from_email, '^{N.EMAIL}$') OR body_plain IS NULL OR trim(body_plain, ' ') = '') AND graph_id IS NOT NULL GROUP BY 1, 2 ORDER BY fetched_ms DESC, graph_id LIMIT 100""",
)
def rejected_listing(spark, folder):
    """L3, S13, SK8: the newest hundred mails without usable sender or body (a listing's page)."""
    bad = F.col("from_email").isNull() | ~F.col("from_email").rlike(f"^{N.EMAIL}$") | F.col("body_plain").isNull() | (F.trim("body_plain") == "")
    m = mails(spark, folder).where(bad & F.col("graph_id").isNotNull()).groupBy("graph_id", "subject").agg(F.unix_millis(F.max("fetched_at")).alias("fetched_ms"))
    return m.orderBy(F.desc("fetched_ms"), "graph_id").limit(100)


@query("event_attributes", "SELECT k AS name, count(*) AS n, count(DISTINCT json_extract_string(props, k)) AS values FROM (SELECT props, unnest(json_keys(props)) AS k FROM events WHERE json_valid(props)) GROUP BY 1")
def event_attributes(spark, folder):
    """A5, SC20, SC21, N22: the keys of a JSON column with their counts."""
    e = table(spark, folder, "events").where(F.try_parse_json("props").isNotNull()).select(F.explode(F.from_json("props", "map<string,string>")).alias("name", "v"))
    return e.groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("v").alias("values"))


@query("segment_blocks")
def segment_blocks(spark, folder):
    """SG1, SG2, SG4-SG6, SG10, SG11: mails cut into records by the first strategy that fits (no oracle: line states; tested on fixtures)."""
    from lodestream.operators.segment import segmented

    m = mails(spark, folder).where("graph_id is not null").select("graph_id", N.unquoted_head(F.col("body_plain")).alias("head"))
    b = segmented(m, "head")
    return b.select("graph_id", "block_no", "strategy", F.length("block").cast("bigint").alias("chars"), F.try_element_at("fields", F.lit("job_title")).alias("job_title"), F.try_element_at("fields", F.lit("location")).alias("location"))
