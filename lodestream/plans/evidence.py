"""Queries that check values against the text they came from, and gates that join tables (SURVEY V, G, U, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions import text as N
from lodestream.functions.text import ascii_lower, normal_form
from lodestream.plans.base import query
from lodestream.plans.dual import E, case, col, first, glued, group, lower, matches, of, register, replaced, trimmed
from lodestream.plans.fields import DEMANDS, MAILS, TECH, body, job_id
from lodestream.plans.matching import demands, events, mails, stored, versions
from lodestream.plans.texts import LOWER
from lodestream.sources.tables import table


def _in(text: E, part: E) -> E:
    """Whether a text holds another; false for nulls."""
    return E(lambda: F.coalesce(F.contains(text.c(), part.c()), F.lit(False)), f"coalesce(contains({text.s}, {part.s}), false)")


def _flat(e: E) -> E:
    return trimmed(replaced(lower(e), "[ \t\n\r\f]+", " "))


_title, _source = col("job_title"), col("source_subject")
register("evidence_quotes", DEMANDS, "X24, V11: how a title stands in its mail's subject: verbatim, in other case, with other spaces, or not at all.",
         {"job_id": job_id, "quote": case((_title.null() | trimmed(first(_title, "")).is_(""), None), (_in(_source, _title), "verbatim"), (_in(lower(_source), lower(_title)), "other case"), (_in(_flat(_source), _flat(_title)), "other spaces"), default="none")})
register("evidence_lines", MAILS, "X23: the first line of a mail that names a technical skill.", {"graph_id": col("graph_id"), "line": trimmed(replaced(group(lower(body), rf"(?:^|\n)([^\n]*{TECH}[^\n]*)"), "[ \t\r]+", " "))}, matches(lower(body), TECH))

_TOKENS = f"list_distinct(list_filter(regexp_split_to_array({LOWER.format('title')}, '[^a-z0-9]+'), lambda x: length(x) >= 3))"


@query(
    "stored_support",
    f"""WITH d AS (SELECT requirement_id AS job_id, arg_max(job_description, (version_number, id)) AS description FROM jd_versions WHERE requirement_id IS NOT NULL AND job_description IS NOT NULL GROUP BY 1),
        s AS (SELECT job_id, least(greatest(try_cast(payload_json->>'$.confidence' AS DOUBLE), 0), 1) AS stated, payload_json->>'$.job_title' AS title FROM metaforge_requirements WHERE json_valid(payload_json)),
        t AS (SELECT job_id, stated, {_TOKENS} AS words, {LOWER.format('description')} AS description FROM s JOIN d USING (job_id)),
        r AS (SELECT job_id, stated, CASE WHEN len(words) > 0 THEN len(list_filter(words, lambda x: contains(description, x))) / len(words) END AS support FROM t)
        SELECT job_id, round(stated, 4) AS stated, round(support, 4) AS support, round(CASE WHEN support < 0.5 THEN stated / 2 ELSE stated END, 4) AS confidence FROM r""",
)
def stored_support(spark, folder):
    """The stated confidence, clamped to 0 to 1 and halved where the latest description holds less than half of the title's words."""
    d = versions(spark, folder).where("requirement_id is not null and job_description is not null").groupBy(F.col("requirement_id").alias("job_id")).agg(F.max_by("job_description", F.struct("version_number", "id")).alias("description"))
    s = stored(spark, folder).where(F.try_parse_json("payload_json").isNotNull())
    stated = F.get_json_object("payload_json", "$.confidence").try_cast("double")
    words = F.array_distinct(F.filter(F.split(ascii_lower(F.get_json_object("payload_json", "$.job_title")), "[^a-z0-9]+"), lambda x: F.length(x) >= 3))
    t = s.select("job_id", F.when(stated.isNotNull(), F.least(F.greatest(stated, F.lit(0.0)), F.lit(1.0))).alias("stated"), words.alias("words")).join(d, "job_id")
    low = ascii_lower(F.col("description"))
    support = F.when(F.size("words") > 0, F.size(F.filter("words", lambda x: F.contains(low, x))) / F.size("words"))
    t = t.withColumn("support", support)
    return t.select("job_id", F.round("stated", 4).alias("stated"), F.round("support", 4).alias("support"), F.round(F.when(F.col("support") < 0.5, F.col("stated") / 2).otherwise(F.col("stated")), 4).alias("confidence"))


_KNOWN = ("job_status", "number_of_positions", "location", "work_mode", "notice_period", "yearly_budget", "job_title", "mandatory_skills", "overall_experience", "client_poc", "requirement_from", "client_jd_id")


@query(
    "change_maps",
    f"""WITH c AS (SELECT id, changes_json, unnest(json_keys(changes_json)) AS k FROM jd_versions WHERE json_valid(changes_json) AND json_type(changes_json) = 'OBJECT'), v AS (SELECT id, k, json_extract_string(changes_json, '$."' || k || '".new') AS n FROM c)
        SELECT id, count(*) FILTER (WHERE trim(n) <> '')::BIGINT AS kept, count(*) FILTER (WHERE n IS NULL OR trim(n) = '')::BIGINT AS blank, count(*) FILTER (WHERE k NOT IN {_KNOWN}) > 0 AS is_rejected FROM v GROUP BY 1""",
)
def change_maps(spark, folder):
    """Maps of changes without their blank values; a map with an unknown key rejects its row."""
    v = versions(spark, folder).where(F.try_parse_json("changes_json").isNotNull()).select("id", F.explode(F.from_json("changes_json", "map<string,struct<old:string,new:string>>")).alias("k", "c"))
    new = F.col("c.new")
    return v.groupBy("id").agg(F.count_if(F.trim(new) != "").alias("kept"), F.count_if(new.isNull() | (F.trim(new) == "")).alias("blank"), (F.count_if(~F.col("k").isin(*_KNOWN)) > 0).alias("is_rejected"))


@query("confident_records", "SELECT job_id, try_cast(payload_json->>'$.confidence' AS DOUBLE) AS confidence FROM metaforge_requirements WHERE json_valid(payload_json) AND try_cast(payload_json->>'$.confidence' AS DOUBLE) >= 0.6")
def confident_records(spark, folder):
    """Records of at least a stated confidence."""
    c = F.get_json_object("payload_json", "$.confidence").try_cast("double")
    return stored(spark, folder).where(F.try_parse_json("payload_json").isNotNull()).select("job_id", c.alias("confidence")).where("confidence >= 0.6")


_DOMAIN = f"{LOWER.format('split_part(from_email, chr(64), 2)')}"
_HEAD = f"split_part({LOWER.format('canonical_name')}, ' ', 1)"


@query(
    "sender_allowlist",
    f"""WITH l AS (SELECT {_HEAD} AS head, min(entry_id) AS entry_id, count(*) AS entries FROM reference_entries WHERE entry_kind = 'client' AND canonical_name IS NOT NULL GROUP BY 1), i AS (SELECT DISTINCT {LOWER.format("split_part(x, chr(64), 2)")} AS domain FROM (SELECT unnest(cc_recipients) AS x FROM outlook_messages) WHERE x IS NOT NULL)
        SELECT DISTINCT graph_id, CASE WHEN from_email IS NULL OR NOT regexp_matches(from_email, '^{N.EMAIL}$') THEN 'malformed' WHEN l.head IS NULL AND i.domain IS NOT NULL THEN 'internal' WHEN l.head IS NULL THEN 'unknown' WHEN l.entries > 1 THEN 'ambiguous' ELSE 'listed' END AS verdict, CASE WHEN l.entries = 1 THEN l.entry_id END AS entry_id
        FROM outlook_messages m LEFT JOIN l ON l.head = split_part({_DOMAIN}, '.', 1) LEFT JOIN i ON i.domain = {_DOMAIN} WHERE graph_id IS NOT NULL""",
)
def sender_allowlist(spark, folder):
    """Senders by format, then by the client whose name their domain begins with, then domains of the desk's own copies; a join to tables, nothing listed in code."""
    l = table(spark, folder, "reference_entries").where("entry_kind = 'client' and canonical_name is not null").groupBy(F.split_part(ascii_lower(F.col("canonical_name")), F.lit(" "), F.lit(1)).alias("head")).agg(F.min("entry_id").alias("entry_id"), F.count("*").alias("entries"))  # noqa: E741
    m = mails(spark, folder)
    domain = ascii_lower(F.split_part("from_email", F.lit("@"), F.lit(2)))
    i = m.select(F.explode("cc_recipients").alias("x")).where("x is not null").select(ascii_lower(F.split_part("x", F.lit("@"), F.lit(2))).alias("domain")).distinct().withColumn("inner", F.lit(True))
    m = m.where("graph_id is not null").select("graph_id", "from_email", domain.alias("domain")).distinct().withColumn("head", F.split_part("domain", F.lit("."), F.lit(1)))
    j = m.join(l, "head", "left").join(i, "domain", "left")
    verdict = F.when(F.col("from_email").isNull() | ~F.col("from_email").rlike(f"^{N.EMAIL}$"), "malformed").when(F.col("entries").isNull(), F.when(F.col("inner"), "internal").otherwise("unknown")).when(F.col("entries") > 1, "ambiguous").otherwise("listed")
    return j.select("graph_id", verdict.alias("verdict"), F.when(F.col("entries") == 1, F.col("entry_id")).alias("entry_id")).distinct()


@query(
    "stale_states",
    """WITH e AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, max(epoch_us(ts) // 1000) AS ms FROM events WHERE user_id IS NOT NULL GROUP BY 1), n AS (SELECT max(epoch_us(ts) // 1000) AS ms FROM events)
        SELECT user_id, state, CASE WHEN state IN ('purchase', 'error') THEN 'finished' WHEN n.ms - e.ms > 1800000 THEN 'cleared' ELSE 'in work' END AS outcome FROM e, n""",
)
def stale_states(spark, folder):
    """The last state of each entity; final ones stay, others are cleared when they were silent for half an hour."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = events(spark, folder)
    last = rows.where("user_id is not null").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.max(ms).alias("ms"))
    now = rows.agg(F.max(ms).alias("now")).withColumn("one", F.lit(1))  # one row
    j = last.withColumn("one", F.lit(1)).join(now, "one")
    outcome = F.when(F.col("state").isin("purchase", "error"), "finished").when(F.col("now") - F.col("ms") > 1_800_000, "cleared").otherwise("in work")
    return j.select("user_id", "state", outcome.alias("outcome"))


@query(
    "backlog_antifilter",
    """SELECT DISTINCT job_id FROM final_corrected_requirements d WHERE job_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM metaforge_requirements m WHERE m.job_id = d.job_id) AND NOT EXISTS (SELECT 1 FROM metaforge_requirements m WHERE m.client_jd_id = d.client_jd_id) AND NOT EXISTS (SELECT 1 FROM jd_versions v WHERE v.client_jd_id = d.client_jd_id)""",
)
def backlog_antifilter(spark, folder):
    """Demands that none of three keys of the stores knows."""
    d = demands(spark, folder).where("job_id is not null").select("job_id", "client_jd_id").distinct()
    m = stored(spark, folder)
    d = d.join(m.select("job_id").distinct(), "job_id", "left_anti").join(m.select("client_jd_id").distinct(), "client_jd_id", "left_anti")
    return d.join(versions(spark, folder).select("client_jd_id").distinct(), "client_jd_id", "left_anti").select("job_id").distinct()


@query(
    "overlap_window",
    """WITH w AS (SELECT mailbox_zone, max(epoch_ms(fetched_at)) AS mark FROM outlook_messages WHERE fetched_at IS NOT NULL GROUP BY 1)
        SELECT w.mailbox_zone, w.mark, greatest(w.mark - 300000, 1735689600000) AS since, count(*) AS again FROM w JOIN outlook_messages m ON m.mailbox_zone IS NOT DISTINCT FROM w.mailbox_zone AND epoch_ms(m.fetched_at) >= greatest(w.mark - 300000, 1735689600000) GROUP BY ALL""",
)
def overlap_window(spark, folder):
    """From where a feed is read again: five minutes before its high-water mark, not before a cutoff, and how many mails that meets."""
    m = mails(spark, folder).where("fetched_at is not null").select("mailbox_zone", F.unix_millis("fetched_at").alias("ms"))
    from lodestream.operators.slices import attached

    w = m.groupBy("mailbox_zone").agg(F.max("ms").alias("mark")).withColumn("since", F.greatest(F.col("mark") - 300_000, F.lit(1_735_689_600_000)))
    return attached(m, w, ["mailbox_zone"]).where("ms >= since").groupBy("mailbox_zone", "mark", "since").agg(F.count("*").alias("again"))


_ID = r"(?i)(?:demand|req)[ #:-]*([0-9]{3,})"


@query(
    "id_sections",
    rf"""WITH t AS (SELECT DISTINCT graph_id, body_plain AS b FROM outlook_messages WHERE graph_id IS NOT NULL AND regexp_matches(body_plain, '{_ID}')), s AS (SELECT graph_id, regexp_extract_all(b, '{_ID}', 1) AS ids, regexp_split_to_array(b, '(?i)(?:demand|req)[ #:-]*[0-9]{{3,}}') AS parts FROM t),
        r AS (SELECT graph_id, unnest(ids) AS id, unnest(parts[2:]) AS part, generate_subscripts(ids, 1) AS n FROM s) SELECT graph_id, n::BIGINT AS n, id, length(part)::BIGINT AS chars, md5(part) AS digest FROM r""",
)
def id_sections(spark, folder):
    """SG4, SG5: the text that follows each request id up to the next."""
    t = mails(spark, folder).where("graph_id is not null").where(F.col("body_plain").rlike(_ID)).select("graph_id", F.col("body_plain").alias("b")).distinct()
    parts = F.split("b", r"(?i)(?:demand|req)[ #:-]*[0-9]{3,}", -1)
    both = F.arrays_zip(F.regexp_extract_all("b", F.lit(_ID), F.lit(1)).alias("id"), F.slice(parts, 2, 1 << 30).alias("part"))
    r = t.select("graph_id", F.posexplode(both).alias("n", "x"))
    return r.select("graph_id", (F.col("n") + 1).cast("bigint").alias("n"), F.col("x")["id"].alias("id"), F.length(F.col("x")["part"]).cast("bigint").alias("chars"), F.md5(F.col("x")["part"]).alias("digest"))


_LOW = f"trim(regexp_replace({LOWER.format('u.s')}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"


@query(
    "validated_skills",
    f"""WITH s AS (SELECT DISTINCT job_id, requirement_from AS client, {_LOW} AS skill FROM final_corrected_requirements, unnest(regexp_split_to_array(mandatory_skills, '[,;/|\\n•*]+')) AS u(s) WHERE mandatory_skills IS NOT NULL AND job_id IS NOT NULL),
        k AS (SELECT client_name AS client, line FROM (SELECT DISTINCT client_name, doc_id, trim(regexp_replace({LOWER.format('u.s')}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ') AS line FROM documents, unnest(string_split(text, chr(10))) AS u(s) WHERE text IS NOT NULL AND client_name IS NOT NULL) GROUP BY 1, 2 HAVING count(*) >= 3)
        SELECT job_id, skill FROM s WHERE skill <> '' AND len(regexp_split_to_array(skill, ' ')) <= 30 AND NOT EXISTS (SELECT 1 FROM k WHERE k.client = s.client AND k.line = s.skill)""",
)
def validated_skills(spark, folder):
    """Skills of thirty words or fewer that are no line which three or more texts of the client share; an anti-join on hashes of the learnt lines."""
    from lodestream.functions import extract as X

    s = demands(spark, folder).where("mandatory_skills is not null and job_id is not null").select("job_id", F.col("requirement_from").alias("client"), F.explode(X.tokens(F.col("mandatory_skills"))).alias("skill")).distinct()
    s = s.where(F.size(F.split("skill", " ")) <= 30).withColumn("h", F.xxhash64("skill"))
    d = table(spark, folder, "documents").where("text is not null and client_name is not null").select(F.col("client_name").alias("client"), "doc_id", F.explode(N.lines(F.col("text"))).alias("line"))
    d = d.select("client", "doc_id", F.xxhash64(normal_form(F.col("line"))).alias("h")).distinct().groupBy("client", "h").agg(F.count("*").alias("docs")).where("docs >= 3").select("client", "h")
    return s.join(d, ["client", "h"], "left_anti").select("job_id", "skill")


register("notes_compliance", MAILS, "H36, H30: whether a mail's note reports a failure, and whether it names a manager's role as contact, not as demand.", {"graph_id": col("graph_id"), "complies": ~matches(body, r"(?i)\b(failed|invalid|error|rejected by schema)\b"), "names_manager": matches(glued(first(body, "")), r"(?i)\breport(s|ing)? (in)?to (the )?"), "kind": case((matches(body, r"(?i)\breport(s|ing)? (in)?to\b"), of("contact")), default="none")})
