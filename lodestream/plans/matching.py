"""Queries that look up, match and resolve records (SURVEY J, E, R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions import extract as X
from lodestream.operators import resolve as R
from lodestream.operators.slices import before, id_place
from lodestream.plans.base import query
from lodestream.plans.texts import LOWER, NORM
from lodestream.sources.tables import table


def _t(name):
    return lambda spark, folder: table(spark, folder, name)


mails, demands, stored, versions, events = (_t(x) for x in ("outlook_messages", "final_corrected_requirements", "metaforge_requirements", "jd_versions", "events"))


@query("seen_antijoin", "SELECT graph_id, internet_message_id FROM outlook_messages m WHERE NOT EXISTS (SELECT 1 FROM jd_versions v WHERE v.source_email_id = m.graph_id)")
def seen_antijoin(spark, folder):
    """Mails that no version came from."""
    seen = versions(spark, folder).select(F.col("source_email_id").alias("graph_id")).where("graph_id is not null").distinct()
    return mails(spark, folder).select("graph_id", "internet_message_id").join(seen, "graph_id", "left_anti")


@query(
    "pending_join_topk",
    """SELECT m.job_id, v.id, v.version_number FROM metaforge_requirements m JOIN jd_versions v ON v.requirement_id = m.job_id WHERE m.client_jd_id IS NOT NULL ORDER BY v.id DESC LIMIT 50""",
)
def pending_join_topk(spark, folder):
    """J3, SC22, H10, L3: the 50 latest arrivals of an equi-join (a top-k report)."""
    v = versions(spark, folder).select(F.col("requirement_id").alias("job_id"), "id", "version_number")
    m = stored(spark, folder).where("client_jd_id is not null").select("job_id")
    return m.join(v, "job_id").orderBy(F.desc("id")).limit(50)


@query(
    "conversation_openers",
    """WITH o AS (SELECT conversation_id, min(graph_id) AS opener FROM outlook_messages WHERE in_reply_to IS NULL GROUP BY 1)
        SELECT m.conversation_id, o.opener, count(*) AS mails, count(m.in_reply_to) AS replies FROM outlook_messages m LEFT JOIN o USING (conversation_id) GROUP BY 1, 2""",
)
def conversation_openers(spark, folder):
    """Conversations with the mail that opened them; one aggregation, no self-join, so a hot conversation is combined first."""
    opener = F.min(F.when(F.col("in_reply_to").isNull(), F.col("graph_id")))
    return mails(spark, folder).groupBy("conversation_id").agg(opener.alias("opener"), F.count("*").alias("mails"), F.count("in_reply_to").alias("replies"))


@query(
    "reply_parents",
    """WITH p AS (SELECT internet_message_id, min(graph_id) AS parent FROM outlook_messages WHERE internet_message_id IS NOT NULL GROUP BY 1)
        SELECT DISTINCT m.graph_id, p.parent, p.parent IS NULL AS is_lost FROM outlook_messages m LEFT JOIN p ON p.internet_message_id = m.in_reply_to WHERE m.in_reply_to IS NOT NULL""",
)
def reply_parents(spark, folder):
    """The answered mail by its message id."""
    p = mails(spark, folder).where("internet_message_id is not null").groupBy(F.col("internet_message_id").alias("in_reply_to")).agg(F.min("graph_id").alias("parent"))
    m = mails(spark, folder).where("in_reply_to is not null").select("graph_id", "in_reply_to").distinct()
    return m.join(p, "in_reply_to", "left").select("graph_id", "parent", F.col("parent").isNull().alias("is_lost")).distinct()


@query(
    "tiered_lookup",
    """WITH u AS (SELECT client_jd_id AS k, 10 AS tier, job_id AS ref FROM metaforge_requirements UNION ALL SELECT client_jd_id, 5, requirement_id FROM jd_versions UNION ALL SELECT client_jd_id, 2, job_id FROM final_corrected_requirements),
        r AS (SELECT k, tier, ref, row_number() OVER (PARTITION BY k ORDER BY tier DESC, ref) AS rn FROM u WHERE k IS NOT NULL AND trim(k) <> '')
        SELECT k AS client_jd_id, tier, ref FROM r WHERE rn = 1""",
)
def tiered_lookup(spark, folder):
    """One hit per id from several stores by precedence; an aggregate, combined before its shuffle."""
    parts = [stored(spark, folder).select(F.col("client_jd_id").alias("k"), F.lit(10).alias("tier"), F.col("job_id").alias("ref")), versions(spark, folder).select("client_jd_id", F.lit(5), "requirement_id"), demands(spark, folder).select("client_jd_id", F.lit(2), "job_id")]
    u = parts[0].union(parts[1]).union(parts[2]).where("k is not null and trim(k) <> ''")
    best = u.groupBy("k").agg(F.min_by(F.struct("tier", "ref"), F.struct((-F.col("tier")).alias("t"), "ref")).alias("b"))
    return best.select(F.col("k").alias("client_jd_id"), "b.tier", "b.ref")


@query(
    "history_autofill",
    f"""WITH d AS (SELECT DISTINCT job_id, {NORM.format('requirement_from')} AS client, {NORM.format('job_title')} AS title, location, CASE WHEN {LOWER.format('trim(location)')} NOT IN (SELECT placeholder FROM placeholder_values) THEN location END AS loc FROM final_corrected_requirements WHERE job_id IS NOT NULL),
        w AS (SELECT job_id, location, loc, last_value(loc IGNORE NULLS) OVER (PARTITION BY client, title ORDER BY job_id, location NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM d WHERE client IS NOT NULL AND title IS NOT NULL)
        SELECT job_id, location, coalesce(loc, earlier) AS filled FROM w WHERE loc IS NULL AND earlier IS NOT NULL""",
)
def history_autofill(spark, folder):
    """Missing locations from the latest earlier record of the same client and title."""
    from lodestream.functions.text import normal_form
    from lodestream.functions.values import placeholder_list, real_or_null

    d = demands(spark, folder).where("job_id is not null").select("job_id", normal_form(F.col("requirement_from")).alias("client"), normal_form(F.col("job_title")).alias("title"), "location").distinct()
    d = d.where("client is not null and title is not null").withColumn("loc", real_or_null(F.col("location"), placeholder_list(table(spark, folder, "placeholder_values"))))
    d = before(d, ["client", "title"], ["job_id", "location"], {"earlier": "loc"}, id_place(F.col("job_id")), real=True)
    return d.where("loc is null and earlier is not null").select("job_id", "location", F.col("earlier").alias("filled"))


_KEY = "regexp_replace(" + NORM.format("requirement_from") + ", '[^a-z0-9]', '', 'g')"
_DIGEST = "substr(sha256(coalesce(" + NORM.format("job_title") + ", '') || '|' || coalesce(" + NORM.format("location") + ", '')), 1, 16)"
_IDENTITY = f"CASE WHEN trim(client_jd_id) <> '' THEN concat_ws(':', {_KEY}, 'cjd', trim(client_jd_id)) ELSE concat_ws(':', {_KEY}, 'hash', {_DIGEST}) END"


@query("identity_hash", f"SELECT {_IDENTITY} AS identity, count(*) AS times_seen, min(job_id) AS first_job, max(job_id) AS last_job FROM final_corrected_requirements GROUP BY 1")
def identity_hash(spark, folder):
    """Identities with how often they were seen."""
    key = R.identity(F.col("requirement_from"), F.col("client_jd_id"), F.col("job_title"), F.col("location"))
    return demands(spark, folder).groupBy(key.alias("identity")).agg(F.count("*").alias("times_seen"), F.min("job_id").alias("first_job"), F.max("job_id").alias("last_job"))


@query(
    "ttl_duplicates",
    """WITH e AS (SELECT DISTINCT user_id, event_type, epoch_us(ts) // 1000 AS ms FROM events), l AS (SELECT *, ms - lag(ms) OVER (PARTITION BY user_id, event_type ORDER BY ms) AS gap FROM e)
        SELECT event_type, count(*) AS n, count(*) FILTER (WHERE gap <= 86400000)::BIGINT AS within_day FROM l GROUP BY 1""",
)
def ttl_duplicates(spark, folder):
    """Repetitions within a day of the one before."""
    e = events(spark, folder).select("user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")).distinct()
    e = before(e, ["user_id", "event_type"], ["ms"], {"last": "ms"})
    return e.withColumn("gap", F.col("ms") - F.col("last")).groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("gap") <= 86_400_000).alias("within_day"))


@query("duplicate_ids", "SELECT client_jd_id, count(*) AS cnt, min(job_id) AS kept FROM metaforge_requirements WHERE client_jd_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, folder):
    """Ids stored more than once, and the earliest, which is kept."""
    return stored(spark, folder).where("client_jd_id is not null").groupBy("client_jd_id").agg(F.count("*").alias("cnt"), F.min("job_id").alias("kept")).where("cnt > 1")


@query(
    "latest_kept_rest_archived",
    """WITH r AS (SELECT requirement_id, version_number, id, row_number() OVER (PARTITION BY requirement_id ORDER BY version_number DESC, id DESC) AS rn FROM jd_versions)
        SELECT requirement_id, max(CASE WHEN rn = 1 THEN id END) AS kept_id, max(CASE WHEN rn = 1 THEN version_number END) AS kept_version, (count(*) - 1)::BIGINT AS archived FROM r GROUP BY 1""",
)
def latest_kept_rest_archived(spark, folder):
    """The latest version of each entity stays; the others are counted, not merged."""
    best = F.max_by(F.struct("id", "version_number"), F.struct("version_number", "id"))
    v = versions(spark, folder).groupBy("requirement_id").agg(best.alias("b"), (F.count("*") - 1).alias("archived"))
    return v.select("requirement_id", F.col("b.id").alias("kept_id"), F.col("b.version_number").alias("kept_version"), "archived")


_WORDS = "list_distinct(list_filter(regexp_split_to_array({}, '[^a-z0-9]+'), lambda x: x <> ''))"
_TOKENS = "list_distinct(list_filter(list_transform(regexp_split_to_array({}, '[,;/|\\n•*]+'), lambda x: trim(regexp_replace(" + LOWER.format("x") + ", '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')), lambda x: x <> ''))"


@query(
    "neighbour_similarity",
    f"""WITH d AS (SELECT DISTINCT job_id, {NORM.format('requirement_from')} AS client, {NORM.format('location')} AS city, {NORM.format('job_title')} AS title, mandatory_skills FROM final_corrected_requirements WHERE requirement_from IS NOT NULL AND location IS NOT NULL AND job_title IS NOT NULL AND job_id IS NOT NULL AND mandatory_skills IS NOT NULL),
        l AS (SELECT *, lag(title) OVER w AS t2, lag(mandatory_skills) OVER w AS s2 FROM d WINDOW w AS (PARTITION BY client, city ORDER BY job_id, title, mandatory_skills)),
        j AS (SELECT job_id, client, city, title, t2, {_TOKENS.format('mandatory_skills')} AS a, {_TOKENS.format('s2')} AS b, {_WORDS.format('title')} AS wa, {_WORDS.format('t2')} AS wb FROM l WHERE t2 IS NOT NULL)
        SELECT job_id, round(len(list_intersect(wa, wb)) / greatest(len(list_distinct(list_concat(wa, wb))), 1), 4) AS title_jaccard, round(1 - levenshtein(title, t2) / greatest(length(title), length(t2), 1), 4) AS title_edit,
        round(len(list_intersect(a, b)) / greatest(len(list_distinct(list_concat(a, b))), 1), 4) AS skills_jaccard FROM j""",
)
def neighbour_similarity(spark, folder):
    """Similarities to the record before in the block of client and typed location; all candidates are in candidate_decisions."""
    from lodestream.functions.text import normal_form

    d = demands(spark, folder).where("requirement_from is not null and location is not null and job_title is not null and job_id is not null and mandatory_skills is not null")
    d = d.select("job_id", normal_form(F.col("requirement_from")).alias("client"), normal_form(F.col("location")).alias("city"), normal_form(F.col("job_title")).alias("title"), "mandatory_skills").distinct()
    d = before(d, ["client", "city"], ["job_id", "title", "mandatory_skills"], {"t2": "title", "s2": "mandatory_skills"}, id_place(F.col("job_id"))).where("t2 is not null")
    share = lambda a, b: F.round(F.coalesce(X.jaccard(a, b), F.lit(0.0)), 4)
    edit = F.round(1 - F.levenshtein("title", "t2") / F.greatest(F.length("title"), F.length("t2"), F.lit(1)), 4)
    return d.select("job_id", share(X.words(F.col("title")), X.words(F.col("t2"))).alias("title_jaccard"), edit.alias("title_edit"), share(X.tokens(F.col("mandatory_skills")), X.tokens(F.col("s2"))).alias("skills_jaccard"))


def _range_sql(c: str) -> tuple[str, str]:
    n = "([0-9]{1,2}(?:\\.[0-9])?)"
    lo, hi = (f"try_cast(nullif(regexp_extract({c}, '{n} *(?:-|–|to) *{n}', {k}), '') AS DOUBLE)" for k in (1, 2))
    le = f"try_cast(coalesce(nullif(regexp_extract({c}, '{n} *\\+', 1), ''), nullif(regexp_extract({c}, '(?i)(?:min|minimum|at least|above|over)[a-z ]* {n}', 1), '')) AS DOUBLE)"
    mo = f"try_cast(nullif(regexp_extract({c}, '(?i)(?:max|maximum|up ?to|below|under)[a-z ]* {n}', 1), '') AS DOUBLE)"
    one = f"try_cast(nullif(regexp_extract({c}, '{n}', 1), '') AS DOUBLE)"
    return f"CASE WHEN {lo} IS NOT NULL THEN {lo} WHEN {le} IS NOT NULL THEN {le} WHEN {mo} IS NULL THEN {one} END", f"CASE WHEN {lo} IS NOT NULL THEN {hi} WHEN {le} IS NOT NULL THEN NULL WHEN {mo} IS NOT NULL THEN {mo} END"


_NUMERIC = "list_sort(list_filter({}, lambda x: regexp_matches(x, '^([0-9]+|i{{1,3}}|iv|v)$')))"
_DECISIONS = f"""WITH d AS (SELECT DISTINCT job_id, {NORM.format('requirement_from')} AS client, {NORM.format('location')} AS city, {NORM.format('job_title')} AS title, mandatory_skills AS s, overall_experience AS e FROM final_corrected_requirements WHERE job_id IS NOT NULL),
    l AS (SELECT job_id, title, lag(title) OVER w AS t2, s, lag(s) OVER w AS s2, e, lag(e) OVER w AS e2 FROM d WHERE client IS NOT NULL AND title IS NOT NULL WINDOW w AS (PARTITION BY client, city ORDER BY job_id, title, s NULLS FIRST)),
    f AS (SELECT job_id, t2, CASE WHEN greatest(length(title), length(t2)) > 0 THEN 1 - levenshtein(title, t2) / greatest(length(title), length(t2)) END AS edit, {_WORDS.format('title')} AS wa, {_WORDS.format('t2')} AS wb, {_TOKENS.format('s')} AS a, {_TOKENS.format('s2')} AS b,
        {_range_sql('e')[0]} AS l1, {_range_sql('e')[1]} AS h1, {_range_sql('e2')[0]} AS l2, {_range_sql('e2')[1]} AS h2 FROM l),
    g AS (SELECT *, coalesce(len(list_intersect(wa, wb)) / nullif(len(list_distinct(list_concat(wa, wb))), 0), 0) AS words, greatest(l1, coalesce(h1, l1 + {X.OPEN_YEARS})) AS e1, greatest(l2, coalesce(h2, l2 + {X.OPEN_YEARS})) AS e2 FROM f),
    h AS (SELECT job_id, t2, (edit + CASE WHEN {_NUMERIC.format('wa')} = {_NUMERIC.format('wb')} THEN words ELSE 0 END) / 2 AS ts,
        CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN len(list_intersect(a, b)) / nullif(len(list_distinct(list_concat(a, b))), 0) END AS ss,
        CASE WHEN l1 IS NOT NULL AND l2 IS NOT NULL THEN greatest(0.0, (least(e1, e2) - greatest(l1, l2) + 1) / (greatest(e1, e2) - least(l1, l2) + 1)) END AS es FROM g),
    r AS (SELECT job_id, CASE WHEN t2 IS NOT NULL THEN round((coalesce(ts * {R.TITLE}, 0) + coalesce(ss * {R.SKILLS}, 0) + coalesce(es * {R.EXPERIENCE}, 0)) / (CASE WHEN ts IS NOT NULL THEN {R.TITLE}::DOUBLE ELSE 0 END + CASE WHEN ss IS NOT NULL THEN {R.SKILLS}::DOUBLE ELSE 0 END + CASE WHEN es IS NOT NULL THEN {R.EXPERIENCE}::DOUBLE ELSE 0 END), 6) END AS score FROM h)
    SELECT job_id, score, CASE WHEN score IS NULL THEN 'FIRST' WHEN score >= {R.DUPLICATE} THEN 'DUPLICATE' WHEN score >= {R.POSSIBLE} THEN 'POSSIBLE' ELSE 'NEW' END AS decision FROM r"""


@query("resolution_decisions", _DECISIONS)
def resolution_decisions(spark, folder):
    """Weighted decision on each record against the one before in its block of client and typed location alone; candidate_decisions looks at all candidates."""
    from lodestream.functions.text import normal_form

    d = demands(spark, folder).where("job_id is not null").select("job_id", normal_form(F.col("requirement_from")).alias("client"), normal_form(F.col("location")).alias("city"), normal_form(F.col("job_title")).alias("title"), "mandatory_skills", "overall_experience").distinct()
    d = d.where("client is not null and title is not null")
    scored = R.score_neighbours(d, ["client", "city"], ["job_id", "title", "mandatory_skills"], "title", "mandatory_skills", "overall_experience")
    return scored.select("job_id", "score", "decision")


@query("candidate_decisions")
def candidate_decisions(spark, folder):
    """The hard rules and the weights of title, skills and experience: the best decision on each record against all earlier candidates (no oracle: brute force in the tests)."""
    from lodestream.functions.text import normal_form

    d = demands(spark, folder).select("job_id", normal_form(F.col("requirement_from")).alias("client"), R.city_of(F.col("location")).alias("city"), "client_jd_id", normal_form(F.col("job_title")).alias("title"), F.col("mandatory_skills").alias("skills"), F.col("overall_experience").alias("experience"))
    return R.score_candidates(d)


@query("sequence_ratio")
def sequence_ratio(spark, folder):
    """R2: Ratcliff/Obershelp similarity of a demand's subject and title, each distinct pair once (no oracle: no SQL form)."""
    d = demands(spark, folder).where("source_subject is not null and job_title is not null").groupBy("source_subject", "job_title").agg(F.count("*").alias("n_rows"))
    return d.withColumn("ratio", F.round(R.sequence_ratio("source_subject", "job_title"), 6))


@query(
    "status_join_top",
    """SELECT e.event_type, n.n_name, count(*) AS cnt FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1, 2 ORDER BY cnt DESC, e.event_type, n.n_name LIMIT 10""",
)
def status_join_top(spark, folder):
    """The most frequent groups of a join (a top-k report); events are combined by user before they meet the customers."""
    e = events(spark, folder).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    j = e.join(c, e.user_id == c.c_custkey).groupBy("event_type", "c_nationkey").agg(F.sum("n").alias("cnt"))
    j = j.join(n, j.c_nationkey == n.n_nationkey).groupBy("event_type", "n_name").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    return j.orderBy(F.desc("cnt"), "event_type", "n_name").limit(10)
