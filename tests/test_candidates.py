"""Candidate searches against brute force over all pairs."""

import random

from pyspark.sql import functions as F

from lodestream.functions import extract as X
from lodestream.operators import resolve as R

PROFILE = "job_id string, client string, city string, client_jd_id string, title string, skills string, experience string"


def brute_decisions(spark, df):
    """Every record against every other one, by the rules as they are written."""
    df = df.where("job_id is not null and client is not null and title <> ''").distinct()
    a, b = (df.select(*[F.col(c).alias(f"{c}_{x}") for c in df.columns]) for x in "ab")
    j = a.crossJoin(b).where("client_a = client_b and job_id_b < job_id_a and (city_a is null or city_b is null or city_a = city_b or client_jd_id_a = client_jd_id_b)")
    mine, other = X.number_range(F.col("experience_a")), X.number_range(F.col("experience_b"))
    score = X.weighted([
        (R.TITLE, R.title_score(F.col("title_a"), F.col("title_b"))),
        (R.SKILLS, X.jaccard(X.tokens(F.col("skills_a")), X.tokens(F.col("skills_b")))),
        (R.EXPERIENCE, X.overlap(mine["low"], mine["high"], other["low"], other["high"])),
    ])
    ruled = F.when(F.expr("client_jd_id_a = client_jd_id_b"), 1.0).when(F.expr("client_jd_id_a <> client_jd_id_b or city_a <> city_b"), 0.0).otherwise(F.round(score, 6))
    best = {r["job_id_a"]: r["s"] for r in j.groupBy("job_id_a").agg(F.max(ruled).alias("s")).collect()}
    jobs = {r["job_id"] for r in df.select("job_id").collect()}
    name = lambda s: "FIRST" if s is None else "DUPLICATE" if s >= R.DUPLICATE else "POSSIBLE" if s >= R.POSSIBLE else "NEW"
    return {k: (best[k] if best.get(k, 0) >= R.POSSIBLE else None, name(best.get(k))) for k in jobs}


def test_candidates_against_brute_force(spark):
    r = random.Random(5)
    titles = ["java developer", "senior java developer", "java devloper", "data engineer", "data engineer ii", "data engineer iii", "qa", "###", "", None]
    skills = ["java, sql, spring", "sql; java", "java | sql | spring | git", "python, spark", "spark / python / sql", "", None]
    rows = [(f"J{r.randrange(150):03}", r.choice(["acme", "acme", "bolt"]), r.choice(["pune", "delhi", None]), r.choice([None, None, "7", " 7 ", "8", ""]), r.choice(titles), r.choice(skills), r.choice(["3-5 years", "4", "8+", None])) for _ in range(220)]
    df = spark.createDataFrame(rows, PROFILE)
    got = {x["job_id"]: (x["score"], x["decision"]) for x in R.score_candidates(df).collect()}
    want = brute_decisions(spark, df.withColumn("client_jd_id", F.nullif(F.trim("client_jd_id"), F.lit(""))))
    assert got == want
    assert {d for _, d in want.values()} == {"FIRST", "NEW", "POSSIBLE", "DUPLICATE"}


def test_candidate_two_back_and_elsewhere(spark):
    """A duplicate that isn't the row before, whose place is spelt otherwise or is none."""
    place = [("J1", "Bengaluru "), ("J2", "Bangalore"), ("J3", "TBD"), ("J4", "Delhi"), ("J5", "WFO Bangalore")]
    title = {"J2": "data engineer", "J4": "java developer"}
    rows = [(j, "acme", p, None, title.get(j, "java developer"), "python, spark" if j == "J2" else "java, sql", "4 years") for j, p in place]
    df = spark.createDataFrame(rows, PROFILE).withColumn("city", R.city_of(F.col("city")))
    got = {x["job_id"]: (x["decision"], x["candidate"]) for x in R.score_candidates(df).collect()}
    assert got == {"J1": ("FIRST", None), "J2": ("NEW", None), "J3": ("DUPLICATE", "J1"), "J4": ("DUPLICATE", "J3"), "J5": ("DUPLICATE", "J1")}


def test_candidates_of_a_table(spark, sf):
    """The registered query on the smallest tables."""
    from lodestream.functions.text import normal_form
    from lodestream.plans import registry
    from lodestream.plans.matching import demands

    d = demands(spark, sf).select("job_id", normal_form(F.col("requirement_from")).alias("client"), R.city_of(F.col("location")).alias("city"), F.nullif(F.trim("client_jd_id"), F.lit("")).alias("client_jd_id"), normal_form(F.col("job_title")).alias("title"), F.col("mandatory_skills").alias("skills"), F.col("overall_experience").alias("experience"))
    got = {x["job_id"]: (x["score"], x["decision"]) for x in registry.queries()["candidate_decisions"](spark, sf).collect()}
    assert got == brute_decisions(spark, d)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_titles(left, right):
    import re

    words = lambda s: {w for w in re.split("[^a-z0-9]+", s) if w}
    out = set()
    for c, a in left:
        for d, b in right:
            if c == d and c and a and b and min(len(a), len(b)) >= 3:
                x, y = words(a), words(b)
                if max(1 - _distance(a, b) / max(len(a), len(b)), len(x & y) / len(x | y) if x | y else 0) >= 0.8:
                    out.add((c, a, b))
    return out


def test_titles_against_brute_force(spark):
    r = random.Random(3)
    bases = ["internal auditor", "release manager", "information security officer", "qa", "dba", "aaaa aaaa", "sap basis administrator iii"]

    def noisy():
        t = list(r.choice(bases))
        for _ in range(r.randrange(5)):
            k = r.randrange(len(t) + 1)
            t[k : k + r.randrange(2)] = r.choice(["", "a", " ", "é"])
        return (r.choice(["acme", "bolt", None]), r.choice(["", "", "sr. ", "re: ", "senior "]) + "".join(t))

    left, right = [noisy() for _ in range(150)], [noisy() for _ in range(150)] + [("acme", None)]
    df = lambda rows: spark.createDataFrame(rows, "client string, title string")
    got = [tuple(x)[:3] for x in R.near_titles(df(left), df(right)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_titles(left, right)


def test_titles_with_other_beginnings(spark):
    """Pairs that a block of the first four characters loses."""
    rows = lambda *t: spark.createDataFrame([("acme", x) for x in t], "client string, title string")
    got = R.near_titles(rows("sr. internal auditor", "rlease manager", "dba", "officer of security and data privacy"), rows("internal auditor", "release manager", "dba", "security and data privacy officer of", "dbo"))
    assert {(x["title"], x["stored_title"]) for x in got.collect()} == {("sr. internal auditor", "internal auditor"), ("rlease manager", "release manager"), ("dba", "dba"), ("officer of security and data privacy", "security and data privacy officer of")}


def test_titles_of_a_table(spark, sf):
    """The registered query finds all that the blocked one does."""
    from lodestream.plans import registry

    whole = {tuple(x)[:3] for x in registry.queries()["fuzzy_title_matches"](spark, sf).collect()}
    assert whole >= {tuple(x)[:3] for x in registry.queries()["fuzzy_title_lookup"](spark, sf).collect()}


def test_no_exploded_table_is_broadcast(spark, monkeypatch):
    """Entries are many times the file that they come from, by whose size Spark would choose to
    send them through the driver; so no join of the search may be one."""
    plans, cut = [], R.cut
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(R, "cut", lambda df: seen(df) or cut(df))
    rows = spark.createDataFrame([("acme", f"release manager {k}") for k in range(30)] + [("bolt", "dba")], "client string, title string")
    found = R.near_titles(rows, rows)
    seen(found)
    assert found.count() == 30 * 30 + 1
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4
    assert not [p for p in plans if "Broadcast" in p]


def test_titles_of_few_distinct_pairs(spark):
    """Runs of one character hold a single pair, however long."""
    titles = ["a" * n for n in range(2, 14)] + ["ab" * n for n in range(2, 8)] + ["aabaa", "abaab", "baaaa"]
    rows = [(c, t) for c in ("acme", "bolt") for t in titles]
    df = lambda x: spark.createDataFrame(x, "client string, title string")
    got = [tuple(x)[:3] for x in R.near_titles(df(rows), df(rows[: len(titles)] + [("core", "aaaa")])).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_titles(rows, rows[: len(titles)])
