"""Entity resolution: identities, blocked similarity with renormalised weights, decisions (E, R).

``score_candidates`` decides each record against all earlier ones that may be the same;
``score_neighbours`` only against its predecessor in a block. Equal records are collapsed first.
"""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.functions import extract as X
from lodestream.functions.text import normal_form
from lodestream.operators.slices import before, id_place
from lodestream.session import cut

#: Weights and thresholds of the score (fixed values).
TITLE, SKILLS, EXPERIENCE = 0.4, 0.4, 0.2
DUPLICATE, POSSIBLE = 0.85, 0.70


def identity(client: Column, client_id: Column, *content: Column) -> Column:
    """client:cjd:ID where there is an id, else client:hash:16 hex digits of the content."""
    key = F.regexp_replace(normal_form(client), "[^a-z0-9]", "")
    digest = F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(normal_form(c), F.lit("")) for c in content]), 256), 1, 16)
    return F.when(F.trim(client_id) != "", F.concat_ws(":", key, F.lit("cjd"), F.trim(client_id))).otherwise(F.concat_ws(":", key, F.lit("hash"), digest))


NUMERAL = "^([0-9]+|i{1,3}|iv|v)$"


def title_score(a: Column, b: Column) -> Column:
    """Similarity of two titles, the mean of their edit similarity and the Jaccard similarity of
    their words; words count for nothing where the titles' numerals differ."""
    longest = F.greatest(F.length(a), F.length(b))
    edit = F.when(longest > 0, 1 - F.levenshtein(a, b) / longest)
    wa, wb = X.words(a), X.words(b)
    numerals = lambda w: F.array_sort(F.filter(w, lambda x: x.rlike(NUMERAL)))
    words = F.when(numerals(wa) == numerals(wb), F.coalesce(X.jaccard(wa, wb), F.lit(0.0))).otherwise(0.0)
    return (edit + words) / 2


def score_neighbours(rows: DataFrame, block: list[str], order: list[str], title: str, skills: str, experience: str) -> DataFrame:
    """rows with ``score`` against the row before in the same block and ``decision``."""
    df = before(rows, block, order, {"__title": title, "__skills": skills, "__exp": experience}, id_place(F.col(order[0])))
    mine, other = X.number_range(F.col(experience)), X.number_range(F.col("__exp"))
    score = X.weighted([
        (TITLE, title_score(F.col(title), F.col("__title"))),
        (SKILLS, X.jaccard(X.tokens(F.col(skills)), X.tokens(F.col("__skills")))),
        (EXPERIENCE, X.overlap(mine["low"], mine["high"], other["low"], other["high"])),
    ])
    df = df.withColumn("score", F.when(F.col("__title").isNotNull(), F.round(score, 6)))
    decision = F.when(F.col("score").isNull(), "FIRST").when(F.col("score") >= DUPLICATE, "DUPLICATE").when(F.col("score") >= POSSIBLE, "POSSIBLE").otherwise("NEW")
    return df.withColumn("decision", decision).drop("__title", "__skills", "__exp")


#: Place names by city (fixed values); what fits none of them names no city.
CITIES = (
    (r"bengaluru|bangalore|electronic\s*city|whitefield|manyata|bdc\d*\w*", "bangalore"), (r"mumbai|bombay|navi\s*mumbai|thane|airoli|mdc(?:-\d+|\d*\w*)", "mumbai"),
    (r"pune|hinjewadi|magarpatta|pdc\d*\w*", "pune"), (r"hyderabad|secunderabad|gachibowli|madhapur|hitec\s*city|hdc\d*\w*", "hyderabad"),
    (r"chennai|madras|sholinganallur|omr|t\s*nagar|cdc\d*\w*", "chennai"), (r"gurgaon|gurugram|cyber\s*city|ddc\d*\w*", "gurgaon"), (r"noida|greater\s*noida", "noida"), (r"mysore|mysuru", "mysore"),
    (r"kolkata|calcutta|kdc\d*\w*", "kolkata"), (r"delhi|new\s*delhi|ncr", "delhi"), (r"coimbatore", "coimbatore"), (r"kochi|cochin", "kochi"), (r"chandigarh|mohali", "chandigarh"), (r"ahmedabad", "ahmedabad"),
    (r"trivandrum|thiruvananthapuram", "trivandrum"), (r"bhubaneswar", "bhubaneswar"), (r"indore", "indore"), (r"jaipur", "jaipur"),
)
_NO_CITY = r"\b(?:any\s+(?:\w+\s+)?(?:location|office)|client\s+(?:location|site|office)|pan\s+india)\b"


def city_of(location: Column) -> Column:
    """The city that a location names, null where it names none."""
    place = normal_form(location)
    return F.when(~place.rlike(_NO_CITY), X.ladder(place, [(rf"\b(?:{p})\b", name) for p, name in CITIES]))


def prefix_entries(rows: DataFrame, key: str, group: str, items: Column, keep: Column) -> DataFrame:
    """(key, group, item): of each row its first ``keep`` items, those that are rarest in the
    group first. What only one row of the group holds counts, but is left out.

    Spark takes an exploded table to be as large as the file before it, so without the hint it
    would send counts of any size through the driver."""
    e = rows.select(key, group, keep.alias("__keep"), F.explode(items).alias("item"))
    n = e.groupBy(group, "item").agg(F.count("*").alias("__n"))
    rank = F.row_number().over(W.partitionBy(key).orderBy("__n", "item"))
    return e.join(n.hint("merge"), [group, "item"]).withColumn("__rank", rank).where("__rank <= __keep and __n > 1").select(key, group, "item")


def jaccard_prefix(n: Column, threshold: float) -> Column:
    """Two sets of Jaccard similarity >= threshold share an item among so many first ones."""
    return n - F.ceil(n * threshold - 1e-9) + 1


#: A pair of score POSSIBLE needs this similarity of skills where both sides have some (title and
#: experience 1); where the skills don't count, this one of titles, and so this one of their words.
LEAST_SKILLS = (POSSIBLE - TITLE - EXPERIENCE) / SKILLS - 1e-5
LEAST_TITLE = (POSSIBLE * (TITLE + EXPERIENCE) - EXPERIENCE) / TITLE - 1e-5
LEAST_WORDS = 2 * LEAST_TITLE - 1


def score_candidates(rows: DataFrame) -> DataFrame:
    """(job_id, score, decision, candidate): each record's best decision against all earlier
    ones, by job_id, of its client in the same city, without a city, or with the same id; of
    the whole client where it has no city itself.

    ``rows`` has job_id, client, city, client_jd_id, title, skills and experience; records
    without client or title are left out. The same id decides for DUPLICATE, two different
    ids or cities against it, else the weighted score. ``score`` and ``candidate`` are null
    under POSSIBLE. Distinct profiles meet on the rarest of their skills, as many as the
    least score needs; where a side has no skills to compare, on the rarest words of
    their titles.
    """
    rows = rows.where("job_id is not null and client is not null and title <> ''").withColumn("client_jd_id", F.nullif(F.trim("client_jd_id"), F.lit(""))).distinct()
    fields = ["client", "city", "client_jd_id", "title", "skills", "experience"]
    # xxhash64 skips nulls, so their places count
    rows = cut(rows.withColumn("pid", F.xxhash64(*fields, *[F.col(c).isNull() for c in fields])))
    profiles = cut(rows.groupBy("pid", *fields).agg(F.min("job_id").alias("first")).withColumn("tokens", X.tokens(F.col("skills"))))
    kept = [F.col(c) for c in ("pid", "client", "city", "client_jd_id", "first")]

    def met(a: DataFrame, b: DataFrame, on: list[str], more: Column) -> DataFrame:
        """Pairs of profiles whose ids allow a score; b is the earlier one."""
        open_ids = F.col("a.client_jd_id").isNull() | F.col("b.client_jd_id").isNull()
        equal = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
        j = a.alias("a").join(b.alias("b"), equal).where(open_ids & (F.col("b.first") < F.col("a.first")) & more)
        return j.select(F.col("a.pid").alias("pa"), F.col("b.pid").alias("pb"))

    def in_city(e: DataFrame, f: DataFrame, on: list[str], more: Column) -> list[DataFrame]:
        """The equi-joins of the search: the same city, the earlier without one, the later without one."""
        here, nowhere = (lambda x: x.where("city is not null")), (lambda x: x.where("city is null"))
        return [met(here(e), here(f), [*on, "city"], more), met(e, nowhere(f), on, more), met(nowhere(e), here(f), on, more)]

    some = profiles.where(F.size("tokens") > 0)
    entries = prefix_entries(some, "pid", "client", F.col("tokens"), jaccard_prefix(F.size("tokens"), LEAST_SKILLS))
    entries = cut(entries.drop("client").join(profiles.select(*kept), "pid"))
    pairs = in_city(entries, entries, ["client", "item"], F.lit(True))
    # without skills on a side, or with none to compare on both, the titles decide; they must share
    # a word, one of as many of their rarest as the least similarity needs
    named = X.words(F.col("title"))
    titled = cut(prefix_entries(profiles, "pid", "client", named, jaccard_prefix(F.size(named), LEAST_WORDS)).drop("client").join(profiles.select(*kept, "tokens"), "pid"))
    bare, none, full = titled.where("tokens is null"), titled.where(F.size("tokens") == 0), titled.where("tokens is not null")
    for a, b in ((bare, titled), (full, bare), (none, none)):
        pairs += in_city(a, b, ["client", "item"], F.lit(True))
    pairs = cut(reduce(DataFrame.unionByName, pairs).distinct())

    side = lambda x: profiles.select(F.col("pid").alias(f"p{x}"), F.col("title").alias(f"title_{x}"), F.col("tokens").alias(f"tokens_{x}"), X.number_range(F.col("experience")).alias(f"years_{x}"), F.col("first").alias(f"first_{x}"))
    mine, other = F.col("years_a"), F.col("years_b")
    score = X.weighted([
        (TITLE, title_score(F.col("title_a"), F.col("title_b"))),
        (SKILLS, X.jaccard(F.col("tokens_a"), F.col("tokens_b"))),
        (EXPERIENCE, X.overlap(mine["low"], mine["high"], other["low"], other["high"])),
    ])
    scored = pairs.join(side("a"), "pa").join(side("b"), "pb").withColumn("score", F.round(score, 6)).where(F.col("score") >= POSSIBLE)
    best = scored.groupBy(F.col("pa").alias("pid")).agg(F.min_by(F.struct("score", "first_b"), F.struct((-F.col("score")).alias("against"), "first_b")).alias("best"))

    # who came first: in the client, its city, without a city, with the id
    first = lambda name, *by, where="true": profiles.where(where).groupBy(*by).agg(F.min("first").alias(name))
    d = rows.select("job_id", "pid", "client", "city", "client_jd_id").join(profiles.select("pid", "first"), "pid").join(best, "pid", "left")
    d = d.join(first("of_client", "client"), "client").join(first("of_none", "client", where="city is null"), "client", "left")
    d = d.join(first("of_city", "client", "city", where="city is not null"), ["client", "city"], "left").join(first("of_id", "client", "client_jd_id", where="client_jd_id is not null"), ["client", "client_jd_id"], "left")
    earlier = F.when(F.col("city").isNull(), F.col("of_client")).otherwise(F.least("of_city", "of_none", "of_id")) < F.col("job_id")
    same = F.least(*[F.when(F.col(c) < F.col("job_id"), F.col(c)) for c in ("first", "of_id")])
    found = F.when(same.isNotNull(), F.struct(F.lit(1.0).alias("score"), same.alias("candidate"))).otherwise(F.struct(F.col("best.score").alias("score"), F.col("best.first_b").alias("candidate")))
    d = d.withColumn("f", found).groupBy("job_id").agg(F.max(F.coalesce(earlier, F.lit(False))).alias("earlier"), F.min_by("f", F.struct((-F.coalesce("f.score", F.lit(0.0))).alias("against"), "f.candidate")).alias("f"))
    decision = F.when(F.col("f.score") >= DUPLICATE, "DUPLICATE").when(F.col("f.score") >= POSSIBLE, "POSSIBLE").when(F.col("earlier"), "NEW").otherwise("FIRST")
    return d.select("job_id", "f.score", decision.alias("decision"), "f.candidate")


def _grams(c: Column) -> Column:
    """The distinct pairs of adjacent characters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2))))


def near_titles(left: DataFrame, right: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(client, title, stored_title, score) of all titles of left and right (client, title), of 3
    characters or more, with one client and an edit similarity or a Jaccard similarity of
    words of at least ``threshold``; the score is the better of both.

    Each of k edits takes at most two pairs of characters from a title and never all, so titles
    that near share one among their 2 k + 1 rarest; likewise words. A title's partner is at most
    its length / threshold long. Titles meet by numbers, only those of clients that both sides
    have; a client's hash stands for it until the pair is looked at.
    """
    tagged = lambda df, is_left: df.where("client is not null and length(title) >= 3").select(F.lit(is_left).alias("is_left"), "client", "title")
    rows = cut(tagged(left, True).unionByName(tagged(right, False)).distinct())
    both = rows.groupBy("client").agg(F.min("is_left").alias("a"), F.max("is_left").alias("b")).where("a <> b").select("client")
    rows = rows.join(both.hint("merge"), "client", "left_semi").withColumn("words", X.words(F.col("title"))).withColumn("grams", _grams(F.col("title")))
    rows = cut(rows.withColumn("id", F.monotonically_increasing_id()))
    most_edits = F.floor(F.length("title") * (1 - threshold) / threshold + 1e-9)
    met = []
    for items, n, keep in (("grams", F.length("title"), 2 * most_edits + 1), ("words", F.size("words"), jaccard_prefix(F.size("words"), threshold))):
        keyed = rows.select(F.struct("id", "is_left", n.alias("n")).alias("key"), F.xxhash64("client").alias("of"), items, keep.alias("keep"))
        entries = cut(prefix_entries(keyed, "key", "of", F.col(items), F.col("keep")).select("of", "item", "key.*"))
        a, b = (entries.where(F.col("is_left") == x).select("of", "item", F.col("id").alias(f"id_{y}"), F.col("n").alias(f"n_{y}")) for x, y in ((True, "l"), (False, "r")))
        met.append(a.join(b.hint("merge"), ["of", "item"]).where(F.least("n_l", "n_r") >= F.greatest("n_l", "n_r") * threshold - 1e-9).select("id_l", "id_r", F.lit(items == "grams").alias("by_edits"), F.lit(items == "words").alias("by_words")))
    side = lambda x: rows.select(F.col("id").alias(f"id_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in ("client", "title", "words")]).hint("merge")
    pairs = met[0].unionByName(met[1]).groupBy("id_l", "id_r").agg(F.max("by_edits").alias("by_edits"), F.max("by_words").alias("by_words")).join(side("l"), "id_l").join(side("r"), "id_r").where("client_l = client_r")
    # a similarity by which a pair did not meet is below the threshold, and so not the better one
    edit = F.when(F.col("by_edits"), 1 - F.levenshtein("title_l", "title_r") / F.greatest(F.length("title_l"), F.length("title_r")))
    score = F.greatest(edit, F.when(F.col("by_words"), X.jaccard(F.col("words_l"), F.col("words_r"))))
    pairs = pairs.select(F.col("client_l").alias("client"), F.col("title_l").alias("title"), F.col("title_r").alias("stored_title"), score.alias("score"))
    return pairs.where(F.col("score") >= threshold)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp similarity, batch by batch over Arrow; null where a side is null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def greedy_matches(pairs: DataFrame, group: str, left: str, right: str, score: str) -> DataFrame:
    """Per group the pairs taken greedily by score, each side once (J17). A group holds one
    sample's few records; groups are independent."""

    def take(t):
        import pyarrow as pa

        used_l, used_r, keep = set(), set(), []
        rows = t.to_pylist()
        for k, r in sorted(enumerate(rows), key=lambda x: (-x[1][score], str(x[1][left]), str(x[1][right]))):
            if r[left] not in used_l and r[right] not in used_r:
                used_l.add(r[left])
                used_r.add(r[right])
                keep.append(k)
        return t.take(pa.array(keep, pa.int64()))

    return pairs.groupBy(group).applyInArrow(take, pairs.schema)
