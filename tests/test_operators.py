"""Store, resolution, alert and extraction operators on small fixtures."""

import difflib

from pyspark.sql import functions as F

from lodestream.functions import extract as X
from lodestream.operators import alerts, resolve, store


def test_ranges(spark):
    rows = [("3-5 yrs",), ("3 to 5",), ("8+ years",), ("min 4 years",), ("up to 6",), ("7 years",), ("none",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(X.number_range(F.col("t")).alias("r"), X.number_range(F.col("t"), True).alias("b"))
    got = [(r["r"]["low"], r["r"]["high"], r["b"]["high"]) for r in df.collect()]
    assert got == [(3, 5, 5), (3, 5, 5), (8, None, None), (4, None, None), (None, 6, 6), (7, None, 7), (None, None, None), (None, None, None)]


def test_overlap(spark):
    rows = [(3.0, 5.0, 3.0, 9.0, 3 / 7), (3.0, 6.0, 5.0, 8.0, 2 / 6), (3.0, 5.0, 6.0, 8.0, 0.0), (1.0, 2.0, 9.0, 12.0, 0.0), (None, 2.0, 9.0, 12.0, None), (8.0, None, 8.0, 12.0, 1.0), (4.0, 4.0, 4.0, 4.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, want double").select("want", X.overlap(*map(F.col, "abcd")).alias("got"))
    assert all(r["got"] == r["want"] for r in df.collect())


def test_weights_are_renormalised(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 0.0), (None, None)], "a double, b double").select(X.weighted([(0.75, F.col("a")), (0.25, F.col("b"))]).alias("s"))
    assert [r["s"] for r in df.collect()] == [1.0, 0.75, None]


def test_merge_never_lets_blank_over_real(spark):
    df = spark.createDataFrame([("k", 1, "Pune", "x"), ("k", 2, "TBD", "y"), ("k", 3, None, None)], "k string, o int, place string, first string")
    r = store.merged(df, ["k"], F.col("o"), ["place", "first"], fixed=("first",)).first()
    assert (r["place"], r["first"]) == ("Pune", "x")


def test_upsert_keeps_columns_of_both_sides(spark):
    current = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, o int, p string")
    incoming = spark.createDataFrame([("a", 1, "n"), ("c", 2, "m")], "k string, o int, q string")
    rows = {r["k"]: (r["o"], r["p"], r["q"]) for r in store.upsert(current, incoming, ["k"], "o").collect()}
    assert rows == {"a": (1, None, "n"), "b": (5, "y", None), "c": (2, None, "m")}


def test_numbers_continue_without_gaps(spark):
    rows = spark.createDataFrame([("d1", 2, "x"), ("d1", 1, "y"), ("d2", 1, "z")], "day string, at int, id string")
    start = spark.createDataFrame([("d1", 30)], "day string, last long")
    got = {r["id"]: r["seq"] for r in store.numbered(rows, "day", ["at", "id"], start).collect()}
    assert got == {"y": 31, "x": 32, "z": 1}
    gaps = store.missing_numbers(spark.createDataFrame([("d", 2), ("d", 3), ("d", 7), ("e", 1)], "day string, seq long"), "day", "seq")
    assert sorted(map(tuple, gaps.collect())) == [("d", 1, 1), ("d", 4, 6)]


def test_field_changes(spark):
    df = spark.createDataFrame([({"a": "1", "b": "x  y", "c": "k"}, {"a": "2", "b": "x y", "c": ""})], "o map<string,string>, n map<string,string>")
    got = df.select(store.field_changes(F.col("o"), F.col("n")).alias("c")).first()["c"]
    assert {k: tuple(v) for k, v in got.items()} == {"a": ("1", "2")}


def test_trailing_windows_match_a_plain_count(spark):
    times = [0, 5, 5, 9, 10, 11, 19, 20, 21, 40]
    df = spark.createDataFrame([("k", t) for t in times], "k string, ms long")
    got = sorted((r["ms"], r["n"]) for r in alerts.in_window(df, "k", "ms", 10, "n").collect())
    assert got == sorted((t, sum(t - 10 <= u <= t for u in times)) for t in times)


def test_sequence_ratio(spark):
    pairs = [("data engineer", "data enginer"), ("", ""), ("a", None), ("long " * 90, "long " * 80 + "x")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", resolve.sequence_ratio("a", "b").alias("r"))
    for r in df.collect():
        want = None if r["b"] is None else difflib.SequenceMatcher(None, r["a"], r["b"]).ratio()
        assert (r["r"] is None or r["r"] != r["r"]) if want is None else abs(r["r"] - want) < 1e-12


def test_neighbour_decisions(spark):
    rows = [("1", "c", "java developer", "a,b,c,d", "3-5"), ("2", "c", "java developer", "d,c,b,a", "3-6"), ("3", "c", "java developer 2", "a,b", "9-12"), ("4", "d", "welder", None, None)]
    df = resolve.score_neighbours(spark.createDataFrame(rows, "id string, b string, t string, s string, e string"), ["b"], ["id"], "t", "s", "e")
    got = {r["id"]: r["decision"] for r in df.collect()}
    assert got == {"1": "FIRST", "2": "DUPLICATE", "3": "NEW", "4": "FIRST"}


def test_greedy_takes_each_side_once(spark):
    rows = [("g", "a", "x", 0.9), ("g", "a", "y", 0.8), ("g", "b", "x", 0.7), ("g", "b", "y", 0.1), ("h", "a", "x", 0.0)]
    got = {tuple(r)[:3] for r in resolve.greedy_matches(spark.createDataFrame(rows, "g string, l string, r string, s double"), "g", "l", "r", "s").collect()}
    assert got == {("g", "a", "x"), ("g", "b", "y"), ("h", "a", "x")}


def test_extractor_keeps_rows_that_fail(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from lodestream.operators.extractor import extracted, reprocessed

    schema = StructType([StructField("size", LongType()), StructField("title", StringType())])

    def extractor(texts):
        if "bad" in texts:
            raise ValueError("no")
        return [t and {"size": len(t)} for t in texts]

    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "bad")], "k long, t string").coalesce(1)
    rows = {r["k"]: (r["size"], r["title"], r["extract_error"]) for r in extracted(df, "t", schema, extractor, size=1, tries=2, pause=0.0).collect()}
    assert rows == {1: (3, None, None), 2: (None, None, None), 3: (None, None, "no")}
    assert extracted(df, "t", schema).where("size is null").count() == 3
    again = spark.createDataFrame([(1, "abc"), (3, "x"), (4, "y")], "k long, t string")
    assert {tuple(r) for r in reprocessed(df, "k", again).collect()} == {(1, "same"), (2, "lost"), (3, "changed"), (4, "added")}


def test_sanitized(spark):
    from lodestream.functions.text import sanitized

    r = spark.createDataFrame([({"from_email": "a@b", "note": "x" * 70, "n": "1"},)], "m map<string,string>").select(sanitized(F.col("m")).alias("m")).first()["m"]
    assert r == {"from_email": "[redacted]", "note": "x" * 60 + "...", "n": "1"}
