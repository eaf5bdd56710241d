"""Windows over slices against plain sorts; many slices, hot keys, null keys, ties."""

import random

import pytest
from pyspark.sql import functions as F

from lodestream.operators import slices


def rows(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice(["hot"] * 8 + ["cold", None]), rng.randint(0, 60), k, rng.choice(["a", "b", None])) for k in range(n)]


@pytest.mark.parametrize("most", [5, 50, 10_000])
def test_before(spark, most):
    data = rows(most)
    df = spark.createDataFrame(data, "k string, ms long, id long, v string")
    got = {r["id"]: (r["last_ms"], r["last_v"]) for r in slices.before(df, ["k"], ["ms", "id"], {"last_ms": "ms", "last_v": "v"}, most=most).collect()}
    real = {r["id"]: r["seen"] for r in slices.before(df, ["k"], ["ms", "id"], {"seen": "v"}, real=True, most=most).collect()}
    number = {r["id"]: r["n"] for r in slices.numbered(df, ["k"], ["ms", "id"], "n", most=most).collect()}
    assert len(got) == len(real) == len(number) == len(data)
    for key in {r[0] for r in data}:
        last, seen = (None, None), None
        for n, (_, ms, k, v) in enumerate(sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2])), 1):
            assert got[k] == last and real[k] == seen and number[k] == n
            last, seen = (ms, v), v if v is not None else seen


def test_hot_keys_are_cut(spark):
    df = spark.range(20_000).select(F.lit("x").alias("k"), (F.col("id") * F.col("id")).alias("ms"))
    sizes = [r["count"] for r in slices.sliced(df, ["k"], F.col("ms"), most=1_000).groupBy("__slice").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1_500
    assert slices.sliced(df, ["k"], F.col("ms"), most=20_000).select("__slice").distinct().count() == 1
    assert slices.before(df.limit(0), ["k"], ["ms"], {"last": "ms"}).count() == 0


def test_written_tables_are_removed(spark):
    from lodestream.session import clean, cut

    t = cut(spark.range(5).toDF("x"))
    assert t.count() == 5
    assert clean(spark) >= 1 and clean(spark) == 0
    with pytest.raises(Exception, match="(?i)exist|found"):
        t.count()
