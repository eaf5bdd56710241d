"""Windows over keys that may hold any share of the rows: a key is cut into slices of its order.

A window sorts each key in one task. Here a key of more than SLICE_ROWS rows is cut at quantiles
of its order, estimated in one aggregation; every slice is sorted alone, and what a row needs
from before its slice comes from one row per slice. Keys below that are one slice.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Keys of more rows are cut, into at most QUANTILES slices.
SLICE_ROWS, QUANTILES = 500_000, 1_000


def attached(rows: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """rows left-joined to ``few``, one row per key; null keys meet too."""
    others = [c for c in few.columns if c not in keys]
    few = few.select(*[F.col(k).alias(f"__of_{k}") for k in keys], *others)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    return rows.join(few, same, "left").drop(*[f"__of_{k}" for k in keys])


def has_hot_key(rows: DataFrame, keys: list[str], most: int = SLICE_ROWS) -> bool:
    """Whether a key has more than ``most`` rows: one aggregation, of which one row comes back. Where
    none has, a plain window sorts no more than that in a task, and slices would only cost."""
    return rows.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > most).limit(1).count() > 0


def sliced(rows: DataFrame, keys: list[str], place: Column, most: int = SLICE_ROWS) -> DataFrame:
    """rows with ``__slice``: 0, 1, ... along the number ``place`` within each key, so that slices
    have about ``most`` rows or a thousandth of the key's. Rows of one place are in one slice; a
    null place is in the first."""
    rows = rows.withColumn("__place", place.cast("double"))
    hot = rows.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > most)
    cuts = attached(rows.select(*keys, "__place"), hot, keys).where("__n is not null")
    cuts = cuts.groupBy(*keys).agg(F.percentile_approx("__place", [k / QUANTILES for k in range(1, QUANTILES)], 10 * QUANTILES).alias("__cuts"), F.max("__n").alias("__n"))
    # as many of the quantiles as the key needs slices
    step = F.greatest(F.lit(1), F.floor(F.lit(QUANTILES) * most / F.col("__n"))).cast("int")
    cuts = cuts.select(*keys, F.array_distinct(F.filter("__cuts", lambda x, k: (k + 1) % step == 0)).alias("__cuts"))
    rows = attached(rows, cuts, keys)
    return rows.withColumn("__slice", F.coalesce(F.size(F.filter("__cuts", lambda x: x < F.col("__place"))), F.lit(0))).withColumn("__slice", F.greatest("__slice", F.lit(0))).drop("__cuts", "__place")


def before(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, str], place: Column | None = None, real: bool = False, most: int = SLICE_ROWS) -> DataFrame:
    """rows with new columns {out: column}: that column's value in the row before, by ``order``
    within the keys; null in the first row. ``real``: the last value that isn't null instead.

    ``place`` is a number that rises with the order, of which the first column is the default. The
    order should be total; null keys are a key. An empty table gives an empty result.
    """
    if not has_hot_key(rows, keys, most):
        w = W.partitionBy(*keys).orderBy(*order)
        one = (lambda c: F.last(c, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))) if real else (lambda c: F.lag(c).over(w))
        return rows.withColumns({out: one(c) for out, c in values.items()})
    s = sliced(rows, keys, F.col(order[0]) if place is None else place, most)
    inside = W.partitionBy(*keys, "__slice").orderBy(*order)
    along = W.partitionBy(*keys).orderBy("__slice")
    at = F.struct(F.lit(1).alias("is"), *order)
    if real:
        ends = s.groupBy(*keys, "__slice").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"__last_{out}") for out, c in values.items()])
        carried = along.rowsBetween(W.unboundedPreceding, -1)
        ends = ends.select(*keys, "__slice", *[F.last(f"__last_{out}", ignorenulls=True).over(carried).alias(f"__carried_{out}") for out in values])
        for out, c in values.items():
            s = s.withColumn(f"__inside_{out}", F.last(c, ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, -1)))
        s = attached(s, ends, [*keys, "__slice"])
        for out in values:
            s = s.withColumn(out, F.coalesce(f"__inside_{out}", f"__carried_{out}"))
        return s.drop("__slice", *[f"__{x}_{out}" for out in values for x in ("inside", "carried")])
    row = F.struct(*[F.col(c).alias(out) for out, c in values.items()])
    ends = s.groupBy(*keys, "__slice").agg(F.max_by(row, at).alias("__last"))
    ends = ends.select(*keys, "__slice", F.lag("__last").over(along).alias("__carried"))
    s = attached(s.withColumn("__before", F.lag(row).over(inside)), ends, [*keys, "__slice"])
    s = s.withColumn("__before", F.coalesce("__before", "__carried"))
    return s.select(*rows.columns, *[F.col(f"__before.{out}").alias(out) for out in values])


def numbered(rows: DataFrame, keys: list[str], order: list[str], out: str, place: Column | None = None, most: int = SLICE_ROWS) -> DataFrame:
    """rows with bigint ``out``: 1, 2, ... by ``order`` within the keys; see before()."""
    if not has_hot_key(rows, keys, most):
        return rows.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    s = sliced(rows, keys, F.col(order[0]) if place is None else place, most)
    sums = s.groupBy(*keys, "__slice").agg(F.count("*").alias("__n"))
    ahead = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*keys, "__slice", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    s = s.withColumn("__k", F.row_number().over(W.partitionBy(*keys, "__slice").orderBy(*order)))
    return attached(s, sums, [*keys, "__slice"]).withColumn(out, (F.col("__ahead") + F.col("__k")).cast("bigint")).drop("__slice", "__k", "__ahead")


def id_place(c: Column) -> Column:
    """A number that rises with an id that holds its day, as YYYY/MM/DD-N or REQ-YYYYMMDD-N."""
    return F.substring(F.regexp_replace(c, "[^0-9]", ""), 1, 8).try_cast("int")
