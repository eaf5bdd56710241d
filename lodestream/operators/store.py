"""Snapshot tables without row updates: merge, field differences, numbering (U, Q)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions.values import PLACEHOLDERS, real_or_null
from lodestream.operators import slices


def field_changes(before: Column, after: Column) -> Column:
    """map(field -> struct(old, new)) of the fields of two maps that differ; a blank new
    value never counts, nor does another order or case of spaces."""
    both = F.map_zip_with(before, after, lambda k, o, n: F.struct(o.alias("old"), n.alias("new")))
    norm = lambda c: F.trim(F.regexp_replace(c, "[ \t\n\r]+", " "))
    return F.map_filter(both, lambda k, v: v["new"].isNotNull() & (F.trim(v["new"]) != "") & ~norm(v["new"]).eqNullSafe(norm(v["old"])))


def merged(rows: DataFrame, key: list[str], order: Column, fields: list[str], fixed: tuple[str, ...] = (), placeholders: tuple[str, ...] = PLACEHOLDERS) -> DataFrame:
    """One row per key: of each field the latest real value, of fixed fields the earliest.

    max_by over a filtered order is an aggregate with partial sums, so no key is sorted in one task."""
    latest = [F.max_by(f, F.when(real_or_null(F.col(f).cast("string"), placeholders).isNotNull(), order)).alias(f) for f in fields if f not in fixed]
    first = [F.min_by(f, F.when(real_or_null(F.col(f).cast("string"), placeholders).isNotNull(), order)).alias(f) for f in fixed]
    return rows.groupBy(*key).agg(*first, *latest)


def upsert(current: DataFrame, incoming: DataFrame, key: list[str], order: str) -> DataFrame:
    """The next snapshot: of each key the row of the greatest ``order``, incoming first on ties."""
    both = current.withColumn("__src", F.lit(0)).unionByName(incoming.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    names = [c for c in both.columns if c not in (*key, "__src")]
    best = F.max_by(F.struct(*names), F.struct(order, "__src"))
    return both.groupBy(*key).agg(best.alias("__b")).select(*key, "__b.*")


def numbered(rows: DataFrame, day: str, order: list[str], start: DataFrame | None = None, out: str = "seq") -> DataFrame:
    """Gap-free numbers per day in the order of arrival, continuing after ``start`` (day, last)."""
    rows = slices.numbered(rows, [day], order, out)
    if start is None:
        return rows
    return rows.join(start, day, "left").withColumn(out, F.col(out) + F.coalesce("last", F.lit(0))).drop("last")


def missing_numbers(rows: DataFrame, day: str, seq: str) -> DataFrame:
    """(day, from_seq, to_seq): the ranges of numbers that a day lacks, from 1 on."""
    gaps = slices.before(rows.select(day, seq).distinct(), [day], [seq], {"last": seq}).withColumn("before", F.coalesce("last", F.lit(0)))
    return gaps.where(F.col(seq) > F.col("before") + 1).select(day, (F.col("before") + 1).alias("from_seq"), (F.col(seq) - 1).alias("to_seq"))
