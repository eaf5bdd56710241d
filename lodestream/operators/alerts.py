"""Alerts over time: cooldown by quiet gaps, counts in trailing windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestream.operators.slices import before

DAY_MS = 86_400_000


def cooled(rows: DataFrame, key: str, ms: str, quiet_ms: int, tie: str) -> DataFrame:
    """The rows before which their key was quiet for at least quiet_ms; the first always. A key
    may hold any share of the rows."""
    rows = before(rows, [key], [ms, tie], {"__last_ms": ms})
    return rows.where(F.col("__last_ms").isNull() | (F.col(ms) - F.col("__last_ms") >= quiet_ms)).drop("__last_ms")


def in_window(rows: DataFrame, key: str, ms: str, width_ms: int, out: str) -> DataFrame:
    """rows with how many of their key lie in the width_ms up to and with them.

    A key may hold any share of the rows: time is cut into slices of the window's width,
    each row is also counted in the next slice, and a slice is one window partition, so no
    task sorts more than two slices of a key."""
    sliced = rows.withColumn("__slice", F.floor(F.col(ms) / width_ms)).withColumn("__own", F.explode(F.array(F.lit(True), F.lit(False))))
    sliced = sliced.withColumn("__slice", F.when(F.col("__own"), F.col("__slice")).otherwise(F.col("__slice") + 1))
    w = W.partitionBy(key, "__slice").orderBy(ms).rangeBetween(-width_ms, 0)
    return sliced.withColumn(out, F.count("*").over(w)).where("__own").drop("__slice", "__own")
