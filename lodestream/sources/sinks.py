"""Writing results: reports (SK4-SK6, SK9), append logs by day, rejected rows (SK8), pluggable delivery with a
store for what failed (SK1, SK3, SK11, T6, T12b, T12c)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


#: A report of up to so many rows is one file.
ONE_FILE = 100_000


def report(df: DataFrame, path: str, columns: list[str], kind: str = "csv") -> None:
    """A report of given columns; missing ones are empty. One file up to ONE_FILE rows, which are
    counted first, a file for each partition beyond."""
    have = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    small = df.limit(ONE_FILE + 1).count() <= ONE_FILE
    out = (df.coalesce(1) if small else df).select(*have).write.mode("overwrite")
    out.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path) if kind == "csv" else out.format(kind).save(path)


def append_by_day(df: DataFrame, path: str, ms: str) -> None:
    """Rows appended to a log that is partitioned by UTC day, so that reads prune."""
    day = F.date_format(F.timestamp_add("MILLISECOND", F.col(ms), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")), "yyyy-MM-dd")
    df.withColumn("day", day).write.mode("append").partitionBy("day").parquet(path)


def split_rejected(df: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows without and with a reason; none is lost."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def deliver(post: Callable[[dict], None], fallback: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that posts each row from the executors; rows whose delivery
    fails are kept in ``fallback`` with the error, to be tried again."""

    def batch(df: DataFrame, batch_id: int) -> None:
        names = df.columns
        schema = df.withColumn("error", F.lit(None).cast("string")).schema
        kinds = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = b.to_pylist()
                for r in rows:
                    try:
                        post(dict(r))
                        r["error"] = None
                    except Exception as e:  # noqa: BLE001  any failure of a delivery is kept
                        r["error"] = str(e)
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

        done = df.mapInArrow(run, schema)
        done.where("error is not null").select(*names, "error", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("append").parquet(fallback)

    return batch
