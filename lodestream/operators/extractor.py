"""A pluggable extractor for texts (X21), and running stored rows through it again."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Extractor = Callable[[list[str | None]], list[dict | None]]


def nothing(texts: list[str | None]) -> list[dict | None]:
    """The default extractor: it knows nothing."""
    return [None] * len(texts)


def extracted(df: DataFrame, text: str, schema: StructType, extractor: Extractor = nothing, size: int = 64, tries: int = 6, pause: float = 0.2) -> DataFrame:
    """df with the columns of ``schema`` from extractor(texts), in Arrow batches of ``size``.

    A call that fails is tried again with growing pauses; one that fails for good gives
    nulls and its error in ``extract_error``, so no row is lost."""
    out = StructType([*df.schema.fields, *schema.fields]).add("extract_error", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                texts, error, made = part.column(batch.schema.get_field_index(text)).to_pylist(), None, None
                for k in range(tries):
                    try:
                        made = extractor(texts)
                        break
                    except Exception as e:  # noqa: BLE001  whatever the plugin raises is reported
                        error = str(e)
                        if k + 1 < tries:
                            time.sleep(pause * 2**k)
                rows = made or [None] * len(texts)
                found = [{n: (r or {}).get(n) for n in schema.names} | {"extract_error": None if made else error} for r in rows]
                yield pa.RecordBatch.from_pylist([a | b for a, b in zip(part.to_pylist(), found)], schema=pa.schema([*batch.schema, *_arrow(schema), ("extract_error", pa.string())]))

    return df.mapInArrow(run, out)


def _arrow(schema: StructType) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(schema))


def reprocessed(stored: DataFrame, key: str, again: DataFrame) -> DataFrame:
    """(key, verdict) of a rerun against what is stored: added, lost, changed or same. The
    dry run of a backfill; writing ``again`` as the next snapshot is the backfill itself."""
    names = [c for c in stored.columns if c != key and c in again.columns]
    digest = lambda df: df.select(key, F.xxhash64(*names).alias("h"))
    j = digest(stored).withColumnRenamed("h", "old").join(digest(again).withColumnRenamed("h", "new"), key, "full_outer")
    verdict = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "lost").when(F.col("old") == F.col("new"), "same").otherwise("changed")
    return j.select(key, verdict.alias("verdict"))
