"""Streaming ingest: permanent seen-set, watermarked windows, alert cooldown with state (T).

Mail that comes late is never dropped by ``seen_ingest``: a permanent table of seen keys
takes the place of a watermark. Where bounded state matters more, ``bounded_distinct``
forgets keys after a delay. Batches are idempotent: a batch that is run again after a
failure writes the same folder again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


#: Buckets of the permanent seen-set.
SEEN_BUCKETS = 64


def seen_ingest(stream: DataFrame, key: str, out: str, checkpoint: str, trigger: dict | None = None, each: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Writes rows of ``stream`` whose key was never seen to out/data, keys to out/seen.

    Seen keys lie in SEEN_BUCKETS buckets of their hash; a batch reads those of its own keys only."""
    bucket = F.pmod(F.xxhash64(key), F.lit(SEEN_BUCKETS)).cast("int")

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        keys = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/seen")
        fs = keys.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fresh = df.where(F.col(key).isNotNull()).dropDuplicates([key])
        if fs.exists(keys):
            # this batch's own earlier attempt doesn't count as seen
            mine = [r[0] for r in fresh.select(bucket).distinct().collect()]  # at most SEEN_BUCKETS
            seen = spark.read.parquet(f"{out}/seen").where((F.col("batch") < batch_id) & F.col("bucket").isin(mine)).select(key)
            fresh = fresh.join(seen, key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")
        kept = spark.read.parquet(f"{out}/data/batch={batch_id}")
        if each:
            each(kept, batch_id)
        kept.select(key, bucket.alias("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/seen/batch={batch_id}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def bounded_distinct(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """Rows with distinct keys, where a key is remembered for ``delay`` of event time."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_failures(stream: DataFrame, time: str, kind: str, width: str = "30 minutes", slide: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts per kind in sliding windows of event time, closed ``late`` after their end."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width, slide), kind).agg(F.count("*").alias("n"))


def cooled_alerts(stream: DataFrame, key: str, ms: str, quiet_ms: int) -> DataFrame:
    """(key, ms, is_sent): an alert is sent after a quiet time; suppressed ones prolong it.

    The state of a key is the time of its last alert. Alerts of a key may come in several
    batches; within a batch they are taken in order of time."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(ms)
        sent = []
        for t in rows[ms]:
            sent.append(last is None or t - last >= quiet_ms)
            last = int(t) if last is None else max(last, int(t))
        state.update((last,))
        yield pd.DataFrame({key: k[0], ms: rows[ms].astype("int64"), "is_sent": sent})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {ms} long, is_sent boolean", "last long", "append", GroupStateTimeout.NoTimeout)


def heartbeats(query: StreamingQuery) -> list[dict]:
    """The recent progress of a query as heartbeat rows (SK10, T15)."""
    return [{"batch_id": p["batchId"], "started_at": p["timestamp"], "rows": p["numInputRows"]} for p in query.recentProgress]
