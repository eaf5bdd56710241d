"""Filling fixed-capacity containers (problem 9).

Documents matter to packing only by their size, and a size is at most the capacity: so
the instance is a histogram of at most ``capacity`` counts, however many documents there
are. On it, Martello-Toth reduction fixes the sets that provably dominate all others with
the same item, then best fit decreasing packs what is left, whole runs of equal sizes at a
time. What comes out is a plan: which places of which container hold items of a size. The
documents are numbered within their size, in parallel, and look their container up.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestream.llm.tokens import VOCABULARY, sizes
from lodestream.session import cut
from lodestream.sources.tables import table

#: Items of one size that are numbered in one task, about.
NUMBERED = 200_000


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Martello-Toth reduction of {size: count}: (fixed sets with how often, the rest).

    For the largest item j in turn, with room r beside it: j alone dominates if nothing
    else fits; j with k, the largest that fits, if k fills r exactly or if no two others
    fit together; j with k and the largest b that fits beside k, if no three others fit
    and every pair that fits is covered by (k, b), each of its items by one of these, or
    both by k. Sets with j that are dominated never make a better packing.
    """
    left = {s: n for s, n in counts.items() if 0 < s <= capacity and n > 0}
    order = sorted(left)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def smallest(k: int, without: int) -> list[int]:
        """The k smallest items, one item of size ``without`` set aside."""
        got: list[int] = []
        for s in order:
            got += [s] * min(k - len(got), left[s] - (s == without))
            if len(got) == k:
                break
        return got

    def largest(room: int, *aside: int) -> int | None:
        """The largest size <= room, items of ``aside`` being used."""
        at = bisect_right(order, room)
        while at:
            at -= 1
            if left[order[at]] > aside.count(order[at]):
                return order[at]
        return None

    def fix(items: tuple[int, ...]) -> None:
        use = {s: items.count(s) for s in items}
        times = min(left[s] // n for s, n in use.items())
        fixed.append((items, times))
        for s, n in use.items():
            left[s] -= n * times
            if not left[s]:
                del left[s]
                del order[bisect_left(order, s)]

    tried = capacity + 1
    while (at := bisect_left(order, tried)) > 0:
        j = order[at - 1]
        room = capacity - j
        k = largest(room, j)
        if k is None:
            fix((j,))
            continue
        low = smallest(3, j)
        if k == room or len(low) < 2 or low[0] + low[1] > room:
            fix((j, k))
            continue
        b = largest(room - k, j, k)
        if b is not None and (len(low) < 3 or sum(low) > room) and _covers(order, left, room, k, b):
            fix((j, k, b))
            continue
        tried = j  # not reducible now
    return fixed, left


def _covers(order: list[int], left: dict[int, int], room: int, k: int, b: int) -> bool:
    """Whether every pair of sizes that fits room is covered by k and b."""
    at = bisect_right(order, b)
    while at < len(order) and 2 * order[at] <= room:  # pairs whose smaller item is over b
        other = order[bisect_right(order, room - order[at]) - 1]
        if order[at] + other > k:
            return False
        at += 1
    return True


def best_fit(counts: dict[int, int], capacity: int, opened: list[tuple[tuple[int, ...], int]] = ()) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit decreasing on {size: count}; ``opened`` containers may be filled up.
    Returns (((size, copies), ...), how many such containers)."""
    bins: dict[int, list[list]] = {}  # room -> [items, times]
    rooms: list[int] = []

    def put(room: int, items: tuple[tuple[int, int], ...], times: int) -> None:
        if room not in bins:
            bins[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        bins[room].append([items, times])

    for items, times in opened:
        put(capacity - sum(items), tuple((s, items.count(s)) for s in dict.fromkeys(items)), times)
    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                room, items, times = capacity, (), n
            else:
                room = rooms[at]
                items, times = bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    del rooms[at]
            q = room // s  # best fit goes on in the container it just used
            full = min(times, n // q)
            if full:
                put(room - q * s, (*items, (s, q)), full)
                n -= q * full
                times -= full
            if times and 0 < n < q:
                put(room - n * s, (*items, (s, n)), 1)
                n, times = 0, times - 1
            if times and items:
                put(room, items, times)
    return [(items, times) for room in bins for items, times in bins[room]]


def plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Runs of places: items of ``size`` numbered from ``start`` go ``copies`` by
    ``copies`` into containers from ``base`` on."""
    fixed, rest = reduce_instance(counts, capacity)
    out: list[tuple[int, int, int, int]] = []
    used: dict[int, int] = {}
    base = 1
    for items, times in best_fit(rest, capacity, fixed):
        for s, q in items:
            out.append((s, used.get(s, 0), q, base))
            used[s] = used.get(s, 0) + q * times
        base += times
    if used != {s: n for s, n in counts.items() if n and s}:
        raise AssertionError("the plan doesn't place every item once")
    out.sort()
    columns = [np.array(c, np.int64) for c in zip(*out)] or [np.zeros(0, np.int64)] * 4
    return dict(zip(("size", "start", "copies", "base"), columns)) | {"containers": base - 1}


def number_within(df: DataFrame, group: str, order: str, total: int, out: str, most: int = NUMBERED) -> DataFrame:
    """df with bigint ``out``: 0, 1, ... within each value of ``group``.

    A group is cut into buckets by a hash of ``order``, buckets are numbered each on its
    own and shifted by the counts of those before, so a group may hold any share of rows.
    """
    buckets = max(16, -(-total // most))
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(order, group), F.lit(buckets)))
    shift = df.groupBy(group, "__bucket").agg(F.count("*").alias("__n"))
    before = W.partitionBy(group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    shift = shift.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = F.row_number().over(W.partitionBy(group, "__bucket").orderBy(order))
    return df.withColumn("__k", inside).join(shift, [group, "__bucket"]).withColumn(out, F.col("__shift") + F.col("__k") - 1).drop("__bucket", "__shift", "__k")


def pack(items: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, part_no, part_tokens, container_id) for items with a unique ``key``.

    An item over the capacity is cut: each full part has a container of its own, the rest
    is packed like other items. Nothing else is cut. An item of size 0 or null takes no
    room and joins a container that is there (spread evenly), or container 1 where there
    is none. Containers are numbered from 1. Rows of a null key are left out, an empty
    table gives an empty result, other columns take no part.
    """
    if capacity < 1:
        raise ValueError("a capacity of 1 or more is needed")
    items = cut(items.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n")))
    rest = F.col("n") % capacity
    # at most ``capacity`` rows, one for each size
    found = items.groupBy(rest.alias("s")).agg(F.count("*").alias("c"), F.sum(F.floor(F.col("n") / capacity)).alias("full"), F.count_if(F.col("n") >= capacity).alias("large")).collect()
    counts = {r["s"]: r["c"] for r in found if r["s"]}
    fulls = sum(r["full"] or 0 for r in found)
    made = plan(counts, capacity)
    containers, big = made["containers"], made["containers"] + fulls
    total = sum(r["c"] for r in found)
    ends = items.where(rest > 0).select("k", "n", rest.alias("s"))
    ends = number_within(ends, "s", "k", total, "i")
    starts = (made["size"] << 40) + made["start"]
    broadcast = items.sparkSession.sparkContext.broadcast((starts, made["start"], made["copies"], made["base"]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, start, copies, base = broadcast.value
        for b in batches:
            s, i, n = (b.column(x).to_numpy() for x in ("s", "i", "n"))
            at = np.searchsorted(starts, (s << 40) + i, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), pa.array((n - s) // capacity + 1), pa.array(s), pa.array(base[at] + (i - start[at]) // copies[at])],
                [key, "part_no", "part_tokens", "container_id"],
            )

    kind = items.schema["k"].dataType.simpleString()
    out = ends.select("k", "n", "s", "i").mapInArrow(look_up, f"`{key}` {kind}, part_no long, part_tokens long, container_id long")
    whole = items.where(F.col("n") >= capacity).select("k", F.floor(F.col("n") / capacity).alias("m"))
    if fulls:
        whole = number_runs(whole, "k", "m", "first", sum(r["large"] for r in found))
        whole = whole.select(F.col("k").alias(key), F.explode(F.sequence(F.lit(1).cast("bigint"), "m")).alias("part_no"), "first")
        out = out.unionByName(whole.select(key, "part_no", F.lit(capacity).cast("bigint").alias("part_tokens"), (F.col("first") + F.col("part_no") + containers).alias("container_id")))
    spread = F.pmod(F.xxhash64("k"), F.lit(max(1, big))) + 1
    none = items.where("n = 0").select(F.col("k").alias(key), F.lit(1).cast("bigint").alias("part_no"), F.lit(0).cast("bigint").alias("part_tokens"), spread.cast("bigint").alias("container_id"))
    return out.unionByName(none)


def number_runs(df: DataFrame, key: str, length: str, out: str, total: int, most: int = NUMBERED) -> DataFrame:
    """df of ``total`` rows with bigint ``out``: the summed ``length`` of the rows before, in no given
    order; buckets of about ``most`` rows are summed each on its own, as in number_within()."""
    buckets = max(16, -(-total // most))
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    shift = df.groupBy("__bucket").agg(F.sum(length).alias("__n"))
    shift = shift.withColumn("__shift", F.coalesce(F.sum("__n").over(W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    inside = F.coalesce(F.sum(length).over(W.partitionBy("__bucket").orderBy(key).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("__k", inside).join(shift, "__bucket").withColumn(out, (F.col("__shift") + F.col("__k")).cast("bigint")).drop("__bucket", "__shift", "__k")


#: (max_tokens, overlap_tokens) of a purpose that token_limits doesn't have.
DEFAULTS = {"container": (2048, 0), "piece": (512, 48)}


def limit(spark: SparkSession, folder: str, purpose: str) -> tuple[int, int]:
    """(max_tokens, overlap_tokens) of a purpose in token_limits; of several the lowest
    limit_id, of none the default."""
    row = table(spark, folder, "token_limits").where((F.col("purpose") == purpose) & (F.col("max_tokens") > 0)).orderBy("limit_id").first()
    return (row["max_tokens"], row["overlap_tokens"] or 0) if row else DEFAULTS[purpose]


def p9_containers(spark: SparkSession, folder: str, path: str = VOCABULARY) -> DataFrame:
    """doc_id, part_no, part_tokens, container_id of all documents."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pack(sizes(documents, "text", path=path), "doc_id", "n_tokens", limit(spark, folder, "container")[0])
