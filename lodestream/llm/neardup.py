"""Near-duplicate records with small edits (problem 7): a grouped prefix join.

Records are sets of items (words, or sequences of words); two are near-duplicates if
their Jaccard similarity reaches a threshold. Sets that are equal are one class. Within a
set, items are ordered by how many sets hold them, the rarest first, from exact counts that
are joined to the items: two similar sets must share an item of their prefixes. Classes with
the same prefix and size are collapsed into one group; groups are joined on the items of
their prefixes, group pairs filtered by size and position; the pairs that are left are
expanded to their member classes, filtered by parities of the members and verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions.values import is_real, placeholder_list
from lodestream.llm.bpe import ragged
from lodestream.llm.wordsets import mixed, word_sets
from lodestream.session import cut
from lodestream.sources.tables import table

#: Parities kept of a set, in bits.
BITMAP = 512
#: Sets of one item that meet in one place; a more frequent item is split.
BLOCK = 50_000
#: Items of all sets for each part of the join.
ENTRIES = 1_500_000
#: Pairs that are looked at together.
PAIRS = 400_000

#: Members of two classes that are paired in one place; larger classes are cut into cells.
CELL = 1_000


def shared_items(rows: DataFrame) -> DataFrame:
    """(item, sets): in how many rows each item stands, of those that stand in two or more; exact,
    and combined before the shuffle."""
    return rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("sets")).where("sets > 1")


def entries_of(rows: DataFrame) -> DataFrame:
    """(class_id, n, item) of the classes of rows (class_id, items), each once in a partition, so
    that a class of very many records is small before any shuffle; n is the set's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = np.zeros(0, np.int64)
        for b in batches:
            fresh = np.unique(b.column("class_id").to_numpy(), return_index=True)[1]
            b = b.take(pa.array(np.sort(fresh)))
            b = b.filter(pa.array(~np.isin(b.column("class_id").to_numpy(), given)))
            given = np.append(given, b.column("class_id").to_numpy())
            n = np.diff(b.column("items").offsets.to_numpy())
            items = b.column("items").flatten()
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("class_id").to_numpy(), n)), pa.array(np.repeat(n, n).astype(np.int32)), items], ["class_id", "n", "item"])

    return rows.select("class_id", "items").mapInArrow(run, "class_id long, n int, item long")


def prefix_length(n: np.ndarray, threshold: float) -> np.ndarray:
    """Two sets of Jaccard similarity >= threshold share an item among so many first ones."""
    return n - np.ceil(n * threshold - 1e-9).astype(np.int64) + 1


_ENTRIES = "part int, class_id long, grp long, n int, shared int, bitmap binary, items array<long>, at array<int>, flag array<int>"
_FIRST = 4


def with_prefixes(entries: DataFrame, threshold: float, parts: int) -> DataFrame:
    """One row for each class of entries (class_id, n, item, sets) and each part that holds items of
    its prefix: those items, their positions and flags, the set's size, how many of its items
    other sets hold too, BITMAP parities of these, and its group (equal prefix and size).

    ``entries`` has the items that several sets hold; what a set has beyond them comes first in its
    order and can't meet anything. An item of more than BLOCK sets is split into 2^k blocks of
    classes; two blocks meet in a list of their own (flags 1 and 2), a block with itself in
    another (flag 0), so no list is longer than two blocks. Such a class's group is cut by the
    same blocks. Flag _FIRST marks the first item of a prefix.
    """

    def prefixes(classes: np.ndarray, n: np.ndarray, item: np.ndarray, sets: np.ndarray) -> pa.RecordBatch:
        """Of whole classes, sorted by class, sets and item; a repeated entry counts once."""
        keep = np.ones(len(item), bool)
        keep[1:] = (classes[1:] != classes[:-1]) | (item[1:] != item[:-1])
        classes, n, item, sets = classes[keep], n[keep].astype(np.int64), item[keep], sets[keep]
        begins = np.ones(len(item), bool)
        begins[1:] = classes[1:] != classes[:-1]
        start = np.flatnonzero(begins)
        doc = np.cumsum(begins) - 1
        shared = np.diff(np.append(start, len(item)))
        who, size = classes[start], n[start]
        parity = np.bincount(doc * BITMAP + (mixed(item.view(np.uint64)) & np.uint64(BITMAP - 1)).astype(np.int64), minlength=len(who) * BITMAP) & 1
        bitmap = np.packbits(parity.astype(np.uint8).reshape(len(who), BITMAP), axis=1)
        position = np.arange(len(item)) - start[doc] + (size - shared)[doc]
        inside = position < prefix_length(size, threshold)[doc]
        first = begins[inside]
        item, sets, doc, position = item[inside], sets[inside], doc[inside], position[inside]
        grp = mixed(size.astype(np.uint64))
        np.add.at(grp, doc, mixed(item.view(np.uint64)))
        blocks = np.int64(1) << np.ceil(np.log2(np.maximum(1, sets / BLOCK))).astype(np.int64)
        most = np.ones(len(who), np.int64)
        np.maximum.at(most, doc, blocks)
        own = mixed(who.view(np.uint64))
        grp = mixed(grp + mixed((own & (most - 1).astype(np.uint64)) + np.uint64(1)))
        flag = np.where(first, _FIRST, 0)
        hot = blocks > 1
        if hot.any():
            i = np.repeat(np.flatnonzero(hot), blocks[hot])
            other = ragged(np.zeros(hot.sum(), np.int64), blocks[hot]).astype(np.uint64)
            mine = own[doc[i]] & (blocks[i] - 1).astype(np.uint64)
            meets = mixed(item[i].view(np.uint64) + mixed(np.minimum(mine, other) * np.uint64(1 << 32) + np.maximum(mine, other) + np.uint64(1))).view(np.int64)
            side = np.where(mine == other, 0, np.where(mine < other, 1, 2))
            item = np.concatenate([item[~hot], meets])
            flag = np.concatenate([flag[~hot], flag[i] | side])
            doc, position = np.concatenate([doc[~hot], doc[i]]), np.concatenate([position[~hot], position[i]])
        part = (mixed(item.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((item, part, doc))
        item, doc, position, part, flag = item[order], doc[order], position[order], part[order], flag[order]
        new = np.ones(len(item), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        offsets = pa.array(np.append(starts, len(item)), pa.int32())
        whose = doc[starts]
        maps = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITMAP // 8), len(who), [None, pa.py_buffer(bitmap.tobytes())]).take(pa.array(whose)).cast(pa.binary())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (item, position.astype(np.int32), flag.astype(np.int32))]
        return pa.RecordBatch.from_arrays(
            [pa.array(part[starts].astype(np.int32)), pa.array(who[whose]), pa.array(grp.view(np.int64)[whose]), pa.array(size[whose].astype(np.int32)), pa.array(shared[whose].astype(np.int32)), maps, *lists],
            ["part", "class_id", "grp", "n", "shared", "bitmap", "items", "at", "flag"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last class, which may go on in the next batch
        for b in batches:
            columns = [b.column(c).to_numpy() for c in ("class_id", "n", "item", "sets")]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns)]
            if not len(columns[0]):
                continue
            at = int(np.flatnonzero(columns[0] != columns[0][-1])[-1]) + 1 if columns[0][0] != columns[0][-1] else 0
            rest = [c[at:] for c in columns]
            if at:
                yield prefixes(*(c[:at] for c in columns))
        if rest is not None:
            yield prefixes(*rest)

    sorted_ = entries.select("class_id", "n", "item", "sets").repartition("class_id").sortWithinPartitions("class_id", "sets", "item")
    return sorted_.mapInArrow(run, _ENTRIES)


def matched(t: pa.Table, threshold: float) -> pa.Table:
    """Class pairs (a, b) of one part that pass the size, position and bitmap filters.

    An overlap of share * (na + nb) is needed. So an entry with r items left (its own
    included) can be the first common item only with partners of at most r / share - n
    items: from each entry, partners in the same item's list of its own size or more up to
    that bound are looked at. Groups are matched; what passes is expanded to the groups'
    classes, and so are groups of several, where their first item stands. Of two sets that
    similar the shared items differ in few parities.
    """
    share = threshold / (1 + threshold)
    class_all = t.column("class_id").to_numpy()
    known, first, of = np.unique(t.column("grp").to_numpy(), return_index=True, return_inverse=True)
    lists = [t.column(c).combine_chunks() for c in ("items", "at", "flag")]
    size = np.diff(lists[0].offsets.to_numpy())
    keep = np.zeros(len(t), bool)
    keep[first] = True  # the entries of a group are equal in all its classes
    row = np.repeat(np.arange(len(t)), size)
    inside = keep[row]
    row = row[inside]
    item, at, flag = (x.flatten().to_numpy()[inside].astype(np.int64) for x in lists)
    sizes, shared = (t.column(c).to_numpy().astype(np.int64) for c in ("n", "shared"))
    maps = np.frombuffer(b"".join(t.column("bitmap").to_pylist()), np.uint64).reshape(-1, BITMAP // 64)
    grp, n = of[row], sizes[row]
    order = np.lexsort((grp, n, item))
    item, grp, n, at, flag = item[order], grp[order], n[order], at[order], flag[order]
    cap = np.floor((n - at) / share + 1e-9).astype(np.int64) - n
    rank = np.cumsum(np.append(0, item[1:] != item[:-1]))
    width = int(n.max()) + 2 if len(n) else 2
    key = rank * width + n
    stop = np.searchsorted(key, rank * width + np.minimum(cap, width - 1), "right")
    begin = np.arange(len(key)) + 1
    many = np.where(cap >= n, np.maximum(0, stop - begin), 0)
    total = np.cumsum(many)
    side = flag & 3
    # members by group
    members = np.argsort(of, kind="stable")
    amount = np.bincount(of, minlength=len(known))
    where = np.cumsum(amount) - amount

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of rows differ in few enough parities."""
        most = shared[a] + shared[b] - 2 * np.ceil((sizes[a] + sizes[b]) * share - 1e-9).astype(np.int64)
        return np.bitwise_count(maps[a] ^ maps[b]).sum(1, dtype=np.int64) <= most

    singles: list[np.ndarray] = []
    several: list[np.ndarray] = []
    for k in range(0, int(total[-1]) if len(total) else 0, PAIRS):
        i = np.arange(np.searchsorted(total, k, "right"), min(np.searchsorted(total, k + PAIRS, "left") + 1, len(many)))
        before = total[i] - many[i]
        skip = np.maximum(0, k - before)
        some = np.minimum(total[i], k + PAIRS) - np.maximum(before, k)
        i, skip, some = i[some > 0], skip[some > 0], some[some > 0]
        a, b = np.repeat(i, some), ragged(begin[i] + skip, some)
        ok = (cap[b] >= n[a]) & ((side[a] == 0) | (side[a] != side[b])) & (grp[a] != grp[b])
        a, b = grp[a[ok]], grp[b[ok]]
        one = (amount[a] == 1) & (amount[b] == 1)
        close = one.copy()
        close[one] = near(first[a[one]], first[b[one]])
        for found, which in ((singles, close), (several, ~one)):
            found.append(np.unique(np.minimum(a[which], b[which]) * len(known) + np.maximum(a[which], b[which])))
    pairs_of = lambda found: np.divmod(np.unique(np.concatenate(found)), len(known)) if found else (np.zeros(0, np.int64),) * 2
    a, b = pairs_of(singles)
    out = [(class_all[first[a]], class_all[first[b]])]
    ga, gb = pairs_of(several)
    alone = np.unique(grp[(flag == _FIRST) & (amount[grp] > 1)])
    for x, y in zip(np.concatenate([ga, alone]).tolist(), np.concatenate([gb, alone]).tolist()):
        left, right = members[where[x] : where[x] + amount[x]], members[where[y] : where[y] + amount[y]]
        step = max(1, PAIRS // len(right))
        for k in range(0, len(left), step):
            some = left[k : k + step]
            a, b = np.repeat(some, len(right)), np.tile(right, len(some))
            ok = near(a, b) if x != y else near(a, b) & (a < b)
            out.append((class_all[a[ok]], class_all[b[ok]]))
    a, b = (np.concatenate(x) for x in zip(*out))
    a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def similar_classes(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b) with a < b: all pairs of classes whose sets have Jaccard similarity >= threshold.

    ``rows`` has class_id (bigint, the same for equal sets) and items (sorted distinct
    hashes, none empty), and is read several times, so it should be a written table.
    """
    items = cut(shared_items(rows))
    held = items.agg(F.sum("sets")).first()[0] or 0
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, held // ENTRIES)
    entries = with_prefixes(entries_of(rows).join(items, "item"), threshold, parts)
    # the number of parts stands, as their work is more than their bytes tell
    candidates = cut(entries.repartition(parts, "part").groupBy("part").applyInArrow(lambda t: matched(t, threshold), "a long, b long").distinct())
    # exact, on the sets themselves
    some = candidates.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
    sets = rows.select("class_id", "items").join(some, "class_id", "left_semi").groupBy("class_id").agg(F.first("items").alias("items"))
    found = candidates.join(sets.select(F.col("class_id").alias("a"), F.col("items").alias("sa")), "a").join(sets.select(F.col("class_id").alias("b"), F.col("items").alias("sb")), "b")
    found = found.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return found.where(F.col("common") >= (F.size("sa") + F.size("sb") - F.col("common")) * threshold - 1e-9).select("a", "b")


def near_duplicates(sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(membership, links) of records (key, items).

    membership: (key, class_id, class_size, representative) of every record with a
    non-empty set; equal sets are one class, its least key the representative. links:
    (a, b), all pairs of classes at or over the threshold. Null keys and empty sets are in
    no class; repeated rows count once; a key with several sets is in several classes.
    """
    rows = sets.select("key", "items").where(F.col("key").isNotNull() & (F.size("items") > 0))
    rows = cut(rows.withColumn("class_id", F.xxhash64("items")))
    membership = rows.select("key", "class_id").distinct()
    sizes = membership.groupBy("class_id").agg(F.count("*").alias("class_size"), F.min("key").alias("representative"))
    membership = membership.join(sizes, "class_id").select("key", "class_id", "class_size", "representative")
    return membership, cut(similar_classes(rows, threshold))


def record_pairs(membership: DataFrame, links: DataFrame, expanded: int | None = None) -> DataFrame:
    """(key_a, key_b) with key_a < key_b from classes and links: all pairs of records of one
    class and of linked ones, whatever their number.

    With ``expanded``, a shorter list on request: of a class of more records each member is
    paired with the representative, and that alone with other classes' records.
    """
    small = F.lit(True) if expanded is None else F.col("class_size") <= expanded
    speaks = membership.where(small | (F.col("key") == F.col("representative")))
    cells = F.when(small, F.ceil(F.col("class_size") / CELL)).otherwise(1)
    members = speaks.select("class_id", "key", F.pmod(F.xxhash64("key"), cells).alias("cell"))
    large = membership.where(small & (F.col("class_size") > CELL)).groupBy("class_id").agg(F.first(cells).alias("cells"))
    within = membership.where(small & (F.col("class_size") > 1)).select("class_id").distinct()
    met = links.select("a", "b").unionByName(within.select(F.col("class_id").alias("a"), F.col("class_id").alias("b")))
    for c in "ab":
        met = met.join(large.select(F.col("class_id").alias(c), F.col("cells").alias(f"cells_{c}")), c, "left")
        met = met.withColumn(f"cell_{c}", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(f"cells_{c}", F.lit(1)) - 1))).drop(f"cells_{c}")
    side = lambda c: members.select(F.col("class_id").alias(c), F.col("cell").alias(f"cell_{c}"), F.col("key").alias(f"key_{c}"))
    # of a class with itself each pair is met twice
    once = F.when(F.col("a") == F.col("b"), F.col("key_a") < F.col("key_b")).otherwise(F.col("key_a") != F.col("key_b"))
    pairs = met.join(side("a"), ["a", "cell_a"]).join(side("b"), ["b", "cell_b"]).where(once).select("key_a", "key_b")
    if expanded is not None:
        pairs = pairs.unionByName(membership.where(~small & (F.col("key") != F.col("representative"))).select(F.col("representative").alias("key_a"), F.col("key").alias("key_b")))
    return pairs.select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b")).distinct()


def opening_mails(spark: SparkSession, folder: str) -> DataFrame:
    """(key, items): sequences of three adjacent words of the mails that open a topic."""
    mails = table(spark, folder, "outlook_messages").where("in_reply_to is null and graph_id is not null and body_plain is not null")
    return word_sets(mails.select(F.col("graph_id").alias("key"), F.col("body_plain").alias("text")), "text", 3)


def requirement_words(spark: SparkSession, folder: str) -> DataFrame:
    """(key, items): words of title and skills of the requirements that have both."""
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    rows = table(spark, folder, "final_corrected_requirements").where("job_id is not null").where(is_real(F.col("job_title"), placeholders) & is_real(F.col("mandatory_skills"), placeholders))
    return word_sets(rows.select(F.col("job_id").alias("key"), F.concat_ws("\n", "job_title", "mandatory_skills").alias("text")), "text", 1)


SOURCES = (("outlook_messages", opening_mails, 0.5), ("final_corrected_requirements", requirement_words, 0.75))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """table_name, key_a, key_b of all near-duplicate records of both tables."""
    parts = [record_pairs(*near_duplicates(sets(spark, folder), t)).select(F.lit(name).alias("table_name"), "key_a", "key_b") for name, sets, t in SOURCES]
    return parts[0].unionByName(parts[1])


def p7_documents(spark: SparkSession, folder: str) -> DataFrame:
    """table_name, record_key, class_id, class_size, links of every record: its class of equal
    records, named by its least key, and how many other classes are near-duplicates of it."""
    parts = []
    for name, sets, t in SOURCES:
        membership, links = near_duplicates(sets(spark, folder), t)
        ends = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
        rows = membership.join(ends, "class_id", "left")
        parts.append(rows.select(F.lit(name).alias("table_name"), F.col("key").alias("record_key"), F.col("representative").alias("class_id"), "class_size", F.coalesce("links", F.lit(0)).cast("bigint").alias("links")))
    return parts[0].unionByName(parts[1])


def _pairs_sql(items: str, table_name: str, threshold: float) -> str:
    """SQL for (k, x) items of a table: s the sets, n their sizes, p the pairs, by shared items."""
    return f"""s_{table_name} AS (SELECT DISTINCT k, x FROM ({items})), n_{table_name} AS (SELECT k, count(*) AS n, md5(string_agg(x, chr(1) ORDER BY x)) AS cls FROM s_{table_name} GROUP BY k),
        c_{table_name} AS (SELECT a.k AS ka, b.k AS kb, count(*) AS c FROM s_{table_name} a JOIN s_{table_name} b ON a.x = b.x AND a.k < b.k GROUP BY 1, 2),
        p_{table_name} AS (SELECT ka, kb, na.cls AS ca, nb.cls AS cb FROM c_{table_name} JOIN n_{table_name} na ON na.k = ka JOIN n_{table_name} nb ON nb.k = kb WHERE c >= {threshold} * (na.n + nb.n - c) - 1e-9)"""


_REAL = "({0} IS NOT NULL AND lower(trim({0})) NOT IN (SELECT placeholder FROM placeholder_values))"
_MAIL_ITEMS = r"""SELECT k, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS x FROM
        (SELECT graph_id AS k, regexp_extract_all(lower(body_plain), '[\p{L}\p{N}]+') AS w FROM outlook_messages WHERE in_reply_to IS NULL AND graph_id IS NOT NULL)"""
_DEMAND_ITEMS = rf"""SELECT job_id AS k, unnest(regexp_extract_all(lower(job_title || chr(10) || mandatory_skills), '[\p{{L}}\p{{N}}]+')) AS x FROM final_corrected_requirements
        WHERE job_id IS NOT NULL AND {_REAL.format("job_title")} AND {_REAL.format("mandatory_skills")}"""
_WITH = f"WITH {_pairs_sql(_MAIL_ITEMS, 'outlook_messages', 0.5)}, {_pairs_sql(_DEMAND_ITEMS, 'final_corrected_requirements', 0.75)} "

P7_FOUND_SQL = _WITH + " UNION ALL ".join(f"SELECT '{name}' AS table_name, ka AS key_a, kb AS key_b FROM p_{name}" for name, _, _ in SOURCES)
P7_DOCUMENTS_SQL = _WITH + " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, n.k AS record_key, min(n.k) OVER (PARTITION BY n.cls) AS class_id, count(*) OVER (PARTITION BY n.cls) AS class_size, coalesce(l.links, 0) AS links FROM n_{name} n
        LEFT JOIN (SELECT cls, count(DISTINCT other) AS links FROM (SELECT ca AS cls, cb AS other FROM p_{name} WHERE ca <> cb UNION ALL SELECT cb, ca FROM p_{name} WHERE ca <> cb) GROUP BY 1) l ON l.cls = n.cls"""
    for name, _, _ in SOURCES
)
