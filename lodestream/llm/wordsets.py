"""Sets of words or word sequences, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestream.llm.tokens import chunks

_WORD = re.compile(r"[^\W_]+")
#: Distinct words that a worker remembers before it starts afresh.
REMEMBERED = 500_000
_known: dict[str, int] = {}


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words end to end, and how many words each text has."""
    if len(_known) > REMEMBERED:
        _known.clear()
    split = [_WORD.findall(t.lower()) if t else [] for t in texts]
    flat = [w for words in split for w in words]
    for w in set(flat).difference(_known):
        _known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(_known.__getitem__, flat), np.uint64, len(flat)), np.fromiter(map(len, split), np.int64, len(texts))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sets_of(texts: list[str | None], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct sequences of ``length`` adjacent words of each text: sorted hashes end
    to end, and their number. A text of fewer words has none."""
    words, n = hashed_words(texts)
    doc = np.repeat(np.arange(len(texts)), n)
    if len(words) < length:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    h = words[: len(words) - length + 1]
    for k in range(1, length):
        h = mixed(h) + words[k : len(words) - length + 1 + k]
    h = mixed(h).view(np.int64)
    inside = doc[: len(h)] == doc[length - 1 :]
    h, doc = h[inside], doc[: len(h)][inside]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(texts))


def word_sets(df: DataFrame, text: str, length: int, out: str = "items") -> DataFrame:
    """df with the sorted array of hashes in place of ``text``; empty for null and short texts."""
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, len(kept)):
                h, n = sets_of(part.column(len(kept)).to_pylist(), length)
                made = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(h))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], [*kept, out])

    return df.select(*kept, text).mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.ArrayType(T.LongType(), False))]))
