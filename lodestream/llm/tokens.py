"""Encoding of a corpus with a public tokenizer (problem 8), and sizes in its tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lodestream.llm.bpe import Encoder
from lodestream.sources.tables import table

#: Where the tokenizer's file lies; a parameter everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

#: Characters that a worker encodes at a time.
CHUNK_CHARS = 2_000_000

_encoders: dict[int, Encoder] = {}


def shipped(spark: SparkSession, path: str = VOCABULARY) -> Broadcast:
    """The vocabulary file's bytes (about 1.5 MB) for the workers, which need no file then."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoder_of(vocabulary: Broadcast) -> Encoder:
    """The worker's encoder, built once from the shipped bytes."""
    raw = vocabulary.value
    key = hash(raw)
    if key not in _encoders:
        _encoders[key] = Encoder(raw)
    return _encoders[key]


def chunks(batch: pa.RecordBatch, column: int, most: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, however long single texts are."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def encode(df: DataFrame, text: str, out: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """df with the list of token ids of ``text`` in place of the text, named ``out``.

    Null and empty texts have an empty list. Repeated rows stay; other columns are kept as
    they are, unless one is called ``out``, which is refused. No shuffle: each partition is
    encoded as it is read.
    """
    return _mapped(df, text, out, T.ArrayType(T.IntegerType(), False), path, _ids)


def sizes(df: DataFrame, text: str, out: str = "n_tokens", path: str = VOCABULARY) -> DataFrame:
    """df with the number of tokens of ``text`` in place of the text; 0 for null and empty."""
    return _mapped(df, text, out, T.LongType(), path, _counts)


def _ids(enc: Encoder, texts: list) -> pa.Array:
    ids, n = enc.encode(texts)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(ids, pa.int32()))


def _counts(enc: Encoder, texts: list) -> pa.Array:
    return pa.array(enc.count(texts), pa.int64())


def _mapped(df: DataFrame, text: str, out: str, kind: T.DataType, path: str, f: Callable[[Encoder, list], pa.Array]) -> DataFrame:
    kept = [c for c in df.columns if c != text]
    if out in kept:
        raise ValueError(f"there is a column {out} already")
    vocabulary = shipped(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(vocabulary)
        for batch in batches:
            for part in chunks(batch, len(kept)):
                made = f(enc, part.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], [*kept, out])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, kind, False)])
    return df.select(*kept, text).mapInArrow(run, schema)


def p8_ids(spark: SparkSession, folder: str, path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids of every document by byte_bpe_50k."""
    return encode(table(spark, folder, "documents").select("doc_id", "text").where("doc_id is not null"), "text", path=path)
