"""Splitting oversized texts at natural boundaries (problem 10).

A text is a tree: sections under headings (by depth), paragraphs, list items and lines,
sentences, words. Siblings are merged from below as long as they fit the limit together;
only a node that is itself too large is taken apart into its children. A word without any
boundary inside is cut between tokens. Sizes are tokens of a public tokenizer, counted
once per text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lodestream.llm.bpe import Encoder
from lodestream.llm.packing import limit
from lodestream.llm.tokens import VOCABULARY, chunks, encoder_of, shipped
from lodestream.sources.tables import table

#: Strength of a boundary; a lower level is a larger part of the text.
SECTION, PARAGRAPH, ITEM, LINE, SENTENCE, WORD = 0, 7, 8, 9, 10, 11

_HEADING = re.compile(
    r"^[ \t]*(?:(?P<hash>#{1,6})[ \t]+\S"
    r"|<h(?P<tag>[1-6])\b"
    r"|(?P<number>\d+(?:\.\d+){0,4})\.?[ \t]+[^\W\d_][^\n]{0,70}\n(?=[ \t]*\n)"
    r"|(?P<rule>(?:[=*~_#-][ \t]?){4,}$|-- [^\n]{1,60} --$)"
    r"|(?P<caps>[^a-z\n]{0,10}[A-Z][^a-z\n]{3,60}:?[ \t]*$))",
    re.M,
)
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n\s*|<(?:p|div|table|section|article)\b[^>]*>|</(?:p|div|table|section|article)>", re.I)
_ITEM = re.compile(r"\n(?=[ \t]*(?:[-*+•◦·>|]|\(?\w{1,3}[.)])[ \t])|<(?:li|tr|dt|dd)\b[^>]*>|(?=<(?:li|tr)\b)", re.I)
_LINE = re.compile(r"\r?\n|\r|<br\s*/?>", re.I)
_SENTENCE = re.compile(r"[.!?…]+[\"'”’)\]]*\s+|[。！？]+[”’」』]*|[।॥]\s*|[;:]\s+")


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, levels) of the natural boundaries of a text, by offset; the strongest counts."""
    found: dict[int, int] = {}
    for m in _SENTENCE.finditer(text):
        found[m.end()] = SENTENCE
    for m in _LINE.finditer(text):
        found[m.end()] = LINE
    for m in _ITEM.finditer(text):
        found[m.end()] = ITEM
    for m in _PARAGRAPH.finditer(text):
        found[m.end()] = PARAGRAPH
    for m in _HEADING.finditer(text):
        depth = 1
        if m["hash"]:
            depth = len(m["hash"])
        elif m["tag"]:
            depth = int(m["tag"])
        elif m["number"]:
            depth = min(6, 1 + m["number"].count("."))
        elif m["caps"]:
            depth = 2
        found[m.start()] = SECTION + depth
    at = np.array(sorted(x for x in found if 0 < x < len(text)), np.int64)
    return at, np.array([found[x] for x in at.tolist()], np.int8)


def cuts(weight: np.ndarray, level: np.ndarray, most: int, least: int = 0) -> list[int]:
    """Where to cut a row of units into runs of at most ``most`` weight.

    ``weight`` of each unit, ``level`` of the boundary before each unit (that of unit 0
    doesn't matter). Returns the units before which a cut lies. Each unit must fit alone.
    Siblings of ``least`` weight or less before a node that is too large join it.
    """
    level = level.copy()
    total = np.concatenate([[0], np.cumsum(weight)])

    def pack(a: int, b: int) -> list[tuple[int, int]]:
        """Runs that tile units a..b, for a node that is too large."""
        inner = level[a + 1 : b]
        if not len(inner):
            return [(a, b)]
        top = inner.min()
        edges = [a, *(a + 1 + np.flatnonzero(inner == top)).tolist(), b]
        runs: list[tuple[int, int]] = []
        open_: tuple[int, int] | None = None  # siblings merged so far
        for x, y in zip(edges, edges[1:]):
            if open_ and total[y] - total[open_[0]] <= most:
                open_ = (open_[0], y)
                continue
            if open_ and total[y] - total[x] > most and total[x] - total[open_[0]] <= least:
                level[x] = WORD
                x = open_[0]
            elif open_:
                runs.append(open_)
            open_ = None
            if total[y] - total[x] <= most:
                open_ = (x, y)
            else:
                parts = pack(x, y)
                if runs and total[parts[0][1]] - total[runs[-1][0]] <= most:  # a short rest before takes the child's beginning
                    parts[0] = (runs.pop()[0], parts[0][1])
                runs += parts[:-1]
                open_ = parts[-1]
        if open_:
            runs.append(open_)
        return runs

    if total[-1] <= most:
        return []
    return [a for a, _ in pack(0, len(weight))][1:]


Piece = tuple[int, int, int, int, int]


def split_text(enc: Encoder, text: str | None, most: int, overlap: int) -> list[Piece]:
    """Pieces of one text; see split_texts()."""
    return split_texts(enc, [text], most, overlap)[0]


def split_texts(enc: Encoder, texts: list[str | None], most: int, overlap: int) -> list[list[Piece]]:
    """Pieces of each text as (start_char, end_char, start_token, end_token, n_tokens).

    Offsets are into the text and its token sequence. A piece starts ``overlap`` tokens
    before the end of the one before (one or a few more where that falls inside a
    character); ends tile the text. n_tokens is what the piece's own text encodes to,
    which is at most ``most``, as is the span. Null and empty texts have no piece.
    """
    if overlap < 0 or most - overlap < 5:
        raise ValueError("the limit must exceed the overlap by 5 or more")
    out: list[list[Piece] | None] = [None] * len(texts)
    left, reserve = list(range(len(texts))), 4
    while left:
        # a piece may begin inside a word, which then takes more tokens: texts with a piece that
        # doesn't fit are split again with twice the reserve
        room = most - overlap - reserve
        made = _split_once(enc, [texts[k] for k in left], most, overlap, room)
        last = room < 2 * reserve + 1
        for k, pieces in zip(left, made):
            if last or all(p[4] <= most for p in pieces):
                out[k] = [q for p in pieces for q in (_halved(enc, texts[k], p, most, overlap) if p[4] > most else [p])]
        left, reserve = [k for k in left if out[k] is None], reserve * 2
    return out


def _split_once(enc: Encoder, texts: list[str | None], most: int, overlap: int, room: int) -> list[list[Piece]]:
    """Pieces of each text with at most ``room`` tokens beside the overlap, and what they encode to."""
    split = [enc.pieces(t) if t else [] for t in texts]
    enc.learn([w for words in split for w in words])
    spans: list[list[list[int]]] = []
    edges: list[str] = []  # beginnings and ends of pieces, which alone may encode otherwise
    for text, words in zip(texts, split):
        made, ends = _spans(enc, text, words, most, overlap, room) if words else ([], [])
        spans.append(made)
        edges += ends
    n = enc.count(edges).tolist()
    out, k = [], 0
    for made in spans:
        rows: list[Piece] = []
        for *span, edged, known in made:
            rows.append((*span, known + sum(n[k : k + edged])))
            k += edged
        out.append(rows)
    return out


def _spans(enc: Encoder, text: str, words: list[str], most: int, overlap: int, room: int) -> tuple[list[list[int]], list[str]]:
    """[start_char, end_char, start_token, end_token, number of edges, tokens between the
    edges] of each piece, and the texts of the edges."""
    index = np.fromiter(map(enc.index.__getitem__, words), np.int64, len(words))
    tokens, chars = enc.sizes[index], np.fromiter(map(len, words), np.int64, len(words))
    total = int(tokens.sum())
    if total <= most:
        return [[0, len(text), 0, total, 0, total]], []
    # words too long to fit are cut between tokens, at whole characters
    if (tokens > room).any():
        words, tokens, chars = _cut_words(enc, words, tokens, chars, room)
    ends_c, ends_t = np.cumsum(chars), np.cumsum(tokens)
    level = np.full(len(words), WORD, np.int8)
    at, strength = boundaries(text)
    # a boundary inside a word moves to the word's start
    where = np.searchsorted(ends_c, at, "right")
    ok = where < len(words)
    np.minimum.at(level, where[ok], strength[ok])
    where = [0, *cuts(tokens, level, room, 2 * overlap), len(words)]
    made, edges = [], []
    for first, last in zip(where, where[1:]):
        k, start_c, start_t = _back(enc, words, ends_c, ends_t, first, overlap) if first else (0, 0, 0)
        end_c, end_t = int(ends_c[last - 1]), int(ends_t[last - 1])
        j = k + 1
        while j < last - 4 and words[j].isspace():  # white space is split by what follows it
            j += 1
        if j >= last - 4:
            edges.append(text[start_c:end_c])
            made.append([start_c, end_c, start_t, end_t, 1, 0])
            continue
        edges += [text[start_c : int(ends_c[j])], text[int(ends_c[last - 4]) : end_c]]
        made.append([start_c, end_c, start_t, end_t, 2, int(ends_t[last - 4] - ends_t[j])])
    return made, edges


def _halved(enc: Encoder, text: str, piece: Piece, most: int, overlap: int) -> list[Piece]:
    """A piece that doesn't fit whatever the reserve, as two; only limits near the overlap need it."""
    a, b, s, e, _ = piece
    middle = (a + b) // 2
    at = enc.count([text[a:middle], text[middle:b]]).tolist()
    t = min(e, s + at[0])
    halves = [(a, middle, s, t, at[0]), (middle, b, t, e, at[1])]
    return [q for h in halves for q in (_halved(enc, text, h, most, overlap) if h[4] > most and h[1] - h[0] > 1 else [h])]


def _back(enc: Encoder, words: list[str], ends_c: np.ndarray, ends_t: np.ndarray, first: int, overlap: int) -> tuple[int, int, int]:
    """The word, the character and the token that lie ``overlap`` tokens before word ``first``."""
    goal = int(ends_t[first - 1]) - overlap
    if overlap == 0:
        return first, int(ends_c[first - 1]), int(ends_t[first - 1])
    if goal <= 0:
        return 0, 0, 0
    k = int(np.searchsorted(ends_t, goal, "right"))  # the word in which the overlap begins
    t0, c0 = (int(ends_t[k - 1]), int(ends_c[k - 1])) if k else (0, 0)
    done = back = 0
    if goal > t0:
        for used, n in _prefixes(enc, words[k]):
            if used > goal - t0:
                break
            done, back = n, used
    return k, c0 + done, t0 + back


def _prefixes(enc: Encoder, word: str) -> Iterator[tuple[int, int]]:
    """(tokens, characters) of the beginnings of a word that are whole tokens and whole characters."""
    k = enc.index.get(word)
    ids = enc.store[enc.starts[k] : enc.starts[k] + enc.sizes[k]] if k is not None else enc.encode_pieces([word])[0]
    lengths = enc.byte_lengths()[ids].tolist()
    if word.isascii():
        c = 0
        for t, n in enumerate(lengths, 1):
            c += n
            yield t, c
        return
    whole = {0: 0}
    e = 0
    for c, letter in enumerate(word, 1):
        e += len(letter.encode())
        whole[e] = c
    e = 0
    for t, n in enumerate(lengths, 1):
        e += n
        if e in whole:
            yield t, whole[e]


def _cut_words(enc: Encoder, words: list[str], tokens: np.ndarray, chars: np.ndarray, room: int):
    new_w: list[str] = []
    new_t: list[int] = []
    for w, n in zip(words, tokens.tolist()):
        if n <= room:
            new_w.append(w)
            new_t.append(n)
            continue
        begin_t = begin_c = last_t = last_c = 0
        for t, c in _prefixes(enc, w):
            if t - begin_t > room // 4 and last_c > begin_c:
                new_w.append(w[begin_c:last_c])
                new_t.append(last_t - begin_t)
                begin_t, begin_c = last_t, last_c
            last_t, last_c = t, c
        new_w.append(w[begin_c:])
        new_t.append(n - begin_t)
    return new_w, np.array(new_t, np.int64), np.array([len(w) for w in new_w], np.int64)


_OUT = [("piece_no", T.LongType(), pa.int64()), ("start_char", T.LongType(), pa.int64()), ("end_char", T.LongType(), pa.int64()), ("start_token", T.LongType(), pa.int64()), ("end_token", T.LongType(), pa.int64()), ("n_tokens", T.LongType(), pa.int64()), ("piece", T.StringType(), pa.string())]


def split(df: DataFrame, text: str, most: int, overlap: int, path: str = VOCABULARY) -> DataFrame:
    """One row per piece of ``text``: the other columns, then piece_no (from 1), start_char,
    end_char, start_token, end_token, n_tokens and piece, as split_text() defines them.

    Null and empty texts have no piece; a text within the limit is one piece. Repeated rows
    are split each; other columns are kept and must not be called as the new ones. No
    shuffle, and whole texts: a piece comes from its own row alone.
    """
    kept = [c for c in df.columns if c != text]
    if {*kept} & {n for n, _, _ in _OUT}:
        raise ValueError("a column has the name of a new one")
    vocabulary = shipped(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(vocabulary)
        for batch in batches:
            for part in chunks(batch, len(kept)):
                enc.forget_if_large()
                rows, row = [], []
                texts = part.column(len(kept)).to_pylist()
                for k, (t, pieces) in enumerate(zip(texts, split_texts(enc, texts, most, overlap))):
                    for no, p in enumerate(pieces, 1):
                        rows.append((no, *p, t[p[0] : p[1]]))
                        row.append(k)
                take = pa.array(row, pa.int64())
                made = [pa.array(c, kind) for c, (_, _, kind) in zip(zip(*rows), _OUT)] if rows else [pa.array([], kind) for _, _, kind in _OUT]
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(take) for i in range(len(kept))), *made], [*kept, *(n for n, _, _ in _OUT)])

    return df.select(*kept, text).mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), *(T.StructField(n, kind) for n, kind, _ in _OUT)]))


def p10_pieces(spark: SparkSession, folder: str, path: str = VOCABULARY) -> DataFrame:
    """doc_id, piece_no, spans, n_tokens and piece of all documents by the piece limit."""
    most, overlap = limit(spark, folder, "piece")
    return split(table(spark, folder, "documents").select("doc_id", "text").where("doc_id is not null"), "text", most, overlap, path)
