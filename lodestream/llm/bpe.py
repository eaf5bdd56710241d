"""Byte-pair encoding with numpy: many words at once, one matrix per length bucket.

A text is split by the tokenizer's public pattern; each distinct piece is encoded once.
Pieces become rows of padded matrices, bucketed by length. In each round every row merges
its leftmost pair of minimum rank: the pair's rank comes from a hash table in two arrays,
the merged column is cut out of all rows at once (compaction), and rows without a pair
left leave the matrix. Rows of more than WIDE bytes merge the pair wherever it stands in the
row in the same round, which gives the same ids, as a merge makes pairs of higher rank only.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np

_NONE = np.int32(2**31 - 1)
#: Rows longer than this merge all occurrences of their minimum pair in a round.
WIDE = 96
#: Distinct pieces that a worker remembers before it starts afresh (about 200 bytes each).
REMEMBERED = 400_000

#: The tokenizer's split pattern (fixed value), and the same for texts of ASCII alone.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ASCII = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+""")


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: itself where it is
    printable, else the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """The tokenizer of one vocabulary file's text (JSON with vocab and merges)."""

    def __init__(self, text: bytes | str):
        import regex

        model = json.loads(text)["model"]
        vocab, letters = model["vocab"], byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.split = regex.compile(PATTERN).findall
        self.of_byte = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.left = np.array([vocab[a] for a, _ in merges], np.uint32)
        self.right = np.array([vocab[b] for _, b in merges], np.uint32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self._hash((self.left << np.uint32(16)) | self.right)
        # two bytes that no token holds side by side: a piece may be cut between them
        self.joined = np.zeros(65536, bool)
        for token in vocab:
            raw = [letters[c] for c in token if c in letters]
            for a, b in zip(raw, raw[1:]):
                self.joined[a << 8 | b] = True
        self._lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, k in vocab.items():
            self._lengths[k] = sum(c in letters for c in token)
        self._forget()

    def byte_lengths(self) -> np.ndarray:
        """The number of bytes of each token, by id."""
        return self._lengths

    def forget_if_large(self) -> None:
        if len(self.index) > REMEMBERED:
            self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.sizes = np.zeros(1, np.int64)
        self.store = np.zeros(0, np.int32)

    # --- hashed pair lookup

    def _hash(self, keys: np.ndarray) -> None:
        self.bits = 19
        size = 1 << self.bits
        self.keys, self.ranks = np.full(size, 0xFFFFFFFF, np.uint32), np.full(size, _NONE, np.int32)
        at = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):  # linear probing, all keys of a step at once
            slot = at[todo]
            free = self.keys[slot] == 0xFFFFFFFF
            ours, first = np.unique(slot[free], return_index=True)
            win = todo[free][first]
            self.keys[ours], self.ranks[ours] = keys[win], win
            todo = np.setdiff1d(todo, win, assume_unique=True)
            at[todo] = (at[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair (a, b), _NONE where it isn't in the merges or a side is padding (-1)."""
        keys = (a.astype(np.uint32) << np.uint32(16)) | (b.astype(np.uint32) & np.uint32(0xFFFF))
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.ranks[at], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != 0xFFFFFFFF))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found, want = self.keys[at[open_]], keys[open_]
            hit = found == want
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found != 0xFFFFFFFF)]
        out[(a < 0) | (b < 0)] = _NONE
        return out

    # --- merging

    def _bucket(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all rows of a padded matrix (padding -1, at the right) to the end.
        Returns the ids of the rows end to end, and the rows' sizes."""
        n, width = rows.shape
        out, sizes = np.full((n, width), -1, np.int32), (rows >= 0).sum(1)
        m, who = rows, np.arange(n)
        r = self.rank(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(n, width - 1) if width > 1 else np.zeros((n, 0), np.int32)
        while m.shape[1] > 1:
            best = r.argmin(1)
            row = np.arange(len(m))
            low = r[row, best]
            done = low == _NONE
            if done.any():
                out[who[done], : m.shape[1]] = m[done]
                keep = ~done
                m, r, who, best, low = m[keep], r[keep], who[keep], best[keep], low[keep]
                row = np.arange(len(m))
                if not len(m):
                    break
            m[row, best] = self.merged[low]
            sizes[who] -= 1
            left = np.ones(m.shape, bool)
            left[row, best + 1] = False
            m = m[left].reshape(len(m), -1)  # the merged-in column of each row goes
            left = left[:, 1:]
            r = r[left].reshape(len(m), -1)
            if m.shape[1] > 1:
                for side in (best - 1, best):
                    ok = (side >= 0) & (side < m.shape[1] - 1)
                    i, j = row[ok], side[ok]
                    r[i, j] = self.rank(m[i, j], m[i, j + 1])
        if len(m):
            out[who, : m.shape[1]] = m
        return out[out >= 0], sizes

    def _wide_bucket(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """_bucket() for wide rows: a round merges all occurrences of each row's minimum pair, of
        overlapping ones from the left every second; then all rows are compacted."""
        n = len(rows)
        done_ids: list[np.ndarray] = [np.zeros(0, np.int32)] * n
        m, who = rows, np.arange(n)
        while len(m):
            r = self.rank(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(len(m), m.shape[1] - 1)
            low = r.min(1, initial=_NONE)
            for k in np.flatnonzero(low == _NONE):
                done_ids[who[k]] = m[k][m[k] >= 0]
            keep = low != _NONE
            m, r, who, low = m[keep], r[keep], who[keep], low[keep]
            if not len(m):
                break
            i, j = np.nonzero(r == low[:, None])
            begins = np.ones(len(i), bool)
            begins[1:] = (i[1:] != i[:-1]) | (j[1:] != j[:-1] + 1)
            start = j[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
            second = (j - start) % 2 == 0
            i, j = i[second], j[second]
            m[i, j] = self.merged[low[i]]
            stay = m >= 0
            stay[i, j + 1] = False
            sizes = stay.sum(1)
            to, at = np.nonzero(stay)
            fresh = np.full((len(m), max(1, int(sizes.max()))), -1, np.int32)
            fresh[to, ragged(np.zeros(len(m), np.int64), sizes)] = m[to, at]
            m = fresh
        return np.concatenate(done_ids), np.fromiter(map(len, done_ids), np.int64, n)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and their sizes."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lens)
        # cut pieces where no token can lie across
        cut = np.ones(len(flat), bool)
        if len(flat) > 1:
            cut[1:] = ~self.joined[flat[:-1].astype(np.int64) << 8 | flat[1:]]
        cut[ends[:-1]] = True
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(flat)))
        owner = np.searchsorted(ends, begin, "right")
        ids = self.of_byte[flat]
        counts = np.zeros(len(begin), np.int64)
        parts, order = [], []
        edges = [0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, WIDE]
        while edges[-1] < size.max(initial=0):
            edges.append(edges[-1] * 2)
        for lo, hi in zip(edges, edges[1:]):
            rows = np.flatnonzero((size > lo) & (size <= hi))
            for part in np.array_split(rows, max(1, len(rows) * hi // 400_000)) if len(rows) else ():
                width = int(size[part].max())
                grid = begin[part][:, None] + np.arange(width)
                inside = np.arange(width) < size[part][:, None]
                m = np.where(inside, ids[np.minimum(grid, len(ids) - 1)], np.int32(-1))
                done, n = self._wide_bucket(m) if hi > WIDE else self._bucket(m)
                parts.append(done)
                order.append(part)
                counts[part] = n
        made = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        which = np.concatenate(order) if order else np.zeros(0, np.int64)
        # back into the order of the text
        at = np.zeros(len(begin), np.int64)
        at[which] = np.cumsum(counts[which]) - counts[which]
        return made[ragged(at, counts)], np.bincount(owner, counts, len(pieces)).astype(np.int64)

    # --- texts

    def pieces(self, text: str) -> list[str]:
        return _ASCII.findall(text) if text.isascii() else self.split(text)

    def learn(self, pieces: list[str]) -> None:
        """Encode the pieces that aren't remembered yet."""
        index = self.index
        fresh = [p for p in dict.fromkeys(pieces) if p not in index]
        if not fresh:
            return
        ids, sizes = self.encode_pieces(fresh)
        base = len(index)
        for k, p in enumerate(fresh):
            index[p] = base + k
        starts = len(self.store) + np.cumsum(sizes) - sizes
        self.starts = np.concatenate([self.starts[:base], starts])
        self.sizes = np.concatenate([self.sizes[:base], sizes])
        self.store = np.concatenate([self.store, ids])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end and the texts' sizes; null and empty texts have none."""
        self.forget_if_large()
        split = [self.pieces(t) if t else [] for t in texts]
        flat = [p for x in split for p in x]
        self.learn(flat)
        which = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        sizes = self.sizes[which] if len(flat) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(texts)), np.fromiter(map(len, split), np.int64, len(texts)))
        ids = self.store[ragged(self.starts[which], sizes)] if len(flat) else np.zeros(0, np.int32)
        return ids, np.bincount(of, sizes, len(texts)).astype(np.int64)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The texts' sizes in tokens."""
        self.forget_if_large()
        split = [self.pieces(t) if t else [] for t in texts]
        flat = [p for x in split for p in x]
        self.learn(flat)
        which = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        of = np.repeat(np.arange(len(texts)), np.fromiter(map(len, split), np.int64, len(texts)))
        return np.bincount(of, self.sizes[which] if len(flat) else [], len(texts)).astype(np.int64)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[k], starts[k] + 1, ... (sizes[k] of them) for all k, end to end."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return np.arange(total) + shift


@cache
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, built once in a process."""
    with open(path, "rb") as f:
        return Encoder(f.read())
