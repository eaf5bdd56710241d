"""Reducing mails to what their senders newly wrote (problem 2).

A body is segmented into blocks: paragraphs, cut where quoting, introductions or the form
of lines change. The body that it answers is joined as hashes of its lines, so each line
is known to be, or not, the ancestor's next line. All blocks, quoted and closing ones too,
are classified by gradient-boosted trees from contact density, quote depth, sender frequency
(in what share of the sender's mails the block's lines stand), ancestor overlap, place and
form; their verdict alone makes the rows.

Nobody labelled the mails, so the trees learn from distant supervision that looks at no
form: text that the ancestor holds is not new; neither is what stands at or after the first
line that one sender repeats in many mails and hardly anyone else uses (a signature), nor a
line that mostly stands right before such a signature or after it; what stands before, or in a
mail without signature and is no such line, is new. Each
labelled mail is shown several times, with and without its ancestor and the frequencies, so
the trees also learn to judge by form where the one or the other is unknown.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm.bpe import ragged
from lodestream.llm.gbt import Boosted
from lodestream.llm.mailtext import _COMPARES, _PHONE, intro_at, kind, one_less
from lodestream.llm.tokens import chunks
from lodestream.session import cut
from lodestream.sources.tables import table

#: The classifier is fitted on the labelled blocks of at most so many mails.
SAMPLE_MAILS = 3_000
#: A line is a sender's own, like a signature, if at least so many and this share of the
#: sender's mails hold it, and this share of all mails that do are the sender's.
OWN_MAILS, OWN_SHARE, OWN_PART = 4, 0.4, 0.8
#: Lines are known as common from this share of all mails on; so at most 1 / share times the
#: mean number of lines of a mail are known.
COMMON_SHARE = 0.001

#: What is known of a block from its mail and its ancestor, then from the corpus.
FORM = ("lines", "length", "contact", "names", "depth", "overlap", "held", "quoted", "intro", "closing", "legal", "greeting", "after_end", "place", "sentence", "listed", "marked", "delimiter", "first")
CORPUS = ("own", "habit", "spread", "begun")
FEATURES = FORM + CORPUS

#: Blocks whose label is known beforehand, by the features that are not 0, at each of PLACES
#: and with one line or three. They matter only where the mails give hardly any labels.
PRIOR = (
    ({"length": 60, "sentence": 1}, 1), ({"length": 60}, 1), ({"length": 10, "greeting": 1}, 1), ({"length": 40, "listed": 1}, 1),
    ({"length": 8, "closing": 1, "after_end": 1}, 0), ({"length": 20, "names": 0.5, "after_end": 1}, 0), ({"length": 20, "contact": 1, "after_end": 1}, 0), ({"length": 80, "legal": 1, "sentence": 1, "after_end": 1}, 0),
    ({"length": 60, "quoted": 1, "overlap": 1, "held": 1, "sentence": 1}, 0), ({"length": 60, "quoted": 1, "depth": 1, "marked": 1}, 0), ({"length": 60, "quoted": 1}, 0), ({"length": 40, "after_end": 1, "delimiter": 1}, 0),
)
PLACES = (0.0, 0.25, 0.5, 0.75, 1.0)

_NAME = re.compile(r"^[*~ ]*([^\W\d_][\w'.-]*(?: [^\W\d_][\w'.-]*){0,3})[*~ ]*(?:\(.{2,60}\))?$")
_SENTENCE = re.compile(r"[.?!]$|\b(?:the|and|with|for|is|are|of|to|we|please|kindly)\b", re.I)
_LISTED = re.compile(r"^(?:[-*•|]|\d{1,3}[.)]) ?|^[^:]{2,30}(?: ?: | - )")


@lru_cache(maxsize=200_000)
def hashed(line: str) -> int:
    return xxhash.xxh64_intdigest(" ".join(line.split())) - (1 << 63)


def line_hashes(body: str | None) -> list[int]:
    """Hashes of the lines that aren't blank."""
    return [hashed(x) for x in body.split("\n") if x.strip()] if body else []


def _is_name(line: str, words: set[str], local: str) -> bool:
    """Whether a line is the sender's name (in full or the first), decorated or not."""
    m = _NAME.match(line.strip())
    if not m:
        return False
    own = [w.lower() for w in m[1].split()]
    if words:
        return all(w in words for w in own)
    return len(own) == 2 and any(w in local for w in own) and all(w[0] in local for w in own)


def parse(body: str, parent: list[int] | None, sender: str | None, name: str | None) -> list[tuple[int, str, bool, bool, int, bool, bool, bool]]:
    """(line number, text, quoted, after_end, depth, overlap, run, intro) of the lines that aren't blank.

    quoted: in a quote of earlier mails or introducing one. after_end: past the sender's
    closing or name. depth: quote marks before the text. overlap: the ancestor has the line;
    run: and next to it the line that is next to it here. intro: it introduces a quote.
    """
    lines = [x.strip() for x in body.split("\n")]
    n = len(lines)
    old = [False] * n
    begin, style = _quote_begins(lines, parent)
    intro: set[int] = set()
    known = begin is not None
    held = set(parent or ())
    if begin is None:
        for i in range(n):
            j = intro_at(lines, i)
            if j > i:
                begin = j
                intro.update(range(i, j))
                q = next((k for k in range(j, n) if lines[k]), n)
                style = lines[q][0] if q < n and lines[q][0] in ">|" else ""
                break
    else:
        k = begin - 1
        while k >= 0 and not lines[k]:
            k -= 1
        for i in range(max(0, k - 8), k + 1):  # the introduction right before the quote
            if intro_at(lines, i) > k:
                intro.update(range(i, begin))
                break
    for k in intro:
        old[k] = True
    if begin is not None and not style:
        old[begin:] = [True] * (n - begin)
    elif begin is not None:
        for k in range(begin, n):
            s = lines[k]
            if s and s[0] == style:
                # comparisons, rows of tables and bullets may begin like quotes: the ancestor
                # tells; without it, their form
                if not s.strip(">| "):
                    old[k] = True
                elif known:
                    old[k] = hashed(one_less(s)) in held
                else:
                    old[k] = not (s[-1] == "|" and s[1:].lstrip()[:1] != "|" if style == "|" else _COMPARES.match(s))
    words = {w.lower() for w in (name or "").split()}
    local = (sender or "").split("@")[0].lower()
    out = []
    ended = False
    seen = 0
    for k, s in enumerate(lines):
        if not s:
            continue
        if not old[k] and not ended:
            what = form(s)[0]
            if what == "closing" or seen and form(s)[1] and _is_name(s, words, local):
                ended = True
            elif what in ("delimiter", "signed"):
                after = next((x for x in range(k + 1, min(n, k + 4)) if lines[x]), None)
                ended = what == "signed" and (seen > 0) or after is not None and not old[after] and (_is_name(lines[after], words, local) or kind(lines[after]) in ("legal", "contact"))
            elif what == "legal" and seen:
                ended = True
            if what != "legal":
                seen += 1
        depth = 0
        if s[0] == ">" or s[0] == "|":
            t = s
            while t[:1] in (">", "|") and (t[:1] == ">" or depth or style == "|"):
                depth += 1
                t = t[1:].lstrip()
        out.append((k + 1, s, old[k], ended, depth, False, False, k in intro))
    return _overlapping(out, parent) if parent else out


def _overlapping(rows: list[tuple], parent: list[int]) -> list[tuple]:
    """rows with whether the ancestor has the line, and has it beside a neighbour of it."""
    held, beside = set(parent), set(zip(parent, parent[1:]))
    alone = len(parent) == 1
    out = []
    before, filled_at = (), -1
    for r in rows:
        s = r[1]
        if s[0] == ">" or s[0] == "|":
            mine = [h for h in (hashed(one_less(s)), hashed(s)) if h in held]
            filled = bool(s.strip(">| "))  # marks alone are no neighbours
        else:
            h = hashed(s)
            mine = (h,) if h in held else ()
            filled = True
        run = alone and bool(mine)
        if filled:
            if mine and before and any((x, y) in beside for x in before for y in mine):
                run = True
                b = out[filled_at]
                out[filled_at] = (*b[:6], True, b[7])
            before, filled_at = mine, len(out)
        out.append((*r[:5], bool(mine), run, r[7]))
    return out


def _quote_begins(lines: list[str], parent: list[int] | None) -> tuple[int | None, str]:
    """Where the ancestor's body begins in a body, and with which mark; the first of its
    lines must be followed by the next ones, other text between them only in marked quotes."""
    if not parent:
        return None, ""
    first, most = parent[0], min(3, len(parent))
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            continue
        for style in (s[:1], "") if s[:1] in (">", "|") else ("",):
            if hashed(one_less(s) if style else s) != first:
                continue
            hit = 1
            for x in lines[i + 1 :]:
                y = x.strip()
                if hit >= most:
                    break
                if not y or style and (y[:1] != style or not y[1:].strip()):
                    continue
                if hashed(one_less(y) if style else y) != parent[hit]:
                    if style and (_COMPARES.match(y) or y[-1:] == "|"):
                        continue
                    break
                hit += 1
            else:
                if hit == 1 and len(parent) > 1 and not style and kind(s) != "text":
                    continue
                return i, style
            if hit >= most:
                return i, style
    return None, ""


@lru_cache(maxsize=200_000)
def form(line: str) -> tuple[str, bool, bool, bool, bool]:
    """What a line is by itself: its kind, whether it looks like a name, a sentence or an item, and
    has a phone number."""
    return kind(line), bool(_NAME.match(line)), bool(_SENTENCE.search(line)), bool(_LISTED.match(line)), bool(_PHONE.search(line))


def blocks_of(parsed: list[tuple]) -> tuple[list[list[tuple]], list[list]]:
    """Lines in blocks, and sums over each block's lines. Blocks are paragraphs, cut where quoting,
    the end or the lines' form changes; an introduction and the quoted paragraph after it are one.
    Quoted blocks are told apart by mark, depth, introduction, ancestor and place; the form of
    their lines is left at 0."""
    blocks: list[list[tuple]] = []
    sums: list[list] = []
    before_no, before_old, before_intro, before_shape = -1, False, False, None
    for row in parsed:
        no, text, old, ended, depth, held, run, intro = row
        filled = not depth or bool(text.strip(">| "))
        what = "text"
        if not old:
            what, name, sentence, listed, phone = form(text)
        shape = (old, ended, depth, "text" if what == "greeting" else what)
        adjacent = no == before_no + 1
        joins = old and before_old and (before_intro or adjacent and not filled)
        if not joins and (not adjacent or shape != before_shape):
            blocks.append([])
            # lines, characters, run, held, told, intro, contact, names, closing, legal, greeting, sentence, listed, delimiter, depth, quoted, after_end, marked
            sums.append([0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, depth, old, ended, depth > 0])
        blocks[-1].append(row)
        t = sums[-1]
        t[0] += 1
        t[1] += len(text)
        t[2] += run
        t[3] += held
        t[4] += filled and not intro
        if old:
            t[5] += intro
            if before_intro:
                t[14], t[17] = depth, depth > 0
        else:
            t[6] += phone or what == "contact"
            t[7] += name
            t[11] += sentence
            t[12] += listed
            if what != "text":
                t[8] += what == "closing" or what == "signed"
                t[9] += what == "legal"
                t[10] += what == "greeting"
                t[13] += what == "delimiter"
        before_no, before_old, before_intro, before_shape = no, old, intro, shape
    return blocks, sums


def features(sums: list[list], per_mail: list[int]) -> np.ndarray:
    """The features of FORM of the blocks of mails, of which each has so many; those of CORPUS are 0."""
    x = np.zeros((len(sums), len(FEATURES)), np.float32)
    if sums:
        t = np.array(sums, np.float32)
        n, told = t[:, 0], np.maximum(t[:, 4], 1)
        place = ragged(np.zeros(len(per_mail), np.int64), np.array(per_mail)) / np.repeat(per_mail, per_mail)
        x[:, : len(FORM)] = np.stack([
            n, t[:, 1] / n, t[:, 6] / n, t[:, 7] / n, t[:, 14], t[:, 2] / told, t[:, 3] / told, t[:, 15], t[:, 5] / n, t[:, 8] / n, t[:, 9] / n, t[:, 10] / n,
            t[:, 16], place, t[:, 11] / n, t[:, 12] / n, t[:, 17], t[:, 13] / n, place == 0,
        ], 1)
    return x


def _told(block: list[tuple]) -> int:
    """How many of a block's lines an ancestor could hold."""
    return max(1, sum(not r[7] and bool(r[1].strip(">| ")) for r in block))


_COLUMNS = [("graph_id", "string"), ("sender", "long"), ("blind", "boolean"), ("sampled", "boolean"), ("known", "boolean"), ("numbers", "array<int>"), ("size", "array<int>"), ("hashed", "array<int>"), ("lines", "array<long>"), ("truth", "array<float>"), ("loose", "array<float>"), ("features", "array<float>")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32())}
_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in _COLUMNS])


def segmented(mails: DataFrame) -> DataFrame:
    """One row per mail (graph_id, body, sender, name, parent, opens, sampled): of each block
    its lines' numbers, how many they are and how many of these are hashed (all, of quoted
    blocks none), its features and the share of its lines that the ancestor holds in a row
    (truth) or at all (loose); ``lines`` are the hashes. A sampled mail has a second, blind row: parsed without its
    ancestor, which only truth has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, batch.schema.get_field_index("body")):
                rows, all_sums = [], []
                for graph_id, body, sender, name, parent, opens, sampled in zip(*(part.column(c).to_pylist() for c in ("graph_id", "body", "sender", "name", "parent", "opens", "sampled"))):
                    who = hashed(sender or "")
                    parsed = parse(body, parent, sender, name)
                    held, run = ({r[0] for r in parsed if r[i]} for i in (5, 6)) if sampled else (None, None)
                    for blind in (False, True)[: 1 + sampled]:
                        blocks, sums = blocks_of(parse(body, None, sender, name) if blind else parsed)
                        all_sums += sums
                        told = [[r[0] for r in b if not r[4] or r[1].strip(">| ")] for b in blocks]  # marks alone are no text
                        rows.append((
                            graph_id, who, blind, sampled, opens or parent is not None, [no for x in told for no in x], [len(x) for x in told], [0 if b[0][2] else len(b) for b in blocks],
                            [hashed(r[1]) for b in blocks if not b[0][2] for r in b], *([sum(r[0] in lines for r in b) / _told(b) for b in blocks] if sampled else None for lines in (run, held)),
                        ))
                made = [pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), _COLUMNS)] if rows else [pa.array([], _KINDS[k]) for _, k in _COLUMNS[:-1]]
                per_mail = [len(r[6]) for r in rows]
                flat = pa.array(features(all_sums, per_mail).ravel())
                made.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_mail)) * len(FEATURES), pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(made, schema=_SCHEMA)

    return mails.select("graph_id", "body", "sender", "name", "parent", "opens", "sampled").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in _COLUMNS))


def line_statistics(blocks: DataFrame, senders: DataFrame, mails: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(sender, own): for each sender the lines that many of the sender's mails hold, with the
    share of them that do and whether hardly anyone else has the line; then the hashes of the lines
    that are common in the whole corpus, ascending, and the logs of how many senders use them.

    Counts are exact, over all mails, combined before each shuffle. A sender's lines are
    those of OWN_SHARE / 4 of the mails or more, a bounded number; the common lines, which
    come to the driver, are at most mean lines / COMMON_SHARE.
    """
    used = blocks.where("not blind").select("sender", F.explode(F.array_distinct("lines")).alias("line")).groupBy("sender", "line").agg(F.count("*").alias("n"))
    total = used.groupBy("line").agg(F.sum("n").alias("n_all"), F.count("*").alias("senders"))
    often = used.where(F.col("n") >= OWN_MAILS).join(senders, "sender").withColumn("share", F.col("n") / F.col("mails")).where(F.col("share") >= OWN_SHARE / 4)
    often = often.join(total.where(F.col("n_all") >= OWN_MAILS), "line").withColumn("alone", F.col("n") >= F.col("n_all") * OWN_PART)
    own = often.groupBy("sender").agg(F.collect_list(F.struct("line", F.col("share").cast("float").alias("share"), "alone")).alias("own"))
    common = total.where((F.col("n_all") >= max(OWN_MAILS, mails * COMMON_SHARE)) & (F.col("senders") > 1)).select("line", "senders").toArrow()
    lines, senders_of = common.column("line").to_numpy(), common.column("senders").to_numpy()
    order = np.argsort(lines)
    return cut(own), lines[order], np.log2(senders_of[order]).astype(np.float32)


def _looked_up(keys: np.ndarray, sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each key, 0 where it isn't there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.float32)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], np.float32(0))


class _Blocks:
    """The blocks of a batch of mails as flat arrays, with the features of CORPUS filled in."""

    def __init__(self, b: pa.RecordBatch, common: np.ndarray, senders: np.ndarray):
        flat = lambda c: b.column(c).flatten()
        many = lambda c: pa.compute.fill_null(pa.compute.list_value_length(b.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        per_mail = many("size")
        self.mail = np.repeat(np.arange(len(per_mail)), per_mail)
        self.numbers, self.size, hashed_ = (flat(c).to_numpy(zero_copy_only=False) for c in ("numbers", "size", "hashed"))
        self.x = flat("features").to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).copy()
        self.lines, self.block = flat("lines").to_numpy(zero_copy_only=False), np.repeat(np.arange(len(self.mail)), hashed_)
        # the sender's lines, keyed by sender and line
        who = b.column("sender").to_numpy()
        mine = flat("own")
        own_who = np.repeat(who, many("own"))
        own_line, share, one = (mine.field(c).to_numpy(zero_copy_only=False) for c in ("line", "share", "alone"))
        key, at = np.unique(_keyed(own_who, own_line), return_index=True)
        keys = _keyed(who[self.mail[self.block]], self.lines) if len(self.block) else np.zeros(0, np.int64)
        self.is_own = _looked_up(keys, key, np.where(one & (share >= OWN_SHARE), np.float32(1), np.float32(0))[at])
        n = np.maximum(1, hashed_)
        mean = lambda v: np.bincount(self.block, v, len(self.mail)) / n
        own, habit, spread, begun = (FEATURES.index(c) for c in CORPUS)
        if len(self.mail):
            self.x[:, own] = mean(_looked_up(keys, key, np.where(one, share, np.float32(0))[at]))
            self.x[:, habit] = mean(_looked_up(keys, key, np.where(one, np.float32(0), share)[at]))
            self.spread = _looked_up(self.lines, common, senders)
            self.x[:, spread] = mean(self.spread)
            # a mail that begins with its sender's own lines is a template: they tell nothing there
            template = np.zeros(len(per_mail), bool)
            begins = np.flatnonzero(np.diff(self.mail[self.block], prepend=-1) > 0)
            template[self.mail[self.block[begins]]] = self.is_own[begins] > 0
            self.is_own = np.where(template[self.mail[self.block]], np.float32(0), self.is_own)
            self.x[:, own] *= ~template[self.mail]
            self.x[:, habit] *= ~template[self.mail]
            self.anchor = np.bincount(self.block, self.is_own, len(self.mail)) > 0
            self.signed = np.bincount(self.mail, self.anchor, len(per_mail)) > 0
            self.signs = (np.bincount(np.repeat(np.arange(len(per_mail)), many("own")), one & (share >= OWN_SHARE), len(per_mail)) > 0) & ~template
            so_far = np.cumsum(self.anchor) - self.anchor
            begin = np.cumsum(per_mail) - per_mail
            self.x[:, begun] = so_far > so_far[np.minimum(begin[self.mail], len(so_far) - 1)]
        else:
            self.anchor = np.zeros(0, bool)


def _keyed(who: np.ndarray, line: np.ndarray) -> np.ndarray:
    return line ^ (who * np.int64(-7046029254386353131))


def labels_of(b: _Blocks, known: np.ndarray, truth: np.ndarray, loose: np.ndarray, late: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """1 new, 0 not new, -1 unknown, of the blocks of mails. Known are mails whose ancestor is
    (or that answer none); truth and loose are the shares of a block's lines that the ancestor
    holds in a row, or at all; late as _late() gives it."""
    if not len(b.mail):
        return np.zeros(0, np.int64)
    first, end = np.searchsorted(b.mail, b.mail), np.searchsorted(b.mail, b.mail, "right")
    begun = b.x[:, FEATURES.index("begun")] > 0
    met = np.append(0, np.cumsum(truth > 0))
    here = np.arange(len(b.mail))
    apart = (met[here] == met[first]) | (met[end] == met[here + 1])  # not inside the ancestor's text
    hashed_ = np.bincount(b.block, minlength=len(b.mail))
    share = _looked_up(b.lines, late[0], 1 + late[1])  # 0: not seen in signed mails
    all_ = lambda which: (hashed_ > 0) & (np.bincount(b.block, which, len(b.mail)) == hashed_)
    # mails without the signature that their sender has; of common lines only those that begin mails
    begins = all_((share > 0) & (share < 1.2))
    early = b.signs[b.mail] & all_(np.where(share > 0, share < 1.2, b.spread == 0))
    label = np.full(len(b.mail), -1)
    # an ancestor that begins with the same common line is no evidence
    label[(b.signed[b.mail] | early) & ~begun & apart & known[b.mail] & ((loose == 0) | begins)] = 1
    label[all_(share > 1.5)] = 0
    label[b.anchor | begun | (truth >= 0.5)] = 0
    return label


def _late(b: _Blocks) -> tuple[np.ndarray, np.ndarray]:
    """The lines that three or more signed mails hold, and in what share of them they stand right
    before the signature or after it."""
    if not len(b.lines):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    mail = b.mail[b.block]
    after = np.append((b.is_own[1:] > 0) & (mail[1:] == mail[:-1]), False) | (b.x[b.block, FEATURES.index("begun")] > 0)
    counts = np.flatnonzero((b.is_own == 0) & b.signed[mail])
    lines, of, n = np.unique(b.lines[counts], return_inverse=True, return_counts=True)
    share = np.bincount(of, after[counts], len(lines)) / np.maximum(n, 1)
    return lines[n >= 3], share[n >= 3].astype(np.float32)


def fitted(sample: pa.Table, common: np.ndarray, senders: np.ndarray) -> Boosted:
    """The classifier, fitted on the labelled blocks of a sample of mails. A sample without
    labels leaves PRIOR."""
    known = [(f | {"place": p, "lines": n, "first": p == 0}, label) for f, label in PRIOR for p in PLACES for n in (1, 3)]
    xs = [np.array([[f.get(name, 0) for name in FEATURES] for f, _ in known], np.float32)]
    ys = [np.array([label for _, label in known])]
    late = None
    for blind in (False, True):
        for part in sample.filter(pa.compute.equal(sample.column("blind"), blind)).combine_chunks().to_batches():
            b = _Blocks(part, common, senders)
            late = late or _late(b)
            y = labels_of(b, part.column("known").to_numpy(zero_copy_only=False), *(part.column(c).flatten().to_numpy() for c in ("truth", "loose")), late)
            bare = b.x.copy()
            bare[:, len(FORM) :] = 0
            for x in (b.x, bare):
                xs.append(x[y >= 0])
                ys.append(y[y >= 0])
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def new_lines(mails: DataFrame, sample: int = SAMPLE_MAILS, classifier: Boosted | None = None) -> DataFrame:
    """(graph_id, line_no) of the lines that the senders of mails newly wrote.

    ``mails`` has graph_id, internet_message_id, in_reply_to, body_plain, from_email and
    from_name. A null or empty body has no line; nulls elsewhere only take evidence away:
    a mail whose ancestor is unknown is judged by form and frequency alone. Mails delivered
    twice give their lines once, with other bodies the lines of both. Blank lines are in
    no block. An empty table gives an empty result; one without evidence is judged by the
    trees' prior. ``sample`` mails, those of least hash, so the same in every run, are learnt
    from, unless a ``classifier`` is given.
    """
    rows = mails.where("graph_id is not null and body_plain is not null").select("graph_id", "internet_message_id", "in_reply_to", F.col("body_plain").alias("body"), F.lower("from_email").alias("sender"), F.col("from_name").alias("name"))
    kind_of = "array<long>"

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([line_hashes(x) for x in part.column(1).to_pylist()], pa.list_(pa.int64()))], ["id", "parent"])

    # only mails that are answered are ancestors; one body for each id; only hashes travel
    answered = rows.where("in_reply_to is not null").select(F.col("in_reply_to").alias("id")).distinct()
    ancestors = rows.where("internet_message_id is not null").select("internet_message_id", "body").mapInArrow(hashes, f"id string, parent {kind_of}")
    ancestors = ancestors.join(answered, "id", "left_semi").groupBy("id").agg(F.max("parent").alias("parent"))
    replies = rows.where("in_reply_to is not null").join(ancestors, F.col("in_reply_to") == F.col("id"), "left").withColumn("opens", F.lit(False))
    opening = rows.where("in_reply_to is null").withColumn("parent", F.lit(None).cast(kind_of)).withColumn("opens", F.lit(True))
    columns = ["graph_id", "body", "sender", "name", "parent", "opens"]
    # the hash up to which mails are in the sample: of at most ``sample`` of them
    place = F.xxhash64("graph_id")
    last = max((r[0] for r in rows.select(place.alias("h")).orderBy("h").limit(sample).collect()), default=None) if classifier is None else None
    both = opening.select(columns).unionByName(replies.select(columns)).withColumn("sampled", F.lit(False) if last is None else place <= F.lit(last))
    blocks = cut(segmented(both))
    per_sender = blocks.where("not blind").groupBy("sender").agg(F.count("*").alias("mails")).where(F.col("mails") >= OWN_MAILS)
    own, common, senders = line_statistics(blocks, per_sender, blocks.where("not blind").count())
    joined = blocks.join(own, "sender", "left")
    if classifier is None:
        learnt = joined.where("sampled").select("blind", "known", "sender", "own", "numbers", "size", "hashed", "lines", "features", "truth", "loose").limit(4 * sample).toArrow()
        classifier = fitted(learnt, common, senders)
    shipped = mails.sparkSession.sparkContext.broadcast((common, senders, classifier))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, senders, model = shipped.value
        for batch in batches:
            b = _Blocks(batch, common, senders)
            if not len(b.x):
                continue
            keep = np.flatnonzero(model.predict(b.x) >= 0.5)
            lines = b.numbers[ragged((np.cumsum(b.size) - b.size)[keep].astype(np.int64), b.size[keep].astype(np.int64))]
            mail = np.repeat(b.mail[keep], b.size[keep])
            yield pa.RecordBatch.from_arrays([batch.column("graph_id").take(pa.array(mail)), pa.array(lines, pa.int64())], ["graph_id", "line_no"])

    return joined.where("not blind").select("graph_id", "sender", "own", "numbers", "size", "hashed", "lines", "features").mapInArrow(judge, "graph_id string, line_no long").distinct()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """graph_id, line_no of every newly written line."""
    return new_lines(table(spark, folder, "outlook_messages"))
