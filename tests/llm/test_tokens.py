"""The numpy tokenizer against the public library, packing and splitting."""

import random
from collections import defaultdict
from itertools import combinations
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestream.llm import packing, splitting, tokens
from lodestream.llm.bpe import encoder

VOCABULARY = tokens.VOCABULARY
pytestmark = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids if x else []


def ours(texts):
    ids, n = encoder(VOCABULARY).encode(texts)
    out, at = [], 0
    for k in n:
        out.append(ids[at : at + k].tolist())
        at += k
    return out


HARD = [
    "", None, " ", "\n\n\n", "  a", "a  ", "it's we'll I'M 'S", "<|endoftext|>", "\x00\x1c\x1f\x85\xa0 ", "é é ß İ", "漢字かな交じり文" * 50, "नमस्ते दुनिया " * 20,
    "🏳️‍🌈👩‍👩‍👧‍👦", "a" * 70_000, "ab" * 30_000, "0123456789" * 500, "\t\t\r\n x", "x" * 97 + " " * 97, "=" * 1000, "﻿bom", "".join(map(chr, range(1, 0x250))),
]


def test_hard_texts(reference):
    assert ours(HARD) == [reference(x) for x in HARD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=6))
def test_any_text(reference, texts):
    assert ours(texts) == [reference(x) for x in texts]


def test_random_bytes_of_one_word(reference):
    rng = random.Random(5)
    for _ in range(20):
        x = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(90, 4000)))
        assert ours([x]) == [reference(x)]


def test_whole_corpus(spark, sf, reference):
    rows = tokens.p8_ids(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r["ids"] == reference(texts[r["doc_id"]]) for r in rows)


def test_reduction_keeps_the_optimum():
    """The fixed sets and an optimal packing of the rest are as good as an optimal packing."""

    def best(items, capacity):
        items = sorted(items, reverse=True)
        most = [len(items)]

        def place(k, bins):
            if len(bins) >= most[0]:
                return
            if k == len(items):
                most[0] = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                    bins[i] += items[k]
                    place(k + 1, bins)
                    bins[i] -= items[k]
            bins.append(items[k])
            place(k + 1, bins)
            bins.pop()

        place(0, [])
        return most[0]

    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.randint(8, 30)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = defaultdict(int)
        for s in items:
            counts[s] += 1
        fixed, rest = packing.reduce_instance(dict(counts), capacity)
        assert all(sum(i) <= capacity for i, _ in fixed)
        left = [s for s, n in rest.items() for _ in range(n)]
        used = sorted([s for i, n in fixed for s in i * n] + left)
        assert used == sorted(items)
        # fixed sets may be filled up further; alone they must not cost a container
        assert sum(n for _, n in fixed) + (best(left, capacity) if left else 0) == best(items, capacity)


def check_packing(rows, sizes, capacity):
    load = defaultdict(int)
    parts = defaultdict(list)
    for r in rows:
        load[r["container_id"]] += r["part_tokens"]
        parts[r["k"]].append((r["part_no"], r["part_tokens"]))
    assert max(load.values(), default=0) <= capacity
    for k, n in sizes.items():
        got = sorted(parts[k])
        assert [p for p, _ in got] == list(range(1, len(got) + 1)) and sum(x for _, x in got) == (n or 0)
        assert len(got) == 1 or (n or 0) > capacity
    assert set(parts) == set(sizes)
    return load


def test_packing(spark):
    rng = random.Random(2)
    sizes = {k: rng.choice([None, 0, 1, 3, 7, 50, 64, 99, 100, 101, 250, rng.randint(1, 400)]) for k in range(900)}
    df = spark.createDataFrame([(k, n, "x") for k, n in sizes.items()] + [(None, 5, "x")], "k long, n long, container_id string")
    load = check_packing(packing.pack(df, "k", "n", 100).collect(), sizes, 100)
    assert len(load) <= -(-sum(n or 0 for n in sizes.values()) // 100) * 1.05 + 1
    assert packing.pack(df.limit(0), "k", "n", 100).count() == 0
    assert {r["container_id"] for r in packing.pack(df.where("n = 0"), "k", "n", 100).collect()} == {1}
    check_packing(packing.pack(df.where("k = 1").withColumn("n", F.lit(1000).cast("long")), "k", "n", 100).collect(), {1: 1000}, 100)


def test_one_size_holds_most_rows(spark):
    df = spark.range(30_000).select(F.col("id").alias("k"), F.when(F.col("id") < 20_000, 7).otherwise(F.col("id") % 90 + 1).cast("long").alias("n"))
    rows = packing.pack(df, "k", "n", 100).collect()
    sizes = {r["k"]: r["n"] for r in df.collect()}
    assert len(check_packing(rows, sizes, 100)) <= sum(sizes.values()) / 100 * 1.01 + 1


def test_numbers_within_groups(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id")
    rows = packing.number_within(df, "g", "id", 5000, "i", most=100).collect()
    for g in range(3):
        assert sorted(r["i"] for r in rows if r["g"] == g) == list(range(sum(r["g"] == g for r in rows)))


TEXTS = [
    "# One\n\nFirst part. More of it here.\n\n## Two\n\n" + "- item with words\n" * 60 + "\n# Three\n\n" + "A sentence of some length follows. " * 80,
    "word " * 3000, "a" * 20_000, "漢字" * 3000, "é" * 4000, "x\n" * 4000, "\n" * 3000, "नमस्ते" * 2000, "<h1>T</h1><p>" + "text in markup " * 400 + "</p><ul>" + "<li>entry</li>" * 300, "short", "", None,
]


@pytest.mark.parametrize("most, overlap", [(64, 8), (512, 48), (40, 0)])
def test_pieces(most, overlap):
    enc = encoder(VOCABULARY)
    for text in TEXTS:
        pieces = splitting.split_text(enc, text, most, overlap)
        if not text:
            assert pieces == []
            continue
        total = int(enc.count([text])[0])
        assert pieces[0][0] == 0 and pieces[0][2] == 0 and pieces[-1][1] == len(text) and pieces[-1][3] == total
        for a, b in zip(pieces, pieces[1:]):
            assert a[0] <= b[0] <= a[1] < b[1] and b[2] <= a[3]
            if overlap == 0:
                assert b[0] == a[1]
        for s, e, t, u, n in pieces:
            assert n == enc.count([text[s:e]])[0] <= most and u - t <= most
        shared = [a[3] - b[2] for a, b in zip(pieces, pieces[1:])]
        if overlap and shared:
            # one or a few tokens more where it would fall inside a character; less only from the text's start
            assert all(overlap <= x <= overlap + 8 or b[2] == 0 for x, b in zip(shared, pieces[1:]))


def test_texts_that_encode_to_more_than_their_tokens():
    """Pieces that begin inside a word encode to more tokens: they are split again with a larger
    reserve, with the same overlap."""
    enc = encoder(VOCABULARY)
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüéèñ漢字") for _ in range(30_000))
    for most, overlap in ((32, 12), (40, 20), (64, 8)):
        pieces = splitting.split_text(enc, text, most, overlap)
        assert all(p[4] <= most for p in pieces) and pieces[-1][1] == len(text)
        assert all(a[3] - b[2] >= overlap or b[2] == 0 for a, b in zip(pieces, pieces[1:]))


def test_cuts_prefer_stronger_boundaries():
    text = ("# A\n\n" + "One two three four. " * 8 + "\n\n") * 2 + "# B\n\n" + "Five six seven. " * 6
    enc = encoder(VOCABULARY)
    cuts = [e for _, e, _, _, _ in splitting.split_text(enc, text, 70, 4)][:-1]
    assert cuts == [m for m in range(1, len(text)) if text.startswith("# ", m)]


def test_split_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "word " * 900, "x"), (1, "word " * 900, "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, extra string")
    rows = splitting.split(df, "text", 100, 10).collect()
    assert {r["doc_id"] for r in rows} == {1} and {r["extra"] for r in rows} == {"x"} and len(rows) % 2 == 0
    assert splitting.split(df.limit(0), "text", 100, 10).count() == 0
    with pytest.raises(ValueError):
        splitting.split(df.withColumn("piece", F.lit(1)), "text", 100, 10)
    with pytest.raises(ValueError):
        tokens.encode(df.withColumn("ids", F.lit(1)), "text")
    assert list(combinations([1], 2)) == []
