"""Near-duplicates, survivors and canonical values against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestream.llm import canonical, neardup, survivor, wordsets

WORD = re.compile(r"[^\W_]+")


def shingles(text, k):
    w = WORD.findall(text.lower())
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(sets, t):
    keys = sorted(sets)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    common = [f"c{k}" for k in range(12)]
    out = {}
    for k in range(n):
        if out and rng.random() < 0.5:
            w = out[rng.choice(list(out))].split()
            for _ in range(rng.randint(0, 12)):
                at = rng.randrange(len(w)) if w else 0
                w[at : at + rng.randint(0, 1)] = rng.sample(vocabulary, rng.randint(0, 2))
        else:
            w = [rng.choice(vocabulary if rng.random() < 0.6 else common) for _ in range(rng.randint(1, 60))]
        out[f"d{k:04d}"] = " ".join(w)
    return out


@pytest.mark.parametrize("length, threshold", [(3, 0.5), (1, 0.75), (2, 0.8)])
def test_pairs_match_brute_force(spark, length, threshold):
    texts = corpus(7, 260)
    df = spark.createDataFrame(list(texts.items()) + [(None, "w1 w2 w3 w4"), ("empty", ""), ("null", None)] + list(texts.items())[:9], "key string, text string")
    membership, links = neardup.near_duplicates(wordsets.word_sets(df, "text", length), threshold)
    got = {tuple(r) for r in neardup.record_pairs(membership, links).collect()}
    assert got == brute({k: shingles(t, length) for k, t in texts.items()}, threshold)


def test_frequent_items_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 6)
    texts = corpus(3, 120)
    df = spark.createDataFrame(list(texts.items()), "key string, text string")
    rows = wordsets.word_sets(df, "text", 1)
    got = {tuple(r) for r in neardup.record_pairs(*neardup.near_duplicates(rows, 0.6)).collect()}
    assert got == brute({k: shingles(t, 1) for k, t in texts.items()}, 0.6)


def test_large_classes_give_a_star(spark):
    rows = [(f"k{k:03d}", "one two three four five six") for k in range(60)] + [("z", "one two three four five seven")]
    sets = wordsets.word_sets(spark.createDataFrame(rows, "key string, text string"), "text", 1)
    membership, links = neardup.near_duplicates(sets, 0.7)
    got = {tuple(r) for r in neardup.record_pairs(membership, links, expanded=8).collect()}
    assert got == {("k000", f"k{k:03d}") for k in range(1, 60)} | {("k000", "z")}
    assert {r["class_size"] for r in membership.collect()} == {60, 1}


def test_large_classes_give_all_pairs(spark, monkeypatch):
    """Equal sets of different texts, more of them than fit one cell, and their links."""
    monkeypatch.setattr(neardup, "CELL", 7)
    words = "one two three four five six".split()
    texts = {f"k{k:03d}": " ".join(words[k % 6 :] + words[: k % 6]) for k in range(40)} | {f"m{k:03d}": " ".join(words[:5] + ["seven"]) for k in range(20)}
    df = spark.createDataFrame([*texts.items(), ("k000", texts["m000"])], "key string, text string")
    got = [tuple(r) for r in neardup.record_pairs(*neardup.near_duplicates(wordsets.word_sets(df, "text", 1), 0.7)).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in texts for b in texts if a < b}


def test_empty_input(spark):
    sets = wordsets.word_sets(spark.createDataFrame([], "key string, text string"), "text", 3)
    assert neardup.record_pairs(*neardup.near_duplicates(sets, 0.5)).count() == 0


def test_frequencies_are_exact(spark):
    rng = random.Random(4)
    rows = [(k, sorted({rng.randrange(50) for _ in range(rng.randint(0, 20))})) for k in range(200)]
    got = {r["item"]: r["sets"] for r in neardup.shared_items(spark.createDataFrame(rows, "class_id long, items array<long>")).collect()}
    assert got == {x: n for x, n in Counter(x for _, items in rows for x in items).items() if n > 1}


def test_lists_of_a_hot_item_stay_short(spark):
    """One item in 200,000 sets: no list holds more than two blocks of them, and all pairs of sets meet."""
    from pyspark.sql import functions as F

    total = 200_000
    entries = spark.range(total).select(F.col("id").alias("class_id"), F.lit(1).alias("n"), F.lit(77).cast("bigint").alias("item"), F.lit(total).cast("bigint").alias("sets"))
    rows = neardup.with_prefixes(entries, 0.5, 4)
    lists = rows.select(F.explode("items").alias("list")).groupBy("list").agg(F.count("*").alias("n"))
    longest, number = lists.agg(F.max("n"), F.count("*")).first()
    assert longest <= 2.2 * neardup.BLOCK < total / 1.7
    assert number == 4 * 5 // 2
    where = rows.where("class_id < 40").select("class_id", F.explode("items").alias("list")).groupBy("class_id").agg(F.collect_set("list").alias("lists")).collect()
    assert all(set(a["lists"]) & set(b["lists"]) for a in where for b in where)


def test_groups_collapse_equal_prefixes(spark):
    """Documents of one prefix and size with another rest: one group of several classes, whose
    members are told apart and matched after it was expanded."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    sets = {}
    for g in range(6):
        rare = [f"rare{g}x{k}" for k in range(8)]
        for m in range(5):
            sets[f"g{g}m{m}"] = " ".join(rare + rng.sample([f"common{k}" for k in range(12)], 8))
    df = spark.createDataFrame(list(sets.items()), "key string, text string")
    rows = wordsets.word_sets(df, "text", 1).withColumn("class_id", F.xxhash64("items"))
    groups, classes = neardup.with_prefixes(neardup.entries_of(rows).join(neardup.shared_items(rows), "item"), 0.7, 4).agg(F.countDistinct("grp"), F.countDistinct("class_id")).first()
    assert classes == 30 and groups == 6
    got = {tuple(r) for r in neardup.record_pairs(*neardup.near_duplicates(rows.select("key", "items"), 0.7)).collect()}
    want = brute({k: shingles(t, 1) for k, t in sets.items()}, 0.7)
    assert got == want and 0 < len(want) < 6 * 10


def claims(spark, rows):
    return spark.createDataFrame(rows, "grp string, field string, row string, source string, at_ms long, value string, raw string")


def test_latest_value_of_each_field(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    rows = [(f"g{g}" if g else None, f"r{g}{r:02d}", rng.randint(0, 5), rng.choice(["a", "b", None]), rng.choice(["c", None])) for g in range(20) for r in range(rng.randint(1, 5))]
    df = spark.createDataFrame(rows + rows[:9], "k string, row string, at_ms long, x string, y string")
    got = [tuple(r) for r in survivor.latest(df, ["k"], "row", "at_ms", {"x": F.col("x"), "y": F.col("y")}).collect()]
    want = set()
    for g in {r[0] for r in rows if r[0]}:
        mine = [r for r in rows if r[0] == g]
        for name, k in (("x", 3), ("y", 4)):
            held = [(-r[2], r[1]) for r in mine if r[k] is not None]
            if held and len(mine) > 1:
                want.add((min(r[1] for r in mine), name, min(held)[1]))
    assert len(got) == len(want) and set(got) == want
    assert survivor.latest(df.limit(0), ["k"], "row", "at_ms", {"x": F.col("x")}).count() == 0


def fused_by_hand(rows, rounds):
    """The model of fuse() on lists: (grp, field, row) -> (copy, log_odds, p)."""
    S = survivor
    first = {}
    for g, f, row, s, at, v, _ in sorted(rows, key=lambda r: (r[4], r[2])):
        first.setdefault((g, f, v), (row, s))
    is_later = lambda g, f, row, s, v: row != first[g, f, v][0] and s != first[g, f, v][1]
    copy = {(g, f, row): S.DEPENDENT if is_later(g, f, row, s, v) else 0.0 for g, f, row, s, _, v, _ in rows}
    accuracy = dict.fromkeys({r[3] for r in rows}, S.ACCURACY)

    def posterior():
        odds = defaultdict(float)
        for g, f, row, s, _, v, _ in rows:
            a = min(max(accuracy[s], 0.01), 0.99)
            odds[g, f, v] += np.log(S.FALSE_VALUES * a / (1 - a)) * (1 - S.COPIED * copy[g, f, row])
        z = defaultdict(float)
        for (g, f, _), o in odds.items():
            z[g, f] += np.exp(o)
        return odds, {k: np.exp(o) / z[k[:2]] for k, o in odds.items()}

    for _ in range(rounds):
        _, p = posterior()
        mine = defaultdict(list)
        for g, f, _, s, _, v, _ in rows:
            mine[s].append(p[g, f, v])
        accuracy_before, accuracy = accuracy, {s: (sum(x) + S.ACCURACY * S.WEIGHT) / (len(x) + S.WEIGHT) for s, x in mine.items()}
        said = defaultdict(set)
        for g, f, _, s, _, v, _ in rows:
            said[g, f, s].add(v)
        shared = {(g, f, v, s, first[g, f, v][1]) for g, f, row, s, _, v, _ in rows if is_later(g, f, row, s, v)}
        evidence = defaultdict(float)
        for g, f, v, s, o in shared:
            a, b = accuracy[s], accuracy[o]
            alone, same = ((1 - a) * (1 - b) / S.FALSE_VALUES, 1 - b) if p[g, f, v] < 0.5 else (a * b, b)
            evidence[s, o] += np.log((S.COPIED * same + (1 - S.COPIED) * alone) / alone)
        for s, o in evidence:
            evidence[s, o] += np.log(1 - S.COPIED) * sum(x == s and (g, f, o) in said and not said[g, f, s] & said[g, f, o] for g, f, x in said)
        for g, f, row, s, _, v, _ in rows:
            if is_later(g, f, row, s, v):
                e = min(max(evidence[s, first[g, f, v][1]], -30), 30)
                copy[g, f, row] = 1 / (1 + np.exp(-e - np.log(S.DEPENDENT / (1 - S.DEPENDENT))))
        if max(abs(accuracy[s] - accuracy_before[s]) for s in accuracy) <= S.SETTLED:
            break
    odds, p = posterior()
    return {(g, f, row): (copy[g, f, row], odds[g, f, v], p[g, f, v]) for g, f, row, _, _, v, _ in rows}


def test_fusion_matches_the_model_by_hand(spark):
    rng = random.Random(5)
    rows = [(f"g{g}", f, f"r{g}{r:02d}", f"s{rng.randint(0, 4)}", rng.randint(0, 5), v := rng.choice("aaab" + str(r)), v) for g in range(25) for f in ("x", "y") for r in range(rng.randint(1, 5))]
    want = fused_by_hand(rows, survivor.ROUNDS)
    got = {(r["grp"], r["field"], r["row"]): (r["copy"], r["log_odds"], r["p"]) for r in survivor.fuse(claims(spark, rows)).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6), k


def test_disagreement_lowers_dependence(spark):
    """Two sources share 40 true values and differ in 80 fields: no copiers. A planted copier is one."""
    rows = []
    for k in range(120):
        g = f"g{k:03d}"
        t = f"t{k}"
        said = (("a", 1, t if k < 40 else f"a{k}" if k % 2 else t), ("b", 2, t if k < 40 else t if k % 2 else f"b{k}"), ("c", 3, t), ("d", 4, f"a{k}" if k >= 40 and k % 2 else t), ("e", 5, t))
        rows += [(g, "x", f"{g}{s}", s, at, v, v) for s, at, v in said]
    fused = survivor.fuse(claims(spark, rows)).where("copy > 0").groupBy("source").agg({"copy": "max"}).toDF("source", "copy")
    copy = {r["source"]: r["copy"] for r in fused.collect()}
    assert copy["b"] < 0.01 and copy["d"] > 0.9


def test_planted_accuracies_are_found(spark):
    """Sources of known accuracy, one of them copied: the estimates are near, and more true values survive than by recency."""
    rng = random.Random(2)
    true = {"a": 0.95, "b": 0.9, "c": 0.6, "d": 0.5}
    rows = []
    for k in range(300):
        g = f"g{k:03d}"
        say = {s: "t" if rng.random() < p else f"f{rng.randint(0, 9)}" for s, p in true.items()}
        say["e"] = say["d"] if rng.random() < 0.95 else "t"  # e copies d, and is always the newest
        rows += [(g, "x", f"{g}{s}", s, "abcde".index(s), v, v) for s, v in say.items()]
    fused = survivor.fuse(claims(spark, rows))
    accuracy = {r["source"]: r["accuracy"] for r in fused.select("source", "accuracy").distinct().collect()}
    for s, p in true.items():
        assert abs(accuracy[s] - p) < 0.08, (s, accuracy[s])
    won = [r["value"] for r in survivor.survivors(fused, half_life_ms=100).collect()]
    newest = [v for *_, s, _, v, _ in rows if s == "e"]
    assert won.count("t") / len(won) > 0.95 > newest.count("t") / len(newest)


def test_copied_votes_count_less(spark):
    """Source c repeats a's mistakes; against two independent sources it should lose."""
    rows = []
    for k in range(40):
        g = f"g{k:02d}"
        wrong = k % 2 == 0
        rows += [(g, "x", f"{g}a", "a", 1, v := f"bad{k}" if wrong else "t", v), (g, "x", f"{g}c", "c", 2, v, v), (g, "x", f"{g}b", "b", 1, "t", "t"), (g, "x", f"{g}d", "d", 1, "t", "t")]
    fused = survivor.fuse(claims(spark, rows))
    copy = {r["source"]: r["p"] for r in fused.groupBy("source").agg({"copy": "avg"}).toDF("source", "p").collect()}
    assert copy["c"] > 0.4 > copy["a"]
    won = {r["grp"]: r["value"] for r in survivor.survivors(fused, half_life_ms=10**9).collect()}
    assert set(won.values()) == {"t"}
    accuracy = {r["source"]: r["accuracy"] for r in fused.select("source", "accuracy").distinct().collect()}
    assert accuracy["b"] > accuracy["a"]


def test_honest_sources_are_no_copiers(spark):
    """a and b share many true values, but differ in a fourth of them; c copies a. The verdict
    holds for a table of any size."""
    for size in (24, 96):
        rows = []
        for k in range(size):
            g = f"g{k:02d}"
            a, b = ("ta"[k % 8 == 0] + str(k), "tb"[k % 8 == 1] + str(k)) if k % 4 < 2 else (f"t{k}", f"t{k}")
            said = (("a", 1, a), ("b", 2, b), ("c", 3, a), ("d", 4, f"t{k}" if k % 3 else f"d{k}"))
            rows += [(g, "x", f"{g}{s}", s, at, v, v) for s, at, v in said]
        fused = survivor.fuse(claims(spark, rows))
        copy = {r["source"]: r["p"] for r in fused.groupBy("source").agg({"copy": "max"}).toDF("source", "p").collect()}
        assert copy["b"] < 0.1 and copy["d"] < 0.1 and copy["c"] > 0.3


NAMES = {
    "location": [(1, "Pune", ["Poona"]), (2, "Mumbai", ["Bombay"]), (3, "Navi Mumbai", []), (4, "Noida", []), (5, "Greater Noida", []), (6, "Chennai", ["Madras"]), (7, "Chandigarh", []), (8, "Bangalore", ["Bengaluru"])],
    "client": [(11, "Norvane Capital", []), (12, "Norvane Systems", []), (13, "Kelmora Software", ["KEL"]), (14, "Ryndale Labs", [])],
    "job_title": [(21, "Java Developer", []), (22, "JavaScript Developer", []), (23, "Data Engineer", []), (24, "SAP MM Consultant", []), (25, "SAP SD Consultant", []), (26, "Network Engineer", []), (27, "Network Security Analyst", []), (28, "HR Recruiter", [])],
}

VALUES = [
    ("location", "poona ", [1]), ("location", "NaviMumbai", [3]), ("location", "Navi Mumbai, India", [3]), ("location", "pune/Greater Nodia", [1, 5]), ("location", "Chn", [6]), ("location", "B'lore", [8]), ("location", "4 days from Mumbai", [2]),
    ("location", "Remote", [0]), ("location", "Oskquamoula Tech Park", [0]), ("location", "Client office - Bangaloer", [8]), ("location", "Pan India", [0]),
    ("client", "Kelmora", [13]), ("client", "KELMORA SOFTWARE Pvt Ltd", [13]), ("client", "kel", [13]), ("client", "kelmora.example", [13]), ("client", "Rnydale Labbs", [14]), ("client", "Norvane", [0]), ("client", "Norvane Cap.", [11]), ("client", "NOS", [12]), ("client", "Gupfel & Sons", [0]),
    ("job_title", "Sr. Java Dev", [21]), ("job_title", "Javascript Developers", [22]), ("job_title", "Engineer (Data) - urgent", [23]), ("job_title", "Consultant, SAP SDs", [25]), ("job_title", "Lead Network Security Anlst/Associate", [27]), ("job_title", "Netwrok Engg. || Pune || 8+ years", [26]), ("job_title", "Recruiter - HR", [28]), ("job_title", "Glass Blower", [0]), ("job_title", "Developer", [0]), ("job_title", "x" * 100_000, [0]), ("job_title", "???", [0]),
]


def test_values(spark):
    df = spark.createDataFrame([(k, v) for k, v, _ in VALUES] * 2 + [(None, "Pune"), ("location", None)], "kind string, value string")
    entries = spark.createDataFrame([(e, k, n, a) for k, names in NAMES.items() for e, n, a in names] + [(None, "client", "x", None), (99, "client", None, ["y"])], "entry_id long, kind string, name string, aliases array<string>")
    got = defaultdict(list)
    for r in canonical.map_values(df, entries).collect():
        got[r["kind"], r["value"]].append(r["entry_ids"])
    for kind, value, want in VALUES:
        assert got[kind, value] == [want], (kind, value[:40], got[kind, value])
    assert canonical.map_values(df.limit(0), entries).count() == 0


def test_distance():
    for a, b, d in [("abc", "abc", 0), ("abc", "acb", 1), ("abc", "ab", 1), ("abcd", "xbcy", 2), ("", "ab", 2), ("abcdef", "uvwxyz", 3)]:
        assert canonical.distance(a, b, 2) == d


def test_deletions_meet_for_all_near_words():
    """Words within the allowed edits share a key, swaps and ends included."""
    rng = random.Random(6)
    pairs = []
    for _ in range(600):
        w = "".join(rng.choice("abcde") for _ in range(rng.randint(3, 13)))
        t = list(w)
        for _ in range(rng.randint(0, canonical.edits(len(w)))):
            at = rng.randrange(len(t))
            what = rng.randrange(4)
            if what == 0 and at:
                t[at - 1], t[at] = t[at], t[at - 1]
            elif what == 1:
                t[at] = rng.choice("abcde")
            elif what == 2 and len(t) > 2:
                del t[at]
            else:
                t.insert(at, rng.choice("abcde"))
        pairs.append((w, "".join(t), canonical.edits(len(w))))
    near = [(w, t, k) for w, t, k in pairs if canonical.distance(w, t, k) <= k]
    assert len(near) > 400 and all(canonical.deletions(w, k) & canonical.deletions(t, k) for w, t, k in near)
