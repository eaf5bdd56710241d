"""Mapping typed values to a reference list (problem 5): token-level repair, soft TF-IDF.

Each distinct token of all typed values is joined once to the words of the reference
names: by edit distance (both sides' deletions meet, then the distance is verified), and by
beginnings and skeletons of consonants. A value's repaired tokens are joined to the names
that hold their rare words, and then rank these complete entries: an entry's score is the share
of its words' weight (inverse document frequency) that the value holds, each word as similar as
it was repaired. What no entry reaches is reported. The list may be of any size: it is joined,
never sent around whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions.values import is_real, placeholder_list
from lodestream.session import cut
from lodestream.sources.tables import table

#: field -> kind of entry
KINDS = {"location": "location", "requirement_from": "client", "job_title": "job_title"}

#: Common words that are never repaired into a name (fixed values).
PLAIN = frozenset("a an and any as at for from in is more no not of on only or other the to up with".split())

#: A token of OWN_VALUES values or more is a word of its own, no misspelling, where it stands in more
#: than OWN_PART as many values as the near word, and no abbreviation where in more than the word:
#: misspellings are rarer than what they miss.
OWN_VALUES, OWN_PART = 4, 0.25

#: Share of a name's weight that a value must hold.
CLIENT, TITLE = 0.75, 0.72

#: Deletions are made within so many first characters; words that near share one of them.
PREFIX = 7

_TOKEN = re.compile(r"[^\W_]+")


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower().replace("'", "").replace("’", ""))


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


def edits(length: int) -> int:
    """How many edits a word of that length may differ by."""
    return 0 if length < 3 else 1 if length < 4 else 2 if length < 9 else 3


def repair(kind: str, token: str, times: int, candidates: list[tuple[str, bool, int]]) -> list[tuple[str, float]]:
    """The reference words that a token of ``times`` values may stand for, with similarities, among
    candidates (word, whether it is a name written as one word, in how many values it stands)."""
    words = {w for w, _, _ in candidates}
    found: dict[str, float] = {}
    for w in (token + "s", token[:-1] if token.endswith("s") else ""):  # number
        if len(w) > 1 and w in words:
            found[w] = 0.97
    if token in words:
        return [(token, 1.0), *found.items()]
    if token in PLAIN or not token.isalpha() or len(token) < 2 or found:
        return list(found.items())
    mine, stem = allowed(kind, token), stem_of(token)
    for w, joined, n in candidates:
        most = min(edits(len(w)), mine)
        if times >= OWN_VALUES and times > OWN_PART * n:
            most = 0
            if times > n:
                continue
        if w.isalpha() and abs(len(w) - len(token)) <= most and (d := distance(token, w, most)) <= most:
            found[w] = max(found.get(w, 0), 1 - d / max(len(w), len(token)) * 0.9)
        if len(stem) > 2 and not joined and w[0] == stem[0]:
            if w.startswith(stem):
                found[w] = max(found.get(w, 0), 0.9)
            elif len(w) > len(stem) and len(w) > 4:
                found[w] = max(found.get(w, 0), _skeleton(stem, w))
    return sorted(((w, x) for w, x in found.items() if x), key=lambda x: (-x[1], x[0]))


#: A reference name: its entry, its words, their weights, and its entry's rarest word.
Name = tuple[int, list[str], list[float], str | None]


def stand_for(kind: str, text: str, repaired: dict[str, list[tuple[str, float]]], names: list[Name]) -> list[int]:
    """The entries among names that a value stands for, [0] where it stands for none."""
    words = tokens_of(text)
    return sorted(set(_places(words, repaired, names) if kind == "location" else _best(kind, words, repaired, names))) or [0]


def _places(words: list[str], repaired: dict, names: list[Name]) -> list[int]:
    """All names in the text, the longest first, none in another's words."""
    sims = [dict(repaired.get(t, ())) for t in words]
    hits = []
    for entry_id, name, idf, _ in names:
        for at in range(len(words) - len(name) + 1):
            held = [sims[at + k].get(n, 0.0) for k, n in enumerate(name)]
            if min(held) <= 0:
                continue
            score = sum(s * w for s, w in zip(held, idf)) / sum(idf)
            if score >= (0.6 if len(name) > 1 else 0.69):
                hits.append((len(name), score, -at, entry_id))
    taken: set[int] = set()
    out: list[int] = []
    hits.sort(reverse=True)
    for size, score, at, entry_id in hits:
        place = set(range(-at, -at + size))
        if place & taken:
            continue
        rivals = {h[3] for h in hits if h[0] == size and h[2] == at and abs(h[1] - score) < 1e-9}
        taken |= place
        if len(rivals) == 1:  # a token that could be two places is none
            out.append(entry_id)
    return out


def _best(kind: str, words: list[str], repaired: dict, names: list[Name]) -> list[int]:
    """The one entry with the greatest share of its weight in the text."""
    best: dict[str, float] = {}
    for token in words:
        for w, s in repaired.get(token, ()):
            best[w] = max(best.get(w, 0.0), s)
    scored: dict[int, tuple[float, float]] = {}
    rarest = {}
    for entry_id, name, idf, rare in names:
        held = sum(best.get(n, 0.0) * w for n, w in zip(name, idf))
        scored[entry_id] = max(scored.get(entry_id, (0.0, 0.0)), (held / sum(idf), held))
        rarest[entry_id] = rare
    order = sorted(((s, h, e) for e, (s, h) in scored.items() if h > 0), reverse=True)
    if kind == "client":  # the rarest word of a name may stand for it alone
        first = [x for x in order if rarest[x[2]] is not None and best.get(rarest[x[2]], 0.0) >= 0.8]
        order = [x for x in order if x[0] >= CLIENT] or first
    else:
        order = [x for x in order if x[0] >= TITLE]
    if not order:
        return []
    # a fuller name that is nearly as well held outranks a shorter one inside it
    top = max((x for x in order if x[0] >= order[0][0] - 0.12), key=lambda x: (round(x[1], 6), x[0]))
    if sum(1 for x in order if abs(x[0] - top[0]) < 1e-9 and abs(x[1] - top[1]) < 1e-9) > 1:
        return []  # it could be two
    return [top[2]]


def _skeleton(short: str, word: str) -> float:
    """How well ``short`` abbreviates word by leaving letters out (the first stays): 0.8 to
    0.9 by how many of the word's consonants it keeps, 0 where it has other letters or order."""
    at = 0
    for c in short:
        at = word.find(c, at) + 1
        if not at:
            return 0.0
    once = re.sub(r"(.)\1+", r"\1", word)
    kept = once[0] + re.sub("[aeiou]", "", once[1:])
    return 0.8 + 0.1 * min(1.0, len(short) / len(kept))


def _words(c: Column) -> Column:
    """tokens_of() as an expression."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(c), "['’]", ""), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def reference_names(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words, names) of entries (entry_id, kind, name, aliases).

    words: (kind, word, idf, joined), each word of the names, of names written as one word
    (joined) and of codes, with its weight. names: (kind, entry_id, words, idfs, rare, keys), each
    name; rare is the rarest word of the entry's longest name, keys are the words of which a
    value must hold one to reach the entry. Entries without id or name are left out.
    """
    entries = entries.where("entry_id is not null and name is not null and kind is not null")
    totals = entries.groupBy("kind").agg(F.count("*").alias("total"))
    plain = entries.select("kind", "entry_id", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    plain = plain.select("kind", "entry_id", _words(F.col("name")).alias("words")).where(F.size("words") > 0).distinct()
    joined = plain.where(F.size("words") > 1).select("kind", "entry_id", F.array(F.array_join("words", "")).alias("words"))
    # clients that share their first word have codes of both words
    held = plain.unionByName(joined).select("kind", "entry_id", F.explode("words").alias("word")).groupBy("kind", "word").agg(F.countDistinct("entry_id").alias("n"))
    shared = held.where("kind = 'client' and n > 1").select("kind", F.col("word").alias("head"))
    codes = plain.where("kind = 'client' and size(words) > 1").withColumn("head", F.col("words")[0]).join(shared, ["kind", "head"], "left_semi")
    codes = codes.select("kind", "entry_id", F.array(F.concat(F.substring("head", 1, 2), F.substring(F.col("words")[1], 1, 1))).alias("words"))
    names = cut(plain.unionByName(joined).unionByName(codes).distinct())
    each = names.select("kind", "entry_id", "words", F.posexplode("words").alias("at", "word"))
    words = each.groupBy("kind", "word").agg(F.countDistinct("entry_id").alias("n")).join(totals, "kind")
    one = joined.select("kind", F.col("words")[0].alias("word")).distinct().withColumn("joined", F.lit(True))
    words = words.join(one, ["kind", "word"], "left").select("kind", "word", F.log(1 + F.col("total") / F.col("n")).alias("idf"), F.coalesce("joined", F.lit(False)).alias("joined"))
    words = cut(words)
    weighed = each.join(words.select("kind", "word", "idf"), ["kind", "word"]).groupBy("kind", "entry_id", "words").agg(F.array_sort(F.collect_list(F.struct("at", "idf", "word"))).alias("w"))
    weighed = weighed.withColumn("idfs", F.col("w.idf")).withColumn("rarest", F.array_max(F.transform("w", lambda x: F.struct(x["idf"], (-x["at"]).alias("at"), x["word"])))["word"])
    longest = weighed.where(F.size("words") > 1).groupBy("kind", "entry_id").agg(F.max_by("rarest", F.struct(F.size("words").alias("n"), "words")).alias("rare"))
    # a name is found by its rarest words, as many as it can't do without
    down = F.sort_array(F.transform("w", lambda x: F.struct(x["idf"], x["word"])), asc=False)
    weighed = weighed.withColumn("down", down).withColumn("all", F.aggregate("idfs", F.lit(0.0), lambda a, x: a + x))
    least = F.when(F.col("kind") == "location", 1.0).when(F.col("kind") == "client", CLIENT).otherwise(TITLE) * F.col("all") - 1e-9
    rest = lambda i: F.aggregate(F.slice("down", i + 1, F.size("down")), F.lit(0.0), lambda a, x: a + x["idf"])
    keys = F.transform(F.filter("down", lambda x, i: rest(i) >= least), lambda x: x["word"])
    names = weighed.join(longest, ["kind", "entry_id"], "left")
    keys = F.when((F.col("kind") == "client") & F.col("rare").isNotNull(), F.array_distinct(F.concat(keys, F.array("rare")))).otherwise(keys)
    return words, cut(names.select("kind", "entry_id", "words", "idfs", "rare", keys.alias("keys")))


def deletions(word: str, most: int) -> set[str]:
    """The first PREFIX characters of a word without up to ``most`` of them. Two words within that
    many edits have one in common."""
    start = word[:PREFIX]
    return {"".join(c for k, c in enumerate(start) if k not in gone) for n in range(min(most, len(start)) + 1) for gone in combinations(range(len(start)), n)}


def stem_of(token: str) -> str:
    """A token without a plural s and without the double of its last letter."""
    stem = token[:-1] if len(token) > 3 and token[-1] == "s" else token
    return stem[:-1] if len(stem) > 3 and stem[-1] == stem[-2] else stem


def allowed(kind: str, token: str) -> int:
    """How many edits a typed token may be from a word, whatever the word."""
    return edits(max(4, len(token) + 1)) if kind == "job_title" else edits(len(token) + 1)


def token_keys(kind: str, token: str) -> set[str]:
    """What a token meets words by: near ones by deletions, words that it abbreviates by its first
    three letters."""
    stem = stem_of(token)
    return {"d" + x for x in deletions(token, allowed(kind, token))} | ({"a" + stem[:3]} if len(stem) > 2 else set())


def word_keys(word: str, joined: bool) -> set[str]:
    """What a word meets tokens by: an abbreviation has its first letter, then others in order."""
    thirds = set() if joined else {"a" + word[0] + x + y for x, y in combinations(word[1:], 2)}
    return {"d" + x for x in deletions(word, edits(len(word)))} | thirds


def _with_keys(df: DataFrame, columns: list[str], of: Callable[..., set[str]], schema: str) -> DataFrame:
    """df (columns, arguments of ``of``) with a row for each of its keys, named key."""

    names = [*df.columns, "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                keys = [sorted(of(*row)) for row in zip(*(part.column(c).to_pylist() for c in columns))]
                take = pa.array([i for i, x in enumerate(keys) for _ in x], pa.int64())
                yield pa.RecordBatch.from_arrays([*(c.take(take) for c in part.columns), pa.array([x for y in keys for x in y], pa.string())], names)

    return df.mapInArrow(run, schema)


def near_words(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(kind, token, times, candidates) of distinct tokens (kind, token, times): the words (kind, word,
    joined) that repair() may find, with how often they are tokens themselves; an equi-join on
    keys that both sides make of themselves."""
    given = words.select("kind", "word", "joined")
    counted = tokens.select("kind", F.col("token").alias("word"), F.col("times").alias("n"))
    seen = given.join(counted, ["kind", "word"], "left").select("kind", "word", F.coalesce("n", F.lit(0)).alias("n"))
    forms = F.array_distinct(F.array("token", F.concat("token", F.lit("s")), F.regexp_replace("token", "s$", "")))
    same = tokens.select("kind", "token", F.explode(forms).alias("word")).join(given, ["kind", "word"])
    unknown = tokens.join(given.select("kind", F.col("word").alias("token")), ["kind", "token"], "left_anti").where(~F.col("token").isin(*PLAIN) & (F.length("token") >= 2))
    a = _with_keys(unknown.select("kind", "token"), ["kind", "token"], token_keys, "kind string, token string, key string")
    b = _with_keys(given, ["word", "joined"], word_keys, "kind string, word string, joined boolean, key string")
    near = F.col("key").startswith("a") | (F.abs(F.length("token") - F.length("word")) <= 3)
    met = a.join(b, ["kind", "key"]).where(near).select("kind", "token", "word", "joined")
    found = same.select("kind", "token", "word", "joined").unionByName(met)
    found = found.join(seen, ["kind", "word"]).groupBy("kind", "token").agg(F.collect_set(F.struct("word", "joined", "n")).alias("candidates"))
    return found.join(tokens, ["kind", "token"])


_REPAIRED = "kind string, token string, words array<struct<word:string,sim:double>>"


def map_values(values: DataFrame, entries: DataFrame) -> DataFrame:
    """(kind, value, entry_ids) of distinct (kind, value); entry_ids is [0] where nothing fits.

    ``entries`` is the reference list (entry_id, kind, name, aliases). Null kinds and values are
    left out, repeated rows count once. The tokens are repaired once each, then joined back to
    their values.
    """
    words, names = reference_names(entries)
    parts = values.sparkSession.sparkContext.defaultParallelism
    values = values.where("kind is not null and value is not null").distinct()
    split = values.select("kind", "value", F.explode(F.array_distinct(_words(F.col("value")))).alias("token"))

    def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [repair(k, t, n, [(c["word"], c["joined"], c["n"]) for c in cs]) for k, t, n, cs in zip(*(b.column(c).to_pylist() for c in ("kind", "token", "times", "candidates")))]
            made = pa.array([[{"word": w, "sim": s} for w, s in r] for r in rows], pa.list_(pa.struct([("word", pa.string()), ("sim", pa.float64())])))
            yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("token"), made], ["kind", "token", "words"])

    # the number of parts stands, as the work is more than the bytes tell
    near = near_words(split.groupBy("kind", "token").agg(F.count("*").alias("times")), words).repartition(parts, "kind", "token")
    repaired = cut(near.mapInArrow(repairs, _REPAIRED).where(F.size("words") > 0))
    held = split.join(repaired, ["kind", "token"])
    tokens = held.groupBy("kind", "value").agg(F.collect_list(F.struct("token", "words")).alias("tokens"))
    keyed = names.select("kind", F.explode("keys").alias("word"), F.struct("entry_id", "words", "idfs", "rare").alias("name"))
    reach = held.select("kind", "value", F.explode("words.word").alias("word")).distinct().join(keyed, ["kind", "word"]).groupBy("kind", "value").agg(F.collect_set("name").alias("names"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for kind, value, tokens, names in zip(*(b.column(c).to_pylist() for c in ("kind", "value", "tokens", "names"))):
                out.append(stand_for(kind, value, {t["token"]: [(w["word"], w["sim"]) for w in t["words"]] for t in tokens}, [(n["entry_id"], n["words"], n["idfs"], n["rare"]) for n in names]))
            yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("value"), pa.array(out, pa.list_(pa.int64()))], ["kind", "value", "entry_ids"])

    ranked = tokens.join(reach, ["kind", "value"]).repartition(parts, "kind", "value").mapInArrow(rank, "kind string, value string, entry_ids array<long>")
    return values.join(ranked, ["kind", "value"], "left").withColumn("entry_ids", F.coalesce("entry_ids", F.array(F.lit(0).cast("bigint"))))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """job_id, field_name, entry_id of every real value of the three fields."""
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    rows = table(spark, folder, "final_corrected_requirements").select("job_id", *KINDS).where("job_id is not null")
    rows = rows.select("job_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.lit(k).alias("kind"), F.col(f).alias("value")) for f, k in KINDS.items()])).alias("x")).select("job_id", "x.*")
    rows = rows.where(is_real(F.col("value"), placeholders))
    entries = table(spark, folder, "reference_entries").select("entry_id", F.col("entry_kind").alias("kind"), F.col("canonical_name").alias("name"), "aliases")
    mapped = map_values(rows.select("kind", "value"), entries)
    out = rows.join(mapped, ["kind", "value"]).select("job_id", "field_name", F.explode("entry_ids").alias("entry_id"))
    return out.distinct()
