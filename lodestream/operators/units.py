"""Quantities in different units (problem 1; X5, X5b, X5c, C34, H41): amounts of pay as INR a year.

A multi-pattern automaton finds every unit alias of a text at once; of overlapping hits
the longest stands. Aliases next to a number give it a scale or mark it as no money
(years, percent, positions); currency and period come from anywhere in the text, else
from the field. What the numbers mean is thereby codes and decimals only; the factors are
joined from the units table, so another unit needs another row there and an alias here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.functions.values import PLACEHOLDERS
from lodestream.sources.tables import table

#: Unit aliases by kind and code (fixed values).
ALIASES = {
    ("currency", "INR"): ("₹", "rs", "rs.", "re.", "inr", "rupee", "rupees"),
    ("currency", "USD"): ("$", "us$", "usd", "us dollar", "us dollars", "dollar", "dollars"),
    ("currency", "EUR"): ("€", "eur", "euro", "euros"),
    ("currency", "GBP"): ("£", "gbp", "pound", "pounds", "pound sterling", "pounds sterling"),
    ("currency", "SGD"): ("s$", "sg$", "sgd", "singapore dollar", "singapore dollars"),
    ("scale", "thousand"): ("k", "thousand", "thousands"),
    ("scale", "lakh"): ("l", "lac", "lacs", "lakh", "lakhs"),
    ("scale", "crore"): ("cr", "cr.", "crs", "crore", "crores"),
    ("both", "lakh year"): ("lpa", "l.p.a", "l.p.a.", "l p a"),
    ("both", "lakh month"): ("lpm", "l.p.m", "l.p.m."),
    ("period", "year"): ("year", "yr", "yearly", "annum", "annual", "annually", "pa", "p.a", "p.a.", "p/a"),
    ("period", "month"): ("month", "mth", "mo", "monthly", "pm", "p.m", "p.m.", "p/m"),
    ("period", "day"): ("day", "daily", "daily rate", "per diem", "pd", "p.d", "p.d.", "p/d"),
    ("period", "hour"): ("hour", "hr", "hourly", "ph", "p.h", "p.h.", "p/h"),
    ("count", "after"): ("%", "percent", "yrs", "years", "+ yrs", "+ years", "+yrs", "+years", "positions", "position", "openings", "opening", "seats", "heads", "resources", "days", "weeks", "months", "hrs", "hours"),
    ("count", "before"): ("level", "band", "grade", "tier", "card", "fy", "q", "last", "ref", "no."),
}

#: Numbers in words (fixed values).
WORDS = {w: str(n) for n, w in enumerate(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split(), 1
)} | {"thirty": "30", "forty": "40", "fifty": "50", "sixty": "60"}

_NUMBER = re.compile(r"\d+(?:[.,]\d+)*|(?<![a-z])(?:" + "|".join(sorted(WORDS, key=len, reverse=True)) + r")(?![a-z])")
_ANY = re.compile(r"\d|" + "|".join(WORDS), re.I)
_LINK = re.compile(r"\s*(?:-|–|—|to|and|till|upto)\s*$")
_GROUPED = re.compile(r"^\d{1,3}(?:\.\d{3})+$")

_NAMES = ("lo", "hi", "currency", "period", "lo_scale", "hi_scale")
AMOUNT = T.StructType([*(T.StructField(n, T.StringType()) for n in _NAMES), T.StructField("bare", T.BooleanType())])


@cache
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for unit, names in ALIASES.items():
        for name in names:
            a.add_word(name, (name, *unit))
    a.make_automaton()
    return a


def _hits(t: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, code) of the aliases in t; of overlapping ones the longest, then the first."""
    found = []
    for last, (name, kind, code) in _automaton().iter(t):
        start = last + 1 - len(name)
        # letters must not run on into other letters; digits may touch
        if name[0].isalpha() and start and t[start - 1].isalpha() or name[-1].isalpha() and last + 1 < len(t) and t[last + 1].isalpha():
            continue
        found.append((start, last + 1, kind, code))
    taken: list[tuple[int, int, str, str]] = []
    for h in sorted(found, key=lambda h: (h[0] - h[1], h[0])):
        if all(h[1] <= x[0] or h[0] >= x[1] for x in taken):
            taken.append(h)
    return sorted(taken)


def scan(text: str | None) -> tuple | None:
    """The amount that a text states as (lo, hi, currency, period, lo_scale, hi_scale, bare),
    with null for what it doesn't say, or None where it states none. ``bare``: no unit
    stands in the text. lo and hi are as written, without grouping commas."""
    if not text or not _ANY.search(text):
        return None
    t = re.sub(r"\s+", " ", text.lower()).strip()
    if t in PLACEHOLDERS:
        return None
    hits = _hits(t)
    spans = [(m.start(), m.end(), WORDS.get(m.group(), m.group())) for m in _NUMBER.finditer(t)]
    linked = {i for i in range(1, len(spans)) if _between(t, spans, hits, i)}
    after = {i: h for i, s in enumerate(spans) for h in hits if 0 <= h[0] - s[1] <= 2 and not t[s[1] : h[0]].strip(" +")}
    before = {i: h for i, s in enumerate(spans) for h in hits if 0 <= s[0] - h[1] <= 2 and not t[h[1] : s[0]].strip(" :#.")}
    out = {i for i in range(len(spans)) if i in after and after[i][2:] == ("count", "after") or i in before and before[i][2:] == ("count", "before")}
    for i in sorted(linked, reverse=True):  # a range counts what its end counts
        if i in out:
            out.add(i - 1)
    money = [i for i in range(len(spans)) if i not in out]
    if not money:
        return None
    first = money[0]
    pair = [first, first + 1] if first + 1 in linked and first + 1 in money else [first]
    units = [h for h in hits if h[2] != "count"]
    currency = next((h[3] for h in units if h[2] == "currency"), None)
    period = next((h[3].split()[-1] for h in units if h[2] in ("period", "both")), None)
    scales = [after[i][3].split()[0] if i in after and after[i][2] in ("scale", "both") else None for i in pair]
    values = [_decimal(spans[i][2], currency, s) for i, s in zip(pair, scales)]
    if len(pair) == 2 and scales[0] is None and scales[1] and float(values[0]) <= float(values[1]):
        scales[0] = scales[1]  # "16.5 and 18L": the end's scale holds for both
    bare = not units
    return values[0], values[-1], currency, period, scales[0], scales[-1], bare


def _between(t: str, spans: list, hits: list, i: int) -> bool:
    """Whether number i ends a range that number i - 1 begins."""
    gap = t[spans[i - 1][1] : spans[i][0]]
    for h in hits:  # units may stand between: "44 lpa-47 lpa", "rs 5 to rs 6"
        if spans[i - 1][1] <= h[0] and h[1] <= spans[i][0] and h[2] != "count":
            a, b = h[0] - spans[i - 1][1], h[1] - spans[i - 1][1]
            gap = gap[:a] + " " * (b - a) + gap[b:]
    return bool(_LINK.match(" ".join(gap.replace("/-", "").split()) or "x"))


def _decimal(number: str, currency: str | None, scale: str | None) -> str:
    if _GROUPED.match(number) and not scale and currency == "EUR" or number.count(".") > 1:
        return number.replace(".", "")
    return number.replace(",", "")


@F.pandas_udf(AMOUNT)
def _scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        known: dict[str, tuple | None] = {}
        yield pd.DataFrame([known[x] if x in known else known.setdefault(x, scan(x)) or (None,) * 7 for x in batch], columns=AMOUNT.names).astype(object)


def to_common_unit(df: DataFrame, text: str, default_period: str, currency: str | None, factors: DataFrame, out: str = "inr") -> DataFrame:
    """df with ``<out>_min`` and ``<out>_max``: bigint INR a year that ``text`` states.

    Null where the text is null, blank, a placeholder, states no amount of money, or names
    a unit without factor. ``currency`` names a column that is used where the text has no
    currency; without one there it is INR. ``factors`` has (unit_kind, unit_code, factor);
    it is small, and Spark broadcasts it by its own size check. Repeated rows stay.
    """
    scanned = df.withColumn("__amount", _scan(F.col(text)))
    a = F.col("__amount")
    field = _scan_currency(F.col(currency)) if currency else F.lit(None).cast("string")
    scanned = scanned.withColumn("__cur", F.coalesce(a["currency"], field, F.lit("INR")))
    # an INR figure under 1,000 with nothing beside it is in lakh
    small = lambda x: F.col("__cur").eqNullSafe("INR") & a["bare"] & (x.try_cast("decimal(20,6)") < 1000)
    # a point before three digits groups them in euro figures without a scale
    figure = lambda x, s: F.when((F.col("__cur") == "EUR") & s.isNull() & x.rlike(r"^[1-9]\d{0,2}\.\d{3}$"), F.regexp_replace(x, r"\.", "")).otherwise(x).try_cast("decimal(20,6)")
    scanned = (
        scanned.withColumn("__lo", figure(a["lo"], a["lo_scale"])).withColumn("__hi", figure(a["hi"], a["hi_scale"]))
        .withColumn("__ls", F.coalesce(a["lo_scale"], F.when(small(a["lo"]), "lakh"))).withColumn("__hs", F.coalesce(a["hi_scale"], F.when(small(a["hi"]), "lakh")))
        .withColumn("__per", F.coalesce(a["period"], F.lit(default_period)))
    )
    for key, kind in (("__cur", "currency"), ("__per", "period"), ("__ls", "scale"), ("__hs", "scale")):
        f = factors.where(F.col("unit_kind") == kind).groupBy(F.col("unit_code").alias(f"{key}_c")).agg(F.max("factor").alias(f"{key}_f"))
        scanned = scanned.join(f, F.col(key) == F.col(f"{key}_c"), "left")
    year = F.col("__cur_f") * F.col("__per_f")
    amount = lambda v, s: F.round(F.col(v) * F.when(F.col(s).isNull(), 1).otherwise(F.col(f"{s}_f")).cast("decimal(12,0)") * year.cast("decimal(12,0)")).cast("bigint")
    lo, hi = amount("__lo", "__ls"), amount("__hi", "__hs")
    scanned = scanned.withColumn(f"{out}_min", F.least(lo, hi)).withColumn(f"{out}_max", F.greatest(lo, hi))
    return scanned.select(*df.columns, f"{out}_min", f"{out}_max")


def _scan_currency(c):
    """The currency code of a currency field: an alias as a whole, else null."""
    pairs = [F.lit(x) for (kind, code), names in ALIASES.items() if kind == "currency" for n in names for x in (n, code)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(c)))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """job_id, inr_per_year_min, inr_per_year_max; the yearly field counts before the monthly."""
    rows = table(spark, folder, "final_corrected_requirements").select("job_id", "yearly_budget", "monthly_budget", "budget_currency").where("job_id is not null")
    factors = table(spark, folder, "budget_units")
    rows = to_common_unit(rows, "yearly_budget", "year", "budget_currency", factors, "year")
    rows = to_common_unit(rows, "monthly_budget", "month", "budget_currency", factors, "month")
    pick = lambda x: F.when(F.col("year_min").isNotNull(), F.col(f"year_{x}")).otherwise(F.col(f"month_{x}")).alias(f"inr_per_year_{x}")
    return rows.select("job_id", pick("min"), pick("max")).where("inr_per_year_min is not null").distinct()
