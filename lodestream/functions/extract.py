"""Field extraction as column expressions (X, part of C and H).

A pattern is matched once, its groups cast with try_cast, so bad input is null, not a failure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.functions.text import ascii_lower, normal_form

NUMBER = r"([0-9]{1,2}(?:\.[0-9])?)"


def group(c: Column, pattern: str, k: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))


def first_of(c: Column, patterns: list[str]) -> Column:
    """The first group of the first pattern that matches."""
    return F.coalesce(*[group(c, p) for p in patterns])


def label_value(c: Column, labels: list[str]) -> Column:
    """The rest of the first line that begins with one of the labels and a separator; the
    labels are tried in their order."""
    return first_of(c, [rf"(?i)(?:^|\n)[ \t*|>-]*{label}[ \t]*(?:[:=|]|-[ ])[ \t]*([^\n\r|]*[^\n\r| ])" for label in labels])


def labelled_lines(c: Column, labels: list[str]) -> Column:
    """The lines that begin with any of the labels and a separator, from the label to the value's end:
    the text that label_value() has to look at, in one pass over the whole."""
    return F.array_join(F.regexp_extract_all(c, F.lit(rf"(?i)(?:^|\n)[ \t*|>-]*((?:{'|'.join(labels)})[ \t]*(?:[:=|]|-[ ])[ \t]*[^\n\r|]*[^\n\r| ])"), F.lit(1)), "\n")


def number_range(c: Column, single_is_both: bool = False) -> Column:
    """struct(low, high) of the years in a text: '3-5', '3 to 5', '8+', 'min 3', 'max 5', '4'.
    A single figure is low alone, or both if so asked."""
    low, high = (group(c, rf"{NUMBER} *(?:-|–|to) *{NUMBER}", k).try_cast("double") for k in (1, 2))
    least = first_of(c, [rf"{NUMBER} *\+", rf"(?i)(?:min|minimum|at least|above|over)[a-z ]* {NUMBER}"]).try_cast("double")
    most = first_of(c, [rf"(?i)(?:max|maximum|up ?to|below|under)[a-z ]* {NUMBER}"]).try_cast("double")
    one = group(c, NUMBER).try_cast("double")
    a = F.when(low.isNotNull(), low).when(least.isNotNull(), least).when(most.isNull(), one)
    b = F.when(low.isNotNull(), high).when(least.isNotNull(), None).when(most.isNotNull(), most)
    return F.struct(a.alias("low"), (F.when(low.isNull() & least.isNull() & most.isNull(), one).otherwise(b) if single_is_both else b).alias("high"))


def ladder(c: Column, rungs: list[tuple[str, str]]) -> Column:
    """The value of the first pattern that matches; null where none does."""
    return reduce(lambda rest, x: F.when(c.rlike(x[0]), F.lit(x[1])).otherwise(rest), reversed(rungs), F.lit(None).cast("string"))


def only_one(c: Column, options: list[tuple[str, str]]) -> Column:
    """The value of the one pattern that matches; null where none or several do."""
    hits = [c.rlike(p).cast("int") for p, _ in options]
    return F.when(reduce(lambda a, b: a + b, hits) == 1, ladder(c, options))


def hits(c: Column, patterns: list[str]) -> Column:
    """How many of the patterns match; 0 for null."""
    return reduce(lambda a, b: a + b, [F.coalesce(c.rlike(p), F.lit(False)).cast("int") for p in patterns])


WORK_MODES = [(r"(?i)\b(?:hybrid)\b", "Hybrid"), (r"(?i)\b(?:remote|wfh|work from home)\b", "Remote"), (r"(?i)\b(?:on-?site|onsite|wfo|office)\b", "Onsite")]
PRIORITIES = [(r"(?i)\b(?:high|urgent|critical|p1)\b", "HIGH"), (r"(?i)\b(?:medium|normal|p2)\b", "MEDIUM"), (r"(?i)\b(?:low|p3)\b", "LOW")]
EMPLOYMENT = [(r"(?i)contract|c2h|contractual", "Contract"), (r"(?i)full[ -]?time|permanent|fte", "Full-time"), (r"(?i)part[ -]?time", "Part-time"), (r"(?i)intern", "Internship")]
NOTICE = [(r"(?i)serving", "Serving notice"), (r"(?i)^ *immediate *$", "Immediate"), (r"(?i)immediate", "Immediate or later")]


def notice_days(c: Column) -> Column:
    return F.when(c.rlike(r"(?i)^ *immediate *$"), 0).otherwise(group(c, r"([0-9]{1,3}) *(?i:days?)").try_cast("int"))


def level_of_years(years: Column) -> Column:
    return F.when(years < 3, "Junior").when(years < 7, "Mid").when(years.isNotNull(), "Senior")


def tokens(c: Column, split: str = r"[,;/|\n•*]+") -> Column:
    """The distinct tokens of a list in a text, in order, in normal form."""
    return F.array_distinct(F.filter(F.transform(F.split(c, split), normal_form), lambda x: x != ""))


def words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(ascii_lower(c), "[^a-z0-9]+"), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two arrays; null where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union)


def weighted(pairs: list[tuple[float, Column]]) -> Column:
    """Weighted mean over the scores that aren't null; null where none is there."""
    have = reduce(lambda a, b: a + b, [F.when(s.isNotNull(), w).otherwise(0.0) for w, s in pairs])
    total = reduce(lambda a, b: a + b, [F.coalesce(s * w, F.lit(0.0)) for w, s in pairs])
    return F.when(have > 0, total / have)


#: Years that an open end ('8+') reaches beyond its beginning.
OPEN_YEARS = 4


def overlap(low1: Column, high1: Column, low2: Column, high2: Column) -> Column:
    """Jaccard similarity of two ranges of whole years, both ends included; an open end reaches
    OPEN_YEARS on. Null where a beginning is missing."""
    end = lambda low, high: F.greatest(low, F.coalesce(high, low + OPEN_YEARS))
    e1, e2 = end(low1, high1), end(low2, high2)
    common = F.least(e1, e2) - F.greatest(low1, low2) + 1
    whole = F.greatest(e1, e2) - F.least(low1, low2) + 1
    return F.when(low1.isNotNull() & low2.isNotNull(), F.greatest(F.lit(0.0), common / whole))
