"""Expressions that know both their Spark and their SQL form, so that a field rule is written once.

An expression is built before there is a session, so its column is made when the query runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.plans.base import query
from lodestream.sources.tables import table


@dataclass(frozen=True)
class E:
    """A value: ``c()`` is its column, ``s`` its SQL."""

    c: Callable[[], Column]
    s: str

    def _op(self, other: object, sign: str, f: Callable[[Column, Column], Column]) -> E:
        o = of(other)
        return E(lambda: f(self.c(), o.c()), f"({self.s} {sign} {o.s})")

    def __add__(self, o): return self._op(o, "+", lambda a, b: a + b)  # noqa: E704
    def __sub__(self, o): return self._op(o, "-", lambda a, b: a - b)  # noqa: E704
    def __gt__(self, o): return self._op(o, ">", lambda a, b: a > b)  # noqa: E704
    def __ge__(self, o): return self._op(o, ">=", lambda a, b: a >= b)  # noqa: E704
    def __lt__(self, o): return self._op(o, "<", lambda a, b: a < b)  # noqa: E704
    def __le__(self, o): return self._op(o, "<=", lambda a, b: a <= b)  # noqa: E704
    def __and__(self, o): return self._op(o, "AND", lambda a, b: a & b)  # noqa: E704
    def __or__(self, o): return self._op(o, "OR", lambda a, b: a | b)  # noqa: E704
    def __invert__(self): return E(lambda: ~self.c(), f"(NOT {self.s})")  # noqa: E704
    def is_(self, o): return self._op(o, "=", lambda a, b: a == b)  # noqa: E704
    def null(self): return E(lambda: self.c().isNull(), f"({self.s} IS NULL)")  # noqa: E704
    def there(self): return E(lambda: self.c().isNotNull(), f"({self.s} IS NOT NULL)")  # noqa: E704


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def of(x: object) -> E:
    """A constant as an expression; expressions stay."""
    if isinstance(x, E):
        return x
    if x is None:
        return E(lambda: F.lit(None), "NULL")
    return E(lambda: F.lit(x), quoted(x) if isinstance(x, str) else str(x))


def col(name: str) -> E:
    return E(lambda: F.col(name), f'"{name}"')


def matches(e: E, pattern: str) -> E:
    """Whether the text matches; false for null."""
    return E(lambda: F.coalesce(e.c().rlike(pattern), F.lit(False)), f"coalesce(regexp_matches({e.s}, {quoted(pattern)}), false)")


def group(e: E, pattern: str, k: int = 1) -> E:
    """A group of the first match, null where there is none."""
    return E(lambda: F.nullif(F.regexp_extract(e.c(), pattern, k), F.lit("")), f"nullif(regexp_extract({e.s}, {quoted(pattern)}, {k}), '')")


def number(e: E) -> E:
    return E(lambda: e.c().try_cast("double"), f"try_cast({e.s} AS DOUBLE)")


def whole(e: E) -> E:
    return E(lambda: e.c().cast("bigint"), f"({e.s})::BIGINT")


def first(*es: object) -> E:
    xs = [of(e) for e in es]
    return E(lambda: F.coalesce(*[x.c() for x in xs]), "coalesce(" + ", ".join(x.s for x in xs) + ")")


def case(*rungs: tuple[E, object], default: object = None) -> E:
    """The value of the first condition that holds."""
    pairs, other = [(c, of(v)) for c, v in rungs], of(default)

    def column() -> Column:
        out = F.when(pairs[0][0].c(), pairs[0][1].c())
        for c, v in pairs[1:]:
            out = out.when(c.c(), v.c())
        return out.otherwise(other.c())

    return E(column, "CASE " + " ".join(f"WHEN {c.s} THEN {v.s}" for c, v in pairs) + f" ELSE {other.s} END")


def ladder(e: E, rungs: list[tuple[str, str]], default: object = None) -> E:
    """The value of the first pattern that matches."""
    return case(*[(matches(e, p), v) for p, v in rungs], default=default)


def hits(e: E, patterns: list[str]) -> E:
    """How many of the patterns match."""
    ms = [matches(e, p) for p in patterns]

    def column() -> Column:
        out = F.lit(0)
        for m in ms:
            out = out + m.c().cast("int")
        return out.cast("bigint")

    return E(column, "(" + " + ".join(f"{m.s}::INT" for m in ms) + ")::BIGINT")


def only_one(e: E, rungs: list[tuple[str, str]]) -> E:
    """The value of the one pattern that matches, null if several do."""
    return case((hits(e, [p for p, _ in rungs]).is_(1), ladder(e, rungs)))


def every(e: E, pattern: str, k: int = 0) -> E:
    """The group of all matches, as a list."""
    return E(lambda: F.regexp_extract_all(e.c(), F.lit(pattern), F.lit(k)), f"regexp_extract_all({e.s}, {quoted(pattern)}, {k})")


def distinct(e: E) -> E:
    """A list's values once each, in the order of their first place."""
    return E(lambda: F.array_distinct(e.c()), f"list_filter({e.s}, lambda x, i: list_position({e.s}, x) = i)")


def size(e: E) -> E:
    return E(lambda: F.size(e.c()).cast("bigint"), f"len({e.s})::BIGINT")


def at_most(e: E, n: int) -> E:
    return E(lambda: F.slice(e.c(), 1, n), f"list_slice({e.s}, 1, {n})")


def joined(e: E, mark: str = ", ") -> E:
    return E(lambda: F.array_join(e.c(), mark), f"array_to_string({e.s}, {quoted(mark)})")


def numbers(e: E) -> E:
    """A list of texts as numbers, what is none left out."""
    return E(lambda: F.filter(F.transform(e.c(), lambda x: x.try_cast("double")), lambda x: x.isNotNull()), f"list_filter(list_transform({e.s}, lambda x: try_cast(x AS DOUBLE)), lambda x: x IS NOT NULL)")


def greatest_in(e: E) -> E:
    return E(lambda: F.array_max(e.c()), f"list_aggregate({e.s}, 'max')")


def least_in(e: E) -> E:
    return E(lambda: F.array_min(e.c()), f"list_aggregate({e.s}, 'min')")


def without(e: E, other: E) -> E:
    """A list's values that another list doesn't hold."""
    return E(lambda: F.filter(e.c(), lambda x: ~F.array_contains(other.c(), x)), f"list_filter({e.s}, lambda x: NOT list_contains({other.s}, x))")


def that(e: E, pattern: str, holds: bool = True) -> E:
    """A list's texts that match (or don't)."""
    return E(lambda: F.filter(e.c(), lambda x: x.rlike(pattern) == F.lit(holds)), f"list_filter({e.s}, lambda x: regexp_matches(x, {quoted(pattern)}) = {str(holds).lower()})")


def parts(e: E, pattern: str) -> E:
    """A text split at a pattern, as trimmed lower-case texts with single spaces, empty ones left out."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    form = lambda x: F.trim(F.regexp_replace(F.translate(x, upper, lower), "[ \t\n\r\f]+", " "))
    sql = f"trim(regexp_replace(translate(x, '{upper}', '{lower}'), '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"
    return E(lambda: F.filter(F.transform(F.split(e.c(), pattern, -1), form), lambda x: x != ""), f"list_filter(list_transform(regexp_split_to_array({e.s}, {quoted(pattern)}), lambda x: {sql}), lambda x: x <> '')")


def lower(e: E) -> E:
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return E(lambda: F.translate(e.c(), upper, low), f"translate({e.s}, '{upper}', '{low}')")


def replaced(e: E, pattern: str, by: str = "") -> E:
    return E(lambda: F.regexp_replace(e.c(), pattern, by), f"regexp_replace({e.s}, {quoted(pattern)}, {quoted(by)}, 'g')")


def trimmed(e: E) -> E:
    return E(lambda: F.trim(e.c()), f"trim({e.s}, ' ')")


def empty_is_null(e: E) -> E:
    return E(lambda: F.nullif(e.c(), F.lit("")), f"nullif({e.s}, '')")


def glued(*es: object) -> E:
    """Texts end to end; null if one is."""
    xs = [of(e) for e in es]
    return E(lambda: F.concat(*[x.c() for x in xs]), "(" + " || ".join(x.s for x in xs) + ")")


def text_of_number(e: E) -> E:
    """A whole number as text."""
    return E(lambda: e.c().cast("bigint").cast("string"), f"({e.s})::BIGINT::VARCHAR")


def register(name: str, source: str, doc: str, columns: dict[str, E], where: E | None = None, once: bool = True) -> None:
    """Register the query ``name``: columns of a whole table; ``once``: each row once."""
    sql = f"SELECT {'DISTINCT ' if once else ''}" + ", ".join(f'{e.s} AS "{n}"' for n, e in columns.items()) + f" FROM {source}" + (f" WHERE {where.s}" if where else "")

    def run(spark, folder):
        df = table(spark, folder, source)
        df = df.where(where.c()) if where else df
        df = df.select(*[e.c().alias(n) for n, e in columns.items()])
        return df.distinct() if once else df

    run.__doc__, run.__name__ = doc, name
    query(name, sql)(run)
