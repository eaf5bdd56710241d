"""What counts as a value: placeholders, blank text, normal forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Placeholder texts, trimmed and lower-cased (fixed values, as in placeholder_values).
PLACEHOLDERS = (
    "", "n/a", "na", "nil", "none", "null", "-", "--", "tbd", "unknown", "not provided",
    "not specified", "not mentioned", "to be confirmed", "to be shared", "as discussed", "awaited",
)

#: Characters that count as white space, in a regex class.
BLANK = r"[\s ​﻿]"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def single_spaced(c: Column) -> Column:
    """Trimmed, lower-cased, with single spaces inside."""
    return F.lower(trimmed(F.regexp_replace(c, f"{BLANK}+", " ")))


def is_real(c: Column, placeholders: tuple[str, ...] = PLACEHOLDERS) -> Column:
    """True where c is not null and no placeholder; never null."""
    return c.isNotNull() & ~F.coalesce(F.lower(trimmed(c)).isin(*placeholders), F.lit(True))


def real_or_null(c: Column, placeholders: tuple[str, ...] = PLACEHOLDERS) -> Column:
    return F.when(is_real(c, placeholders), c)


def letters_digits(c: Column) -> Column:
    """Only letters and digits, lower-cased."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{Nd}]", ""))


def placeholder_list(df: DataFrame, most: int = 10_000) -> tuple[str, ...]:
    """The entries of a placeholder table; one beyond ``most`` rows is refused."""
    rows = [r[0] for r in df.select("placeholder").where("placeholder is not null").limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"placeholder table of more than {most} rows")
    return tuple(sorted({*rows, ""}))


def present(df: DataFrame, name: str) -> DataFrame:
    """df without the rows where ``name`` is null.

    A plain filter would be pushed below the projection that computes ``name``, with all
    of its expression copied into it, and again for each step under that one. Generating
    nought or one value from it costs no copy.
    """
    return df.withColumn(name, F.explode(F.array_compact(F.array(name))))
