"""Text normal forms as column expressions (N, H20, H31)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space that all engines agree on.
SPACE = r"[ \t\n\r\f]"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9][0-9 ()-]{7,14}[0-9]"
#: Subject prefixes of answers and forwards.
PREFIX = r"(?i)^[ \t]*((re|fw|fwd|aw|wg|tr|recall)[ \t]*:[ \t]*)+"
INVISIBLE = "​‌‍⁠﻿­"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def collapsed(c: Column) -> Column:
    """Single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def normal_form(c: Column) -> Column:
    return collapsed(ascii_lower(c))


def fingerprint(c: Column, length: int = 16) -> Column:
    """The first hex digits of the SHA-256 of the normal form."""
    return F.substring(F.sha2(normal_form(c), 256), 1, length)


def scrubbed(c: Column) -> Column:
    """Mail addresses and phone numbers replaced by marks."""
    return F.regexp_replace(F.regexp_replace(c, EMAIL, "[email]"), PHONE, "[phone]")


def subject_core(c: Column) -> Column:
    return normal_form(F.regexp_replace(c, PREFIX, ""))


def visible(c: Column) -> Column:
    return F.translate(c, INVISIBLE, "")


def unquoted_head(c: Column) -> Column:
    """The text before the first line that begins quoted history."""
    return F.regexp_replace(c, r"(?s)(^|\n)[>| ]*(From:|Von:|-----|_{10,}|Begin forwarded message).*$", "")


def masked_line(c: Column) -> Column:
    """A line for counting: digits are #, spaces single."""
    return F.regexp_replace(normal_form(c), "[0-9]+", "#")


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def bullets(c: Column, most: int = 40) -> Column:
    """The distinct bullet lines in order, without their marks; a report of the first ``most``."""
    found = F.filter(lines(c), lambda x: x.rlike(r"^[ \t]*[-*•][ \t]+[^ ]"))
    return F.slice(F.array_distinct(F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"^[ \t]*[-*•][ \t]+", "")))), 1, most)


def summary(c: Column, most: int = 600) -> Column:
    """The text from its greeting or 'please find' on, at most so many characters."""
    at = F.regexp_instr(c, F.lit(r"(?i)(please find|please share|dear |hi |hello|greetings)"))
    return F.substring(c, F.when(at > 0, at).otherwise(1), F.lit(most))


def sanitized(details: Column, secret: str = "(?i)mail|phone|token|password|body|subject", most: int = 60) -> Column:
    """A map of details fit for an alert: secret keys redacted, long values cut."""
    kept = F.transform_values(details, lambda k, v: F.when(k.rlike(secret), F.lit("[redacted]")).when(F.length(v) > most, F.concat(F.substring(v, 1, most), F.lit("..."))).otherwise(v))
    return kept
