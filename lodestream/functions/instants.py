"""Times in many notations and zones as one instant in UTC milliseconds.

All of it is built-in expressions, so it runs inside the JVM. Each notation is one
pattern that rewrites the text to the same nine fields; the fields become a local
time, the local time an instant. Nothing depends on the session's time zone.
"""

from __future__ import annotations

from functools import cache
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MONTH = r"(?i:(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?\.?)"
_ZONE = r"(Z|[+-]\d{2}:?\d{2}|[A-Za-z]{2,5})?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
#: Fields: year|month|day|hour|minute|second|fraction|half of day|zone|region
NOTATIONS = (
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:[T ]+{_CLOCK} ?{_ZONE}(?:\[([A-Za-z_/+-]+)\])?)?$", "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    (r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})?(Z|[+-]\d{2}:?\d{2})?)?$", "$1|$2|$3|$4|$5|$6|||$7|"),
    (rf"^(?:[A-Za-z]{{3,9}}, ?)?(\d{{1,2}})(?:st|nd|rd|th)? {_MONTH},? (\d{{4}})(?: {_CLOCK} ?(?i:(AM|PM)?) ?{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|"),
    (rf"^(\d{{1,2}})-{_MONTH}-(\d{{4}})(?: {_CLOCK} ?(?i:(AM|PM)?) ?{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|"),
    (rf"^(?:[A-Za-z]{{3,9}}, )?{_MONTH} (\d{{1,2}})(?:st|nd|rd|th)?, (\d{{4}})(?: {_CLOCK} ?(?i:(AM|PM)?) ?{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|"),
)
_SLASHED = rf"^(\d{{1,2}})[/.](\d{{1,2}})[/.](\d{{4}})(?:,? {_CLOCK} ?(?i:(AM|PM)?) ?{_ZONE})?$"
DAY_FIRST, MONTH_FIRST = "$3|$2|$1|$4|$5|$6|$7|$8|$9|", "$3|$1|$2|$4|$5|$6|$7|$8|$9|"

#: Zones that write slashed dates month first (fixed values).
MONTH_FIRST_ZONES = ("America/New_York",)

#: Minutes east of UTC of the abbreviations of a zone (fixed values).
ABBREVIATIONS = {
    "Asia/Kolkata": {"IST": 330},
    "Asia/Singapore": {"SGT": 480, "SST": 480},
    "Europe/London": {"GMT": 0, "BST": 60},
    "Europe/Berlin": {"CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120},
    "America/New_York": {"EST": -300, "EDT": -240},
}

_MS_DAY = 86_400_000
#: Milliseconds from 1970 back to the origins of bare numbers (fixed values).
_SHEET_ORIGIN, _FILE_ORIGIN, _TICK_ORIGIN = -25_569 * _MS_DAY, -11_644_473_600_000, -62_135_596_800_000


@cache
def known_zones() -> tuple[str, ...]:
    return tuple(sorted(available_timezones() - {"localtime"}))


def _ms(local: Column) -> Column:
    """Milliseconds of a local time as though it were UTC."""
    return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), local)


def local_of(ms: Column) -> Column:
    """The local time that _ms() turns into ms."""
    return F.timestamp_add("MILLISECOND", ms, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def local_to_utc_ms(local_ms: Column, zone: Column, seen_ms: Column | None = None) -> Column:
    """The instant of a local time in a zone.

    A local time that the end of summer time makes occur twice is the earlier instant,
    unless the row was seen (fetched, ingested) after the later one and nearer to it by
    the usual lag: of the two the one that violates "received before seen, soon after"
    least. A local time that never occurs is moved on by the gap.
    """
    first = _ms(F.convert_timezone(zone, F.lit("UTC"), local_of(local_ms)))
    if seen_ms is None:
        return first
    hour = F.lit(3_600_000)
    again = _ms(F.convert_timezone(F.lit("UTC"), zone, local_of(first + hour))) == local_ms
    return F.when(again & (seen_ms >= first + hour) & (seen_ms - first - hour < hour), first + hour).otherwise(first)


def _fields(t: Column, zone: Column) -> Column:
    """The notation's fields as an array of ten texts, or null."""
    tries = [F.when(t.rlike(p), F.regexp_replace(t, p, to)) for p, to in NOTATIONS]
    slashed = F.when(
        t.rlike(_SLASHED),
        F.regexp_replace(t, F.lit(_SLASHED), F.when(zone.isin(*MONTH_FIRST_ZONES), F.lit(MONTH_FIRST)).otherwise(F.lit(DAY_FIRST))),
    )
    return F.split(F.coalesce(*tries, slashed), r"\|", -1)


def _number_ms(t: Column) -> tuple[Column, Column]:
    """Milliseconds that a bare number states, and whether they are local time.

    The count of digits before the point tells the unit and the origin: up to 6 days of a
    sheet (1899-12-30, local), 9 to 11 seconds, 12 to 14 milliseconds, 15 or 16
    microseconds of 1970, 17 or 18 units of 100 ns of 1601 or (from 5e17) of year 1, 19
    nanoseconds of 1970.
    """
    n = F.when(t.rlike(r"^\d{1,19}(\.\d{1,12})?$"), t).try_cast("decimal(34,12)")
    size = F.length(F.regexp_extract(t, r"^(\d+)", 1))
    whole = lambda x: F.floor(x).cast("bigint")
    sheet = F.round(n * _MS_DAY).cast("bigint") + F.lit(_SHEET_ORIGIN)
    ms = (
        F.when(size.between(4, 6), sheet)
        .when(size.between(9, 11), whole(n * 1000))
        .when(size.between(12, 14), whole(n))
        .when(size.between(15, 16), whole(n / 1000))
        .when(size.between(17, 18) & (n < 500_000_000_000_000_000), whole(n / 10_000) + F.lit(_FILE_ORIGIN))
        .when(size.between(17, 18), whole(n / 10_000) + F.lit(_TICK_ORIGIN))
        .when(size == 19, whole(n / 1_000_000))
    )
    return ms, size.between(4, 6)


def with_utc_ms(df: DataFrame, out: str, text: Column, zone: Column, seen_ms: Column | None = None) -> DataFrame:
    """df with a bigint column ``out``: the instant that ``text`` states, in milliseconds
    since 1970 UTC, or null where it is no valid time.

    ``zone`` (an IANA name) is used where the text states no offset; where it is null or
    unknown such a text has no instant. ``seen_ms`` settles local times that occur twice.
    The steps are columns of their own, so none is evaluated twice.
    """
    t, z, f, w, o, s = (f"__{out}_{x}" for x in "tzfwos")
    df = df.withColumn(t, F.regexp_replace(F.trim(text), r"\s+", " ")).withColumn(z, F.when(zone.isin(*known_zones()), zone))
    df = df.withColumn(s, (seen_ms if seen_ms is not None else F.lit(None)).cast("bigint"))
    df = df.withColumn(f, _fields(F.col(t), F.col(z)))
    c = F.col(f)
    number = lambda x: F.nullif(x, F.lit("")).try_cast("int")
    month = F.coalesce(number(c[1]), ((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(c[1], 1, 3))) + 2) / 3).cast("int"))
    hour, half = F.coalesce(number(c[3]), F.lit(0)), F.upper(c[7])
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "PM", 12).otherwise(0))
    zero = F.lit(0)
    second = F.coalesce(number(c[5]), zero)
    local = F.try_make_timestamp_ntz(number(c[0]), month, number(c[2]), hour, F.coalesce(number(c[4]), zero), F.when(second < 60, second))
    written = _ms(local) + F.coalesce(F.rpad(F.nullif(c[6], F.lit("")), 3, "0").try_cast("int"), zero)
    mark, digits = F.upper(c[8]), F.regexp_replace(c[8], "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    numeric = F.when(mark.rlike(r"^[+-]\d{2}:?\d{2}$"), F.when(mark.startswith("-"), -minutes).otherwise(minutes))
    table = F.create_map(*[F.lit(x) for name, of in ABBREVIATIONS.items() for k, v in of.items() for x in (f"{name} {k}", v)])
    offset = F.coalesce(numeric, F.when(mark.isin("Z", "UTC"), 0), F.when(mark != "", F.try_element_at(table, F.concat(F.col(z), F.lit(" "), mark))))
    bare, is_local = _number_ms(F.col(t))
    df = df.withColumn(w, F.when(F.col(f).isNotNull(), written).otherwise(bare))
    df = df.withColumn(o, F.when(F.col(f).isNotNull(), offset).when(~is_local, 0))
    instant = F.when(F.col(o).isNotNull(), F.col(w) - F.col(o).cast("bigint") * 60_000).when(F.col(z).isNotNull(), local_to_utc_ms(F.col(w), F.col(z), F.col(s)))
    return df.withColumn(out, instant).drop(t, z, f, w, o, s)
