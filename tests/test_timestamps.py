"""Times in many notations, against zoneinfo."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from lodestream.operators.timestamps import estimate_zones, to_utc


def ms(*at, zone="UTC"):
    return round(datetime(*at, tzinfo=ZoneInfo(zone)).timestamp() * 1000)


CASES = [
    ("2025-09-16T13:28:23Z", "Asia/Kolkata", ms(2025, 9, 16, 13, 28, 23)),
    ("2025-09-16T13:28:23.1239999Z", None, ms(2025, 9, 16, 13, 28, 23) + 123),
    ("2025-09-17T03:59:28+05:30", "America/New_York", ms(2025, 9, 16, 22, 29, 28)),
    ("2025-10-22T05:14:27+05:30[Asia/Kolkata]", None, ms(2025, 10, 21, 23, 44, 27)),
    ("2025-11-20 06:01:13.416-0500", None, ms(2025, 11, 20, 11, 1, 13) + 416),
    ("2025-09-15 18:37:41", "Asia/Kolkata", ms(2025, 9, 15, 18, 37, 41, zone="Asia/Kolkata")),
    ("2025-09-15", "Asia/Kolkata", ms(2025, 9, 15, zone="Asia/Kolkata")),
    ("20251018T125216Z", "Asia/Kolkata", ms(2025, 10, 18, 12, 52, 16)),
    ("03/10/2025 07:50 AM", "Europe/London", ms(2025, 10, 3, 7, 50, zone="Europe/London")),
    ("9/29/2025 11:29:19", "America/New_York", ms(2025, 9, 29, 11, 29, 19, zone="America/New_York")),
    ("12/01/2026 12:05 AM", "Asia/Kolkata", ms(2026, 1, 12, 0, 5, zone="Asia/Kolkata")),
    ("Thu, 18 Sep 2025 08:58:42 +0530", "Asia/Kolkata", ms(2025, 9, 18, 3, 28, 42)),
    ("07-Oct-2025 18:41:10 IST", "Asia/Kolkata", ms(2025, 10, 7, 13, 11, 10)),
    ("08-Jan-2026 13:36:15 EST", "America/New_York", ms(2026, 1, 8, 18, 36, 15)),
    ("March 13, 2026 7:23 PM", "Asia/Kolkata", ms(2026, 3, 13, 19, 23, zone="Asia/Kolkata")),
    ("21st November 2025", "Asia/Kolkata", ms(2025, 11, 21, zone="Asia/Kolkata")),
    ("1 Jan 2026", "Asia/Kolkata", ms(2026, 1, 1, zone="Asia/Kolkata")),
    ("1757981766", "Asia/Kolkata", 1_757_981_766_000),
    ("1758975899981", None, 1_758_975_899_981),
    ("1758975899981123", None, 1_758_975_899_981),
    ("133444736000000000", None, 133444736000000000 // 10_000 - 11_644_473_600_000),
    ("45917.75", "Asia/Kolkata", ms(2025, 9, 17, 18, zone="Asia/Kolkata")),
    ("31/11/2025", "Europe/London", None), ("2026-02-30 10:00:00", "Asia/Kolkata", None), ("0000-00-00 00:00:00", "Asia/Kolkata", None),
    ("13/13/2025", "America/New_York", None), ("2025-09-15 25:00:00", "Asia/Kolkata", None), ("yesterday evening", "Asia/Kolkata", None),
    ("TBD", "Asia/Kolkata", None), ("", "Asia/Kolkata", None), (None, "Asia/Kolkata", None), ("2025-09-15 10:00:00", None, None), ("2025-09-15 10:00:00", "No/Zone", None), ("9" * 5000, "UTC", None),
]


def test_cases(spark):
    df = spark.createDataFrame([(k, t, z) for k, (t, z, _) in enumerate(CASES)], "k long, t string, z string")
    got = {r["k"]: r["utc_ms"] for r in to_utc(df, "t", F.col("z")).collect()}
    for k, (t, z, want) in enumerate(CASES):
        assert got[k] == want, (t, z, got[k], want)


def test_session_zone_does_not_matter(spark):
    df = spark.createDataFrame([("2025-03-30 02:30:00", "Asia/Kolkata"), ("2025-07-01", "Europe/Berlin")], "t string, z string")
    before = spark.conf.get("spark.sql.session.timeZone")
    want = to_utc(df, "t", F.col("z")).collect()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert to_utc(df, "t", F.col("z")).collect() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clock_set_back(spark):
    """01:30 occurs twice in New York on 2025-11-02; the time of sight tells which."""
    early, late = ms(2025, 11, 2, 5, 30), ms(2025, 11, 2, 6, 30)
    df = spark.createDataFrame([("2025-11-02 01:30:00", s) for s in (early + 60_000, late + 60_000, late + 10**9, None)], "t string, s long")
    rows = to_utc(df, "t", F.lit("America/New_York"), seen_ms=F.col("s")).collect()
    assert [r["utc_ms"] for r in sorted(rows, key=lambda r: (r["s"] is None, r["s"]))] == [early, late, early, early]


def test_missing_zones_are_estimated(spark):
    rows = []
    for feed, zone in (("a", "Asia/Kolkata"), ("b", "America/New_York"), ("c", "Europe/Berlin")):
        for k in range(40):  # over both ends of summer time
            at = datetime(2025, 9, 1, 3, 7, tzinfo=timezone.utc) + timedelta(days=6 * k)
            rows.append((feed, at.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S"), round(at.timestamp() * 1000) + 60_000 * (k % 9), round(at.timestamp() * 1000)))
    df = spark.createDataFrame(rows, "feed string, t string, seen long, truth long")
    zones = {r["feed"]: r["zone"] for r in estimate_zones(df, "feed", "t", F.col("seen")).collect() if r["feed"]}
    assert zones == {"a": "Asia/Kolkata", "b": "America/New_York", "c": "Europe/Berlin"}
    out = to_utc(df, "t", F.lit(None).cast("string"), seen_ms=F.col("seen"), feed="feed").collect()
    assert len(out) == len(rows) and all(r["utc_ms"] == r["truth"] for r in out)


def test_small_feeds_and_feeds_without_evidence(spark):
    """A feed of one time is decided by it, one without usable times gets the zone of all, nothing is dropped."""
    at = datetime(2025, 9, 1, 12, 0, tzinfo=timezone.utc)
    seen = round(at.timestamp() * 1000) + 60_000
    local = at.astimezone(ZoneInfo("Asia/Kolkata")).strftime("%Y-%m-%d %H:%M:%S")
    rows = [("a", local, seen), ("b", "2025-09-01 12:00:00", seen), ("c", local, None), (None, local, seen), ("a", local, seen)]
    df = spark.createDataFrame(rows, "feed string, t string, seen long")
    got = sorted((r["feed"] or "", r["utc_ms"]) for r in to_utc(df, "t", F.lit(None).cast("string"), seen_ms=F.col("seen"), feed="feed").collect())
    truth = round(at.timestamp() * 1000)
    assert got == [("", truth), ("a", truth), ("a", truth), ("b", truth), ("c", truth)]
    none = to_utc(df.where("feed = 'c'"), "t", F.lit(None).cast("string"), seen_ms=F.col("seen"), feed="feed", fallback="UTC").collect()
    assert [r["utc_ms"] for r in none] == [truth + 19_800_000]


def test_withheld_zones_are_found(spark, sf):
    """The estimate against the stated zones of all mailboxes: the share of times in mailboxes that it finds."""
    from lodestream.operators.timestamps import p6_zones

    rows = p6_zones(spark, sf).collect()
    assert sum(r["n"] for r in rows if r["zone"] == r["stated_zone"]) >= 0.9 * sum(r["n"] for r in rows)
