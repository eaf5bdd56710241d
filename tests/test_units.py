"""Amounts of pay in common units."""

import pytest

from lodestream.operators.units import scan, to_common_unit

FACTORS = [("currency", "INR", 1), ("currency", "USD", 84), ("currency", "EUR", 92), ("currency", "GBP", 107), ("currency", "SGD", 63), ("period", "year", 1), ("period", "month", 12), ("period", "day", 240), ("period", "hour", 1920), ("scale", "thousand", 1000), ("scale", "lakh", 100000), ("scale", "crore", 10000000)]

CASES = [
    # text, default period, currency field, min, max
    ("27.5 LPA all inclusive", "year", "INR", 2_750_000, 2_750_000),
    ("Rs. 34 L – 38 L per annum", "year", None, 3_400_000, 3_800_000),
    ("between 16.5 and 18L p.a INR (2 positions)", "year", None, 1_650_000, 1_800_000),
    ("0.5 to 0.525cr fixed", "year", "INR", 5_000_000, 5_250_000),
    ("€ 124.000 p.a.", "year", "INR", 124_000 * 92, 124_000 * 92),
    ("71.000 - 73.000 pa", "year", "EUR", 71_000 * 92, 73_000 * 92),
    ("between usd 51 and 56k", "year", "INR", 51_000 * 84, 56_000 * 84),
    ("S$ 700/day (incl. 10% variable)", "month", "SGD", 700 * 63 * 240, 700 * 63 * 240),
    ("19.5", "year", "", 1_950_000, 1_950_000),
    ("1.65 to 1.75", "month", "Rupees", 1_980_000, 2_100_000),
    ("19.5", "year", "USD", 1638, 1638),
    ("Upto 2400 INR/hr", "month", None, 2400 * 1920, 2400 * 1920),
    ("₹600", "year", None, 600, 600),
    ("nine – ten lakhs p.a.", "year", None, 900_000, 1_000_000),
    ("80,000 to 1.2 lakh", "month", None, 960_000, 1_440_000),
    ("Based on experience 6-8 yrs", "year", "INR", None, None),
    ("20% hike on current", "year", "INR", None, None),
    ("Level 3 band", "year", "INR", None, None),
    ("Refer rate card 2026", "year", "INR", None, None),
    ("TBD", "year", "INR", None, None),
    ("", "year", None, None, None),
    (None, "year", None, None, None),
    ("x" * 100_000, "year", None, None, None),
]


def test_cases(spark):
    factors = spark.createDataFrame(FACTORS, "unit_kind string, unit_code string, factor long")
    for period in ("year", "month"):
        rows = [(k, t, c) for k, (t, p, c, _, _) in enumerate(CASES) if p == period]
        df = spark.createDataFrame(rows, "k long, t string, c string")
        got = {r["k"]: (r["inr_min"], r["inr_max"]) for r in to_common_unit(df, "t", period, "c", factors).collect()}
        for k, _, _ in rows:
            assert got[k] == CASES[k][3:], CASES[k]


def test_repeated_rows_and_unknown_units(spark):
    factors = spark.createDataFrame([f for f in FACTORS if f[1] != "USD"], "unit_kind string, unit_code string, factor long")
    df = spark.createDataFrame([("$5000",), ("$5000",), ("5 lpa",)], "t string")
    rows = to_common_unit(df, "t", "year", None, factors).collect()
    assert len(rows) == 3 and sorted(str(r["inr_min"]) for r in rows) == ["500000", "None", "None"]


@pytest.mark.parametrize("text, alias", [("US$ 5k", "USD"), ("S$5k", "SGD"), ("5k Singapore dollars", "SGD"), ("5k dollars", "USD")])
def test_longest_alias(text, alias):
    assert scan(text)[2] == alias
