"""Blocks, tables and vertical rows on fixtures."""

import pytest

from lodestream.operators.segment import header_field, segment, segmented, vertical_rows, without_tables

TABLE = "Hi,\n| Role | City | Exp |\n|---|---|---|\n| Java Developer | Pune | 3-5 |\n| Tester | Kochi | 2 |\n\nThanks"
PAIRS = "| Role | Java Developer |\n| City | Pune |\n| Budget | open |"
NUMBERED = "Dear team,\n\n1. Java Developer - Pune - 5 yrs\nknows Spring\n2. Tester - Kochi - 2 yrs"
LABELS = "Role: Java Developer\nCity: Pune\n\nRole: Tester\nCity: Kochi"
BULLETS = "Needs:\n- Java Developer, 5 years\n- Tester, 2 years"
DUTIES = "Role: Java Developer\n- write code\n- test code"
HEADINGS = "# Java Developer\ntext\n# Tester\ntext"


@pytest.mark.parametrize("text, strategy, n", [(TABLE, "table", 2), (PAIRS, "table", 1), (NUMBERED, "numbered", 2), (LABELS, "labels", 2), (BULLETS, "bullets", 2), (DUTIES, "single", 1), (HEADINGS, "headings", 2), ("one text", "single", 1), ("", None, 0), ("  \n", None, 0), (None, None, 0)])
def test_strategies(text, strategy, n):
    blocks = segment(text)
    assert len(blocks) == n and {b[0] for b in blocks} <= {strategy}


def test_fields_and_context():
    assert [f for _, _, f in segment(TABLE)] == [{"job_title": "Java Developer", "location": "Pune", "experience": "3-5"}, {"job_title": "Tester", "location": "Kochi", "experience": "2"}]
    assert segment(PAIRS)[0][2] == {"job_title": "Java Developer", "location": "Pune", "yearly_budget": "open"}
    assert segment(NUMBERED)[1][1] == "Dear team,\n2. Tester - Kochi - 2 yrs"
    assert header_field("Work  Location:") == "location" and header_field("Candidate") is None


def test_tables_are_taken_out():
    text = "We need two people.\nName Email Mobile\nA B\nREQ-12345 stays\n\nPlease reply soon.\nend"
    assert without_tables(text, ("name", "email", "mobile")) == "We need two people.\nREQ-12345 stays\n\nPlease reply soon.\nend"
    assert without_tables(None, ("a", "b")) is None and without_tables("", ("a",)) == ""


def test_vertical_rows():
    text = "intro\nRole\nCity\nExp\nJava Developer\nPune\n3-5\nTester\nKochi\n2\n\nrest"
    assert vertical_rows(text) == [{"job_title": "Java Developer", "location": "Pune", "experience": "3-5"}, {"job_title": "Tester", "location": "Kochi", "experience": "2"}]
    assert vertical_rows("Role\n\nCity") == vertical_rows(None) == []


def test_operator(spark):
    df = spark.createDataFrame([(1, TABLE), (2, None), (3, ""), (1, TABLE)], "k long, t string")
    rows = segmented(df, "t").collect()
    assert [r["k"] for r in rows].count(1) == 4 and {r["k"] for r in rows} == {1}
    assert segmented(df.limit(0), "t").count() == 0
