"""Evaluation of samples of several records, against a plain recount."""

import pytest

from lodestream.plans import quality

SCHEMA = "client string, day string, id string, job_title string, experience string, skills string, location string, budget string, positions string"


def test_samples_of_several_records(spark):
    e = [("acme", "d1", "e1", "java developer", "4 years", "java, sql", "Pune, Delhi", "9", None), ("acme", "d1", "e2", "data engineer", None, "spark", "Delhi", None, "1"), ("bolt", "d1", "e3", "tester", "2", "qa", "Pune", "1", "1")]
    a = [("acme", "d1", "a1", "data engineer", "3", "spark", "Delhi", "7", "1"), ("acme", "d1", "a2", "java developer", "4 years", "sql; java", "delhi; pune", "9", ""), ("acme", "d1", "a3", "java developer", "9", "go", "", "5", "2"), ("coda", "d2", "a4", "cook", "", "", "", None, "3")]
    got = {(r["client"], r["day"]): r.asDict() for r in quality.evaluated(spark.createDataFrame(e, SCHEMA), spark.createDataFrame(a, SCHEMA)).collect()}
    assert set(got) == {("acme", "d1"), ("bolt", "d1"), ("coda", "d2")}
    one = got["acme", "d1"]
    # e1-a2 score 1 and are taken first, e2-a1 next; a3 is left over
    assert (one["n_expected"], one["n_actual"], one["matched"], one["expected"], one["actual"]) == (2, 3, 2, "java developer", "java developer")
    assert [one[f] for f in quality.WEIGHTS] == pytest.approx([2 / 3, 1 / 3, 2 / 3, 2 / 3], abs=1e-6)
    assert one["invented"] == 1 + 2  # e2's budget; budget and positions of a3
    assert one["is_failure"] and one["low_fields"] == "job_title,experience,skills,location"
    assert (got["bolt", "d1"]["matched"], got["bolt", "d1"]["job_title"], got["bolt", "d1"]["invented"]) == (0, 0.0, 0)
    assert (got["coda", "d2"]["n_expected"], got["coda", "d2"]["invented"]) == (0, 1)


def test_equal_sample_does_not_fail(spark):
    rows = [("acme", "d", f"x{k}", f"role {k}", "1", "a, b", "Pune", "5", "1") for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    (r,) = quality.evaluated(df, df).collect()
    assert r["matched"] == 3 and not r["is_failure"] and all(r[f] == 1.0 for f in quality.WEIGHTS)


def test_registered_samples_have_several_pairs(spark):
    from lodestream.plans import registry

    rows = registry.queries()["greedy_eval"](spark, "/root/testdata/sf0.01").collect()
    assert any(r["matched"] > 0 and r["n_expected"] * r["n_actual"] > 1 for r in rows)
