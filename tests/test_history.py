"""Chains of periods, against a plain loop, and the store's replacement of chains."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodestream.operators.history import ChainStore, Conflict, build_chains, rebuild_affected

SCHEMA = "entity string, field string, value string, at_ms long"
change = st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.sampled_from(["1", "2", "3", None]), st.one_of(st.none(), st.integers(0, 40)))


def plain(rows):
    at = defaultdict(dict)
    for e, f, v, t in rows:
        if v is not None and t is not None:
            at[e, f][t] = max(v, at[e, f].get(t, v))
    out = set()
    for (e, f), values in at.items():
        chain = []
        for t in sorted(values):
            if not chain or chain[-1][1] != values[t]:
                chain.append((t, values[t]))
        out |= {(e, f, v, t, chain[k + 1][0] if k + 1 < len(chain) else 0, k == 0) for k, (t, v) in enumerate(chain)}
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, max_size=40))
def test_chains(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in build_chains(df, most=3).collect()]  # many slices
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_late_changes_rebuild_only_their_entities(spark, tmp_path):
    base = [("a", "x", "1", 10), ("a", "x", "2", 30), ("b", "x", "1", 5), ("c", "y", "9", 1)]
    late = [("a", "x", "3", 20), ("c", "y", "9", 4)]
    both = spark.createDataFrame(base + late, SCHEMA)
    chains = build_chains(spark.createDataFrame(base, SCHEMA))
    got = {tuple(r) for r in rebuild_affected(chains, both, spark.createDataFrame(late, SCHEMA)).collect()}
    assert got == plain(base + late)
    assert {tuple(r) for r in rebuild_affected(chains, both, spark.createDataFrame([], SCHEMA)).collect()} == plain(base)

    store = ChainStore(spark, f"file://{tmp_path}/chains")
    assert store.current() is None
    first = store.apply(spark.createDataFrame(base, SCHEMA), spark.createDataFrame(base, SCHEMA))
    old = store.current()
    second = store.apply(both, spark.createDataFrame(late, SCHEMA))
    assert first != second
    assert {tuple(r) for r in store.current().collect()} == plain(base + late)
    assert {tuple(r) for r in old.collect()} == plain(base)  # a reader of the old snapshot is undisturbed


def test_only_touched_buckets_are_written(spark, tmp_path):
    base = [(f"e{k}", "x", str(k), 10) for k in range(40)]
    store = ChainStore(spark, f"file://{tmp_path}/chains", buckets=8)
    store.apply(spark.createDataFrame(base, SCHEMA), spark.createDataFrame(base, SCHEMA))
    _, before = store.manifest()
    late = [("e3", "x", "new", 20)]
    store.apply(spark.createDataFrame(base + late, SCHEMA), spark.createDataFrame(late, SCHEMA))
    _, after = store.manifest()
    assert len(before) == len(after) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert {tuple(r) for r in store.current().collect()} == plain(base + late)


def test_two_writers(spark, tmp_path):
    """Of two updates from one manifest the second is refused, and apply() starts again."""
    base = [("a", "x", "1", 10)]
    store = ChainStore(spark, f"file://{tmp_path}/chains")
    store.apply(spark.createDataFrame(base, SCHEMA), spark.createDataFrame(base, SCHEMA))
    number, folders = store.manifest()
    assert store.publish(folders, number) == number + 1
    with pytest.raises(Conflict):
        store.publish(folders, number)
    assert store.numbers()[-1] == number + 1
    late = [("a", "x", "2", 20)]
    store.apply(spark.createDataFrame(base + late, SCHEMA), spark.createDataFrame(late, SCHEMA))
    assert {tuple(r) for r in store.current().collect()} == plain(base + late)


def test_old_snapshots_are_removed(spark, tmp_path):
    rows = []
    store = ChainStore(spark, f"file://{tmp_path}/chains", buckets=2, keep=2)
    for k in range(5):
        rows.append(("a", "x", str(k), k))
        store.apply(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[-1:], SCHEMA))
    assert store.numbers() == [4, 5]
    assert len([p for p in (tmp_path / "chains").glob("data-*/bucket=*")]) <= 4
    assert {tuple(r) for r in store.current().collect()} == plain(rows)
