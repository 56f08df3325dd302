"""SCD2 as a transform and as stored versions."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from cartwright.config import v1_rules, v2_rules
from cartwright.operators.joins import SkewPolicy
from cartwright.operators.scd2 import History, scd2_apply, stamp_current
from cartwright.sinks.history import BUCKET, HistoryTable
from cartwright.sources.tables import TableStore
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

DAY = [dt.date(2001, 8, d) for d in range(1, 6)]
SCHEMA = "id string, v int"
HISTORY = History("source", "id", ("id", "v"))


def rules(day, make=v2_rules):
    return make(as_of=DAY[day], now=dt.datetime.combine(DAY[day], dt.time(12)))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def model(state, batch, day, guard):
    """The rules in plain Python, on rows (id, v, start, end, current)."""
    ids = {i for i, _ in batch if i is not None}
    after = [
        (i, v, start, DAY[day], False) if i in ids and (current or not guard) else (i, v, start, end, current)
        for i, v, start, end, current in state
    ]
    return after + [(i, v, DAY[day], None, True) for i, v in batch]


def state_bag(df):
    names = ("id", "v", "effective_date", "expiry_date", "is_current")
    return Counter(tuple(r[n] for n in names) for r in df.collect())


batches = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 2)), max_size=6
)


@pytest.mark.parametrize("guard", [True, False])
@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(first=batches, second=batches, third=batches)
def test_apply_follows_the_rules(spark, guard, first, second, third):
    state, expected = stamp_current(frame(spark, first), rules(0)), model([], first, 0, guard)
    for day, batch in ((1, second), (2, third)):
        policy = SkewPolicy(rows_per_cell=2, always_spread=day == 2)
        state = scd2_apply(state, frame(spark, batch), "id", rules(day), guard, policy)
        expected = model(expected, batch, day, guard)
    assert state_bag(state) == Counter(expected)


def test_same_day_rerun_leaves_empty_intervals(spark):
    batch = frame(spark, [("a", 1)])
    state = scd2_apply(stamp_current(batch, rules(0)), batch, "id", rules(0))
    closed = state.filter("NOT is_current").collect()
    assert [(r.effective_date, r.expiry_date) for r in closed] == [(DAY[0], DAY[0])]


@pytest.fixture
def table(spark, database, tmp_path):
    return HistoryTable(TableStore(spark, database), "target", str(tmp_path / "it's \\ here"), buckets=4)


def files(table):
    return {p for p in Path(table.location).glob("**/*.parquet")}


@pytest.mark.parametrize("make", [v2_rules, v1_rules])
def test_table_equals_transform(spark, table, make):
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    loads = [
        (0, [("a", 1), ("b", 1), (None, 1), ("a", 1)]),
        (1, [("a", 2), ("c", 2), (None, 2)]),
        (2, []),
        (3, [("a", 3), ("b", 3)]),
        # Again on the same day, with keys that were closed on it and a second one without key.
        (3, [("a", 4), ("d", 4), (None, 4)]),
        (3, [(None, 5)]),
        (4, [("a", 6), ("b", 6), ("c", 6), ("d", 6)]),
    ]
    expected, guard = [], HISTORY.guarded(rules(0, make))
    assert guard == (make is v2_rules)
    for day, batch in loads:
        table.merge(frame(spark, batch), HISTORY, rules(day, make))
        expected = model(expected, batch, day, guard)
        assert state_bag(table.read()) == Counter(expected), day
    assert state_bag(table.current()) == Counter(r for r in expected if r[4])
    # It is a table like any other, by its name.
    assert state_bag(spark.table(table.tables.name("target"))) == Counter(expected)


@pytest.mark.parametrize("make", [v2_rules, v1_rules])
def test_batch_of_one_key_rewrites_one_bucket(spark, table, make):
    table.merge(frame(spark, [(f"k{i}", i) for i in range(40)] + [(None, 1)]), HISTORY, rules(0, make))
    before = files(table)
    hit = table.merge(frame(spark, [("k7", 100)]), HISTORY, rules(1, make))
    assert len(hit) == 1
    gone, new = before - files(table), files(table) - before
    assert gone and new
    assert {f"{BUCKET}={hit[0]}" in str(path) for path in gone | new} == {True}
    assert table.read().count() == 42


def test_closed_rows_are_written_once(spark, table):
    kept = set()
    for day in range(4):
        table.merge(frame(spark, [("a", day)]), HISTORY, rules(day))
        closed = {path for path in files(table) if "HIVE_DEFAULT" not in str(path)}
        assert kept <= closed and len(closed) == day
        kept = closed


def test_merge_reads_only_the_buckets_and_days_it_writes(spark, table, monkeypatch):
    for day in range(3):
        table.merge(frame(spark, [(f"k{i}", day) for i in range(40)]), HISTORY, rules(day))
    planned = []
    monkeypatch.setattr(
        TableStore, "replace_partitions", lambda self, df, *_: planned.append(df._jdf.queryExecution().executedPlan().toString())
    )
    table.merge(frame(spark, [("k7", 100)]), HISTORY, rules(3))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", planned[0])
    assert any(BUCKET in f and "expiry_date" in f for f in filters)


def test_run_that_dies_before_its_commit_changes_nothing(spark, table):
    table.merge(frame(spark, [("a", 1)]), HISTORY, rules(0))
    before = state_bag(table.read())
    broken = frame(spark, [("a", 2)]).withColumn("v", F.expr("if(id = 'a', raise_error('lost'), v)").cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.merge(broken, HISTORY, rules(1))
    assert state_bag(table.read()) == before
    table.merge(frame(spark, [("a", 2)]), HISTORY, rules(1))
    assert table.read().count() == 2


def test_first_load_of_an_empty_batch(spark, table):
    table.merge(frame(spark, []), HISTORY, rules(0))
    assert table.exists() and table.read().count() == 0
    table.merge(frame(spark, [("a", 1)]), HISTORY, rules(1))
    assert table.read().count() == 1
    assert replace(rules(0), as_of=None).as_of is None


def test_other_rules_are_refused(spark, table):
    table.merge(frame(spark, [("a", 1)]), HISTORY, rules(0))
    with pytest.raises(ValueError, match="laid out"):
        table.merge(frame(spark, [("a", 2)]), HISTORY, rules(1, v1_rules))
