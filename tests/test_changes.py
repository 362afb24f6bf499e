from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.changes import latest_changes, merge_changes
from ledgerlake.operators.history import apply_to_history, build_history, load_facts, lookup_version
from ledgerlake.plans import warehouse
from ledgerlake.plans.layout import WarehousePaths
from ledgerlake.schemas import CHANGES, CHANGES_V1

START = datetime(2024, 1, 1)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def feed(spark, changes):
    """changes: (id, hours since the start, op, segment)"""
    return spark.createDataFrame(
        [(seq, key, START + timedelta(hours=h), op, segment, 0.0)
         for seq, (key, h, op, segment) in enumerate(changes)],
        CHANGES_V1,
    )


def test_latest_breaks_ties_by_sequence(spark):
    out = latest_changes(feed(spark, [(1, 5, "U", "a"), (1, 5, "U", "b"), (1, 4, "U", "c"), (2, 0, "D", "d")]))
    assert {r["id"]: r["segment"] for r in out.collect()} == {1: "b", 2: "d"}


def test_latest_reduces_on_the_map_side(spark):
    out = latest_changes(feed(spark, [(1, 5, "U", "a")]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_merge(spark, limit):
    ods = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "segment string, id long")
    batch = feed(spark, [(2, 0, "U", "B"), (3, 0, "D", "x"), (4, 0, "I", None), (5, 0, "D", "y")])
    merged = merge_changes(ods, batch, limit=limit)
    assert merged.columns == ods.columns
    assert rows(merged) == Counter([("a", 1), ("B", 2), (None, 4)])
    assert rows(merge_changes(merged, batch, limit=limit)) == rows(merged)


def test_history(spark):
    out = build_history(
        feed(spark, [
            (1, 1, "I", "a"), (1, 2, "U", "b"),  # the first day ends as b
            (1, 25, "U", "b"),  # no change
            (1, 50, "D", "b"), (1, 100, "U", "c"),
            (2, 0, "D", "z"), (2, 30, "I", None), (2, 60, "U", None), (2, 80, "U", "q"),
        ]),
        ["segment"],
    )
    day = lambda n: date(2024, 1, n)
    assert rows(out.select("id", "segment", "start_date", "end_date")) == Counter([
        (1, "b", day(1), day(3)), (1, "c", day(5), None),
        (2, None, day(2), day(4)), (2, "q", day(4), None),
    ])


changes_strategy = st.lists(
    st.tuples(st.integers(1, 3), st.integers(0, 24 * 6 - 1), st.sampled_from("IUD"), st.sampled_from(["a", "b", None])),
    min_size=1, max_size=25,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes_strategy)
def test_daily_batches_build_the_same_history(spark, changes):
    everything = feed(spark, changes)
    whole = build_history(everything, ["segment"])
    dimension = whole.limit(0)
    for n in range(6):
        day = START.date() + timedelta(days=n)
        batch = latest_changes(everything.where(F.to_date("updated_at") == F.lit(day)))
        dimension = apply_to_history(dimension, batch, ["segment"], day.isoformat(), limit=(n % 2) << 20)
        path_free = [tuple(r) for r in dimension.collect()]
        dimension = spark.createDataFrame(path_free, whole.schema)
    assert rows(dimension) == rows(whole)
    versions = Window.partitionBy("id").orderBy("start_date")
    overlap = whole.withColumn("next", F.lead("start_date").over(versions)).where(
        (F.col("start_date") >= F.col("end_date")) | (F.col("end_date") > F.col("next"))
        | (F.col("next").isNotNull() & F.col("end_date").isNull())
    )
    assert overlap.count() == 0


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_second_run_of_a_batch_changes_nothing(spark, limit):
    dimension = build_history(feed(spark, [(1, 0, "I", "a"), (2, 0, "I", "b"), (3, 0, "I", "c")]), ["segment"])
    batch = feed(spark, [(1, 48, "U", "x"), (2, 48, "D", "b"), (3, 48, "U", "c"), (4, 48, "I", "n"), (5, 48, "D", "n")])
    once = apply_to_history(dimension, batch, ["segment"], "2024-01-03", limit=limit)
    twice = apply_to_history(once, batch, ["segment"], "2024-01-03", limit=limit)
    assert rows(once) == rows(twice)
    assert once.where("end_date IS NULL").count() == 3  # 1, 3 and 4


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_facts_find_the_version_of_their_day(spark, limit):
    d = lambda m, n: date(2024, m, n)
    dimension = spark.createDataFrame(
        [("s1", 1, d(1, 1), d(1, 10)), ("s2", 1, d(1, 10), d(4, 1)), ("s3", 1, d(4, 1), None), ("s4", 2, d(2, 1), d(2, 2))],
        "sk string, id int, start_date date, end_date date",
    )
    facts = spark.createDataFrame(
        [(n, key, day) for n, (key, day) in enumerate(
            [(1, d(1, 9)), (1, d(1, 10)), (1, d(3, 31)), (1, d(4, 1)), (1, d(4, 30)), (2, d(2, 1)), (2, d(2, 2)), (3, d(1, 1)), (None, d(1, 1))])],
        "n int, id int, day date",
    )
    out = lookup_version(facts, dimension, "day", "2024-01-01", "2024-05-01", limit=limit)
    assert out.columns == ["n", "id", "day", "sk"]
    assert [r["sk"] for r in out.orderBy("n").collect()] == ["s1", "s2", "s2", "s3", "s3", "s4", None, None, None]


def test_only_new_facts_of_the_period_are_loaded(spark):
    d = lambda n: date(2024, 1, n)
    facts = spark.createDataFrame([(n, 1, d(n)) for n in range(1, 7)], "f int, id int, day date")
    dimension = spark.createDataFrame([("s", 1, d(1), None)], "sk string, id int, start_date date, end_date date")
    out = load_facts(facts, facts.where("f = 3"), dimension, "f", "day", "2024-01-02", "2024-01-05")
    assert {r["f"] for r in out.collect()} == {2, 4}


def test_warehouse_reruns(spark, tmp_path):
    paths = WarehousePaths.under(str(tmp_path))
    customers = warehouse.Feed(CHANGES, tracked=("segment",))
    deliveries = {
        "2024-01-01": [(1, 0, "I", "a"), (2, 1, "I", "b")],
        "2024-01-02": [(1, 25, "U", "x"), (2, 20, "U", "late"), (3, 26, "I", "n")],
    }
    facts = spark.createDataFrame(
        [(1, 1, date(2024, 1, 1), 5), (2, 1, date(2024, 1, 2), 6), (3, 3, date(2024, 1, 2), 7)],
        "f int, id long, day date, amount int",
    )
    for day, changes in deliveries.items():
        for _ in range(2):
            warehouse.run_curation(feed(spark, changes), customers, paths, day)
    for _ in range(2):
        warehouse.run_initial_load(spark, customers, paths, "2024-01-01")
        warehouse.run_batch(spark, customers, paths, "2024-01-02", "2024-01-01")
    ods = warehouse.read_state(spark, customers, paths, "2024-01-02")
    assert ods.columns == ["seq", "id", "segment", "value", "email", "phone"]
    assert rows(ods.select("id", "segment")) == Counter([(1, "x"), (2, "late"), (3, "n")])
    dimension = lambda day: {
        (r["id"], r["segment"], str(r["start_date"]), str(r["end_date"]))
        for r in warehouse.read_dimension(spark, customers, paths, day).collect()
    }
    first = {(1, "a", "2024-01-01", "None"), (2, "b", "2024-01-01", "None")}
    assert dimension("2024-01-01") == first
    assert dimension("2024-01-02") == {
        (1, "a", "2024-01-01", "2024-01-02"), (1, "x", "2024-01-02", "None"),
        (2, "b", "2024-01-01", "2024-01-02"), (2, "late", "2024-01-02", "None"),
        (3, "n", "2024-01-02", "None"),
    }
    closed = spark.read.parquet(paths.dimension).where("state = 'closed'")
    assert closed.count() == 2  # written once, by the batch that closed them
    load = lambda source: warehouse.run_fact_load(
        spark, customers, source, paths, "2024-01-02", "2024-01-01", "2024-01-03", "f", "day"
    )
    load(facts.limit(0))
    load(facts.where("f < 3"))
    load(facts)  # one late fact of a day that has facts already
    load(facts)
    report = warehouse.fact_report(spark, facts, paths, "day", ["amount"], "2024-01-01", "2024-01-03")
    assert [r["ok"] for r in report.collect()] == [True, True]
    assert spark.read.parquet(paths.fact).where("sk IS NULL").count() == 0
