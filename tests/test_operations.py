"""Hot keys by a sketch, reconciliation by rows, resumable backfills, catalog statistics."""

from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import enrich, joins
from ledgerlake.operators.aggregate import reconcile_rows
from ledgerlake.plans import daily
from ledgerlake.plans.layout import LakePaths
from ledgerlake.schemas import BRONZE, FX_RATES
from ledgerlake.sinks import lake as sink
from ledgerlake.sources import lake


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 500)
    return spark.range(6000, numPartitions=6).select(key.cast("int").alias("k"), F.lit("x").alias("g"), "id")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", [["k"], ["k", "g"]])
def test_sketched_join_equals_a_plain_join(spark, skewed, how, on):
    lookup = spark.range(0, 400).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("g"), (F.col("id") * 2).alias("v"))
    lookup = lookup.select(*on, "v").unionAll(lookup.select(*on, "v").where("k = 7"))
    found = joins.sketched_join(skewed, lookup, on, how)
    plain = skewed.join(lookup, on, how)
    assert found.columns == plain.columns and rows(found) == rows(plain)


def test_the_sketch_spreads_the_hot_key_and_reads_the_facts_once(spark, skewed, tmp_path):
    lookup = spark.range(0, 500).select(F.col("id").cast("int").alias("k"))
    found = joins.sketched_join(skewed, lookup, ["k"])
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "Range (0, 6000" not in plan and "Relation" in plan  # the written facts, not their source
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found.withColumn("p", F.spark_partition_id()).write.parquet(str(tmp_path / "j"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = spark.read.parquet(str(tmp_path / "j")).where("k = 7").groupBy("p").count().collect()
    assert sum(r["count"] for r in hot) == skewed.where("k = 7").count() and len(hot) >= 2


def test_sketched_join_without_rows(spark, skewed):
    lookup = spark.range(3).select(F.col("id").cast("int").alias("k"))
    assert joins.sketched_join(skewed.limit(0), lookup, ["k"]).count() == 0
    with pytest.raises(ValueError, match="unmatched"):
        joins.sketched_join(skewed, lookup, ["k"], "full_outer")


def test_reconciled_rows(spark):
    schema = "k int, g string, v double"
    source = [(1, "a", 1.0), (1, "b", None), (2, None, 5.0), (3, "c", 1.0), (3, "c", 1.0), (None, None, 9.0), (4, "d", 2.0), (5, "e", None)]
    target = [(1, "a", 1.0), (1, "b", 0.0), (2, None, 5.0), (3, "c", 1.0), (None, None, 8.0), (6, "f", 2.0), (5, None, None)]
    for buckets in (1, 4096):
        found = reconcile_rows(spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), ["k", "g"], ["v"], buckets)
        assert rows(found) == Counter([
            (1, "b", 1, 1, "changed"), (3, "c", 2, 1, "changed"), (None, None, 1, 1, "changed"),
            (4, "d", 1, 0, "missing"), (6, "f", 0, 1, "extra"), (5, "e", 1, 0, "missing"), (5, None, 0, 1, "extra"),
        ])
    same = spark.createDataFrame(source, schema)
    assert reconcile_rows(same, same.orderBy("v"), ["k", "g"], ["v"]).count() == 0
    with pytest.raises(TypeError, match="different types"):
        reconcile_rows(same, same.withColumn("v", F.lit(1)), ["k", "g"], ["v"])


def land(spark, paths, days):
    names = [f.name for f in BRONZE]
    values = [(d,) for d in days]
    cells = {"value_date": F.col("d"), "withdrawal_amt": F.lit(2), "withdrawal_currency": F.lit("USD"), "ingestion_date": F.col("d")}
    txn = spark.createDataFrame(values, "d string").select(*[cells.get(n, F.lit(None)).cast(BRONZE[n].dataType).alias(n) for n in names])
    sink.write_dates(txn, paths.bronze)
    fx = spark.createDataFrame([(d, "SGD", "USD") for d in set(days)], "run_date string, base_currency string, target_currency string")
    sink.write_fx(fx.withColumn("rate_to_sgd", F.lit(2).cast(FX_RATES["rate_to_sgd"].dataType)), paths.fx)


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_a_stopped_backfill_continues(spark, tmp_path, monkeypatch):
    paths = LakePaths.under(str(tmp_path))
    land(spark, paths, ["2024-01-03", "2024-01-12", "2024-01-12", "2024-01-25"])
    real, calls = daily.replace_period, []

    def failing(*args):
        calls.append(args[2])
        if len(calls) == 3:
            raise OSError("stopped")
        return real(*args)

    monkeypatch.setattr(daily, "replace_period", failing)
    job = lambda name="first": daily.run_sliced_backfill(spark, paths, "2024-01-01", "2024-02-01", name, 10)
    with pytest.raises(OSError, match="stopped"):
        job()
    before = files(paths.currency_agg)
    assert calls == ["2024-01-01", "2024-01-11", "2024-01-21"] and len(before) == 2
    assert job() == [("2024-01-21", "2024-01-31"), ("2024-01-31", "2024-02-01")]
    after = files(paths.currency_agg)
    assert {k: after[k] for k in before} == before
    found = lake.read_days(spark, paths.currency_agg, "2024-01-01", "2024-02-01")
    assert {(r.ingestion_date, r.txn_count) for r in found.collect()} == {("2024-01-03", 1), ("2024-01-12", 2), ("2024-01-25", 1)}
    assert job() == []
    # A day that lost its rows goes, a day outside the slices stays.
    sink.write_day(lake.read_day(spark, paths.bronze, "2024-01-12").limit(0), paths.bronze, "2024-01-12")
    sink.write_day(found.limit(1), paths.currency_agg, "2024-02-07")
    assert len(job("second")) == 4
    left = lake.read_days(spark, paths.currency_agg, "2024-01-01", "2024-03-01")
    assert {r.ingestion_date for r in left.collect()} == {"2024-01-03", "2024-01-25", "2024-02-07"}


def test_slices():
    assert daily.period_slices("2024-01-01", "2024-01-08", 3) == [("2024-01-01", "2024-01-04"), ("2024-01-04", "2024-01-07"), ("2024-01-07", "2024-01-08")]
    assert daily.period_slices("2024-01-01", "2024-01-01", 3) == []


def jobs_of(spark, build):
    """How many jobs building a plan starts."""
    group = f"g{id(build)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        found = build()
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_statistics_decide_about_a_broadcast_without_a_job(spark, tmp_path):
    fx = spark.createDataFrame([("2024-01-01", "SGD", c, n) for n, c in enumerate(["USD", "EUR", "JPY"], 1)], "run_date string, base_currency string, target_currency string, rate_to_sgd int")
    fx.withColumn("rate_to_sgd", F.col("rate_to_sgd").cast(FX_RATES["rate_to_sgd"].dataType)).write.partitionBy("run_date").parquet(str(tmp_path / "fx"))
    lake.create_external_table(spark, "fx_stats", str(tmp_path / "fx"))
    try:
        rates = enrich.day_rates(spark.table("fx_stats"), "2024-01-01")
        assert joins.stated_bytes(rates) is None
        lake.analyze_table(spark, "fx_stats")
        assert rows(lake.partition_statistics(spark, "fx_stats").select("partition", "rows")) == Counter([("run_date=2024-01-01", 3)])
        rates = enrich.day_rates(spark.table("fx_stats"), date(2024, 1, 1))
        stated = joins.stated_bytes(rates)
        assert stated >= joins.measured_bytes(rates) > 0
        txn = spark.createDataFrame([("USD", 1)], "currency string, n int")
        found, jobs = jobs_of(spark, lambda: enrich.enrich_with_fx(txn, rates))
        assert jobs == 0 and "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        found, jobs = jobs_of(spark, lambda: enrich.enrich_with_fx(txn, rates, limit=stated - 1))
        assert jobs > 0 and found.count() == 1
        # A computed cell may be longer than the column's longest.
        assert joins.stated_bytes(rates.withColumn("currency", F.repeat("currency", 1000))) is None
        assert joins.stated_bytes(rates.groupBy("currency").count()) is None
    finally:
        spark.sql("DROP TABLE fx_stats")
