import json
import subprocess
import sys
from collections import Counter
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.__main__ import arguments
from ledgerlake.operators.project import conform, mask_pii, to_long, to_wide, trim_strings
from ledgerlake.plans import daily
from ledgerlake.plans.layout import LakePaths
from ledgerlake.schemas import BRONZE, CHANGES, CHANGES_V1, FX_RATES, GOLD, TRANSACTIONS
from ledgerlake.session import scratch_path, shared_folder
from ledgerlake.sinks import lake as sink
from ledgerlake.sources import lake, landing

D = Decimal
DAY = "2024-01-02"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def raw(spark, amounts, currency=" USD "):
    cells = [(" A1 ", DAY, "t", None, DAY, D(a), currency, None, None, D(0)) for a in amounts]
    return spark.createDataFrame(cells, TRANSACTIONS)


def rates(spark, day=DAY, rate="2"):
    return spark.createDataFrame([(day, "SGD", "USD", D(rate))], FX_RATES)


@pytest.fixture
def paths(tmp_path):
    return LakePaths.under(str(tmp_path))


# --- reruns -------------------------------------------------------------------------------


def test_rerun_replaces_only_its_day(spark, paths):
    for day in ("2024-01-01", DAY):
        sink.write_day(raw(spark, [1, 2]), paths.raw, day)
        sink.write_fx(rates(spark, day), paths.fx)
        daily.run_bronze(spark, paths, day)
        daily.run_currency_aggregate(spark, paths, day)
    sink.write_day(raw(spark, [5]), paths.raw, DAY)
    for _ in range(2):
        daily.run_bronze(spark, paths, DAY)
        daily.run_currency_aggregate(spark, paths, DAY)
    out = {r["ingestion_date"]: r["total_value_sgd"]
           for r in lake.read_days(spark, paths.currency_agg, "2024-01-01", "2024-01-03").collect()}
    assert out == {"2024-01-01": 6, DAY: 10}


def test_dynamic_write_keeps_other_dates_whatever_the_session_says(spark, tmp_path):
    two = spark.createDataFrame([(1, "2024-01-01"), (2, DAY)], "v int, ingestion_date string")
    sink.write_dates(two, str(tmp_path / "t"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    sink.write_dates(two.where(F.col("v") == 2).withColumn("v", F.lit(7)), str(tmp_path / "t"))
    assert rows(spark.read.parquet(str(tmp_path / "t")).select("v")) == Counter([(1,), (7,)])


def test_empty_rerun_empties_the_day(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    sink.write_day(df, str(tmp_path / "t"), DAY)
    sink.write_day(df.where("v > 1"), str(tmp_path / "t"), DAY)
    assert lake.read_day(spark, str(tmp_path / "t"), DAY).count() == 0


def test_backfill_clears_dates_that_lost_their_rows(spark, paths):
    days = ["2024-01-01", DAY, "2024-01-05"]
    for day in days:
        sink.write_day(trim_strings(raw(spark, [1])), paths.bronze, day)
        sink.write_fx(rates(spark, day), paths.fx)
    daily.run_backfill(spark, paths, "2024-01-01", "2024-01-06")
    sink.write_day(trim_strings(raw(spark, [1], "XXX")), paths.bronze, DAY)
    daily.run_backfill(spark, paths, "2024-01-01", "2024-01-03")
    found = lake.read_days(spark, paths.currency_agg, "2024-01-01", "2024-02-01")
    assert {r["ingestion_date"] for r in found.collect()} == {"2024-01-01", "2024-01-05"}


def test_backfill_of_nothing_twice(spark, paths):
    sink.write_fx(rates(spark), paths.fx)
    sink.write_day(trim_strings(raw(spark, [1], "XXX")), paths.bronze, DAY)
    for _ in range(2):
        daily.run_backfill(spark, paths, DAY, "2024-01-03")
    sink.write_day(trim_strings(raw(spark, [1])), paths.bronze, DAY)
    daily.run_backfill(spark, paths, DAY, "2024-01-03")
    assert spark.read.parquet(paths.currency_agg).count() == 1


def test_backfill_equals_daily_runs(spark, paths, tmp_path):
    single = LakePaths.under(str(tmp_path / "single"))
    for day, rate in (("2024-01-01", "2"), (DAY, "3")):
        for p in (paths, single):
            sink.write_day(trim_strings(raw(spark, [1, 2])), p.bronze, day)
            sink.write_fx(rates(spark, day, rate), p.fx)
        daily.run_currency_aggregate(spark, single, day)
    daily.run_backfill(spark, paths, "2024-01-01", "2024-01-03")
    columns = ["ingestion_date", "currency", "txn_count", "total_value_sgd"]
    read = [lake.read_days(spark, p.currency_agg, "2024-01-01", "2024-01-03").select(columns)
            for p in (paths, single)]
    assert rows(read[0]) == rows(read[1])


def test_gold_counts_and_replaces_rejects(spark, paths):
    sink.write_fx(rates(spark, "2024-01-01"), paths.fx)  # only the day before has a rate
    sink.write_day(conform(raw(spark, [1, -2]).withColumn("ingestion_date", F.lit(DAY)), BRONZE), paths.bronze, DAY)
    counts = daily.run_gold(spark, paths, DAY)
    assert counts == {"input_count": 2, "valid_count": 1, "reject_count": 1,
                      "unknown_currency_count": 0, "output_count": 1}
    valid, rejected = daily.read_gold(spark, paths, DAY)
    assert [r["amount_sgd"] for r in valid.collect()] == [0.5]
    assert [r["reject_reason"] for r in rejected.collect()] == ["negative_amount"]
    sink.write_day(conform(raw(spark, [1]).withColumn("ingestion_date", F.lit(DAY)), BRONZE), paths.bronze, DAY)
    daily.run_gold(spark, paths, DAY)
    assert daily.read_gold(spark, paths, DAY)[1].count() == 0


def test_a_day_without_rows(spark, paths):
    sink.write_fx(rates(spark), paths.fx)
    sink.write_day(raw(spark, [1]).limit(0), paths.raw, DAY)
    daily.run_bronze(spark, paths, DAY)
    assert daily.run_gold(spark, paths, DAY) == {
        "input_count": 0, "valid_count": 0, "reject_count": 0, "unknown_currency_count": 0, "output_count": 0}
    assert [part.count() for part in daily.read_gold(spark, paths, DAY)] == [0, 0]
    daily.run_currency_aggregate(spark, paths, DAY)
    assert lake.read_day(spark, paths.currency_agg, DAY).count() == 0


def test_gold_schema(spark, paths):
    sink.write_fx(rates(spark), paths.fx)
    sink.write_day(raw(spark, [1]), paths.raw, DAY)
    daily.run_bronze(spark, paths, DAY)
    daily.run_gold(spark, paths, DAY)
    stored = spark.read.parquet(paths.gold)
    assert set(stored.columns) == set(GOLD.names)
    kinds = {f.name: f.dataType for f in stored.schema.fields}
    folders = ("ingestion_date", "outcome")
    assert all(kinds[f.name] == f.dataType for f in GOLD.fields if f.name not in folders)
    assert daily.read_gold(spark, paths, DAY)[0].count() == 1


# --- layout -------------------------------------------------------------------------------


def test_one_day_is_listed_alone_and_keeps_its_date(spark, paths):
    for day in ("2024-01-01", DAY):
        sink.write_day(raw(spark, [1]), paths.raw, day)
    one = lake.read_transactions(spark, paths.raw, DAY)
    assert "ingestion_date" in one.columns
    assert all("2024-01-01" not in name for name in one.inputFiles())


def test_days_prune_partitions(spark, paths):
    for day in ("2024-01-01", DAY):
        sink.write_day(raw(spark, [1]), paths.raw, day)
    plan = lake.read_days(spark, paths.raw, DAY, "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_file_count_follows_the_request(spark, paths):
    sink.write_day(raw(spark, range(100)), paths.raw, DAY)
    leaf = Path(daily.run_bronze(spark, paths, DAY, files=5))
    assert len(list(leaf.glob("*.parquet"))) == 5
    daily.run_bronze(spark, paths, DAY, file_bytes=1 << 30)
    assert len(list(leaf.glob("*.parquet"))) == 1


def test_files_by_size_need_no_shuffle(spark, paths, monkeypatch):
    """a file per so many raw bytes was a shuffle partition and a task per file."""
    sink.write_day(raw(spark, range(1000)).repartition(4), paths.raw, DAY)
    dealt = []
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "repartition", lambda self, *a, f=frame.repartition: dealt.append(a) or f(self, *a))
    stored = sink.stored_bytes(spark, paths.raw)
    leaf = Path(daily.run_bronze(spark, paths, DAY, file_bytes=stored // 20))
    sizes = [spark.read.parquet(str(f)).count() for f in leaf.glob("*.parquet")]
    assert sum(sizes) == 1000 and max(sizes) <= 50 and len(sizes) >= 20 and not dealt


def test_rates_of_many_days_are_written_by_several_tasks(spark, paths):
    """one task wrote the small files of all days."""
    days = spark.sql("SELECT CAST(date_add(DATE'2024-01-01', CAST(id AS INT)) AS STRING) AS run_date, 'SGD' AS base_currency, "
                     "'USD' AS target_currency, CAST(2 AS DECIMAL(18,12)) AS rate_to_sgd FROM range(60)")
    sink.write_fx(days.coalesce(1), paths.fx)
    files = [f.name.split("-")[1] for f in Path(paths.fx).rglob("*.parquet")]
    assert len(files) == 60 and len(set(files)) > 1
    assert lake.read_fx_days(spark, paths.fx, "2024-01-01", "2025-01-01").count() == 60


def test_partition_count_by_size():
    assert sink.partitions_for(10 * 1024**3) == 80
    assert sink.partitions_for(0) == 1
    assert sink.partitions_for(129 * 1024**2) == 2


def test_compaction_writes_few_files_and_the_same_rows(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") < 900, DAY).otherwise("2024-01-01").alias("ingestion_date")
    )
    sink.write_dates(df.repartition(20), str(tmp_path / "small"))
    sink.compact(spark, str(tmp_path / "small"), str(tmp_path / "big"), "2024-01-01", "2024-01-03")
    files = lambda name: len(list((tmp_path / name).rglob("*.parquet")))
    assert files("small") == 40 and files("big") == 2
    for day in ("2024-01-01", DAY):
        sink.compact_day(spark, str(tmp_path / "small"), str(tmp_path / "days"), day)
    assert files("days") == 2
    small, big, days = (spark.read.parquet(str(tmp_path / n)) for n in ("small", "big", "days"))
    assert rows(small) == rows(big) == rows(days)


def test_compaction_splits_a_large_date(spark, tmp_path):
    df = spark.range(20000).select("id", F.lit(DAY).alias("ingestion_date"))
    sink.write_dates(df.repartition(2), str(tmp_path / "s"))
    size = sink.stored_bytes(spark, str(tmp_path / "s"))
    sink.compact(
        spark, str(tmp_path / "s"), str(tmp_path / "b"), DAY, "2024-01-03", target_bytes=size // 4 + 1
    )
    assert len(list((tmp_path / "b").rglob("*.parquet"))) > 1


@pytest.mark.parametrize("partitions", [(), ("k",)])
def test_external_table(spark, tmp_path, partitions):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    df.write.partitionBy(*partitions).parquet(str(tmp_path / "t"))
    table = lake.create_external_table(spark, "external_check", str(tmp_path / "t"))
    try:
        assert rows(spark.sql("SELECT v FROM external_check WHERE k = 'b'")) == Counter([(2,)])
        assert table.count() == 2
    finally:
        spark.sql("DROP TABLE external_check")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_files_of_two_schema_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    for n, schema in enumerate((CHANGES_V1, CHANGES)):
        spark.createDataFrame([tuple([None] * len(schema))], schema).write.mode("append").parquet(root)
    assert lake.read_versions(spark, root, CHANGES).columns == CHANGES.names
    assert lake.read_versions(spark, root, CHANGES).count() == 2


# --- landed files -------------------------------------------------------------------------

HEADER = ",".join(TRANSACTIONS.names)


def test_csv_keeps_bad_lines(spark, paths, tmp_path):
    good = f" A1 ,{DAY},t,,{DAY},1.50,USD,,,2"
    bad_cell = good.replace("1.50", "abc")
    short = f"A2,{DAY}"
    long = good + ",extra"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("\n".join([HEADER, good, bad_cell, ""]))
    (tmp_path / "in" / "2.csv").write_text("\n".join([HEADER, short, long, good, ""]))
    glob = str(tmp_path / "in" / "*.csv")
    assert daily.run_bronze_from_csv(spark, glob, paths, DAY) == {"read": 5, "corrupt": 3}
    bronze = lake.read_transactions(spark, paths.bronze, DAY)
    assert [(r["account_no"], r["withdrawal_amt"]) for r in bronze.collect()] == [("A1", D("1.50"))] * 2
    rejected = lake.read_day(spark, paths.reject, DAY)
    assert {r[landing.CORRUPT] for r in rejected.collect()} == {bad_cell, short, long}
    (tmp_path / "in" / "1.csv").write_text("\n".join([HEADER, good, ""]))
    (tmp_path / "in" / "2.csv").write_text("\n".join([HEADER, good, ""]))
    assert daily.run_bronze_from_csv(spark, glob, paths, DAY)["corrupt"] == 0
    assert lake.read_day(spark, paths.reject, DAY).count() == 0


def test_rate_reply(spark, tmp_path):
    reply = {"timestamp": 1704153600, "base": "SGD", "rates": {"USD": 1.35, "EUR": 1.5}}
    (tmp_path / "r.json").write_text(json.dumps(reply, indent=2))
    expected = Counter([(DAY, "SGD", "USD", D("1.35")), (DAY, "SGD", "EUR", D("1.5"))])
    assert rows(landing.read_fx_snapshot(spark, str(tmp_path / "r.json"))) == expected
    asked = landing.read_fx_snapshot(spark, str(tmp_path / "r.json"), "2024-01-01")
    assert {r["run_date"] for r in asked.collect()} == {"2024-01-01"}


def test_fx_layout_round_trip(spark, paths):
    sink.write_fx(rates(spark, DAY).unionAll(rates(spark, "2024-01-10")), paths.fx)
    assert Path(paths.fx, "year=2024", "month=01", "day=02").is_dir()
    assert lake.read_fx_data(spark, paths.fx, DAY).columns == ["base_currency", "target_currency", "rate_to_sgd"]
    sink.write_day(rates(spark, DAY), f"{paths.fx}2", DAY, "date")
    assert lake.read_fx_data(spark, f"{paths.fx}2", DAY, "date").first()["rate_to_sgd"] == 2
    days = lake.read_fx_days(spark, paths.fx, DAY, "2024-01-10")
    assert [r["run_date"] for r in days.collect()] == [DAY]
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


# --- cells --------------------------------------------------------------------------------


def test_conform_fills_casts_and_orders(spark):
    target = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("new", T.StringType())])
    df = spark.createDataFrame([("x", "abc"), ("y", "7")], "other string, n string")
    assert rows(conform(df, target)) == Counter([(None, None), (7, None)])


def test_trim_and_blank(spark):
    df = spark.createDataFrame([("  ", 1), (" a ", 2)], "t string, n int")
    assert rows(trim_strings(df)) == Counter([("", 1), ("a", 2)])
    assert rows(trim_strings(df, blank_as_null=True)) == Counter([(None, 1), ("a", 2)])


def test_mask(spark):
    df = spark.createDataFrame([("a",), (None,)], "account_no string")
    plain = {r[0] for r in mask_pii(df).collect()}
    # SHA-256 of "a"
    assert plain == {"ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb", None}
    assert mask_pii(df).columns == ["account_no_hash"]
    assert {r[0] for r in mask_pii(df, salt="s").collect()} != plain


def test_long_and_wide(spark):
    df = raw(spark, [1]).withColumn("id", F.lit(9))
    long = to_long(df, ["id"])
    assert long.first()["transaction_id"] == "9-withdrawal" and long.count() == 1
    wide = to_wide(long).first()
    assert (wide["withdrawal_amt"], wide["deposit_amt"]) == (D(1), None)


# --- session ------------------------------------------------------------------------------


def cluster(conf, master="yarn"):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_named_shared_folder_is_used(spark):
    assert scratch_path(cluster({"spark.checkpoint.dir": "s3://b/c"}), "x").startswith("s3://b/c/x-")
    assert shared_folder(spark) == shared_folder(spark)


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(cluster({}))


def test_job_arguments():
    args = arguments().parse_args(["gold", "--lake", "/l", "--run-date", DAY])
    assert (args.job, args.max_lag_days, args.rate_mode) == ("gold", 1, "divide")
    with pytest.raises(SystemExit):
        arguments().parse_args(["gold", "--lake", "/l"])


def test_job_from_the_command_line(spark, paths, tmp_path):
    sink.write_day(conform(raw(spark, [1, 2], "USD"), BRONZE), paths.bronze, DAY)
    sink.write_fx(rates(spark), paths.fx)
    command = [sys.executable, "-m", "ledgerlake", "currency-agg", "--lake", str(tmp_path), "--run-date", DAY]
    subprocess.run(command, check=True, capture_output=True, cwd=Path(__file__).parents[1], timeout=180)
    assert [tuple(r) for r in lake.read_day(spark, paths.currency_agg, DAY).collect()] == [("USD", 2, D(6), DAY)]


def test_one_large_date_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        df = spark.range(400000, numPartitions=8).select(F.col("id"), F.lit(DAY).alias("ingestion_date"))
        sink.write_output(df, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    assert len(list((tmp_path / "t").rglob("*.parquet"))) > 3
