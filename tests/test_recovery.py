"""Input that comes late, twice, in another order or broken."""

import json
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake import __main__ as command
from ledgerlake.operators import changes as ch
from ledgerlake.operators import joins
from ledgerlake.operators.history import apply_to_history, new_facts
from ledgerlake.plans import daily, warehouse
from ledgerlake.plans.layout import LakePaths, WarehousePaths
from ledgerlake.schemas import BRONZE, CHANGES_V1, FX_RATES, TRANSACTIONS
from ledgerlake.sinks import lake as sink
from ledgerlake.sources import lake

DAY = "2024-01-05"


def feed_rows(seed, n=60):
    rng = random.Random(seed)
    return [
        (i, rng.randint(1, 8), datetime(2024, 1, rng.randint(1, 9), rng.randint(0, 23)), rng.choice("IUUD"), rng.choice("abc"), 1.0)
        for i in range(n)
    ]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_batches_in_any_order_give_one_state(spark, limit):
    rows = feed_rows(1)
    states = []
    for order in (1, 2, 3):
        shuffled = random.Random(order).sample(rows, len(rows))
        state = spark.createDataFrame([], CHANGES_V1)
        for at in range(0, len(rows), 15):
            batch = ch.latest_changes(spark.createDataFrame(shuffled[at : at + 15], CHANGES_V1))
            state = spark.createDataFrame(ch.merge_in_order(state, batch, limit=limit).collect(), CHANGES_V1)
        states.append(Counter(tuple(r) for r in state.collect()))
    last = {}
    for row in rows:
        last[row[1]] = max(last.get(row[1], row), row, key=lambda r: (r[2], r[0]))
    assert states == [Counter(last.values())] * 3


@pytest.mark.parametrize("seed", [1, 2])
def test_no_version_vanishes_and_none_overlap(spark, seed):
    schema = "sk string, id long, segment string, start_date date, end_date date"
    versions = spark.createDataFrame([], schema)
    days = random.Random(seed).sample(range(1, 10), 9)
    for n, day in enumerate(days):
        batch = ch.latest_changes(spark.createDataFrame(feed_rows(seed + day, 8), CHANGES_V1))
        before = {(r.id, r.start_date): r for r in versions.collect()}
        run_date = date(2024, 1, day)
        after = apply_to_history(versions, batch, ["segment"], run_date.isoformat(), limit=(n % 2) << 20).collect()
        now = {(r.id, r.start_date): r for r in after}
        assert all(k in now or k[1] == run_date for k in before)
        for key in {r.id for r in after}:
            own = sorted((r for r in after if r.id == key), key=lambda r: r.start_date)
            assert all(a.end_date is not None and a.end_date <= b.start_date for a, b in zip(own, own[1:], strict=False))
        versions = spark.createDataFrame(after, schema)


def test_gold_takes_the_rates_of_earlier_value_dates(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    txn = [("A", "d", "x", None, "2024-01-04", 10, "USD", None, None, 1, DAY)]
    rows = spark.createDataFrame(txn, ", ".join(f"{f.name} {'int' if f.name.endswith('amt') else 'string'}" for f in BRONZE))
    sink.write_day(rows.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE]), paths.bronze, DAY)
    fx = spark.createDataFrame([("2024-01-03", "SGD", "USD", 2)], "run_date string, base_currency string, target_currency string, rate_to_sgd int")
    sink.write_fx(fx.withColumn("rate_to_sgd", F.col("rate_to_sgd").cast(FX_RATES["rate_to_sgd"].dataType)), paths.fx)
    assert daily.run_gold(spark, paths, DAY)["output_count"] == 1
    assert daily.run_gold(spark, paths, DAY, max_lag_days=0)["output_count"] == 0
    rejected = lake.read_day(spark, paths.gold_reject, DAY).collect()
    assert [r.reject_reason for r in rejected] == ["unknown_currency"] and "account_no" not in rejected[0]


def test_doubled_rates_are_refused_before_anything_is_written(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    sink.write_day(spark.createDataFrame([], TRANSACTIONS), paths.bronze, DAY)
    fx = spark.createDataFrame([(DAY, "SGD", "USD")] * 2, "run_date string, base_currency string, target_currency string")
    sink.write_fx(fx.withColumn("rate_to_sgd", F.lit(2).cast(FX_RATES["rate_to_sgd"].dataType)), paths.fx)
    jobs = [
        lambda: daily.run_currency_aggregate(spark, paths, DAY),
        lambda: daily.run_silver_detail(spark, paths, DAY),
        lambda: daily.run_gold(spark, paths, DAY),
        lambda: daily.run_backfill(spark, paths, DAY, "2024-01-06"),
        lambda: daily.run_detail_backfill(spark, paths, DAY, "2024-01-06"),
    ]
    for job in jobs:
        with pytest.raises(ValueError, match="more than one rate"):
            job()
    assert not (tmp_path / "silver").exists() and not (tmp_path / "gold").exists()


def test_a_reply_without_rates_is_an_error(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    reply = tmp_path / "reply.json"
    reply.write_text(json.dumps({"timestamp": 0, "base": "SGD", "rates": {"USD": "n/a", "EUR": None}}))
    with pytest.raises(ValueError, match="no rates"):
        daily.run_fx_ingest(spark, str(reply), paths, DAY)
    assert lake.read_day(spark, paths.fx_reject, DAY).count() == 2
    reply.write_text(json.dumps({"timestamp": 0, "base": "SGD", "rates": {"USD": "n/a", "EUR": 1.5}}))
    daily.run_fx_ingest(spark, str(reply), paths, DAY)
    assert [float(r.rate_to_sgd) for r in lake.read_fx_days(spark, paths.fx, DAY, "2024-01-06").collect()] == [1.5]


def test_periods_list_their_folders_only(spark, tmp_path):
    days = spark.createDataFrame([(f"2024-{m:02d}-{d:02d}", m) for m in (1, 2, 3) for d in (1, 2)], "day string, v int")
    sink.write_dates(days, str(tmp_path / "l"), "day")
    (tmp_path / "l" / "day=2024-03-09").mkdir()
    (tmp_path / "l" / "day=2024-03-09" / "broken.parquet").write_text("not read")
    read = lake.read_days(spark, str(tmp_path / "l"), "2024-01-02", "2024-02-02", "day")
    assert Counter(r.day for r in read.collect()) == {"2024-01-02": 1, "2024-02-01": 1}
    assert lake.read_days(spark, str(tmp_path / "l"), "2025-01-01", "2025-02-01", "day").count() == 0
    assert len(lake.period_folders("r", "2000-01-01", "2020-01-01", ("%Y-%m-%d", "%Y-%m-*", "%Y-*")).split(",")) == 20


def test_large_lookups_are_shuffled(spark):
    facts = spark.range(1000).withColumn("k", F.col("id") % 5)
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plan = joins.split_join(facts, lookup, ["k"], "left")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    plan = new_facts(facts, facts.select("id"), "id", limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_warehouse_commands(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda name: spark)
    root, csv = str(tmp_path / "w"), tmp_path / "changes"
    csv.mkdir()
    header = "seq,id,updated_at,op,segment,value,email,phone\n"
    (csv / "1.csv").write_text(header + "1,1,2024-01-01 10:00:00,I,a,1.0,e,p\n2,x,2024-01-01 10:00:00,I,a,1.0,e,p\n")
    (csv / "2.csv").write_text(header + "3,1,2024-01-02 10:00:00,U,b,1.0,e,p\n4,2,2024-01-02 09:00:00,?,b,1.0,e,p\n")
    for name, job in (("1", "initial-load"), ("2", "batch")):
        delivery = ["--warehouse", root, "--delivery", f"2024-01-0{name}"]
        command.main(["change-feed", *delivery, "--changes", str(csv / f"{name}.csv")])
        command.main([job, *delivery, *(["--previous", "2024-01-01"] if job == "batch" else [])])
    feed, paths = warehouse.Feed(command.CHANGES, ("segment",)), WarehousePaths.under(root)
    assert [(r.id, r.segment) for r in warehouse.read_state(spark, feed, paths, "2024-01-02").collect()] == [(1, "b")]
    assert warehouse.read_dimension(spark, feed, paths, "2024-01-02").count() == 2
    assert lake.read_day(spark, paths.change_reject, "2024-01-02", "delivery").count() == 1
    assert spark.read.parquet(f"{paths.change_reject}_lines").count() == 1
    spark.createDataFrame([(1, 1, date(2024, 1, 2))], "f int, id long, day date").write.parquet(str(tmp_path / "f"))
    for _ in range(2):
        command.main(["fact-load", *delivery, "--facts", str(tmp_path / "f"), "--fact-id", "f", "--fact-date", "day",
                      "--since", "2024-01-01", "--until", "2024-02-01"])
    assert [r.id for r in spark.read.parquet(paths.fact).where("sk is not null").collect()] == [1]
    command.main(["compact", "--source", paths.fact, "--destination", str(tmp_path / "c"), "--since", "2024-01-01",
                  "--until", "2024-02-01", "--partition", "date"])
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1
