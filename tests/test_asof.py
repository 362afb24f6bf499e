"""Odd dates, rates of a batch's own days, the as-of join and sweeps over versions."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.dates import day_reason, known_day, normal_day
from ledgerlake.operators import asof
from ledgerlake.operators.history import build_history, lookup_version
from ledgerlake.plans import daily
from ledgerlake.plans.layout import LakePaths
from ledgerlake.schemas import BRONZE, CHANGES_V1, FX_RATES
from ledgerlake.sinks import lake as sink
from ledgerlake.sources import lake

DAY = "2024-01-05"
D = lambda n: date(2020, 1, 1) + timedelta(days=n)


def test_days_as_text(spark):
    cells = ["2024-01-05", " 2024-1-5 ", "0001-01-01", "9999-12-31", "+12024-01-01", "2024-02-30", "2024", "", " ", None, "5.1.2024"]
    rows = spark.createDataFrame([(c,) for c in cells], "d string")
    found = rows.select("d", known_day("d").cast("string"), normal_day("d"), day_reason("d")).collect()
    assert [r[1] for r in found] == ["2024-01-05"] * 2 + [None] * 9
    assert [r[2] for r in found][:5] == ["2024-01-05", "2024-01-05", "0001-01-01", "9999-12-31", "+12024-01-01"]
    assert [r[3] for r in found] == [None, None] + ["date_out_of_range"] * 2 + ["bad_date"] * 3 + ["no_date"] * 3 + ["bad_date"]


def bronze(spark, paths, days):
    txn = [("A", "d", "x", None, day, 10, "USD", None, None, 1, DAY) for day in days]
    rows = spark.createDataFrame(txn, ", ".join(f"{f.name} {'int' if f.name.endswith('amt') else 'string'}" for f in BRONZE))
    sink.write_day(rows.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE]), paths.bronze, DAY)


def rates(spark, days):
    fx = spark.createDataFrame([(d, "SGD", "USD", 2) for d in days], "run_date string, base_currency string, target_currency string, rate_to_sgd int")
    return fx.withColumn("rate_to_sgd", F.col("rate_to_sgd").cast(FX_RATES["rate_to_sgd"].dataType))


def test_gold_survives_any_date_and_prunes_rates(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    bronze(spark, paths, ["2024-01-04", "2001-7-9", "0001-01-01", "9999-12-31", "+12024-01-01", None, "", "2024-01-04"])
    sink.write_fx(rates(spark, ["2024-01-03", "2001-07-09", "2010-01-01", "2015-05-05"]), paths.fx)
    counters = daily.run_gold(spark, paths, DAY)
    assert counters["output_count"] == 3
    rejected = Counter(r.reject_reason for r in lake.read_day(spark, paths.gold_reject, DAY).collect())
    assert rejected == {"date_out_of_range": 2, "bad_date": 1, "no_date": 2}
    days = spark.createDataFrame([(date(2024, 1, 3),), (date(2001, 7, 9),), (date(1, 1, 1),)], "day date")
    days.write.parquet(str(tmp_path / "days"))
    read = lake.read_fx_of_days(spark, paths.fx, spark.read.parquet(str(tmp_path / "days")))
    assert {r.run_date for r in read.collect()} == {"2024-01-03", "2001-07-09"}
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()


def test_gold_without_rates_or_rows(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    bronze(spark, paths, ["2024-01-04"])
    assert daily.run_gold(spark, paths, DAY)["output_count"] == 0
    bronze(spark, paths, [])
    assert daily.run_gold(spark, paths, DAY)["output_count"] == 0


def test_bronze_has_one_spelling_and_rejects_what_is_no_date(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    rows = [("A1", "2024-1-5"), ("A2", "05/01/2024"), ("A3", " "), ("A4", "9999-12-31")]
    sink.write_day(spark.createDataFrame(rows, "account_no string, value_date string"), paths.raw, DAY)
    daily.run_bronze(spark, paths, DAY)
    found = lake.read_day(spark, paths.bronze, DAY).collect()
    assert {(r.account_no, r.value_date) for r in found} == {("A1", "2024-01-05"), ("A3", ""), ("A4", "9999-12-31")}
    rejected = lake.read_day(spark, paths.reject, DAY).collect()
    assert [(r.value_date, r.reject_reason) for r in rejected] == [("05/01/2024", "unparsed_value_date")]


def test_dates_are_parsed_once_and_typed_cells_are_not_tried(spark, tmp_path):
    """the check of a row repeated the parsing of its date, and tried cells of the right type."""
    cells = "'A' AS account_no, CAST(1 AS DECIMAL(18,4)) AS balance_amt, '1,5' AS withdrawal_amt"
    spark.sql(f"SELECT {cells}, d AS value_date FROM VALUES ('2024-1-5'), ('x'), (' '), (NULL) t(d)").write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    checked = daily.checked_rows(raw, DAY)
    refused = checked.where("reject_reason IS NOT NULL")
    plan = refused._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line)
    assert condition.count("RLIKE") <= 1 and "balance_amt" not in condition
    fine = checked.withColumn("withdrawal_amt", F.lit("1")).collect()
    assert {(r.value_date, r.reject_reason) for r in fine} == {(d, "unparsed_withdrawal_amt") for d in ("2024-01-05", "x", "", None)}
    dates = daily.checked_rows(raw.withColumn("withdrawal_amt", F.lit("1.5")), DAY).collect()
    assert {(r.value_date, r.reject_reason) for r in dates} == {("2024-01-05", None), ("x", "unparsed_value_date"), ("", None), (None, None)}


def test_masked_lines_hold_no_account(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "lake"))
    names = [f.name for f in BRONZE.fields[:-1]]
    lines = ["A77,d,about,,2024-01-05,x,USD,,,2", '"B,88",short', " C99 ,d,x,,2024-01-05,1.00,USD,,,2,extra C99", ",d,x,,2024-01-05,bad,USD,,,2"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("\n".join([",".join(names), *lines, ""]))
    daily.run_bronze_from_csv(spark, str(tmp_path / "in"), paths, DAY, mask=True)
    rejected = lake.read_day(spark, paths.reject, DAY)
    assert "account_no" not in rejected.columns and rejected.count() == 4
    text = " ".join(str(tuple(r)) for r in rejected.collect())
    assert not any(account in text for account in ("A77", "B,88", "C99"))


def slow(facts, lookup):
    out = []
    for n, k, t in facts:
        own = [(at, v) for key, at, v in lookup if k is not None and t is not None and key == k and at is not None and at <= t]
        out.append((n, k, t, *(max(own)[::-1] if own else (None, None))))
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_of_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 6 + ["b", "c", None])
    facts = [(n, key(), None if rng.random() < 0.05 else D(rng.choice([100, rng.randint(0, 400)]))) for n in range(400)]
    lookup = list({(k, t): (k, t, n) for n in range(60) for k, t in [(key(), None if rng.random() < 0.05 else D(rng.randint(0, 1200)))]}.values())
    lookup += [("c", D(50), 1000), ("c", D(50), 2000)]
    left = spark.createDataFrame(facts, "n int, k string, t date").repartition(5)
    right = spark.createDataFrame(lookup, "key string, at date, v int").withColumnRenamed("key", "k")
    found = asof.asof_join(left, right.withColumn("since", F.col("at")), ["k"], "t", "at", ["v", "since"])
    assert found.columns == ["n", "k", "t", "v", "since"]
    assert Counter(map(tuple, found.collect())) == slow(facts, lookup)


def test_one_key_and_moment_is_spread(spark):
    facts = spark.range(4000).select(F.lit("k").alias("k"), F.lit(D(9)).alias("t"), "id").repartition(4)
    lookup = spark.createDataFrame([("k", D(9), 5), ("k", D(1), 4)], "k string, at date, v int")
    found = asof.asof_join(facts, lookup, ["k"], "t", "at", ["v"])
    assert found.where("v = 5").count() == 4000
    ranges = spark.read.parquet(*[f for f in found.inputFiles()]).groupBy("__part").count().collect()
    assert len(ranges) > 4 and max(r["count"] for r in ranges) < 2000


def test_as_of_without_rows(spark):
    facts = spark.createDataFrame([("k", D(1))], "k string, t date")
    lookup = spark.createDataFrame([], "k string, at date, v int")
    assert asof.asof_join(facts, lookup, ["k"], "t", "at", ["v"]).collect() == [("k", D(1), None)]
    assert asof.asof_join(facts.limit(0), lookup, ["k"], "t", "at", ["v"]).collect() == []


def test_rates_of_long_ago_serve(spark):
    txn = spark.createDataFrame([("USD", "2024-06-01"), ("USD", "2020-01-01"), ("EUR", "2024-06-01"), (None, "2024-06-01"), ("USD", "x")], "currency string, value_date string")
    found = asof.asof_rates(txn, rates(spark, ["2022-02-02", "2024-06-02"])).collect()
    assert Counter((r.currency, r.value_date, r.rate_date) for r in found) == Counter([
        ("USD", "2024-06-01", date(2022, 2, 2)), ("USD", "2020-01-01", None), ("EUR", "2024-06-01", None),
        (None, "2024-06-01", None), ("USD", "x", None),
    ])


def test_sweep_equals_the_monthly_lookup(spark):
    rng = random.Random(4)
    changes = [(n, rng.randint(1, 5), None, rng.choice("IUD"), rng.choice("ab"), 1.0) for n in range(60)]
    feed = spark.createDataFrame(changes, CHANGES_V1).withColumn("updated_at", F.lit(D(0)).cast("timestamp_ntz") + F.make_dt_interval((F.col("seq") * 37 % 900).cast("int")))
    dimension = spark.createDataFrame(build_history(feed, ["segment"]).collect(), "sk string, id long, segment string, start_date date, end_date date")
    facts = spark.createDataFrame([(n, rng.randint(1, 6), D(rng.randint(-50, 1000))) for n in range(300)], "n int, id long, day date")
    wanted = lookup_version(facts, dimension, "day", "2019-01-01", "2024-01-01")
    swept = asof.versions_by_sweep(facts, dimension, "day")
    assert swept.columns == wanted.columns
    assert Counter(map(tuple, swept.collect())) == Counter(map(tuple, wanted.collect()))
    assert "Generate" not in swept._jdf.queryExecution().optimizedPlan().toString()
