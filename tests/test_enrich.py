from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions.keys import row_hash
from ledgerlake.operators import aggregate, enrich, joins, project
from ledgerlake.plans import daily
from ledgerlake.schemas import FX_RATES

TXN = "value_date string, withdrawal_amt decimal(18,2), withdrawal_currency string, " \
    "deposit_amt decimal(18,2), deposit_currency string"
D = Decimal


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def fx(spark):
    days = [
        ("2024-01-01", "USD", "1.5"),
        ("2024-01-02", "USD", "1.6"),
        ("2024-01-01", "EUR", "2.0"),
        ("2024-01-02", "EUR", None),
        ("2024-01-02", "ZRO", "0"),
    ]
    return spark.createDataFrame(
        [(d, "SGD", c, None if r is None else D(r)) for d, c, r in days], FX_RATES
    )


@pytest.fixture(scope="module")
def txn(spark):
    return spark.createDataFrame(
        [
            ("2024-01-02", D(10), "USD", None, None),
            ("2024-01-02", D(20), "USD", None, None),
            ("2024-01-02", None, None, D(30), "EUR"),
            ("2024-01-02", None, None, D(40), "ZRO"),
            ("2024-01-02", None, None, D(50), "XXX"),
            ("2024-01-03", D(60), "USD", D(70), "EUR"),
            ("2024-01-03", D(80), None, None, None),
        ],
        TXN,
    )


def test_daily_aggregate(txn, fx):
    day = fx.where("run_date = '2024-01-02'")
    out = daily.currency_aggregate(txn, day, "2024-01-02")
    assert out.columns == ["currency", "txn_count", "total_value_sgd", "ingestion_date"]
    assert rows(out) == Counter(
        [("USD", 3, 144.0, "2024-01-02"), ("ZRO", 1, 0.0, "2024-01-02")]
    )
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "bigint", "double", "string"]


def test_zero_rate_divides_to_null(txn, fx):
    day = fx.where("run_date = '2024-01-02'")
    out = {r["currency"]: r["total_value_sgd"] for r in daily.currency_aggregate(txn, day, "d", "divide").collect()}
    assert out["ZRO"] is None
    assert out["USD"] == 90 / 1.6


def test_amounts_may_be_doubles(txn, fx):
    doubles = txn.withColumn("withdrawal_amt", F.col("withdrawal_amt").cast("double")).withColumn(
        "deposit_amt", F.col("deposit_amt").cast("double")
    )
    day = fx.where("run_date = '2024-01-02'")
    out = daily.currency_aggregate(doubles, day, "d")
    assert {r["currency"]: r["total_value_sgd"] for r in out.collect()} == {"USD": 144.0, "ZRO": 0.0}


def test_unknown_rate_mode():
    with pytest.raises(ValueError, match="rate_mode"):
        enrich.to_sgd("amount", "rate_to_sgd", "add")


def test_doubled_rate_counts_twice_as_row_by_row(spark, txn):
    doubled = spark.createDataFrame(
        [("d", "SGD", "USD", D("1.5")), ("d", "SGD", "USD", D("1.6")), ("d", "SGD", "EUR", D(2))], FX_RATES
    )
    fast = daily.currency_aggregate(txn, doubled, "d")
    valid = txn.transform(project.add_currency_column).transform(project.add_amount_column)
    slow = project.convert_to_sgd(enrich.enrich_with_fx(valid, enrich.day_rates(doubled)))
    assert rows(fast) == rows(aggregate.aggregate_by_currency(slow, "d"))
    assert [r["target_currency"] for r in enrich.duplicate_rates(doubled).collect()] == ["USD"]
    with pytest.raises(ValueError, match="more than one rate"):
        enrich.require_unique_rates(doubled)


def test_fallback_takes_the_nearest_known_rate(fx):
    got = {(r["value_date"], r["currency"]): r["rate_to_sgd"] for r in enrich.effective_rates(fx, 1).collect()}
    assert got[("2024-01-02", "USD")] == D("1.6")
    assert got[("2024-01-02", "EUR")] == D("2")  # the day itself has no rate
    assert got[("2024-01-03", "USD")] == D("1.6")
    assert ("2024-01-03", "EUR") not in got


def test_both_sides_keep_no_rate_columns(txn, fx):
    out = enrich.convert_both_sides(txn, fx)
    assert out.columns == [*txn.columns, "deposit_sgd_amt", "withdrawal_sgd_amt"]
    by_amount = {r["deposit_amt"]: r for r in out.collect()}
    assert by_amount[D(40)]["deposit_sgd_amt"] is None  # zero rate
    assert out.count() == txn.count()


def test_both_sides_compare_trimmed(spark, fx):
    padded = spark.createDataFrame([("2024-01-02", D(16), " USD ", None, None)], TXN)
    assert enrich.convert_both_sides(padded, fx).first()["withdrawal_sgd_amt"] == 10.0


def test_gold_keeps_every_row(spark, txn, fx):
    gold = daily.gold_rows(txn.withColumn("account_no", F.lit(" A1 ")), fx)
    assert gold.count() == txn.count()
    reasons = Counter(r["reject_reason"] for r in gold.collect())
    assert reasons == Counter(
        {None: 4, "unknown_currency": 1, "both_amounts": 1, "no_currency": 1}
    )
    assert "account_no" not in gold.columns
    counts = gold.agg(*aggregate.quality_counters()).first()
    assert counts["input_count"] == counts["valid_count"] + counts["reject_count"]
    assert counts["valid_count"] == counts["output_count"] + counts["unknown_currency_count"]


# --- joins --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, a third has none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(F.lit("k"), (n % 50).cast("string")))
    return spark.range(3000, numPartitions=6).select(key.alias("k"), (n % 7).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(spark, skewed, how):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k4", 3), ("k4", 4), (None, 5), ("no", 6)], "k string, r int")
    plain = skewed.join(lookup, "k", how)
    assert rows(joins.split_join(skewed, lookup, ["k"], how)) == rows(plain)
    assert rows(joins.lookup_join(skewed, lookup, ["k"], how, limit=0)) == rows(plain)
    assert rows(joins.lookup_join(skewed, lookup, ["k"], how)) == rows(plain)


def test_split_join_spreads_the_hot_key_and_the_null_key(spark, skewed):
    lookup = spark.createDataFrame([("hot", 1)], "k string, r int")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.split_join(skewed, lookup, ["k"], "left")
        tasks = joined.groupBy("k", F.spark_partition_id().alias("p")).count()
        per_key = {r["k"]: r["n"] for r in tasks.groupBy("k").agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert per_key["hot"] > 1
    assert per_key[None] > 1


def test_salts_are_the_same_when_computed_again(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "t"))
    again = [rows(spark.read.parquet(str(tmp_path / "t")).withColumn("h", row_hash(["k", "v"]))) for _ in range(2)]
    assert again[0] == again[1]
    copies = skewed.where("k = 'hot' AND v = 0").select(row_hash(["k", "v"]).alias("h"))
    assert copies.distinct().count() > 1  # copies in different partitions


def test_hot_keys_are_fewer_than_partitions(spark, skewed):
    hot = {r["k"]: r["__salts"] for r in joins.hot_keys(skewed, ["k"]).collect()}
    assert hot.keys() == {"hot", None}
    assert len(hot) < int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(n > 1 for n in hot.values())


def test_split_join_refuses_joins_that_return_the_lookup(spark, skewed):
    with pytest.raises(ValueError, match="full"):
        joins.split_join(skewed, skewed, ["k"], "full")


def test_size_is_measured_not_guessed(spark):
    wide_text = spark.range(1000).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.measured_bytes(wide_text) > 1_000_000
    assert not joins.fits_broadcast(wide_text, 1_000_000)
    with pytest.raises(TypeError):
        joins.measured_bytes(spark.range(1).select(F.array("id").alias("a")))


def test_salted_totals_equal_plain_totals(skewed):
    txn = skewed.withColumn("amount", F.col("v").cast("decimal(18,2)"))
    plain = aggregate.currency_totals(txn, "k")
    assert rows(aggregate.salted_totals(txn, ["k"], 4)) == rows(plain)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.decimals(-999, 999, places=2)), min_size=1, max_size=30
    ),
    st.lists(st.sampled_from(["a", "b", "c"]), max_size=4),
)
def test_pricing_totals_equals_pricing_rows(spark, transactions, currencies):
    txn = spark.createDataFrame(transactions, "currency string, amount decimal(18,2)")
    rates = spark.createDataFrame([(c, D("1.25")) for c in currencies], "currency string, rate_to_sgd decimal(12,6)")
    fast = aggregate.price_totals(aggregate.currency_totals(txn, "currency"), rates, ["currency"])
    slow = (
        txn.join(rates, "currency")
        .groupBy("currency")
        .agg(F.count("*").alias("n"), F.sum(F.col("amount") * F.col("rate_to_sgd")).cast("double").alias("v"))
    )
    assert rows(fast) == rows(slow)


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("x", 1), ("z", 9)], "k string, v int")
    out = {r["k"]: (r["source_count"], r["target_count"], r["source_v"], r["target_v"], r["ok"])
           for r in aggregate.reconcile(a, b, ["k"], ["v"]).collect()}
    assert out == {"x": (2, 2, 3, 3, True), "y": (1, 0, 3, 0, False), "z": (0, 1, 0, 9, False)}


# --- plans --------------------------------------------------------------------------------


def physical(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_aggregate_has_one_shuffle_of_partial_sums(txn, fx, spark, tmp_path):
    txn.write.parquet(str(tmp_path / "t"))
    fx.where("run_date = '2024-01-02'").write.parquet(str(tmp_path / "fx"))
    plan = physical(
        daily.currency_aggregate(
            spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "fx")), "d"
        )
    )
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan and "partial_count" in plan
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_detail_joins_do_not_shuffle(txn, fx):
    for df in (
        enrich.convert_both_sides(txn, fx),
        daily.silver_detail(txn, fx.where("run_date = '2024-01-02'"), "2024-01-02"),
    ):
        plan = physical(df)
        assert "Exchange hashpartitioning" not in plan
        assert "BroadcastHashJoin" in plan
