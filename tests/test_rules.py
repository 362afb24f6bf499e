from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.validate import (
    SchemaMismatch,
    split_by_reason,
    validate_data,
    validate_schema,
    validate_transactions,
    with_reject_reason,
)
from ledgerlake.schemas import MONEY

SIDES = T.StructType(
    [
        T.StructField("n", T.IntegerType()),
        T.StructField("withdrawal_amt", MONEY),
        T.StructField("withdrawal_currency", T.StringType()),
        T.StructField("deposit_amt", MONEY),
        T.StructField("deposit_currency", T.StringType()),
    ]
)
# row number: (withdrawn, its currency, deposited, its currency), reason
ROWS = {
    1: (("5", "USD", None, None), None),
    2: ((None, None, "5", "EUR"), None),
    3: (("0", "USD", None, None), None),
    4: (("5", "USD", "5", "EUR"), "both_amounts"),
    5: ((None, "USD", None, None), "no_amount"),
    6: (("-1", "USD", None, None), "negative_amount"),
    7: (("5", "USD", None, "EUR"), "both_currencies"),
    8: (("5", None, None, None), "no_currency"),
    9: (("5", "  ", None, None), "no_currency"),
    10: (("5", None, None, "EUR"), "side_mismatch"),
    11: ((None, "USD", "5", None), "side_mismatch"),
    12: ((None, None, None, None), "no_amount"),
    13: (("-1", "USD", "5", "EUR"), "both_amounts"),
}


@pytest.fixture(scope="module")
def wide(spark):
    money = lambda text: None if text is None else Decimal(text)
    return spark.createDataFrame(
        [(n, money(a), b, money(c), d) for n, ((a, b, c, d), _) in ROWS.items()], SIDES
    )


def numbers(df):
    return {row["n"] for row in df.select("n").collect()}


def test_reasons(wide):
    found = {r["n"]: r["reject_reason"] for r in with_reject_reason(wide).collect()}
    assert found == {n: reason for n, (_, reason) in ROWS.items()}


def test_split_is_complete(wide):
    valid, rejected = split_by_reason(with_reject_reason(wide))
    assert numbers(valid) == {n for n, (_, reason) in ROWS.items() if reason is None}
    assert numbers(valid) | numbers(rejected) == set(ROWS)
    assert "reject_reason" not in valid.columns


def test_live_rule_checks_amount_and_currency_apart(wide):
    assert numbers(validate_transactions(wide)) == {1, 2, 3, 4, 6, 7, 9, 10, 11, 13}


def test_two_rule_check_loses_negative_amounts(wide):
    valid, rejected = validate_data(wide)
    assert numbers(rejected) == {4, 13}
    assert numbers(valid) == set(ROWS) - {4, 13, 6}


def test_live_rule_reaches_the_scan(spark, wide, tmp_path):
    wide.write.parquet(str(tmp_path / "t"))
    plan = validate_transactions(spark.read.parquet(str(tmp_path / "t")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "Or(IsNotNull(withdrawal_amt)" in pushed


def test_schema_by_name(wide):
    assert validate_schema(wide, ["n", "deposit_amt"]) is wide
    with pytest.raises(SchemaMismatch, match="balance_amt"):
        validate_schema(wide, ["n", "balance_amt"])


def test_schema_by_type(wide):
    assert validate_schema(wide, SIDES) is wide
    with pytest.raises(SchemaMismatch, match="deposit_amt"):
        validate_schema(wide.withColumn("deposit_amt", F.col("deposit_amt").cast("double")), SIDES)
