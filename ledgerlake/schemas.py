"""Table schemas. Money is decimal, so that sums do not depend on row order."""

from pyspark.sql import types as T

# Four places hold currencies with mills, twelve hold rates of currencies of small units. A product
# of both is exact: 18 + 18 + 1 <= 38 digits.
MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(18, 12)
# Sum of MONEY; times RATE it has 41 digits, of which Spark keeps 13 places.
MONEY_TOTAL = T.DecimalType(22, 4)

INGESTION_DATE = "ingestion_date"

TRANSACTIONS = T.StructType(
    [
        T.StructField("account_no", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("transaction_details", T.StringType()),
        T.StructField("chq_no", T.StringType()),
        T.StructField("value_date", T.StringType()),
        T.StructField("withdrawal_amt", MONEY),
        T.StructField("withdrawal_currency", T.StringType()),
        T.StructField("deposit_amt", MONEY),
        T.StructField("deposit_currency", T.StringType()),
        T.StructField("balance_amt", MONEY),
    ]
)

BRONZE = T.StructType(TRANSACTIONS.fields + [T.StructField(INGESTION_DATE, T.StringType())])

# A bronze row, masked and converted, or with the reason of its rejection.
GOLD = T.StructType(
    [field for field in BRONZE.fields if field.name != "account_no"]
    + [
        T.StructField("account_no_hash", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("rate_to_sgd", RATE),
        T.StructField("amount_sgd", T.DoubleType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)

LONG_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_no", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value_date", T.StringType()),
    ]
)

FX_RATES = T.StructType(
    [
        T.StructField("run_date", T.StringType()),
        T.StructField("base_currency", T.StringType()),
        T.StructField("target_currency", T.StringType()),
        T.StructField("rate_to_sgd", RATE),
    ]
)

# One reply of the rates service, as landed: a cell that is no rate must not spoil the others.
FX_SNAPSHOT = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("base", T.StringType()),
        T.StructField("rates", T.MapType(T.StringType(), T.StringType())),
    ]
)

CHANGES_V1 = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("op", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

CHANGES = T.StructType(
    CHANGES_V1.fields
    + [T.StructField("email", T.StringType()), T.StructField("phone", T.StringType())]
)
