"""The SQL that each registered query is checked against, for DuckDB."""

from __future__ import annotations

from ledgerlake.checks.fixtures import BATCH_DATE, RUN_DATE
from ledgerlake.checks.queries import FIX_DATE, V2_SINCE

_TXN = """
txn0 AS (SELECT l.*, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS vd,
   CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN '   '
        WHEN l_partkey % 11 = 0 THEN ' C' || lpad(CAST(l_suppkey % 30 AS VARCHAR), 2, '0') || ' '
        ELSE 'C' || lpad(CAST(l_suppkey % 30 AS VARCHAR), 2, '0') END AS ccy,
   CAST(CAST(CASE WHEN l_partkey % 47 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,4))
     + CASE WHEN l_partkey % 29 = 0 THEN 0.005 ELSE 0.000 END AS DECIMAL(20,4)) AS amt,
   CASE WHEN l_orderkey % 50 = 0 THEN 'B' WHEN l_orderkey % 53 = 0 THEN 'X'
        WHEN l_returnflag = 'R' THEN 'W' ELSE 'D' END AS side
 FROM lineitem l),
txn AS (SELECT ' AC' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS account_no,
   vd AS value_date, l_linestatus AS transaction_details,
   CASE WHEN side IN ('W','B') THEN amt END AS withdrawal_amt,
   CASE WHEN side IN ('W','B') THEN ccy END AS withdrawal_currency,
   CASE WHEN side IN ('D','B') THEN amt END AS deposit_amt,
   CASE WHEN side IN ('D','B') THEN ccy END AS deposit_currency,
   CAST(l_quantity AS DECIMAL(18,4)) AS balance_amt, l_orderkey, l_linenumber FROM txn0),
clean AS (SELECT * REPLACE (trim(account_no) AS account_no,
   trim(withdrawal_currency) AS withdrawal_currency, trim(deposit_currency) AS deposit_currency)
 FROM txn)"""

_FX = """
cal AS (SELECT n_nationkey, CAST(unnest(range(DATE '1995-01-01', DATE '2001-11-05', INTERVAL 1 DAY)) AS DATE) AS dt
 FROM nation),
fx_all AS (SELECT CAST(dt AS VARCHAR) AS run_date, 'SGD' AS base_currency,
   'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS currency,
   CASE WHEN n_nationkey = 24 THEN NULL
        WHEN n_nationkey = 23 THEN CAST(0.0000113456 + (year(dt) - 1995) * 0.0000001 AS DECIMAL(18,12))
        ELSE CAST(0.5 + n_nationkey * 0.05 + (year(dt) - 1995) * 0.01 AS DECIMAL(18,12)) END AS rate
 FROM cal WHERE (day(dt) + n_nationkey) % 9 <> 0)"""


def _valid(source: str, name: str = "valid") -> str:
    return f"""
{name} AS (SELECT *, coalesce(withdrawal_currency, deposit_currency) AS currency,
   coalesce(withdrawal_amt, deposit_amt) AS amount FROM {source}
 WHERE (withdrawal_amt IS NOT NULL OR deposit_amt IS NOT NULL)
   AND (withdrawal_currency IS NOT NULL OR deposit_currency IS NOT NULL))"""


_VALID = _valid("clean")
_DAY_FX = f"""
fx AS (SELECT currency, rate FROM fx_all WHERE run_date = '{RUN_DATE}' AND rate IS NOT NULL)"""
_EFFECTIVE = """
eff AS (SELECT run_date, currency, rate FROM fx_all WHERE rate IS NOT NULL
 UNION ALL
 SELECT CAST(CAST(p.run_date AS DATE) + 1 AS VARCHAR), p.currency, p.rate FROM fx_all p
 WHERE p.rate IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_all s WHERE s.rate IS NOT NULL
   AND s.currency = p.currency AND s.run_date = CAST(CAST(p.run_date AS DATE) + 1 AS VARCHAR)))"""
_REASON = """CASE
   WHEN withdrawal_amt IS NOT NULL AND deposit_amt IS NOT NULL THEN 'both_amounts'
   WHEN withdrawal_amt IS NULL AND deposit_amt IS NULL THEN 'no_amount'
   WHEN coalesce(withdrawal_amt, 0) < 0 OR coalesce(deposit_amt, 0) < 0 THEN 'negative_amount'
   WHEN nullif(trim(withdrawal_currency), '') IS NOT NULL
    AND nullif(trim(deposit_currency), '') IS NOT NULL THEN 'both_currencies'
   WHEN nullif(trim(withdrawal_currency), '') IS NULL
    AND nullif(trim(deposit_currency), '') IS NULL THEN 'no_currency'
   WHEN (withdrawal_amt IS NOT NULL) <> (nullif(trim(withdrawal_currency), '') IS NOT NULL)
   THEN 'side_mismatch' END"""


def _gold(rates: str) -> str:
    return f"""
gold AS (SELECT c.l_orderkey, c.l_linenumber, sha256(account_no) AS account_no_hash, value_date,
   withdrawal_amt, nullif(withdrawal_currency, '') AS withdrawal_currency,
   deposit_amt, nullif(deposit_currency, '') AS deposit_currency, r.rate,
   coalesce(nullif(withdrawal_currency, ''), nullif(deposit_currency, '')) AS currency,
   coalesce(withdrawal_amt, deposit_amt) AS amount,
   coalesce({_REASON}, CASE WHEN r.rate IS NULL THEN 'unknown_currency' END) AS reject_reason
 FROM clean c LEFT JOIN {rates} r ON r.run_date = c.value_date
  AND r.currency = coalesce(nullif(withdrawal_currency, ''), nullif(deposit_currency, '')))"""


_CDC = """
cdc AS (SELECT event_id AS seq, user_id AS id, ts AS updated_at,
   CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
   event_type AS segment, value FROM events)"""


def _latest(name: str, condition: str = "TRUE") -> str:
    return f"""
{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
   (PARTITION BY id ORDER BY updated_at DESC, seq DESC) AS rn FROM cdc WHERE {condition}) z WHERE rn = 1)"""


_BEFORE = f"updated_at < TIMESTAMP '{BATCH_DATE} 00:00:00'"
_BATCH = f"updated_at >= TIMESTAMP '{BATCH_DATE} 00:00:00'"


def _history(name: str, condition: str = "TRUE") -> str:
    return f"""
{name}_day AS (SELECT id, op = 'D' AS gone, CASE WHEN op <> 'D' THEN segment END AS segment, start_date
 FROM (SELECT *, CAST(updated_at AS DATE) AS start_date, row_number() OVER
   (PARTITION BY id, CAST(updated_at AS DATE) ORDER BY updated_at DESC, seq DESC) AS rn
   FROM cdc WHERE {condition}) z WHERE rn = 1),
{name}_lag AS (SELECT *, lag(gone) OVER w AS was_gone, lag(segment) OVER w AS was_segment
 FROM {name}_day WINDOW w AS (PARTITION BY id ORDER BY start_date)),
{name} AS (SELECT * EXCLUDE (gone, was_gone, was_segment),
   lead(start_date) OVER (PARTITION BY id ORDER BY start_date) AS end_date, gone
 FROM {name}_lag WHERE was_gone IS NULL OR gone <> was_gone OR segment IS DISTINCT FROM was_segment),
{name}_dim AS (SELECT md5(concat_ws(':', id, start_date)) AS sk, id, segment, start_date, end_date
 FROM {name} WHERE NOT gone)"""


def _with(*parts: str) -> str:
    return "WITH" + ",".join(parts[:-1]) + "\n" + parts[-1]


def _q1(source: str, total: str = "CAST(sum(amount * rate) AS DOUBLE)") -> str:
    return _with(
        _TXN, _FX, _valid(source), _DAY_FX,
        f"""SELECT currency, count(*) AS txn_count, {total} AS total_value_sgd,
        '{RUN_DATE}' AS ingestion_date FROM valid JOIN fx USING (currency) GROUP BY currency""",
    )


def _yearly(source: str, name: str) -> str:
    return f"""
{name} AS (SELECT *, substr(value_date, 1, 4) || '-12-31' AS ingestion_date FROM {source})"""


_DETAIL = """currency, CAST(amount AS DOUBLE) AS amount,
  CAST(rate AS DOUBLE) AS rate_to_sgd, CAST(amount * rate AS DOUBLE) AS amount_sgd"""
_ROW = "l_orderkey, l_linenumber"
_SIDES = """CAST(withdrawal_amt AS DOUBLE) AS withdrawal_amt, withdrawal_currency,
  CAST(deposit_amt AS DOUBLE) AS deposit_amt, deposit_currency"""


def _float(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


def _two_sided(columns: str) -> str:
    return _with(
        _TXN, _FX,
        f"""SELECT {_ROW}, value_date, {columns} FROM txn t
        LEFT JOIN fx_all d ON d.run_date = value_date AND d.currency = trim(deposit_currency)
        LEFT JOIN fx_all w ON w.run_date = value_date AND w.currency = trim(withdrawal_currency)""",
    )


def _by_date(rates: str) -> str:
    return _with(
        _TXN, _FX, _VALID, _EFFECTIVE,
        f"""SELECT {_ROW}, value_date, v.{_DETAIL} FROM valid v
        JOIN {rates} r ON r.run_date = v.value_date AND r.currency = v.currency WHERE rate IS NOT NULL""",
    )


_BRONZE = """trim(account_no) AS account_no, value_date AS date, transaction_details,
  CAST(NULL AS VARCHAR) AS chq_no, value_date,
  CAST(withdrawal_amt AS DOUBLE) AS withdrawal_amt, trim(withdrawal_currency) AS withdrawal_currency,
  CAST(deposit_amt AS DOUBLE) AS deposit_amt, trim(deposit_currency) AS deposit_currency,
  CAST(balance_amt AS DOUBLE) AS balance_amt"""
_CHANGE = "seq, id, CAST(updated_at AS VARCHAR) AS updated_at, op, segment, value"
_CONTACTS = f"""CASE WHEN updated_at >= TIMESTAMP '{V2_SINCE} 00:00:00' THEN 'u' || id || '@example.com' END AS email,
  CASE WHEN updated_at >= TIMESTAMP '{V2_SINCE} 00:00:00' THEN lpad(CAST(id AS VARCHAR), 8, '0') END AS phone"""
_DIM = """sk, id, segment, CAST(start_date AS VARCHAR) AS start_date,
  CAST(end_date AS VARCHAR) AS end_date"""
_MERGE = _with(
    _CDC, _latest("old", _BEFORE), _latest("batch", _BATCH),
    """SELECT coalesce(b.id, o.id) AS id,
      CASE WHEN b.id IS NULL THEN o.seq ELSE b.seq END AS seq,
      CASE WHEN b.id IS NULL THEN o.segment ELSE b.segment END AS segment,
      CASE WHEN b.id IS NULL THEN o.value ELSE b.value END AS value
    FROM (SELECT * FROM old WHERE op <> 'D') o FULL OUTER JOIN batch b ON o.id = b.id
    WHERE b.id IS NULL OR b.op <> 'D'""",
)
_FACTS = """
claims AS (SELECT event_id AS claim_id, user_id AS id, CAST(ts AS DATE) AS claim_date,
   CAST(value AS DECIMAL(18,4)) AS amount FROM events)"""
_FACT_LOAD = _with(
    _CDC, _history("h"), _FACTS,
    f"""SELECT claim_id, c.id, CAST(claim_date AS VARCHAR) AS claim_date,
      CAST(amount AS DOUBLE) AS amount, sk
    FROM claims c LEFT JOIN h_dim d ON d.id = c.id AND c.claim_date >= d.start_date
      AND (d.end_date IS NULL OR c.claim_date < d.end_date)
    WHERE claim_date >= DATE '{V2_SINCE}'""",
)
_BACKFILL = """SELECT v.ingestion_date, v.currency, count(*) AS txn_count,
  CAST(sum(amount * rate) AS DOUBLE) AS total_value_sgd FROM valid v
  JOIN fx_all r ON r.run_date = v.ingestion_date AND r.currency = v.currency
  WHERE rate IS NOT NULL GROUP BY v.ingestion_date, v.currency"""

_SALTED_JOIN = _with(
    _TXN, _FX, _VALID, _DAY_FX,
    f"""SELECT {_ROW}, v.currency, CAST(amount AS DOUBLE) AS amount, CAST(rate AS DOUBLE) AS rate_to_sgd
    FROM valid v LEFT JOIN fx ON fx.currency = v.currency""",
)

ORACLE: dict[str, str] = {
    "q1_currency_agg": _q1("clean"),
    "q1_untrimmed": _q1("txn"),
    "q1_divided": _q1("clean", "CAST(sum(amount) AS DOUBLE) / CAST(max(rate) AS DOUBLE)"),
    "q1_row_by_row": _q1("clean"),
    "q1_from_lake": _q1("clean"),
    "silver_detail": _with(
        _TXN, _FX, _VALID, _DAY_FX,
        f"""SELECT {_ROW}, account_no, {_DETAIL}, '{RUN_DATE}' AS ingestion_date
        FROM valid JOIN fx USING (currency)""",
    ),
    "silver_from_lake": _with(
        _TXN, _FX, _VALID, _DAY_FX,
        f"""SELECT account_no, value_date, {_DETAIL}, '{RUN_DATE}' AS ingestion_date
        FROM valid JOIN fx USING (currency)""",
    ),
    "validate_transactions": _with(
        _TXN,
        f"""SELECT {_ROW}, {_SIDES} FROM txn
        WHERE coalesce(withdrawal_amt, deposit_amt) IS NOT NULL
          AND coalesce(withdrawal_currency, deposit_currency) IS NOT NULL""",
    ),
    "validate_data_valid": _with(
        _TXN,
        f"""SELECT {_ROW}, {_SIDES} FROM txn
        WHERE (withdrawal_amt IS NULL OR deposit_amt IS NULL)
          AND coalesce(withdrawal_amt, 0) >= 0 AND coalesce(deposit_amt, 0) >= 0""",
    ),
    "validate_data_reject": _with(
        _TXN,
        f"""SELECT {_ROW}, {_SIDES} FROM txn
        WHERE withdrawal_amt IS NOT NULL AND deposit_amt IS NOT NULL""",
    ),
    "reject_reasons": _with(
        _TXN,
        f"""SELECT * FROM (SELECT {_ROW}, {_SIDES}, {_REASON} AS reject_reason FROM txn) z
        WHERE reject_reason IS NOT NULL""",
    ),
    "unknown_currency": _with(
        _TXN, _FX, _VALID, _DAY_FX,
        f"""SELECT {_ROW}, currency, CAST(amount AS DOUBLE) AS amount FROM valid v
        WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.currency = v.currency)""",
    ),
    "quality_counts": _with(
        _TXN, _FX, _EFFECTIVE, _gold("eff"),
        """SELECT count(*) AS input_count,
          count(*) FILTER (reject_reason IS NULL OR reject_reason = 'unknown_currency') AS valid_count,
          count(*) FILTER (reject_reason IS NOT NULL AND reject_reason <> 'unknown_currency') AS reject_count,
          count(*) FILTER (reject_reason = 'unknown_currency') AS unknown_currency_count,
          count(*) FILTER (reject_reason IS NULL) AS output_count FROM gold""",
    ),
    "two_sided_conversion": _two_sided(
        f"""{_SIDES}, CAST(deposit_amt AS DOUBLE) / CAST(d.rate AS DOUBLE) AS deposit_sgd_amt,
        CAST(withdrawal_amt AS DOUBLE) / CAST(w.rate AS DOUBLE) AS withdrawal_sgd_amt"""
    ),
    "two_sided_floats": _two_sided(
        f"""{_float('deposit_amt')} / {_float('d.rate')} AS deposit_sgd_amt,
        {_float('withdrawal_amt')} / {_float('w.rate')} AS withdrawal_sgd_amt"""
    ),
    "mask_pii": _with(
        _TXN,
        f"""SELECT {_ROW}, sha256(account_no) AS account_no_hash, value_date,
        CAST(balance_amt AS DOUBLE) AS balance_amt FROM txn""",
    ),
    "long_form": _with(
        _TXN,
        """SELECT concat_ws('-', l_orderkey, l_linenumber, 'withdrawal') AS transaction_id, account_no,
          CAST(withdrawal_amt AS DOUBLE) AS amount, withdrawal_currency AS currency,
          'withdrawal' AS type, value_date FROM txn WHERE withdrawal_amt IS NOT NULL
        UNION ALL
        SELECT concat_ws('-', l_orderkey, l_linenumber, 'deposit'), account_no,
          CAST(deposit_amt AS DOUBLE), deposit_currency, 'deposit', value_date
        FROM txn WHERE deposit_amt IS NOT NULL""",
    ),
    "wide_form": _with(
        _TXN,
        """SELECT concat_ws('-', l_orderkey, l_linenumber, 'withdrawal') AS transaction_id, account_no,
          value_date, CAST(withdrawal_amt AS DOUBLE) AS withdrawal_amt, withdrawal_currency,
          CAST(NULL AS DOUBLE) AS deposit_amt, CAST(NULL AS VARCHAR) AS deposit_currency
        FROM txn WHERE withdrawal_amt IS NOT NULL
        UNION ALL
        SELECT concat_ws('-', l_orderkey, l_linenumber, 'deposit'), account_no, value_date,
          NULL, NULL, CAST(deposit_amt AS DOUBLE), deposit_currency
        FROM txn WHERE deposit_amt IS NOT NULL""",
    ),
    "schema_conform": _with(
        _CDC,
        """SELECT seq, id, CAST(NULL AS VARCHAR) AS updated_at, op, segment,
          CASE WHEN op <> 'D' THEN value END AS value,
          CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone FROM cdc""",
    ),
    "date_aligned_detail": _by_date("fx_all"),
    "fx_fallback": _by_date("eff"),
    "backfill_agg": _with(
        _TXN, _FX, "\ndated AS (SELECT *, value_date AS ingestion_date FROM clean)",
        _valid("dated"), _BACKFILL,
    ),
    "backfill_resumed": _with(_TXN, _FX, _yearly("clean", "dated"), _valid("dated"), _BACKFILL),
    "curated_stats": _with(
        _CDC,
        """SELECT 'date=' || CAST(CAST(updated_at AS DATE) AS VARCHAR) AS "partition", count(*) AS "rows"
        FROM cdc GROUP BY CAST(updated_at AS DATE)""",
    ),
    "reconcile_rows": _with(
        _FACTS,
        """SELECT claim_id + CASE WHEN kind = 'extra' THEN 1000000 ELSE 0 END AS claim_id,
          CASE WHEN kind = 'extra' THEN 0 ELSE 1 END AS source_rows,
          CASE kind WHEN 'missing' THEN CASE WHEN claim_id % 193 = 0 THEN 1 ELSE 0 END
            WHEN 'twice' THEN 2 ELSE 1 END AS target_rows,
          CASE WHEN kind IN ('changed', 'twice') OR kind = 'missing' AND claim_id % 193 = 0 THEN 'changed' ELSE kind END AS status
        FROM (SELECT claim_id, CASE WHEN claim_id % 211 = 0 THEN 'missing' WHEN claim_id % 193 = 0 THEN 'twice'
            WHEN claim_id % 197 = 0 THEN 'changed' END AS kind FROM claims
          UNION ALL SELECT claim_id, 'extra' FROM claims WHERE claim_id % 199 = 0) t
        WHERE kind IS NOT NULL AND NOT (kind = 'missing' AND claim_id % 193 = 0)""",
    ),
    "backfill_from_lake": _with(_TXN, _FX, _yearly("clean", "dated"), _valid("dated"), _BACKFILL),
    "backfill_detail_from_lake": _with(
        _TXN, _FX, _yearly("clean", "dated"), _valid("dated"),
        f"""SELECT {_ROW}, ingestion_date, value_date, v.{_DETAIL} FROM valid v
        JOIN fx_all r ON r.run_date = v.ingestion_date AND r.currency = v.currency
        WHERE rate IS NOT NULL""",
    ),
    "duplicate_rates": _with(
        _TXN, _FX,
        """SELECT run_date, currency AS target_currency, CAST(2 AS BIGINT) AS rates FROM fx_all
        WHERE run_date IN (SELECT value_date FROM txn)""",
    ),
    "fx_ingest": _with(
        _TXN, _FX,
        """SELECT run_date, base_currency, currency AS target_currency,
          CAST(rate AS DOUBLE) AS rate_to_sgd FROM fx_all
        WHERE rate IS NOT NULL AND run_date IN (SELECT value_date FROM txn)""",
    ),
    "salted_agg": _with(
        _TXN, _VALID,
        """SELECT currency, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total
        FROM valid GROUP BY currency""",
    ),
    "salted_join": _SALTED_JOIN,
    "salted_join_counted": _SALTED_JOIN,
    "bronze_trim": _with(_TXN, f"SELECT {_BRONZE}, '{RUN_DATE}' AS ingestion_date FROM txn"),
    "bronze_by_size": _with(_TXN, f"SELECT {_BRONZE}, '{RUN_DATE}' AS ingestion_date FROM txn"),
    "schema_mismatches": """SELECT name, said, count(*) AS n FROM lineitem, (VALUES ('bronze', 'ok'),
      ('no_currency', 'missing columns: [''deposit_currency'']'),
      ('text', 'wrong types: {''balance_amt'': ''string instead of decimal(18,4)''}')) t(name, said)
      GROUP BY name, said""",
    "csv_bronze": _with(
        _TXN,
        f"SELECT {_BRONZE}, '{RUN_DATE}' AS ingestion_date FROM txn WHERE l_orderkey % 43 <> 0",
    ),
    "csv_rejects": _with(
        _TXN,
        """SELECT account_no, CAST(NULL AS DOUBLE) AS balance_amt, concat(account_no, ',', value_date, ',', transaction_details, ',,', value_date, ',',
          withdrawal_amt, ',', withdrawal_currency, ',', deposit_amt, ',', deposit_currency,
          ',n/a') AS _corrupt_record FROM txn WHERE l_orderkey % 43 = 0""",
    ),
    "csv_rejects_masked": _with(
        _TXN,
        """SELECT sha256(trim(account_no)) AS account_no_hash, CAST(NULL AS DOUBLE) AS balance_amt,
          concat(replace(account_no, trim(account_no), sha256(trim(account_no))), ',', value_date, ',', transaction_details, ',,', value_date, ',',
          withdrawal_amt, ',', withdrawal_currency, ',', deposit_amt, ',', deposit_currency,
          ',n/a') AS _corrupt_record FROM txn WHERE l_orderkey % 43 = 0""",
    ),
    "gold_odd_dates": _with(
        _TXN, _FX, _EFFECTIVE,
        f"""
odd AS (SELECT *, CASE WHEN l_orderkey % 19 = 0 THEN '9999-12-31' WHEN l_orderkey % 17 = 0 THEN '0001-01-01'
   WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN '+12024-01-01' ELSE value_date END AS day FROM clean),
judged AS (SELECT day AS value_date, CASE WHEN day = '+12024-01-01' THEN 'unparsed_value_date'
   ELSE coalesce({_REASON}, CASE WHEN day IS NULL THEN 'no_date'
     WHEN day IN ('9999-12-31', '0001-01-01') THEN 'date_out_of_range'
     WHEN r.rate IS NULL THEN 'unknown_currency' END, '') END AS reject_reason
 FROM odd LEFT JOIN eff r ON r.run_date = day
  AND r.currency = coalesce(nullif(withdrawal_currency, ''), nullif(deposit_currency, '')))""",
        "SELECT value_date, reject_reason, count(*) AS txn_count FROM judged GROUP BY value_date, reject_reason",
    ),
    "fx_asof": _with(
        _TXN, _FX, _VALID,
        f"""
known AS (SELECT run_date, currency, rate FROM fx_all WHERE rate IS NOT NULL AND run_date NOT LIKE '1997%')""",
        f"""SELECT {_ROW}, v.currency, v.value_date, r.run_date AS rate_date, CAST(r.rate AS DOUBLE) AS rate_to_sgd
        FROM valid v ASOF LEFT JOIN known r ON r.currency = v.currency AND v.value_date >= r.run_date""",
    ),
    "fact_load_decade": _with(
        _CDC, _history("h"), _FACTS,
        """
moved AS (SELECT * REPLACE (CAST(claim_date + to_months(CAST(claim_id % 120 - 60 AS INTEGER)) AS DATE) AS claim_date) FROM claims)""",
        """SELECT claim_id, c.id, CAST(claim_date AS VARCHAR) AS claim_date, CAST(amount AS DOUBLE) AS amount, sk
        FROM moved c LEFT JOIN h_dim d ON d.id = c.id AND c.claim_date >= d.start_date
          AND (d.end_date IS NULL OR c.claim_date < d.end_date)""",
    ),
    "partition_overwrite": _with(
        _TXN, _yearly("txn", "raw"), _valid("raw", "before"), _yearly("clean", "fixed"),
        _valid("fixed", "after"),
        f"""SELECT ingestion_date, currency, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS amount
        FROM before WHERE ingestion_date <> '{FIX_DATE}' GROUP BY ingestion_date, currency
        UNION ALL
        SELECT ingestion_date, currency, count(*), CAST(sum(amount) AS DOUBLE)
        FROM after WHERE ingestion_date = '{FIX_DATE}' GROUP BY ingestion_date, currency""",
    ),
    "compaction": _with(
        _TXN, _yearly("txn", "dated"),
        f"""SELECT account_no, value_date AS date, transaction_details, value_date, {_SIDES},
        CAST(balance_amt AS DOUBLE) AS balance_amt, {_ROW}, ingestion_date FROM dated""",
    ),
    "hour_partitions": _with(
        _CDC,
        """SELECT seq, id, op, CAST(CAST(updated_at AS DATE) AS VARCHAR) AS date,
          CAST(hour(updated_at) AS INTEGER) AS hour FROM cdc""",
    ),
    "schema_versions_read": _with(
        _CDC,
        f"""SELECT {_CHANGE}, {_CONTACTS}, CAST(CAST(cdc.updated_at AS DATE) AS VARCHAR) AS date FROM cdc""",
    ),
    "change_feed_read": _with(_CDC, f"SELECT {_CHANGE}, {_CONTACTS} FROM cdc"),
    "change_feed_by_header": _with(_CDC, f"SELECT {_CHANGE}, {_CONTACTS} FROM cdc"),
    "schema_types_read": _with(
        _CDC,
        """SELECT seq, id, day,
          CASE WHEN reason IS NULL THEN CAST(CAST(seq / 4.0 AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
          reason AS reject_reason
        FROM (SELECT *, CAST(CAST(updated_at AS DATE) AS VARCHAR) AS day,
          CASE WHEN day(updated_at) <= 8 AND seq % 97 = 0
            OR day(updated_at) BETWEEN 17 AND 24 AND seq % 89 = 0 THEN 'unparsed_amount' END AS reason FROM cdc) t""",
    ),
    "curated_sql": _with(
        _CDC,
        """SELECT op, segment, CAST(CAST(updated_at AS DATE) AS VARCHAR) AS date,
          count(*) AS changes, count(DISTINCT id) AS ids FROM cdc
        GROUP BY op, segment, CAST(updated_at AS DATE)""",
    ),
    "gold_detail": _with(
        _TXN, _FX, _EFFECTIVE, _gold("eff"),
        f"""SELECT {_ROW}, account_no_hash, value_date, currency, CAST(amount AS DOUBLE) AS amount,
          CAST(rate AS DOUBLE) AS rate_to_sgd,
          CAST(amount AS DOUBLE) / CAST(rate AS DOUBLE) AS amount_sgd
        FROM gold WHERE reject_reason IS NULL""",
    ),
    "gold_rejects": _with(
        _TXN, _FX, _EFFECTIVE, _gold("eff"),
        f"""SELECT {_ROW}, account_no_hash, value_date, {_SIDES}, reject_reason
        FROM gold WHERE reject_reason IS NOT NULL""",
    ),
    "gold_from_lake": _with(
        _TXN, _FX, _EFFECTIVE, _gold("eff"),
        """SELECT coalesce(reject_reason, '') AS reject_reason, value_date,
          count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS amount
        FROM gold GROUP BY reject_reason, value_date""",
    ),
    "gold_reject_layer": _with(
        _TXN, _FX, _EFFECTIVE, _gold("eff"),
        f"""SELECT account_no_hash, value_date, {_SIDES}, reject_reason
        FROM gold WHERE reject_reason IS NOT NULL""",
    ),
    "fx_ingest_bad_rate": _with(
        _FX,
        f"""SELECT currency AS target_currency,
          CASE WHEN currency NOT IN ('C03', 'C05', 'C07') THEN CAST(rate AS DOUBLE) END AS rate_to_sgd,
          CASE currency WHEN 'C03' THEN 'n/a' WHEN 'C05' THEN '1500000.5' WHEN 'C07' THEN '-1' END AS rate_text
        FROM fx_all WHERE run_date = '{RUN_DATE}' AND rate IS NOT NULL""",
    ),
    "bronze_rejects": _with(
        _TXN,
        """SELECT value_date, CASE WHEN l_orderkey % 43 = 0
            THEN replace(CAST(withdrawal_amt AS VARCHAR), '.', ',') ELSE CAST(withdrawal_amt AS VARCHAR)
          END AS withdrawal_amt,
          CASE WHEN l_orderkey % 43 = 0 AND withdrawal_amt IS NOT NULL THEN 'unparsed_withdrawal_amt'
          END AS reject_reason FROM txn""",
    ),
    "change_feed_rejects": _with(_CDC, "SELECT seq, seq % 97 = 0 AS rejected FROM cdc"),
    "ods_merge_late": _with(_CDC, _latest("latest"), f"SELECT {_CHANGE} FROM latest"),
    "ods_merge_late_shuffled": _with(_CDC, _latest("latest"), f"SELECT {_CHANGE} FROM latest"),
    "scd2_replay": _with(_CDC, _history("h"), f"SELECT {_DIM} FROM h_dim"),
    "cdc_bad_ops": _with(
        _CDC,
        """SELECT seq, CASE WHEN seq % 103 = 0 THEN 'no_key'
          WHEN seq % 101 = 0 OR seq % 89 = 0 THEN 'unknown_operation' END AS reject_reason FROM cdc""",
    ),
    "cdc_schema_change": _with(
        _CDC, _latest("latest"),
        f"""SELECT id, seq, segment,
          CASE WHEN new THEN 'u' || id || '@example.com' END AS email,
          CASE WHEN new THEN lpad(CAST(id AS VARCHAR), 8, '0') END AS phone,
          CASE WHEN new THEN 'u' || id || '@example.com' END AS version_email
        FROM (SELECT *, updated_at >= TIMESTAMP '{BATCH_DATE} 00:00:00' AS new FROM latest WHERE op <> 'D')""",
    ),
    "fact_load_duplicates": _with(
        _FACTS,
        """SELECT CAST(claim_date AS VARCHAR) AS label, count(*) AS n FROM claims GROUP BY claim_date
        UNION ALL SELECT 'no_id', count(*) FROM claims WHERE claim_id % 5 = 0
        UNION ALL SELECT 'no_date', count(*) FROM claims WHERE claim_id % 7 = 0""",
    ),
    "cdc_latest": _with(_CDC, _latest("latest"), f"SELECT {_CHANGE} FROM latest"),
    "ods_merge": _MERGE,
    "ods_merge_shuffled": _MERGE,
    "scd2_history": _with(_CDC, _history("h"), f"SELECT {_DIM} FROM h_dim"),
    "scd2_incremental": _with(
        _CDC, _history("h", _BEFORE), _latest("batch", _BATCH),
        f"""
moved AS (SELECT h_dim.*, b.op, b.segment AS new_segment, end_date IS NULL AND b.id IS NOT NULL
   AND (b.op = 'D' OR b.segment IS DISTINCT FROM h_dim.segment) AS closes
 FROM h_dim LEFT JOIN batch b ON b.id = h_dim.id)""",
        f"""SELECT sk, id, segment, CAST(start_date AS VARCHAR) AS start_date,
          CASE WHEN closes THEN '{BATCH_DATE}' ELSE CAST(end_date AS VARCHAR) END AS end_date FROM moved
        UNION ALL
        SELECT md5(concat_ws(':', id, '{BATCH_DATE}')), id, segment, '{BATCH_DATE}', NULL FROM batch b
        WHERE op <> 'D' AND NOT EXISTS (SELECT 1 FROM h_dim WHERE h_dim.id = b.id
          AND end_date IS NULL AND h_dim.segment IS NOT DISTINCT FROM b.segment)""",
    ),
    "fact_load": _FACT_LOAD,
    "fact_load_shuffled": _FACT_LOAD,
    "reconcile": _with(
        _TXN, _FX, _VALID, _DAY_FX,
        """SELECT v.currency, count(*) AS source_count,
          count(*) FILTER (rate IS NOT NULL) AS target_count,
          CAST(sum(amount) AS DOUBLE) AS source_amount,
          CAST(coalesce(sum(amount) FILTER (rate IS NOT NULL), 0) AS DOUBLE) AS target_amount,
          count(*) = count(*) FILTER (rate IS NOT NULL) AS ok
        FROM valid v LEFT JOIN fx ON fx.currency = v.currency GROUP BY v.currency""",
    ),
    "cdc_to_ods": _with(
        _CDC, _latest("latest"),
        f"SELECT id, seq, segment, value, {_CONTACTS} FROM latest WHERE op <> 'D'",
    ),
    "ods_bucketed": _with(
        _CDC, _latest("latest"),
        f"SELECT id, seq, segment, value, {_CONTACTS} FROM latest WHERE op <> 'D'",
    ),
    "ods_bucketed_before": _with(
        _CDC, _latest("latest", _BEFORE),
        f"SELECT id, seq, segment, value, {_CONTACTS} FROM latest WHERE op <> 'D'",
    ),
    "published_counters": _with(
        _CDC,
        f"""
labelled AS (SELECT *, CASE WHEN {_BEFORE} THEN '2024-01-29' ELSE '{BATCH_DATE}' END AS version FROM cdc)""",
        """SELECT version, 'changed_keys' AS counter, count(DISTINCT id) AS value FROM labelled GROUP BY version
        UNION ALL SELECT version, 'changed_days', count(DISTINCT (id, CAST(updated_at AS DATE))) FROM labelled
        GROUP BY version""",
    ),
    "scd2_late": _with(_CDC, _history("h"), f"SELECT {_DIM} FROM h_dim"),
    "cdc_to_dimension": _with(_CDC, _history("h"), f"SELECT {_DIM} FROM h_dim"),
    "reconcile_facts": _with(
        _FACTS,
        f"""SELECT CAST(claim_date AS VARCHAR) AS claim_date, count(*) AS source_count,
          count(*) FILTER (claim_date < DATE '{V2_SINCE}') AS target_count,
          CAST(sum(amount) AS DOUBLE) AS source_amount,
          CAST(coalesce(sum(amount) FILTER (claim_date < DATE '{V2_SINCE}'), 0) AS DOUBLE) AS target_amount,
          claim_date < DATE '{V2_SINCE}' AS ok FROM claims GROUP BY claim_date""",
    ),
    "cdc_to_warehouse": _with(
        _CDC, _history("h"), _FACTS,
        """SELECT claim_id, c.id, CAST(claim_date AS VARCHAR) AS claim_date,
          CAST(amount AS DOUBLE) AS amount, sk, segment,
          CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
        FROM claims c LEFT JOIN h_dim d ON d.id = c.id AND c.claim_date >= d.start_date
          AND (d.end_date IS NULL OR c.claim_date < d.end_date)""",
    ),
}
