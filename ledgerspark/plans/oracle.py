"""DuckDB SQL twins of the registered queries (the correctness oracle).

Only the given tables exist as views in the oracle, so every statement
carries the record derivations of ``sources.fixtures`` as CTEs.  Conventions
that keep both engines comparable:

* sums ``CAST(SUM(x) AS DECIMAL(38,2))``;
* averages and percentages rounded half up with integer arithmetic
  (DuckDB's ``AVG(decimal)`` is a double);
* hours and conditional counts as ``BIGINT``;
* a unique tie-break after every ``ORDER BY ... LIMIT``; ``NULLS LAST`` on
  nullable keys.
"""

from __future__ import annotations

from ledgerspark.sources.fixtures import BAD_AMOUNTS, BAD_DATES
from ledgerspark.sources.schemas import CIBIL_FIELDS, CUSTOMER_FIELDS, NPA_FIELDS


def _zf(expr: str, width: int) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END)"


def _money_text(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS VARCHAR)"


# what counts as a number and as a business time; DuckDB's own casts take more
# (1_000, 24:00:00)
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
TIME = r"[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]([01][0-9]|2[0-3]):[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?"
AMT = f"CASE WHEN regexp_full_match(trim(amount), '{NUMBER}') THEN TRY_CAST(trim(amount) AS DECIMAL(18,2)) END"
TTS = f"CASE WHEN regexp_full_match(trim(txn_date), '{TIME}') THEN TRY_CAST(trim(txn_date) AS TIMESTAMP) END"
CHN = "upper(trim(channel))"


def _choice(values: tuple[str, ...], number: str) -> str:
    """One of ``values`` by a whole number."""
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {cases} END"


def _avg(x: str) -> str:
    return (
        f"CAST(CAST((2*CAST(SUM({x})*100 AS HUGEINT)+COUNT({x}))//(2*COUNT({x})) AS DECIMAL(36,0))"
        f"*CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(38,2))"
    )


def _sum(x: str) -> str:
    return f"CAST(SUM({x}) AS DECIMAL(38,2))"


PCT = (
    "CAST(CAST((20000*COUNT(*)+SUM(COUNT(*)) OVER ())//(2*SUM(COUNT(*)) OVER ()) AS DECIMAL(10,0))"
    "*CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(5,2))"
)

TXN = f"""txn AS (
 SELECT
  'TXN' || {_zf('event_id', 12)} AS txn_id,
  'ACCT' || {_zf('user_id', 6)} AS account_id,
  CASE WHEN event_id % 89 <> 0 THEN 'CUST' || {_zf('user_id', 6)} END AS customer_id,
  CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_type IN ('purchase', 'click') THEN ' debit' ELSE 'CREDIT' END AS txn_type,
  CASE WHEN event_id % 97 = 0 THEN {_choice(BAD_AMOUNTS, 'event_id // 97')}
       WHEN event_type = 'purchase' AND event_id % 10 < 6 THEN {_money_text('900000 + (event_id * 7919) % 100000')}
       WHEN event_type = 'purchase' AND event_id % 10 = 6 THEN {_money_text('1000000 + (event_id * 7919) % 4000000')}
       ELSE {_money_text('value')} END AS amount,
  'INR' AS currency,
  CASE WHEN event_id % 101 = 0 THEN {_choice(BAD_DATES, 'event_id // 101')} ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS txn_date,
  strftime(ts, '%Y-%m-%d') AS value_date,
  'BR' || {_zf('event_id % 23', 3)} AS branch_code,
  CASE WHEN event_id % 83 = 0 THEN NULL
       WHEN event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'CASH' ELSE ' cash ' END
       WHEN event_type = 'click' THEN 'UPI' WHEN event_type = 'view' THEN 'neft'
       WHEN event_type = 'signup' THEN 'ATM ' ELSE 'RTGS' END AS channel,
  upper(event_type) || ' PAYMENT' AS narration,
  {_money_text('10000 + (event_id * 104729) % 4990000')} AS balance_after,
  CASE WHEN event_id % 10 = 8 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  'REF' || {_zf('event_id', 12)} AS ref_number,
  ts AS _ingestion_ts
 FROM events)"""

TXN_COLS = (
    "txn_id, account_id, customer_id, txn_type, amount, currency, txn_date, value_date, "
    "branch_code, channel, narration, balance_after, status, ref_number"
)

TXNF = f"""{TXN},
txnf AS (
 SELECT txn_id, account_id, customer_id, txn_type, amount, currency, txn_date, value_date,
  branch_code, channel, narration, balance_after,
  CASE WHEN {CHN} = 'CASH' AND ({AMT}) > 500000 THEN 'FLAGGED' ELSE status END AS status,
  ref_number, _ingestion_ts
 FROM txn)"""

AML = f"""{TXNF},
aml AS (
 SELECT 'AML' || substr(txn_id, 4) AS alert_id, customer_id, customer_id AS customer_name,
  txn_date AS alert_date,
  CASE seq % 4 WHEN 0 THEN 'STRUCTURING' WHEN 1 THEN 'HIGH_VALUE' WHEN 2 THEN 'VELOCITY' ELSE 'UNUSUAL_PATTERN' END AS alert_type,
  CAST(60 + seq % 40 AS VARCHAR) AS risk_score,
  CASE seq % 4 WHEN 0 THEN 'RULE_CTR_SPLIT' WHEN 1 THEN 'RULE_HIGH_VALUE' WHEN 2 THEN 'RULE_HIGH_VELOCITY' ELSE 'RULE_PATTERN_BREAK' END AS rule_triggered,
  txn_id AS transaction_ids, amount AS total_amount, currency,
  CASE seq % 4 WHEN 0 THEN 'Multiple transactions structured to avoid CTR threshold'
               WHEN 1 THEN 'High value ' || channel || ' of INR ' || amount
               WHEN 2 THEN 'Unusual transaction velocity detected on account'
               ELSE 'Transaction pattern deviates from customer profile' END AS description,
  CASE seq % 2 WHEN 0 THEN 'OPEN' ELSE 'UNDER_REVIEW' END AS status,
  CAST(NULL AS VARCHAR) AS assigned_to,
  CASE seq % 3 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' ELSE 'MEDIUM' END AS priority,
  CAST(NULL AS VARCHAR) AS due_date, CAST(NULL AS VARCHAR) AS resolution,
  CAST(NULL AS VARCHAR) AS resolution_date, CAST(NULL AS VARCHAR) AS sar_filed,
  CAST(NULL AS VARCHAR) AS sar_reference
 FROM (SELECT *, TRY_CAST(substr(txn_id, 4) AS BIGINT) AS seq FROM txnf WHERE status = 'FLAGGED') f)"""

CUST = f"""cust AS (
 SELECT 'CUST' || {_zf('c_custkey', 6)} AS customer_id, c_name AS name,
  CASE WHEN c_custkey % 2 = 0 THEN 'VERIFIED' ELSE 'PENDING' END AS kyc_status,
  CASE WHEN c_custkey % 7 = 0 THEN 'HIGH' ELSE 'LOW' END AS risk_category,
  'BR' || {_zf('c_custkey % 23', 3)} AS branch_code, c_mktsegment AS occupation
 FROM customer)"""

NPA = f"""npa AS (
 SELECT 'LOAN' || {_zf('o_orderkey', 9)} AS loan_id,
  'CUST' || {_zf('o_custkey', 6)} AS customer_id,
  o_orderpriority AS loan_type,
  CASE WHEN o_orderkey % 97 = 0 THEN 'N/A' ELSE {_money_text('o_totalprice')} END AS outstanding_principal,
  CASE WHEN o_orderkey % 53 = 0 THEN 'unknown' ELSE CAST(o_orderkey % 400 AS VARCHAR) END AS dpd,
  CASE WHEN o_orderstatus = 'P' THEN ' npa ' WHEN o_orderstatus = 'F' THEN 'STANDARD' ELSE 'sma' END AS npa_status
 FROM orders)"""

CIBIL = f"""cibil AS (
 SELECT 'CIB' || {_zf('c_custkey', 9)} AS report_id,
  'CUST' || {_zf('c_custkey', 6)} AS customer_id, c_name AS customer_name,
  CASE WHEN c_custkey % 71 = 0 THEN 'NA' ELSE CAST(300 + (c_custkey * 37) % 600 AS VARCHAR) END AS cibil_score,
  {_money_text('abs(c_acctbal)')} AS total_outstanding,
  CAST(c_custkey % 5 AS VARCHAR) AS dpd_90_count,
  CASE WHEN c_custkey % 50 = 0 THEN 'Y' ELSE 'N' END AS wilful_defaulter,
  '2026-03-31' AS report_pull_date
 FROM customer)"""

# typed transactions
T = f"""{TXN},
t AS (SELECT *, {AMT} AS amt, {TTS} AS tts, {CHN} AS chn FROM txn)"""

# parsed Kafka messages: all 14 fields NULL where the message was broken
INGESTED = f"""{TXNF},
msg AS (SELECT *, TRY_CAST(substr(txn_id, 4) AS BIGINT) % 61 = 0 AS broken FROM txnf),
ingested AS (
 SELECT {", ".join(f"CASE WHEN broken THEN NULL ELSE {c} END AS {c}" for c in TXN_COLS.split(", "))},
  'kafka' AS _source
 FROM msg)"""


def _parsed(table: str, held: tuple[str, ...], fields: tuple[str, ...]) -> str:
    """The records of ``table`` as ingested: fields the record lacks are NULL."""
    cols = ", ".join(c if c in held else f"CAST(NULL AS VARCHAR) AS {c}" for c in fields)
    return f"SELECT {cols}, 'kafka' AS _source FROM {table}"


CUST_HELD = ("customer_id", "name", "kyc_status", "risk_category", "branch_code", "occupation")
NPA_HELD = ("loan_id", "customer_id", "loan_type", "outstanding_principal", "dpd", "npa_status")
CIBIL_HELD = (
    "report_id",
    "customer_id",
    "customer_name",
    "cibil_score",
    "total_outstanding",
    "dpd_90_count",
    "wilful_defaulter",
    "report_pull_date",
)


def _json_pair(c: str) -> str:
    return f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":"' || {c} || '"' END"""


ORACLE: dict[str, str] = {
    "kpi_overall": f"""WITH {T}
SELECT COUNT(*) AS total_transactions,
 COUNT(DISTINCT customer_id) AS active_customers,
 COUNT(DISTINCT account_id) AS unique_accounts,
 COUNT(DISTINCT branch_code) AS unique_branches,
 {_sum('amt')} AS total_volume_inr,
 {_avg('amt')} AS avg_amount_inr,
 MIN(tts) AS earliest_txn, MAX(tts) AS latest_txn,
 MAX(_ingestion_ts) AS last_ingested
FROM t""",
    "volume_daily": f"""WITH {T}
SELECT CAST(tts AS DATE) AS txn_day, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount,
 COUNT(DISTINCT customer_id) AS active_customers
FROM t WHERE tts IS NOT NULL AND amt IS NOT NULL
GROUP BY CAST(tts AS DATE) ORDER BY txn_day DESC LIMIT 30""",
    "volume_hourly": f"""WITH {T}
SELECT CAST(hour(tts) AS BIGINT) AS txn_hour, COUNT(*) AS txn_count, {_avg('amt')} AS avg_amount,
 {_sum('amt')} AS total_amount
FROM t WHERE tts IS NOT NULL AND amt IS NOT NULL
GROUP BY hour(tts) ORDER BY txn_hour""",
    "pattern_channel": f"""WITH {T}
SELECT chn AS channel, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount, {_avg('amt')} AS avg_amount,
 {PCT} AS pct_of_total
FROM t WHERE amt IS NOT NULL AND channel IS NOT NULL
GROUP BY chn ORDER BY txn_count DESC""",
    "pattern_txn_type": f"""WITH {T}
SELECT upper(trim(txn_type)) AS txn_type, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount,
 CAST(MIN(amt) AS DECIMAL(18,2)) AS min_amount, CAST(MAX(amt) AS DECIMAL(18,2)) AS max_amount
FROM t WHERE amt IS NOT NULL AND txn_type IS NOT NULL
GROUP BY upper(trim(txn_type)) ORDER BY total_amount DESC""",
    "pattern_branch_top15": f"""WITH {T}
SELECT branch_code, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount,
 COUNT(DISTINCT customer_id) AS unique_customers
FROM t WHERE amt IS NOT NULL AND branch_code IS NOT NULL
GROUP BY branch_code ORDER BY total_amount DESC, branch_code LIMIT 15""",
    "risk_high_value_cash": f"""WITH {T}
SELECT txn_id, customer_id, branch_code, amt AS amount, narration, txn_date
FROM t WHERE chn = 'CASH' AND amt >= 1000000
ORDER BY amt DESC, txn_id LIMIT 20""",
    "risk_structuring": f"""WITH {T}
SELECT customer_id, CAST(tts AS DATE) AS txn_day, COUNT(*) AS cash_txn_count, {_sum('amt')} AS total_cash
FROM t WHERE chn = 'CASH' AND amt BETWEEN 900000 AND 999999 AND tts IS NOT NULL
GROUP BY customer_id, CAST(tts AS DATE)
HAVING COUNT(*) >= 2
ORDER BY cash_txn_count DESC, total_cash DESC, customer_id NULLS LAST, txn_day LIMIT 20""",
    "risk_high_velocity": f"""WITH {T}
SELECT customer_id, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount,
 COUNT(DISTINCT chn) AS channels_used, COUNT(DISTINCT branch_code) AS branches_used,
 MIN(txn_date) AS first_txn, MAX(txn_date) AS last_txn
FROM t WHERE amt IS NOT NULL AND customer_id IS NOT NULL
GROUP BY customer_id HAVING COUNT(*) >= 20
ORDER BY txn_count DESC, customer_id LIMIT 15""",
    "bronze_counts": f"""WITH {AML}, {CUST}, {NPA}, {CIBIL}
SELECT 'finacle_transactions' AS table_name, COUNT(*) AS row_count FROM txnf
UNION ALL SELECT 'finacle_customers', COUNT(*) FROM cust
UNION ALL SELECT 'aml_alerts', COUNT(*) FROM aml
UNION ALL SELECT 'cibil_bureau', COUNT(*) FROM cibil
UNION ALL SELECT 'npa_report', COUNT(*) FROM npa""",
    "txn_channel_distribution": f"""WITH {T}
SELECT chn AS channel, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount, {_avg('amt')} AS avg_amount,
 COUNT(DISTINCT customer_id) AS unique_customers
FROM t WHERE amt IS NOT NULL
GROUP BY chn ORDER BY total_amount DESC""",
    "txn_branch_type_top15": f"""WITH {T}
SELECT branch_code, upper(trim(txn_type)) AS txn_type, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount,
 CAST(MAX(amt) AS DECIMAL(18,2)) AS max_amount
FROM t WHERE amt IS NOT NULL
GROUP BY branch_code, upper(trim(txn_type))
ORDER BY total_amount DESC, branch_code NULLS LAST, txn_type NULLS LAST LIMIT 15""",
    "txn_hourly": f"""WITH {T}
SELECT CAST(hour(tts) AS BIGINT) AS txn_hour, COUNT(*) AS txn_count, {_sum('amt')} AS total_amount
FROM t WHERE tts IS NOT NULL AND amt IS NOT NULL
GROUP BY hour(tts) ORDER BY txn_hour""",
    "txn_data_quality": f"""WITH {T}
SELECT COUNT(*) AS total_rows,
 CAST(SUM(CASE WHEN amt IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_amount,
 CAST(SUM(CASE WHEN tts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_txn_date,
 CAST(SUM(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_customer
FROM t""",
    "risk_high_value_cash_channel": f"""WITH {T}
SELECT txn_id, customer_id, chn AS channel, amt AS amount, narration, txn_date
FROM t WHERE chn = 'CASH' AND amt >= 1000000
ORDER BY amt DESC, txn_id LIMIT 20""",
    "risk_open_aml_alerts": f"""WITH {AML}
SELECT alert_id, customer_id, customer_name, alert_type,
 TRY_CAST(risk_score AS INTEGER) AS risk_score,
 TRY_CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
 status, priority, alert_date
FROM aml WHERE upper(trim(status)) = 'OPEN'
ORDER BY TRY_CAST(risk_score AS INTEGER) DESC NULLS LAST, alert_id LIMIT 20""",
    "risk_npa_summary": f"""WITH {NPA}
SELECT upper(trim(npa_status)) AS npa_status, COUNT(*) AS accounts,
 {_sum('TRY_CAST(outstanding_principal AS DECIMAL(18,2))')} AS total_outstanding,
 CAST((2*SUM(TRY_CAST(dpd AS INTEGER)) + COUNT(TRY_CAST(dpd AS INTEGER)))
      // (2*COUNT(TRY_CAST(dpd AS INTEGER))) AS BIGINT) AS avg_dpd
FROM npa WHERE TRY_CAST(outstanding_principal AS DECIMAL(18,2)) IS NOT NULL
GROUP BY upper(trim(npa_status)) ORDER BY total_outstanding DESC NULLS LAST""",
    "risk_low_cibil": f"""WITH {CIBIL}
SELECT customer_id, customer_name, TRY_CAST(cibil_score AS INTEGER) AS cibil_score,
 TRY_CAST(total_outstanding AS DECIMAL(18,2)) AS total_outstanding,
 TRY_CAST(dpd_90_count AS INTEGER) AS dpd_90_count, wilful_defaulter, report_pull_date
FROM cibil WHERE TRY_CAST(cibil_score AS INTEGER) < 600
ORDER BY TRY_CAST(cibil_score AS INTEGER), customer_id LIMIT 20""",
    "derive_flag": f"""WITH {TXNF}
SELECT {TXN_COLS} FROM txnf""",
    "derive_aml_alerts": f"""WITH {AML}
SELECT * FROM aml""",
    "publish_envelope": f"""WITH {TXNF}
SELECT txn_id AS key,
 '{{' || concat_ws(',', {", ".join(_json_pair(c) for c in TXN_COLS.split(", "))}) || '}}' AS value
FROM txnf""",
    "derive_ref_number": f"""WITH {T}
SELECT txn_id,
 'TXN' || strftime(tts, '%Y%m%d') || {_zf('TRY_CAST(substr(txn_id, 4) AS BIGINT)', 6)} AS derived_txn_id,
 chn || strftime(tts, '%Y%m%d') || {_zf('TRY_CAST(substr(txn_id, 4) AS BIGINT)', 6)} AS derived_ref_number
FROM t""",
    "ingest_json": f"""WITH {INGESTED}
SELECT * FROM ingested""",
    "ingest_append_twice": f"""WITH {INGESTED}
SELECT * FROM ingested UNION ALL SELECT * FROM ingested""",
    "ingest_stream": f"""WITH {INGESTED}
SELECT * FROM ingested""",
    "ingest_alerts": f"""WITH {AML}
SELECT *, 'kafka' AS _source FROM aml""",
    "ingest_all_topics": f"""WITH {AML}, {CUST}, {NPA}, {CIBIL}
SELECT 'finacle_transactions' AS table_name, COUNT(*) AS row_count FROM txnf
UNION ALL SELECT 'finacle_customers', COUNT(*) FROM cust
UNION ALL SELECT 'aml_alerts', COUNT(*) FROM aml
UNION ALL SELECT 'cibil_bureau', COUNT(*) FROM cibil
UNION ALL SELECT 'npa_report', COUNT(*) FROM npa""",
    "ingest_mixed": f"""WITH {INGESTED}
SELECT * FROM ingested""",
    "ingest_customers": f"""WITH {CUST}
{_parsed('cust', CUST_HELD, CUSTOMER_FIELDS)}""",
    "ingest_npa": f"""WITH {NPA}
{_parsed('npa', NPA_HELD, NPA_FIELDS)}""",
    "ingest_cibil": f"""WITH {CIBIL}
{_parsed('cibil', CIBIL_HELD, CIBIL_FIELDS)}""",
    "bronze_tables": """SELECT * FROM (VALUES ('finacle_transactions'), ('finacle_customers'), ('aml_alerts'),
 ('cibil_bureau'), ('npa_report')) t(table_name)""",
    "bronze_schema": f"""SELECT column_name,
 CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(column_type) END AS data_type
FROM (DESCRIBE WITH {TXN}
SELECT {TXN_COLS}, CAST(_ingestion_ts AS TIMESTAMPTZ) AS _ingestion_ts, 'kafka' AS _source FROM txn)""",
}

# the same rows and reports by another way
ORACLE["ingest_compacted"] = ORACLE["ingest_offsets"] = ORACLE["ingest_stream"]
ORACLE["volume_daily_silver"] = ORACLE["gold_volume_daily"] = ORACLE["volume_daily"]
ORACLE["gold_kpi_overall"] = ORACLE["kpi_overall"]
ORACLE["gold_volume_hourly"] = ORACLE["volume_hourly"]
ORACLE["gold_pattern_channel"] = ORACLE["pattern_channel"]
ORACLE["gold_pattern_txn_type"] = ORACLE["pattern_txn_type"]
