"""Bronze-shaped record tables derived from the given test tables.

No bank data ships with the tests, so each record type is a projection of a
given table (``events``, ``orders``, ``customer``).  Each plants dirty data on
purpose: unparseable amounts and dates, NULL customers, channels and types,
padded and lower-case labels.  The moduli below only choose which rows carry
a dirty value; no row is ever dropped.  All derivations are narrow (no
shuffle) and read only the columns they use, so the records grow with the
given tables: one record per source row.

The same derivations exist as SQL in ``ledgerspark.plans.oracle`` for the
DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions import MONEY, zfill
from ledgerspark.operators.alerts import derive_aml_alerts, derive_flag, json_value, txn_number
from ledgerspark.sources.schemas import TOPICS

# The moduli that plant dirty rows, and id widths.
BAD_AMOUNT_MOD = 97
BAD_DATE_MOD = 101
NULL_CUSTOMER_MOD = 89
NULL_CHANNEL_MOD = 83
NULL_TYPE_MOD = 79
BRANCHES_MOD = 23
BROKEN_JSON_MOD = 61
BROKEN_JSON = "{broken"

# texts that are no amount and no business time
BAD_AMOUNTS = (
    "N/A",
    "",
    "   ",
    "1_000",
    "1,000.00",
    "12.3.4",
    "abc",
    "--5",
    "1e",
    "NaN",
    "INR 500",
    "0x1F",
    "12.50 CR",
)
BAD_DATES = (
    "bad-date",
    "",
    "2026",
    "2026-03",
    "2026-13-01",
    "2026-02-30",
    "24:00:00",
    "2026-01-01T24:00:00",
    "2026-01-01T10",
    "2026-01-01T10:61:00",
    "01/02/2026",
    "20260101",
    "2026-1-1",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _choice(values: tuple[str, ...], number: str, step: int):
    """One of ``values`` by ``number div step``."""
    listed = F.array(*[F.lit(v) for v in values])
    return F.element_at(listed, (F.expr(f"{number} div {step}") % len(values) + 1).cast("int"))


def _money_text(c):
    return c.cast(MONEY).cast("string")


def transactions(events: DataFrame) -> DataFrame:
    """Transaction records from ``events``; ``_ingestion_ts`` is the event
    time, so results that show it are comparable."""
    eid = F.col("event_id")
    et = F.col("event_type")
    purchase = et == "purchase"
    scaled = eid * 7919
    return events.select(
        F.concat(F.lit("TXN"), zfill(eid, 12)).alias("txn_id"),
        F.concat(F.lit("ACCT"), zfill("user_id", 6)).alias("account_id"),
        F.when(eid % NULL_CUSTOMER_MOD != 0, F.concat(F.lit("CUST"), zfill("user_id", 6))).alias("customer_id"),
        F.when(eid % NULL_TYPE_MOD == 0, F.lit(None))
        .when(et.isin("purchase", "click"), " debit")
        .otherwise("CREDIT")
        .alias("txn_type"),
        F.when(eid % BAD_AMOUNT_MOD == 0, _choice(BAD_AMOUNTS, "event_id", BAD_AMOUNT_MOD))
        .when(purchase & (eid % 10 < 6), _money_text(900000 + scaled % 100000))
        .when(purchase & (eid % 10 == 6), _money_text(1000000 + scaled % 4000000))
        .otherwise(_money_text(F.col("value")))
        .alias("amount"),
        F.lit("INR").alias("currency"),
        F.when(eid % BAD_DATE_MOD == 0, _choice(BAD_DATES, "event_id", BAD_DATE_MOD))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("txn_date"),
        F.date_format("ts", "yyyy-MM-dd").alias("value_date"),
        F.concat(F.lit("BR"), zfill(eid % BRANCHES_MOD, 3)).alias("branch_code"),
        F.when(eid % NULL_CHANNEL_MOD == 0, F.lit(None))
        .when(purchase, F.when(eid % 2 == 0, "CASH").otherwise(" cash "))
        .when(et == "click", "UPI")
        .when(et == "view", "neft")
        .when(et == "signup", "ATM ")
        .otherwise("RTGS")
        .alias("channel"),
        F.concat(F.upper(et), F.lit(" PAYMENT")).alias("narration"),
        _money_text(10000 + (eid * 104729) % 4990000).alias("balance_after"),
        F.when(eid % 10 == 8, "FAILED").otherwise("SUCCESS").alias("status"),
        F.concat(F.lit("REF"), zfill(eid, 12)).alias("ref_number"),
        F.col("ts").alias("_ingestion_ts"),
    )


def flagged_transactions(events: DataFrame) -> DataFrame:
    """Transactions as the generator publishes them: flag rule applied."""
    return derive_flag(transactions(events))


def aml_alerts(events: DataFrame) -> DataFrame:
    """One alert per flagged transaction."""
    return derive_aml_alerts(flagged_transactions(events))


def customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        F.concat(F.lit("CUST"), zfill(k, 6)).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(k % 2 == 0, "VERIFIED").otherwise("PENDING").alias("kyc_status"),
        F.when(k % 7 == 0, "HIGH").otherwise("LOW").alias("risk_category"),
        F.concat(F.lit("BR"), zfill(k % BRANCHES_MOD, 3)).alias("branch_code"),
        F.col("c_mktsegment").alias("occupation"),
    )


def npa_report(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    return orders.select(
        F.concat(F.lit("LOAN"), zfill(k, 9)).alias("loan_id"),
        F.concat(F.lit("CUST"), zfill("o_custkey", 6)).alias("customer_id"),
        F.col("o_orderpriority").alias("loan_type"),
        F.when(k % 97 == 0, "N/A").otherwise(_money_text(F.col("o_totalprice"))).alias("outstanding_principal"),
        F.when(k % 53 == 0, "unknown").otherwise((k % 400).cast("string")).alias("dpd"),
        F.when(status == "P", " npa ").when(status == "F", "STANDARD").otherwise("sma").alias("npa_status"),
    )


def cibil_bureau(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        F.concat(F.lit("CIB"), zfill(k, 9)).alias("report_id"),
        F.concat(F.lit("CUST"), zfill(k, 6)).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(k % 71 == 0, "NA").otherwise((300 + (k * 37) % 600).cast("string")).alias("cibil_score"),
        _money_text(F.abs(F.col("c_acctbal"))).alias("total_outstanding"),
        (k % 5).cast("string").alias("dpd_90_count"),
        F.when(k % 50 == 0, "Y").otherwise("N").alias("wilful_defaulter"),
        F.lit("2026-03-31").alias("report_pull_date"),
    )


def kafka_records(records: DataFrame, topic: str = "finacle-transactions", broken: bool = True) -> DataFrame:
    """A Kafka-shaped frame of messages (as a topic dump would look).

    The value is the record as JSON (fields the record frame lacks are
    absent and parse back as NULL).  For transactions, one message in
    ``BROKEN_JSON_MOD`` (by transaction number) is replaced by broken JSON.
    """
    t = TOPICS[topic]
    fields = [f for f in t.schema.fieldNames() if f in records.columns]
    value = json_value(fields)
    if topic == "finacle-transactions":
        seq = txn_number()
        if broken:
            value = F.when(seq % BROKEN_JSON_MOD == 0, F.lit(BROKEN_JSON)).otherwise(value)
        partition, offset = F.pmod(seq, F.lit(8)).cast("int"), seq
    else:
        partition, offset = F.spark_partition_id(), F.monotonically_increasing_id()
    ts = F.col("_ingestion_ts").cast("timestamp") if "_ingestion_ts" in records.columns else F.current_timestamp()
    return records.select(
        F.col(t.key_field).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
