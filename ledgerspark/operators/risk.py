"""Risk signals: high-value cash, structuring, velocity, open alerts, NPA,
low credit scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import amt, as_int, int_avg, money_sum, norm, with_typed

# Thresholds of the reference risk analytics (INR).
HIGH_VALUE_CASH = 1_000_000
STRUCTURING_LOW = 900_000
STRUCTURING_HIGH = 999_999
STRUCTURING_MIN_COUNT = 2
VELOCITY_MIN_COUNT = 20
LOW_CIBIL = 600


def _cash(txn: DataFrame) -> DataFrame:
    t = with_typed(txn)
    return t.where(F.col("_chn") == "CASH")


def risk_high_value_cash(
    txn: DataFrame, threshold: int = HIGH_VALUE_CASH, top: int = 20
) -> DataFrame:
    """Largest cash transactions at or above ``threshold`` (CTR candidates).

    ``orderBy().limit()`` plans as a top-k (``TakeOrderedAndProject``): each
    task keeps its best ``top`` rows, no full sort.
    """
    return (
        _cash(txn)
        .where(F.col("_amt") >= threshold)
        .select(
            "txn_id",
            "customer_id",
            "branch_code",
            F.col("_amt").alias("amount"),
            "narration",
            "txn_date",
        )
        .orderBy(F.col("amount").desc(), F.col("txn_id"))
        .limit(top)
    )


def risk_high_value_cash_channel(
    txn: DataFrame, threshold: int = HIGH_VALUE_CASH, top: int = 20
) -> DataFrame:
    """``risk_high_value_cash`` showing the normalised channel, not the branch."""
    return (
        _cash(txn)
        .where(F.col("_amt") >= threshold)
        .select(
            "txn_id",
            "customer_id",
            F.col("_chn").alias("channel"),
            F.col("_amt").alias("amount"),
            "narration",
            "txn_date",
        )
        .orderBy(F.col("amount").desc(), F.col("txn_id"))
        .limit(top)
    )


def risk_structuring(
    txn: DataFrame,
    low: int = STRUCTURING_LOW,
    high: int = STRUCTURING_HIGH,
    min_count: int = STRUCTURING_MIN_COUNT,
    top: int = 20,
) -> DataFrame:
    """Customers with ``min_count`` or more cash transactions in
    [``low``, ``high``] on one day.

    NULL customers are not excluded: they form one group per day.  That group
    (or any hot customer) is combined map-side by the partial aggregate, so
    the shuffle carries one row per (customer, day) per task.
    """
    return (
        _cash(txn)
        .where(F.col("_amt").between(low, high) & F.col("_tts").isNotNull())
        .groupBy(F.col("customer_id"), F.col("_day").alias("txn_day"))
        .agg(F.count(F.lit(1)).alias("cash_txn_count"), money_sum("_amt").alias("total_cash"))
        .where(F.col("cash_txn_count") >= min_count)
        .orderBy(
            F.col("cash_txn_count").desc(),
            F.col("total_cash").desc(),
            F.col("customer_id").asc_nulls_last(),
            F.col("txn_day"),
        )
        .limit(top)
    )


def risk_high_velocity(
    txn: DataFrame, min_count: int = VELOCITY_MIN_COUNT, top: int = 15
) -> DataFrame:
    """Customers with ``min_count`` or more transactions over the whole table
    (no time window): count, total, distinct channels and branches, and the
    first and last ``txn_date`` compared as text.

    Two passes.  The ranking needs only the count, so the first pass counts
    per customer (one small row per customer and task in the shuffle) and
    takes the ``top``.  The second keeps the rows of those customers.  They
    are the hottest keys, so their rows are combined per customer, channel and
    branch before the two distinct counts expand anything.  The join carries
    no hint: the ranked side is limited to ``top`` rows, and Spark picks the
    strategy from its size.
    """
    t = with_typed(txn).where(F.col("_amt").isNotNull() & F.col("customer_id").isNotNull())
    order = [F.col("txn_count").desc(), F.col("customer_id")]
    ranked = (
        t.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .where(F.col("txn_count") >= min_count)
        .orderBy(*order)
        .limit(top)
    )
    places = (
        t.join(ranked, "customer_id")
        .groupBy("customer_id", "txn_count", "_chn", "branch_code")
        .agg(F.sum("_amt").alias("_sum"), F.min("txn_date").alias("_first"), F.max("txn_date").alias("_last"))
    )
    return (
        places.groupBy("customer_id", "txn_count")
        .agg(
            money_sum("_sum").alias("total_amount"),
            F.count_distinct("_chn").alias("channels_used"),
            F.count_distinct("branch_code").alias("branches_used"),
            F.min("_first").alias("first_txn"),
            F.max("_last").alias("last_txn"),
        )
        .orderBy(*order)
    )


def risk_open_aml_alerts(alerts: DataFrame, top: int = 20) -> DataFrame:
    """Open alerts with the highest risk score (score and amount typed)."""
    return (
        alerts.where(norm("status") == "OPEN")
        .select(
            "alert_id",
            "customer_id",
            "customer_name",
            "alert_type",
            as_int("risk_score").alias("risk_score"),
            amt("total_amount").alias("total_amount"),
            "status",
            "priority",
            "alert_date",
        )
        .orderBy(F.col("risk_score").desc_nulls_last(), F.col("alert_id"))
        .limit(top)
    )


def risk_npa_summary(npa: DataFrame) -> DataFrame:
    """Per normalised NPA status: loans with a parseable principal, their
    principal total and the rounded average days past due (unparseable
    ``dpd`` left out of the average)."""
    typed = npa.select(
        norm("npa_status").alias("npa_status"),
        amt("outstanding_principal").alias("_principal"),
        as_int("dpd").alias("_dpd"),
    ).where(F.col("_principal").isNotNull())
    agg = typed.groupBy("npa_status").agg(
        F.count(F.lit(1)).alias("accounts"),
        money_sum("_principal").alias("total_outstanding"),
        F.sum("_dpd").alias("_dpd_sum"),
        F.count("_dpd").alias("_dpd_n"),
    )
    return agg.select(
        "npa_status",
        "accounts",
        "total_outstanding",
        int_avg("_dpd_sum", "_dpd_n").alias("avg_dpd"),
    ).orderBy(F.col("total_outstanding").desc_nulls_last())


def risk_low_cibil(cibil: DataFrame, max_score: int = LOW_CIBIL, top: int = 20) -> DataFrame:
    """Lowest credit scores below ``max_score`` (unparseable scores drop out)."""
    return (
        cibil.select(
            "customer_id",
            "customer_name",
            as_int("cibil_score").alias("cibil_score"),
            amt("total_outstanding").alias("total_outstanding"),
            as_int("dpd_90_count").alias("dpd_90_count"),
            "wilful_defaulter",
            "report_pull_date",
        )
        .where(F.col("cibil_score") < max_score)
        .orderBy(F.col("cibil_score"), F.col("customer_id").asc_nulls_last())
        .limit(top)
    )
