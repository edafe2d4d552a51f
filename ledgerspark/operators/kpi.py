"""Headline numbers over the whole transactions table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import money_avg, money_sum, with_typed


def kpi_overall(txn: DataFrame) -> DataFrame:
    """One row: counts, distinct customers/accounts/branches, money volume and
    average, first/last business time, last ingestion time.

    One level: the partial aggregation runs on the rows, and the three exact
    distinct counts shuffle one row per distinct value and task.
    """
    agg = with_typed(txn).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_distinct("customer_id").alias("active_customers"),
        F.count_distinct("account_id").alias("unique_accounts"),
        F.count_distinct("branch_code").alias("unique_branches"),
        money_sum("_amt").alias("total_volume_inr"),
        F.count("_amt").alias("_n_amt"),
        F.min("_tts").alias("earliest_txn"),
        F.max("_tts").alias("latest_txn"),
        F.max("_ingestion_ts").alias("last_ingested"),
    )
    return agg.select(
        "total_transactions",
        "active_customers",
        "unique_accounts",
        "unique_branches",
        "total_volume_inr",
        money_avg("total_volume_inr", "_n_amt").alias("avg_amount_inr"),
        "earliest_txn",
        "latest_txn",
        "last_ingested",
    )
