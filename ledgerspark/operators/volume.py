"""Volume over time: per business day and per hour of day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import money_avg, money_sum, txn_hour, with_typed


def _dated_money(txn: DataFrame) -> DataFrame:
    t = with_typed(txn)
    return t.where(F.col("_tts").isNotNull() & F.col("_amt").isNotNull())


def volume_daily(txn: DataFrame, days: int = 30) -> DataFrame:
    """Count, money total and distinct customers per day, for the newest
    ``days`` days that have transactions (not calendar days)."""
    return (
        _dated_money(txn)
        .groupBy(F.col("_day").alias("txn_day"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            money_sum("_amt").alias("total_amount"),
            F.count_distinct("customer_id").alias("active_customers"),
        )
        .orderBy(F.col("txn_day").desc())
        .limit(days)
    )


def _by_hour(df: DataFrame) -> DataFrame:
    # At most 24 rows (hour of day): move them to one partition and order them
    # there, instead of a range shuffle with its sampling job.  repartition,
    # not coalesce, so the final aggregate above still runs in parallel.
    return df.repartition(1).sortWithinPartitions("txn_hour")


def volume_hourly(txn: DataFrame) -> DataFrame:
    """Count, average and total per hour of day; absent hours are not filled."""
    return (
        _dated_money(txn)
        .groupBy(txn_hour(F.col("_tts")).alias("txn_hour"))
        .agg(F.count(F.lit(1)).alias("txn_count"), money_sum("_amt").alias("total_amount"))
        .select(
            "txn_hour",
            "txn_count",
            money_avg("total_amount", "txn_count").alias("avg_amount"),
            "total_amount",
        )
        .transform(_by_hour)
    )


def txn_hourly(txn: DataFrame) -> DataFrame:
    """``volume_hourly`` without the average."""
    return (
        _dated_money(txn)
        .groupBy(txn_hour(F.col("_tts")).alias("txn_hour"))
        .agg(F.count(F.lit(1)).alias("txn_count"), money_sum("_amt").alias("total_amount"))
        .transform(_by_hour)
    )
