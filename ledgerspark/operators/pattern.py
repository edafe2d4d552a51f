"""Distribution of transactions by channel, type and branch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import MONEY, money_avg, money_sum, norm, pct_of, with_typed


def _money(txn: DataFrame) -> DataFrame:
    t = with_typed(txn)
    return t.where(F.col("_amt").isNotNull())


def pattern_channel(txn: DataFrame) -> DataFrame:
    """Per normalised channel (NULL channel excluded): count, total, average
    and share of all counted transactions.

    The total behind the shares is a scalar subquery over the same aggregate.
    It keeps all of the aggregate's columns, so Spark reuses the exchange: one
    scan, and no task has to hold all channels.
    """
    agg = (
        _money(txn)
        .where(F.col("channel").isNotNull())
        .groupBy(F.col("_chn").alias("channel"))
        .agg(F.count(F.lit(1)).alias("txn_count"), money_sum("_amt").alias("total_amount"))
    )
    whole = agg.agg(F.struct(F.sum("txn_count").alias("n"), F.sum("total_amount").alias("amount")).alias("w")).scalar()
    return (
        agg.withColumn("_whole", whole)
        .select(
            "channel",
            "txn_count",
            "total_amount",
            money_avg("total_amount", "txn_count").alias("avg_amount"),
            pct_of("txn_count", F.col("_whole").getField("n")).alias("pct_of_total"),
        )
        .orderBy(F.col("txn_count").desc())
    )


def pattern_txn_type(txn: DataFrame) -> DataFrame:
    """Per normalised transaction type (NULL excluded): count, total, min, max."""
    return (
        _money(txn)
        .where(F.col("txn_type").isNotNull())
        .groupBy(norm("txn_type").alias("txn_type"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            money_sum("_amt").alias("total_amount"),
            F.min("_amt").cast(MONEY).alias("min_amount"),
            F.max("_amt").cast(MONEY).alias("max_amount"),
        )
        .orderBy(F.col("total_amount").desc())
    )


def pattern_branch_top15(txn: DataFrame, top: int = 15) -> DataFrame:
    """Top branches (raw code, not normalised) by money total."""
    return (
        _money(txn)
        .where(F.col("branch_code").isNotNull())
        .groupBy("branch_code")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            money_sum("_amt").alias("total_amount"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .orderBy(F.col("total_amount").desc(), F.col("branch_code"))
        .limit(top)
    )


def txn_channel_distribution(txn: DataFrame) -> DataFrame:
    """Per normalised channel, NULL channel kept as its own group: count,
    total, average, distinct customers."""
    agg = (
        _money(txn)
        .groupBy(F.col("_chn").alias("channel"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            money_sum("_amt").alias("total_amount"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    return agg.select(
        "channel",
        "txn_count",
        "total_amount",
        money_avg("total_amount", "txn_count").alias("avg_amount"),
        "unique_customers",
    ).orderBy(F.col("total_amount").desc())


def txn_branch_type_top15(txn: DataFrame, top: int = 15) -> DataFrame:
    """Top (branch, normalised type) pairs by money total."""
    return (
        _money(txn)
        .groupBy(F.col("branch_code"), norm("txn_type").alias("txn_type"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            money_sum("_amt").alias("total_amount"),
            F.max("_amt").cast(MONEY).alias("max_amount"),
        )
        .orderBy(
            F.col("total_amount").desc(),
            F.col("branch_code").asc_nulls_last(),
            F.col("txn_type").asc_nulls_last(),
        )
        .limit(top)
    )
