"""Data-quality counts over the transactions table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import with_typed


def _count_when(cond: Column) -> Column:
    # SUM(CASE ...) rather than count_if: NULL, not 0, on an empty table.
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def txn_data_quality(txn: DataFrame) -> DataFrame:
    """Total rows; rows whose amount or date does not parse (NULL included);
    rows without a customer."""
    t = with_typed(txn)
    return t.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _count_when(F.col("_amt").isNull()).alias("bad_amount"),
        _count_when(F.col("_tts").isNull()).alias("bad_txn_date"),
        _count_when(F.col("customer_id").isNull()).alias("missing_customer"),
    )
