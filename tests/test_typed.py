"""The typed-column layer: one place for casts and rounding."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerspark.functions import amt, as_int, chn, money_avg, money_sum, tts, txn_hour, zfill


def one(spark, col, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("v")).collect()[0].v


def test_timestamps(spark):
    assert one(spark, tts("x"), "2026-03-15T10:11:12") == dt.datetime(2026, 3, 15, 10, 11, 12)
    assert one(spark, tts("x"), "2026-03-15 10:11:12") == dt.datetime(2026, 3, 15, 10, 11, 12)
    assert one(spark, tts("x"), "bad-date") is None
    # zone-less type: an offset in the text does not shift the wall clock
    assert one(spark, tts("x"), "2026-03-15T10:11:12+05:30") == dt.datetime(2026, 3, 15, 10, 11, 12)
    assert one(spark, txn_hour(tts("x")), "2026-03-15T23:59:59") == 23


def test_amounts(spark):
    assert one(spark, amt("x"), "1234.5") == Decimal("1234.50")
    assert one(spark, amt("x"), "1.005") == Decimal("1.01")  # third place rounds half up
    assert one(spark, amt("x"), "N/A") is None
    assert one(spark, amt("x"), "") is None
    assert one(spark, as_int("x"), "5.7") is None  # not an integer
    assert one(spark, as_int("x"), "42") == 42


def test_labels(spark):
    assert one(spark, chn("x"), "  cash ") == "CASH"
    assert one(spark, chn("x"), "\tcash") == "\tCASH"  # only spaces are trimmed
    assert one(spark, chn("x"), None) is None


def test_zfill_never_truncates(spark):
    assert one(spark, zfill("x", 6), 42, "x long") == "000042"
    assert one(spark, zfill("x", 6), 1234567, "x long") == "1234567"


def test_negative_average_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("-0.01"),), (Decimal("-0.02"),)], "x decimal(18,2)")
    r = df.agg(money_sum("x").alias("t"), F.count("x").alias("n")).select(money_avg("t", "n").alias("a"))
    assert r.collect()[0].a == Decimal("-0.02")


def test_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x decimal(18,2)")
    r = df.agg(money_sum("x").alias("t"), F.count("x").alias("n")).select(money_avg("t", "n").alias("a"))
    assert r.collect()[0].a is None
