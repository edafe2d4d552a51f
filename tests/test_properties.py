"""Property tests for the exact arithmetic (one Spark job per generated batch)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspark.functions import half_up_quotient, money_avg, money_sum, pct_of, zfill

SETTINGS = settings(max_examples=15, deadline=None)


def _half_up(n: int, d: int) -> int:
    return int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**20, 10**20), st.integers(1, 10**12)), min_size=1, max_size=50))
def test_half_up_quotient_matches_decimal(spark, pairs):
    pairs = [(n, d) for n, d in pairs if abs(n) // d < 2**62]  # result fits a bigint
    if not pairs:
        return
    df = spark.createDataFrame([(Decimal(n), d) for n, d in pairs], "n decimal(38,0), d long")
    got = [r.q for r in df.select(half_up_quotient("n", "d").alias("q")).collect()]
    assert got == [_half_up(n, d) for n, d in pairs]


money = st.decimals(min_value=Decimal("-9999999.99"), max_value=Decimal("9999999.99"), places=2,
                    allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(money, min_size=1, max_size=200))
def test_money_avg_is_exact_round_half_up(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(18,2)")
    r = df.agg(money_sum("x").alias("t"), F.count("x").alias("n")).select("t", money_avg("t", "n").alias("a")).collect()[0]
    exact = (sum(values) / Decimal(len(values))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert r.t == sum(values) and r.a == exact


@SETTINGS
@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=40))
def test_percentages_are_exact(spark, counts):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "k int, c long")
    got = {r.k: r.p for r in df.withColumn("t", F.lit(sum(counts)).cast("long")).select("k", pct_of("c", "t").alias("p")).collect()}
    total = sum(counts)
    for i, c in enumerate(counts):
        assert got[i] == (Decimal(100 * c) / total).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@SETTINGS
@given(st.lists(st.integers(0, 10**15), min_size=1, max_size=50), st.integers(1, 12))
def test_zfill_matches_python(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r.z for r in df.select(zfill("v", width).alias("z")).collect()]
    assert got == [str(v).zfill(width) for v in values]
