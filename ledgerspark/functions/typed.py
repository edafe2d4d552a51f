"""Typed columns over the all-text bronze records, and exact money math.

Bronze tables keep every business field as text (schema-on-read).  Queries
see real types only through ``try_cast``: text that does not parse becomes
NULL and is then filtered or counted, never an error.  All casts live here so
a query never spells one out twice.

Money is exact decimal throughout.  Averages and percentages are rounded
half away from zero with integer arithmetic on the aggregated sums and
counts, so the result is exact whatever the row count (a decimal quotient
rounded to a fixed scale first and to two places second could be off by a
cent once a group holds ~10^12 rows).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The types the analytics cast to.
MONEY = "decimal(18,2)"  # TRY_CAST(amount AS DECIMAL(18,2))
MONEY_TOTAL = "decimal(38,2)"  # sums and averages of money
PERCENT = "decimal(5,2)"  # share of total, two places
TS = "timestamp_ntz"  # zone-less business time, text form yyyy-MM-ddTHH:mm:ss
# a full date, alone or with at least hours and minutes; a zone is read over
TS_FORM = r"^ *\d{4}-\d{2}-\d{2}([T ]([01]\d|2[0-3]):\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)? *$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def amt(col: str | Column = "amount") -> Column:
    """Money amount; NULL when the text is not a number."""
    return _c(col).try_cast(MONEY)


def tts(col: str | Column = "txn_date") -> Column:
    """Business timestamp: a full date, alone or followed (after ``T`` or a
    space) by hours and minutes or more; NULL otherwise.

    The cast alone would read ``2026`` and ``2026-03`` as the first day of
    that year or month.
    """
    return F.when(_c(col).rlike(TS_FORM), _c(col).try_cast(TS))


def as_int(col: str | Column) -> Column:
    """Integer field (scores, day counts); NULL when not an integer."""
    return _c(col).try_cast("int")


def norm(col: str | Column) -> Column:
    """Normalised label: upper case, surrounding spaces removed."""
    return F.upper(F.trim(_c(col)))


def chn(col: str | Column = "channel") -> Column:
    return norm(col)


def txn_day(ts: Column) -> Column:
    return F.to_date(ts)


def txn_hour(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def zfill(col: str | Column, width: int) -> Column:
    """Left-pad digits with zeros to ``width``; longer text is kept whole.

    ``lpad`` alone would cut ids wider than ``width``.
    """
    s = _c(col).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def money_sum(col: str | Column) -> Column:
    """Aggregate: exact sum of a money column as ``decimal(38,2)``."""
    return F.sum(_c(col)).cast(MONEY_TOTAL)


def half_up_quotient(num: str | Column, den: str | Column) -> Column:
    """``num / den`` rounded to an integer, halves away from zero.

    Exact for integral ``num`` and positive integral ``den`` of any size:
    ``round(a / d) = (2a + d) div 2d`` for ``a >= 0``.  NULL when ``den`` is 0
    or NULL (no rows to average).
    """
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    q = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.when(d > 0, F.when(n < 0, -q).otherwise(q))


def money_avg(total: str | Column, count: str | Column) -> Column:
    """``ROUND(AVG(money), 2)`` from an exact money sum and its non-NULL count.

    Use on aggregated columns: ``total`` is ``money_sum(x)``, ``count`` is
    ``count(x)``.
    """
    cents = half_up_quotient(_c(total) * 100, count)
    return (cents.cast("decimal(36,0)") / 100).cast(MONEY_TOTAL)


def pct_of(count: str | Column, total: str | Column) -> Column:
    """Share of ``count`` in ``total``, in percent with two places."""
    # widen before scaling: a bigint count times 10000 could overflow
    basis_points = half_up_quotient(_c(count).cast("decimal(38,0)") * 10000, total)
    return (basis_points.cast("decimal(10,0)") / 100).cast(PERCENT)


def int_avg(total: str | Column, count: str | Column) -> Column:
    """``ROUND(AVG(int), 0)`` as an exact ``bigint`` from a sum and a count."""
    return half_up_quotient(total, count).cast("bigint")


# Typed columns a transactions frame carries once ``with_typed`` ran.  A silver
# table stores them, so filters on them reach the Parquet scan.
TYPED_COLUMNS = ("_amt", "_tts", "_chn", "_day")


def with_typed(df):
    """Add ``_amt``, ``_tts``, ``_chn`` and ``_day`` unless already present.

    Catalyst prunes whichever the query does not use, so this costs nothing
    beyond the casts a query needs.
    """
    have = set(df.columns)
    add = {}
    if "_amt" not in have:
        add["_amt"] = amt("amount")
    if "_tts" not in have:
        add["_tts"] = tts("txn_date")
    if "_chn" not in have:
        add["_chn"] = chn("channel")
    out = df.withColumns(add) if add else df
    if "_day" not in have:
        out = out.withColumn("_day", txn_day(F.col("_tts")))
    return out
