"""Results do not depend on how the input is partitioned or ordered.

On a cluster the records arrive in many splits in no particular order; every
operator (including the top-k cuts, which carry unique tie-breaks) must give
the same rows as on one ordered split.
"""

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from frames import rows
from ledgerspark import operators as op
from ledgerspark.sources import fixtures

TXN_OPS = [
    op.kpi_overall, op.volume_daily, op.volume_hourly, op.pattern_channel, op.pattern_txn_type,
    op.pattern_branch_top15, op.risk_high_value_cash, op.risk_structuring, op.risk_high_velocity,
    op.txn_channel_distribution, op.txn_branch_type_top15, op.txn_hourly, op.txn_data_quality,
    op.risk_high_value_cash_channel, op.derive_ref_number,
]


@pytest.fixture(scope="module")
def frames(spark):
    events = fixtures.load(spark, "/root/testdata/sf0.01", "events")
    scattered = events.repartition(17).sortWithinPartitions(F.rand(7))
    return fixtures.transactions(events), fixtures.transactions(scattered)


@pytest.mark.parametrize("fn", TXN_OPS, ids=lambda f: f.__name__)
def test_same_rows_when_scattered(frames, fn):
    one, many = frames
    assert rows(fn(many)) == rows(fn(one))


def test_alerts_and_other_tables_when_scattered(spark):
    events = fixtures.load(spark, SF_SMALL, "events")
    orders = fixtures.load(spark, SF_SMALL, "orders")
    customer = fixtures.load(spark, SF_SMALL, "customer")
    assert rows(op.risk_open_aml_alerts(fixtures.aml_alerts(events.repartition(9)))) == \
        rows(op.risk_open_aml_alerts(fixtures.aml_alerts(events)))
    assert rows(op.risk_npa_summary(fixtures.npa_report(orders.repartition(9)))) == \
        rows(op.risk_npa_summary(fixtures.npa_report(orders)))
    assert rows(op.risk_low_cibil(fixtures.cibil_bureau(customer.repartition(9)))) == \
        rows(op.risk_low_cibil(fixtures.cibil_bureau(customer)))
