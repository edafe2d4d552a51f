"""Threshold boundaries, label normalisation, NULL groups, exact rounding."""

from decimal import Decimal

from pyspark.sql import functions as F

from frames import txn_rows
from ledgerspark import operators as op
from ledgerspark.functions import half_up_quotient, money_avg, money_sum


def cash(amount, **kw):
    return {"channel": "CASH", "amount": amount, **kw}


def test_structuring_bounds(spark):
    df = txn_rows(spark, [cash(a) for a in ("899999.99", "900000", "999999", "999999.01")])
    rows = op.risk_structuring(df).collect()
    assert len(rows) == 1
    assert rows[0].cash_txn_count == 2
    assert rows[0].total_cash == Decimal("1899999.00")


def test_structuring_needs_two(spark):
    df = txn_rows(spark, [cash("950000")])
    assert op.risk_structuring(df).count() == 0


def test_structuring_null_customer_is_one_group(spark):
    df = txn_rows(spark, [cash("950000", customer_id=None), cash("960000", customer_id=None)])
    rows = op.risk_structuring(df).collect()
    assert [(r.customer_id, r.cash_txn_count) for r in rows] == [(None, 2)]


def test_structuring_groups_by_day(spark):
    df = txn_rows(
        spark,
        [cash("950000", txn_date="2026-03-15T09:00:00"), cash("950000", txn_date="2026-03-16T09:00:00")],
    )
    assert op.risk_structuring(df).count() == 0


def test_high_value_bound(spark):
    df = txn_rows(spark, [cash("999999.99"), cash("1000000")])
    rows = op.risk_high_value_cash(df).collect()
    assert [r.amount for r in rows] == [Decimal("1000000.00")]


def test_gap_between_cash_rules_is_kept(spark):
    # 999,999.01-999,999.99 is neither structuring nor high value
    df = txn_rows(spark, [cash("999999.50"), cash("999999.50")])
    assert op.risk_structuring(df).count() == 0
    assert op.risk_high_value_cash(df).count() == 0


def test_channel_labels(spark):
    df = txn_rows(spark, [cash("2000000", channel=c) for c in ("CASH", " cash ", "Cash", "\tcash")])
    assert op.risk_high_value_cash(df).count() == 3  # trim removes spaces only


def test_flag_rule_bound(spark):
    df = txn_rows(spark, [cash("500000"), cash("500000.01"), {"channel": "UPI", "amount": "900000"}])
    got = [r.status for r in op.derive_flag(df).orderBy("txn_id").collect()]
    assert got == ["SUCCESS", "FLAGGED", "SUCCESS"]


def test_velocity_threshold(spark):
    rows = [{"customer_id": "C19"}] * 19 + [{"customer_id": "C20"}] * 20 + [{"customer_id": "C20", "amount": "x"}]
    out = op.risk_high_velocity(txn_rows(spark, rows)).collect()
    assert [(r.customer_id, r.txn_count) for r in out] == [("C20", 20)]


def test_velocity_text_min_max_and_distincts(spark):
    rows = [
        {"customer_id": "C", "txn_date": d, "channel": c, "branch_code": b}
        for d, c, b in [("2026-03-01T00:00:00", "UPI", "BR1"), ("bad-date", " upi", "BR2"), ("2026-02-01T00:00:00", "CASH", "BR1")]
    ] * 7
    r = op.risk_high_velocity(txn_rows(spark, rows)).collect()[0]
    assert (r.channels_used, r.branches_used) == (2, 2)
    assert (r.first_txn, r.last_txn) == ("2026-02-01T00:00:00", "bad-date")


def test_low_cibil(spark):
    df = spark.createDataFrame(
        [(f"C{i}", "n", s, "10.00", "1", "N", "2026-03-31") for i, s in enumerate(["599", "600", "NA", None])],
        "customer_id string, customer_name string, cibil_score string, total_outstanding string, "
        "dpd_90_count string, wilful_defaulter string, report_pull_date string",
    )
    assert [r.cibil_score for r in op.risk_low_cibil(df).collect()] == [599]


def test_npa_average_skips_bad_dpd(spark):
    df = spark.createDataFrame(
        [("L1", " npa ", "10.00", "1"), ("L2", "NPA", "20.00", "2"), ("L3", "npa", "30.00", "bad"), ("L4", "npa", "x", "9")],
        "loan_id string, npa_status string, outstanding_principal string, dpd string",
    )
    r = op.risk_npa_summary(df).collect()
    assert [(x.npa_status, x.accounts, x.total_outstanding, x.avg_dpd) for x in r] == [("NPA", 3, Decimal("60.00"), 2)]


def test_half_up_quotient(spark):
    vals = [(5, 2), (-5, 2), (7, 3), (1, 0), (10**18, 3)]
    df = spark.createDataFrame([(Decimal(n), d) for n, d in vals], "n decimal(38,0), d long")
    got = [r.q for r in df.select(half_up_quotient("n", "d").alias("q")).collect()]
    assert got == [3, -3, 2, None, 333333333333333333]


def test_money_avg_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "x decimal(18,2)")
    r = df.agg(money_sum("x").alias("t"), F.count("x").alias("n")).select(money_avg("t", "n").alias("a")).collect()[0]
    assert r.a == Decimal("0.02")


def test_kpi_avg_ignores_unparseable(spark):
    df = txn_rows(spark, [{"amount": "1.00"}, {"amount": "2.00"}, {"amount": "oops"}])
    r = op.kpi_overall(df).collect()[0]
    assert (r.total_transactions, r.total_volume_inr, r.avg_amount_inr) == (3, Decimal("3.00"), Decimal("1.50"))


def test_pct_of_total_and_null_channel(spark):
    df = txn_rows(spark, [{"channel": "UPI"}, {"channel": " upi"}, {"channel": "ATM"}, {"channel": None}])
    pct = {r.channel: r.pct_of_total for r in op.pattern_channel(df).collect()}
    assert pct == {"UPI": Decimal("66.67"), "ATM": Decimal("33.33")}
    groups = {r.channel: r.txn_count for r in op.txn_channel_distribution(df).collect()}
    assert groups == {"UPI": 2, "ATM": 1, None: 1}


def test_data_quality_counts(spark):
    df = txn_rows(spark, [{"amount": "x"}, {"txn_date": "nope", "customer_id": None}, {}])
    r = op.txn_data_quality(df).collect()[0]
    assert (r.total_rows, r.bad_amount, r.bad_txn_date, r.missing_customer) == (3, 1, 1, 1)


def test_volume_daily_keeps_newest_days_present(spark):
    rows = [{"txn_date": f"2026-01-{d:02d}T10:00:00"} for d in range(1, 32)] + [{"txn_date": "2026-03-01T00:00:00"}]
    days = [r.txn_day.isoformat() for r in op.volume_daily(txn_rows(spark, rows), days=3).collect()]
    assert days == ["2026-03-01", "2026-01-31", "2026-01-30"]


def test_ref_number_keeps_long_sequence(spark):
    df = txn_rows(spark, [{"txn_id": "TXN1234567", "channel": " cash ", "txn_date": "2026-03-15T23:59:59"}])
    r = op.derive_ref_number(df).collect()[0]
    assert (r.derived_txn_id, r.derived_ref_number) == ("TXN202603151234567", "CASH202603151234567")


def test_alerts_one_per_flagged(spark):
    df = op.derive_flag(txn_rows(spark, [cash("600000"), cash("100"), cash("700000", channel=" cash ")]))
    alerts = op.derive_aml_alerts(df).collect()
    assert len(alerts) == 2
    a = alerts[0].asDict()
    assert a["sar_filed"] is None and a["assigned_to"] is None
    assert 60 <= int(a["risk_score"]) <= 99
    assert a["status"] in ("OPEN", "UNDER_REVIEW") and a["priority"] in ("CRITICAL", "HIGH", "MEDIUM")


def test_kpi_on_empty_table(spark):
    r = op.kpi_overall(txn_rows(spark, [{}]).limit(0)).collect()[0]
    assert r.total_transactions == 0 and r.active_customers == 0
    assert r.total_volume_inr is None and r.avg_amount_inr is None and r.earliest_txn is None


def test_kpi_distincts_ignore_null(spark):
    rows = [{"customer_id": None, "account_id": "A1"}, {"customer_id": "C1", "account_id": "A1"},
            {"customer_id": "C2", "account_id": "A2", "branch_code": "BR9"}]
    r = op.kpi_overall(txn_rows(spark, rows)).collect()[0]
    assert (r.total_transactions, r.active_customers, r.unique_accounts, r.unique_branches) == (3, 2, 2, 2)


def test_velocity_is_the_same_for_any_top(spark):
    rows = [{"customer_id": f"C{i % 3}", "branch_code": f"B{i % 7}"} for i in range(70)]
    df = txn_rows(spark, rows)
    small, large = op.risk_high_velocity(df), op.risk_high_velocity(df, top=10**7)
    assert small.collect() == large.collect()
    assert [r.customer_id for r in small.collect()] == ["C0", "C1", "C2"]
    for d in (small, large):  # no size is forced on the join
        assert "strategy=broadcast" not in d._jdf.queryExecution().analyzed().toString()


def test_business_time_needs_a_full_date(spark):
    from ledgerspark.functions import amt, tts
    from ledgerspark.sources.fixtures import BAD_AMOUNTS, BAD_DATES

    good = ["2026-03-15", "2026-03-15T10:00", "2026-03-15 10:00:01", " 2026-03-15T23:59:59.5 "]
    df = spark.createDataFrame([(x,) for x in good], "x string")
    assert df.where(tts("x").isNull()).count() == 0
    bad = spark.createDataFrame([(x,) for x in BAD_DATES], "x string")
    assert [r.x for r in bad.where(tts("x").isNotNull()).collect()] == []
    bad = spark.createDataFrame([(x,) for x in BAD_AMOUNTS], "x string")
    assert [r.x for r in bad.where(amt("x").isNotNull()).collect()] == []
    assert len(BAD_DATES) >= 10 and len(BAD_AMOUNTS) >= 10


def test_alerts_for_ids_of_another_form(spark):
    df = op.derive_flag(txn_rows(spark, [cash("600000", txn_id=f"UPI-TXN{i}") for i in range(20)]))
    alerts = op.derive_aml_alerts(df).collect()
    assert len(alerts) == 20
    assert all(a.alert_type and a.status and a.priority and a.rule_triggered and a.description for a in alerts)
    assert all(60 <= int(a.risk_score) <= 99 for a in alerts) and len({a.alert_type for a in alerts}) > 1
    assert op.risk_open_aml_alerts(op.derive_aml_alerts(df)).count() > 0
    long = "TXN" + "9" * 200
    r = op.derive_aml_alerts(op.derive_flag(txn_rows(spark, [cash("600000", txn_id=long)]))).first()
    assert r.alert_id == "AML" + "9" * 200
