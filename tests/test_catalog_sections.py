"""Catalog checks, listings and the section runner over written bronze tables."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from frames import rows
from ledgerspark.plans import sections
from ledgerspark.plans.registry import bronze_frames, scratch_database
from ledgerspark.plans.silver import read_silver, write_silver
from ledgerspark import operators as op
from ledgerspark.session import fresh_path
from ledgerspark.sources import catalog
from ledgerspark.sources.bronze import append_bronze


@pytest.fixture(scope="module")
def bronze_db(spark):
    db = scratch_database(spark)
    for name, frame in bronze_frames(spark, SF_SMALL).items():
        if name != "cibil_bureau":  # one table absent on purpose
            append_bronze(frame, f"{db}.{name}")
    return db


def test_preflight(spark, bronze_db):
    assert catalog.preflight(spark, f"{bronze_db}.finacle_transactions", bronze_db)
    with pytest.raises(catalog.MissingObject):
        catalog.preflight(spark, f"{bronze_db}.nope", bronze_db)
    with pytest.raises(catalog.MissingObject):
        catalog.preflight(spark, "x.y", "no_such_namespace")
    with pytest.raises(catalog.MissingObject):
        catalog.preflight(spark, "x.y", bronze_db, catalog="no_such_catalog")
    assert catalog.has_catalog(spark, "spark_catalog")


def test_counts_skip_absent_tables(spark, bronze_db):
    got = {r.table_name: r.row_count for r in catalog.bronze_counts_in(spark, bronze_db).collect()}
    assert got == {"finacle_transactions": 1000, "finacle_customers": 150, "aml_alerts": 147, "npa_report": 1500}


def test_run_all_sections(spark, bronze_db):
    seen = []
    tables = sections.BronzeTables(namespace=bronze_db)
    n = sections.run_sections(spark, tables=tables, action=lambda name, df: seen.append((name, df.count())),
                              sections=tuple(sections.SECTIONS))
    names = [s for s, _ in seen]
    assert "risk_low_cibil" not in names  # its table is absent
    assert n == len(seen) == 19
    assert dict(seen)["risk_structuring"] == 20


def test_unknown_section(spark, bronze_db):
    with pytest.raises(KeyError):
        sections.run_sections(spark, "counts_v0", tables=sections.BronzeTables(namespace=bronze_db))


def test_empty_table_reports_nothing(spark):
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.finacle_transactions (txn_id string) USING parquet")
    assert sections.run_sections(spark, tables=sections.BronzeTables(namespace=db)) == 0


def test_sections_need_only_their_own_tables(spark):
    db = scratch_database(spark)
    append_bronze(bronze_frames(spark, SF_SMALL)["aml_alerts"], f"{db}.aml_alerts")
    tables, seen = sections.BronzeTables(namespace=db), []
    act = lambda name, df: seen.append((name, df.count()))
    assert sections.run_sections(spark, "risk_tables", tables, act) == 1
    assert sections.run_sections(spark, "counts", tables, act) == 2
    assert dict(seen) == {"risk_open_aml_alerts": 20, "bronze_tables": 1, "bronze_counts": 1}
    with pytest.raises(catalog.MissingObject):
        sections.run_sections(spark, "kpi", tables, act)


def test_a_failing_query_does_not_stop_its_section(spark, bronze_db):
    db = scratch_database(spark)
    append_bronze(spark.table(f"{bronze_db}.finacle_transactions").drop("txn_type", "_batch"), f"{db}.finacle_transactions")
    seen = []
    with pytest.raises(RuntimeError, match="pattern_txn_type"):
        sections.run_sections(spark, "pattern", sections.BronzeTables(namespace=db), lambda n, df: seen.append((n, df.count())))
    assert [n for n, _ in seen] == ["pattern_channel", "pattern_branch_top15"]


def test_reports_are_printed_whole(spark, capsys):
    sections.show("x", spark.range(30))
    assert "only showing" not in capsys.readouterr().out


def test_only_missing_names_count_as_missing(spark, monkeypatch):
    assert not catalog.table_exists(spark, "no_such_catalog.x.y")
    assert not catalog.table_exists(spark, "no_such_namespace.y")

    def broken(name):
        raise RuntimeError("metastore is down")

    monkeypatch.setattr(type(spark.catalog), "tableExists", lambda self, name: broken(name))
    with pytest.raises(RuntimeError, match="metastore"):
        catalog.table_exists(spark, "bronze.t")


def test_silver_refresh_and_file_count(spark, bronze_db):
    import os

    bronze = spark.table(f"{bronze_db}.finacle_transactions").repartition(40)
    path = fresh_path(spark, "silver")
    write_silver(bronze, path, mode="refresh")
    first = rows(read_silver(spark, path))
    days = read_silver(spark, path).select("_day").distinct().count()
    files = sum(f.endswith(".parquet") for _, _, names in os.walk(path.replace("file:", "")) for f in names)
    assert len(first) == 1000 and files <= 2 * days
    write_silver(bronze, path, mode="refresh")  # again: nothing doubles
    assert rows(read_silver(spark, path)) == first
    one_day = bronze.where("txn_date like '2024-01-05%'")
    write_silver(one_day.withColumn("narration", F.lit("late")), path, mode="refresh")
    after = read_silver(spark, path)
    assert after.count() == 1000 and after.where("narration = 'late'").count() == one_day.count() > 0
    ns = scratch_database(spark)
    for _ in range(2):
        write_silver(bronze, table=f"{ns}.s", mode="refresh")
    assert spark.table(f"{ns}.s").count() == 1000
    write_silver(bronze, table=f"{ns}.s")
    assert spark.table(f"{ns}.s").count() == 2000
    with pytest.raises(ValueError):
        write_silver(bronze, path, mode="replace")


def test_silver_gives_same_answers_and_pushes_filters(spark, bronze_db):
    bronze = spark.table(f"{bronze_db}.finacle_transactions")
    path = fresh_path(spark, "silver")
    write_silver(bronze, path)
    silver = read_silver(spark, path)
    for fn in (op.kpi_overall, op.risk_structuring, op.pattern_channel, op.risk_high_velocity, op.volume_daily):
        assert rows(fn(silver)) == rows(fn(bronze)), fn.__name__
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        op.risk_high_value_cash(silver).explain("formatted")
    plan = buf.getvalue()
    assert "EqualTo(_chn,CASH)" in plan and "GreaterThanOrEqual(_amt,1000000.00)" in plan


def test_counts_of_empty_namespace_and_listing_without_temp_views(spark):
    db = scratch_database(spark)
    empty = catalog.bronze_counts_in(spark, db)
    assert empty.count() == 0 and empty.columns == ["table_name", "row_count"]
    spark.range(3).createOrReplaceTempView("finacle_transactions")
    spark.range(1).write.saveAsTable(f"{db}.aml_alerts")
    assert [r.table_name for r in catalog.bronze_tables(spark, db).collect()] == ["aml_alerts"]
    assert {r.table_name: r.row_count for r in catalog.bronze_counts_in(spark, db).collect()} == {"aml_alerts": 1}
    spark.catalog.dropTempView("finacle_transactions")


def test_silver_as_catalog_table_prunes_days(spark, bronze_db):
    import contextlib
    import io

    from pyspark.sql import functions as F

    bronze = spark.table(f"{bronze_db}.finacle_transactions")
    ns = scratch_database(spark)
    write_silver(bronze, table=f"{ns}.finacle_transactions")
    silver = spark.table(f"{ns}.finacle_transactions")
    assert rows(op.kpi_overall(silver)) == rows(op.kpi_overall(bronze))
    one_day = silver.where(F.col("_day") == F.lit("2024-01-05").cast("date"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        op.txn_data_quality(one_day).explain("formatted")
    assert "PartitionFilters: [isnotnull(_day" in buf.getvalue()
    assert one_day.count() == bronze.where(F.col("txn_date").startswith("2024-01-05")).count()
