"""Named groups of analytics over bronze tables, run one group or all.

Live sections (over the transactions table): ``kpi``, ``volume``,
``pattern``, ``risk``.  Documented sections: ``counts`` (catalog listing,
row counts, schema), ``txn`` (transaction breakdowns and data quality) and
``risk_tables`` (cash, open alerts, NPA, credit scores; each only when its
table exists).

Each query is a lazy DataFrame handed to ``action`` (default: print the
report).  A query runs when the table it reads exists and has rows; others
are skipped with a warning.  A failing query does not stop the others; all
failures are raised together at the end.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerspark import operators as op
from ledgerspark.sources import catalog
from ledgerspark.sources.compaction import live
from ledgerspark.sources.schemas import BRONZE_NAMESPACE, BRONZE_TABLES

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BronzeTables:
    namespace: str = BRONZE_NAMESPACE
    transactions: str = "finacle_transactions"
    alerts: str = "aml_alerts"
    npa: str = "npa_report"
    cibil: str = "cibil_bureau"
    catalog: str | None = None  # e.g. an Iceberg catalog; None: the session catalog

    @property
    def qualified_namespace(self) -> str:
        return f"{self.catalog}.{self.namespace}" if self.catalog else self.namespace

    def name(self, table: str) -> str:
        return f"{self.qualified_namespace}.{table}"


Builder = Callable[[SparkSession, BronzeTables], DataFrame]


@dataclass(frozen=True)
class Report:
    """One query of a section: what it reads (an attribute of ``BronzeTables``,
    or None for the catalog itself) and how it is built."""

    reads: str | None
    build: Builder


def _on(attr: str, fn: Callable[[DataFrame], DataFrame]) -> Report:
    return Report(attr, lambda spark, t: fn(live(spark, t.name(getattr(t, attr)))))


def _txn(fn: Callable[[DataFrame], DataFrame]) -> Report:
    return _on("transactions", fn)


SECTIONS: dict[str, dict[str, Report]] = {
    "kpi": {"kpi_overall": _txn(op.kpi_overall)},
    "volume": {
        "volume_daily": _txn(op.volume_daily),
        "volume_hourly": _txn(op.volume_hourly),
    },
    "pattern": {
        "pattern_channel": _txn(op.pattern_channel),
        "pattern_txn_type": _txn(op.pattern_txn_type),
        "pattern_branch_top15": _txn(op.pattern_branch_top15),
    },
    "risk": {
        "risk_high_value_cash": _txn(op.risk_high_value_cash),
        "risk_structuring": _txn(op.risk_structuring),
        "risk_high_velocity": _txn(op.risk_high_velocity),
    },
    "counts": {
        "bronze_tables": Report(None, lambda spark, t: catalog.bronze_tables(spark, t.qualified_namespace)),
        "bronze_counts": Report(
            None, lambda spark, t: catalog.bronze_counts_in(spark, t.qualified_namespace, BRONZE_TABLES)
        ),
        "bronze_schema": Report(
            "transactions", lambda spark, t: catalog.bronze_schema(spark, t.name(t.transactions))
        ),
    },
    "txn": {
        "txn_channel_distribution": _txn(op.txn_channel_distribution),
        "txn_branch_type_top15": _txn(op.txn_branch_type_top15),
        "txn_hourly": _txn(op.txn_hourly),
        "txn_data_quality": _txn(op.txn_data_quality),
    },
    "risk_tables": {
        "risk_high_value_cash_channel": _on("transactions", op.risk_high_value_cash_channel),
        "risk_open_aml_alerts": _on("alerts", op.risk_open_aml_alerts),
        "risk_npa_summary": _on("npa", op.risk_npa_summary),
        "risk_low_cibil": _on("cibil", op.risk_low_cibil),
    },
}
LIVE_SECTIONS = ("kpi", "volume", "pattern", "risk")


def show(name: str, df: DataFrame, rows: int = 1000) -> None:
    """Print a report; the longest one is bounded (30 days), the rest by their
    number of groups."""
    print(f"--- {name} ---")
    df.show(rows, truncate=False)


def run_sections(
    spark: SparkSession,
    section: str | None = None,
    tables: BronzeTables = BronzeTables(),
    action: Callable[[str, DataFrame], None] = show,
    sections: tuple[str, ...] = LIVE_SECTIONS,
) -> int:
    """Run one section, or every section in ``sections``; returns the number of
    queries run.

    A missing catalog or namespace raises ``catalog.MissingObject``, and so
    does a section none of whose tables exists; an unknown section raises
    ``KeyError``.  Tables that no chosen query reads are not looked at.
    """
    if section is not None and section not in SECTIONS:
        raise KeyError(f"unknown section {section!r}; known: {sorted(SECTIONS)}")
    catalog.require_namespace(spark, tables.namespace, tables.catalog)
    chosen = {n: r for sec in ([section] if section else sections) for n, r in SECTIONS[sec].items()}
    needed = {r.reads for r in chosen.values() if r.reads}
    exists = {attr: catalog.table_exists(spark, tables.name(getattr(tables, attr))) for attr in needed}
    if needed and not any(exists.values()) and all(r.reads for r in chosen.values()):
        raise catalog.MissingObject(f"no table of {sorted(getattr(tables, a) for a in needed)} in {tables.qualified_namespace}")
    filled = {a: ok and not spark.table(tables.name(getattr(tables, a))).isEmpty() for a, ok in exists.items()}
    ran, failures = 0, {}
    for name, report in chosen.items():
        if report.reads and not filled[report.reads]:
            state = "empty" if exists[report.reads] else "missing"
            log.warning("%s skipped: %s is %s", name, tables.name(getattr(tables, report.reads)), state)
            continue
        try:
            action(name, report.build(spark, tables))
            ran += 1
        except Exception as exc:
            log.error("%s failed: %s", name, exc)
            failures[name] = exc
    if failures:
        raise RuntimeError(f"queries failed: {sorted(failures)}") from next(iter(failures.values()))
    return ran
