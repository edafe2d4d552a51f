"""Small literal frames for edge tests."""

from __future__ import annotations

import datetime as dt

from ledgerspark.sources.schemas import TRANSACTION_FIELDS

TXN_DDL = ", ".join(f"{f} string" for f in TRANSACTION_FIELDS) + ", _ingestion_ts timestamp_ntz"


def txn_rows(spark, rows: list[dict]):
    """Transactions frame; unspecified fields default to a clean row."""
    base = {
        "txn_id": None,
        "account_id": "ACCT000001",
        "customer_id": "CUST000001",
        "txn_type": "DEBIT",
        "amount": "100.00",
        "currency": "INR",
        "txn_date": "2026-03-15T10:00:00",
        "value_date": "2026-03-15",
        "branch_code": "BR001",
        "channel": "UPI",
        "narration": "TEST",
        "balance_after": "1000.00",
        "status": "SUCCESS",
        "ref_number": None,
        "_ingestion_ts": dt.datetime(2026, 3, 16),
    }
    out = []
    for i, r in enumerate(rows):
        row = dict(base)
        row["txn_id"] = f"TXN{i + 1:012d}"
        row.update(r)
        out.append(tuple(row[k] for k in list(TRANSACTION_FIELDS) + ["_ingestion_ts"]))
    return spark.createDataFrame(out, TXN_DDL)


def rows(df):
    """Collected rows in a stable order (NULLs sort last)."""
    return sorted(df.collect(), key=lambda r: tuple((v is None, str(v)) for v in r))
