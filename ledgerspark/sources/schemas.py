"""Record schemas of the five bronze topics and the topic registry.

Every business field is nullable text; real types appear only in queries
(``ledgerspark.functions.typed``).  Bronze tables add ``_ingestion_ts`` and
``_source``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

# Field names, in order, of each record type.
TRANSACTION_FIELDS = (
    "txn_id",
    "account_id",
    "customer_id",
    "txn_type",
    "amount",
    "currency",
    "txn_date",
    "value_date",
    "branch_code",
    "channel",
    "narration",
    "balance_after",
    "status",
    "ref_number",
)

CUSTOMER_FIELDS = (
    "customer_id",
    "name",
    "pan",
    "aadhaar_masked",
    "mobile",
    "email",
    "dob",
    "gender",
    "kyc_status",
    "kyc_date",
    "risk_category",
    "branch_code",
    "account_type",
    "account_number",
    "account_open_date",
    "occupation",
    "annual_income",
    "address_city",
    "address_state",
    "nominee_name",
)

AML_ALERT_FIELDS = (
    "alert_id",
    "customer_id",
    "customer_name",
    "alert_date",
    "alert_type",
    "risk_score",
    "rule_triggered",
    "transaction_ids",
    "total_amount",
    "currency",
    "description",
    "status",
    "assigned_to",
    "priority",
    "due_date",
    "resolution",
    "resolution_date",
    "sar_filed",
    "sar_reference",
)

CIBIL_FIELDS = (
    "report_id",
    "customer_id",
    "customer_name",
    "pan",
    "cibil_score",
    "score_date",
    "total_accounts",
    "active_accounts",
    "closed_accounts",
    "overdue_accounts",
    "total_outstanding",
    "secured_outstanding",
    "unsecured_outstanding",
    "credit_utilization_pct",
    "enquiry_count_6m",
    "enquiry_count_12m",
    "dpd_30_count",
    "dpd_60_count",
    "dpd_90_count",
    "written_off_amount",
    "suit_filed_count",
    "wilful_defaulter",
    "report_pull_date",
    "report_source",
)

NPA_FIELDS = (
    "report_date",
    "loan_id",
    "customer_id",
    "customer_name",
    "loan_type",
    "branch_code",
    "sanctioned_amount",
    "outstanding_principal",
    "outstanding_interest",
    "total_outstanding",
    "dpd",
    "asset_classification",
    "npa_status",
    "npa_date",
    "provision_required_pct",
    "provision_amount",
    "collateral_type",
    "collateral_value",
    "net_npa_exposure",
    "recovery_action",
    "recovery_amount",
    "last_review_date",
    "next_review_date",
    "relationship_manager",
    "remarks",
)

# Topic names and bronze table names.
BRONZE_NAMESPACE = "bronze"
NAMESPACES = ("bronze", "silver", "gold")


def text_schema(fields: list[str]) -> StructType:
    return StructType([StructField(f, StringType(), True) for f in fields])


@dataclass(frozen=True)
class Topic:
    name: str
    table: str
    schema: StructType
    key_field: str


TOPICS: dict[str, Topic] = {
    t.name: t
    for t in (
        Topic("finacle-transactions", "finacle_transactions", text_schema(TRANSACTION_FIELDS), "txn_id"),
        Topic("finacle-customers", "finacle_customers", text_schema(CUSTOMER_FIELDS), "customer_id"),
        Topic("aml-alerts", "aml_alerts", text_schema(AML_ALERT_FIELDS), "alert_id"),
        Topic("cibil-bureau", "cibil_bureau", text_schema(CIBIL_FIELDS), "report_id"),
        Topic("npa-report", "npa_report", text_schema(NPA_FIELDS), "loan_id"),
    )
}

BRONZE_TABLES = [t.table for t in TOPICS.values()]


def topic(name: str) -> Topic:
    """Registry lookup; an unknown topic is an error naming the known ones."""
    try:
        return TOPICS[name]
    except KeyError:
        raise KeyError(f"unknown topic {name!r}; known: {sorted(TOPICS)}") from None


def select_topics(name: str | None = None) -> list[Topic]:
    """One topic by name, or all of them."""
    return [topic(name)] if name else list(TOPICS.values())
