"""Rules of the transaction generator, as column rules over a transactions
table: the flag rule, one AML alert per flagged transaction, reference
numbers, and the key/JSON envelope a Kafka sink takes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import amt, chn, tts, zfill
from ledgerspark.sources.schemas import AML_ALERT_FIELDS, TRANSACTION_FIELDS

# The flag rule.
FLAG_CHANNEL = "CASH"
FLAG_ABOVE = 500_000
FLAGGED = "FLAGGED"

# The four alert kinds (type, rule, description).  The
# HIGH_VALUE description is built from the transaction: "High value
# <channel> of INR <amount>".
ALERT_KINDS = (
    ("STRUCTURING", "RULE_CTR_SPLIT", "Multiple transactions structured to avoid CTR threshold"),
    ("HIGH_VALUE", "RULE_HIGH_VALUE", None),
    ("VELOCITY", "RULE_HIGH_VELOCITY", "Unusual transaction velocity detected on account"),
    ("UNUSUAL_PATTERN", "RULE_PATTERN_BREAK", "Transaction pattern deviates from customer profile"),
)
# Alert statuses and priorities, in order; score range.
ALERT_STATUSES = ("OPEN", "UNDER_REVIEW")
ALERT_PRIORITIES = ("CRITICAL", "HIGH", "MEDIUM")
ALERT_SCORE_MIN = 60
ALERT_SCORE_SPAN = 40  # scores 60-99


def derive_flag(txn: DataFrame) -> DataFrame:
    """Cash above 500,000 forces ``status = 'FLAGGED'``; other rows keep theirs.

    The channel is compared normalised (upper case, trimmed) and the amount
    typed, so padded labels and text amounts follow the rule too.
    """
    rule = (chn("channel") == FLAG_CHANNEL) & (amt("amount") > FLAG_ABOVE)
    return txn.withColumn("status", F.when(rule, F.lit(FLAGGED)).otherwise(F.col("status")))


def _pick(seq, values):
    """``values[seq % len(values)]`` as a column (a CASE over a fixed list)."""
    k = F.pmod(seq, F.lit(len(values)))
    out = None
    for i, v in enumerate(values):
        out = (F.when(k == i, v) if out is None else out.when(k == i, v))
    return out


def txn_number(txn_id: str = "txn_id"):
    """The number after the three-letter prefix of a transaction id; for ids
    of another form, a stable non-negative hash of the id."""
    return F.coalesce(
        after_prefix(txn_id).try_cast("bigint"), F.pmod(F.xxhash64(txn_id), F.lit(1 << 31)).cast("bigint")
    )


def after_prefix(txn_id: str = "txn_id"):
    """All of an id behind its three-letter prefix."""
    return F.expr(f"substring({txn_id}, 4)")


def derive_aml_alerts(txn: DataFrame) -> DataFrame:
    """One alert record per FLAGGED transaction, in the alert schema.

    Type, rule, score, status and priority are chosen by the transaction
    number (the generator draws them at random), so the output is
    deterministic.  Fields the generator never fills stay NULL.
    """
    seq = txn_number()
    flagged = txn.where(F.col("status") == FLAGGED).withColumn("_seq", seq)
    s = F.col("_seq")
    description = _pick(
        s,
        [
            d if d is not None else F.concat(F.lit("High value "), F.col("channel"), F.lit(" of INR "), F.col("amount"))
            for _, _, d in ALERT_KINDS
        ],
    )
    filled = {
        "alert_id": F.concat(F.lit("AML"), after_prefix()),
        "customer_id": F.col("customer_id"),
        "customer_name": F.col("customer_id"),
        "alert_date": F.col("txn_date"),
        "alert_type": _pick(s, [k for k, _, _ in ALERT_KINDS]),
        "risk_score": (F.lit(ALERT_SCORE_MIN) + F.pmod(s, F.lit(ALERT_SCORE_SPAN))).cast("string"),
        "rule_triggered": _pick(s, [r for _, r, _ in ALERT_KINDS]),
        "transaction_ids": F.col("txn_id"),
        "total_amount": F.col("amount"),
        "currency": F.col("currency"),
        "description": description,
        "status": _pick(s, ALERT_STATUSES),
        "priority": _pick(s, ALERT_PRIORITIES),
    }
    return flagged.select(
        [filled.get(f, F.lit(None).cast("string")).alias(f) for f in AML_ALERT_FIELDS]
    )


def derive_ref_number(
    txn: DataFrame, seq: str | None = None, width: int = 6
) -> DataFrame:
    """Transaction id ``TXN<yyyymmdd><seq>`` and reference number
    ``<CHANNEL><yyyymmdd><seq>``, with ``seq`` zero-filled to ``width`` (longer
    numbers kept whole).  ``seq`` defaults to the transaction number; the day
    is the business date of ``txn_date``."""
    n = F.col(seq) if seq else txn_number()
    day = F.date_format(tts("txn_date"), "yyyyMMdd")
    padded = zfill(n, width)
    return txn.select(
        "txn_id",
        F.concat(F.lit("TXN"), day, padded).alias("derived_txn_id"),
        F.concat(chn("channel"), day, padded).alias("derived_ref_number"),
    )


def publish_envelope(df: DataFrame, key_field: str, fields: list[str] | None = None) -> DataFrame:
    """``key, value`` frame for a Kafka sink: the id as key, the record as a
    JSON object as value (NULL fields omitted; they parse back as NULL)."""
    cols = fields or [c for c in df.columns if not c.startswith("_")]
    return df.select(F.col(key_field).cast("string").alias("key"), json_value(cols).alias("value"))


def json_value(fields: list[str]):
    """The record as one JSON object (NULL fields omitted)."""
    return F.to_json(F.struct(*fields))


def transactions_envelope(txn: DataFrame) -> DataFrame:
    return publish_envelope(txn, "txn_id", TRANSACTION_FIELDS)
