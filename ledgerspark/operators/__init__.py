"""One ``DataFrame -> DataFrame`` function per analytic or rule.

Transaction analytics take a bronze-shaped transactions frame (text columns,
optionally with the typed columns of a silver table); thresholds are keyword
parameters whose defaults are the fixed values of the reference analytics.
"""

from ledgerspark.operators.alerts import (  # noqa: F401
    derive_aml_alerts,
    derive_flag,
    derive_ref_number,
    publish_envelope,
    transactions_envelope,
)
from ledgerspark.operators.kpi import kpi_overall  # noqa: F401
from ledgerspark.operators.pattern import (  # noqa: F401
    pattern_branch_top15,
    pattern_channel,
    pattern_txn_type,
    txn_branch_type_top15,
    txn_channel_distribution,
)
from ledgerspark.operators.quality import txn_data_quality  # noqa: F401
from ledgerspark.operators.risk import (  # noqa: F401
    risk_high_value_cash,
    risk_high_value_cash_channel,
    risk_high_velocity,
    risk_low_cibil,
    risk_npa_summary,
    risk_open_aml_alerts,
    risk_structuring,
)
from ledgerspark.operators.volume import txn_hourly, volume_daily, volume_hourly  # noqa: F401
