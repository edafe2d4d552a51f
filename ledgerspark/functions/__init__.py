from ledgerspark.functions.typed import (  # noqa: F401
    MONEY,
    MONEY_TOTAL,
    PERCENT,
    amt,
    as_int,
    chn,
    half_up_quotient,
    int_avg,
    money_avg,
    money_sum,
    norm,
    pct_of,
    tts,
    txn_day,
    txn_hour,
    with_typed,
    TYPED_COLUMNS,
    zfill,
)
