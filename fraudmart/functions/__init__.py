"""Column expressions built from Spark SQL built-ins only (JVM side, codegen)."""

from fraudmart.functions.columns import (  # noqa: F401
    abs_gap_seconds,
    amount_from_text,
    business_date,
    date_lit,
    date_tag,
    epoch_ms_to_date,
    epoch_seconds,
    excel_serial_to_date,
    full_name,
    iso_date,
    ts_lit,
)
