"""Column-level helpers built only from Spark's own expressions."""

from marketlake.functions.scalar import (  # noqa: F401
    as_col,
    epoch_ms_to_ts,
    interval_label,
    is_valid_number,
    parse_double,
    parse_ts,
    safe_div,
    typical_price,
)
