"""Column expressions: dates, load stamps, keys, numbers. All run inside the JVM."""

from lamina.functions.columns import (
    MISSING_DESCRIPTION,
    is_cancellation,
    natural_key,
    to_working_decimal,
)
from lamina.functions.temporal import invoice_time, load_stamp, now, time_of_day

__all__ = [
    "MISSING_DESCRIPTION",
    "invoice_time",
    "is_cancellation",
    "load_stamp",
    "natural_key",
    "now",
    "time_of_day",
    "to_working_decimal",
]
