"""Column expressions shared by the operators (built-in Spark functions only)."""

from forgeline.functions.numeric import (  # noqa: F401
    clamp_non_negative,
    nan_ignoring_max,
    safe_ratio,
)
from forgeline.functions.text import (  # noqa: F401
    decimal_text,
    id_number,
    normalize_string,
    zero_pad,
)
from forgeline.functions.time import (  # noqa: F401
    days_between,
    hours_between,
    parse_date_strict,
    parse_timestamp_strict,
)
