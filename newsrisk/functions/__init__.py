"""Column-level helpers: built-in expressions only, no Python UDFs."""

from newsrisk.functions.codes import (
    CONFLICT_CODES,
    CONFLICT_CODES_WEIGHTED10,
    ROOT_LABELS,
    lpad_root_code,
    normalize_root_code,
    root_label,
)
from newsrisk.functions.scalars import (
    first_csv_double,
    if_else_zero,
    parse_yyyymmdd,
    safe_divide,
    to_bigint,
    to_double,
    tone_bucket,
    yyyymmdd,
)

__all__ = [
    "CONFLICT_CODES",
    "CONFLICT_CODES_WEIGHTED10",
    "ROOT_LABELS",
    "first_csv_double",
    "if_else_zero",
    "lpad_root_code",
    "normalize_root_code",
    "parse_yyyymmdd",
    "root_label",
    "safe_divide",
    "to_bigint",
    "to_double",
    "tone_bucket",
    "yyyymmdd",
]
