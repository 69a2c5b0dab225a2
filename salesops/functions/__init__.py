"""Scalar and aggregate expressions shared by the operators."""

from salesops.functions.expressions import (  # noqa: F401
    blank_to_null,
    days_between,
    format_key,
    is_blank,
    major_units,
    md5_modulo,
    mean,
    minor_units,
    null_if_sentinel,
    percent,
    quarter_label,
    quarter_number,
    quarter_text,
    repair_prefix,
    round_half_up,
    thousands,
    total_or_zero,
    wide,
)
