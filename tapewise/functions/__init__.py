"""Column-expression builders shared by the operators."""

from tapewise.functions.exprs import (  # noqa: F401
    as_column,
    cut_expr,
    default_label_expr,
    flag_expr,
    floor_zero_expr,
    format_percent_expr,
    hash_bucket,
    hash_int,
    hash_unit,
    safe_log_expr,
    safe_ratio,
)
