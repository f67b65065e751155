from biasloom.functions.columns import (
    count_equal,
    count_missing,
    distinct_with_null,
    level_effect,
    residual,
    rmse,
    row_hash,
    share,
    whole_number,
)

__all__ = [
    "count_equal",
    "count_missing",
    "distinct_with_null",
    "level_effect",
    "residual",
    "rmse",
    "row_hash",
    "share",
    "whole_number",
]
