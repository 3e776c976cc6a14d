from .codes import label, ordinal, override_code, relabel, relabel_regex
from .numeric import if_known, log_value, pct, ratio, rescale, round_even
from .text import (
    concat_code, display_name, drop_chars, expand_year2, fold_key, norm_code, pad_code,
    part, sentinel_null, title_case, to_date, to_number, whole_number, year_from_name,
)

__all__ = [
    "concat_code", "display_name", "drop_chars", "expand_year2", "fold_key", "if_known", "label",
    "log_value", "norm_code", "ordinal", "override_code", "pad_code", "part", "pct", "ratio",
    "relabel", "relabel_regex", "rescale", "round_even", "sentinel_null", "title_case", "to_date",
    "to_number", "whole_number", "year_from_name",
]
