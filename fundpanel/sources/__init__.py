from .code_tables import code_table, states
from .delimited import infer_then_convert, read_csv, read_grid, read_text_table, to_grid
from .fixed_width import (
    by_positions, by_widths, parse_fixed, parse_ragged, read_fixed, read_lines_sliced,
)
from .lines import numbered_lines, numbered_records
from .vintages import layout_for, read_vintages, tag_vintage

__all__ = [
    "by_positions", "by_widths", "code_table", "infer_then_convert", "layout_for", "numbered_lines", "numbered_records",
    "parse_fixed", "parse_ragged", "read_csv", "read_fixed", "read_grid", "read_lines_sliced",
    "read_text_table", "read_vintages", "states", "tag_vintage", "to_grid",
]
