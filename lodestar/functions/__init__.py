"""Column functions: cleaning, defaults, code maps and line classifiers."""

from lodestar.functions.columns import (
    account_label,
    clean_line_breaks,
    code_decode,
    date_id,
    escape_line_breaks,
    fill_blank,
    fill_empty,
    fill_null,
    fill_unknown,
    from_text_timestamp,
    presence_flag,
    to_text_timestamp,
)
from lodestar.functions.lines import LINE_RULES, LineRule, line_type

__all__ = [
    "LINE_RULES",
    "LineRule",
    "account_label",
    "clean_line_breaks",
    "code_decode",
    "date_id",
    "escape_line_breaks",
    "fill_blank",
    "fill_empty",
    "fill_null",
    "fill_unknown",
    "from_text_timestamp",
    "line_type",
    "presence_flag",
    "to_text_timestamp",
]
