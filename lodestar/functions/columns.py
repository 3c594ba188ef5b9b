"""Column expressions shared by extracts and loads.

Everything here is a composition of built-in functions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodestar.functions.reserved import DATE_ID_FORMAT, NULL_DATE_ID, TEXT_TIMESTAMP


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_line_breaks(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace every line feed and carriage return in ``cols`` by one blank."""
    return df.withColumns({c: F.translate(F.col(c), "\n\r", "  ") for c in cols})


def escape_line_breaks(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Put a backslash before every line feed and carriage return in ``cols``."""
    return df.withColumns({c: F.regexp_replace(F.col(c), "([\n\r])", "\\\\$1") for c in cols})


def fill_null(c: Column | str, default: Any) -> Column:
    """``default`` where the value is NULL; an empty string is kept."""
    return F.coalesce(_col(c), F.lit(default))


def fill_empty(c: Column | str, default: str) -> Column:
    """``default`` where the text is empty; NULL is kept."""
    return F.when(F.length(_col(c)) == 0, F.lit(default)).otherwise(_col(c))


def fill_blank(c: Column | str, default: str) -> Column:
    """``default`` where the text is NULL or empty."""
    return F.when(F.length(_col(c)) > 0, _col(c)).otherwise(F.lit(default))


def fill_unknown(df: DataFrame, defaults: Mapping[str, Any], empty: bool = True) -> DataFrame:
    """Fill missing values by a per-column rule.

    NULL always takes the default. With ``empty`` an empty string does too, which
    is what a text column needs after a CSV load has turned NULL into ``''``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def filled(name: str, default: Any) -> Column:
        if empty and isinstance(types[name], T.StringType):
            return fill_blank(name, default)
        return fill_null(name, F.lit(default).cast(types[name]))

    return df.withColumns({c: filled(c, d) for c, d in defaults.items()})


def code_decode(c: Column | str, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Map code values; a ``None`` key matches NULL. No default gives NULL."""
    c = _col(c)
    chain: Column | None = None
    for code, value in mapping.items():
        hit = c.isNull() if code is None else c == F.lit(code)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    if chain is None:
        return F.lit(default)
    return chain if default is None else chain.otherwise(F.lit(default))


def presence_flag(c: Column | str) -> Column:
    """``YES`` where a joined row was found, else ``NO``."""
    return F.when(_col(c).isNull(), F.lit("NO")).otherwise(F.lit("YES"))


def date_id(c: Column | str) -> Column:
    """Date-dimension id: ``yyyyMMdd`` text, ``'0'`` for a NULL date."""
    return F.coalesce(F.date_format(_col(c), DATE_ID_FORMAT), F.lit(NULL_DATE_ID))


def to_text_timestamp(c: Column | str) -> Column:
    """Timestamp rendered as the text form used in extract files."""
    return F.date_format(_col(c), TEXT_TIMESTAMP)


def from_text_timestamp(c: Column | str) -> Column:
    """Text form of an extract file parsed back to a timestamp."""
    return F.to_timestamp_ntz(_col(c), F.lit(TEXT_TIMESTAMP))


def account_label(number: Column | str, name: Column | str) -> Column:
    """``number name``; keeps the part that is not NULL."""
    return F.concat_ws(" ", _col(number), _col(name))


def ts_lit(value: str | dt.datetime) -> Column:
    """A zone-free timestamp literal from text or a datetime."""
    return F.lit(str(value)).cast("timestamp_ntz")
