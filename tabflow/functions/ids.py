"""Prefixed identifiers such as ``INN1207``: parse the numeric part, format new ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabflow.functions._util import as_col


def quote_prefix(prefix: str) -> str:
    """Java-regex literal quoting of ``prefix``."""
    return r"\Q" + prefix.replace(r"\E", r"\E\\E\Q") + r"\E"


def id_suffix(c, prefix: str) -> Column:
    """Digits right after the first occurrence of ``prefix`` (unanchored search).

    Ids without the prefix give NULL, so aggregates ignore them.  The prefix
    is matched literally (regex-quoted).
    """
    extracted = F.regexp_extract(as_col(c), quote_prefix(prefix) + r"(\d+)", 1)
    return F.when(extracted != "", extracted).cast("bigint")


def format_id(prefix: str, number, width) -> Column:
    """``prefix`` + number zero-padded to ``width`` digits (never truncated)."""
    digits = as_col(number).cast("string")
    w = F.greatest(as_col(width) if not isinstance(width, int) else F.lit(width), F.length(digits))
    return F.concat(F.lit(prefix), F.lpad(digits, w, "0"))
