"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import as_col
from tidemark.functions.text import concat_ws_strict

__all__ = ["plain_key", "surrogate_key"]

# Fixed value: stands for NULL inside a key.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the dash-joined texts, a NULL counted as its own value."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def plain_key(*cols: Column | str) -> Column:
    """md5 of the dash-joined texts; NULL as soon as one part is NULL."""
    return F.md5(concat_ws_strict("-", *[as_col(c).cast("string") for c in cols]))
