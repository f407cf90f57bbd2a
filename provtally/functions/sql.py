"""Small helpers for expressions put together as SQL text.

Long generated expressions (one term per dataset, filter or field) are built as text and parsed
once: building them call by call costs a gateway round trip per node.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values: Iterable[str]) -> str:
    """A SQL array of string literals."""
    items = ", ".join(quote(v) for v in values)
    return f"array({items})" if items else "cast(array() as array<string>)"


def text_list(values: Iterable[str]) -> str:
    """Comma-separated string literals, for ``in (...)``."""
    return ", ".join(quote(v) for v in values)


def exploded(df: DataFrame, items: Column, name: str, *keep: Column | str) -> DataFrame:
    """One row per array element, with the array evaluated once.

    For a plain explode the optimiser adds a filter on the array's size below it and so evaluates
    a costly array twice; it does not for the outer form, whose empty rows are dropped here.
    Elements must not be null.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())
