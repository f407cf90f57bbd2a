"""Canonical sets and the keys made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(values: Column) -> Column:
    """The values as a set: unique and sorted."""
    return F.array_sort(F.array_distinct(values))


def joined(values: Column) -> Column:
    return F.array_join(canonical(values), "+")


def filter_key(classes: Column, datasets: Column) -> Column:
    return F.concat(joined(classes), F.lit("~"), joined(datasets))
