"""Figures as the reader sees them: shares, counts, dates, value ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_label(n: Column) -> Column:
    return F.format_number(n, 0)


def one_decimal(x: Column) -> Column:
    """A non-negative double rounded to one decimal by its exact binary value, halves up.

    Spark's own formatting rounds the shortest decimal form instead, which differs where the
    double lies just below a half. ``x*20`` is split into two exact products and the rounding
    error of their sum is recovered, so the comparison with the half is exact.
    """
    tenths = F.floor(x * 10)
    big, small = x * 16, x * 4
    total = big + small
    half = tenths * 2 + 1
    up = (total > half) | ((total == half) & (small - (total - big) >= 0))
    return (tenths + F.when(up, 1).otherwise(0)) / F.lit(10.0)


def share_label(part: Column, total: Column) -> Column:
    percent = F.try_divide(part, total) * 100
    return (
        F.when(total == 0, F.lit("—"))
        .when((percent > 0) & (percent < 0.1), F.lit("<0.1%"))
        .when((percent < 100) & (percent > 99.9), F.lit(">99.9%"))
        .otherwise(F.format_string("%.1f%%", one_decimal(percent)))
    )


def _instant(raw: Column) -> Column:
    # Accept a missing seconds field and an offset without a colon, which a plain cast does not.
    padded = F.regexp_replace(raw, r"T(\d{2}:\d{2})(?=Z|[+-]|$)", "T$1:00")
    colon = F.regexp_replace(padded, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(raw.rlike(r"\A\d{4}-\d{2}-\d{2}(T.*)?\z"), colon.try_cast("timestamp"))


def date_label(raw: Column) -> Column:
    """``Jan 5, 2024`` in UTC; text that is no date stays as it is."""
    return F.coalesce(F.date_format(_instant(raw), "MMM d, yyyy"), raw)


def instant_label(raw: Column) -> Column:
    """``Jan 5, 2024, 10:05 AM`` in UTC; text that is no instant stays as it is."""
    return F.coalesce(F.date_format(_instant(raw), "MMM d, yyyy, h:mm a"), raw)


def plural(n: Column, word: str) -> Column:
    return F.when(n == 1, F.lit(word)).otherwise(F.lit(word + "s"))
