"""Sizes, percentages, rates and bit masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetquarry.functions.text import ColumnOrName, as_column


def ceil_text(value: ColumnOrName, divisor: int = 1024, unit: str = "GB") -> Column:
    """``value / divisor`` rounded up, with its unit: ``500GB``."""
    scaled = F.ceil(as_column(value).cast("decimal(20,4)") / F.lit(divisor))
    return F.concat(scaled.cast("string"), F.lit(unit))


def one_decimal(value: ColumnOrName) -> Column:
    """``1,234.5``: grouped thousands, one decimal, halves away from zero."""
    return F.format_number(F.round(as_column(value), 1), 1)


def percent_text(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``45.3%``; NULL for an empty whole."""
    share = F.try_divide(as_column(part) * 100, as_column(whole))
    return F.concat(one_decimal(share), F.lit("%"))


def megabytes(value: ColumnOrName) -> Column:
    """Bytes as MB with two decimals, halves to even."""
    return F.bround(as_column(value) / F.lit(1048576), 2)


def complement(value: ColumnOrName) -> Column:
    """Used percent from free percent and back."""
    return F.lit(100) - as_column(value)


def mbit(value: ColumnOrName) -> Column:
    """Bytes per second as Mbit per second."""
    return as_column(value) * 8 / F.lit(1024 * 1024)


def mask_names(mask: ColumnOrName, names: dict[int, str], separator: str = ", ") -> Column:
    """Names of the bits set in ``mask``, in the order of the given dictionary."""
    mask = as_column(mask)
    hits = [
        F.when(mask.bitwiseAND(F.lit(bits).cast("long")) == bits, F.lit(name))
        for bits, name in names.items()
    ]
    return F.concat_ws(separator, *hits)


def disk_space(size: ColumnOrName, free: ColumnOrName) -> list[Column]:
    """Size and free space in GB and percent free, as report text."""
    gib = F.lit(1024**3)
    return [
        one_decimal(as_column(size) / gib).alias("size_gb"),
        one_decimal(as_column(free) / gib).alias("free_space_gb"),
        one_decimal(as_column(free)).alias("free_space"),
        percent_text(free, size).alias("percent_free"),
    ]
