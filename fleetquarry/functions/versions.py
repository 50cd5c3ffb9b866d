"""Dotted version text: sortable form, its inverse, and versions found in file names."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from fleetquarry.functions.text import ColumnOrName, path_leaf, plain

SECTION_WIDTH = 7
MAX_PARTS = 4


def _sections(value: Column, max_parts: int | None, convert) -> Column:
    parts = F.split(value, "[.]")
    valid = ~F.exists(parts, lambda p: F.length(p) == 0)
    if max_parts is not None:
        valid = valid & (F.size(parts) <= max_parts)
    return F.when(valid, F.array_join(F.transform(parts, convert), "."))


def version_sort_key(
    value: ColumnOrName, width: int = SECTION_WIDTH, max_parts: int | None = MAX_PARTS
) -> Column:
    """Pad each section with zeros so that text order is version order.

    Longer sections stay whole. NULL for an empty section or more than ``max_parts``.
    """
    return _sections(
        plain(value),
        max_parts,
        lambda p: F.lpad(p, F.greatest(F.lit(width), F.length(p)), F.lit("0")),
    )


def version_strip_zeros(value: ColumnOrName, max_parts: int | None = MAX_PARTS) -> Column:
    """Drop leading zeros of each section; a section of zeros becomes ``0``."""
    return _sections(
        plain(value),
        max_parts,
        lambda p: F.coalesce(F.nullif(F.ltrim(p, F.lit("0")), F.lit("")), F.lit("0")),
    )


def version_from_file(url: ColumnOrName) -> Column:
    """``19.008.20071`` from ``.../Name1900820071_LANG.ext``: first digit run of the stem's head."""
    stem = F.regexp_replace(plain(path_leaf(url)), "[.][^.]*$", "")
    digits = F.regexp_extract(F.substring_index(stem, "_", 1), r"\d+", 0)
    dotted = F.concat_ws(
        ".", F.substring(digits, 1, 2), F.substring(digits, 3, 3), F.substring(digits, 6, 200)
    )
    return F.when(F.length(digits) >= 5, dotted)


def register_sql_functions(spark: SparkSession) -> None:
    """The two version functions for SQL text, as SQL functions that Catalyst inlines."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION version_sort_key(v STRING) RETURNS STRING RETURN
        CASE WHEN size(split(v, '[.]')) <= {MAX_PARTS}
                  AND NOT exists(split(v, '[.]'), p -> length(p) = 0)
             THEN array_join(transform(split(v, '[.]'),
                  p -> lpad(p, greatest({SECTION_WIDTH}, length(p)), '0')), '.') END"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION version_strip_zeros(v STRING) RETURNS STRING RETURN
        CASE WHEN size(split(v, '[.]')) <= {MAX_PARTS}
                  AND NOT exists(split(v, '[.]'), p -> length(p) = 0)
             THEN array_join(transform(split(v, '[.]'),
                  p -> coalesce(nullif(ltrim('0', p), ''), '0')), '.') END"""
    )
