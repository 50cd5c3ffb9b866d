"""Join shapes the reports share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def left_where(left: DataFrame, right: DataFrame, on: Column, keep: Column) -> DataFrame:
    """Left join to the right rows that satisfy ``keep``; left rows without one stay."""
    return left.join(right.filter(keep), on, "left")


def blank_safe(df: DataFrame, key: str) -> Column:
    """A key of ``df`` in the form in which NULL and '' are the same; texts keep their collation."""
    text = isinstance(df.schema[key].dataType, StringType)
    return F.coalesce(df[key] if text else df[key].cast("string"), F.lit(""))


def is_collated(df: DataFrame, key: str) -> bool:
    """Whether texts of the column compare without case, as in the source databases."""
    kind = df.schema[key].dataType
    return isinstance(kind, StringType) and kind.collation in ("UTF8_LCASE", "UTF8_LCASE_RTRIM")


def compared(df: DataFrame, key: str) -> Column:
    """A column in a form that is equal where its values are: texts that compare without case as lower-cased plain text.

    The collation lowers each sign by itself, and so has one small sigma for the two that ``lower`` tells apart.
    """
    if not is_collated(df, key):
        return df[key]
    text = df[key].cast("string")
    if df.schema[key].dataType.collation.endswith("_RTRIM"):
        text = F.rtrim(text)
    return F.translate(F.lower(text), "\u03c2", "\u03c3")


def blank_key(df: DataFrame, key: str) -> Column:
    """``blank_safe`` in the form of ``compared``."""
    return F.coalesce(compared(df, key), F.lit("")) if is_collated(df, key) else blank_safe(df, key)


def blank_safe_anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a right row of the same keys, NULL and '' being the same."""

    known = right.select(*[blank_safe(right, k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    match = [blank_safe(left, k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    return left.join(known, match, "left_anti")


def folded_anti(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key, case aside, is not among the right's. NULL keys stay."""
    known = right.select(F.lower(key).alias("__k")).distinct()
    return left.join(known, F.lower(left[key]) == F.col("__k"), "left_anti")


def two_hop(edges: DataFrame, nodes: DataFrame, source: str, target: str, key: str) -> DataFrame:
    """Edges with the columns of both end nodes, prefixed ``source_`` and ``target_``.

    The source node must exist, the target need not.
    """
    start = nodes.select(*[F.col(c).alias(f"source_{c}") for c in nodes.columns])
    end = nodes.select(*[F.col(c).alias(f"target_{c}") for c in nodes.columns])
    return edges.join(start, edges[source] == F.col(f"source_{key}")).join(
        end, edges[target] == F.col(f"target_{key}"), "left"
    )


def with_parent(df: DataFrame, key: str, parent_key: str, columns: Sequence[str]) -> DataFrame:
    """Rows with ``parent_``-prefixed columns of the row their parent key points to."""
    parents = df.select(
        F.col(key).alias("__k"), *[F.col(c).alias(f"parent_{c}") for c in columns]
    )
    return df.join(parents, df[parent_key] == F.col("__k")).drop("__k")
