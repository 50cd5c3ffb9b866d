"""Per-group text roll-ups, counts and flags, one aggregation per child table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Text:
    """One list cell: ``value`` per row, in the order of ``order``, joined by ``separator``.

    NULL values are left out, ``default`` stands for a group without any.
    """

    value: Column
    order: Sequence[Column] = field(default_factory=tuple)
    separator: str = "\n"
    default: str | None = None


def ordered_rollup(
    df: DataFrame,
    keys: Sequence[str],
    cells: dict[str, Text],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per group with its list cells, plus any ``extra`` aggregates, in one pass.

    A cell is one value, so its group must fit one value: the disks of a machine, the entries
    of a folder. For groups without such a bound use :func:`rollup_parts`.
    """
    work, aggs = df, []
    for n, (name, cell) in enumerate(cells.items()):
        # listed as plain text, ordered as the values compare
        work = work.withColumn(f"__v{n}", cell.value.cast("string"))
        order = [*cell.order, cell.value]
        for i, by in enumerate(order):
            work = work.withColumn(f"__v{n}_{i}", by)
        by = ", ".join(f"__v{n}_{i} ASC NULLS FIRST" for i in range(len(order)))
        literal = cell.separator.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
        agg = F.expr(f"listagg(__v{n}, '{literal}') WITHIN GROUP (ORDER BY {by})")
        if cell.default is not None:
            agg = F.coalesce(agg, F.lit(cell.default))
        aggs.append(agg.alias(name))
    return work.groupBy(*keys).agg(*aggs, *extra)


def rollup_parts(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: Sequence[Column],
    separator: str = "\n",
    partitions: int | None = None,
) -> DataFrame:
    """The same list as rows ``(keys, part, text)`` for groups too large for one value.

    Rows are range-partitioned by key and order, so a hot group is cut into consecutive parts
    held by different tasks; the parts of a group in ``part`` order are its whole list.
    """
    work = df.select(*keys, value.cast("string").alias("__v"), *[o.alias(f"__o{i}") for i, o in enumerate(order)])
    by = [*keys, *[f"__o{i}" for i in range(len(order))], "__v"]
    ranged = work.repartitionByRange(partitions, *by) if partitions else work.repartitionByRange(*by)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    sort = ", ".join(f"{c} ASC NULLS FIRST" for c in by[len(keys) :])
    literal = separator.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    text = F.expr(f"listagg(__v, '{literal}') WITHIN GROUP (ORDER BY {sort})")
    return ranged.groupBy(*keys, "part").agg(text.alias("text")).filter("text IS NOT NULL")


def with_count(
    df: DataFrame, child: DataFrame, on: str, out: str, child_key: str | None = None
) -> DataFrame:
    """``df`` plus its number of child rows, 0 for none."""
    counts = child.groupBy(F.col(child_key or on).alias("__k")).agg(F.count("*").alias(out))
    joined = df.join(counts, df[on] == F.col("__k"), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(out, F.lit(0)).alias(out))


def with_flag(
    df: DataFrame, child: DataFrame, on: str, out: str, child_key: str | None = None
) -> DataFrame:
    """``df`` plus whether any child row exists."""
    keys = child.select(F.col(child_key or on).alias("__k")).distinct()
    joined = df.join(keys, df[on] == F.col("__k"), "left")
    return joined.select(*[df[c] for c in df.columns], F.col("__k").isNotNull().alias(out))


def with_default_rows(
    parents: DataFrame, child: DataFrame, on: str, defaults: dict[str, str]
) -> DataFrame:
    """All child rows, and one row of ``defaults`` for each parent without any.

    Parents are looked for among the distinct keys of ``child``, compared so that the join filters nothing below them: what ``child``
    itself has shuffled then serves for the rows shown and for the keys.
    """
    seen, own = child.select(F.col(on).alias("__seen")).distinct(), parents.select(on).distinct()
    missing = own.join(seen, own[on].eqNullSafe(seen["__seen"]) & own[on].isNotNull(), "left_anti")
    fill = missing.select(on, *[F.lit(v).alias(k) for k, v in defaults.items()])
    return child.unionByName(fill, allowMissingColumns=True)
