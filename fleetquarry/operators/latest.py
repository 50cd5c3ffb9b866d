"""Newest rows per group, ranks, and keyed upsert.

None of these sorts a whole group in one task. An extreme is a partial aggregate plus a join
back on group *and* value, so the rows of one hot group are spread by that value; a rank is
taken over the distinct order values of a group only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetquarry.functions.text import plain
from fleetquarry.functions.times import NTZ, Moment, days_before
from fleetquarry.operators.joins import compared, is_collated


def rows_at_extreme(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    newest: bool = True,
    over: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``order`` is the largest (smallest) of their group, ties kept.

    ``over`` is where the extreme is looked for when that is more than ``df`` itself.
    """
    pick = F.max if newest else F.min
    extreme = (over if over is not None else df).groupBy(*keys).agg(pick(order).alias("__extreme"))
    extreme = extreme.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__extreme"
    )
    match = [df[k] == F.col(f"__k{i}") for i, k in enumerate(keys)]
    match.append(df[order] == F.col("__extreme"))
    return df.join(extreme, match, "left_semi")


def latest_snapshot(
    df: DataFrame, key: str | Sequence[str], stamp: str, where: Column | None = None
) -> DataFrame:
    """Rows of the newest scan of each device.

    The newest stamp is taken over all rows while ``where`` limits the rows returned, so a
    device whose last scan found nothing loses its older rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = df if where is None else df.filter(where)
    return rows_at_extreme(kept, keys, stamp, over=df)


def latest_scan(df: DataFrame, key: str, stamp: str, read: Callable[[str], Column], out: str, where: Column | None = None) -> DataFrame:
    """As :func:`latest_snapshot` where the stamp is text, which ``read`` turns into a time, shown as ``out``.

    A device has few scans, so texts are read once a scan and not once a row; rows find their scan by its text.
    """
    scans = df.groupBy(F.col(key).alias("__k"), plain(stamp).alias("__stamp")).agg(F.count("*").alias("__rows"))
    # the count, never 0, keeps the reading above this aggregate; else it would be done below, row by row
    scans = scans.select("__k", "__stamp", F.when(F.col("__rows") > 0, read("__stamp")).alias(out))
    last = rows_at_extreme(scans, ["__k"], out)
    kept = df if where is None else df.filter(where)
    return kept.join(last, (kept[key] == last["__k"]) & (plain(kept[stamp]) == last["__stamp"])).select(*[kept[c] for c in kept.columns], out)


def top_rank(
    df: DataFrame, keys: Sequence[str], order: str, descending: bool = False
) -> DataFrame:
    """Rows of dense rank 1: NULLs order first ascending and last descending.

    Ascending, a group with a NULL keeps exactly its NULL rows; descending, only a group of
    NULLs alone keeps them. NULL keys are a group of their own.
    """
    # the (not null, value) pair orders NULLs first ascending and last descending
    position = F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("value"))
    pick = F.max if descending else F.min
    best = df.groupBy(*keys).agg(pick(position).alias("__best"))
    best = best.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__best.value")
    match = [df[k].eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    match.append(df[order].eqNullSafe(F.col("value")))
    return df.join(best, match, "left_semi")


def dense_rank_of(
    df: DataFrame, keys: Sequence[str], order: str, out: str, descending: bool = False
) -> DataFrame:
    """``df`` plus its dense rank per group, ranked over distinct values and joined back."""
    distinct = df.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(order).alias("__value")
    ).distinct()
    by = F.desc_nulls_last("__value") if descending else F.asc_nulls_first("__value")
    window = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy(by)
    ranks = distinct.withColumn(out, F.dense_rank().over(window))
    match = [df[k].eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    match.append(df[order].eqNullSafe(F.col("__value")))
    return df.join(ranks, match, "left").select(*[df[c] for c in df.columns], out)


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """A number that equal keys share, by the form that they compare in."""
    plainly = [k for k in keys if is_collated(df, k) or getattr(df.schema[k].dataType, "collation", "UTF8_BINARY") == "UTF8_BINARY"]
    return F.xxhash64(*[compared(df, k) for k in plainly])


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df`` without repeats. Of texts that are equal under their collation one spelling stays, taken from one row.

    A plain DISTINCT over a collation sorts the rows by it, lower-casing texts in each comparison; here they are grouped by the
    plain text that stands for them.
    """
    texts = [c for c in df.columns if is_collated(df, c)]
    if not texts:
        return df.distinct()
    own = [c for c in df.columns if c not in texts]
    keys = [compared(df, c).alias(f"__t{i}") for i, c in enumerate(texts)]
    spelled = F.struct(*[plain(c).alias(c) for c in texts])
    keyed = df.select(key_hash(df, df.columns).alias("__hash"), *own, *keys, spelled.alias("__row"))
    grouped = keyed.groupBy("__hash", *own, *[f"__t{i}" for i in range(len(texts))]).agg(F.max("__row").alias("__row"))
    shown = {c: F.col("__row")[c].cast(df.schema[c].dataType).alias(c) for c in texts}
    return grouped.select(*[shown.get(c, F.col(c)) for c in df.columns])


def newest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the one of the greatest ``order``, other columns breaking ties.

    A partial aggregate on the map side, so repeats of a hot key meet before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.max(
        F.struct(
            *[F.struct(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)],
            F.struct(*rest).alias("row"),
        )
    )
    picked = df.groupBy(*keys).agg(ranked.alias("__top"))
    return picked.select(*[F.col(k) for k in keys], "__top.row.*").select(*df.columns)


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | None = None
) -> DataFrame:
    """Next state of a keyed table: batch rows replace target rows of the same key.

    ``target`` has one row a key. Only the batch is reduced: repeats in it are settled by ``order``, then by
    their other columns. Target rows are read and passed on; they are neither sorted nor moved while the
    batch's keys fit a broadcast, and joined on the keys when they do not. NULL keys equal each other.
    """
    once = newest_by_key(batch, keys, [order] if order else [])
    replaced = once.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    match = [target[k].eqNullSafe(replaced[f"__k{i}"]) for i, k in enumerate(keys)]
    return target.join(replaced, match, "left_anti").unionByName(once, allowMissingColumns=True)


def drop_older(df: DataFrame, stamp: Column, as_of: Moment, days: int) -> DataFrame:
    """Rows newer than ``days`` before ``as_of``; rows without a readable time stay."""
    return df.filter(F.coalesce(stamp.cast(NTZ) > days_before(as_of, days), F.lit(True)))
