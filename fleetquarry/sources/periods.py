"""Keyed stores laid out by time: a folder for each day or month of the rows' own time.

A merge rewrites only the periods that its batch touches, retention drops whole folders, and a search
of a day opens that day alone. Merged periods are first written beside the store, complete, and then
renamed into it; a run that was cut short in between is finished by the same call again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.functions.text import plain
from fleetquarry.functions.times import on_day, parse_mixed
from fleetquarry.operators.dictionaries import DICTIONARY_ROWS
from fleetquarry.operators.latest import newest_by_key
from fleetquarry.session import entries, exists, remove, rename, shared_dir, shuffles_dropped, touch

PERIOD = "period"
_READY = "_READY"
_UNREADABLE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class PeriodStore:
    """Where a store is and how it is laid out.

    ``stamp`` names the time of a row as text in any of the known layouts; rows whose time cannot be read are in a folder
    of their own and never expire. ``grain`` is "day" or "month". With ``moves`` the same key may come
    again with another time, so a merge looks for its older row in all periods (key columns only);
    without, as where the time is part of the key, it opens the batch's periods alone.
    """

    root: str
    schema: str
    keys: Sequence[str]
    stamp: str
    grain: str = "day"
    moves: bool = True

    def period_of(self, time: Column) -> Column:
        return F.trunc(time, "month") if self.grain == "month" else F.to_date(time)

    def start_of(self, day: date) -> date:
        return day.replace(day=1) if self.grain == "month" else day

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, with their period; filters on the period choose folders."""
        if not exists(spark, self.root):
            return spark.createDataFrame([], f"{self.schema}, {PERIOD} date")
        return spark.read.schema(f"{self.schema}, {PERIOD} date").option("basePath", self.root).parquet(self.root)

    def periods(self, spark: SparkSession) -> list[date | None]:
        """Periods that have a folder; None is that of unreadable times."""
        names = [n.split("=", 1)[1] for n in entries(spark, self.root) if n.startswith(f"{PERIOD}=")]
        return sorted((None if n == _UNREADABLE else date.fromisoformat(n) for n in names), key=lambda d: (d is not None, d or date.min))

    def folder(self, period: date | None) -> str:
        return f"{self.root.rstrip('/')}/{PERIOD}={_UNREADABLE if period is None else period.isoformat()}"


def _any_of(periods: Sequence[date | None]) -> Column:
    known = [F.lit(p) for p in periods if p is not None]
    out = F.col(PERIOD).isin(known) if known else F.lit(False)
    return out | F.col(PERIOD).isNull() if None in periods else out


def _staged(store: PeriodStore, run: str) -> str:
    return f"{store.root.rstrip('/')}.staged/{run}"


def _replace(spark: SparkSession, store: PeriodStore, rows: DataFrame, periods: Sequence[date | None], run: str) -> None:
    """Makes ``rows`` the content of ``periods``."""
    staged = _staged(store, run)
    # a period is written by as many tasks as its size asks for
    with shuffles_dropped(spark):
        rows.hint("rebalance", F.col(PERIOD)).write.mode("overwrite").partitionBy(PERIOD).parquet(staged)
    held = set(entries(spark, staged))
    for period in periods:
        name = store.folder(period).rsplit("/", 1)[1]
        if name not in held:
            touch(spark, f"{staged}/gone-{name}")  # its rows have all moved on
    touch(spark, f"{staged}/{_READY}")
    finish(spark, store, run)


def finish(spark: SparkSession, store: PeriodStore, run: str) -> bool:
    """Renames into the store what ``run`` has staged; False if it staged nothing complete.

    What an earlier attempt has renamed is not there any more, so this can be called again at any time.
    """
    staged = _staged(store, run)
    if not exists(spark, f"{staged}/{_READY}"):
        return False
    for name in entries(spark, staged):
        if name.startswith("gone-"):
            remove(spark, f"{store.root.rstrip('/')}/{name.removeprefix('gone-')}")
            remove(spark, f"{staged}/{name}")
        elif name.startswith(f"{PERIOD}="):
            target = f"{store.root.rstrip('/')}/{name}"
            remove(spark, target)
            rename(spark, f"{staged}/{name}", target)
    return True


def merge(spark: SparkSession, store: PeriodStore, batch: DataFrame, order: str | None = None, run: str | None = None) -> None:
    """Upserts ``batch`` into the store, a row a key; only the periods of its rows, old and new, are rewritten.

    Repeats of a key in the batch are settled by ``order``, then by the other columns. A ``run`` of the same name that was cut
    short is finished and not merged again, so a replayed batch changes nothing.
    """
    run = run or uuid.uuid4().hex
    if finish(spark, store, run):
        return
    columns = [c for c in batch.columns if c != PERIOD]
    kept = shared_dir(spark, "batch")
    placed, touched = _placed(spark, store, newest_by_key(batch.select(*columns), store.keys, [order] if order else []), kept)
    if touched:
        _merged(spark, store, placed, touched, run)
    remove(spark, kept)


def _merged(spark: SparkSession, store: PeriodStore, placed: DataFrame, touched: set[date | None], run: str) -> None:
    """Rewrites the periods of ``placed``, whose keys come once, and those that its keys leave."""
    stored, held = store.read(spark), set(store.periods(spark))
    if store.moves and held - touched:
        elsewhere = stored.where(~F.coalesce(_any_of(list(touched)), F.lit(False))).select(*store.keys, PERIOD)
        match = [elsewhere[k].eqNullSafe(placed[k]) for k in store.keys]
        moved = elsewhere.join(placed.select(*store.keys), match, "left_semi")
        touched |= {r[PERIOD] for r in moved.select(PERIOD).distinct().collect()}
    if held & touched:
        before = stored.where(_any_of(list(touched)))
        # where the time is part of the key, a row can only take the place of one of its own period
        rival = placed.where(_any_of(list(held & touched))) if store.stamp in store.keys else placed
        # a row of a period that is not rewritten is no row of the batch's keys
        match = [before[k].eqNullSafe(rival[k]) for k in store.keys]
        left = before.join(rival.select(*store.keys), match, "left_anti")
    else:
        left = stored.limit(0)  # nothing to compare with; its columns and types stay
    _replace(spark, store, left.unionByName(placed, allowMissingColumns=True), sorted(touched, key=str), run)


def _placed(spark: SparkSession, store: PeriodStore, batch: DataFrame, kept: str) -> tuple[DataFrame, set[date | None]]:
    """``batch``, written once to the folder ``kept``, with the period of each row, and these periods.

    A text of a time is read once, however many rows have it; the rows look theirs up while the texts are few enough to be sent to every task.
    """
    with shuffles_dropped(spark):
        batch.write.parquet(f"{kept}/rows")
    batch = spark.read.schema(batch.schema).parquet(f"{kept}/rows")
    texts = batch.groupBy(plain(store.stamp).alias("__stamp")).agg(F.count("*").alias("__rows"))
    # the count, never 0, keeps the reading above this aggregate; else it would be done below, row by row
    times = texts.select("__stamp", F.when(F.col("__rows") > 0, store.period_of(parse_mixed("__stamp"))).alias(PERIOD))
    with shuffles_dropped(spark):
        times.write.parquet(f"{kept}/times")
    times = spark.read.schema(times.schema).parquet(f"{kept}/times")
    # periods are days or months: a list the driver can hold
    touched = {r[PERIOD] for r in times.select(PERIOD).distinct().collect()}
    if times.limit(DICTIONARY_ROWS + 1).count() > DICTIONARY_ROWS:
        return batch.withColumn(PERIOD, store.period_of(parse_mixed(store.stamp))), touched
    found = plain(batch[store.stamp]).eqNullSafe(times["__stamp"])
    return batch.join(F.broadcast(times), found).select(*[batch[c] for c in batch.columns], PERIOD), touched


def expiring(spark: SparkSession, store: PeriodStore, cutoff: datetime) -> DataFrame:
    """Rows of the one period that the cutoff parts; its folder alone is opened."""
    return store.read(spark).where(F.col(PERIOD) == F.lit(store.start_of(cutoff.date())))


def purge(spark: SparkSession, store: PeriodStore, as_of: datetime | str, days: int, run: str | None = None) -> None:
    """Drops rows whose time is not after ``days`` before ``as_of``: whole folders, and a rewrite of the one period between."""
    at = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    cutoff = at - timedelta(days=days)
    parted = store.start_of(cutoff.date())
    for period in store.periods(spark):
        if period is not None and period < parted:
            remove(spark, store.folder(period))
    if parted in store.periods(spark):
        kept = expiring(spark, store, cutoff).where(parse_mixed(store.stamp) > F.lit(str(cutoff)).cast("timestamp_ntz"))
        _replace(spark, store, kept, [parted], run or uuid.uuid4().hex)


def rows_of_day(spark: SparkSession, store: PeriodStore, day: date | str) -> DataFrame:
    """Rows of the 24 hours after ``day``, open at both ends, from the folders that may hold them."""
    start = datetime.fromisoformat(day) if isinstance(day, str) else datetime(day.year, day.month, day.day)
    first, last = store.start_of(start.date()), store.start_of((start + timedelta(days=1)).date())
    near = F.col(PERIOD).between(F.lit(first), F.lit(last))
    return store.read(spark).where(near & on_day(parse_mixed(store.stamp), str(start))).drop(PERIOD)
