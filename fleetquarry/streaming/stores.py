"""Event store and insert-if-absent as streams.

Keys seen so far, and repeats within the watermark, are the streams' own keyed state. In a plain store each
micro-batch writes its own folder, named by the batch id, so a batch replayed after a
failure overwrites itself, and the store is read by merging those folders, newest batch first per
key. ``compact`` folds them into one version in a fresh folder, under a number that no batch has, and
a stream restarted there goes on from it. A start that would overwrite batches of an earlier stream
is refused. No batch rewrites the whole store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from fleetquarry.functions.text import folded
from fleetquarry.functions.times import Moment, parse_mixed
from fleetquarry.operators.joins import blank_safe
from fleetquarry.operators.latest import drop_older, newest_by_key
from fleetquarry.operators.snapshots import EVENT_KEYS, RETENTION_DAYS, insert_new
from fleetquarry.session import entries, exists, touch
from fleetquarry.sources import periods
from fleetquarry.sources.periods import PeriodStore

BATCH = "batch_id"
#: Batch number of a compacted version: before every batch of a stream.
COMPACTED = -1
#: Mark in a checkpoint whose state does not hold the keys of the store it was started on.
OLDER_KEYS = "older-keys"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stored_batches(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches under ``root``, a compacted version's included."""
    names = [n for n in entries(spark, root) if n.startswith(f"{BATCH}=")]
    return sorted(int(n.split("=", 1)[1]) for n in names)


def _refuse_overwrite(spark: SparkSession, root: str, checkpoint: str) -> None:
    """A new checkpoint numbers its batches from 0 again, over those that are there."""
    found = [b for b in stored_batches(spark, root) if b != COMPACTED]
    if found and not entries(spark, checkpoint):
        raise ValueError(
            f"{root} holds batches {found[0]} to {found[-1]} of a stream, which a new checkpoint would "
            "overwrite: go on with that stream's checkpoint, or compact to a fresh folder"
        )


def _batch_writer(root: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/{BATCH}={batch_id}")

    return write


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: on the executors' disks, changes only to the checkpoint."""
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_event_store(
    parsed: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str] = EVENT_KEYS,
    event_time: str | None = None,
    lateness: str = "1 day",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append parsed events to the store under ``root``.

    With ``event_time`` repeats of a key that arrive within ``lateness`` are dropped by the
    stream itself; repeats that come later are settled when the store is read.
    """
    _refuse_overwrite(parsed.sparkSession, root, checkpoint)
    if event_time:
        parsed = parsed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))
    with _state_on_disk(parsed.sparkSession):
        return (
            parsed.writeStream.foreachBatch(_batch_writer(root))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def read_store(
    spark: SparkSession,
    root: str,
    schema: str,
    keys: Sequence[str] = EVENT_KEYS,
    order: Sequence[str] = (),
) -> DataFrame:
    """The store as a table: one row per key, the one of the last batch.

    Within one batch ``order`` decides, then the other columns.
    """
    batches = spark.read.schema(f"{schema}, {BATCH} bigint").parquet(root)
    return newest_by_key(batches, keys, [BATCH, *order]).drop(BATCH)


def compact(
    spark: SparkSession,
    root: str,
    schema: str,
    target: str,
    keys: Sequence[str] = EVENT_KEYS,
    order: Sequence[str] = (),
    as_of: Moment | None = None,
    days: int = RETENTION_DAYS,
    stamp: str = "time_generated",
) -> None:
    """The merged store as the compacted version of a fresh folder, for a stream to go on there.

    ``order`` is the reader's, so the same rows win. With ``as_of`` rows whose ``stamp`` is more than ``days``
    older are purged.
    """
    if stored_batches(spark, target):
        raise ValueError(f"{target} already holds a store; compact to a fresh folder")
    merged = read_store(spark, root, schema, keys, order)
    if as_of is not None:
        merged = drop_older(merged, parse_mixed(stamp), as_of, days)
    merged.write.mode("overwrite").parquet(f"{target}/{BATCH}={COMPACTED}")


def _state_key(df: DataFrame, key: str) -> Column:
    """A blank-safe key whose equal spellings are equal bytes, as state needs them."""
    kind = df.schema[key].dataType
    spelled = isinstance(kind, StringType) and kind != StringType()
    return F.coalesce(folded(F.col(key).cast("string"), True), F.lit("")) if spelled else blank_safe(df, key)


def start_insert_new(
    incoming: DataFrame,
    root: str,
    checkpoint: str,
    schema: str,
    keys: Sequence[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append only rows whose keys no earlier batch brought; NULL and '' are the same key.

    The keys seen so far are keyed state of the stream, so a batch costs what it holds and reads nothing of
    the batches before. Of several rows of a key in one batch any one is appended; where it matters, make all columns
    keys. A stream goes on after compaction with its own checkpoint, into the compacted folder. Only a
    new checkpoint on a compacted store compares each batch with that version, which its state does not know.
    """
    spark = incoming.sparkSession
    _refuse_overwrite(spark, root, checkpoint)
    if not entries(spark, checkpoint) and stored_batches(spark, root):
        touch(spark, f"{checkpoint}/{OLDER_KEYS}")
    older = exists(spark, f"{checkpoint}/{OLDER_KEYS}")
    marks = {f"__key{i}": _state_key(incoming, k) for i, k in enumerate(keys)}
    fresh = incoming.withColumns(marks).dropDuplicates(list(marks)).drop(*marks)

    def write(batch: DataFrame, batch_id: int) -> None:
        if older:
            known = batch.sparkSession.read.schema(schema).parquet(f"{root}/{BATCH}={COMPACTED}")
            batch = insert_new(known, batch, keys)
        batch.write.mode("overwrite").parquet(f"{root}/{BATCH}={batch_id}")

    with _state_on_disk(spark):
        return (
            fresh.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def start_period_store(
    parsed: DataFrame,
    store: PeriodStore,
    checkpoint: str,
    event_time: str,
    lateness: str,
    order: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert parsed events into a store laid out by time, as they arrive.

    ``event_time`` is a time column that only the watermark needs; it is not stored. Repeats of a key within ``lateness`` are
    dropped by the stream's state, across batches; rows that arrive later than that are dropped too, so it is
    chosen no shorter than the retention; rows without a readable time stay. A batch rewrites the periods of its rows alone, and a
    replayed one changes nothing.
    """
    keyed = parsed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(store.keys)).drop(event_time)
    # a new stream numbers its batches from 0 again, and must not take them for those of another one
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def write(batch: DataFrame, batch_id: int) -> None:
        periods.merge(batch.sparkSession, store, batch, order, run=f"{name}-{batch_id}")

    with _state_on_disk(parsed.sparkSession):
        return (
            keyed.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
