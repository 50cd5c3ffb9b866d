"""Keyed tables in hash buckets: joins and groups on the keys find them dealt out already.

A bucket is one sorted file whose name carries its number, as Spark's bucketed tables have it. A change rewrites only
the files of the buckets that it touches: the new files are first written beside the table, complete, and then take
the place of the old ones; a run that was cut short is finished by the same call again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetquarry.operators.latest import newest_by_key
from fleetquarry.session import entries, exists, remove, rename, shared_dir, shuffles_dropped, touch

OP = "op"
_READY = "_READY"
_BUCKET = re.compile(r"_(\d{5})(?:\.c\d+)?\.[^/]*$")


@dataclass(frozen=True)
class BucketStore:
    """Where a table is, its columns, its keys, and into how many buckets they are hashed. NULL keys are a key of their own."""

    root: str
    schema: str
    keys: Sequence[str]
    buckets: int = 64

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as Spark knows it to be bucketed; empty where nothing was written yet."""
        if not exists(spark, self.root):
            return spark.createDataFrame([], self.schema)
        return _table(spark, self.root, self.schema, self.keys, self.buckets)

    def bucket_of(self) -> Column:
        """The number of a row's bucket, by the hash that bucketed tables use."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def files(self, spark: SparkSession, bucket: int | None = None) -> list[str]:
        """Paths of data files, of one bucket or of all."""
        held = self.by_bucket(spark)
        return sorted(p for b, paths in held.items() for p in paths if bucket in (None, b))

    def by_bucket(self, spark: SparkSession) -> dict[int, list[str]]:
        """Paths of data files by bucket, from one listing of the folder."""
        held: dict[int, list[str]] = {}
        for name in entries(spark, self.root):
            if found := _BUCKET.search(name):
                held.setdefault(int(found[1]), []).append(f"{self.root.rstrip('/')}/{name}")
        return held


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _table(spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A view of the files at ``path`` that carries their bucketing; a catalog entry made for this read."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({_names(keys)}) SORTED BY ({_names(keys)}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay


def _written(rows: DataFrame, path: str, keys: Sequence[str], buckets: int, dealt: bool = False) -> None:
    """``rows`` as one file a bucket; ``dealt`` says that they are parted by the keys already, in as many parts."""
    name = f"written_{uuid.uuid4().hex}"
    rows = rows if dealt else rows.repartition(buckets, *keys)
    with shuffles_dropped(rows.sparkSession):
        rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").format("parquet").saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")


def bucketed_copy(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` written once to the shared folder in buckets of ``keys`` and read back.

    One exchange deals the rows out; every join and group on the keys above the copy needs none.
    """
    path = shared_dir(df.sparkSession, name)
    _written(df, path, keys, buckets)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return _table(df.sparkSession, path, schema, keys, buckets)


def create(spark: SparkSession, store: BucketStore, rows: DataFrame) -> None:
    """Writes the whole table."""
    _written(rows, store.root, store.keys, store.buckets)


def apply_changes(
    spark: SparkSession, store: BucketStore, changes: DataFrame, run: str | None = None, once: bool = False
) -> list[int]:
    """Applies rows of ``op`` insert, update or delete to the table; returns the numbers of the rewritten buckets.

    Deletes need the keys alone. Of several changes of a key one counts: a delete last, else the greatest by the other columns. Only
    files of touched buckets are read and replaced. A ``run`` of the same name that was cut short is finished and
    not applied again. ``once`` says that no key comes twice, as from ``reconcile_changes``.
    """
    run = run or uuid.uuid4().hex
    staged = f"{store.root.rstrip('/')}.staged/{run}"
    if exists(spark, f"{staged}/{_READY}"):
        return _finish(spark, store, staged)
    kept = shared_dir(spark, "changes")
    rank = F.when(F.col(OP) == "delete", 0).otherwise(1)
    single = changes if once else newest_by_key(changes, store.keys, [rank])
    with shuffles_dropped(spark):
        single.withColumn("__bucket", store.bucket_of()).write.parquet(kept)
    changes = spark.read.parquet(kept)
    # as many numbers as there are buckets at most
    touched = sorted(r["__bucket"] for r in changes.select("__bucket").distinct().collect())
    if not touched:
        remove(spark, kept)
        return []
    columns = [F.col(f"`{f}`") for f in store.read(spark).columns]
    files = store.by_bucket(spark)
    before = sorted(p for b in touched for p in files.get(b, ()))
    changed = changes.select(*columns, F.when(F.col(OP) == "delete", 2).otherwise(1).alias("__change"))
    if before:
        # old rows and changes are dealt out once, together; where a key has a change, its old rows go
        old = spark.read.schema(store.schema).parquet(*before).select(*columns, F.lit(0).alias("__change"))
        both = old.unionByName(changed).repartition(store.buckets, *store.keys)
        both = both.withColumn("__last", F.max("__change").over(Window.partitionBy(*store.keys)))
        after = both.where((F.col("__change") == 1) | (F.col("__last") == 0))
    else:
        after = changed.where("__change = 1")
    _written(after.select(*columns), staged, store.keys, store.buckets, dealt=bool(before))
    held = {int(m[1]) for n in entries(spark, staged) if (m := _BUCKET.search(n))}
    for bucket in touched:
        if bucket not in held:
            touch(spark, f"{staged}/gone-{bucket}")
    touch(spark, f"{staged}/{_READY}")
    _finish(spark, store, staged)
    remove(spark, kept)
    return touched


def _finish(spark: SparkSession, store: BucketStore, staged: str) -> list[int]:
    """Puts the staged files in the place of their buckets' old ones; what an earlier attempt has moved is not staged any more."""
    moved, held = [], store.by_bucket(spark)
    for name in entries(spark, staged):
        found = _BUCKET.search(name)
        if name.startswith("gone-"):
            bucket = int(name.removeprefix("gone-"))
        elif found:
            bucket = int(found[1])
        else:
            continue
        # once a bucket: what has just been moved in is not in the listing
        for old in held.pop(bucket, ()):
            remove(spark, old)
        if found:
            rename(spark, f"{staged}/{name}", f"{store.root.rstrip('/')}/{name}")
        else:
            remove(spark, f"{staged}/{name}")
        moved.append(bucket)
    return sorted(moved)
