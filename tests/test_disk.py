"""Disk: what a write has shuffled is gone when it ends."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from fleetquarry.llm import common
from fleetquarry.operators import rollups
from fleetquarry.operators.snapshots import PERMISSION_KEYS
from fleetquarry.session import shuffles_dropped
from fleetquarry.sources import buckets, periods

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    """Names of the shuffle files that the session holds now."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (blocks.apply(i).getName() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


def dealt(spark, n: int = 5000):
    return spark.range(n).withColumn("x", F.xxhash64("id")).repartition("x").sortWithinPartitions("x")


def test_a_stored_table_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    kept = common.stored(dealt(spark), "dealt")
    assert shuffle_files(spark) <= before
    assert kept.count() == 5000 and spark.conf.get(CLEANUP) == "false"


def test_the_setting_is_as_before_when_a_write_fails(spark, tmp_path):
    for value in ("true", "false"):
        spark.conf.set(CLEANUP, value)
        with pytest.raises(Exception, match="boom"), shuffles_dropped(spark):
            dealt(spark).select(F.raise_error(F.lit("boom"))).write.parquet(f"{tmp_path}/{value}")
        assert spark.conf.get(CLEANUP) == value
    spark.conf.unset(CLEANUP)
    # a table that was written may be asked again: its shuffle is made again
    df = dealt(spark)
    with shuffles_dropped(spark):
        df.write.parquet(f"{tmp_path}/y")
    assert df.count() == 5000


PERMISSIONS = ("F", "10.01.2024 08:00", "Shared", "u", "Read", "Allow")
KIND = "resource_id long, shared_folder_name string, time_added string, permission_type string, security_principal string, file_system_rights string, access_control_type string"


def test_stores_leave_neither_shuffles_nor_working_copies(spark, tmp_path, monkeypatch):
    """What a merge or a change has kept beside its store is gone when it ends, and so is what it has shuffled."""
    for module in (periods, buckets):
        monkeypatch.setattr(module, "shared_dir", lambda _, name: f"{tmp_path}/shared/{name}-{uuid.uuid4().hex}")
    days = periods.PeriodStore(f"{tmp_path}/days", KIND, PERMISSION_KEYS, "time_added", moves=False)
    dealt_out = buckets.BucketStore(f"{tmp_path}/dealt", "k long, v long", ["k"], 4)
    for add in (0, 500):
        batch = spark.createDataFrame([(i + add, *PERMISSIONS) for i in range(1000)], KIND)
        changes = spark.range(add, add + 1000).selectExpr("if(id % 7 = 0, 'delete', 'update') AS op", "id AS k", "id + 1 AS v")
        periods.merge(spark, days, batch)
        buckets.apply_changes(spark, dealt_out, changes)
    assert buckets.apply_changes(spark, dealt_out, changes.limit(0)) == []
    assert days.read(spark).count() == 1500
    assert {r["k"]: r["v"] for r in dealt_out.read(spark).collect()} == {k: k + 1 for k in range(1500) if k % 7}
    assert len(dealt_out.files(spark)) == 4
    assert list((tmp_path / "shared").rglob("*.parquet")) == []


def test_parents_are_looked_for_among_keys_alone(spark):
    """The distinct of whole rows is made for the rows that are shown, not again for the join; keys without a value match nothing."""
    child = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "k int, v string").repartition(3).distinct()
    parents = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    filled = rollups.with_default_rows(parents, child, "k", {"v": "none"})
    assert sorted(filled.collect(), key=str) == sorted([(1, "a"), (None, "b"), (2, "none"), (None, "none")], key=str)
    assert len(re.findall(r"Aggregate \[k#\d+, v#\d+\]", filled._jdf.queryExecution().optimizedPlan().toString())) == 1


def test_the_entries_of_a_scan_are_shuffled_once(spark):
    """Share entries are passed on, file system entries made distinct: one exchange for the rows and for the devices that have any."""
    shared = spark.range(50).selectExpr("id AS k", "concat('s', id) AS v")
    ntfs = spark.range(30, 80).selectExpr("id AS k", "concat('n', id % 3) AS v").repartition(3).distinct()
    filled = rollups.with_default_rows(spark.range(100).toDF("k"), shared.unionByName(ntfs), "k", {"v": "none"})
    assert filled.count() == 120 and sorted(r["k"] for r in filled.where("v = 'none'").collect()) == list(range(80, 100))
    filled.collect()
    assert "ReusedExchange" in filled._jdf.queryExecution().executedPlan().toString()
