"""Stores laid out by time, and streams that keep keys as state."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from test_plans import optimized, plan_of

from fleetquarry.functions.times import parse_mixed
from fleetquarry.operators.snapshots import merge_events
from fleetquarry.sources import periods
from fleetquarry.sources.periods import PeriodStore
from fleetquarry.streaming import stores

SCHEMA = "id bigint, time_generated string, note string"


@pytest.fixture
def store(tmp_path):
    return PeriodStore(str(tmp_path / "store"), SCHEMA, ["id"], "time_generated")


def batch(spark, *events):
    return spark.createDataFrame(list(events), SCHEMA)


def files(store, name):
    return {str(p) for p in Path(store.root).glob(f"period={name}/*.parquet")}


def held(spark, store):
    return rows(store.read(spark), "id", "note")


def test_a_merge_rewrites_only_the_days_it_touches(spark, store):
    periods.merge(spark, store, batch(spark, (1, "01.01.2024 10:00:00", "a"), (2, "02.01.2024 10:00:00", "b"), (3, "03.01.2024 10:00:00", "c")))
    before = {d: files(store, d) for d in ("2024-01-01", "2024-01-02", "2024-01-03")}
    periods.merge(spark, store, batch(spark, (2, "02.01.2024 11:00:00", "b2"), (4, "02.01.2024 10:00:00", "d")))
    assert held(spark, store) == [(1, "a"), (2, "b2"), (3, "c"), (4, "d")]
    after = {d: files(store, d) for d in before}
    assert after["2024-01-01"] == before["2024-01-01"] and after["2024-01-03"] == before["2024-01-03"]
    assert not after["2024-01-02"] & before["2024-01-02"]


def test_a_key_that_moves_leaves_its_old_day(spark, store):
    periods.merge(spark, store, batch(spark, (1, "01.01.2024 10:00:00", "a"), (2, "02.01.2024 10:00:00", "b"), (5, "02.01.2024 10:00:00", "e")))
    periods.merge(spark, store, batch(spark, (1, "05.01.2024 10:00:00", "a2"), (2, "05.01.2024 10:00:00", "b2")))
    assert held(spark, store) == [(1, "a2"), (2, "b2"), (5, "e")]
    # all rows of the first day have moved on
    assert store.periods(spark) == [date(2024, 1, 2), date(2024, 1, 5)]


def test_repeats_nulls_and_unreadable_times(spark, store):
    periods.merge(spark, store, batch(spark, (1, "soon", "a"), (1, "soon", "b"), (None, None, "n"), (2, "1/2/2024 10:00:00", "us")), order="note")
    assert store.periods(spark) == [None, date(2024, 1, 2)]
    periods.merge(spark, store, batch(spark, (None, "01.02.24 10:00:00", "n2"), (3, "", "x")))
    assert held(spark, store) == [(None, "n2"), (1, "b"), (2, "us"), (3, "x")]
    periods.merge(spark, store, batch(spark).limit(0))
    assert len(held(spark, store)) == 4
    periods.purge(spark, store, "2030-01-01 00:00:00", 1)
    # a time that cannot be read never expires
    assert held(spark, store) == [(1, "b"), (3, "x")]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_purging_equals_that_of_the_plain_store(spark, tmp_path, grain):
    events = [(i, f"{1 + i % 28:02d}.{1 + i // 28:02d}.2024 {i % 24:02d}:00:00", "x") for i in range(100)] + [(200, "31.01.2024 12:00:00", "at")]
    own = PeriodStore(str(tmp_path / "s"), SCHEMA, ["id"], "time_generated", grain=grain)
    periods.merge(spark, own, batch(spark, *events))
    periods.purge(spark, own, datetime(2024, 3, 1, 12), 30)
    want = merge_events(batch(spark, *events), batch(spark).limit(0), "2024-03-01 12:00:00", keys=["id"], days=30)
    assert held(spark, own) == rows(want, "id", "note") and 200 not in [r[0] for r in held(spark, own)]


def test_dropped_days_are_folders_and_others_keep_their_files(spark, store):
    periods.merge(spark, store, batch(spark, *[(d, f"{d:02d}.01.2024 10:00:00", "x") for d in range(1, 6)]))
    kept = {d: files(store, f"2024-01-0{d}") for d in (4, 5)}
    periods.purge(spark, store, "2024-01-13 09:00:00", 10)
    assert [p.day for p in store.periods(spark)] == [3, 4, 5]
    assert {d: files(store, f"2024-01-0{d}") for d in (4, 5)} == kept


def test_a_search_and_a_purge_open_only_their_days(spark, store):
    periods.merge(spark, store, batch(spark, *[(d, f"{d:02d}.01.2024 10:00:00", "x") for d in range(1, 6)]))
    found = periods.rows_of_day(spark, store, "2024-01-02 11:00:00")
    assert rows(found, "id") == [(3,)]
    assert "PartitionFilters: [isnotnull(period" in plan_of(found).replace("#", " ").replace("period ", "period")
    assert found.inputFiles() and {f.split("period=")[1][:10] for f in found.inputFiles()} >= {"2024-01-03"}
    parted = plan_of(periods.expiring(spark, store, datetime(2024, 1, 3, 9)))
    assert "PartitionFilters: [isnotnull(period" in parted
    assert rows(periods.rows_of_day(spark, store, date(2024, 1, 5)), "id") == [(5,)]


def test_a_run_that_was_cut_short_is_finished_and_never_merged_twice(spark, store, monkeypatch):
    periods.merge(spark, store, batch(spark, (1, "01.01.2024 10:00:00", "a"), (2, "02.01.2024 10:00:00", "b")), run="first")
    real, calls = periods.rename, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(periods, "rename", failing)
    change = batch(spark, (1, "03.01.2024 10:00:00", "a2"), (2, "02.01.2024 10:00:00", "b2"))
    with pytest.raises(OSError):
        periods.merge(spark, store, change, run="second")
    monkeypatch.setattr(periods, "rename", real)
    periods.merge(spark, store, change, run="second")
    assert held(spark, store) == [(1, "a2"), (2, "b2")] and date(2024, 1, 1) not in store.periods(spark)
    periods.merge(spark, store, batch(spark, (2, "02.01.2024 10:00:00", "b3")), run="third")
    periods.merge(spark, store, change, run="second")  # replayed
    assert held(spark, store) == [(1, "a2"), (2, "b3")]


def test_an_empty_store(spark, store):
    assert store.read(spark).count() == 0 and store.periods(spark) == []
    periods.purge(spark, store, "2024-01-01 00:00:00", 1)
    assert periods.rows_of_day(spark, store, "2024-01-01").count() == 0


# -- streams ------------------------------------------------------------------------------------


def land(spark, folder, *events, schema=SCHEMA):
    spark.createDataFrame(list(events), schema).coalesce(1).write.mode("append").parquet(folder)


def test_a_batch_of_inserts_reads_nothing_of_the_batches_before(spark, tmp_path):
    landing, root, schema = str(tmp_path / "in"), tmp_path / "store", "k string, n bigint"

    def run():
        stream = spark.readStream.schema(schema).parquet(landing)
        stores.start_insert_new(stream, str(root), str(tmp_path / "p"), schema, ["k"]).awaitTermination()

    for n in range(4):
        land(spark, landing, (f"k{n}", n), ("", n), (None, n), (f"k{n - 1}", n), schema=schema)
        run()  # each time a restart from the checkpoint
    for folder in root.glob("batch_id=*"):
        for part in folder.glob("*.parquet"):
            part.write_bytes(b"not to be read")
    land(spark, landing, ("k4", 4), ("k0", 4), ("k-1", 4), (None, 4), schema=schema)
    run()
    (last,) = [f for f in root.glob("batch_id=*") if f.name == "batch_id=4"]
    assert rows(spark.read.schema(schema).parquet(str(last)), "k", "n") == [("k4", 4)]


def test_inserts_go_on_with_their_checkpoint_after_compaction(spark, tmp_path):
    landing, root, fresh, schema = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "fresh"), "k string, n bigint"

    def run(target, progress):
        stream = spark.readStream.schema(schema).parquet(landing)
        stores.start_insert_new(stream, target, str(tmp_path / progress), schema, ["k"]).awaitTermination()

    land(spark, landing, ("a", 1), schema=schema)
    run(root, "p")
    stores.compact(spark, root, schema, fresh, ["k"])
    land(spark, landing, ("a", 2), ("b", 2), schema=schema)
    run(fresh, "p")
    assert rows(spark.read.schema(schema).parquet(fresh + "/*"), "k", "n") == [("a", 1), ("b", 2)]
    assert not (tmp_path / "p" / stores.OLDER_KEYS).exists()
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_late_rows_on_both_sides_of_the_mark(spark, tmp_path):
    landing = str(tmp_path / "in")
    own = PeriodStore(str(tmp_path / "s"), SCHEMA, ["id"], "time_generated", moves=False)

    def run(*events):
        land(spark, landing, *events)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        parsed = stream.withColumn("at", parse_mixed("time_generated").cast("timestamp"))
        stores.start_period_store(parsed, own, str(tmp_path / "p"), "at", "5 days").awaitTermination()
        return held(spark, own)

    assert run((1, "20.01.2024 00:00:00", "first"), (2, "01.01.2024 00:00:00", "old")) == [(1, "first"), (2, "old")]
    # the mark is the 15th: a row of the 16th is late and kept, one of the 14th is too late, a repeat is none
    assert run((3, "16.01.2024 00:00:00", "late"), (4, "14.01.2024 00:00:00", "too late"), (1, "20.01.2024 00:00:00", "again")) == [
        (1, "first"), (2, "old"), (3, "late"),
    ]
    assert run((5, "15.01.2024 00:00:01", "edge"), (6, "unreadable", "no time")) [:4] == [(1, "first"), (2, "old"), (3, "late"), (5, "edge")]


def replaced(spark, monkeypatch, own, rows):
    """What a merge gives to be written."""
    real, seen = periods._replace, []
    with monkeypatch.context() as patch:
        patch.setattr(periods, "_replace", lambda s, st, r, *rest: (seen.append(optimized(r)), real(s, st, r, *rest)))
        periods.merge(spark, own, rows)
    return seen[0]


def test_a_merge_compares_and_reads_times_no_more_than_it_must(spark, tmp_path, monkeypatch):
    """Times are read once a text, new periods are compared with nothing, and rows of them with no stored row."""
    own = PeriodStore(str(tmp_path / "s"), SCHEMA, ["id", "time_generated"], "time_generated", grain="month", moves=False)
    first = [(i, t, "a") for i in range(5) for t in ("01.02.2024 10:00:00", "02/01/2024 10:00:00", "soon", None)]
    plan = replaced(spark, monkeypatch, own, batch(spark, *first))
    assert "LeftAnti" not in plan and "RLIKE" not in plan
    assert own.periods(spark) == [None, date(2024, 2, 1)] and len(held(spark, own)) == 20
    plan = replaced(spark, monkeypatch, own, batch(spark, *[(i, t, "b") for i in (4, 5) for t in ("01.02.2024 10:00:00", "01.03.2024 10:00:00", None)]))
    right = plan.split("Join LeftAnti")[1].splitlines()
    assert any("Filter" in line and "2024-02-01" in line and "2024-03-01" not in line for line in right)
    assert rows(own.read(spark).where("id > 3"), "id", "time_generated", "note") == [
        (4, None, "b"), (4, "01.02.2024 10:00:00", "b"), (4, "01.03.2024 10:00:00", "b"), (4, "02/01/2024 10:00:00", "a"), (4, "soon", "a"),
        (5, None, "b"), (5, "01.02.2024 10:00:00", "b"), (5, "01.03.2024 10:00:00", "b"),
    ]


def test_times_that_are_too_many_for_a_dictionary(spark, tmp_path, monkeypatch):
    got = []
    for limit in (1, 50):
        monkeypatch.setattr(periods, "DICTIONARY_ROWS", limit)
        own = PeriodStore(str(tmp_path / f"s{limit}"), SCHEMA, ["id", "time_generated"], "time_generated", moves=False)
        for note in "ab":
            periods.merge(spark, own, batch(spark, *[(i, f"0{1 + i % 3}.01.2024 10:0{i}:00", note) for i in range(9)], (9, "soon", note), (9 if note == "b" else 8, None, note)))
        got.append(rows(own.read(spark), "id", "time_generated", "note", "period"))
    assert got[0] == got[1] and len(got[0]) == 12
