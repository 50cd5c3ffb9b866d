"""Tables in hash buckets: change rows, untouched files, joins that find them dealt out."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import exchanges, no_broadcasts, paths_to, plan_of  # noqa: F401

from fleetquarry.operators.differences import ENTRY_LISTS
from fleetquarry.operators.snapshots import reconcile, reconcile_changes
from fleetquarry.plans import performance, shares
from fleetquarry.sources import buckets
from fleetquarry.sources.buckets import BucketStore
from fleetquarry.sources.tables import SCHEMAS

SCHEMA = "a bigint, b string, n int"
CHANGE = f"op string, {SCHEMA}"


@pytest.fixture
def store(tmp_path):
    return BucketStore(str(tmp_path / "store"), SCHEMA, ["a", "b"], 8)


def changes(spark, *data):
    return spark.createDataFrame(list(data), CHANGE)


def test_changes_against_a_plain_table(spark, store):
    rng, plain = random.Random(1), {}
    for turn in range(4):
        batch = {}
        for _ in range(30):
            key = (rng.choice([None, *range(12)]), rng.choice([None, "", "x", "y"]))
            op = "delete" if key in plain and rng.random() < 0.4 else "update" if key in plain else "insert"
            batch[key] = (op, *key, None if op == "delete" else rng.randrange(100))
        touched = buckets.apply_changes(spark, store, changes(spark, *batch.values()))
        for key, (op, *_, n) in batch.items():
            plain.pop(key, None)
            if op != "delete":
                plain[key] = n
        assert {(r["a"], r["b"]): r["n"] for r in store.read(spark).collect()} == plain
        assert touched == sorted(set(touched)) and max(touched) < 8
    assert buckets.apply_changes(spark, store, changes(spark).limit(0)) == []


def test_only_the_files_of_touched_buckets_are_replaced(spark, store):
    buckets.create(spark, store, spark.range(200).selectExpr("id AS a", "'x' AS b", "0 AS n"))
    before = {b: store.files(spark, b) for b in range(8)}
    assert all(len(f) == 1 for f in before.values())
    number = spark.sql("SELECT 7L AS a, 'x' AS b").select(store.bucket_of()).first()[0]
    assert buckets.apply_changes(spark, store, changes(spark, ("update", 7, "x", 9))) == [number]
    after = {b: store.files(spark, b) for b in range(8)}
    assert [b for b in range(8) if before[b] != after[b]] == [number]
    assert rows(store.read(spark).where("n = 9"), "a") == [(7,)] and store.read(spark).count() == 200


def test_a_bucket_that_becomes_empty_and_repeats_of_a_key(spark, store):
    buckets.create(spark, store, spark.sql("SELECT 1L AS a, 'x' AS b, 0 AS n"))
    buckets.apply_changes(spark, store, changes(spark, ("delete", 1, "x", None), ("insert", 2, "x", 1), ("insert", 2, "x", 3)))
    assert rows(store.read(spark)) == [(2, "x", 3)]
    buckets.apply_changes(spark, store, changes(spark, ("delete", 2, "x", None), ("update", 3, "x", 4), ("delete", 3, "x", None), ("update", 3, "x", 5)))
    assert rows(store.read(spark)) == [(3, "x", 5)]


def test_a_run_that_was_cut_short_is_finished(spark, store, monkeypatch):
    buckets.create(spark, store, spark.range(100).selectExpr("id AS a", "'x' AS b", "0 AS n"))
    real, calls = buckets.rename, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("lost")
        real(*args)

    change = changes(spark, *[("update" if i % 2 else "delete", i, "x", 1) for i in range(100)])
    monkeypatch.setattr(buckets, "rename", failing)
    with pytest.raises(OSError):
        buckets.apply_changes(spark, store, change, run="r")
    monkeypatch.setattr(buckets, "rename", real)
    buckets.apply_changes(spark, store, change, run="r")
    assert rows(store.read(spark), "a", "n") == [(i, 1) for i in sorted(range(1, 100, 2), key=str)]
    buckets.apply_changes(spark, store, changes(spark, ("delete", 1, "x", None)), run="s")
    buckets.apply_changes(spark, store, change, run="r")  # replayed
    assert store.read(spark).count() == 49


STATE = SCHEMAS["approval"]


def state_of(spark, *data):
    return spark.createDataFrame([(d, f, "Approved", None, "admin", "before", p) for d, f, p in data], STATE)


def test_change_rows_make_the_next_state(spark, tmp_path):
    rng = random.Random(4)
    pick = lambda: [(d, f, rng.choice("pqr")) for d in range(12) for f in ("A", "B") if rng.random() < 0.6]
    state, found = state_of(spark, *pick(), (50, "A", None)), spark.createDataFrame([*pick(), (50, "A", "p"), (51, "A", None)], "resource_id bigint, shared_folder_name string, permissions string")
    store = BucketStore(str(tmp_path / "approval"), STATE, ["resource_id", "shared_folder_name"], 4)
    buckets.create(spark, store, state)
    change = reconcile_changes(store.read(spark), found, "2024-01-02")
    assert {r["op"] for r in change.collect()} == {"insert", "update", "delete"}
    buckets.apply_changes(spark, store, change)
    want = reconcile(state, found, "2024-01-02")
    assert rows(store.read(spark)) == rows(want.select(*store.read(spark).columns))
    kept = store.files(spark)
    assert reconcile_changes(store.read(spark), found, "2024-01-03").count() == 0
    assert buckets.apply_changes(spark, store, reconcile_changes(store.read(spark), found, "2024-01-03")) == [] and store.files(spark) == kept


def test_the_state_is_not_exchanged(spark, tmp_path, no_broadcasts):  # noqa: F811
    store = BucketStore(str(tmp_path / "approval"), STATE, ["resource_id", "shared_folder_name"], 8)
    buckets.create(spark, store, state_of(spark, (1, "A", "p"), (2, "B", "q")))
    found = spark.range(100).selectExpr("id AS resource_id", "concat('A', id) AS shared_folder_name", "concat('p', id) AS permissions")
    (path,) = paths_to(plan_of(reconcile_changes(store.read(spark), found, "2024-01-02")), "new_permissions")
    assert exchanges(path) == 0 and any("SortMergeJoin" in n for n in path)


def test_the_counters_are_exchanged_once(spark, no_broadcasts):  # noqa: F811
    columns = (
        "date_time timestamp_ntz, date_day timestamp_ntz, average_value double, min_value double, max_value double, "
        "instance_name string, object_name string, counter_name string, netbios_name string, domain string, device string"
    )
    base = buckets.bucketed_copy(spark.createDataFrame([], columns), "counters", performance.SLICE, 8)
    paths = paths_to(plan_of(performance.performance_history(base)), "netbios_name")
    # hours, disks, processors, memory and the others; only the network's first adapters are ranked by host
    assert sum(exchanges(p) == 0 for p in paths) >= 5
    assert len([p for p in paths if exchanges(p)]) <= 3


def test_lists_with_separators_in_names_reach_the_digest(spark):
    rows_of = lambda principal: [(1, "F", "10.01.2024 08:00", "SharedPermission", principal, "Read", "AccessAllowed", "", "o"),
                                 (1, "F", "10.01.2024 08:00", "NTFSPermission", "n", "Read", "AccessDenied", "", "o")]
    scan = lambda principal: shares.current_permissions(spark.createDataFrame(rows_of(principal), SCHEMAS["share_folder_permission"]), lists=True)
    empty = spark.createDataFrame([], STATE + "".join(f", {a}_{n} array<string>" for a in ("old", "new") for n in ENTRY_LISTS))
    first = reconcile(empty, scan("a)(b"), "2024-01-10", lists=ENTRY_LISTS)
    second = reconcile(first, scan("a[NTFS](b"), "2024-01-11", lists=ENTRY_LISTS)
    (row,) = second.collect()
    assert row["old_shared_entries"] == ["a)(b: Read"] and row["new_shared_entries"] == ["a[NTFS](b: Read"]
    # texts that are equal by chance: one entry "a: x)(b: x", or two
    system = spark.createDataFrame([(1, "pc", "corp.net", *[None] * 5)], SCHEMAS["system"])
    (shown,) = shares.share_change_digest(second, system, "2024-01-11 12:00:00").collect()
    assert shown["old_line"].count("<br>") == 4 and "a)(b: Read</font>" in shown["old_line"]
    assert shown["new_line"].startswith('<strong>Shared</strong><br><font color="red">a[NTFS](b: Read</font><br><strong>NTFS</strong><br>n: Read DENY<br>')
    assert reconcile(second, scan("a[NTFS](b"), "2024-01-12", lists=ENTRY_LISTS).select(F.max("check_status_time").cast("date")).first()[0].day == 11


def test_equal_texts_with_different_lists_are_a_change(spark):
    kind = "resource_id bigint, shared_folder_name string, permissions string, e array<string>"
    now = spark.createDataFrame([(1, "F", "t", ["a)(b"])], kind)
    state = reconcile(spark.createDataFrame([], STATE + ", old_e array<string>, new_e array<string>"), now, "2024-01-01", lists=["e"])
    then = spark.createDataFrame([(1, "F", "t", ["a", "b"])], kind)
    (row,) = reconcile(state, then, "2024-01-02", lists=["e"]).collect()
    assert (row["check_status"], row["old_e"], row["new_e"]) == ("Modified", ["a)(b"], ["a", "b"])


def test_the_folder_is_listed_a_few_times_however_many_buckets_change(spark, tmp_path, monkeypatch):
    store = BucketStore(f"{tmp_path}/many", SCHEMA, ["a", "b"], 16)
    buckets.apply_changes(spark, store, changes(spark, *[("insert", k, "x", k) for k in range(100)]))
    listed, plain = [], buckets.entries
    monkeypatch.setattr(buckets, "entries", lambda *args: listed.append(args) or plain(*args))
    touched = buckets.apply_changes(spark, store, changes(spark, *[("update", k, "x", -k) for k in range(100)]))
    assert len(touched) == 16 and len(listed) <= 4
    assert sorted(r.n for r in store.read(spark).collect()) == sorted(-k for k in range(100))
    assert len(store.files(spark)) == 16
