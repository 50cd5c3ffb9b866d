from __future__ import annotations

from collections import defaultdict
from datetime import datetime

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetquarry.operators import differences, joins, latest, rollups, snapshots, upkeep

D = datetime


# -- newest and ranks -----------------------------------------------------------------


def test_latest_snapshot_looks_at_all_rows_before_the_filter(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "a"), (2, 2, "none"), (3, None, "x")], "k int, t int, v string"
    )
    kept = latest.latest_snapshot(df, "k", "t", F.col("v") != "none")
    assert rows(kept) == [(1, 2, "b"), (1, 2, "c")]  # device 2 found nothing in its last scan
    assert rows(latest.latest_snapshot(df, "k", "t")) == [(1, 2, "b"), (1, 2, "c"), (2, 2, "none")]


_cells = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(_cells, _cells), min_size=1, max_size=25), st.booleans())
def test_ranks_equal_the_window_function(spark, values, descending):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, k int, v int")
    df.createOrReplaceTempView("ranked_input")
    order = "v DESC NULLS LAST" if descending else "v ASC NULLS FIRST"
    want = spark.sql(f"SELECT *, dense_rank() OVER (PARTITION BY k ORDER BY {order}) AS r FROM ranked_input")
    got = latest.dense_rank_of(df, ["k"], "v", "r", descending)
    assert rows(got) == rows(want)
    top = latest.top_rank(df, ["k"], "v", descending)
    assert rows(top) == rows(want.filter("r = 1").drop("r"))


def test_upsert(spark):
    target = spark.createDataFrame([(1, 9, "old"), (2, 9, "old"), (None, 9, "old")], "k int, t int, v string")
    batch = spark.createDataFrame([(2, 1, "a"), (2, 2, "b"), (3, 1, "c"), (None, 1, "n")], "k int, t int, v string")
    assert rows(latest.upsert(target, batch, ["k"], "t")) == [
        (None, 1, "n"), (1, 9, "old"), (2, 2, "b"), (3, 1, "c"),
    ]


def test_drop_older_keeps_unreadable_times(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2020, 6, 1)), (3, None)], "i int, t timestamp_ntz")
    assert rows(latest.drop_older(df, F.col("t"), D(2020, 6, 29), 180), "i") == [(2,), (3,)]
    edge = D(2020, 1, 1)  # exactly 180 days before the 29th of June
    assert rows(latest.drop_older(df, F.col("t"), "2020-06-29 00:00:00", 180).filter(F.col("t") == F.lit(str(edge)).cast("timestamp_ntz"))) == []


# -- roll-ups ---------------------------------------------------------------------------


def test_ordered_rollup(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 2), (1, "c", None), (1, None, 0), (2, None, 1)], "k int, v string, o int"
    )
    cells = {
        "x": rollups.Text(F.col("v"), [F.col("o")]),
        "y": rollups.Text(F.upper("v"), [F.col("v")], "'; ", "empty"),
    }
    got = rollups.ordered_rollup(df, ["k"], cells, [F.count("*").alias("n")])
    assert rows(got) == [(1, "c\na\nb", "A'; B'; C", 4), (2, None, "empty", 1)]


def test_rollup_parts_hold_a_hot_group_whole(spark):
    n = 5000
    df = spark.range(n).selectExpr("IF(id % 10 < 9, 0, id) AS k", "CAST(id AS string) AS v", "(id * 7919) % 5000 AS o")
    parts = rollups.rollup_parts(df, ["k"], F.col("v"), [F.col("o")], ",", partitions=8)
    texts = defaultdict(dict)
    for row in parts.collect():
        texts[row.k][row.part] = row.text
    want = defaultdict(list)
    for i in sorted(range(n), key=lambda i: (i * 7919) % 5000):
        want[0 if i % 10 < 9 else i].append(str(i))
    assert len(texts[0]) > 3  # the hot group is spread over tasks
    assert {k: ",".join(t for _, t in sorted(p.items())) for k, p in texts.items()} == {
        k: ",".join(v) for k, v in want.items()
    }


def test_counts_flags_and_default_rows(spark):
    parents = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    child = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z")], "k int, v string")
    assert rows(rollups.with_count(parents, child, "k", "n")) == [(None, 0), (1, 2), (2, 0)]
    assert rows(rollups.with_flag(parents, child, "k", "f")) == [(None, False), (1, True), (2, False)]
    filled = rollups.with_default_rows(parents.filter("k IS NOT NULL"), child, "k", {"v": "none"})
    assert rows(filled) == [(None, "z"), (1, "a"), (1, "b"), (2, "none")]


# -- joins --------------------------------------------------------------------------------


def test_join_shapes(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "k int, w string")
    got = joins.left_where(left, right, left.k == right.k, F.col("w") == "y")
    assert rows(got.select(left.k, "w")) == [(1, "y"), (2, None), (3, None)]
    known = spark.createDataFrame([(2, ""), (9, "a")], "k int, v string")
    assert rows(joins.blank_safe_anti(left, known, ["k", "v"])) == [(1, "a"), (3, "")]
    names = spark.createDataFrame([("A",), (None,)], "v string")
    assert rows(joins.folded_anti(left, names, "v"), "k") == [(2,), (3,)]


# -- state ----------------------------------------------------------------------------------

STATE = (
    "resource_id bigint, shared_folder_name string, check_status string, check_status_time timestamp_ntz, "
    "changed_by string, old_permissions string, new_permissions string"
)
SNAPSHOT = "resource_id bigint, shared_folder_name string, permissions string"


def test_reconcile(spark):
    old, now = D(2020, 1, 1), D(2020, 2, 2)
    state = spark.createDataFrame(
        [
            (1, "same", "Approved", old, "admin", "None", "p"),
            (1, "changed", "Approved", old, "admin", "None", "p"),
            (1, "vanished", "Approved", old, "admin", "None", "p"),
            (1, "unknown", "Approved", old, "admin", "None", None),
        ],
        STATE,
    )
    snapshot = spark.createDataFrame(
        [(1, "same", "p"), (1, "changed", "q"), (1, "unknown", "q"), (2, "same", "r"), (2, "same", "r")], SNAPSHOT
    )
    once = snapshots.reconcile(state, snapshot, now)
    want = [
        (1, "changed", "Modified", now, "Script", "p", "q"),
        (1, "same", "Approved", old, "admin", "None", "p"),
        (1, "unknown", "Approved", old, "admin", "None", None),  # not comparable: untouched
        (2, "same", "New", now, "Script", "None", "r"),
    ]
    assert rows(once) == want
    assert rows(snapshots.reconcile(once, snapshot, D(2021, 1, 1))) == want  # a second run changes nothing
    assert once.schema.simpleString() == state.schema.simpleString()


def test_insert_new_appends_once(spark):
    schema = "a string, b string, note string"
    target = spark.createDataFrame([("x", "", "stored")], schema)
    batch = spark.createDataFrame([("x", None, "n1"), ("y", None, "n2"), ("y", "", "n3"), ("z", "1", "n4")], schema)
    added = snapshots.insert_new(target, batch, ["a", "b"])
    assert [r[0] for r in rows(added)] == ["y", "z"]
    assert snapshots.insert_new(target.union(added), batch, ["a", "b"]).count() == 0


def test_stores_purge_then_upsert(spark, table):
    store = table(
        "share_folder_permission",
        (1, "F", "01.01.2020 10:00", "NTFSPermission", "u", "r", "AccessAllowed", "", "old owner"),
        (1, "F", "01.06.2020 10:00", "NTFSPermission", "u", "r", "AccessAllowed", "", "old owner"),
    )
    batch = table(
        "share_folder_permission",
        (1, "F", "01.06.2020 10:00", "NTFSPermission", "u", "r", "AccessAllowed", "", "new owner"),
        (1, "F", "01.01.2019 10:00", "NTFSPermission", "u", "r", "AccessAllowed", "", "late"),
    )
    merged = snapshots.merge_permissions(store, batch, D(2020, 8, 1))
    # only stored rows are purged, as the purge runs before the batch is published
    assert rows(merged, "time_added", "owner") == [("01.01.2019 10:00", "late"), ("01.06.2020 10:00", "new owner")]


# -- differences ------------------------------------------------------------------------------


def test_combined_permissions_and_marks(spark):
    entries = spark.createDataFrame(
        [
            (1, "SharedPermission", "b", "W", "AccessAllowed"),
            (1, "SharedPermission", "a", "R", "AccessDenied"),
            (1, "SharedPermission", "a", "R", "AccessAllowed"),
            (2, "NTFSPermission", "x & y", "F", "AccessAllowed"),
            (3, "Other", "z", "F", "AccessAllowed"),
        ],
        "k int, permission_type string, security_principal string, file_system_rights string, access_control_type string",
    )
    combined = differences.combined_permissions(entries, ["k"])
    texts = dict(rows(combined))
    assert texts == {
        1: "[Shared](a: R)(a: R DENY)(b: W)[NTFS](UNKNOWN)",
        2: "[Shared](UNKNOWN)[NTFS](x & y: F)",
        3: "[Shared](UNKNOWN)[NTFS](UNKNOWN)",
    }
    pair = spark.createDataFrame([(texts[1], texts[2]), ("None", texts[2]), (None, ""), ("Unknown", "x")], "o string, n string")
    lines = pair.select(differences.marked_line(F.col("n"), F.col("o")), differences.marked_line(F.col("o"), F.col("n")))
    red = '<font color="red">{}</font><br>'.format
    assert [tuple(r) for r in lines.collect()] == [
        (
            "<strong>Shared</strong><br>" + red("UNKNOWN") + "<strong>NTFS</strong><br>" + red("x &amp; y: F"),
            "<strong>Shared</strong><br>" + red("a: R") + red("a: R DENY") + red("b: W") + "<strong>NTFS</strong><br>" + red("UNKNOWN"),
        ),
        ("<strong>Shared</strong><br>" + red("UNKNOWN") + "<strong>NTFS</strong><br>" + red("x &amp; y: F"), "None"),
        ("Unknown", "Unknown"),
        ("Unknown", "Unknown"),
    ]


def test_names_with_marker_words_do_not_break_the_lists(spark):
    text = "[Shared](NTFS admins@corp: R)([x]: W)[NTFS](u: F)"
    shared, ntfs = differences.permission_lists(F.lit(text))
    assert tuple(spark.range(1).select(shared, ntfs).first()) == (["NTFS admins@corp: R", "[x]: W"], ["u: F"])


# -- upkeep -----------------------------------------------------------------------------------


def test_evictable(spark, table):
    cache = table(
        "cache_item",
        ("APP", "c:/1", 0, 10), ("app2", "c:/2", 0, 10), ("P1", "c:/3", 0, 10), ("P2", "c:/4", 0, 10), ("P3", "c:/4", 0, 10),
        ("U1", "c:/5", 0, 10), ("U2", "c:/6", None, 10), ("lost", "c:/7", 0, 10), ("kept", "c:/8", 1, 10), ("empty", "c:/9", 0, 0),
    )
    apps = table("app_dt", ("a", "Installed", True, "app"), ("b", "Installed", False, "APP2"), ("c", "Installed", True, None))
    programs = table(
        "program",
        ("p1", "n", "Succeeded", None), ("p1", "n", "Succeeded", "RerunNever"),
        ("p2", "n", "Succeeded", None), ("p2", "n", "Failed", None), ("p3", "n", "Succeeded", "RerunAlways"),
    )
    updates = table("update_status", ("u1", "t", "Installed"), ("u2", "t", "Missing"))
    got = upkeep.evictable(cache, apps, programs, updates)
    want = [("APP", "application"), ("P1", "package"), ("U1", "update"), ("lost", "orphan")]
    assert rows(got, "content_id", "reason") == want
    totals = rows(upkeep.eviction_totals(got), "reason", "items", "bytes")
    assert totals == [("application", 1, 10), ("orphan", 1, 10), ("package", 1, 10), ("update", 1, 10)]
    unmatched = upkeep.evictable(cache, apps, programs, updates, packages_match=False)
    assert [(c, r) for c, r in rows(unmatched, "content_id", "reason") if c.startswith("P")] == [
        ("P1", "orphan"), ("P2", "orphan"), ("P3", "orphan"),
    ]


def test_retention(spark, table):
    new, old = D(2024, 1, 30), D(2023, 1, 1)
    files = table(
        "file_inventory",
        ("C:\\Temp\\Logs\\a.log", 5, old), ("C:\\Temp\\Logs\\x\\noext", 6, old), ("c:\\temp\\logs\\new.log", 7, new),
        ("C:\\Temp\\Logs", 8, old), ("C:\\Windows\\Temp\\BootImages\\b.wim", 9, old), ("C:\\Windows\\Temp\\c", 10, old),
        ("C:\\Windows\\logs\\CBS\\d.LOG", 11, old), ("C:\\Windows\\logs\\CBS\\d.log.cab", 12, old),
        ("C:\\Users\\joe\\AppData\\Local\\Temp\\e", 13, old), ("C:\\Users\\a\\b\\AppData\\Local\\Temp\\e", 14, old),
        ("C:\\Users\\joe\\Appdata\\Local\\Mozilla\\Firefox\\Profiles\\p1\\cache2\\f", 15, old), ("C:\\PerfLogs\\g", 16, None),
    )
    report = upkeep.retention_report(files, upkeep.DEFAULT_POLICIES, "2024-01-31 00:00:00")
    assert report.count() == len(upkeep.DEFAULT_POLICIES) == 24
    assert {p: (f, b) for p, f, b in rows(report.filter("files > 0"), "path", "files", "bytes")} == {
        "C:\\Temp\\Logs\\": (2, 11),
        "C:\\Windows\\Temp\\": (1, 10),
        "C:\\Windows\\logs\\CBS\\": (1, 11),
        "C:\\Users\\*\\AppData\\Local\\Temp\\": (1, 13),
        "C:\\Users\\*\\Appdata\\Local\\Mozilla\\Firefox\\Profiles\\*\\cache2\\": (1, 15),
    }


@pytest.mark.parametrize(
    "title, name, wanted",
    [
        ("Update (KB1)", "word-en-us.cab", True),
        ("Update (KB1)", "word-RU-RU.cab", True),
        ("Update (KB1)", "word-de-de.cab", False),
        ("Update (KB1)", "word-x-none.cab", True),
        ("Update 64-Bit", "word-en-us.cab", False),
        ("Update for sharepoint", "word-en-us.cab", False),
        ("Update", "Visio-en-us.cab", False),
        (None, None, True),
    ],
)
def test_wanted_file(spark, title, name, wanted):
    df = spark.createDataFrame([(title, name)], "display_name string, file_name string")
    assert df.select(upkeep.wanted_file()).first()[0] is wanted


def test_upsert_of_null_keys_and_repeats(spark):
    kind = "k int, n int, v string"
    target = spark.createDataFrame([(None, 0, "old"), (1, 0, "old"), (2, 0, "old")], kind)
    batch = spark.createDataFrame([(None, 1, "new"), (1, 1, "z"), (1, 2, "a"), (3, 1, "new")], kind)
    assert rows(latest.upsert(target, batch, ["k"], "n"), "k", "v") == [(None, "new"), (1, "a"), (2, "old"), (3, "new")]
    assert rows(latest.upsert(target.limit(0), batch, ["k"]), "k", "v") == [(None, "new"), (1, "a"), (3, "new")]


def test_stamp_is_the_writers_layout(spark):
    one = spark.createDataFrame([(1, "x")], "a int, time_added string")
    assert rows(snapshots.stamped(one, "2024-02-03 04:05:06")) == [(1, "03.02.2024 04:05")]


def test_inserts_whose_columns_are_all_keys_keep_the_same_rows(spark):
    import itertools

    values = [None, "", "x"]
    data = [(a, b, n) for a, b, n in itertools.product(values, values, [1, None])] * 2
    batch = spark.createDataFrame(data, "a string, b string, n int")
    known = batch.where("a = 'x' AND n = 1").select("a", "b", "n")
    # a further column makes the general path
    general = snapshots.insert_new(known.withColumn("z", F.lit(0)), batch.withColumn("z", F.lit(0)), ["a", "b", "n"]).drop("z")
    assert rows(snapshots.insert_new(known, batch, ["a", "b", "n"])) == rows(general)
    assert rows(snapshots.insert_new(known, batch, ["n", "b", "a"])) == rows(general)
