"""Texts that compare without case and trailing blanks, in reports, keys, ranks and streams."""

from __future__ import annotations

import inspect

import pytest
from conftest import rows
from test_plans import plan_of

from fleetquarry.operators import joins, latest, rollups, snapshots
from fleetquarry.plans import audit, collections, compliance, inventory, linux_updates, performance, servers, shares
from fleetquarry.sources.files import UPDATE_SCHEMA
from fleetquarry.sources.tables import COLLATION, SCHEMAS, collated, schema_of, tables
from fleetquarry.streaming import stores
from pyspark.sql import functions as F

TABLES = {
    "membership": "full_collection_membership", "result": "app_deployment_result", "assignment": "application_assignment",
    "software": "installed_software", "programs": "add_remove_programs", "rule": "performance_rule",
    "rule_instance": "performance_rule_instance", "hourly": "perf_hourly", "entity": "managed_entity",
    "permissions": "share_folder_permission",
}
BUILDS = "build string, file_version string, sql_version string, kb string, link string, update_name string, release_date string"
REPORTS = [
    audit.security_audit, collections.collection_members, collections.device_collections, compliance.configuration_status,
    compliance.application_deployments, compliance.cve_supersedence, inventory.installed_software, inventory.linux_system_info,
    inventory.system_info, linux_updates.linux_update_compliance, performance.counter_base, servers.server_version_compliance,
    shares.share_events_search, shares.share_permissions_latest, shares.current_permissions, shares.share_event_digest,
]


@pytest.mark.parametrize("report", REPORTS, ids=lambda r: r.__name__)
def test_every_report_runs_on_collated_tables(spark, report):
    """A column of no known collation or a pattern over a collated text would fail when the plan is made or run."""
    given = {"as_of": "2024-01-31", "domains": ["a"], "event_types": ["a"], "event_ids": [4720], "ordered": True}
    arguments = {}
    for name, parameter in inspect.signature(report).parameters.items():
        table = "audit_event" if report is audit.security_audit and name == "events" else {"events": "folder_sharing_event"}.get(name, TABLES.get(name, name))
        if table in SCHEMAS:
            arguments[name] = spark.createDataFrame([], schema_of(table, COLLATION))
        elif name == "updates":
            arguments[name] = collated(spark.createDataFrame([], UPDATE_SCHEMA))
        elif name == "builds":
            arguments[name] = collated(spark.createDataFrame([], BUILDS))
        elif parameter.default is inspect.Parameter.empty:
            arguments[name] = given[name]
    assert report(**arguments).collect() == []


def test_tables_keep_their_texts_and_push_filters(spark, tmp_path):
    spark.createDataFrame([(1, "Abc  "), (2, "aBC"), (3, None)], "container_node_id int, name string").write.parquet(str(tmp_path / "folder"))
    folder = tables(spark, str(tmp_path), ["folder"], collation=COLLATION)["folder"]
    assert rows(folder.where(F.col("name") == "ABC"), "container_node_id") == [(1,), (2,)]
    assert sorted(r["name"] for r in folder.where("name is not null").collect()) == ["Abc  ", "aBC"]
    assert folder.select("name").distinct().count() == 2
    assert "ReadSchema: struct<name:string" in plan_of(folder.select("name").distinct())


KEYED = "k string, v string, n int"


def frame(spark, *data, schema=KEYED):
    return collated(spark.createDataFrame(list(data), schema))


def test_keys_in_other_spellings_are_known(spark):
    known = frame(spark, ("A ", "x", 1), (None, "x", 2))
    batch = frame(spark, ("a", "X  ", 3), ("", "x", 4), (" ", "x", 4), ("b", "x", 5), ("B", "X", 6))
    new = snapshots.insert_new(known, batch, ["k", "v"])
    assert [(r["k"].strip().lower(), r["v"].strip().lower()) for r in new.collect()] == [("b", "x")]
    assert rows(joins.blank_safe_anti(batch, known, ["k", "v"]), "n") == [(5,), (6,)]
    merged = latest.upsert(known, frame(spark, ("a", "new", 9)), ["k"])
    assert sorted((r["n"], r["v"]) for r in merged.collect()) == [(2, "x"), (9, "new")]


def test_groups_and_ranks_go_by_the_collation(spark):
    df = frame(spark, ("A", "b", 1), ("a ", "B", 2), ("a", "c", 3))
    assert rows(latest.dense_rank_of(df, ["k"], "v", "rank"), "n", "rank") == [(1, 1), (2, 1), (3, 2)]
    assert rows(latest.top_rank(df, ["k"], "v"), "n") == [(1,), (2,)]
    cells = {"list": rollups.Text(F.col("v"), separator="|")}
    (only,) = rollups.ordered_rollup(df, ["k"], cells).collect()
    assert only["list"].lower() == "b|b|c"


def test_inserts_of_a_stream_go_by_the_collation(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "store")

    def run(*data):
        spark.createDataFrame(list(data), KEYED).coalesce(1).write.mode("append").parquet(landing)
        stream = collated(spark.readStream.schema(KEYED).parquet(landing))
        stores.start_insert_new(stream, root, str(tmp_path / "p"), KEYED, ["k"]).awaitTermination()
        return rows(spark.read.schema(KEYED).parquet(root + "/*"), "n")

    assert run(("A", "x", 1), (None, "x", 2)) == [(1,), (2,)]
    assert run(("a  ", "x", 3), ("", "x", 4), ("b", "x", 5)) == [(1,), (2,), (5,)]


def test_texts_are_equal_in_the_compared_form_where_the_collation_says_so(spark):
    """Every sign by itself and between letters, and texts whose lower case depends on the signs around."""
    signs = spark.range(1, 0x20000).where("id NOT BETWEEN 55296 AND 57343").selectExpr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32') AS s")
    words = spark.createDataFrame([(w,) for w in ["ΑΣ", "ας", "ασ", "ΑΣ ", "İ", "i̇", "ß", "ẞ", "SS", "x", "X  ", "X\t", " x", ""]], "s string")
    texts = collated(signs.unionByName(signs.selectExpr("concat('A', s, 'b ') AS s")).unionByName(words)).withColumn("plain", F.col("s").cast("string"))
    shown = texts.withColumn("form", joins.compared(texts, "s"))
    assert shown.select("s").distinct().count() == shown.select("form").distinct().count() == shown.select("s", "form").distinct().count()


def test_rows_are_distinct_in_one_spelling_without_a_sort_by_collation(spark):
    df = collated(spark.createDataFrame([("KB1", 1), ("kb1 ", 1), ("Kb1", 2), (None, 1), (None, 1), ("", None), (" ", None)], "a string, n int"))
    got = latest.distinct_rows(df)
    assert got.schema == df.schema
    assert sorted((r.a is None, (r.a or "").strip().lower(), r.n or 0) for r in got.collect()) == [
        (False, "", 0), (False, "kb1", 1), (False, "kb1", 2), (True, "", 1)
    ]
    assert {(r.a, r.n) for r in got.collect()} <= {(r.a, r.n) for r in df.collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("__hash" in line for line in plan.splitlines() if "Sort [" in line)
