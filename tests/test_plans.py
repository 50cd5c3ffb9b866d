"""What the plans must and must not contain, whatever the tables' sizes."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from fleetquarry.operators import joins, latest, snapshots
from fleetquarry.plans import compliance, inventory, linux_updates, performance, servers, shares
from fleetquarry.sources.files import UPDATE_SCHEMA
from fleetquarry.sources.tables import SCHEMAS

SF = "/root/testdata/sf0.001"
# work that leaves the JVM, or that pairs rows without a key
FORBIDDEN = ["Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.all_queries()))
def test_no_query_leaves_the_jvm_or_pairs_rows_without_a_key(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in plan], plan


@pytest.fixture
def landed(spark, tmp_path):
    """Empty tables on disk, so that scans and what reaches them show in the plan."""

    def read(name):
        path = str(tmp_path / name)
        spark.createDataFrame([], SCHEMAS[name]).write.mode("overwrite").parquet(path)
        return spark.read.schema(SCHEMAS[name]).parquet(path)

    return read


def test_counter_filters_reach_the_scans(landed):
    base = performance.counter_base(
        landed("performance_rule"), landed("performance_rule_instance"), landed("perf_hourly"), landed("managed_entity"), "2024-01-31"
    )
    plan = plan_of(base)
    assert "GreaterThan(date_time,2024-01-01T00:00)" in plan
    assert "In(counter_name, [" in plan


def test_history_collects_no_group_and_shuffles_no_product(landed, spark, tmp_path):
    columns = (
        "date_time timestamp_ntz, date_day timestamp_ntz, average_value double, min_value double, max_value double, "
        "instance_name string, object_name string, counter_name string, netbios_name string, domain string, device string"
    )
    spark.createDataFrame([], columns).write.mode("overwrite").parquet(str(tmp_path / "base"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(performance.performance_history(spark.read.schema(columns).parquet(str(tmp_path / "base"))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "collect_" not in plan.replace("history_collects_no", "") and "Window" not in plan
    joins_and_exchanges = [l for l in plan.splitlines() if "Join" in l or "Exchange" in l]
    # five joins on one key follow each other on the left side without an exchange between them
    assert all("SortMergeJoin" in l and "LeftOuter" in l for l in joins_and_exchanges[:5])


def test_join_types(landed):
    membership, filed = landed("full_collection_membership"), landed("folder_member")
    members = membership.join(filed, membership.collection_id == filed.instance_key, "left")
    # a left join that a later inner join makes an inner one
    late = members.join(landed("folder"), "container_node_id")
    assert "Join Inner" in optimized(late) and "LeftOuter" not in optimized(late)
    left = landed("cve_article")
    assert "LeftAnti" in optimized(joins.blank_safe_anti(left, landed("cve_article"), ["cve", "article"]))
    snapshot = latest.latest_snapshot(landed("perf_hourly"), "managed_entity_row_id", "date_time")
    assert "LeftSemi" in optimized(snapshot) and "Window" not in plan_of(snapshot)


def test_deployments_do_not_join_memberships_and_aggregate_before_joining(landed):
    report = compliance.application_deployments(
        landed("app_deployment_result"), landed("application_assignment"), landed("ci_compliance"), landed("system"), landed("user")
    )
    plan = optimized(report)
    assert plan.count("Join LeftOuter") == 4
    assert plan.index("Join LeftOuter") < plan.index("max(last_compliance_time")


def test_only_needed_columns_are_read(landed):
    report = shares.share_event_digest(landed("folder_sharing_event"), landed("system"), "2024-01-31")
    scans = [line for line in plan_of(report).splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2
    assert not any("logon_id" in s or "old_sd" in s or "agent_edition" in s for s in scans)


def test_hot_keys_meet_partial_aggregates_first(landed):
    plan = plan_of(latest.upsert(landed("approval"), landed("approval"), ["resource_id", "shared_folder_name"]))
    assert "partial_max" in plan and "Window" not in plan
    ranked = plan_of(latest.top_rank(landed("system"), ["resource_domain"], "netbios_name"))
    assert "partial_min" in ranked and "Window" not in ranked


@pytest.fixture
def no_broadcasts(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def paths_to(plan: str, scan: str) -> list[list[str]]:
    """For each scan that reads the column ``scan``, the operators above it, innermost first."""
    out, stack = [], []
    for line in plan.splitlines():
        name = line.lstrip(" :+-*")
        depth = len(line) - len(line.lstrip(" :+-"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, name))
        if "FileScan" in name and scan in name:
            out.append([n for _, n in reversed(stack[:-1])])
    return out


def exchanges(path: list[str]) -> int:
    return sum(n.startswith("Exchange") for n in path)


def test_products_are_exchanged_once(landed, no_broadcasts):
    t = {n: landed(n) for n in ("system", "user", "operating_system", "combined_device", "installed_software")}
    report = inventory.installed_software(*t.values(), ordered=False)
    (path,) = paths_to(plan_of(report), "software_code")
    assert exchanges(path) == 1


def test_services_are_not_exchanged_with_device_columns_first(landed, no_broadcasts):
    names = ("system", "computer_system", "system_ou", "service", "operating_system", "software_file", "combined_device")
    builds = landed("service").selectExpr("name AS build", "name AS file_version", "name AS sql_version", "name AS kb", "name AS link", "name AS update_name", "name AS release_date")
    report = servers.server_version_compliance(*[landed(n) for n in names], builds, ordered=False)
    path = min(paths_to(plan_of(report), "start_name"), key=exchanges)
    assert exchanges(path) <= 4  # device, file, line of builds, and the final grouping


def test_installed_packages_are_scanned_once(landed, no_broadcasts, spark):
    updates = spark.createDataFrame([], UPDATE_SCHEMA)
    report = linux_updates.linux_update_compliance(landed("system"), landed("add_remove_programs"), updates)
    assert len(paths_to(plan_of(report), "publisher")) == 1


def test_a_small_batch_moves_no_target(landed, spark):
    target = landed("share_folder_permission")
    values = ", ".join(f"'x' AS {c}" for c in target.columns[1:])
    batch = spark.sql(f"SELECT 1L AS resource_id, {values}")
    (path,) = paths_to(plan_of(latest.upsert(target, batch, list(snapshots.PERMISSION_KEYS))), "access_control_type")
    assert not [n for n in path if n.startswith(("Exchange", "SortAggregate", "Sort "))]
    (path,) = paths_to(plan_of(snapshots.insert_new(target, batch, list(snapshots.PERMISSION_KEYS))), "access_control_type")
    assert not [n for n in path if n.startswith(("Exchange hash", "SortAggregate", "Sort "))]
