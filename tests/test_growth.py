"""Plans whose tasks stay small as the tables grow: rows are made distinct before a join multiplies them."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from test_plans import optimized, plan_of

import __spark_entry__ as entry
from fleetquarry.bindings import estate
from fleetquarry.operators import dictionaries
from fleetquarry.plans import compliance, inventory, shares
from fleetquarry.sources import files

SMALL = "/root/testdata/sf0.001"


T0 = datetime(2020, 1, 1)


def top(df) -> list[str]:
    """Operators of a plan above its first join."""
    lines = [line.strip(" +-:*") for line in plan_of(df).splitlines()]
    return lines[: next(i for i, line in enumerate(lines) if "Join" in line)]


@pytest.mark.parametrize("name", ["cve_supersedence", "collated_articles", "configuration_status", "application_deployments"])
def test_rows_are_not_sorted_out_after_the_last_join(spark, name):
    above = top(entry.all_queries()[name](spark, SMALL))
    assert not [line for line in above if "Aggregate" in line or "Exchange" in line]


def test_articles_reached_twice_are_listed_once(table):
    """Two old updates of an article superseded by one new update, one by an update of the same article, one by an unknown update."""
    updates = table("update_info", (1, "A"), (2, "A"), (3, "B"), (3, "B"), (4, "A"), (9, None))
    articles = table("cve_article", *[(None, p, None, None, "A", None, None, None, "CVE-1") for p in "xy"])
    relations = table("ci_relation", (3, 1, 6), (3, 2, 6), (4, 1, 6), (7, 1, 6), (8, 2, 6), (9, 2, 6), (3, 1, 5))
    got = compliance.cve_supersedence(updates, articles, relations)
    assert rows(got) == [("CVE-1", "A", None, None), ("CVE-1", "A", None, 9), *[("CVE-1", "A", "A", i) for i in (1, 2, 4)], ("CVE-1", "A", "B", 3)]


def test_states_that_look_alike_are_shown_once(table):
    """Flags that give one text, devices listed twice, a device without states."""
    got = compliance.configuration_status(
        table("system", (1, "PC1", None, "D", "joe"), (1, "PC1", "other.net", "D", "joe"), (2, "PC2", None, "D", "ann")),
        table("ci_compliance", (1, 7, T0, 0, 0, 1), (1, 7, T0, 0, 1, 2), (1, 7, T0, 1, 1, 2), (1, 7, T0, 1, 1, 9)),
        table("ci_setting_detail", (1, 7, "off"), (1, 7, None), (2, 7, "on")),
        table("ci_rule", (7, "rule"), (7, "rule")),
        table("ci_localized", (7, 65535, "seven")),
    )
    assert rows(got, "resource_id", "noncompliant_value", "state", "state_or_value") == [
        (1, None, "Non Compliant", None), (1, None, "Not Applicable", "Not Applicable"), (1, None, "Unknown", "Unknown"),
        (1, "off", "Non Compliant", "off"), (1, "off", "Not Applicable", "Not Applicable"), (1, "off", "Unknown", "Unknown"),
        (2, "on", "Unknown", "Unknown"),
    ]


def test_deployments_that_look_alike_are_shown_once(table):
    """Items with the same last time, devices and users listed twice or under ids of the other kind, offers without a name."""
    got = compliance.application_deployments(
        table("app_deployment_result", *[(d, 1, item, state, T0, None) for d in (16777216, 42) for item in (5, 6, 7) for state in (1000, None)]),
        table("application_assignment", (1, "A", "Col", "C", 1), (1, "A", "Col", "C", 3), (1, "A", "Col", "C", 2)),
        table("ci_compliance", (16777216, 5, T0), (16777216, 6, T0)),
        table("system", (16777216, "PC", None, "D"), (16777216, "PC", "x.net", "D"), (42, "PC42", None, "D"), (42, "PC43", None, "D")),
        table("user", *[(i, n, "D", n, "IT", f"D\\{n}") for i in (42, 16777216) for n in ("joe", "joe")], (16777216, "ann", "D", "ann", "IT", "D\\ann")),
    )
    shown = [
        (name, purpose, message, last)
        for name, lasts in (("D\\PC", (None, T0)), ("D\\joe", (None,))) for purpose, rest in ((None, "Unknown"), ("Available", "Available for Install"))
        for message in ("Success", rest) for last in lasts
    ]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(got, "name", "purpose", "state_message", "last_status_utc") == sorted(shown, key=key)


def test_one_feed_file_is_read_by_many_tasks(spark, tmp_path):
    """Attributes that hold ends of tags, elements over several lines, empty ones, other elements with a like name."""
    one = """<update status="final" type="a>b/>"><id>U%d</id><title>é &lt;update&gt;\n two</title><pkglist><collection>
      <package name="p%d" version="1"><filename>p.rpm</filename></package></collection></pkglist></update>\n"""
    text = '<?xml version="1.0"?>\n<updates><updated>x</updated><update/>' + "".join(one % (i, i) for i in range(2000)) + "<update status='s' /></updates>\n"
    (tmp_path / "feed.xml").write_text(text, encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        read = files.read_updateinfo(spark, str(tmp_path / "feed.xml"))
        got, tasks = read.selectExpr("id", "_type", "title", "pkglist.collection[0].package[0]._name AS p", "_status").collect(), read.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert tasks > 4 and len(got) == 2002
    named = {r["id"]: tuple(r)[1:] for r in got if r["id"]}
    assert named == {f"U{i}": ("a>b/>", "é <update>\n two", f"p{i}", "final") for i in range(2000)}
    assert sorted(str(r["_status"]) for r in got if not r["id"]) == ["None", "s"]


def test_access_entries_are_not_dealt_out_by_code(spark, monkeypatch):
    """A few codes stand on all rows: their names come by broadcast, and even parts meet the distinct."""
    report = entry.all_queries()["share_aces_by_table"](spark, SMALL)
    plan = plan_of(report)
    assert "SortMergeJoin" not in plan and "REBALANCE" in plan
    monkeypatch.setattr(dictionaries, "DICTIONARY_ROWS", 1)
    kept = dictionaries.dictionary(spark.range(2))
    assert "broadcast" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert rows(entry.all_queries()["share_aces_by_table"](spark, SMALL)) == rows(report)


def test_articles_of_two_databases_are_dealt_out_by_the_rows(spark, monkeypatch):
    """More rows, more buckets: 6,000 lines in buckets of 500."""
    monkeypatch.setattr(estate, "ROWS_OF_BUCKET", 500)
    plan = plan_of(entry.all_queries()["cve_two_databases"](spark, SMALL))
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert f"SelectedBucketsCount: {lines // 500} out of {lines // 500}" in plan


def test_scan_times_are_read_once_a_scan(table):
    """Two spellings of the newest time, an older one, a text that is no time, a device with none."""
    permissions = table(
        "share_folder_permission", (1, "A", "10.01.2024 08:00"), (1, "B", "01/10/2024 08:00:00"), (1, "C", "09.01.2024 08:00"), (1, "D", "soon"),
        (1, "E", None), (2, "F", "soon"), (3, "G", "09.01.2024 08:00"), (3, "No Shared Folders", "10.01.2024 08:00"),
    )
    last = shares.current_permissions(permissions)
    assert rows(last, "resource_id", "shared_folder_name") == [(1, "A"), (1, "B")]
    # the patterns of times stand above the scans of a device, none among the filters and columns of rows
    read = [line for line in optimized(last).splitlines() if "RLIKE" in line]
    assert read and all("Aggregate [" in line and "RLIKE(time_added" not in line for line in read)


def test_the_feed_is_parsed_once_by_many_tasks(spark):
    report = entry.all_queries()["linux_update_compliance"](spark, SMALL)
    assert "from_xml" not in plan_of(report)
    xml = spark.createDataFrame([("<update><id>a</id></update>",)], "xml string")
    assert "Repartition" in plan_of(files.updates_from_text(xml, "xml")) or "RoundRobin" in plan_of(files.updates_from_text(xml, "xml"))


def test_products_are_dealt_to_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    """6,000 products in tasks of 100, and the same rows in the same order."""
    query, order = entry.all_queries()["installed_software"], ["product_name", "version", "netbios_name", "resource_id"]
    want = query(spark, SMALL)
    monkeypatch.setattr(inventory, "ROWS_OF_TASK", 100)
    got = query(spark, SMALL)
    assert got.rdd.getNumPartitions() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count() // 100
    assert got.select(*order).collect() == want.select(*order).collect() and rows(got) == rows(want)
