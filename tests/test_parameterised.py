"""SQL reports with tables, lists, patterns and days as parameters."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows

from fleetquarry.plans import parameterised
from fleetquarry.plans.parameterised import ANY_DAY, SHARE_EVENT_SEARCH, run


@pytest.fixture
def views(spark):
    system = [(1, "PC1", "CORP.net", "CORP"), (2, "PC2", "LAB.net", "LAB"), (3, "PC3", None, "CORP")]
    spark.createDataFrame(system, "resource_id bigint, netbios_name string, full_domain_name string, resource_domain string").createOrReplaceTempView("p_system")
    events = [(1, 5142, "2024-01-05 00:00:00"), (1, 5143, "2024-01-05 10:00:00"), (2, 5142, "2024-01-06 10:00:00"), (3, 5142, "2024-01-06 11:00:00"), (1, 5142, None)]
    spark.createDataFrame(events, "resource_id bigint, instance_id bigint, t string").selectExpr(
        "resource_id", "'D' AS account_domain", "'a' AS account_name", "instance_id", r"'\\\\*\\share' AS share_name", "'C:/' AS share_path", "CAST(t AS timestamp_ntz) AS event_time"
    ).createOrReplaceTempView("p_events")
    return {"events": "p_events", "system": "p_system", "instance_ids": [5142, 5143], "computer": "%", "domains": [], "day": None}


def test_any_day_any_domain(spark, views):
    found = run(spark, SHARE_EVENT_SEARCH, views)
    # a device without a full domain has no computer name
    assert rows(found, "resource_id", "instance_id").count((1, 5142)) == 2 and found.count() == 4
    assert found.first()["shared_folder"] == "share"
    assert run(spark, SHARE_EVENT_SEARCH, views | {"day": ANY_DAY}).count() == 4


def test_lists_days_and_patterns(spark, views):
    count = lambda **given: run(spark, SHARE_EVENT_SEARCH, views | given).count()
    assert count(domains=["LAB", "x"]) == 1 and count(domains=["CORP", "LAB"]) == 4 and count(instance_ids=[]) == 0
    assert count(day=datetime(2024, 1, 5)) == 1  # open at both ends
    assert count(computer="PC_.lab%") == 1 and count(computer="%.corp.net") == 3


def test_values_never_become_text(spark, views):
    assert run(spark, SHARE_EVENT_SEARCH, views | {"computer": "%' OR '1' = '1", "domains": ["') OR true --"]}).count() == 0


def test_articles_by_text(spark):
    spark.createDataFrame([(1, "KB1"), (2, "KB2")], "ci_id int, article_id string").createOrReplaceTempView("p_updates")
    spark.createDataFrame([("KB1", "CVE-1"), ("KB1", "CVE-1"), ("KB1", None)], "article string, cve string").createOrReplaceTempView("p_articles")
    spark.createDataFrame([(2, 1, 6), (9, 1, 6), (2, 1, 5)], "ci_id int, referenced_ci_id int, relation_type int").createOrReplaceTempView("p_relations")
    names = {"updates": "p_updates", "articles": "p_articles", "relations": "p_relations"}
    assert rows(run(spark, parameterised.CVE_SUPERSEDENCE, names)) == [("CVE-1", "KB1", None, None), ("CVE-1", "KB1", "KB1", 1), ("CVE-1", "KB1", "KB2", 2)]
