"""Configuration items, application deployments, and articles that close vulnerabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.codes import (
    NEUTRAL_LOCALE,
    OFFER_TYPES,
    SUPERSEDES,
    compliance_text,
    enforcement_message,
    lookup,
)
from fleetquarry.functions.text import account, is_device_id
from fleetquarry.functions.times import shift_hours
from fleetquarry.operators.latest import distinct_rows
from fleetquarry.operators.snapshots import insert_new
from fleetquarry.sources.files import normalise_cve_sheet

ARTICLE_KEYS = [
    "release_date",
    "product",
    "product_family",
    "platform",
    "article",
    "update_classification",
    "severity",
    "impact",
    "cve",
]


def configuration_status(
    system: DataFrame,
    ci_compliance: DataFrame,
    ci_setting_detail: DataFrame,
    ci_rule: DataFrame,
    ci_localized: DataFrame,
    shift: int = 3,
) -> DataFrame:
    """Configuration item state of each device with a failed setting's rule and value.

    A state row stands for one combination of flags of a device and carries the greatest item
    id among them, while rules come from all items of the device, so the two fan out. Devices, settings and states are made
    distinct on the columns shown before they meet; a state is its text and whether it gives way to the setting's value. So
    the join that multiplies the rows gives each row once and nothing has to be sorted out after it.
    """
    flags = ("is_applicable", "is_detected", "compliance_state")
    found = ci_compliance.groupBy("resource_id", *flags).agg(
        F.max("ci_id").alias("ci_id"), F.max("last_compliance_time").alias("last_time")
    )
    titles = (
        ci_localized.filter(F.col("locale_id") == NEUTRAL_LOCALE)
        .select("ci_id", F.col("display_name").alias("item_name"))
        .distinct()
    )
    states = found.join(titles, "ci_id", "left").select(
        "resource_id",
        F.col("ci_id").alias("item_id"),
        "item_name",
        shift_hours("last_time", shift).alias("last_compliance"),
        compliance_text(*flags).alias("state"),
        compliance_text(*flags, F.lit(None).cast("string")).isNull().alias("gives_way"),
    ).distinct()
    settings = (
        ci_setting_detail.join(ci_rule, "ci_id")
        .select("resource_id", "rule_name", F.col("current_value").alias("noncompliant_value"))
        .distinct()
    )
    devices = system.select("resource_id", "netbios_name", "resource_domain", "user_name").distinct()
    # a device without states has the text of unknown flags
    text = F.coalesce("state", compliance_text(*[F.lit(None).cast("int")] * len(flags)))
    value = settings.schema["noncompliant_value"].dataType
    return (
        devices.join(settings, "resource_id")
        .join(states, "resource_id", "left")
        .select(
            *devices.columns,
            "item_id",
            "item_name",
            "last_compliance",
            "rule_name",
            "noncompliant_value",
            text.alias("state"),
            F.when(F.col("gives_way"), F.col("noncompliant_value")).otherwise(text.cast(value)).alias("state_or_value"),
        )
    )


def application_deployments(
    result: DataFrame,
    assignment: DataFrame,
    ci_compliance: DataFrame,
    system: DataFrame,
    user: DataFrame,
    shift: int = 3,
) -> DataFrame:
    """Deployment results of devices and users with purpose, message and last status time.

    Results are made distinct on their own few columns, and so are assignments, devices and users on what is shown of them; the
    joins that only add names then give each row once.
    """
    last = ci_compliance.groupBy("ci_id", "resource_id").agg(
        F.max("last_compliance_time").alias("last_status_utc")
    )
    on_device = is_device_id("resource_id")
    devices = system.where(on_device).select("resource_id", account("resource_domain", "netbios_name").alias("device_name")).distinct()
    users = user.where(~on_device).select("resource_id", "unique_user_name").distinct()
    # offers without a name are shown alike
    offer = F.when(F.col("offer_type_id").isin(list(OFFER_TYPES)), F.col("offer_type_id"))
    assignments = assignment.select(
        "assignment_id", "application_name", F.col("collection_name").alias("target_collection"), offer.alias("offer_type_id")
    ).distinct()
    # merged: a broadcast would leave a whole file split of results to one task's distinct
    results = (
        result.join(last.hint("merge"), ["ci_id", "resource_id"], "left")
        .select("resource_id", "assignment_id", "app_enforcement_state", "last_modification", "start_time", "last_status_utc")
        .distinct()
    )
    return (
        results.join(assignments, "assignment_id", "left")
        .join(devices, "resource_id", "left")
        .join(users, "resource_id", "left")
        .select(
            "resource_id",
            F.when(on_device, F.col("device_name")).otherwise(F.col("unique_user_name")).alias("name"),
            F.when(on_device, F.lit("Devices")).otherwise(F.lit("Users")).alias("deployed_on"),
            "assignment_id",
            "application_name",
            "target_collection",
            lookup("offer_type_id", OFFER_TYPES).alias("purpose"),
            "app_enforcement_state",
            enforcement_message("app_enforcement_state", "offer_type_id").alias("state_message"),
            shift_hours("last_modification", shift).alias("last_modification"),
            shift_hours("start_time", shift).alias("start_time"),
            "last_status_utc",
            shift_hours("last_status_utc", shift).alias("last_status"),
        )
    )


def cve_supersedence(
    update_info: DataFrame, cve_article: DataFrame, ci_relation: DataFrame
) -> DataFrame:
    """Articles that close a vulnerability, directly or one step up by superseding.

    The sheet repeats an article for every product and platform, so (vulnerability, article) pairs are made distinct before any
    join. What an article leads to, itself or one step up, does not depend on the vulnerability and is made distinct without
    it; so the last join, which multiplies the rows, gives each row once and nothing has to be sorted out after it.
    """
    pairs = distinct_rows(cve_article.filter("cve IS NOT NULL").select("cve", F.col("article").alias("article_id")))
    updates = distinct_rows(update_info.select("article_id", "ci_id"))
    edges = (
        ci_relation.filter(F.col("relation_type") == SUPERSEDES)
        .select("ci_id", "referenced_ci_id")
        .distinct()
    )
    newer = updates.select("ci_id", F.col("article_id").alias("newer_article_id"))
    direct = updates.select("article_id", F.col("article_id").alias("newer_article_id"), "ci_id")
    stepped = (
        edges.join(updates.withColumnRenamed("ci_id", "referenced_ci_id"), "referenced_ci_id")
        .join(newer.withColumn("newer_ci_id", F.col("ci_id")), "ci_id", "left")
        .select("article_id", "newer_article_id", F.col("newer_ci_id").alias("ci_id"))
    )
    leads = distinct_rows(direct.union(stepped))
    return leads.join(pairs, "article_id").select("cve", "article_id", "newer_article_id", "ci_id")


def new_articles(known: DataFrame, sheet: DataFrame) -> DataFrame:
    """Rows of a landed vulnerability sheet to append to the article table: unseen ones, once each."""
    return insert_new(known, normalise_cve_sheet(sheet), ARTICLE_KEYS)
