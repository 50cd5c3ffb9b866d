"""Database server builds: the published list, and what the fleet runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.codes import (
    DEFAULT_INSTANCE,
    SERVER_SERVICE_PREFIX,
    product_line,
)
from fleetquarry.functions.text import folded, instance_name, quoted_path, remove_all, short_build
from fleetquarry.functions.times import NTZ, minute_text, shift_hours
from fleetquarry.functions.versions import version_sort_key
from fleetquarry.operators.latest import top_rank
from fleetquarry.sources.html import builds_from_rows, html_table_rows


def build_list(pages: DataFrame, html: str = "html") -> DataFrame:
    """The published builds from landed pages, one row per table row."""
    return builds_from_rows(html_table_rows(pages, html))


def newest_builds(builds: DataFrame, order: str = "text") -> DataFrame:
    """The newest build of each product line, betas left out, ties kept.

    ``order="text"`` compares file versions as text, ``"version"`` by their numbers.
    """
    final = builds.filter(~F.col("update_name").contains("Beta"))
    if order == "version":
        final = final.withColumn("__key", version_sort_key("file_version"))
        return top_rank(final, ["sql_version"], "__key", descending=True).drop("__key")
    return top_rank(final, ["sql_version"], "file_version", descending=True)


def server_version_compliance(
    system: DataFrame,
    computer_system: DataFrame,
    system_ou: DataFrame,
    service: DataFrame,
    operating_system: DataFrame,
    software_file: DataFrame,
    combined_device: DataFrame,
    builds: DataFrame,
    shift: int = 3,
    order: str = "text",
    ordered: bool = True,
    case_insensitive: bool = False,
) -> DataFrame:
    """Database services with their file version and the newest build of its line.

    All that is known of a device, its many units reduced to the one shown, is joined first. Then come
    the services, their files, and last the few builds. ``case_insensitive`` compares paths so.
    """
    # after the first slash; text without one is taken whole
    unit = F.substring(F.col("ou_name"), F.locate("/", F.col("ou_name")) + F.lit(1), F.lit(200))
    units = system_ou.groupBy("resource_id").agg(F.max(unit).alias("organizational_unit"))
    services = service.filter(F.col("display_name").startswith(SERVER_SERVICE_PREFIX)).select(
        "resource_id",
        F.col("name").alias("service"),
        "start_mode",
        F.col("start_name").alias("log_on_as"),
        F.col("display_name").alias("service_name"),
        "path_name",
        quoted_path("path_name").alias("binary"),
    )
    files = software_file.select(
        "resource_id", F.concat("file_path", "file_name").alias("binary"), "file_version"
    )
    os = operating_system.select("resource_id", "caption")
    scans = combined_device.select(
        F.col("machine_id").alias("resource_id"), "last_software_scan"
    )
    newest = newest_builds(builds, order).select(
        F.col("sql_version").alias("line"),
        F.col("file_version").alias("actual_file_version"),
        F.col("build").alias("actual_build"),
        "kb",
        "update_name",
        "link",
        "release_date",
    )
    servers = system.filter(F.col("os_name_and_version").contains("Server")).select(
        "resource_id", "netbios_name", "resource_domain"
    )
    devices = (
        servers.join(os, "resource_id")
        .join(computer_system.select("resource_id"), "resource_id")
        .join(scans, "resource_id", "left")
        .join(units, "resource_id", "left")
    )
    if case_insensitive:
        services = services.withColumn("binary", folded("binary", True))
        files = files.withColumn("binary", folded("binary", True))
    joined = (
        services.join(devices, "resource_id")
        .join(files, ["resource_id", "binary"])
        .join(newest, F.substring("file_version", 1, 4) == F.col("line"), "left")
    )
    shown = [
        "netbios_name",
        "resource_domain",
        "caption",
        "service",
        "start_mode",
        "log_on_as",
        "service_name",
        "path_name",
        "file_version",
        "last_software_scan",
        "actual_file_version",
        "actual_build",
        "kb",
        "update_name",
        "link",
        "release_date",
        "line",
    ]
    grouped = joined.groupBy(*shown).agg(F.max("organizational_unit").alias("organizational_unit"))
    if ordered:
        grouped = grouped.orderBy("line", "netbios_name", "service")
    return (
        grouped.select(
            "netbios_name",
            F.col("resource_domain").alias("domain"),
            "organizational_unit",
            remove_all("caption", ["Microsoft", " Windows "]).alias("operating_system"),
            "service",
            "start_mode",
            "log_on_as",
            "service_name",
            instance_name("service_name", DEFAULT_INSTANCE).alias("instance"),
            "path_name",
            product_line("path_name").alias("sql_version"),
            "file_version",
            short_build("file_version").alias("short_file_version"),
            minute_text(shift_hours("last_software_scan", shift)).alias("last_software_scan"),
            "actual_file_version",
            "actual_build",
            "kb",
            "update_name",
            "link",
            F.col("release_date").try_cast(NTZ).alias("release_date"),
        )
    )
