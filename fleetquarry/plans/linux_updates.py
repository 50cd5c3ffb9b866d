"""Installed Linux packages against the update feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetquarry.functions.codes import LINUX_EDITION
from fleetquarry.functions.text import index_of, leading, remove_all
from fleetquarry.functions.times import parse_compact_day, parse_iso_day
from fleetquarry.operators.latest import rows_at_extreme
from fleetquarry.operators.skew import heavy_keys, split_join
from fleetquarry.session import shared_dir
from fleetquarry.sources.files import FILE_SUFFIXES, update_packages, update_references
from fleetquarry.sources.tables import collated


def package_name(display: Column, version: Column) -> Column:
    """Name of ``name-version-release``: all before the separator in front of the version.

    NULL when the version is empty or not in the text.
    """
    at = index_of(version, display)
    return leading(display, F.when(at > 0, F.greatest(at - 2, F.lit(0))).otherwise(F.lit(-1)))


def version_tail(display: Column, version: Column) -> Column:
    """Everything from the version on; the whole text when the version is not in it."""
    at = F.call_function("locate", version, display)
    tail = F.substring(display, F.greatest(at, F.lit(1)), F.length(display))
    return remove_all(tail, FILE_SUFFIXES)


def linux_update_compliance(
    system: DataFrame, programs: DataFrame, updates: DataFrame, spread: int | None = None
) -> DataFrame:
    """Installed packages with the newest update of their name and its closed vulnerabilities.

    A base package is on every host. With ``spread`` the packages that a hundredth of the rows have are looked for first,
    in one pass over ``programs``, and their rows are spread over so many parts in the joins by name.

    ``updates`` is the feed as read by ``read_updateinfo``. The feed is small next to the
    installed packages; its three derived tables are distinct and are broadcast only while
    they are under the size threshold.
    """
    # three tables come from the feed, which is read and its XML parsed once
    landed = shared_dir(updates.sparkSession, "feed")
    updates.write.parquet(landed)
    updates = updates.sparkSession.read.schema(updates.schema).parquet(landed)
    # texts of the feed compare as those of the installed packages do
    kind = programs.schema["display_name"].dataType
    packages = collated(update_packages(updates), kind).distinct()
    # dates are ISO text, whose order is that of the dates
    newest = rows_at_extreme(packages, ["name"], "date").select(
        F.col("name").alias("feed_name"),
        "status",
        "type",
        "id",
        "title",
        F.concat("version", F.lit("-"), "release").alias("actual_version"),
        F.col("date").alias("newest_date"),
        F.col("file_name").alias("actual_file_name"),
    )
    released = packages.select(
        F.col("file_name").alias("current_file"), F.col("date").alias("file_date"), "name"
    ).distinct()
    closing = (
        packages.select("id", "name", "date")
        .join(collated(update_references(updates), kind).filter(F.col("cve").startswith("CVE")), "id")
        .select(
            F.col("name").alias("cve_package"),
            F.col("date").alias("cve_date"),
            "cve",
            "cve_link",
        )
        .distinct()
    )
    devices = system.filter(F.col("agent_edition") == LINUX_EDITION).select(
        "resource_id", "netbios_name"
    )
    display, version = F.col("display_name"), F.col("version")
    installed = programs.join(devices, "resource_id").select(
        "resource_id",
        "netbios_name",
        "time_stamp",
        remove_all(display, FILE_SUFFIXES).alias("installed_file"),
        package_name(display, version).alias("package"),
        version_tail(display, version).alias("current_version"),
        F.col("install_date").alias("install_text"),
        parse_compact_day("install_date").alias("install_date"),
        "publisher",
        "version",
    )
    joined = (
        installed.join(released, installed["installed_file"] == released["current_file"], "left")
        .withColumn("file_release_date", parse_iso_day("file_date"))
    )
    # the rank does not depend on the other joins, so it is taken before they multiply rows; one
    # host has few versions of one package, so the window's groups are small by nature
    versions = Window.partitionBy("package", "netbios_name").orderBy(F.desc_nulls_last("file_release_date"))
    ranked = joined.withColumn("current_version_rank", F.dense_rank().over(versions))
    # both sides come from the feed, so the installed packages take part in one join only
    feed = newest.join(closing, F.col("feed_name") == F.col("cve_package"), "left")
    required = F.when(
        F.col("feed_name").isNotNull(),
        F.when(F.col("installed_file") != F.col("actual_file_name"), F.lit("1")).otherwise(F.lit("0")),
    )
    is_open = F.when(
        F.col("cve").isNotNull(),
        F.when(F.col("file_date") < F.col("cve_date"), F.lit("1")).otherwise(F.lit("0")),
    )
    heavy = heavy_keys(programs.select(package_name(display, version).alias("package")), "package") if spread else []
    return (
        split_join(ranked, feed, "package", "feed_name", heavy, spread or 1)
        .select(
            "resource_id",
            "netbios_name",
            "time_stamp",
            F.col("installed_file").alias("display_name"),
            F.col("package").alias("name"),
            "current_version",
            "install_text",
            "install_date",
            "publisher",
            "version",
            "actual_version",
            "actual_file_name",
            required.alias("update_required"),
            "id",
            "status",
            "type",
            "title",
            parse_iso_day("newest_date").alias("release_date"),
            "file_release_date",
            "cve",
            "cve_link",
            parse_iso_day("cve_date").alias("cve_closing_date"),
            is_open.alias("cve_is_open"),
            "current_version_rank",
        )
    )
