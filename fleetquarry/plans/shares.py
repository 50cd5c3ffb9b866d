"""Shared folders: event search, permission search, and the daily change digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.codes import (
    ACCESS_TYPES,
    DEVICE_KIND_OTHER,
    DEVICE_KIND_SERVER,
    NO_SHARES,
    PERMISSION_TYPES,
    SHARE_DIGEST_LABELS,
    SHARE_EVENT_LABELS,
    lookup,
    principal,
    share_event_type,
)
from fleetquarry.functions.text import (
    account,
    contains_pattern,
    dotted_host,
    folded,
    like_pattern,
    one_of,
    unc_share,
)
from fleetquarry.functions.times import Moment, days_before, on_day, parse_mixed, second_text
from fleetquarry.operators.differences import ENTRY_LISTS, combined_permissions, marked_line
from fleetquarry.operators.latest import latest_scan
from fleetquarry.operators.rollups import with_default_rows
from fleetquarry.operators.snapshots import stamped
from fleetquarry.sources.html import html_row

FOLDER = ["resource_id", "shared_folder_name"]


def share_events_search(
    events: DataFrame,
    system: DataFrame,
    share: DataFrame,
    domains: Sequence[str],
    event_types: Sequence[str],
    computer: str = "%",
    folder: str = "",
    day: Moment | None = None,
    case_insensitive: bool = False,
) -> DataFrame:
    """Share events of some domains and types, of one day or of all time.

    Devices without a full domain have no computer name and so never match ``computer``.
    """
    named = events.withColumn("share_key", unc_share("share_name"))
    devices = system.filter(one_of("resource_domain", domains, case_insensitive)).select(
        "resource_id",
        F.concat("netbios_name", F.lit("."), F.lower("full_domain_name")).alias("computer_name"),
        "os_name_and_version",
        F.col("resource_domain").alias("domain"),
    )
    remarks = share.select(
        "resource_id", F.col("name").alias("share_key"), F.col("description").alias("remark")
    )
    shown = (
        named.join(devices.filter(like_pattern("computer_name", computer, case_insensitive)), "resource_id")
        .join(remarks, ["resource_id", "share_key"], "left")
        .select(
            "resource_id",
            "computer_name",
            "os_name_and_version",
            "domain",
            account("account_domain", "account_name").alias("changed_by"),
            "instance_id",
            share_event_type("message", SHARE_EVENT_LABELS).alias("event_type"),
            "new_sd",
            "old_sd",
            F.col("share_key").alias("shared_folder"),
            "remark",
            "share_path",
            parse_mixed("time_generated", short_years=False).alias("event_time"),
        )
        .filter(
            contains_pattern("shared_folder", folder, case_insensitive)
            & one_of("event_type", event_types, case_insensitive)
        )
    )
    return shown if day is None else shown.filter(on_day("event_time", day))


def share_permissions_latest(
    permissions: DataFrame,
    system: DataFrame,
    share: DataFrame,
    domains: Sequence[str],
    computer: str = "%",
    permission_type: str = "%",
    security_principal: str = "%",
    folder: str = "",
    case_insensitive: bool = False,
) -> DataFrame:
    """Permissions found by the last scan of each device."""
    last = latest_scan(permissions, "resource_id", "time_added", parse_mixed, "check_time")
    devices = system.filter(one_of("resource_domain", domains, case_insensitive)).select(
        "resource_id",
        dotted_host("netbios_name", "full_domain_name").alias("computer_name"),
        "os_name_and_version",
        F.when(F.col("os_name_and_version").contains("Server"), F.lit(DEVICE_KIND_SERVER))
        .otherwise(F.lit(DEVICE_KIND_OTHER))
        .alias("device_kind"),
        F.col("resource_domain").alias("domain"),
    )
    shares = share.select(
        "resource_id",
        F.col("name").alias("shared_folder_name"),
        F.col("description").alias("remark"),
        "path",
    )
    return (
        last.filter(contains_pattern("shared_folder_name", folder, case_insensitive))
        # the domain filter needs a device, so the join to devices is an inner one
        .join(devices.filter(like_pattern("computer_name", computer, case_insensitive)), "resource_id")
        .join(shares, FOLDER, "left")
        .select(
            "resource_id",
            "computer_name",
            "os_name_and_version",
            "device_kind",
            "domain",
            F.col("shared_folder_name").alias("shared_folder"),
            "remark",
            "path",
            "owner",
            lookup(folded("permission_type"), PERMISSION_TYPES, F.col("permission_type")).alias(
                "permission_type"
            ),
            principal("security_principal").alias("security_principal"),
            lookup(
                folded("access_control_type"), ACCESS_TYPES, F.col("access_control_type")
            ).alias("access"),
            F.col("file_system_rights").alias("rights"),
            "access_control_flags",
            "check_time",
        )
        .filter(
            like_pattern("permission_type", permission_type, case_insensitive)
            & like_pattern("security_principal", security_principal, case_insensitive)
        )
    )


def permission_entries(devices: DataFrame, shared: DataFrame, ntfs: DataFrame, at: Moment) -> DataFrame:
    """Rows of one scan for the permission store: share and file system entries in one list.

    A device without any entry gets the row that says so. All rows carry the scan's time.
    """
    blank = ("permission_type", "owner", "security_principal", "file_system_rights", "access_control_type")
    default = {"shared_folder_name": NO_SHARES} | {c: "" for c in blank}
    found = shared.unionByName(ntfs, allowMissingColumns=True)
    return stamped(with_default_rows(devices, found, "resource_id", default), at)


def current_permissions(permissions: DataFrame, lists: bool = False) -> DataFrame:
    """Combined permission text of each folder of each device's last scan.

    The input of ``reconcile``. A device whose last scan found no folders has none here. With ``lists`` the entries stay
    next to the text, as the columns ENTRY_LISTS.
    """
    listed = F.col("shared_folder_name") != NO_SHARES
    last = latest_scan(permissions, "resource_id", "time_added", parse_mixed, "check_time", listed)
    named = last.withColumn("security_principal", principal("security_principal"))
    return combined_permissions(named, FOLDER, lists)


def share_event_digest(
    events: DataFrame, system: DataFrame, as_of: Moment, days: int = 1, ordered: bool = True
) -> DataFrame:
    """Share events of the last day, newest first, with their HTML row."""
    name = unc_share("share_name")
    timed = events.withColumn("event_time", parse_mixed("time_generated", short_years=False))
    recent = timed.filter(F.col("event_time") > days_before(as_of, days)).join(
        system.select("resource_id", "netbios_name", "full_domain_name"), "resource_id"
    )
    digest = recent.select(
        F.concat(
            F.lit("\\\\"),
            "netbios_name",
            F.lit("."),
            F.lower("full_domain_name"),
            F.lit("\\"),
            name,
        ).alias("shared_folder_path"),
        dotted_host("netbios_name", "full_domain_name").alias("computer_name"),
        name.alias("share_name"),
        account("account_domain", "account_name").alias("changed_by"),
        "event_time",
        second_text("event_time").alias("event_time_text"),
        share_event_type("message", SHARE_DIGEST_LABELS).alias("event_type"),
    )
    digest = digest.withColumn(
        "html",
        html_row("event_type", "event_time_text", "changed_by", "computer_name", "share_name"),
    )
    if not ordered:
        return digest
    return digest.orderBy(F.desc("event_time"), "computer_name", "share_name")


def share_change_digest(
    approval: DataFrame, system: DataFrame, as_of: Moment, days: int = 1
) -> DataFrame:
    """Folders that became New or Modified in the last day, differences marked.

    Where ``approval`` carries the lists of entries, they are shown; else they are cut from the texts.
    """
    recent = approval.filter(
        F.col("check_status").isin("New", "Modified")
        & (F.col("check_status_time") > days_before(as_of, days))
    )
    folder = F.col("shared_folder_name")
    upper, lower = F.upper("netbios_name"), F.lower("netbios_name")
    full = F.col("full_domain_name")
    host = dotted_host(upper, full)
    slash = F.lit("\\")
    path = (
        F.when(folder.startswith("\\\\"), folder)
        .when(full.isNull(), F.concat(F.lit("\\\\"), lower, slash, folder))
        .otherwise(F.concat(F.lit("\\\\"), host, slash, folder))
    )
    old, new = F.col("old_permissions"), F.col("new_permissions")
    carried = f"new_{ENTRY_LISTS[0]}" in approval.columns
    old_lists, new_lists = (tuple(F.col(f"{age}_{n}") for n in ENTRY_LISTS) if carried else None for age in ("old", "new"))
    joined = recent.join(
        system.select("resource_id", "netbios_name", "full_domain_name"), "resource_id"
    )
    digest = joined.select(
        "resource_id",
        "shared_folder_name",
        host.alias("computer_name"),
        path.alias("folder_path"),
        "check_status_time",
        "check_status",
        "changed_by",
        marked_line(old, new, old_lists, new_lists).alias("old_line"),
        marked_line(new, old, new_lists, old_lists).alias("new_line"),
    )
    # the two permission cells are HTML already, their entries escaped
    plain = html_row("check_status", "computer_name", "shared_folder_name")
    marked = html_row("old_line", "new_line", escaped=False)
    inner = F.concat(
        F.regexp_replace(plain, "</tr>$", ""), F.regexp_replace(marked, "^<tr>", "")
    )
    return digest.withColumn("html", inner)
