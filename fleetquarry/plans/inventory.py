"""Installed software and system summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.codes import (
    ENGLISH_LOCALE,
    LINUX_EDITION,
    VENDOR_PREFIXES,
    architecture,
    os_name,
    servicing_suffix,
)
from fleetquarry.functions.numbers import ceil_text, one_decimal
from fleetquarry.functions.text import account, before_first, cpu_text, dotted_host, plain, remove_all
from fleetquarry.functions.times import shift_hours
from fleetquarry.operators.rollups import Text, ordered_rollup

#: Products that a task joins and sorts, where the session's number of shuffle partitions would give it more.
ROWS_OF_TASK = 500_000


def installed_software(
    system: DataFrame,
    user: DataFrame,
    operating_system: DataFrame,
    combined_device: DataFrame,
    software: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    """Installed products with their device, primary user and operating system.

    All that is known of a device is joined first, so the products are joined once, on their device. The products are counted: many more than
    the session's partitions are meant for go to tasks of their own number, for tasks that outgrow their memory spill all rows, in the join
    twice, since the sort's ranges are sampled from it. A device's products still meet in one task.
    """
    tasks = software.count() // ROWS_OF_TASK
    # few devices are left to a broadcast
    own = tasks > int(software.sparkSession.conf.get("spark.sql.shuffle.partitions")) and system.count() > ROWS_OF_TASK
    people = user.select(
        F.col("user_name").alias("u_name"),
        F.col("nt_domain").alias("u_domain"),
        F.col("display_name").alias("full_user_name"),
        "department",
    )
    os = operating_system.select(
        "resource_id",
        F.col("caption").alias("os"),
        F.col("version").alias("os_build"),
        F.col("install_date").alias("os_install_date"),
        "last_bootup",
    )
    scans = combined_device.select(
        F.col("machine_id").alias("resource_id"), "last_policy_request", "last_hardware_scan"
    )
    on_user = (F.col("user_name") == F.col("u_name")) & (F.col("user_domain") == F.col("u_domain"))
    known = system.select("resource_id", "netbios_name", "resource_domain", "user_name", "user_domain").join(people, on_user, "left")
    if own:
        known, software = (df.repartition(tasks, "resource_id") for df in (known.drop("user_domain", "u_name", "u_domain"), software))
    devices = (
        known.join(os, "resource_id", "left")
        .join(scans, "resource_id", "left")
        .select(
            "resource_id",
            "netbios_name",
            "resource_domain",
            "user_name",
            "full_user_name",
            "department",
            "os",
            "os_build",
            "os_install_date",
            "last_bootup",
            "last_policy_request",
            "last_hardware_scan",
        )
    )
    report = (
        software.join(devices, "resource_id")
        .select(
            "product_name",
            F.col("product_version").alias("version"),
            "publisher",
            "software_code",
            "uninstall_string",
            "installed_location",
            "install_date",
            "time_stamp",
            "resource_id",
            "netbios_name",
            F.col("resource_domain").alias("domain"),
            "user_name",
            "full_user_name",
            "department",
            "os",
            "os_build",
            "os_install_date",
            "last_bootup",
            "last_policy_request",
            "last_hardware_scan",
        )
    )
    order = ["product_name", "version", "netbios_name", "resource_id"]
    if own and ordered:
        return report.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return report.orderBy(*order) if ordered else report


def adapter_cells(network_adapter: DataFrame, *extra: Column) -> DataFrame:
    """Addresses and hardware addresses of each device, in address order, in one aggregation."""
    bound = F.col("ip_address").isNotNull()
    order = [F.col("ip_address")]
    return ordered_rollup(
        network_adapter,
        ["resource_id"],
        {
            "ip_addresses": Text(before_first("ip_address", ","), order),
            "mac_addresses": Text(F.when(bound, F.col("mac_address")), order),
        },
        extra,
    )


def processors(processor: DataFrame) -> DataFrame:
    """One row per processor: its text with the core total of the device."""
    counts = processor.groupBy("resource_id").agg(F.count("*").alias("sockets"))
    cores = F.col("number_of_cores") * F.col("sockets")
    return processor.join(counts, "resource_id").select(
        "resource_id", cpu_text("name", cores).alias("cpu")
    )


def linux_system_info(
    system: DataFrame,
    operating_system: DataFrame,
    processor: DataFrame,
    pc_bios: DataFrame,
    computer_system: DataFrame,
    combined_device: DataFrame,
    network_adapter: DataFrame,
    logical_disk: DataFrame,
    shift: int = 3,
    ordered: bool = True,
) -> DataFrame:
    """Summary of each Linux device; everything joins on the device, so one key places it all."""
    volume = F.concat(F.lit("["), F.col("volume_name"), F.lit("] "))
    by_volume = [F.col("volume_name")]
    disks = ordered_rollup(
        logical_disk,
        ["resource_id"],
        {
            "volumes": Text(F.concat(volume, ceil_text("size_mb")), by_volume),
            "free_space": Text(
                F.concat(volume, one_decimal(F.col("free_mb") / 1024), F.lit("GB")), by_volume
            ),
        },
    )
    memory = F.concat(
        F.lit("Virtual: "),
        ceil_text("total_virtual_kb"),
        F.lit("\nVisible: "),
        ceil_text("total_visible_kb"),
        F.lit("\nSWAP: "),
        ceil_text("total_swap_kb"),
    )
    os = operating_system.select(
        "resource_id",
        F.col("caption").alias("os"),
        F.col("build_number").alias("os_build"),
        memory.alias("memory"),
        "last_bootup",
    )
    scans = combined_device.select(
        F.col("machine_id").alias("resource_id"),
        shift_hours("last_policy_request", shift).alias("last_policy_request"),
        shift_hours("last_hardware_scan", shift).alias("last_hardware_scan"),
    )
    report = (
        system.filter(F.col("agent_edition") == LINUX_EDITION)
        .join(os, "resource_id", "left")
        .join(processors(processor), "resource_id", "left")
        .join(pc_bios, "resource_id", "left")
        .join(computer_system, "resource_id", "left")
        .join(scans, "resource_id", "left")
        .join(adapter_cells(network_adapter), "resource_id", "left")
        .join(disks, "resource_id", "left")
        .select(
            "resource_id",
            "netbios_name",
            dotted_host("netbios_name", "full_domain_name").alias("host_name"),
            "ip_addresses",
            "mac_addresses",
            "volumes",
            "free_space",
            "cpu",
            "serial_number",
            "smbios_version",
            "os",
            "os_build",
            "memory",
            "last_bootup",
            "model",
            "manufacturer",
            "last_policy_request",
            "last_hardware_scan",
        )
        .distinct()
    )
    return report.orderBy("netbios_name", "resource_id") if ordered else report


def system_info(
    system: DataFrame,
    operating_system: DataFrame,
    servicing_state: DataFrame,
    servicing_name: DataFrame,
    processor: DataFrame,
    x86_pc_memory: DataFrame,
    pc_bios: DataFrame,
    system_type: DataFrame,
    network_adapter: DataFrame,
    disk: DataFrame,
) -> DataFrame:
    """Summary of each device, one row per processor."""
    wifi = F.coalesce(F.bool_or(F.col("description").contains("Wi-Fi")), F.lit(False))
    adapters = adapter_cells(network_adapter, wifi.alias("wifi"))
    disks = ordered_rollup(
        disk, ["resource_id"], {"disks": Text(ceil_text("size_mb"), [F.col("disk_index")])}
    )
    english = servicing_name.filter(F.col("locale_id") == ENGLISH_LOCALE)
    servicing = (
        servicing_state.filter(F.col("branch") == 0)
        .join(english, "name", "left")
        .select("build", F.col("value").alias("servicing"))
    )
    os = operating_system.select(
        "resource_id", "caption", "version", "os_language", "install_date", "last_bootup"
    )
    os = os.join(servicing, os["version"] == servicing["build"], "left")
    memory = x86_pc_memory.select(
        "resource_id", ceil_text("total_physical_kb", 1024 * 1024).alias("memory")
    )
    has_wifi = F.when(F.col("wifi"), F.lit("Yes")).otherwise(F.lit("No"))
    plain_caption = remove_all("caption", VENDOR_PREFIXES)
    return (
        system.join(os, "resource_id", "left")
        .join(processors(processor), "resource_id", "left")
        .join(memory, "resource_id", "left")
        .join(pc_bios.select("resource_id", "serial_number"), "resource_id", "left")
        .join(system_type, "resource_id", "left")
        .join(adapters, "resource_id", "left")
        .join(disks, "resource_id", "left")
        .select(
            "resource_id",
            "netbios_name",
            dotted_host("netbios_name", "full_domain_name").alias("host_name"),
            F.lower("full_domain_name").alias("domain"),
            "resource_domain",
            account("user_domain", "user_name").alias("primary_user"),
            "ip_addresses",
            "mac_addresses",
            "disks",
            has_wifi.alias("has_wifi"),
            "cpu",
            "memory",
            "serial_number",
            os_name("caption", "build", "servicing").alias("os"),
            F.concat(
                plain(plain_caption),
                plain(servicing_suffix("build", "servicing")),
                F.lit(" "),
                plain(architecture("system_type")),
            ).alias("os_version"),
            "os_name_and_version",
            "version",
            "os_language",
            "install_date",
            "last_bootup",
        )
    )
