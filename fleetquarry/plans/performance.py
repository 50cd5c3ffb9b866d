"""Hourly performance history, counters of one host and hour side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.codes import (
    CPU_COUNTER,
    CPU_OBJECTS,
    INTERFACE_COUNTERS,
    MEMORY_COUNTERS,
    OTHER_COUNTERS,
    counter_title,
    counter_value,
    interface_title,
    used_memory,
)
from fleetquarry.functions.numbers import complement, mbit
from fleetquarry.functions.text import after_first, second_segment
from fleetquarry.functions.times import Moment, day_of, days_before, shift_hours
from fleetquarry.operators.latest import top_rank

SLICE = ["date_time", "netbios_name"]
VAR_DISK = "Disk - /var Used (%)"


def device_kind(name: str = "name", full_name: str = "full_name"):
    """Kind of a host from its entity class, the class's second segment by default."""
    windows = F.col(full_name).startswith("Microsoft.Windows")
    return (
        F.when(windows & F.col(name).startswith("W"), F.lit("Windows WKS"))
        .when(windows, F.lit("Windows Server"))
        .when(~F.col(full_name).contains("."), F.lit("Unknown"))
        .otherwise(second_segment(full_name))
    )


def counter_base(
    rule: DataFrame,
    rule_instance: DataFrame,
    hourly: DataFrame,
    entity: DataFrame,
    as_of: Moment,
    days: int = 30,
    shift: int = 3,
) -> DataFrame:
    """Counter rows of the last ``days`` with their rule, instance and top-level host.

    The time and counter filters reach the scans; the dimensions are broadcast when their
    size allows.
    """
    rules = rule.filter(
        F.col("counter_name").isin([*MEMORY_COUNTERS, CPU_COUNTER, *OTHER_COUNTERS])
    )
    instances = rule_instance.join(rules, "rule_row_id").select(
        "performance_rule_instance_row_id", "instance_name", "object_name", "counter_name"
    )
    hosts = entity.select(
        F.col("managed_entity_row_id").alias("top_level_host_row_id"),
        F.col("name").alias("netbios_name"),
        after_first("name", ".", F.lit("None")).alias("domain"),
        device_kind().alias("device"),
    )
    owners = entity.select("managed_entity_row_id", "top_level_host_row_id").join(
        hosts, "top_level_host_row_id"
    )
    local = shift_hours("date_time", shift)
    return (
        hourly.filter(F.col("date_time") > days_before(as_of, days))
        .join(instances, "performance_rule_instance_row_id")
        .join(owners, "managed_entity_row_id")
        .select(
            local.alias("date_time"),
            day_of(local).alias("date_day"),
            "average_value",
            "min_value",
            "max_value",
            "instance_name",
            "object_name",
            "counter_name",
            "netbios_name",
            "domain",
            "device",
        )
    )


def performance_history(base: DataFrame, fix_network: bool = False) -> DataFrame:
    """One row per host, hour and combination of its counters, all rows distinct.

    Hours and slices are made distinct on what they show before they meet, hashed by all of
    their columns, so repeats of a hot host and hour are combined on the map side and never
    multiply. The joins share one key; a hot key among them is split by the skew rule, and no
    group is ever collected into one value. As every slice is distinct, so is their product,
    which is made in the joins and not shuffled again. The longest slice comes last. ``base``
    is read once per slice: pass a large fact through ``buckets.bucketed_copy`` with the keys SLICE first, which
    deals it out once for all of them.

    The network counters show their minimum three times unless ``fix_network`` asks for the
    value named.
    """
    joined = base.select("date_time", "date_day", "netbios_name", "domain", "device").distinct()
    slices = [
        system_disk(base),
        cpu_counters(base),
        memory_counters(base),
        network_counters(base),
        other_counters(base, fix_network),
    ]
    for piece in slices:
        joined = joined.join(piece, SLICE, "left")
    return joined.select(
        "date_time",
        "date_day",
        "netbios_name",
        "domain",
        "device",
        *MEMORY_COLUMNS,
        *CPU_COLUMNS,
        *OTHER_COLUMNS,
        "system_disk_max",
        "network_average",
        "network_max",
    )


MEMORY_COLUMNS = ["memory_average", "memory_max", "memory_min"]
CPU_COLUMNS = ["cpu_average", "cpu_max", "cpu_min"]
OTHER_COLUMNS = [
    "other_max",
    "other_min",
    "other_average",
    "other_object",
    "other_counter",
    "other_instance",
]


def memory_counters(base: DataFrame) -> DataFrame:
    """Distinct used-memory values, free memory turned around."""
    counter = F.col("counter_name")
    wanted = (F.col("object_name") == "Memory") & counter.isin(MEMORY_COUNTERS)
    return (
        base.filter(wanted)
        .select(
            *SLICE,
            used_memory(counter, "average_value", "average_value").alias("memory_average"),
            used_memory(counter, "max_value", "min_value").alias("memory_max"),
            used_memory(counter, "min_value", "max_value").alias("memory_min"),
        )
        .distinct()
    )


def cpu_counters(base: DataFrame) -> DataFrame:
    """Distinct processor values."""
    wanted = F.col("object_name").isin(CPU_OBJECTS) & (F.col("counter_name") == CPU_COUNTER)
    return (
        base.filter(wanted)
        .select(
            *SLICE,
            F.col("average_value").alias("cpu_average"),
            F.col("max_value").alias("cpu_max"),
            F.col("min_value").alias("cpu_min"),
        )
        .distinct()
    )


def system_disk(base: DataFrame) -> DataFrame:
    """Distinct highest used space of system disks."""
    counter = F.col("counter_name")
    on_root = (counter == "% Free Space") & F.col("instance_name").isin("C:", "/")
    used = F.when(counter == VAR_DISK, F.col("max_value")).otherwise(complement("min_value"))
    wanted = on_root | (counter == VAR_DISK)
    return base.filter(wanted).select(*SLICE, used.alias("system_disk_max")).distinct()


def other_counters(base: DataFrame, fix_network: bool = False) -> DataFrame:
    """Distinct space, queue and network values in report units."""
    counter = F.col("counter_name")
    average, low, high = F.col("average_value"), F.col("min_value"), F.col("max_value")

    def shown(value: Column, mirrored: Column) -> Column:
        return counter_value(counter, value, mirrored, value if fix_network else low)

    wanted = counter.isin(OTHER_COUNTERS) & ~F.col("instance_name").endswith("/LO/1")
    return (
        base.filter(wanted)
        .select(
            *SLICE,
            shown(high, low).alias("other_max"),
            shown(low, high).alias("other_min"),
            shown(average, average).alias("other_average"),
            F.col("object_name").alias("other_object"),
            counter_title(counter).alias("other_counter"),
            interface_title("instance_name", counter).alias("other_instance"),
        )
        .distinct()
    )


def network_counters(base: DataFrame) -> DataFrame:
    """Distinct rates of each host's first adapter by name and of data interfaces."""
    adapter = (F.col("object_name") == "Network Adapter") & (
        F.col("counter_name") == "Bytes Total/sec"
    )
    first = top_rank(base.filter(adapter), ["netbios_name"], "instance_name")
    # the rates of a data interface are added up per hour, both directions together
    data = base.filter(
        F.col("counter_name").isin(INTERFACE_COUNTERS) & F.col("instance_name").endswith("/1/1")
    )
    summed = data.groupBy(*SLICE, "instance_name").agg(
        F.sum("average_value").alias("average_value"), F.sum("max_value").alias("max_value")
    )
    rates = [*SLICE, "average_value", "max_value"]
    both = first.select(*rates).unionByName(summed.select(*rates))
    return both.select(
        *SLICE,
        mbit("average_value").alias("network_average"),
        mbit("max_value").alias("network_max"),
    ).distinct()
