"""Landed inventory, compliance, counter and event tables, with their declared schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

_T = "timestamp_ntz"

SCHEMAS = {
    "system": "resource_id bigint, netbios_name string, full_domain_name string, "
    "resource_domain string, user_name string, user_domain string, agent_edition int, "
    "os_name_and_version string",
    "user": "resource_id bigint, user_name string, nt_domain string, display_name string, "
    "department string, unique_user_name string",
    "operating_system": "resource_id bigint, caption string, version string, "
    f"build_number string, install_date {_T}, last_bootup {_T}, os_language int, "
    "total_virtual_kb bigint, total_visible_kb bigint, total_swap_kb bigint",
    "combined_device": f"machine_id bigint, last_policy_request {_T}, last_hardware_scan {_T}, "
    f"last_software_scan {_T}",
    "network_adapter": "resource_id bigint, ip_address string, mac_address string, "
    "description string",
    "logical_disk": "resource_id bigint, volume_name string, size_mb decimal(20,4), "
    "free_mb decimal(20,4)",
    "disk": "resource_id bigint, disk_index int, size_mb decimal(20,4)",
    "processor": "resource_id bigint, name string, number_of_cores int",
    "pc_bios": "resource_id bigint, serial_number string, smbios_version string",
    "computer_system": "resource_id bigint, model string, manufacturer string",
    "x86_pc_memory": "resource_id bigint, total_physical_kb bigint",
    "system_type": "resource_id bigint, system_type string",
    "servicing_state": "build string, branch int, name string",
    "servicing_name": "name string, locale_id int, value string",
    "installed_software": "resource_id bigint, product_name string, product_version string, "
    "publisher string, software_code string, uninstall_string string, "
    f"installed_location string, install_date {_T}, time_stamp {_T}",
    "add_remove_programs": "resource_id bigint, display_name string, version string, "
    f"publisher string, install_date string, time_stamp {_T}",
    "service": "resource_id bigint, name string, display_name string, start_mode string, "
    "start_name string, path_name string",
    "software_file": "resource_id bigint, file_path string, file_name string, "
    "file_version string",
    "system_ou": "resource_id bigint, ou_name string",
    "share": "resource_id bigint, name string, description string, path string",
    "collection": f"collection_id string, name string, comment string, last_refresh {_T}",
    "full_collection_membership": "collection_id string, resource_id bigint, name string, "
    "resource_type int, domain string, site_code string",
    "folder_member": "instance_key string, container_node_id int, object_type int",
    "folder": "container_node_id int, name string",
    "ci_compliance": f"resource_id bigint, ci_id int, last_compliance_time {_T}, "
    "is_applicable int, is_detected int, compliance_state int",
    "ci_setting_detail": "resource_id bigint, ci_id int, current_value string",
    "ci_rule": "ci_id int, rule_name string",
    "ci_localized": "ci_id int, locale_id int, display_name string",
    "app_deployment_result": "resource_id bigint, assignment_id int, ci_id int, "
    f"app_enforcement_state int, last_modification {_T}, start_time {_T}",
    "application_assignment": "assignment_id int, application_name string, "
    "collection_name string, collection_id string, offer_type_id int",
    "cve_article": f"release_date {_T}, product string, product_family string, "
    "platform string, article string, update_classification string, severity string, "
    "impact string, cve string",
    "update_info": "ci_id int, article_id string",
    "ci_relation": "ci_id int, referenced_ci_id int, relation_type int",
    "catalog_update": f"ci_id int, date_posted {_T}, display_name string",
    "catalog_category": "ci_id int, category_id string",
    "catalog_content": "ci_id int, content_id string",
    "catalog_file": "content_id string, file_name string, source_url string",
    "performance_rule": "rule_row_id int, object_name string, counter_name string",
    "performance_rule_instance": "performance_rule_instance_row_id int, rule_row_id int, "
    "instance_name string",
    "perf_hourly": f"date_time {_T}, performance_rule_instance_row_id int, "
    "managed_entity_row_id int, average_value double, min_value double, max_value double",
    "managed_entity": "managed_entity_row_id int, top_level_host_row_id int, name string, "
    "full_name string",
    "audit_event": f"event_id int, creation_time {_T}, target_user string, "
    "target_domain string, primary_domain string, target_sid string, category string, "
    "event_machine string, " + ", ".join(f"string0{i} string" for i in range(1, 9)),
    "folder_sharing_event": "resource_id bigint, index bigint, instance_id bigint, "
    "time_generated string, message string, security_id string, account_name string, "
    "account_domain string, logon_id string, object_type string, share_name string, "
    "share_path string, old_remark string, new_remark string, old_max_users string, "
    "new_max_users string, old_share_flags string, new_share_flags string, old_sd string, "
    "new_sd string, time_added string",
    "share_event_raw": "resource_id bigint, index bigint, time_generated string, "
    "instance_id bigint, message string",
    "share_folder_permission": "resource_id bigint, shared_folder_name string, "
    "time_added string, permission_type string, security_principal string, "
    "file_system_rights string, access_control_type string, access_control_flags string, "
    "owner string",
    "share_ace_raw": "resource_id bigint, share_name string, owner string, "
    "trustee_domain string, trustee_name string, access_mask bigint, ace_type int, "
    "ace_flags int",
    "approval": "resource_id bigint, shared_folder_name string, check_status string, "
    f"check_status_time {_T}, changed_by string, old_permissions string, "
    "new_permissions string",
    "cache_item": "content_id string, location string, persist_in_cache int, size_bytes bigint",
    "app_dt": "full_name string, install_state string, is_machine_target boolean, "
    "content_id string",
    "program": "package_id string, package_name string, last_run_status string, "
    "repeat_run_behavior string",
    "update_status": "unique_id string, title string, status string",
    "file_inventory": f"full_name string, length bigint, last_write_time {_T}",
}


#: How the source databases compare text: case and trailing blanks do not count.
COLLATION = "UTF8_LCASE_RTRIM"


def schema_of(name: str, collation: str | None = None) -> StructType:
    """A table's declared schema, its texts under ``collation``."""
    declared = StructType.fromDDL(SCHEMAS[name])
    if collation is None:
        return declared
    text = StringType(collation)
    return StructType([StructField(f.name, text if isinstance(f.dataType, StringType) else f.dataType) for f in declared])


def tables(
    spark: SparkSession, root: str, names: Iterable[str] | None = None, collation: str | None = None
) -> dict[str, DataFrame]:
    """Parquet tables under ``root`` by name, read with their declared schemas.

    With a ``collation`` every comparison of their texts in the reports (joins, DISTINCT, groups, ranks, sorts) goes by it, as
    in the source databases; which spelling of equal texts is shown is open.
    """
    return {
        name: spark.read.schema(schema_of(name, collation)).parquet(f"{root.rstrip('/')}/{name}")
        for name in (names or SCHEMAS)
    }


def collated(df: DataFrame, collation: str | DataType = COLLATION) -> DataFrame:
    """``df`` with all its text columns under ``collation``, a name or the type of a column to compare them with."""
    kind = StringType(collation) if isinstance(collation, str) else collation
    return df.select(*[F.col(f.name).cast(kind) if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema])


def catalog_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    """Tables of the session catalog by local name; names may cross catalogs and databases."""
    return {local: spark.table(qualified) for local, qualified in names.items()}


def register_views(frames: dict[str, DataFrame], prefix: str = "") -> None:
    """Make the tables visible to SQL text under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
