"""Collections, compliance, deployments, inventory, audit and counters on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetquarry.bindings.common import load
from fleetquarry.plans.audit import security_audit
from fleetquarry.plans.collections import collection_members, device_collections
from fleetquarry.plans.compliance import (
    application_deployments,
    configuration_status,
    cve_supersedence,
)
from fleetquarry.plans.inventory import installed_software, linux_system_info, system_info
from fleetquarry.plans.parameterised import CVE_SUPERSEDENCE, run
from fleetquarry.plans.performance import SLICE, counter_base, performance_history
from fleetquarry.session import shared_dir
from fleetquarry.sources.buckets import bucketed_copy
from fleetquarry.sources.tables import SCHEMAS, catalog_tables, tables

QUERIES, ORACLES = {}, {}


# -- collections ----------------------------------------------------------------------


def _collection_members(spark: SparkSession, sf: str) -> DataFrame:
    membership = load(spark, sf, "customer").selectExpr(
        "concat('C', c_nationkey) AS collection_id",
        "c_custkey AS resource_id",
        "c_name AS name",
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 5 WHEN 'BUILDING' THEN 4 ELSE 3 END AS resource_type",
        "c_mktsegment AS domain",
        "concat('S', c_nationkey) AS site_code",
    )
    collection = load(spark, sf, "region").selectExpr(
        "concat('C', r_regionkey) AS collection_id", "r_name AS name"
    )
    return collection_members(membership, collection)


QUERIES["collection_members"] = _collection_members
ORACLES["collection_members"] = """
SELECT 'C' || c_nationkey AS collection_id, c_custkey AS resource_id, c_name AS member,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 5 WHEN c_mktsegment = 'BUILDING' THEN 4 ELSE 3 END AS resource_type,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Device' WHEN c_mktsegment = 'BUILDING' THEN 'User' ELSE 'unknown' END AS member_type,
       r_name AS collection, c_mktsegment AS domain, 'S' || c_nationkey AS site_code
FROM customer LEFT JOIN region ON r_regionkey = c_nationkey
"""


def _device_collections(spark: SparkSession, sf: str) -> DataFrame:
    nation = load(spark, sf, "nation")
    membership = load(spark, sf, "customer").selectExpr(
        "concat('N', c_nationkey) AS collection_id", "c_name AS name"
    )
    collection = nation.selectExpr(
        "concat('N', n_nationkey) AS collection_id",
        "n_name AS name",
        "CASE WHEN n_regionkey = 1 THEN n_name END AS comment",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last_refresh",
    )
    filed = nation.selectExpr(
        "concat('N', n_nationkey) AS instance_key",
        "n_regionkey AS container_node_id",
        "CASE WHEN n_regionkey = 2 THEN 5001 ELSE 5000 END AS object_type",
    )
    folder = load(spark, sf, "region").selectExpr("r_regionkey AS container_node_id", "r_name AS name")
    # landed as parquet and read back with the declared schemas
    root = shared_dir(spark, "landed")
    landed = {
        "full_collection_membership": membership, "collection": collection, "folder_member": filed, "folder": folder,
    }
    for name, frame in landed.items():
        typed = [
            F.col(c.name).cast(c.dataType).alias(c.name) if c.name in frame.columns else F.lit(None).cast(c.dataType).alias(c.name)
            for c in StructType.fromDDL(SCHEMAS[name])
        ]
        frame.select(*typed).write.parquet(f"{root}/{name}")
    t = tables(spark, root, landed)
    return device_collections(
        t["full_collection_membership"], t["collection"], t["folder_member"], t["folder"], ordered=False
    )


QUERIES["device_collections"] = _device_collections
ORACLES["device_collections"] = """
SELECT c_name AS member, 'N' || n_nationkey AS collection_id, n_name AS collection_name,
       CASE WHEN n_regionkey = 1 THEN n_name END AS comment, r_name AS folder_name,
       TIMESTAMP '2024-01-01 00:00:00' AS last_refresh
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE n_regionkey <> 2
"""


# -- compliance -----------------------------------------------------------------------


def _configuration_status(spark: SparkSession, sf: str) -> DataFrame:
    orders, nation = load(spark, sf, "orders"), load(spark, sf, "nation")
    system = load(spark, sf, "customer").selectExpr(
        "c_custkey AS resource_id",
        "c_name AS netbios_name",
        "c_mktsegment AS resource_domain",
        "concat('u', c_nationkey) AS user_name",
    )
    compliance = orders.selectExpr(
        "o_custkey AS resource_id",
        "month(o_orderdate) AS ci_id",
        "o_orderdate AS last_compliance_time",
        "CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END AS is_applicable",
        "CASE o_orderpriority WHEN '5-LOW' THEN 0 ELSE 1 END AS is_detected",
        "CAST(left(o_orderpriority, 1) AS int) + month(o_orderdate) % 3 AS compliance_state",
    )
    detail = orders.selectExpr(
        "o_custkey AS resource_id",
        "month(o_orderdate) AS ci_id",
        "nullif(o_orderstatus, 'O') AS current_value",
    )
    rule = nation.selectExpr("n_nationkey AS ci_id", "concat('Rule ', n_name) AS rule_name")
    localized = nation.selectExpr(
        "n_nationkey AS ci_id",
        "CASE WHEN n_regionkey = 0 THEN 1033 ELSE 65535 END AS locale_id",
        "concat('Item ', n_name) AS display_name",
    )
    return configuration_status(system, compliance, detail, rule, localized)


QUERIES["configuration_status"] = _configuration_status
ORACLES["configuration_status"] = """
WITH flagged AS (
  SELECT o_custkey AS dev, month(o_orderdate) AS item, o_orderdate AS seen,
         o_orderstatus <> 'P' AS applicable, o_orderpriority <> '5-LOW' AS detected,
         CAST(left(o_orderpriority, 1) AS INTEGER) + month(o_orderdate) % 3 AS st
  FROM orders),
grouped AS (
  SELECT dev, applicable, detected, st, max(item) AS item, max(seen) AS seen
  FROM flagged GROUP BY ALL),
worded AS (
  SELECT *, CASE WHEN NOT applicable THEN 'Not Applicable' WHEN NOT detected THEN 'Not Detected'
                 WHEN st IN (1, 4) THEN 'Compliant' WHEN st = 2 THEN 'Non Compliant'
                 WHEN st IN (5, 6) THEN 'Status ' || st ELSE 'Unknown' END AS words
  FROM grouped)
SELECT DISTINCT c_custkey AS resource_id, c_name AS netbios_name, c_mktsegment AS resource_domain,
       'u' || c_nationkey AS user_name, CAST(w.item AS INTEGER) AS item_id,
       CASE WHEN t.n_regionkey <> 0 THEN 'Item ' || t.n_name END AS item_name,
       w.seen + INTERVAL 3 HOUR AS last_compliance, 'Rule ' || r.n_name AS rule_name,
       nullif(o_orderstatus, 'O') AS noncompliant_value, words AS state,
       CASE WHEN words = 'Non Compliant' THEN nullif(o_orderstatus, 'O') ELSE words END AS state_or_value
FROM customer
JOIN orders ON o_custkey = c_custkey
JOIN nation r ON r.n_nationkey = month(o_orderdate)
LEFT JOIN worded w ON w.dev = c_custkey
LEFT JOIN nation t ON t.n_nationkey = w.item
"""


def _application_deployments(spark: SparkSession, sf: str) -> DataFrame:
    orders, nation = load(spark, sf, "orders"), load(spark, sf, "nation")
    result = load(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_linestatus = 'F' THEN l_orderkey + 10000000 ELSE l_suppkey END AS resource_id",
        "l_linenumber AS assignment_id",
        "l_linenumber AS ci_id",
        "CASE l_returnflag WHEN 'A' THEN 1000 + l_linenumber % 4 "
        "WHEN 'R' THEN 5000 + CAST(l_quantity AS int) END AS app_enforcement_state",
        "l_shipdate AS last_modification",
        "CASE WHEN l_linenumber < 6 THEN l_shipdate END AS start_time",
    )
    assignment = nation.selectExpr(
        "n_nationkey AS assignment_id",
        "n_name AS application_name",
        "concat('Col ', n_name) AS collection_name",
        "n_regionkey AS offer_type_id",
    )
    compliance = orders.selectExpr(
        "o_orderkey + 10000000 AS resource_id",
        "month(o_orderdate) AS ci_id",
        "o_orderdate AS last_compliance_time",
    )
    system = orders.selectExpr(
        "o_orderkey + 10000000 AS resource_id",
        "concat('PC', o_orderkey) AS netbios_name",
        "nullif(o_orderstatus, 'P') AS resource_domain",
    )
    user = load(spark, sf, "supplier").selectExpr("s_suppkey AS resource_id", "s_name AS unique_user_name")
    return application_deployments(result, assignment, compliance, system, user)


QUERIES["application_deployments"] = _application_deployments
ORACLES["application_deployments"] = """
WITH base AS (
  SELECT *, l_linestatus = 'F' AS dev,
         CASE WHEN l_returnflag = 'A' THEN 1000 + l_linenumber % 4
              WHEN l_returnflag = 'R' THEN 5000 + CAST(l_quantity AS INTEGER) END AS st
  FROM lineitem),
messages(st, msg) AS (VALUES (1000, 'Success'), (1001, 'Already Compliant'), (1002, 'Simulate Success'),
  (5000, 'Deployment failed'), (5001, 'Evaluation failed'), (5002, 'Deployment failed'),
  (5003, 'Failed to locate content'), (5004, 'Dependency installation failed'),
  (5005, 'Failed to download dependent content'), (5006, 'Conflicts with another application deployment'),
  (5007, 'Waiting retry'), (5008, 'Failed to uninstall superseded deployment type'),
  (5009, 'Failed to download superseded deployment type'),
  (5010, 'Failed to updating App-V Virtual Environment'))
SELECT DISTINCT CASE WHEN dev THEN l_orderkey + 10000000 ELSE l_suppkey END AS resource_id,
       CASE WHEN dev THEN nullif(o_orderstatus, 'P') || '\\' || 'PC' || o_orderkey ELSE s_name END AS name,
       CASE WHEN dev THEN 'Devices' ELSE 'Users' END AS deployed_on,
       l_linenumber AS assignment_id, n_name AS application_name, 'Col ' || n_name AS target_collection,
       CASE n_regionkey WHEN 0 THEN 'Required' WHEN 2 THEN 'Available' END AS purpose,
       st AS app_enforcement_state,
       coalesce(msg, CASE WHEN n_regionkey = 2 THEN 'Available for Install' WHEN base.st IS NULL THEN 'Unknown' END) AS state_message,
       l_shipdate + INTERVAL 3 HOUR AS last_modification,
       CASE WHEN l_linenumber < 6 THEN l_shipdate + INTERVAL 3 HOUR END AS start_time,
       CASE WHEN dev AND month(o_orderdate) = l_linenumber THEN o_orderdate END AS last_status_utc,
       CASE WHEN dev AND month(o_orderdate) = l_linenumber THEN o_orderdate + INTERVAL 3 HOUR END AS last_status
FROM base
LEFT JOIN nation ON n_nationkey = l_linenumber
LEFT JOIN messages USING (st)
LEFT JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN supplier ON s_suppkey = l_suppkey
""".replace("\\\\", "\\")


def _cve_supersedence(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = load(spark, sf, "lineitem")
    update_info = load(spark, sf, "part").selectExpr(
        "CAST(p_partkey AS int) AS ci_id", "CAST(4000000 + p_partkey DIV 3 AS string) AS article_id"
    )
    articles = lineitem.selectExpr(
        "CAST(4000000 + l_partkey DIV 3 AS string) AS article",
        "CASE WHEN l_returnflag <> 'N' THEN concat('CVE-2020-', l_suppkey) END AS cve",
    )
    relation = lineitem.selectExpr(
        "CAST(l_partkey + 1 AS int) AS ci_id",
        "CAST(l_partkey AS int) AS referenced_ci_id",
        "l_linenumber AS relation_type",
    )
    return cve_supersedence(update_info, articles, relation)


QUERIES["cve_supersedence"] = _cve_supersedence
ORACLES["cve_supersedence"] = """
WITH hits AS (
  SELECT DISTINCT 'CVE-2020-' || l_suppkey AS cve, CAST(4000000 + l_partkey // 3 AS VARCHAR) AS art
  FROM lineitem WHERE l_returnflag <> 'N'),
upd AS (SELECT CAST(p_partkey AS INTEGER) AS ci, CAST(4000000 + p_partkey // 3 AS VARCHAR) AS art FROM part)
SELECT cve, art AS article_id, art AS newer_article_id, ci AS ci_id FROM upd JOIN hits USING (art)
UNION
SELECT cve, u1.art, u2.art, u2.ci
FROM lineitem JOIN upd u1 ON u1.ci = l_partkey JOIN hits h ON h.art = u1.art
LEFT JOIN upd u2 ON u2.ci = l_partkey + 1
WHERE l_linenumber = 6
"""


#: Rows of the sheet for each bucket of its table.
ROWS_OF_BUCKET = 250_000


def _cve_two_databases(spark: SparkSession, sf: str) -> DataFrame:
    """The inventory in one database of the catalog, the sheet in another: as tables by qualified names, and as SQL text."""
    lineitem, run_id = load(spark, sf, "lineitem"), uuid.uuid4().hex
    inventory, sheet, root = f"inventory_{run_id}", f"sheet_{run_id}", shared_dir(spark, "databases")
    frames = {
        f"{inventory}.update_info": load(spark, sf, "part").selectExpr(
            "CAST(p_partkey AS int) AS ci_id", "CAST(4000000 + p_partkey DIV 3 AS string) AS article_id"
        ),
        f"{inventory}.ci_relation": lineitem.selectExpr(
            "CAST(l_partkey + 1 AS int) AS ci_id", "CAST(l_partkey AS int) AS referenced_ci_id", "l_linenumber AS relation_type"
        ),
        f"{sheet}.cve_article": lineitem.selectExpr(
            "CAST(4000000 + l_partkey DIV 3 AS string) AS article", "CASE WHEN l_returnflag <> 'N' THEN concat('CVE-2020-', l_suppkey) END AS cve"
        ),
    }
    for database in (inventory, sheet):
        spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/{database}'")
    try:
        # dealt out by article once, in buckets as many as the rows ask for: what is made distinct and joined by article is so small in
        # every task, in both forms
        buckets = max(8, lineitem.count() // ROWS_OF_BUCKET)
        by = {f"{inventory}.update_info": "article_id", f"{sheet}.cve_article": "article"}
        for name, frame in frames.items():
            if name in by:
                frame = frame.repartition(buckets, by[name])
            writer = frame.write.format("parquet").option("path", f"{root}/files/{name}")
            (writer.bucketBy(buckets, by[name]) if name in by else writer).saveAsTable(name)
        t = catalog_tables(spark, {n.split(".")[1]: n for n in frames})
        first = cve_supersedence(t["update_info"], t["cve_article"], t["ci_relation"])
        names = {"updates": f"{inventory}.update_info", "articles": f"{sheet}.cve_article", "relations": f"{inventory}.ci_relation"}
        second = run(spark, CVE_SUPERSEDENCE, names)
    finally:
        for database in (inventory, sheet):  # the tables' files are elsewhere and stay
            spark.sql(f"DROP DATABASE {database} CASCADE")
    return first.withColumn("form", F.lit("tables")).unionByName(second.withColumn("form", F.lit("text")))


QUERIES["cve_two_databases"] = _cve_two_databases
ORACLES["cve_two_databases"] = f"""
SELECT * FROM ({ORACLES["cve_supersedence"]}) CROSS JOIN (VALUES ('tables'), ('text')) AS f(form)
"""


# -- inventory ------------------------------------------------------------------------


def _installed_software(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    software = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS resource_id",
        "concat('Product ', l_partkey) AS product_name",
        "concat(l_linenumber, '.', CAST(l_quantity AS int), '.0') AS product_version",
        "l_returnflag AS publisher",
        "concat('{', l_partkey, '-', l_suppkey, '}') AS software_code",
        "concat('uninstall ', l_partkey) AS uninstall_string",
        "CASE WHEN l_linestatus = 'F' THEN 'C:/Program Files' END AS installed_location",
        "l_shipdate AS install_date",
        "l_shipdate + INTERVAL 1 DAY AS time_stamp",
    )
    system = orders.selectExpr(
        "o_orderkey AS resource_id",
        "concat('PC', o_orderkey) AS netbios_name",
        "o_orderpriority AS resource_domain",
        "concat('u', o_custkey) AS user_name",
        "nullif(o_orderstatus, 'P') AS user_domain",
    )
    user = load(spark, sf, "customer").selectExpr(
        "concat('u', c_custkey) AS user_name",
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'F' ELSE 'O' END AS nt_domain",
        "c_name AS display_name",
        "c_mktsegment AS department",
    )
    os = orders.selectExpr(
        "o_orderkey AS resource_id",
        "concat('OS ', o_orderpriority) AS caption",
        "o_orderstatus AS version",
        "o_orderdate AS install_date",
        "o_orderdate + INTERVAL 2 DAY AS last_bootup",
    )
    scans = orders.filter("o_orderstatus <> 'F'").selectExpr(
        "o_orderkey AS machine_id",
        "o_orderdate AS last_policy_request",
        "o_orderdate + INTERVAL 5 HOUR AS last_hardware_scan",
    )
    return installed_software(system, user, os, scans, software)


QUERIES["installed_software"] = _installed_software
ORACLES["installed_software"] = """
SELECT 'Product ' || l_partkey AS product_name,
       l_linenumber || '.' || CAST(l_quantity AS INTEGER) || '.0' AS version,
       l_returnflag AS publisher, '{' || l_partkey || '-' || l_suppkey || '}' AS software_code,
       'uninstall ' || l_partkey AS uninstall_string,
       CASE WHEN l_linestatus = 'F' THEN 'C:/Program Files' END AS installed_location,
       l_shipdate AS install_date, l_shipdate + INTERVAL 1 DAY AS time_stamp,
       o_orderkey AS resource_id, 'PC' || o_orderkey AS netbios_name, o_orderpriority AS domain,
       'u' || o_custkey AS user_name, c_name AS full_user_name, c_mktsegment AS department,
       'OS ' || o_orderpriority AS os, o_orderstatus AS os_build, o_orderdate AS os_install_date,
       o_orderdate + INTERVAL 2 DAY AS last_bootup,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS last_policy_request,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderdate + INTERVAL 5 HOUR END AS last_hardware_scan
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN customer ON c_custkey = o_custkey
  AND o_orderstatus = CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'F' ELSE 'O' END
"""


def _devices(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Customers as devices, their orders as adapters, disks and processors."""
    customer, orders = load(spark, sf, "customer"), load(spark, sf, "orders")
    return {
        "system": customer.selectExpr(
            "c_custkey AS resource_id",
            "c_name AS netbios_name",
            "CASE WHEN c_mktsegment <> 'MACHINERY' THEN concat(c_mktsegment, '.NET') END AS full_domain_name",
            "c_mktsegment AS resource_domain",
            "concat('u', c_nationkey) AS user_name",
            "CASE WHEN c_mktsegment <> 'BUILDING' THEN 'D' END AS user_domain",
            "CASE WHEN c_acctbal > 2000 THEN 13 ELSE 5 END AS agent_edition",
            "concat('OS ', c_mktsegment) AS os_name_and_version",
        ),
        "operating_system": customer.selectExpr(
            "c_custkey AS resource_id",
            """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Microsoft Windows Server 2012 R2 Standard'
               WHEN 'BUILDING' THEN 'Red Hat Enterprise Linux Server 7.5 (Maipo)'
               WHEN 'FURNITURE' THEN 'Майкрософт Windows 10 Корпоративная'
               WHEN 'HOUSEHOLD' THEN 'Microsoft Windows 7' ELSE 'Plain' END AS caption""",
            "concat(CASE WHEN c_acctbal > 0 THEN '10.0.' ELSE '6.1.' END, c_nationkey) AS version",
            "concat('B', c_nationkey) AS build_number",
            "TIMESTAMP_NTZ'2020-05-05 00:00:00' AS install_date",
            "TIMESTAMP_NTZ'2020-06-06 00:00:00' AS last_bootup",
            "1033 AS os_language",
            "c_custkey * 1000 AS total_virtual_kb",
            "c_custkey * 900 AS total_visible_kb",
            "CASE WHEN c_nationkey <> 3 THEN c_custkey * 10 END AS total_swap_kb",
        ),
        "network_adapter": orders.selectExpr(
            "o_custkey AS resource_id",
            """CASE o_orderstatus WHEN 'F' THEN concat('10.0.', month(o_orderdate), '.', day(o_orderdate), ',fe80::1')
               WHEN 'O' THEN concat('10.1.', month(o_orderdate), '.', day(o_orderdate)) END AS ip_address""",
            "CASE WHEN o_orderpriority <> '5-LOW' THEN concat('00:', o_orderkey) END AS mac_address",
            "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'Fast Wi-Fi card' ELSE 'Wired' END AS description",
        ),
        "logical_disk": orders.selectExpr(
            "o_custkey AS resource_id",
            "nullif(o_orderpriority, '3-MEDIUM') AS volume_name",
            "CAST(o_totalprice AS decimal(20,4)) AS size_mb",
            "CAST(o_totalprice AS decimal(20,4)) AS free_mb",
        ),
        "disk": orders.selectExpr(
            "o_custkey AS resource_id",
            "month(o_orderdate) AS disk_index",
            "CAST(o_totalprice AS decimal(20,4)) AS size_mb",
        ),
        "processor": orders.selectExpr(
            "o_custkey AS resource_id",
            """CASE o_orderstatus WHEN 'F' THEN 'AMD Opteron' WHEN 'O' THEN concat('Xeon @ 2.', month(o_orderdate), 'GHz rev')
               ELSE 'Generic CPU' END AS name""",
            "month(o_orderdate) AS number_of_cores",
        ),
        "pc_bios": customer.selectExpr(
            "c_custkey AS resource_id", "concat('SN', c_custkey) AS serial_number", "'V1' AS smbios_version"
        ),
        "computer_system": customer.selectExpr(
            "c_custkey AS resource_id", "c_mktsegment AS model", "'Maker' AS manufacturer"
        ),
        "combined_device": customer.filter("c_acctbal > 4000").selectExpr(
            "c_custkey AS machine_id",
            "TIMESTAMP_NTZ'2024-01-01 22:00:00' AS last_policy_request",
            "TIMESTAMP_NTZ'2024-01-02 22:00:00' AS last_hardware_scan",
        ),
    }


def _linux_system_info(spark: SparkSession, sf: str) -> DataFrame:
    d = _devices(spark, sf)
    return linux_system_info(
        d["system"],
        d["operating_system"],
        d["processor"],
        d["pc_bios"],
        d["computer_system"],
        d["combined_device"],
        d["network_adapter"],
        d["logical_disk"],
    )


_CHILD_CELLS = """
nets AS (
  SELECT o_custkey AS dev,
         string_agg(split_part(ip, ',', 1), chr(10) ORDER BY ip, split_part(ip, ',', 1)) AS ips,
         string_agg(mac, chr(10) ORDER BY ip, mac) AS macs
  FROM (SELECT o_custkey,
               CASE o_orderstatus WHEN 'F' THEN '10.0.' || month(o_orderdate) || '.' || day(o_orderdate) || ',fe80::1'
                                  WHEN 'O' THEN '10.1.' || month(o_orderdate) || '.' || day(o_orderdate) END AS ip,
               CASE WHEN o_orderpriority <> '5-LOW' THEN '00:' || o_orderkey END AS mac FROM orders)
  WHERE ip IS NOT NULL GROUP BY 1),
cpus AS (
  SELECT o_custkey AS dev,
         CASE o_orderstatus WHEN 'F' THEN 'AMD'
              WHEN 'O' THEN left('2.' || month(o_orderdate) || 'GHz rev', 7) ELSE 'eneric ' END
         || ' (Cores:' || month(o_orderdate) * count(*) OVER (PARTITION BY o_custkey) || ')' AS cpu
  FROM orders)"""

QUERIES["linux_system_info"] = _linux_system_info
ORACLES["linux_system_info"] = f"""
WITH {_CHILD_CELLS},
sized AS (
  SELECT o_custkey AS dev, nullif(o_orderpriority, '3-MEDIUM') AS vol, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders),
texts AS (
  SELECT dev, vol, '[' || vol || '] ' || ((cents + 102399) // 102400) || 'GB' AS size_text,
         '[' || vol || '] ' || format('{{:,}}', ((cents * 20 + 102400) // 204800) // 10) || '.'
             || ((cents * 20 + 102400) // 204800) % 10 || 'GB' AS free_text
  FROM sized),
disks AS (
  SELECT dev, string_agg(size_text, chr(10) ORDER BY vol, size_text) AS volumes,
         string_agg(free_text, chr(10) ORDER BY vol, free_text) AS free_space
  FROM texts GROUP BY dev)
SELECT DISTINCT c_custkey AS resource_id, c_name AS netbios_name,
       c_name || CASE WHEN c_mktsegment <> 'MACHINERY' THEN '.' || lower(c_mktsegment) || '.net' ELSE '' END AS host_name,
       ips AS ip_addresses, macs AS mac_addresses, volumes, free_space, cpu,
       'SN' || c_custkey AS serial_number, 'V1' AS smbios_version,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Microsoft Windows Server 2012 R2 Standard'
            WHEN 'BUILDING' THEN 'Red Hat Enterprise Linux Server 7.5 (Maipo)'
            WHEN 'FURNITURE' THEN 'Майкрософт Windows 10 Корпоративная'
            WHEN 'HOUSEHOLD' THEN 'Microsoft Windows 7' ELSE 'Plain' END AS os,
       'B' || c_nationkey AS os_build,
       'Virtual: ' || (c_custkey * 1000 + 1023) // 1024 || 'GB' || chr(10) || 'Visible: '
         || (c_custkey * 900 + 1023) // 1024 || 'GB' || chr(10) || 'SWAP: '
         || CASE WHEN c_nationkey <> 3 THEN (c_custkey * 10 + 1023) // 1024 END || 'GB' AS memory,
       TIMESTAMP '2020-06-06 00:00:00' AS last_bootup, c_mktsegment AS model, 'Maker' AS manufacturer,
       CASE WHEN c_acctbal > 4000 THEN TIMESTAMP '2024-01-02 01:00:00' END AS last_policy_request,
       CASE WHEN c_acctbal > 4000 THEN TIMESTAMP '2024-01-03 01:00:00' END AS last_hardware_scan
FROM customer LEFT JOIN nets n ON n.dev = c_custkey LEFT JOIN cpus p ON p.dev = c_custkey
LEFT JOIN disks d ON d.dev = c_custkey
WHERE c_acctbal > 2000
"""


def _system_info(spark: SparkSession, sf: str) -> DataFrame:
    d = _devices(spark, sf)
    customer, nation = load(spark, sf, "customer"), load(spark, sf, "nation")
    servicing_state = nation.selectExpr(
        "concat('10.0.', n_nationkey) AS build",
        "CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END AS branch",
        "n_name AS name",
    )
    servicing_name = nation.selectExpr(
        "n_name AS name",
        "CASE WHEN n_regionkey = 1 THEN 1049 ELSE 1033 END AS locale_id",
        "CASE WHEN n_regionkey <> 3 THEN concat('19H', n_nationkey) END AS value",
    )
    memory = customer.selectExpr("c_custkey AS resource_id", "c_custkey * 1000000 AS total_physical_kb")
    system_type = customer.filter("c_acctbal > 1000").selectExpr(
        "c_custkey AS resource_id",
        "CASE WHEN c_nationkey < 12 THEN 'X64-based PC' ELSE 'X86-based PC' END AS system_type",
    )
    return system_info(
        d["system"],
        d["operating_system"],
        servicing_state,
        servicing_name,
        d["processor"],
        memory,
        d["pc_bios"],
        system_type,
        d["network_adapter"],
        d["disk"],
    )


QUERIES["system_info"] = _system_info
ORACLES["system_info"] = f"""
WITH {_CHILD_CELLS},
wifi AS (SELECT DISTINCT o_custkey AS dev FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
disks AS (
  SELECT o_custkey AS dev, string_agg(t, chr(10) ORDER BY i, t) AS disks
  FROM (SELECT o_custkey, month(o_orderdate) AS i,
               (CAST(round(o_totalprice * 100) AS BIGINT) + 102399) // 102400 || 'GB' AS t FROM orders)
  GROUP BY 1),
sys AS (
  SELECT *, CASE WHEN c_acctbal > 0 AND n_regionkey <> 0 THEN
                 CASE WHEN n_regionkey IN (2, 4) THEN ' (19H' || n_nationkey || ')' END ELSE '' END AS svc,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Windows Server 2012 R2' WHEN 'BUILDING' THEN 'RHEL 7.5'
              WHEN 'FURNITURE' THEN 'Windows 10' WHEN 'HOUSEHOLD' THEN 'Windows 7' ELSE 'Windows ' END AS family,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Windows Server 2012 R2 Standard'
              WHEN 'BUILDING' THEN 'Red Hat Enterprise Linux Server 7.5 (Maipo)'
              WHEN 'FURNITURE' THEN 'Windows 10 Корпоративная' WHEN 'HOUSEHOLD' THEN 'Windows 7' ELSE 'Plain' END AS plain
  FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey AS resource_id, c_name AS netbios_name,
       c_name || CASE WHEN c_mktsegment <> 'MACHINERY' THEN '.' || lower(c_mktsegment) || '.net' ELSE '' END AS host_name,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) || '.net' END AS domain,
       c_mktsegment AS resource_domain,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN 'D' || chr(92) || 'u' || c_nationkey END AS primary_user,
       ips AS ip_addresses, macs AS mac_addresses, disks,
       CASE WHEN w.dev IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_wifi, cpu,
       (c_custkey * 1000000 + 1048575) // 1048576 || 'GB' AS memory, 'SN' || c_custkey AS serial_number,
       family || svc AS os,
       plain || svc || ' ' || CASE WHEN c_acctbal > 1000 AND c_nationkey < 12 THEN 'x64' ELSE 'x86' END AS os_version,
       'OS ' || c_mktsegment AS os_name_and_version,
       CASE WHEN c_acctbal > 0 THEN '10.0.' ELSE '6.1.' END || c_nationkey AS version,
       1033 AS os_language, TIMESTAMP '2020-05-05 00:00:00' AS install_date,
       TIMESTAMP '2020-06-06 00:00:00' AS last_bootup
FROM sys LEFT JOIN cpus p ON p.dev = c_custkey LEFT JOIN nets n ON n.dev = c_custkey
LEFT JOIN disks d ON d.dev = c_custkey LEFT JOIN wifi w ON w.dev = c_custkey
"""


# -- audit and counters -----------------------------------------------------------------


def _security_audit(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").selectExpr(
        "CASE event_type WHEN 'click' THEN 4740 WHEN 'error' THEN 4768 WHEN 'purchase' THEN 4769 "
        "WHEN 'signup' THEN 4771 ELSE 4624 END AS event_id",
        "ts AS creation_time",
        "concat('user', user_id, CASE WHEN value > 50 THEN '@corp.net' ELSE '' END) AS target_user",
        "concat('T', event_type) AS target_domain",
        "concat('P', event_type) AS primary_domain",
        "concat('S-1-', user_id) AS target_sid",
        "event_type AS category",
        "concat('DC', user_id) AS event_machine",
        *[f"concat('s{i}/', event_id) AS string0{i}" for i in range(1, 9)],
    )
    return security_audit(events, [4740, 4768, 4769, 4771], "ser", "s1")


QUERIES["security_audit"] = _security_audit
ORACLES["security_audit"] = """
SELECT CASE event_type WHEN 'click' THEN 4740 WHEN 'error' THEN 4768 WHEN 'purchase' THEN 4769 ELSE 4771 END AS event_id,
       ts AS event_time, 'user' || user_id AS target_user,
       CASE WHEN event_type = 'click' THEN 'p' ELSE 't' END || event_type AS target_domain,
       CASE WHEN event_type = 'click' THEN 's2/' ELSE 's1/' END || event_id AS service_name,
       CASE event_type WHEN 'click' THEN 'na' WHEN 'error' THEN 's7/' || event_id ELSE 's5/' || event_id END AS client_address,
       CASE WHEN event_type = 'error' THEN 's8/' ELSE 's6/' END || event_id AS client_port,
       'S-1-' || user_id AS target_sid,
       CASE WHEN event_type = 'click' THEN 'na' ELSE 's2/' || event_id END AS service_sid,
       's4/' || event_id AS ticket_encryption, 's3/' || event_id AS ticket_options,
       event_type AS category, 'DC' || user_id AS event_machine
FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup')
"""

# counter of each rule number, for the rules beyond the list a counter nobody asks for
_COUNTERS = [
    ("Memory", "PercentMemoryUsed", "m0"),
    ("Memory", "Free Memory %", "m1"),
    ("Processor", "% Processor Time", "_Total"),
    ("LogicalDisk", "% Free Space", "C:"),
    ("LogicalDisk", "% Free Space", "D:"),
    ("Appliance", "Disk - /var Used (%)", "/var"),
    ("Network Adapter", "Bytes Total/sec", "nic-a"),
    ("Network Adapter", "Bytes Total/sec", "nic-b"),
    ("Interface", "Interface Received Bytes Rate", "if/1/1"),
    ("Interface", "Interface Transmitted Bytes Rate", "if/LO/1"),
    ("Interface", "Interface Transmitted Bytes Rate", "if/0/1"),
    ("Disk", "Current Disk Queue Length", "_Total"),
    ("Process", "Handle Count", "_Total"),
]
_N = len(_COUNTERS)


def _case(column: str, position: int) -> str:
    arms = " ".join(f"WHEN {i} THEN '{c[position]}'" for i, c in enumerate(_COUNTERS))
    return f"CASE {column} {arms} END"


def _performance_history(spark: SparkSession, sf: str) -> DataFrame:
    nation = load(spark, sf, "nation")
    rule = nation.selectExpr(
        "n_nationkey AS rule_row_id",
        f"coalesce({_case('n_nationkey', 0)}, 'None') AS object_name",
        f"coalesce({_case('n_nationkey', 1)}, 'None') AS counter_name",
    )
    instance = nation.selectExpr(
        "n_nationkey AS rule_row_id",
        "n_nationkey + 100 AS performance_rule_instance_row_id",
        f"coalesce({_case('n_nationkey', 2)}, 'None') AS instance_name",
    )
    hourly = load(spark, sf, "events").selectExpr(
        "CAST(CAST(ts AS date) AS timestamp_ntz) AS date_time",
        f"CAST(100 + event_id % {_N} AS int) AS performance_rule_instance_row_id",
        "user_id AS managed_entity_row_id",
        "CAST(event_id % 97 AS double) AS average_value",
        "CAST(event_id % 89 AS double) AS min_value",
        "CAST(event_id % 83 AS double) AS max_value",
    )
    entity = load(spark, sf, "customer").selectExpr(
        "c_custkey AS managed_entity_row_id",
        "c_custkey - c_custkey % 10 AS top_level_host_row_id",
        "concat(CASE WHEN c_nationkey < 12 THEN 'W' ELSE 'S' END, c_custkey, "
        "CASE WHEN c_acctbal > 2000 THEN '.corp.net' ELSE '' END) AS name",
        """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Microsoft.Windows.Computer' WHEN 'BUILDING' THEN 'Maker.Router.Class'
           WHEN 'FURNITURE' THEN 'Maker.Router' ELSE 'Thing' END AS full_name""",
    )
    base = counter_base(rule, instance, hourly, entity, "2024-01-31 00:00:00")
    # dealt out once, by the key of all its slices
    return performance_history(bucketed_copy(base, "counters", SLICE, int(spark.conf.get("spark.sql.shuffle.partitions"))))


QUERIES["performance_history"] = _performance_history
ORACLES["performance_history"] = f"""
WITH host AS (
  SELECT c_custkey AS id,
         CASE WHEN c_nationkey < 12 THEN 'W' ELSE 'S' END || c_custkey
           || CASE WHEN c_acctbal > 2000 THEN '.corp.net' ELSE '' END AS name,
         CASE WHEN c_acctbal > 2000 THEN 'corp.net' ELSE 'None' END AS domain,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_nationkey < 12 THEN 'Windows WKS'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Windows Server' WHEN c_mktsegment = 'BUILDING' THEN 'Router'
              WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE 'Unknown' END AS device
  FROM customer),
base AS (
  SELECT date_trunc('day', ts) + INTERVAL 3 HOUR AS t, h.name, domain, device,
         event_id % {_N} AS k, CAST(event_id % 97 AS DOUBLE) AS av, CAST(event_id % 89 AS DOUBLE) AS lo,
         CAST(event_id % 83 AS DOUBLE) AS hi
  FROM events JOIN customer ON c_custkey = user_id JOIN host h ON h.id = c_custkey - c_custkey % 10
  WHERE date_trunc('day', ts) > TIMESTAMP '2024-01-01 00:00:00' AND event_id % {_N} <> 12),
mem AS (SELECT t, name, CASE k WHEN 1 THEN 100 - av ELSE av END AS memory_average,
               CASE k WHEN 1 THEN 100 - lo ELSE hi END AS memory_max,
               CASE k WHEN 1 THEN 100 - hi ELSE lo END AS memory_min FROM base WHERE k IN (0, 1)),
oth AS (
  SELECT t, name,
         CASE WHEN k IN (3, 4) THEN 100 - lo WHEN k IN (5, 11) THEN hi ELSE lo * 8 / 1048576 END AS other_max,
         CASE WHEN k IN (3, 4) THEN 100 - hi WHEN k IN (5, 11) THEN lo ELSE lo * 8 / 1048576 END AS other_min,
         CASE WHEN k IN (3, 4) THEN 100 - av WHEN k IN (5, 11) THEN av ELSE lo * 8 / 1048576 END AS other_average,
         {_case('k', 0)} AS other_object,
         CASE WHEN k IN (3, 4, 5) THEN '% Used Space' WHEN k = 11 THEN 'Current Disk Queue Length' ELSE 'Mbit/sec' END AS other_counter,
         CASE k WHEN 8 THEN 'Data Interface (Received)' WHEN 10 THEN 'Management Interface (Transmitted)'
                ELSE {_case('k', 2)} END AS other_instance
  FROM base WHERE k IN (3, 4, 5, 6, 7, 8, 10, 11)),
dsk AS (SELECT t, name, CASE k WHEN 5 THEN hi ELSE 100 - lo END AS system_disk_max FROM base WHERE k IN (3, 5)),
net AS (
  SELECT t, name, av, hi
  FROM (SELECT *, min(k) OVER (PARTITION BY name) AS first_k FROM base WHERE k IN (6, 7)) WHERE k = first_k
  UNION ALL
  SELECT t, name, sum(av), sum(hi) FROM base WHERE k = 8 GROUP BY t, name)
SELECT DISTINCT b.t AS date_time, date_trunc('day', b.t) AS date_day, b.name AS netbios_name, b.domain, b.device,
       memory_average, memory_max, memory_min, c.av AS cpu_average, c.hi AS cpu_max, c.lo AS cpu_min,
       other_max, other_min, other_average, other_object, other_counter, other_instance,
       system_disk_max, n.av * 8 / 1048576 AS network_average, n.hi * 8 / 1048576 AS network_max
FROM (SELECT DISTINCT t, name, domain, device FROM base) b
LEFT JOIN mem m ON m.t = b.t AND m.name = b.name
LEFT JOIN base c ON c.t = b.t AND c.name = b.name AND c.k = 2
LEFT JOIN oth o ON o.t = b.t AND o.name = b.name
LEFT JOIN dsk d ON d.t = b.t AND d.name = b.name
LEFT JOIN net n ON n.t = b.t AND n.name = b.name
"""
