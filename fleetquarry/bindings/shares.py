"""Shared folders on the test tables: events, permissions, digests, message parsing."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.bindings.common import load
from fleetquarry.functions.times import parse_mixed
from fleetquarry.operators.dictionaries import with_readable_sd
from fleetquarry.operators.differences import ENTRY_LISTS, array_changes, combined_permissions
from fleetquarry.operators.rollups import with_default_rows
from fleetquarry.operators.snapshots import PERMISSION_KEYS, SHARE_KEYS, merge_events, reconcile_changes
from fleetquarry.plans.parameterised import SHARE_EVENT_SEARCH, run
from fleetquarry.plans.shares import (
    current_permissions,
    permission_entries,
    share_change_digest,
    share_event_digest,
    share_events_search,
    share_permissions_latest,
)
from fleetquarry.session import shared_dir
from fleetquarry.sources import buckets, periods
from fleetquarry.sources.buckets import BucketStore
from fleetquarry.sources.messages import parse_share_events, readable_sd, share_aces
from fleetquarry.sources.periods import PeriodStore
from fleetquarry.sources.tables import SCHEMAS

QUERIES, ORACLES = {}, {}

_B = "\\\\"  # one backslash in Spark SQL text

# -- events -------------------------------------------------------------------------------

_MESSAGE = """CASE event_type WHEN 'click' THEN 'A network share object was modified. '
  WHEN 'error' THEN 'Объект сетевой папки удален. ' WHEN 'purchase' THEN 'A network share object was added.'
  WHEN 'signup' THEN 'Объект сетевой папки изменен.' ELSE 'Something else' END"""


def _system(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").selectExpr(
        "c_custkey AS resource_id",
        "c_name AS netbios_name",
        "CASE WHEN c_nationkey <> 4 THEN concat(c_mktsegment, '.NET') END AS full_domain_name",
        "c_mktsegment AS resource_domain",
        "CASE WHEN c_nationkey < 9 THEN 'Windows Server' ELSE 'Windows 10' END AS os_name_and_version",
    )


def _share_events(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").selectExpr(
        "user_id AS resource_id",
        "event_id AS index",
        "CASE event_type WHEN 'click' THEN 5143 WHEN 'error' THEN 5144 ELSE 5142 END AS instance_id",
        """CASE WHEN event_type = 'view' THEN 'no time' WHEN event_type = 'click' THEN date_format(ts, 'MM/dd/yyyy HH:mm:ss')
           WHEN event_type = 'error' THEN date_format(ts, 'M/d/yyyy h:mm:ss a')
           ELSE date_format(ts, 'dd.MM.yyyy HH:mm:ss') END AS time_generated""",
        f"{_MESSAGE} AS message",
        "concat('acc', user_id) AS account_name",
        "CASE WHEN user_id % 7 <> 0 THEN 'DOM' END AS account_domain",
        f"concat('{_B}{_B}*{_B}SHARE', user_id % 25) AS share_name",
        "concat('C:/', event_id) AS share_path",
        "concat('old', event_id) AS old_sd",
        "concat('new', event_id) AS new_sd",
    )


def _share(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").selectExpr(
        "c_custkey AS resource_id",
        "concat('SHARE', c_nationkey) AS name",
        "concat('about ', c_nationkey) AS description",
        "concat('D:/', c_nationkey) AS path",
    )


def _share_events_search(spark: SparkSession, sf: str) -> DataFrame:
    return share_events_search(
        _share_events(spark, sf),
        _system(spark, sf),
        _share(spark, sf),
        domains=["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"],
        event_types=["Изменение", "Удаление", "Создание"],
        computer="%.net",
        folder="ARE",
    )


QUERIES["share_events_search"] = _share_events_search
ORACLES["share_events_search"] = """
SELECT user_id AS resource_id, c_name || '.' || lower(c_mktsegment) || '.net' AS computer_name,
       CASE WHEN c_nationkey < 9 THEN 'Windows Server' ELSE 'Windows 10' END AS os_name_and_version,
       c_mktsegment AS domain, CASE WHEN user_id % 7 <> 0 THEN 'DOM' || chr(92) || 'acc' || user_id END AS changed_by,
       CASE event_type WHEN 'click' THEN 5143 WHEN 'error' THEN 5144 ELSE 5142 END AS instance_id,
       CASE event_type WHEN 'error' THEN 'Удаление' WHEN 'purchase' THEN 'Создание' ELSE 'Изменение' END AS event_type,
       'new' || event_id AS new_sd, 'old' || event_id AS old_sd, 'SHARE' || user_id % 25 AS shared_folder,
       CASE WHEN c_nationkey = user_id % 25 THEN 'about ' || c_nationkey END AS remark, 'C:/' || event_id AS share_path,
       date_trunc('second', ts) AS event_time
FROM events JOIN customer ON c_custkey = user_id
WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey <> 4 AND event_type <> 'view'
"""


def _share_events_of_day(spark: SparkSession, sf: str) -> DataFrame:
    return share_events_search(
        _share_events(spark, sf),
        _system(spark, sf),
        _share(spark, sf),
        domains=["AUTOMOBILE", "MACHINERY"],
        event_types=["Изменение", "Something else"],
        day="2024-01-15 00:00:00",
    ).select("resource_id", "share_path", "event_time", "event_type")


QUERIES["share_events_of_day"] = _share_events_of_day
ORACLES["share_events_of_day"] = """
SELECT user_id AS resource_id, 'C:/' || event_id AS share_path, date_trunc('second', ts) AS event_time, 'Изменение' AS event_type
FROM events JOIN customer ON c_custkey = user_id
WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AND c_nationkey <> 4 AND event_type IN ('click', 'signup')
  AND date_trunc('second', ts) > TIMESTAMP '2024-01-15 00:00:00' AND date_trunc('second', ts) < TIMESTAMP '2024-01-16 00:00:00'
"""


def _share_event_digest(spark: SparkSession, sf: str) -> DataFrame:
    return share_event_digest(_share_events(spark, sf), _system(spark, sf), "2024-01-30 12:00:00")


QUERIES["share_event_digest"] = _share_event_digest
ORACLES["share_event_digest"] = """
WITH e AS (
  SELECT *, date_trunc('second', ts) AS t, 'SHARE' || user_id % 25 AS share,
         CASE WHEN user_id % 7 <> 0 THEN 'DOM' || chr(92) || 'acc' || user_id END AS who,
         CASE WHEN c_nationkey <> 4 THEN c_name || '.' || lower(c_mktsegment) || '.net' END AS full_name,
         CASE event_type WHEN 'error' THEN 'Delete' WHEN 'purchase' THEN 'Add' ELSE 'Modify' END AS kind
  FROM events JOIN customer ON c_custkey = user_id WHERE event_type <> 'view')
SELECT chr(92) || chr(92) || full_name || chr(92) || share AS shared_folder_path, coalesce(full_name, c_name) AS computer_name,
       share AS share_name, who AS changed_by, t AS event_time, strftime(t, '%d.%m.%Y %H:%M:%S') AS event_time_text,
       kind AS event_type,
       '<tr><td class="tg-0pky">' || kind || '</td><td class="tg-0pky">' || strftime(t, '%d.%m.%Y %H:%M:%S')
         || '</td><td class="tg-0pky">' || coalesce(who, '') || '</td><td class="tg-0pky">' || coalesce(full_name, c_name)
         || '</td><td class="tg-0pky">' || share || '</td></tr>' AS html
FROM e WHERE t > TIMESTAMP '2024-01-29 12:00:00'
"""


def _raw_messages(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Messages as the event log writes them, lines ending in carriage return and line feed."""
    tab = "\\t\\t"
    common = (
        f"'Security ID:{tab}', CASE WHEN user_id % 11 = 0 THEN 'S-1-5-18' ELSE concat('S-1-', user_id) END, '\\r\\n', "
        f"'Account Name:{tab}acc', user_id, '\\r\\nAccount Domain:{tab}DOM\\r\\nLogon ID:{tab}0x', event_id, '\\r\\n\\r\\nShare Information:\\r\\n'"
    )
    share = (
        f"'Share Name:{tab}{_B}{_B}*{_B}', CASE WHEN user_id % 13 = 0 THEN 'sms_dp$' ELSE concat('S', user_id) END, '\\r\\n'"
    )
    return load(spark, sf, "events").selectExpr(
        *extra,
        "user_id AS resource_id",
        "event_id AS index",
        "CASE event_type WHEN 'click' THEN 5143 WHEN 'view' THEN 4663 WHEN 'error' THEN 5144 ELSE 5142 END AS instance_id",
        f"""CASE WHEN event_type = 'click' THEN
              concat('A network share object was modified.\\r\\n\\r\\nSubject:\\r\\n', {common}, 'Object Type:{tab}File\\r\\n', {share},
                     'Share Path:{tab}C:/a: b\\r\\nOld Remark:{tab}\\r\\nNew Remark:{tab}r', event_id, '\\r\\nOld MaxUsers:{tab}1\\r\\n',
                     'New Maxusers:{tab}2\\r\\nOld ShareFlags:{tab}0x0\\r\\nNew ShareFlags:{tab}0x1\\r\\nOld SD:{tab}O:BAD:(A;;FA;;;BA)(D;;0x1;;;',
                     user_id, ')\\r\\nNew SD:{tab}none')
            ELSE concat('A network share object was added.\\r\\n\\r\\nSubject:\\r\\n', {common}, {share}, 'Share Path:{tab}D:/x ') END AS message""",
    )


def _message_fields(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw_messages(spark, sf)
    names = {"sid": {"BA": "Administrators"}, "type": {"A": "Allow", "D": "Deny"}, "rights": {"FA": "Full"}}
    return parse_share_events(raw, names)


QUERIES["message_fields"] = _message_fields
ORACLES["message_fields"] = """
SELECT user_id AS resource_id, event_id AS index,
       CASE event_type WHEN 'click' THEN 5143 WHEN 'error' THEN 5144 ELSE 5142 END AS instance_id,
       CASE event_type WHEN 'click' THEN 'A network share object was modified.' ELSE 'A network share object was added.' END AS message,
       'S-1-' || user_id AS security_id, 'acc' || user_id AS account_name, 'DOM' AS account_domain, '0x' || event_id AS logon_id,
       CASE WHEN m THEN 'File' END AS object_type, chr(92) || chr(92) || '*' || chr(92) || 'S' || user_id AS share_name,
       CASE WHEN m THEN 'C:/a: b' ELSE 'D:/x' END AS share_path, CASE WHEN m THEN '' END AS old_remark,
       CASE WHEN m THEN 'r' || event_id END AS new_remark, CASE WHEN m THEN '1' END AS old_max_users,
       CASE WHEN m THEN '2' END AS new_max_users, CASE WHEN m THEN '0x0' END AS old_share_flags,
       CASE WHEN m THEN '0x1' END AS new_share_flags,
       CASE WHEN m THEN 'Administrators: Allow (Full) | ' || user_id || ': Deny (0x1)' END AS old_sd,
       CASE WHEN m THEN 'none' END AS new_sd
FROM (SELECT *, event_type = 'click' AS m FROM events)
WHERE event_type <> 'view' AND user_id % 11 <> 0 AND user_id % 13 <> 0
"""


_MIXED_TIME = """CASE event_type WHEN 'click' THEN date_format(ts, 'MM/dd/yyyy HH:mm:ss')
  ELSE date_format(ts, 'dd.MM.yyyy HH:mm:ss') END AS time_generated"""


def _share_event_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """From raw messages to the search: parse, merge two batches into the store, search it."""
    parsed = parse_share_events(_raw_messages(spark, sf, _MIXED_TIME))
    # two batches that overlap and together hold every event
    store = merge_events(parsed.limit(0), parsed.filter("index % 3 < 2"), "2024-07-05 00:00:00")
    store = merge_events(store, parsed.filter("index % 3 > 0"), "2024-07-05 00:00:00")
    return share_events_search(
        store, _system(spark, sf), _share(spark, sf), domains=["automobile", "Building "],
        event_types=["изменение", "СОЗДАНИЕ"], computer="%.NET", folder="s", case_insensitive=True,
    )


QUERIES["share_event_pipeline"] = _share_event_pipeline
ORACLES["share_event_pipeline"] = """
SELECT user_id AS resource_id, c_name || '.' || lower(c_mktsegment) || '.net' AS computer_name,
       CASE WHEN c_nationkey < 9 THEN 'Windows Server' ELSE 'Windows 10' END AS os_name_and_version,
       c_mktsegment AS domain, 'DOM' || chr(92) || 'acc' || user_id AS changed_by,
       CASE event_type WHEN 'click' THEN 5143 WHEN 'error' THEN 5144 ELSE 5142 END AS instance_id,
       CASE event_type WHEN 'click' THEN 'Изменение' ELSE 'Создание' END AS event_type,
       CASE WHEN event_type = 'click' THEN 'none' END AS new_sd,
       CASE WHEN event_type = 'click' THEN 'O:BAD:(A;;FA;;;BA)(D;;0x1;;;' || user_id || ')' END AS old_sd,
       'S' || user_id AS shared_folder, CASE WHEN 'S' || user_id = 'SHARE' || c_nationkey THEN 'about ' || c_nationkey END AS remark,
       CASE WHEN event_type = 'click' THEN 'C:/a: b' ELSE 'D:/x' END AS share_path, date_trunc('second', ts) AS event_time
FROM events JOIN customer ON c_custkey = user_id
WHERE event_type <> 'view' AND user_id % 11 <> 0 AND user_id % 13 <> 0 AND c_nationkey <> 4
  AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
  AND (event_id % 3 > 0 OR date_trunc('second', ts) > TIMESTAMP '2024-07-05 00:00:00' - INTERVAL 180 DAY)
"""


def _readable_sd(spark: SparkSession, sf: str) -> DataFrame:
    names = {"sid": {"WD": "Everyone"}, "type": {"A": "Allow"}, "rights": {"FR": "Read"}}
    return load(spark, sf, "supplier").select(
        "s_suppkey",
        readable_sd(
            F.expr(
                "CASE WHEN s_nationkey < 5 THEN 'not a descriptor' WHEN s_nationkey < 15 THEN "
                "concat('O:BAG:SYD:(A;;FR;;;WD)(A;OICI;0x', s_suppkey, ';;;S-1-5-', s_nationkey, ')S:(AU;;FR;;;WD)') "
                "ELSE 'D:(A;;FR)' END"
            ),
            names,
        ).alias("sd"),
    )


QUERIES["readable_sd"] = _readable_sd
ORACLES["readable_sd"] = """
SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN 'not a descriptor' WHEN s_nationkey < 15 THEN
       'Everyone: Allow (Read) | S-1-5-' || s_nationkey || ': Allow (0x' || s_suppkey || ')' ELSE 'D:(A;;FR)' END AS sd
FROM supplier
"""

def _readable_sd_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """As readable_sd, the names of principals, types and rights from a table."""
    texts = load(spark, sf, "supplier").select("s_suppkey", F.expr(
        "CASE WHEN s_nationkey < 5 THEN 'not a descriptor' WHEN s_nationkey < 15 THEN "
        "concat('O:BAG:SYD:(A;;FR;;;WD)(A;OICI;0x', s_suppkey, ';;;S-1-5-', s_nationkey, ')S:(AU;;FR;;;WD)') ELSE 'D:(A;;FR)' END"
    ).alias("sddl"))
    nation = load(spark, sf, "nation").selectExpr("'sid' AS kind", "concat('S-1-5-', n_nationkey) AS code", "n_name AS name")
    fixed = spark.createDataFrame([("sid", "WD", "Everyone"), ("type", "A", "Allow"), ("rights", "FR", "Read")], "kind string, code string, name string")
    return with_readable_sd(texts, "sddl", nation.unionByName(fixed), "sd").drop("sddl")


QUERIES["readable_sd_by_table"] = _readable_sd_by_table
ORACLES["readable_sd_by_table"] = """
SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN 'not a descriptor' WHEN s_nationkey < 15 THEN
       'Everyone: Allow (Read) | ' || n_name || ': Allow (0x' || s_suppkey || ')' ELSE 'D:(A;;FR)' END AS sd
FROM supplier JOIN nation ON n_nationkey = s_nationkey
"""

# -- permissions --------------------------------------------------------------------------

# an order is one scan of its customer's machine, its lines are the entries found
_SCAN_TEXT = """CASE o_orderstatus WHEN 'F' THEN date_format(o_orderdate, 'yy.MM.dd HH:mm')
  WHEN 'O' THEN date_format(o_orderdate, 'dd.MM.yyyy HH:mm') ELSE date_format(o_orderdate, 'MM/dd/yyyy HH:mm:ss') END"""


def _permissions(spark: SparkSession, sf: str) -> DataFrame:
    scans = load(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey AS resource_id", f"{_SCAN_TEXT} AS time_added", "o_orderpriority"
    )
    entries = load(spark, sf, "lineitem").join(scans, F.col("l_orderkey") == F.col("o_orderkey"))
    return entries.selectExpr(
        "resource_id",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'No Shared Folders' ELSE concat('F', l_linenumber % 3) END AS shared_folder_name",
        "time_added",
        "CASE l_returnflag WHEN 'A' THEN 'NTFSPermission' WHEN 'N' THEN 'SharedPermission' ELSE 'Odd' END AS permission_type",
        f"CASE WHEN l_linenumber = 1 THEN 'Все' WHEN l_linenumber = 2 THEN 'BUILTIN{_B}Пользователи' ELSE concat('u', l_suppkey) END AS security_principal",
        "concat('R', CAST(l_quantity AS int)) AS file_system_rights",
        "CASE WHEN l_linestatus = 'F' THEN 'AccessAllowed' ELSE 'AccessDenied' END AS access_control_type",
        "'Inherited' AS access_control_flags",
        "concat('owner', l_partkey) AS owner",
    )


_ENTRY_SQL = """
entry AS (
  SELECT o_custkey AS dev, o_orderdate AS seen, o_orderpriority = '5-LOW' AS empty, l_returnflag AS rf, l_linestatus AS ls,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'No Shared Folders' ELSE 'F' || l_linenumber % 3 END AS folder,
         CASE WHEN l_linenumber = 1 THEN 'Everyone' WHEN l_linenumber = 2 THEN 'BUILTIN' || chr(92) || 'Users' ELSE 'u' || l_suppkey END AS who,
         'R' || CAST(l_quantity AS INTEGER) AS rights, 'owner' || l_partkey AS owner,
         max(o_orderdate) OVER (PARTITION BY o_custkey) AS last_seen
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


def _share_permissions_latest(spark: SparkSession, sf: str) -> DataFrame:
    return share_permissions_latest(
        _permissions(spark, sf),
        _system(spark, sf),
        _share(spark, sf).selectExpr("resource_id", "concat('F', length(name) % 3) AS name", "description", "path"),
        domains=["AUTOMOBILE", "BUILDING", "MACHINERY"],
        permission_type="%S%",
        security_principal="%e%",
        folder="F",
    )


QUERIES["share_permissions_latest"] = _share_permissions_latest
ORACLES["share_permissions_latest"] = f"""
WITH {_ENTRY_SQL}
SELECT dev AS resource_id,
       c_name || CASE WHEN c_nationkey <> 4 THEN '.' || lower(c_mktsegment) || '.net' ELSE '' END AS computer_name,
       CASE WHEN c_nationkey < 9 THEN 'Windows Server' ELSE 'Windows 10' END AS os_name_and_version,
       CASE WHEN c_nationkey < 9 THEN 'Сервер' ELSE 'Рабочая станция' END AS device_kind,
       c_mktsegment AS domain, folder AS shared_folder,
       CASE WHEN folder = 'F' || length('SHARE' || c_nationkey) % 3 THEN 'about ' || c_nationkey END AS remark,
       CASE WHEN folder = 'F' || length('SHARE' || c_nationkey) % 3 THEN 'D:/' || c_nationkey END AS path,
       owner, CASE rf WHEN 'A' THEN 'NTFS' ELSE 'Shared' END AS permission_type, who AS security_principal,
       CASE WHEN ls = 'F' THEN 'Allowed' ELSE 'Denied' END AS access, rights, 'Inherited' AS access_control_flags,
       seen AS check_time
FROM entry JOIN customer ON c_custkey = dev
WHERE seen = last_seen AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') AND rf IN ('A', 'N')
  AND who LIKE '%e%' AND folder LIKE '%F%'
"""


def _current_permissions(spark: SparkSession, sf: str) -> DataFrame:
    return current_permissions(_permissions(spark, sf))


_COMBINED = """
'[Shared]' || coalesce(string_agg(CASE WHEN rf = 'N' THEN '(' || who || ': ' || rights || CASE WHEN ls <> 'F' THEN ' DENY' ELSE '' END || ')' END,
              '' ORDER BY who, rights, ls DESC), '(UNKNOWN)')
  || '[NTFS]' || coalesce(string_agg(CASE WHEN rf = 'A' THEN '(' || who || ': ' || rights || CASE WHEN ls <> 'F' THEN ' DENY' ELSE '' END || ')' END,
              '' ORDER BY who, rights, ls DESC), '(UNKNOWN)')"""
# access types sort as AccessAllowed < AccessDenied, line status as F < O
_COMBINED = _COMBINED.replace("ls DESC", "ls")
QUERIES["current_permissions"] = _current_permissions
ORACLES["current_permissions"] = f"""
WITH {_ENTRY_SQL}
SELECT dev AS resource_id, folder AS shared_folder_name, {_COMBINED} AS permissions
FROM entry WHERE seen = last_seen AND NOT empty GROUP BY ALL
"""


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "CASE l_returnflag WHEN 'A' THEN 'NTFSPermission' WHEN 'N' THEN 'SharedPermission' ELSE 'Odd' END AS permission_type",
        "concat('u', l_suppkey) AS security_principal",
        "concat('R', CAST(l_quantity AS int)) AS file_system_rights",
        "CASE WHEN l_linestatus = 'F' THEN 'AccessAllowed' ELSE 'AccessDenied' END AS access_control_type",
    )


def _categorised_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return combined_permissions(_entries(spark, sf), ["l_orderkey"])


QUERIES["categorised_rollup"] = _categorised_rollup
ORACLES["categorised_rollup"] = f"""
SELECT l_orderkey, {_COMBINED} AS permissions
FROM (SELECT l_orderkey, l_returnflag AS rf, l_linestatus AS ls, 'u' || l_suppkey AS who,
             'R' || CAST(l_quantity AS INTEGER) AS rights FROM lineitem)
GROUP BY l_orderkey
"""


def _share_change_digest(spark: SparkSession, sf: str) -> DataFrame:
    approval = load(spark, sf, "orders").selectExpr(
        "o_custkey AS resource_id",
        f"CASE WHEN o_orderpriority = '1-URGENT' THEN concat('{_B}{_B}srv{_B}F', o_orderkey) ELSE concat('F', o_orderkey) END AS shared_folder_name",
        "CASE o_orderstatus WHEN 'F' THEN 'New' WHEN 'O' THEN 'Modified' ELSE 'Approved' END AS check_status",
        "o_orderdate AS check_status_time",
        "'Script' AS changed_by",
        """CASE WHEN o_orderstatus = 'F' THEN 'None' WHEN o_orderpriority = '5-LOW' THEN NULL
           ELSE concat('[Shared](a', o_custkey, ': R)(b & c: W)[NTFS](UNKNOWN)') END AS old_permissions""",
        "concat('[Shared](b & c: W)(a', o_custkey, ': R DENY)[NTFS](x: F', month(o_orderdate), ')') AS new_permissions",
    )
    return share_change_digest(approval, _system(spark, sf), "2001-08-02 00:00:00", days=1000)


QUERIES["share_change_digest"] = _share_change_digest
ORACLES["share_change_digest"] = """
WITH rowsx AS (
  SELECT o_custkey AS resource_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN chr(92) || chr(92) || 'srv' || chr(92) || 'F' || o_orderkey ELSE 'F' || o_orderkey END AS f,
         upper(c_name) || CASE WHEN c_nationkey <> 4 THEN '.' || lower(c_mktsegment) || '.net' ELSE '' END AS host,
         CASE WHEN c_nationkey <> 4 THEN upper(c_name) || '.' || lower(c_mktsegment) || '.net' ELSE lower(c_name) END AS unc_host,
         o_orderdate AS t, CASE o_orderstatus WHEN 'F' THEN 'New' ELSE 'Modified' END AS st,
         o_orderstatus = 'F' AS is_new, o_orderpriority = '5-LOW' AS low, o_custkey AS c, month(o_orderdate) AS m, o_orderpriority = '1-URGENT' AS urgent
  FROM orders JOIN customer ON c_custkey = o_custkey
  WHERE o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 1000 DAY),
lined AS (
  SELECT *, CASE WHEN is_new THEN 'None' WHEN low THEN 'Unknown' ELSE
         '<strong>Shared</strong><br><font color="red">a' || c || ': R</font><br>b &amp; c: W<br><strong>NTFS</strong><br><font color="red">UNKNOWN</font><br>' END AS old_line,
         CASE WHEN is_new OR low THEN
         '<strong>Shared</strong><br><font color="red">b &amp; c: W</font><br><font color="red">a' || c || ': R DENY</font><br><strong>NTFS</strong><br><font color="red">x: F' || m || '</font><br>'
         ELSE '<strong>Shared</strong><br>b &amp; c: W<br><font color="red">a' || c || ': R DENY</font><br><strong>NTFS</strong><br><font color="red">x: F' || m || '</font><br>' END AS new_line
  FROM rowsx)
SELECT resource_id, f AS shared_folder_name, host AS computer_name,
       CASE WHEN urgent THEN f ELSE chr(92) || chr(92) || unc_host || chr(92) || f END AS folder_path,
       t AS check_status_time, st AS check_status, 'Script' AS changed_by, old_line, new_line,
       '<tr><td class="tg-0pky">' || st || '</td><td class="tg-0pky">' || host || '</td><td class="tg-0pky">' || f
       || '</td><td class="tg-0pky">' || old_line || '</td><td class="tg-0pky">' || new_line || '</td></tr>' AS html
FROM lined
"""


def _array_diff(spark: SparkSession, sf: str) -> DataFrame:
    """On the kept lists: names hold what would end an entry or a list in the combined text."""
    odd = F.expr("CASE CAST(substring(security_principal, 2) AS int) % 3 WHEN 0 THEN ')(' WHEN 1 THEN '[NTFS]@' ELSE '' END")
    entries = _entries(spark, sf).withColumn("security_principal", F.concat("security_principal", odd))
    combined = combined_permissions(entries, ["l_orderkey"], lists=True)
    marked = combined.select("l_orderkey", array_changes("shared_entries", "ntfs_entries").alias("c"))
    return marked.select(
        "l_orderkey",
        F.array_join(F.transform("c", lambda x: F.when(x["changed"], F.concat(F.lit("!"), x["item"])).otherwise(x["item"])), ",").alias("marked"),
    )


QUERIES["array_diff"] = _array_diff
ORACLES["array_diff"] = """
WITH e AS (
  SELECT l_orderkey, l_returnflag AS rf,
         'u' || l_suppkey || CASE l_suppkey % 3 WHEN 0 THEN ')(' WHEN 1 THEN '[NTFS]@' ELSE '' END AS who, 'R' || CAST(l_quantity AS INTEGER) AS rights, l_linestatus AS ls,
         'u' || l_suppkey || CASE l_suppkey % 3 WHEN 0 THEN ')(' WHEN 1 THEN '[NTFS]@' ELSE '' END || ': R' || CAST(l_quantity AS INTEGER) || CASE WHEN l_linestatus <> 'F' THEN ' DENY' ELSE '' END AS item
  FROM lineitem),
lists AS (
  SELECT l_orderkey,
         coalesce(list(item ORDER BY who, rights, ls) FILTER (rf = 'N'), ['UNKNOWN']) AS s,
         coalesce(list(item) FILTER (rf = 'A'), ['UNKNOWN']) AS n
  FROM e GROUP BY 1)
SELECT l_orderkey, array_to_string([CASE WHEN list_contains(n, x) THEN x ELSE '!' || x END FOR x IN s], ',') AS marked FROM lists
"""

# -- access entries -----------------------------------------------------------------------


def _raw_aces(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS resource_id",
        "CASE l_linenumber WHEN 1 THEN 'ADMIN$' WHEN 2 THEN 'c$' ELSE concat('F', l_linenumber, '$') END AS share_name",
        "concat('o', l_suppkey) AS owner",
        "CASE WHEN l_returnflag = 'A' THEN 'DOM' END AS trustee_domain",
        "CASE WHEN l_returnflag <> 'N' THEN concat('t', l_partkey) END AS trustee_name",
        "CAST(l_quantity AS bigint) AS access_mask",
        "l_linenumber % 3 AS ace_type",
        "l_linenumber AS ace_flags",
    )


def _share_aces(spark: SparkSession, sf: str) -> DataFrame:
    rights = {1: "Read", 2: "Write", 4: "Append", 32: "Execute"}
    return share_aces(
        _raw_aces(spark, sf), "NTFSPermission", rights, {0: "AccessAllowed", 1: "AccessDenied"}, {1: "Object", 2: "Container"}
    )


QUERIES["share_aces"] = _share_aces
ORACLES["share_aces"] = """
SELECT DISTINCT l_orderkey AS resource_id, 'NTFSPermission' AS permission_type, 'F' || l_linenumber || '$' AS shared_folder_name,
       'o' || l_suppkey AS owner,
       CASE WHEN l_returnflag = 'N' THEN 'NOT_RESOLVED' WHEN l_returnflag = 'A' THEN 'DOM' || chr(92) || 't' || l_partkey ELSE 't' || l_partkey END AS security_principal,
       concat_ws(', ', CASE WHEN CAST(l_quantity AS BIGINT) & 1 = 1 THEN 'Read' END, CASE WHEN CAST(l_quantity AS BIGINT) & 2 = 2 THEN 'Write' END,
                 CASE WHEN CAST(l_quantity AS BIGINT) & 4 = 4 THEN 'Append' END, CASE WHEN CAST(l_quantity AS BIGINT) & 32 = 32 THEN 'Execute' END) AS file_system_rights,
       CASE l_linenumber % 3 WHEN 0 THEN 'AccessAllowed' WHEN 1 THEN 'AccessDenied' ELSE '2' END AS access_control_type,
       concat_ws(', ', CASE WHEN l_linenumber & 1 = 1 THEN 'Object' END, CASE WHEN l_linenumber & 2 = 2 THEN 'Container' END) AS access_control_flags
FROM lineitem WHERE l_linenumber > 2
"""


def _share_aces_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """As share_aces, all names from tables; bits that the table lacks are shown as numbers."""
    bits = load(spark, sf, "nation").selectExpr("shiftleft(1L, CAST(n_nationkey AS int)) AS bits", "initcap(n_name) AS name", "n_nationkey")
    kinds = load(spark, sf, "region").selectExpr("r_regionkey AS code", "concat('Access', r_name) AS name")
    return share_aces(
        _raw_aces(spark, sf), "NTFSPermission", bits.where("n_nationkey <> 3"), kinds.where("code < 2"), bits.where("n_nationkey < 2")
    )


QUERIES["share_aces_by_table"] = _share_aces_by_table
ORACLES["share_aces_by_table"] = """
WITH n AS (SELECT n_nationkey AS b, upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS name FROM nation),
bits AS (SELECT m, string_agg(CASE WHEN b = 3 THEN '0x8' ELSE name END, ', ' ORDER BY b) AS rights
         FROM (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS m FROM lineitem) CROSS JOIN n
         WHERE m & (1::BIGINT << b) > 0 GROUP BY m)
SELECT DISTINCT l_orderkey AS resource_id, 'NTFSPermission' AS permission_type, 'F' || l_linenumber || '$' AS shared_folder_name,
       'o' || l_suppkey AS owner,
       CASE WHEN l_returnflag = 'N' THEN 'NOT_RESOLVED' WHEN l_returnflag = 'A' THEN 'DOM' || chr(92) || 't' || l_partkey ELSE 't' || l_partkey END AS security_principal,
       coalesce(rights, '') AS file_system_rights,
       CASE l_linenumber % 3 WHEN 2 THEN '2' ELSE 'Access' || (SELECT r_name FROM region WHERE r_regionkey = l_linenumber % 3) END AS access_control_type,
       coalesce(array_to_string(list_filter([(SELECT name FROM n WHERE b = 0 AND l_linenumber & 1 = 1), (SELECT name FROM n WHERE b = 1 AND l_linenumber & 2 = 2),
         CASE WHEN l_linenumber & 4 = 4 THEN '0x4' END], lambda x: x IS NOT NULL), ', '), '') AS access_control_flags
FROM lineitem LEFT JOIN bits ON m = CAST(l_quantity AS BIGINT) WHERE l_linenumber > 2
"""


def _empty_scan_rows(spark: SparkSession, sf: str) -> DataFrame:
    devices = load(spark, sf, "orders").selectExpr("o_orderkey AS resource_id")
    found = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS resource_id", "concat('F', l_linenumber) AS shared_folder_name", "l_returnflag AS owner"
    )
    return with_default_rows(devices, found, "resource_id", {"shared_folder_name": "No Shared Folders", "owner": ""})


QUERIES["empty_scan_rows"] = _empty_scan_rows
ORACLES["empty_scan_rows"] = """
SELECT l_orderkey AS resource_id, 'F' || l_linenumber AS shared_folder_name, l_returnflag AS owner FROM lineitem
UNION ALL
SELECT o_orderkey, 'No Shared Folders', '' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
"""


def _share_permission_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """From raw entries of two scans to the change digest, each run on what the one before has written.

    Odd lines of an order are share entries and even ones file system entries, the folder is the order. Scan one
    leaves out orders divisible by 5, scan two those divisible by 7; from one to the other the rights of
    orders divisible by 3 change. Names of trustees hold what separates entries and lists in the combined text.
    """
    lines = load(spark, sf, "lineitem").selectExpr(
        "l_suppkey AS resource_id", "concat('F', l_orderkey) AS share_name", "concat('o', l_suppkey) AS owner", "'DOM' AS trustee_domain",
        "CASE l_partkey % 4 WHEN 0 THEN concat('t', l_partkey, ')(u') WHEN 1 THEN concat('[NTFS](t', l_partkey) ELSE concat('t', l_partkey) END AS trustee_name",
        "l_orderkey", "l_linenumber", "0 AS ace_type", "1 AS ace_flags",
    )
    devices = load(spark, sf, "supplier").selectExpr("s_suppkey AS resource_id")
    rights, kinds, flags = {1: "Read", 2: "Write"}, {0: "AccessAllowed"}, {1: "Object"}

    def scan(skipped: int, second: bool, at: str) -> DataFrame:
        mask = F.when((F.col("l_orderkey") % 3 == 0) & F.lit(second), 3).otherwise(1).cast("bigint")
        found = lines.filter(F.col("l_orderkey") % skipped > 0).withColumn("access_mask", mask)
        shared = share_aces(found.filter("l_linenumber % 2 = 1"), "SharedPermission", rights, kinds)
        ntfs = share_aces(found.filter("l_linenumber % 2 = 0"), "NTFSPermission", rights, kinds, flags)
        return permission_entries(devices, shared, ntfs, at)

    root = shared_dir(spark, "permissions")
    store = PeriodStore(f"{root}/store", SCHEMAS["share_folder_permission"], PERMISSION_KEYS, "time_added", moves=False)
    lists = "".join(f", {age}_{name} array<string>" for age in ("old", "new") for name in ENTRY_LISTS)
    state = BucketStore(f"{root}/approval", SCHEMAS["approval"] + lists, SHARE_KEYS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for day, skipped in (("2024-01-10", 5), ("2024-01-11", 7)):
        periods.purge(spark, store, f"{day} 09:00:00", 180)
        periods.merge(spark, store, scan(skipped, skipped == 7, f"{day} 08:00:00"))
        now = current_permissions(store.read(spark), lists=True)
        buckets.apply_changes(spark, state, reconcile_changes(state.read(spark), now, f"{day} 10:00:00", lists=ENTRY_LISTS), once=True)
    system = load(spark, sf, "supplier").selectExpr(
        "s_suppkey AS resource_id", "s_name AS netbios_name", "CAST(NULL AS string) AS full_domain_name"
    )
    return share_change_digest(state.read(spark), system, "2024-01-11 12:00:00").drop("html")


QUERIES["share_permission_pipeline"] = _share_permission_pipeline
ORACLES["share_permission_pipeline"] = """
WITH e AS (SELECT DISTINCT l_suppkey AS d, l_orderkey AS k, l_linenumber % 2 AS n, 'DOM' || chr(92) ||
             CASE l_partkey % 4 WHEN 0 THEN 't' || l_partkey || ')(u' WHEN 1 THEN '[NTFS](t' || l_partkey ELSE 't' || l_partkey END AS who
           FROM lineitem),
f AS (SELECT d, k, list(who || ': ' ORDER BY who) FILTER (n = 1) AS s, list(who || ': ' ORDER BY who) FILTER (n = 0) AS x FROM e GROUP BY 1, 2),
g AS (SELECT *, k % 5 > 0 AS was, k % 3 = 0 AS changes FROM f WHERE k % 7 > 0),
h AS (SELECT * FROM g WHERE NOT was OR changes),
old_new AS (
  SELECT *, CASE WHEN was THEN 'Modified' ELSE 'New' END AS st, CASE WHEN changes THEN 'Read, Write' ELSE 'Read' END AS now FROM h),
lined AS (
  SELECT *,
    '<strong>Shared</strong><br>' || CASE WHEN s IS NULL THEN 'UNKNOWN<br>' ELSE array_to_string(['<font color="red">' || y || 'Read</font><br>' FOR y IN s], '') END
    || '<strong>NTFS</strong><br>' || CASE WHEN x IS NULL THEN 'UNKNOWN<br>' ELSE array_to_string(['<font color="red">' || y || 'Read</font><br>' FOR y IN x], '') END AS before,
    '<strong>Shared</strong><br>' || CASE WHEN s IS NULL THEN CASE WHEN was THEN 'UNKNOWN<br>' ELSE '<font color="red">UNKNOWN</font><br>' END
       ELSE array_to_string(['<font color="red">' || y || now || '</font><br>' FOR y IN s], '') END
    || '<strong>NTFS</strong><br>' || CASE WHEN x IS NULL THEN CASE WHEN was THEN 'UNKNOWN<br>' ELSE '<font color="red">UNKNOWN</font><br>' END
       ELSE array_to_string(['<font color="red">' || y || now || '</font><br>' FOR y IN x], '') END AS after
  FROM old_new)
SELECT d AS resource_id, 'F' || k AS shared_folder_name, upper(s_name) AS computer_name,
       chr(92) || chr(92) || lower(s_name) || chr(92) || 'F' || k AS folder_path, TIMESTAMP '2024-01-11 10:00:00' AS check_status_time,
       st AS check_status, 'Script' AS changed_by, CASE WHEN was THEN before ELSE 'None' END AS old_line, after AS new_line
FROM lined JOIN supplier ON s_suppkey = d
"""

# -- reports as SQL text ------------------------------------------------------------------------


def _search_parameters(spark: SparkSession, sf: str, day: datetime | None, domains: list[str], computer: str) -> DataFrame:
    """The same SQL text for any of its parameters; its tables are views of a database of their own."""
    parsed = parse_share_events(_raw_messages(spark, sf, "date_format(ts, 'dd.MM.yyyy HH:mm:ss') AS time_generated"))
    names = {"events": f"events_{uuid.uuid4().hex}", "system": f"system_{uuid.uuid4().hex}"}
    parsed.withColumn("event_time", parse_mixed("time_generated")).createOrReplaceTempView(names["events"])
    _system(spark, sf).createOrReplaceTempView(names["system"])
    values = names | {"domains": domains, "instance_ids": [5142, 5143], "computer": computer, "day": day}
    return run(spark, SHARE_EVENT_SEARCH, values)


def _share_events_by_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of one text: some domains on one day, and any domain on any day."""
    some = _search_parameters(spark, sf, datetime(2024, 1, 12), ["BUILDING", "MACHINERY"], "%.net")
    every = _search_parameters(spark, sf, None, [], "Customer#0000000_9%")
    return some.withColumn("run", F.lit(1)).unionByName(every.withColumn("run", F.lit(2)))


QUERIES["share_events_by_sql"] = _share_events_by_sql
ORACLES["share_events_by_sql"] = """
WITH e AS (
  SELECT user_id AS resource_id, c_name || '.' || lower(c_mktsegment) || '.net' AS computer_name, c_mktsegment AS domain,
         'DOM' || chr(92) || 'acc' || user_id AS changed_by, CASE event_type WHEN 'click' THEN 5143 ELSE 5142 END AS instance_id,
         'S' || user_id AS shared_folder, CASE WHEN event_type = 'click' THEN 'C:/a: b' ELSE 'D:/x' END AS share_path,
         date_trunc('second', ts) AS event_time
  FROM events JOIN customer ON c_custkey = user_id
  WHERE event_type NOT IN ('view', 'error') AND user_id % 11 <> 0 AND user_id % 13 <> 0 AND c_nationkey <> 4)
SELECT *, 1 AS run FROM e WHERE domain IN ('BUILDING', 'MACHINERY') AND computer_name LIKE '%.net'
  AND event_time > TIMESTAMP '2024-01-12 00:00:00' AND event_time < TIMESTAMP '2024-01-13 00:00:00'
UNION ALL
SELECT *, 2 FROM e WHERE computer_name LIKE 'Customer#0000000_9%'
"""
