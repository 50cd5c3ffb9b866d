"""Jobs that carry state, their streams, and file round trips on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.bindings.common import load
from fleetquarry.bindings.shares import _MIXED_TIME, _permissions, _raw_messages
from fleetquarry.bindings.software import _UPDATE_XML, _FEED_SQL, _part_pages
from fleetquarry.operators.latest import newest_by_key, upsert
from fleetquarry.functions.times import parse_mixed
from fleetquarry.operators.snapshots import (
    EVENT_KEYS,
    PERMISSION_KEYS,
    SHARE_KEYS,
    insert_new,
    merge_events,
    merge_permissions,
    reconcile,
    reconcile_changes,
)
from fleetquarry.plans.compliance import new_articles
from fleetquarry.plans.servers import build_list, newest_builds
from fleetquarry.session import shared_dir
from fleetquarry.sources import buckets, files, html, periods, sinks
from fleetquarry.sources.buckets import BucketStore
from fleetquarry.sources.messages import parse_share_events
from fleetquarry.sources.periods import PeriodStore
from fleetquarry.streaming import stores

QUERIES, ORACLES = {}, {}

# -- reconcile ------------------------------------------------------------------------------

_MIDDLE = "1998-06-01 00:00:00"


def _state_and_snapshot(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """State from the first half of all orders, snapshot from the second."""
    orders = load(spark, sf, "orders").withColumn("early", F.col("o_orderdate") < F.lit(_MIDDLE).cast("timestamp_ntz"))
    keys = ["o_custkey", "o_orderpriority"]
    status = F.max("o_orderstatus").alias("p")
    state = orders.filter("early").groupBy(*keys).agg(status).selectExpr(
        "o_custkey AS resource_id",
        "o_orderpriority AS shared_folder_name",
        "'Approved' AS check_status",
        "TIMESTAMP_NTZ'2000-01-01 00:00:00' AS check_status_time",
        "'admin' AS changed_by",
        "'before' AS old_permissions",
        "p AS new_permissions",
    )
    snapshot = orders.filter("NOT early").groupBy(*keys).agg(status).selectExpr(
        "o_custkey AS resource_id", "o_orderpriority AS shared_folder_name", "p AS permissions"
    )
    return state, snapshot


_RECONCILED = f"""
s AS (SELECT o_custkey AS k, o_orderpriority AS f, max(o_orderstatus) AS p FROM orders WHERE o_orderdate < TIMESTAMP '{_MIDDLE}' GROUP BY ALL),
n AS (SELECT o_custkey AS k, o_orderpriority AS f, max(o_orderstatus) AS p FROM orders WHERE o_orderdate >= TIMESTAMP '{_MIDDLE}' GROUP BY ALL),
r AS (
  SELECT n.k AS resource_id, n.f AS shared_folder_name,
         CASE WHEN s.p IS NULL THEN 'New' WHEN s.p <> n.p THEN 'Modified' ELSE 'Approved' END AS check_status,
         CASE WHEN s.p IS NULL OR s.p <> n.p THEN TIMESTAMP '2002-02-02 00:00:00' ELSE TIMESTAMP '2000-01-01 00:00:00' END AS check_status_time,
         CASE WHEN s.p IS NULL OR s.p <> n.p THEN 'Script' ELSE 'admin' END AS changed_by,
         CASE WHEN s.p IS NULL THEN 'None' WHEN s.p <> n.p THEN s.p ELSE 'before' END AS old_permissions,
         n.p AS new_permissions
  FROM n LEFT JOIN s ON s.k = n.k AND s.f = n.f)
"""


def _reconcile_state(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile(*_state_and_snapshot(spark, sf), "2002-02-02 00:00:00")


QUERIES["reconcile_state"] = _reconcile_state
ORACLES["reconcile_state"] = f"WITH {_RECONCILED} SELECT * FROM r"


def _reconcile_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over written versions; the second, with the same snapshot, changes nothing."""
    state, snapshot = _state_and_snapshot(spark, sf)
    root, schema = shared_dir(spark, "approval"), state.schema.simpleString()[7:-1].replace(":", " ")
    sinks.write_version(state, root, 1)
    first = reconcile(sinks.read_version(spark, root, 1, schema), snapshot, "2002-02-02 00:00:00")
    sinks.write_version(first, root, 2)
    return reconcile(sinks.read_version(spark, root, 2, schema), snapshot, "2003-03-03 00:00:00")


QUERIES["reconcile_versions"] = _reconcile_versions
ORACLES["reconcile_versions"] = f"WITH {_RECONCILED} SELECT * FROM r"

def _reconcile_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The state in hash buckets: the changes of the snapshot are applied, then a second run finds nothing to change."""
    state, snapshot = _state_and_snapshot(spark, sf)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)
    store = BucketStore(shared_dir(spark, "approval"), kind, SHARE_KEYS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets.create(spark, store, state)
    for day in ("2002-02-02 00:00:00", "2003-03-03 00:00:00"):
        buckets.apply_changes(spark, store, reconcile_changes(store.read(spark), snapshot, day), once=True)
    return store.read(spark)


QUERIES["reconcile_buckets"] = _reconcile_buckets
ORACLES["reconcile_buckets"] = f"WITH {_RECONCILED} SELECT * FROM r"

# -- insert if absent and upsert --------------------------------------------------------------


def _sheet_rows(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").selectExpr(
        "nullif(l_returnflag, 'N') AS severity",
        "concat('KB', l_partkey) AS article",
        "l_linestatus AS impact",
        "l_shipdate",
    )


def _anti_join_insert(spark: SparkSession, sf: str) -> DataFrame:
    sheet = _sheet_rows(spark, sf)
    known = sheet.filter("l_shipdate < TIMESTAMP_NTZ'1996-01-01 00:00:00'").drop("l_shipdate")
    # the stored table holds '' where the sheet holds nothing
    known = known.withColumn("severity", F.coalesce("severity", F.lit("")))
    return insert_new(known, sheet.drop("l_shipdate"), ["severity", "article", "impact"])


QUERIES["anti_join_insert"] = _anti_join_insert
ORACLES["anti_join_insert"] = """
WITH s AS (SELECT nullif(l_returnflag, 'N') AS severity, 'KB' || l_partkey AS article, l_linestatus AS impact, l_shipdate FROM lineitem)
SELECT DISTINCT severity, article, impact FROM s
WHERE NOT EXISTS (SELECT 1 FROM s k WHERE k.l_shipdate < TIMESTAMP '1996-01-01 00:00:00'
  AND coalesce(k.severity, '') = coalesce(s.severity, '') AND k.article = s.article AND k.impact = s.impact)
"""


def _sheet(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").selectExpr(
        "date_format(l_shipdate, 'yyyy-MM-01') AS `Date`",
        "concat('P', l_linenumber) AS `Product`",
        "nullif(l_linestatus, 'O') AS `Product Family`",
        "l_linestatus AS `Platform`",
        "concat('''', l_suppkey) AS `Article`",
        "'Security Update' AS `Download`",
        "nullif(l_returnflag, 'N') AS `Severity`",
        "CAST(NULL AS string) AS `Impact`",
        "concat('CVE-', l_suppkey) AS `Details`",
        "l_shipdate",
    )


def _new_articles(spark: SparkSession, sf: str) -> DataFrame:
    sheet = _sheet(spark, sf)
    known = files.normalise_cve_sheet(sheet.filter("l_shipdate < TIMESTAMP_NTZ'1998-01-01 00:00:00'"))
    # the whole sheet brings every row of the known part again
    return new_articles(known, sheet)


QUERIES["new_articles"] = _new_articles
ORACLES["new_articles"] = """
SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS release_date, 'P' || l_linenumber AS product,
       CASE WHEN l_linestatus = 'F' THEN 'F' ELSE '' END AS product_family, l_linestatus AS platform,
       CAST(l_suppkey AS VARCHAR) AS article, 'Security Update' AS update_classification,
       CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS severity, '' AS impact, 'CVE-' || l_suppkey AS cve
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'
"""


def _keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    target = events.filter("ts < TIMESTAMP_NTZ'2024-01-20 00:00:00'").groupBy("user_id", "event_type").agg(
        F.max("ts").alias("ts"), F.max("event_id").alias("event_id"), F.min("value").alias("value")
    )
    batch = events.filter("ts >= TIMESTAMP_NTZ'2024-01-20 00:00:00'")
    return upsert(target, batch, ["user_id", "event_type"], "ts")


QUERIES["keyed_upsert"] = _keyed_upsert
ORACLES["keyed_upsert"] = """
WITH b AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
           FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'),
t AS (SELECT user_id, event_type, max(ts) AS ts, max(event_id) AS event_id, min(value) AS value
      FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1, 2)
SELECT user_id, event_type, ts, event_id, value FROM b WHERE rn = 1
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = t.user_id AND b.event_type = t.event_type)
"""

# -- event and permission stores ---------------------------------------------------------------

_PARSED = (
    "resource_id bigint, index bigint, instance_id bigint, time_generated string, message string, account_name string, "
    "share_name string, new_remark string, time_added string"
)
_EVENT_COLUMNS = "resource_id bigint, index bigint, instance_id bigint, time_generated string, message string"


def _event_rows(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").selectExpr(
        "user_id AS resource_id",
        "event_id DIV 2 AS index",
        "CAST(CASE event_type WHEN 'click' THEN 5143 ELSE 5142 END AS bigint) AS instance_id",
        "date_format(ts, 'dd.MM.yyyy HH:mm:ss') AS time_generated",
        "concat(event_type, ' ', event_id) AS message",
        "ts",
    )


def _merge_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = _event_rows(spark, sf)
    keys = ["resource_id", "index", "instance_id"]
    store = newest_by_key(rows.filter("ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'"), keys, ["message"])
    store = store.drop("ts").withColumn("message", F.lit("stored"))
    # repeats of a key stay in the batch: the greatest message was written last
    batch = rows.filter("ts >= TIMESTAMP_NTZ'2024-01-10 00:00:00'").drop("ts")
    return merge_events(store, batch, "2024-07-05 00:00:00", order="message")


QUERIES["merge_events"] = _merge_events
ORACLES["merge_events"] = """
WITH e AS (SELECT user_id AS r, event_id // 2 AS i, CAST(CASE event_type WHEN 'click' THEN 5143 ELSE 5142 END AS BIGINT) AS n,
                  date_trunc('second', ts) AS t, ts, event_type || ' ' || event_id AS m FROM events),
b AS (SELECT r, i, n, arg_max(t, m) AS t, max(m) AS m FROM e WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY 1, 2, 3),
all_old AS (SELECT r, i, n, arg_max(t, m) AS t FROM e WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1, 2, 3),
old AS (SELECT * FROM all_old WHERE t > TIMESTAMP '2024-07-05 00:00:00' - INTERVAL 180 DAY)
SELECT r AS resource_id, i AS index, n AS instance_id, strftime(t, '%d.%m.%Y %H:%M:%S') AS time_generated, m AS message FROM b
UNION ALL
SELECT r, i, n, strftime(t, '%d.%m.%Y %H:%M:%S'), 'stored' FROM old WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.r = old.r AND b.i = old.i AND b.n = old.n)
"""


def _merge_permissions(spark: SparkSession, sf: str) -> DataFrame:
    rows = _permissions(spark, sf)
    # the store as its first run leaves it: one row a key
    store = merge_permissions(rows.limit(0), rows.filter("time_added NOT LIKE '%/%'"), "2001-08-01 00:00:00")
    batch = rows.filter("time_added LIKE '%/%'")
    return merge_permissions(store, batch, "2001-08-01 00:00:00").select(*PERMISSION_KEYS, "owner")


QUERIES["merge_permissions"] = _merge_permissions
ORACLES["merge_permissions"] = """
SELECT o_custkey AS resource_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'No Shared Folders' ELSE 'F' || l_linenumber % 3 END AS shared_folder_name,
       CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%y.%m.%d %H:%M') WHEN 'O' THEN strftime(o_orderdate, '%d.%m.%Y %H:%M')
            ELSE strftime(o_orderdate, '%m/%d/%Y %H:%M:%S') END AS time_added,
       CASE l_returnflag WHEN 'A' THEN 'NTFSPermission' WHEN 'N' THEN 'SharedPermission' ELSE 'Odd' END AS permission_type,
       CASE WHEN l_linenumber = 1 THEN 'Все' WHEN l_linenumber = 2 THEN 'BUILTIN' || chr(92) || 'Пользователи' ELSE 'u' || l_suppkey END AS security_principal,
       'R' || CAST(l_quantity AS INTEGER) AS file_system_rights,
       CASE WHEN l_linestatus = 'F' THEN 'AccessAllowed' ELSE 'AccessDenied' END AS access_control_type,
       max('owner' || l_partkey) AS owner
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderstatus = 'P' OR o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 180 DAY
GROUP BY ALL
"""

# -- streams ----------------------------------------------------------------------------------


# A stream's input comes in three landings; landing k has the events whose id leaves k by 3.
def _land(rows: DataFrame, root: str, landing: int) -> None:
    rows.filter(F.col("landing") == landing).drop("landing").write.parquet(f"{root}/in/landing{landing}")


def _landed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(f"{root}/in/*")


def _event_store_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of one stream, a compaction that purges, and a new stream going on from it."""
    root = shared_dir(spark, "event-store")
    rows = _event_rows(spark, sf).drop("ts").withColumn("landing", F.regexp_extract("message", "([0-9]+)$", 1).cast("int") % 3)
    for landing in (0, 1):
        _land(rows, root, landing)
        stores.start_event_store(_landed(spark, root, _EVENT_COLUMNS), f"{root}/data", f"{root}/progress").awaitTermination()
    stores.compact(spark, f"{root}/data", _EVENT_COLUMNS, f"{root}/next", order=["message"], as_of="2024-07-05 00:00:00")
    _land(rows, f"{root}/later", 2)
    stores.start_event_store(
        _landed(spark, f"{root}/later", _EVENT_COLUMNS), f"{root}/next", f"{root}/next-progress"
    ).awaitTermination()
    return stores.read_store(spark, f"{root}/next", _EVENT_COLUMNS, order=["message"])


QUERIES["event_store_stream"] = _event_store_stream
ORACLES["event_store_stream"] = """
WITH e AS (SELECT user_id AS r, event_id // 2 AS i, CAST(CASE event_type WHEN 'click' THEN 5143 ELSE 5142 END AS BIGINT) AS n,
                  date_trunc('second', ts) AS t, event_type || ' ' || event_id AS m, event_id % 3 AS landing FROM events),
w AS (SELECT *, row_number() OVER (PARTITION BY r, i, n, landing = 2 ORDER BY landing DESC, m DESC) AS rn FROM e),
b AS (SELECT * FROM w WHERE rn = 1 AND landing = 2),
old AS (SELECT * FROM w WHERE rn = 1 AND landing < 2 AND t > TIMESTAMP '2024-07-05 00:00:00' - INTERVAL 180 DAY)
SELECT r AS resource_id, i AS index, n AS instance_id, strftime(t, '%d.%m.%Y %H:%M:%S') AS time_generated, m AS message FROM b
UNION ALL
SELECT r, i, n, strftime(t, '%d.%m.%Y %H:%M:%S'), m FROM old
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.r = old.r AND b.i = old.i AND b.n = old.n)
"""


def _insert_new_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches of one stream, a compaction after which it goes on, and a new stream on the compacted store; the row
    that came first stays."""
    root, schema, keys = shared_dir(spark, "insert-new"), "user_id bigint, event_type string, landed int", ["user_id", "event_type"]
    rows = load(spark, sf, "events").selectExpr(
        "user_id", "nullif(event_type, 'view') AS event_type", "CAST(event_id % 5 AS int) AS landed", "CAST(event_id % 5 AS int) AS landing"
    )

    def run(landed: str, target: str, progress: str) -> None:
        stream = _landed(spark, landed, schema)
        stores.start_insert_new(stream, f"{root}/{target}", f"{root}/{progress}", schema, keys).awaitTermination()

    for landing in range(3):
        _land(rows, root, landing)
        run(root, "data", "progress")
    stores.compact(spark, f"{root}/data", schema, f"{root}/next", keys)
    _land(rows, root, 3)
    run(root, "next", "progress")
    held = spark.read.schema(schema).parquet(f"{root}/next/*")
    held.write.parquet(f"{root}/last/{stores.BATCH}={stores.COMPACTED}")
    _land(rows, f"{root}/later", 4)
    run(f"{root}/later", "last", "last-progress")
    return spark.read.schema(schema).parquet(f"{root}/last/*")


QUERIES["insert_new_stream"] = _insert_new_stream
ORACLES["insert_new_stream"] = """
SELECT user_id, nullif(event_type, 'view') AS event_type, CAST(min(event_id % 5) AS INTEGER) AS landed FROM events GROUP BY 1, 2
"""


def _raw_event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Raw messages in landings, parsed in the stream, kept by day. A fifth of them comes again in the next landing;
    rows from over ten days before the newest of the landings before come too late."""
    root = shared_dir(spark, "raw-events")
    kind = "resource_id bigint, index bigint, instance_id bigint, time_generated string, time_added string, message string"
    raw = _raw_messages(spark, sf, _MIXED_TIME).withColumn("first", F.col("index") % 3)
    again = raw.where("index % 5 = 0").withColumn("first", F.col("first") + 1)
    raw = raw.unionByName(again).selectExpr(
        "resource_id", "index", "CAST(instance_id AS bigint) AS instance_id", "time_generated", "concat('landing ', first) AS time_added",
        "message", "first AS landing",
    )
    store = PeriodStore(f"{root}/store", _PARSED, EVENT_KEYS, "time_generated", moves=False)
    for landing in range(4):
        _land(raw, root, landing)
        parsed = parse_share_events(_landed(spark, root, kind))
        parsed = parsed.withColumn("event_time", parse_mixed("time_generated").cast("timestamp"))
        stores.start_period_store(parsed, store, f"{root}/progress", "event_time", "10 days").awaitTermination()
    return store.read(spark)


QUERIES["raw_event_stream"] = _raw_event_stream
ORACLES["raw_event_stream"] = """
WITH e AS (SELECT *, event_type = 'click' AS m, date_trunc('second', ts) AS t, event_id % 3 AS first FROM events
           WHERE event_type <> 'view' AND user_id % 11 <> 0 AND user_id % 13 <> 0),
arrivals AS (SELECT *, first AS k FROM e UNION ALL SELECT *, first + 1 FROM e WHERE event_id % 5 = 0),
late AS (SELECT k, (SELECT max(t) FROM arrivals b WHERE b.k < a.k) - INTERVAL 10 DAY AS mark FROM (SELECT DISTINCT k FROM arrivals) a),
kept AS (SELECT event_id, min(k) AS k FROM arrivals JOIN late USING (k) WHERE mark IS NULL OR t > mark GROUP BY event_id)
SELECT user_id AS resource_id, event_id AS index, CAST(CASE event_type WHEN 'click' THEN 5143 WHEN 'error' THEN 5144 ELSE 5142 END AS BIGINT) AS instance_id,
       CASE WHEN m THEN strftime(ts, '%m/%d/%Y %H:%M:%S') ELSE strftime(ts, '%d.%m.%Y %H:%M:%S') END AS time_generated,
       CASE WHEN m THEN 'A network share object was modified.' ELSE 'A network share object was added.' END AS message,
       'acc' || user_id AS account_name, chr(92) || chr(92) || '*' || chr(92) || 'S' || user_id AS share_name,
       CASE WHEN m THEN 'r' || event_id END AS new_remark, 'landing ' || k AS time_added, CAST(t AS DATE) AS period
FROM e JOIN kept USING (event_id)
"""

# -- stores laid out by time --------------------------------------------------------------------


def _event_periods(spark: SparkSession, sf: str) -> DataFrame:
    """As merge_events: a store by day, purged, then a batch some of whose keys move to other days."""
    store = PeriodStore(shared_dir(spark, "event-days"), _EVENT_COLUMNS, EVENT_KEYS, "time_generated")
    rows = _event_rows(spark, sf)
    old = newest_by_key(rows.filter("ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'"), EVENT_KEYS, ["message"])
    periods.merge(spark, store, old.drop("ts").withColumn("message", F.lit("stored")))
    periods.purge(spark, store, "2024-07-05 00:00:00", 180)
    periods.merge(spark, store, rows.filter("ts >= TIMESTAMP_NTZ'2024-01-10 00:00:00'").drop("ts"), order="message")
    return store.read(spark).drop(periods.PERIOD)


QUERIES["event_periods"] = _event_periods
ORACLES["event_periods"] = ORACLES["merge_events"]


def _permission_periods(spark: SparkSession, sf: str) -> DataFrame:
    """As merge_permissions, in a store by month; the time is part of the key, so a merge opens the batch's months alone."""
    kind = ", ".join(f"{c} {t}" for c, t in _permissions(spark, sf).select(*PERMISSION_KEYS, "owner").dtypes)
    store = PeriodStore(shared_dir(spark, "permission-months"), kind, PERMISSION_KEYS, "time_added", grain="month", moves=False)
    rows = _permissions(spark, sf).select(*PERMISSION_KEYS, "owner")
    periods.merge(spark, store, rows.filter("time_added NOT LIKE '%/%'"))
    periods.purge(spark, store, "2001-08-01 00:00:00", 180)
    periods.merge(spark, store, rows.filter("time_added LIKE '%/%'"))
    return store.read(spark).drop(periods.PERIOD)


QUERIES["permission_periods"] = _permission_periods
ORACLES["permission_periods"] = ORACLES["merge_permissions"]


def _event_day(spark: SparkSession, sf: str) -> DataFrame:
    """One day's events from a store by day."""
    store = PeriodStore(shared_dir(spark, "event-days"), _EVENT_COLUMNS, ["index"], "time_generated")
    rows = _event_rows(spark, sf).selectExpr("resource_id", "CAST(split(message, ' ')[1] AS bigint) AS index", "instance_id", "time_generated", "message")
    periods.merge(spark, store, rows)
    return periods.rows_of_day(spark, store, "2024-01-15 06:00:00")


QUERIES["event_day"] = _event_day
ORACLES["event_day"] = """
SELECT user_id AS resource_id, event_id AS index, CAST(CASE event_type WHEN 'click' THEN 5143 ELSE 5142 END AS BIGINT) AS instance_id,
       strftime(ts, '%d.%m.%Y %H:%M:%S') AS time_generated, event_type || ' ' || event_id AS message
FROM events WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-15 06:00:00' AND date_trunc('second', ts) < TIMESTAMP '2024-01-16 06:00:00'
"""

# -- files ------------------------------------------------------------------------------------


def _builds_file(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "builds")
    sinks.write_builds(build_list(_part_pages(spark, sf)), path)
    return newest_builds(files.read_builds(spark, path), "version")


QUERIES["builds_file"] = _builds_file
ORACLES["builds_file"] = """
SELECT '15.' || p_size || '.2' AS build, '20' || (10 + p_size % 6) || '.' || p_partkey || '.2' AS file_version,
       '20' || (10 + p_size % 6) AS sql_version, 'KB' || p_partkey AS kb, 'http://x/' || p_partkey AS link,
       p_name AS update_name, '20' || (10 + p_size % 6) || '-02-03' AS release_date
FROM (SELECT *, max(p_partkey) OVER (PARTITION BY p_size % 6) AS top FROM part) WHERE p_partkey = top
"""


def _manifest_file(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "manifest")
    sinks.write_manifest(
        load(spark, sf, "part").selectExpr(
            "concat('f', p_partkey, '.cab') AS file_name", "concat('http://x/\"', p_name, '\",', p_partkey) AS source_url"
        ),
        path,
    )
    return files.read_manifest(spark, path)


QUERIES["manifest_file"] = _manifest_file
ORACLES["manifest_file"] = """
SELECT 'f' || p_partkey || '.cab' AS file_name, 'http://x/"' || p_name || '",' || p_partkey AS source_url FROM part
"""


def _cve_sheet_file(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "sheet")
    sheet = load(spark, sf, "part").selectExpr(
        "'2024-02-03' AS `Date`",
        "p_name AS `Product`",
        "p_brand AS `Product Family`",
        "nullif(p_type, 'LARGE') AS `Platform`",
        "concat('''', p_partkey) AS `Article`",
        "'Security, Update' AS `Download`",
        "CAST(p_size AS string) AS `Severity`",
        "CAST(NULL AS string) AS `Impact`",
        "concat('CVE-', p_partkey) AS `Details`",
    )
    sheet.write.csv(path, header=True)
    return files.read_cve_sheet(spark, path)


QUERIES["cve_sheet_file"] = _cve_sheet_file
ORACLES["cve_sheet_file"] = """
SELECT TIMESTAMP '2024-02-03 00:00:00' AS release_date, p_name AS product, p_brand AS product_family,
       CASE WHEN p_type = 'LARGE' THEN '' ELSE p_type END AS platform, CAST(p_partkey AS VARCHAR) AS article,
       'Security, Update' AS update_classification, CAST(p_size AS VARCHAR) AS severity, '' AS impact, 'CVE-' || p_partkey AS cve
FROM part
"""


def _update_feed_file(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "feed")
    feed = files.updates_from_text(load(spark, sf, "part").selectExpr(f"{_UPDATE_XML} AS xml"), "xml")
    feed.write.format("xml").options(rootTag="updates", rowTag="update").save(path)
    return files.update_packages(files.read_updateinfo(spark, path))


QUERIES["update_feed_file"] = _update_feed_file
ORACLES["update_feed_file"] = f"""
WITH {_FEED_SQL}
SELECT 'final' AS status, type, id, title, date, name, version, release, file AS file_name FROM pkg
"""


def _html_page_files(spark: SparkSession, sf: str) -> DataFrame:
    """Digest rows written as files, read back as whole pages, and cut into rows again."""
    path = shared_dir(spark, "digest")
    part = load(spark, sf, "part")
    sinks.write_html_rows(part.select(html.html_row("p_partkey", "p_name", "p_type").alias("html")), path)
    rows = html.html_table_rows(html.read_pages(spark, path))
    cells = F.regexp_extract_all("inner_html", F.lit(r"<td[^>]*>([^<]*)</td>"), F.lit(1))
    return rows.select(*[F.get(cells, i).alias(n) for i, n in enumerate(("key", "name", "kind"))])


QUERIES["html_page_files"] = _html_page_files
ORACLES["html_page_files"] = "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_type AS kind FROM part"
