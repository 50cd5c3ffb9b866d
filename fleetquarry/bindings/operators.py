"""Single operators on the test tables: joins, ranks, roll-ups, text, numbers, times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetquarry.bindings.common import load
from fleetquarry.functions import codes, numbers, text, times, versions
from fleetquarry.operators import joins, latest, rollups

QUERIES, ORACLES = {}, {}

# -- joins --------------------------------------------------------------------------------


def _inner_by_later_join(spark: SparkSession, sf: str) -> DataFrame:
    customer, orders = load(spark, sf, "customer"), load(spark, sf, "orders")
    lineitem = load(spark, sf, "lineitem")
    # a left join that the later inner join makes an inner one
    return (
        customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("c_name", "o_orderkey", "l_linenumber", "l_partkey")
    )


QUERIES["inner_by_later_join"] = _inner_by_later_join
ORACLES["inner_by_later_join"] = """
SELECT c_name, o_orderkey, l_linenumber, l_partkey
FROM customer LEFT JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
"""


def _on_clause_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders, lineitem = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    joined = joins.left_where(
        orders, lineitem, F.col("o_orderkey") == F.col("l_orderkey"), F.col("l_returnflag") == "R"
    )
    return joined.select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


QUERIES["on_clause_filter"] = _on_clause_filter
ORACLES["on_clause_filter"] = """
SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_returnflag = 'R'
"""


def _composite_key_join(spark: SparkSession, sf: str) -> DataFrame:
    lineitem, orders = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    shipped = lineitem.select("l_orderkey", F.col("l_shipdate").alias("day"), "l_partkey")
    placed = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(10))).alias("day"),
        "o_custkey",
    )
    return shipped.join(placed, ["l_orderkey", "day"], "left")


QUERIES["composite_key_join"] = _composite_key_join
ORACLES["composite_key_join"] = """
SELECT l_orderkey, l_shipdate AS day, l_partkey, o_custkey
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND l_shipdate = o_orderdate + INTERVAL 10 DAY
"""


def _parent_self_join(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").withColumn("parent_id", F.col("event_id") - 1)
    return joins.with_parent(events, "event_id", "parent_id", ["event_type", "user_id"]).select(
        "event_id", "event_type", "parent_event_type", "parent_user_id"
    )


QUERIES["parent_self_join"] = _parent_self_join
ORACLES["parent_self_join"] = """
SELECT e.event_id, e.event_type, p.event_type AS parent_event_type, p.user_id AS parent_user_id
FROM events e JOIN events p ON p.event_id = e.event_id - 1
"""


def _relation_two_hop(spark: SparkSession, sf: str) -> DataFrame:
    nodes = load(spark, sf, "part").select("p_partkey", "p_name")
    edges = load(spark, sf, "lineitem").selectExpr("l_partkey AS low", "l_partkey + l_linenumber AS high").distinct()
    return joins.two_hop(edges, nodes, "low", "high", "p_partkey").select(
        "low", "high", "source_p_name", "target_p_name"
    )


QUERIES["relation_two_hop"] = _relation_two_hop
ORACLES["relation_two_hop"] = """
SELECT low, high, a.p_name AS source_p_name, b.p_name AS target_p_name
FROM (SELECT DISTINCT l_partkey AS low, l_partkey + l_linenumber AS high FROM lineitem)
JOIN part a ON a.p_partkey = low LEFT JOIN part b ON b.p_partkey = high
"""


def _exists_flag(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer").select("c_custkey", "c_name")
    urgent = load(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    flagged = rollups.with_flag(customer, urgent, "c_custkey", "urgent", "o_custkey")
    return flagged.withColumn("urgent", F.when(F.col("urgent"), F.lit("Yes")).otherwise(F.lit("No")))


QUERIES["exists_flag"] = _exists_flag
ORACLES["exists_flag"] = """
SELECT c_custkey, c_name, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
       AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') THEN 'Yes' ELSE 'No' END AS urgent
FROM customer
"""


def _correlated_count(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    returned = load(spark, sf, "orders").filter("o_orderstatus = 'F'")
    counted = rollups.with_count(customer, returned, "c_custkey", "orders", "o_custkey")
    return counted.withColumn("product", F.col("c_nationkey") * F.col("orders"))


QUERIES["correlated_count"] = _correlated_count
ORACLES["correlated_count"] = """
SELECT c_custkey, c_nationkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS orders,
       c_nationkey * (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS product
FROM customer
"""


def _semi_join(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part").select("p_partkey", "p_name")
    sold = load(spark, sf, "lineitem").filter("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return part.join(sold, "p_partkey", "left_semi")


QUERIES["semi_join"] = _semi_join
ORACLES["semi_join"] = """
SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)
"""

# -- labels and predicates ----------------------------------------------------------------


# of open orders: one of 24 states by customer, or none
_OTHER_STATES = """CASE o_custkey % 25 WHEN 0 THEN 1000 WHEN 1 THEN 2000 WHEN 2 THEN 2001 WHEN 3 THEN 2002 WHEN 4 THEN 2003
  WHEN 5 THEN 2004 WHEN 6 THEN 2005 WHEN 7 THEN 2018 WHEN 8 THEN 2019 WHEN 9 THEN 2020 WHEN 10 THEN 3000 WHEN 11 THEN 3001
  WHEN 12 THEN 4000 WHEN 13 THEN 5000 WHEN 14 THEN 5001 WHEN 15 THEN 5002 WHEN 16 THEN 5003 WHEN 17 THEN 5004 WHEN 18 THEN 5005
  WHEN 19 THEN 5006 WHEN 20 THEN 5007 WHEN 21 THEN 5008 WHEN 22 THEN 5009 WHEN 23 THEN 5010 END"""


def _status_labels(spark: SparkSession, sf: str) -> DataFrame:
    state = f"CASE o_orderstatus WHEN 'F' THEN 1000 + month(o_orderdate) WHEN 'P' THEN 2005 + month(o_orderdate) ELSE {_OTHER_STATES} END"
    orders = load(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"{state} AS state",
        "CAST(left(o_orderpriority, 1) AS int) - 1 AS offer",
        "month(o_orderdate) % 2 AS applicable",
    )
    return orders.select(
        "o_orderkey",
        codes.enforcement_message("state", "offer").alias("message"),
        codes.lookup("offer", codes.OFFER_TYPES).alias("purpose"),
        codes.compliance_text("applicable", F.lit(1), "offer").alias("compliance"),
        codes.compliance_text("applicable", F.lit(1), "offer", F.lit(None).cast("string")).alias("value"),
        codes.member_type("offer").alias("kind"),
        text.is_device_id(F.col("o_orderkey") + 9990000).alias("is_device"),
    )


QUERIES["status_labels"] = _status_labels
ORACLES["status_labels"] = f"""
WITH m(st, msg) AS (VALUES (1001, 'Already Compliant'), (1002, 'Simulate Success'), (2006, 'Downloading dependent content'),
  (2007, 'Installing dependent content'), (2008, 'Restart to complete'), (2009, 'Content downloaded'), (2010, 'Waiting for update'),
  (2011, 'Waiting for user session reconnect'), (2012, 'Waiting for user logoff'), (2013, 'Waiting for user logon'),
  (2014, 'Waiting to install'), (2015, 'Waiting retry'), (2016, 'Waiting for presentation mode'), (2017, 'Waiting for Orchestration'),
  (1000, 'Success'), (2000, 'In Progress'), (2001, 'Waiting for Content'), (2002, 'Installing'), (2003, 'Restart to Continue'),
  (2004, 'Waiting for maintenance window'), (2005, 'Waiting for schedule'), (2018, 'Waiting for network'),
  (2019, 'Pending App-V Virtual Environment'), (2020, 'Updating App-V Virtual Environment'), (3000, 'Requirements not met'),
  (3001, 'Host platform not applicable'), (4000, 'Unknown'), (5000, 'Deployment failed'), (5001, 'Evaluation failed'),
  (5002, 'Deployment failed'), (5003, 'Failed to locate content'), (5004, 'Dependency installation failed'),
  (5005, 'Failed to download dependent content'), (5006, 'Conflicts with another application deployment'), (5007, 'Waiting retry'),
  (5008, 'Failed to uninstall superseded deployment type'), (5009, 'Failed to download superseded deployment type'),
  (5010, 'Failed to updating App-V Virtual Environment')),
o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1000 + month(o_orderdate) WHEN 'P' THEN 2005 + month(o_orderdate) ELSE {_OTHER_STATES} END AS st,
             CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS offer, month(o_orderdate) % 2 AS appl FROM orders)
SELECT o_orderkey, coalesce(msg, CASE WHEN offer = 2 THEN 'Available for Install' WHEN o.st IS NULL THEN 'Unknown' END) AS message,
       CASE offer WHEN 0 THEN 'Required' WHEN 2 THEN 'Available' END AS purpose,
       CASE WHEN appl = 0 THEN 'Not Applicable' WHEN offer IN (1, 4) THEN 'Compliant' WHEN offer = 2 THEN 'Non Compliant' ELSE 'Unknown' END AS compliance,
       CASE WHEN appl = 0 THEN 'Not Applicable' WHEN offer IN (1, 4) THEN 'Compliant' WHEN offer = 2 THEN NULL ELSE 'Unknown' END AS value,
       CASE offer WHEN 4 THEN 'User' ELSE 'unknown' END AS kind, o_orderkey + 9990000 >= 10000000 AS is_device
FROM o LEFT JOIN m ON m.st = o.st
"""


def _param_search(spark: SparkSession, sf: str) -> DataFrame:
    day = "1998-05-01 00:00:00"
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    placed = orders.withColumn("t", F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(5)))
    found = placed.filter(
        F.col("o_orderstatus").isin("F", "O")
        & (times.on_day("t", day) | (F.col("t") > times.days_before("2001-07-31 00:00:00", 60)))
    )
    return found.join(customer, F.col("c_custkey") == F.col("o_custkey")).filter(
        text.like_pattern("c_mktsegment", "%[A-H]UI%") | text.contains_pattern("c_name", "_1")
    ).select("o_orderkey", "c_name", "c_mktsegment", "t")


QUERIES["param_search"] = _param_search
ORACLES["param_search"] = """
SELECT o_orderkey, c_name, c_mktsegment, t
FROM (SELECT *, o_orderdate + INTERVAL 5 HOUR AS t FROM orders) JOIN customer ON c_custkey = o_custkey
WHERE o_orderstatus IN ('F', 'O')
  AND (t > TIMESTAMP '1998-05-01 00:00:00' AND t < TIMESTAMP '1998-05-02 00:00:00'
       OR t > TIMESTAMP '2001-07-31 00:00:00' - INTERVAL 60 DAY)
  AND (c_mktsegment SIMILAR TO '.*[A-H]UI.*' OR c_name LIKE '%_1%')
"""


def _like_edge_cases(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    path = F.concat(F.lit("C:\\"), F.replace("p_name", F.lit(" "), F.lit("\\")), F.lit("_x!%"))
    cases = part.select("p_partkey", "p_name", path.alias("path"))
    return cases.select(
        "p_partkey",
        text.like_pattern("path", "C:\\sm%").alias("backslash"),
        text.like_pattern("path", "%\\gear__!_").alias("wild"),
        text.like_pattern("path", "%!%").alias("bang"),
        (~text.like_pattern("p_name", "%ring%")).alias("not_ring"),
        text.glob_match("p_name", "RED*").alias("glob_prefix"),
        text.glob_match("p_name", "???? *").alias("glob_single"),
        text.glob_any("p_name", ["*bolt", "*PLATE", "hot g*"]).alias("glob_any"),
        (text.folded(F.concat("p_name", F.lit("  ")), True) == text.folded(F.upper("p_name"), True)).alias("same"),
    )


QUERIES["like_edge_cases"] = _like_edge_cases
ORACLES["like_edge_cases"] = r"""
SELECT p_partkey, starts_with(p_name, 'sm') AS backslash, ends_with(p_name, ' gear') AS wild, true AS bang,
       NOT contains(p_name, 'ring') AS not_ring, starts_with(p_name, 'red') AS glob_prefix,
       regexp_matches(p_name, '^.{4} ') AS glob_single,
       regexp_matches(p_name, 'bolt$|plate$|^hot g') AS glob_any, true AS same
FROM part
"""

# -- newest and ranks ---------------------------------------------------------------------


def _latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    return latest.latest_snapshot(
        orders, "o_custkey", "o_orderdate", F.col("o_orderpriority") != "5-LOW"
    ).select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")


QUERIES["latest_snapshot"] = _latest_snapshot
ORACLES["latest_snapshot"] = """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority
FROM orders JOIN (SELECT o_custkey AS k, max(o_orderdate) AS t FROM orders GROUP BY 1) ON k = o_custkey AND t = o_orderdate
WHERE o_orderpriority <> '5-LOW'
"""


def _dense_rank_latest(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part").select("p_brand", "p_name", "p_partkey")
    return latest.top_rank(part, ["p_brand"], "p_name", descending=True)


QUERIES["dense_rank_latest"] = _dense_rank_latest
ORACLES["dense_rank_latest"] = """
SELECT p_brand, p_name, p_partkey
FROM (SELECT *, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_name DESC) AS rn FROM part) WHERE rn = 1
"""


def _dense_rank_first(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "CASE WHEN l_suppkey % 3 = 0 OR l_returnflag <> 'N' THEN concat('a', l_linenumber) END AS name", "l_orderkey"
    )
    return latest.top_rank(lines, ["l_suppkey"], "name")


QUERIES["dense_rank_first"] = _dense_rank_first
ORACLES["dense_rank_first"] = """
SELECT l_suppkey, name, l_orderkey FROM (
  SELECT *, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY name NULLS FIRST) AS rn FROM (
    SELECT l_suppkey, CASE WHEN l_suppkey % 3 = 0 OR l_returnflag <> 'N' THEN 'a' || l_linenumber END AS name, l_orderkey FROM lineitem))
WHERE rn = 1
"""


def _rank_by_parsed_date(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey",
        "CASE WHEN o_orderstatus = 'P' THEN 'no date' ELSE date_format(o_orderdate, 'yyyyMMdd') || '120000' END AS day_text",
    ).withColumn("day", times.parse_compact_day("day_text"))
    return latest.dense_rank_of(orders, ["o_custkey"], "day", "rank", descending=True).drop("day_text")


QUERIES["rank_by_parsed_date"] = _rank_by_parsed_date
ORACLES["rank_by_parsed_date"] = """
SELECT o_orderkey, o_custkey, day, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY day DESC NULLS LAST) AS INTEGER) AS rank
FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS day FROM orders)
"""

# -- roll-ups -----------------------------------------------------------------------------


def _ordered_rollup(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem")
    cells = {
        "parts": rollups.Text(F.concat(F.lit("P"), "l_partkey"), [F.col("l_linenumber")]),
        "returned": rollups.Text(
            F.when(F.col("l_returnflag") == "R", F.col("l_suppkey").cast("string")), [F.col("l_suppkey")], "; ", "none"
        ),
    }
    return rollups.ordered_rollup(lines, ["l_orderkey"], cells, [F.count("*").alias("lines")])


QUERIES["ordered_rollup"] = _ordered_rollup
ORACLES["ordered_rollup"] = """
SELECT l_orderkey, string_agg('P' || l_partkey, chr(10) ORDER BY l_linenumber, 'P' || l_partkey) AS parts,
       coalesce(string_agg(CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey AS VARCHAR) END, '; ' ORDER BY l_suppkey), 'none') AS returned,
       count(*) AS lines
FROM lineitem GROUP BY l_orderkey
"""


def _rollup_of_hot_groups(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    parts = rollups.rollup_parts(
        events, ["event_type"], F.col("event_id").cast("string"), [F.col("ts")], separator=","
    )
    # where a list is cut depends on the sample behind the ranges, so each element is shown with its place in the whole list: the
    # elements of the parts before come first
    before = Window.partitionBy("event_type").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = parts.withColumn("items", F.split("text", ","))
    placed = listed.withColumn("before", F.coalesce(F.sum(F.size("items")).over(before), F.lit(0)))
    elements = placed.select("event_type", "before", F.posexplode("items").alias("at", "event_id"))
    return elements.select("event_type", (F.col("before") + F.col("at") + 1).cast("long").alias("position"), "event_id")


QUERIES["rollup_of_hot_groups"] = _rollup_of_hot_groups
ORACLES["rollup_of_hot_groups"] = """
SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, CAST(event_id AS VARCHAR)) AS position,
       CAST(event_id AS VARCHAR) AS event_id
FROM events
"""


def _distinct_groups(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem")
    return lines.dropDuplicates(["l_partkey", "l_returnflag"]).select("l_partkey", "l_returnflag")


QUERIES["distinct_groups"] = _distinct_groups
ORACLES["distinct_groups"] = "SELECT l_partkey, l_returnflag FROM lineitem GROUP BY l_partkey, l_returnflag"

# -- text ---------------------------------------------------------------------------------


def _version_keys(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").selectExpr(
        "p_partkey",
        """CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '1..2' WHEN p_size = 3 THEN '1.2.3.4.5' WHEN p_size = 4 THEN '12345678.1'
           WHEN p_size = 5 THEN '000.007' ELSE concat(p_size, '.0', p_partkey, '.', lpad(CAST(p_size AS string), 4, '0')) END AS v""",
    )


_VERSION_SQL = """
v AS (SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '1..2' WHEN p_size = 3 THEN '1.2.3.4.5' WHEN p_size = 4 THEN '12345678.1'
      WHEN p_size = 5 THEN '000.007' ELSE p_size || '.0' || p_partkey || '.' || lpad(CAST(p_size AS VARCHAR), 4, '0') END AS v, p_size FROM part)
"""


def _version_sort_key(spark: SparkSession, sf: str) -> DataFrame:
    versions.register_sql_functions(spark)
    return _version_keys(spark, sf).select(
        "p_partkey",
        versions.version_sort_key("v").alias("sort_key"),
        F.expr("version_sort_key(v)").alias("sort_key_sql"),
        versions.version_sort_key("v", max_parts=None).alias("long_key"),
    )


QUERIES["version_sort_key"] = _version_sort_key
ORACLES["version_sort_key"] = f"""
WITH {_VERSION_SQL},
k AS (SELECT *, list_aggregate([lpad(x, greatest(7, length(x))::INTEGER, '0') FOR x IN string_split(v, '.')], 'string_agg', '.') AS key FROM v)
SELECT p_partkey, CASE WHEN p_size NOT IN (2, 3) THEN key END AS sort_key, CASE WHEN p_size NOT IN (2, 3) THEN key END AS sort_key_sql,
       CASE WHEN p_size <> 2 THEN key END AS long_key
FROM k
"""


def _version_strip(spark: SparkSession, sf: str) -> DataFrame:
    versions.register_sql_functions(spark)
    return _version_keys(spark, sf).select(
        "p_partkey",
        versions.version_strip_zeros("v").alias("stripped"),
        F.expr("version_strip_zeros(v)").alias("sql_stripped"),
        versions.version_strip_zeros(versions.version_sort_key("v")).alias("back"),
    )


QUERIES["version_strip"] = _version_strip
ORACLES["version_strip"] = f"""
WITH {_VERSION_SQL},
k AS (SELECT *, list_aggregate([coalesce(nullif(ltrim(x, '0'), ''), '0') FOR x IN string_split(v, '.')], 'string_agg', '.') AS s FROM v)
SELECT p_partkey, CASE WHEN p_size NOT IN (2, 3) THEN s END AS stripped, CASE WHEN p_size NOT IN (2, 3) THEN s END AS sql_stripped, CASE WHEN p_size NOT IN (2, 3) THEN s END AS back FROM k
"""


def _string_cuts(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages")
    url, html = F.col("url"), F.col("html")
    return pages.select(
        "page_id",
        text.index_of("/", "url").alias("at"),
        text.index_of("/", "url", 9).alias("at_from_nine"),
        text.index_of("", "url").alias("at_nothing"),
        text.index_of(F.substring("url", 1, 4), "html").alias("at_column"),
        text.before_first(url, "?").alias("before"),
        text.after_first(url, "?", F.lit("None")).alias("after"),
        text.after_last(url, "/").alias("leaf"),
        text.strip_prefix(url).alias("whole"),
        text.leading(url, F.locate("#", url) - 1).alias("lead"),
        text.second_segment(text.before_first(text.after_first(url, "//"), "/")).alias("segment"),
        text.split_pick(url, "/", 4).alias("piece"),
        text.path_leaf(F.concat(F.lit("a\\"), url)).alias("path_leaf"),
        F.length(text.strip_tags(html)).alias("plain_length"),
        F.length(text.remove_all(html, ["<p>", "</p>"])).alias("cut_length"),
        F.md5(text.xml_escape(html)).alias("escaped"),
        text.without_apostrophes(F.concat(F.lit("'"), url, F.lit("'"))).alias("bare"),
        text.unc_share(url).alias("share"),
    )


QUERIES["string_cuts"] = _string_cuts
ORACLES["string_cuts"] = r"""
SELECT page_id, CAST(strpos(url, '/') AS INTEGER) AS at, CAST(strpos(substr(url, 9), '/') + CASE WHEN strpos(substr(url, 9), '/') > 0 THEN 8 ELSE 0 END AS INTEGER) AS at_from_nine,
       0 AS at_nothing, CAST(strpos(html, left(url, 4)) AS INTEGER) AS at_column,
       split_part(url, '?', 1) AS before, CASE WHEN contains(url, '?') THEN substr(url, strpos(url, '?') + 1) ELSE 'None' END AS after,
       split_part(url, '/', -1) AS leaf, url AS whole, CASE WHEN contains(url, '#') THEN left(url, strpos(url, '#') - 1) END AS lead,
       CASE WHEN len(string_split(split_part(url, '/', 3), '.')) >= 3 THEN split_part(split_part(url, '/', 3), '.', 2)
            WHEN len(string_split(split_part(url, '/', 3), '.')) = 2 THEN '' END AS segment,
       string_split(url, '/')[5] AS piece, split_part(url, '/', -1) AS path_leaf,
       CAST(length(regexp_replace(html, '<[^>]+>', '', 'g')) AS INTEGER) AS plain_length,
       CAST(length(replace(replace(html, '<p>', ''), '</p>', '')) AS INTEGER) AS cut_length,
       md5(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS escaped,
       replace(url, '''', '') AS bare, substr(url, 5, 200) AS share
FROM pages
"""


def _digit_span(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part").withColumn(
        "caption",
        F.expr("CASE p_type WHEN 'PROMO' THEN p_name WHEN 'SMALL' THEN concat(p_size, 'x') WHEN 'LARGE' THEN concat(p_name, ' ', p_size) ELSE concat(p_name, ' v', p_size, '.', p_partkey, ' R2 x') END"),
    )
    return part.select("p_partkey", text.digit_span("caption").alias("span"), codes.os_family("caption").alias("family"))


QUERIES["digit_span"] = _digit_span
ORACLES["digit_span"] = """
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN '' WHEN 'SMALL' THEN '' WHEN 'LARGE' THEN CAST(p_size AS VARCHAR) ELSE p_size || '.' || p_partkey END AS span,
       'Windows ' AS family
FROM part
"""


def _service_text(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part").selectExpr(
        "p_partkey",
        f"""concat('"C:/p/MSSQL', 8 + p_size, '/', p_partkey, '.exe', CASE WHEN p_size > 25 THEN '" -sX' ELSE '"' END) AS path""",
        "CASE WHEN p_size < 10 THEN 'SQL Server (MSSQLSERVER)' WHEN p_size < 40 THEN concat('SQL Server (I', p_size, ')') ELSE p_name END AS shown",
        "CASE WHEN p_size < 20 THEN concat('1.05.', p_size, ' (a)') WHEN p_size < 30 THEN '2.0(b)' ELSE '3.0' END AS build",
        "CASE WHEN p_size < 10 THEN 'AMD x' WHEN p_size < 30 THEN concat('CPU @ 2.', p_size, 'GHz more') ELSE 'Other' END AS cpu",
    )
    return part.select(
        "p_partkey",
        text.quoted_path("path").alias("binary"),
        text.instance_name("shown", codes.DEFAULT_INSTANCE).alias("instance"),
        text.short_build("build").alias("build"),
        text.cpu_text("cpu", F.lit(8)).alias("cpu"),
        text.trustee(F.expr("nullif(cpu, 'Other')"), F.expr("nullif(cpu, 'AMD x')")).alias("trustee"),
    )


QUERIES["service_text"] = _service_text
ORACLES["service_text"] = """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'C:/p/MSSQL' || (8 + p_size) || '/' || p_partkey || '.exe' END AS binary,
       CASE WHEN p_size < 10 THEN 'Default' WHEN p_size < 40 THEN 'I' || p_size ELSE p_name END AS instance,
       CASE WHEN p_size < 20 THEN '1.5.' || p_size WHEN p_size < 30 THEN NULL ELSE '3.0' END AS build,
       CASE WHEN p_size < 10 THEN 'AMD' WHEN p_size < 30 THEN left('2.' || p_size || 'GHz more', 7) ELSE 'ther' END || ' (Cores:8)' AS cpu,
       CASE WHEN p_size < 10 THEN 'NOT_RESOLVED' WHEN p_size < 30 THEN 'CPU @ 2.' || p_size || 'GHz more' || chr(92) || 'CPU @ 2.' || p_size || 'GHz more' ELSE 'Other' END AS trustee
FROM part
"""

# -- numbers and times --------------------------------------------------------------------


def _unit_text(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "CAST(l_quantity AS bigint) AS n")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.ceil_text(F.col("n") * 100).alias("gigabytes"),
        numbers.one_decimal(F.col("n") * 12345 / F.lit(8)).alias("tenths"),
        numbers.percent_text(F.col("n"), F.lit(64)).alias("percent"),
        numbers.percent_text("n", F.lit(0)).alias("no_percent"),
        numbers.complement("n").alias("used"),
        numbers.mbit("n").alias("rate"),
        numbers.megabytes(F.col("n") * 1048576 / 8).alias("megabytes"),
        numbers.mask_names("n", {1: "a", 2: "b", 6: "c", 48: "d"}).alias("flags"),
    )


QUERIES["unit_text"] = _unit_text
ORACLES["unit_text"] = """
SELECT l_orderkey, l_linenumber, l_partkey, (n * 100 + 1023) // 1024 || 'GB' AS gigabytes,
       format('{:,}', (n * 12345 * 10 * 2 + 8) // 16 // 10) || '.' || ((n * 12345 * 10 * 2 + 8) // 16) % 10 AS tenths,
       ((n * 1000 * 2 + 64) // 128) // 10 || '.' || ((n * 1000 * 2 + 64) // 128) % 10 || '%' AS percent,
       CAST(NULL AS VARCHAR) AS no_percent, 100 - n AS used, n * 8 / 1048576 AS rate, round_even(n / 8, 2) AS megabytes,
       concat_ws(', ', CASE WHEN n & 1 = 1 THEN 'a' END, CASE WHEN n & 2 = 2 THEN 'b' END, CASE WHEN n & 6 = 6 THEN 'c' END, CASE WHEN n & 48 = 48 THEN 'd' END) AS flags
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS n FROM lineitem)
"""


def _disk_space(spark: SparkSession, sf: str) -> DataFrame:
    disks = load(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "floor(o_totalprice) * 1000000 AS size",
        "floor(o_totalprice) * month(o_orderdate) * 50000 AS free",
        "floor(o_totalprice) * 7000 AS freed",
    )
    return disks.select(
        "o_orderkey", *numbers.disk_space("size", "free"), numbers.megabytes("freed").alias("freed_megabytes")
    )


QUERIES["disk_space"] = _disk_space
ORACLES["disk_space"] = """
WITH d AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS p, month(o_orderdate) AS m FROM orders)
SELECT o_orderkey, format('{:,.1f}', round(p * 1000000 / 1073741824, 1)) AS size_gb,
       format('{:,.1f}', round(p * m * 50000 / 1073741824, 1)) AS free_space_gb, format('{:,}', p * m * 50000) || '.0' AS free_space,
       CASE WHEN p <> 0 THEN m * 5 || '.0%' END AS percent_free, round_even(p * 7000 / 1048576, 2) AS freed_megabytes
FROM d
"""


def _multi_layout_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS int), CAST(o_orderkey % 60 AS int)) AS t",
        "o_orderkey % 6 AS layout",
    ).withColumn(
        "written",
        F.expr("""CASE layout WHEN 0 THEN date_format(t, 'yy.MM.dd HH:mm') WHEN 1 THEN date_format(t, 'dd.MM.yyyy HH:mm')
                  WHEN 2 THEN date_format(t, 'MM/dd/yyyy HH:mm:ss') WHEN 3 THEN date_format(t, 'M/d/yyyy h:mm:ss a')
                  WHEN 4 THEN date_format(t, 'dd-MM-yyyy HH:mm:ss') ELSE concat('on ', o_orderkey) END"""),
    )
    parsed = times.parse_mixed("written")
    return orders.select(
        "o_orderkey",
        parsed.alias("parsed"),
        times.shift_hours(parsed).alias("shifted"),
        times.day_of(parsed).alias("day"),
        times.hour_of(parsed).alias("hour"),
        times.minute_text(parsed).alias("minute_text"),
        times.second_text(parsed).alias("second_text"),
        times.parse_iso_day(F.date_format("t", "yyyy-MM-dd HH:mm")).alias("iso_day"),
    )


QUERIES["multi_layout_dates"] = _multi_layout_dates
ORACLES["multi_layout_dates"] = """
WITH o AS (SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS t0 FROM orders),
p AS (SELECT *, CASE WHEN o_orderkey % 6 <> 5 THEN t0 END AS t FROM o)
SELECT o_orderkey, t AS parsed, t + INTERVAL 3 HOUR AS shifted, CAST(date_trunc('day', t) AS TIMESTAMP) AS day, date_trunc('hour', t) AS hour,
       strftime(t, '%d.%m.%Y %H:%M') AS minute_text, strftime(t, '%d.%m.%Y %H:%M:%S') AS second_text,
       CAST(date_trunc('day', t0) AS TIMESTAMP) AS iso_day
FROM p
"""
