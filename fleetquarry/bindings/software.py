"""Update feed, server builds, downloads, cache and retention on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.bindings.common import load
from fleetquarry.functions.versions import version_from_file
from fleetquarry.operators.upkeep import (
    Policy,
    catalog_files,
    current_manifest,
    evictable,
    eviction_totals,
    new_downloads,
    new_versions,
    retention_report,
)
from fleetquarry.plans.linux_updates import linux_update_compliance
from fleetquarry.plans.servers import build_list, server_version_compliance
from fleetquarry.sources.files import update_packages, update_references, updates_from_text
from fleetquarry.sources.html import first_link, html_links, html_table_rows

QUERIES, ORACLES = {}, {}

# -- update feed ------------------------------------------------------------------------

# every part is one update: two parts share a package name, one type has no packages,
# one type ships a second package, brands decide the vulnerabilities
_UPDATE_XML = """
concat('<update status="final" type="', p_type, '"><id>RH-', p_partkey, '</id><title>', p_name,
  '</title><issued date="20', 10 + p_size % 10, '-03-', 10 + p_size % 19, ' 08:00:00"/>',
  CASE WHEN p_size % 2 = 0 THEN concat('<references><reference href="http://x/CVE-', p_partkey, '" id="CVE-', p_partkey,
       '" type="cve"/><reference href="http://x/bug" id="BZ-1"/></references>') ELSE '<references/>' END,
  CASE WHEN p_type = 'LARGE' THEN '' ELSE concat('<pkglist><collection><package name="lib', p_partkey DIV 2,
       '" version="1.', p_partkey % 2, '" release="1"><filename>lib', p_partkey DIV 2, '-1.', p_partkey % 2,
       '-1.x86_64.rpm</filename></package>',
       CASE WHEN p_type = 'PROMO' THEN concat('<package name="lib', p_partkey DIV 2, '-devel" version="1.0" release="1"><filename>lib',
            p_partkey DIV 2, '-devel-1.0-1.noarch.rpm</filename></package>') ELSE '' END,
       '</collection></pkglist>') END,
  '</update>')
"""

_FEED_SQL = """
upd AS (
  SELECT p_partkey AS k, 'RH-' || p_partkey AS id, p_type AS type, p_name AS title,
         '20' || (10 + p_size % 10) || '-03-' || (10 + p_size % 19) || ' 08:00:00' AS date,
         p_size % 2 = 0 AS has_cve
  FROM part),
pkg AS (
  SELECT upd.*, 'lib' || k // 2 AS name, '1.' || k % 2 AS version, '1' AS release,
         'lib' || k // 2 || '-1.' || k % 2 || '-1' AS file FROM upd WHERE type <> 'LARGE'
  UNION ALL
  SELECT upd.*, 'lib' || k // 2 || '-devel', '1.0', '1', 'lib' || k // 2 || '-devel-1.0-1' FROM upd WHERE type = 'PROMO'
  UNION ALL
  SELECT upd.*, NULL, NULL, NULL, NULL FROM upd WHERE type = 'LARGE')
"""


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    xml = load(spark, sf, "part").selectExpr(f"{_UPDATE_XML} AS xml")
    return updates_from_text(xml, "xml")


def _xml_packages(spark: SparkSession, sf: str) -> DataFrame:
    return update_packages(_updates(spark, sf))


QUERIES["xml_packages"] = _xml_packages
ORACLES["xml_packages"] = f"""
WITH {_FEED_SQL}
SELECT 'final' AS status, type, id, title, date, name, version, release, file AS file_name FROM pkg
"""


def _xml_references(spark: SparkSession, sf: str) -> DataFrame:
    return update_references(_updates(spark, sf))


QUERIES["xml_references"] = _xml_references
ORACLES["xml_references"] = f"""
WITH {_FEED_SQL}
SELECT id, 'CVE-' || k AS cve, 'http://x/CVE-' || k AS cve_link FROM upd WHERE has_cve
UNION ALL SELECT id, 'BZ-1', 'http://x/bug' FROM upd WHERE has_cve
UNION ALL SELECT id, NULL, NULL FROM upd WHERE NOT has_cve
"""


def _linux_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    system = load(spark, sf, "orders").selectExpr(
        "o_orderkey AS resource_id",
        "concat('PC', o_orderkey) AS netbios_name",
        "CASE WHEN o_orderstatus = 'P' THEN 5 ELSE 13 END AS agent_edition",
    )
    programs = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS resource_id",
        "concat('lib', l_partkey DIV 2, '-1.', l_linenumber % 3, '-1.', "
        "CASE WHEN l_linestatus = 'F' THEN 'x86_64' ELSE 'i686' END) AS display_name",
        "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN '9.9' ELSE concat('1.', l_linenumber % 3) END AS version",
        "l_returnflag AS publisher",
        "CASE WHEN l_returnflag = 'R' THEN 'unknown' ELSE date_format(l_shipdate, 'yyyyMMdd') || '000000' END AS install_date",
        "l_shipdate AS time_stamp",
    )
    return system, programs


def _linux_update_compliance(spark: SparkSession, sf: str) -> DataFrame:
    return linux_update_compliance(*_linux_tables(spark, sf), _updates(spark, sf))


QUERIES["linux_update_compliance"] = _linux_update_compliance
ORACLES["linux_update_compliance"] = f"""
WITH {_FEED_SQL},
newest AS (
  SELECT * FROM (SELECT *, max(date) OVER (PARTITION BY name) AS top FROM pkg WHERE name IS NOT NULL) WHERE date = top),
inst AS (
  SELECT l_orderkey AS dev, 'PC' || l_orderkey AS host, l_shipdate AS stamp,
         'lib' || l_partkey // 2 AS lib, l_linenumber % 3 AS v, l_returnflag AS pub,
         CASE WHEN l_returnflag = 'R' THEN 'unknown' ELSE strftime(l_shipdate, '%Y%m%d') || '000000' END AS itext,
         CASE WHEN l_returnflag <> 'R' THEN date_trunc('day', l_shipdate) END AS idate,
         l_returnflag = 'A' AND l_linenumber = 7 AS lost
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'),
named AS (
  SELECT *, lib || '-1.' || v || '-1' AS disp, CASE WHEN NOT lost THEN lib END AS pname,
         CASE WHEN lost THEN lib || '-1.' || v || '-1' ELSE '1.' || v || '-1' END AS tail,
         CASE WHEN lost THEN '9.9' ELSE '1.' || v END AS ver
  FROM inst),
filed AS (
  SELECT n.*, f.date AS fdate FROM named n LEFT JOIN (SELECT DISTINCT file, date, name FROM pkg) f ON f.file = n.disp),
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY pname, host ORDER BY CAST(left(fdate, 10) AS DATE) DESC NULLS LAST) AS rnk FROM filed),
closing AS (SELECT DISTINCT name, date, 'CVE-' || k AS cve, 'http://x/CVE-' || k AS link FROM pkg WHERE has_cve)
SELECT dev AS resource_id, host AS netbios_name, stamp AS time_stamp, disp AS display_name, pname AS name,
       tail AS current_version, itext AS install_text, CAST(idate AS TIMESTAMP) AS install_date, pub AS publisher, ver AS version,
       u.version || '-' || u.release AS actual_version, u.file AS actual_file_name,
       CASE WHEN u.name IS NOT NULL THEN CASE WHEN disp <> u.file THEN '1' ELSE '0' END END AS update_required,
       u.id, CASE WHEN u.id IS NOT NULL THEN 'final' END AS status, u.type, u.title,
       CAST(left(u.date, 10) AS TIMESTAMP) AS release_date, CAST(left(fdate, 10) AS TIMESTAMP) AS file_release_date,
       cve, link AS cve_link, CAST(left(c.date, 10) AS TIMESTAMP) AS cve_closing_date,
       CASE WHEN cve IS NOT NULL THEN CASE WHEN fdate < c.date THEN '1' ELSE '0' END END AS cve_is_open,
       CAST(rnk AS INTEGER) AS current_version_rank
FROM ranked r LEFT JOIN newest u ON u.name = r.pname LEFT JOIN closing c ON c.name = u.name
"""

# -- server builds ------------------------------------------------------------------------

_FOLDER = (
    "CASE l_linenumber WHEN 1 THEN 'MSSQL10_50' WHEN 2 THEN 'MSSQL10' WHEN 3 THEN 'MSSQL11' WHEN 4 THEN 'MSSQL12' "
    "WHEN 5 THEN 'MSSQL13' WHEN 6 THEN 'MSSQL14' ELSE 'MSSQL15' END"
)
_B = "\\\\"  # one backslash in Spark SQL text


def _server_version_compliance(spark: SparkSession, sf: str) -> DataFrame:
    orders, lineitem = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    system = orders.selectExpr(
        "o_orderkey AS resource_id",
        "concat('PC', o_orderkey) AS netbios_name",
        "o_orderpriority AS resource_domain",
        "CASE WHEN o_orderstatus = 'P' THEN 'Windows 10' ELSE 'Windows Server' END AS os_name_and_version",
    )
    computer = orders.selectExpr("o_orderkey AS resource_id")
    units = orders.selectExpr(
        "o_orderkey AS resource_id",
        "explode(array(concat('corp/', o_orderpriority), concat('zone', o_orderstatus), concat('a/b/', o_custkey))) AS ou_name",
    )
    service = lineitem.selectExpr(
        "l_orderkey AS resource_id",
        "concat('MSSQL$', l_linenumber) AS name",
        "CASE l_returnflag WHEN 'A' THEN 'SQL Server (MSSQLSERVER)' WHEN 'N' THEN concat('SQL Server (I', l_linenumber, ')') "
        "ELSE 'SQL Server Agent' END AS display_name",
        "'Auto' AS start_mode",
        "concat('svc', l_linenumber) AS start_name",
        f"""concat('"C:{_B}Apps{_B}', {_FOLDER}, '.', l_linenumber, '{_B}sqlservr.exe"',
            CASE WHEN l_linestatus = 'F' OR l_linenumber > 2 THEN ' -sI' ELSE ' /x' END) AS path_name""",
    )
    files = (
        lineitem.select("l_orderkey", "l_linenumber")
        .distinct()
        .selectExpr(
            "l_orderkey AS resource_id",
            f"concat('C:{_B}Apps{_B}', {_FOLDER}, '.', l_linenumber, '{_B}') AS file_path",
            "'sqlservr.exe' AS file_name",
            "CASE WHEN l_linenumber % 2 = 1 THEN concat('20', 10 + l_linenumber, '.0110.50', l_linenumber, '.00 ((Main).1)') "
            "ELSE concat('20', 10 + l_linenumber, '.0.1') END AS file_version",
        )
    )
    os = orders.selectExpr("o_orderkey AS resource_id", "'Microsoft Windows Server 2012' AS caption")
    scans = orders.selectExpr("o_orderkey AS machine_id", "o_orderdate AS last_software_scan")
    builds = load(spark, sf, "part").selectExpr(
        "concat('B', p_partkey) AS build",
        "concat('20', 10 + p_size % 6, '.', p_size, '.', p_partkey) AS file_version",
        "concat('20', 10 + p_size % 6) AS sql_version",
        "concat('KB', p_partkey) AS kb",
        "concat('http://x/', p_partkey) AS link",
        "CASE WHEN p_type = 'PROMO' THEN concat('Beta ', p_name) ELSE p_name END AS update_name",
        "concat('20', 10 + p_size % 6, '-02-03') AS release_date",
    )
    return server_version_compliance(system, computer, units, service, os, files, scans, builds)


QUERIES["server_version_compliance"] = _server_version_compliance
ORACLES["server_version_compliance"] = f"""
WITH b AS (
  SELECT *, '20' || (10 + p_size % 6) AS line, '20' || (10 + p_size % 6) || '.' || p_size || '.' || p_partkey AS fv
  FROM part WHERE p_type <> 'PROMO'),
best AS (SELECT * FROM (SELECT *, max(fv) OVER (PARTITION BY line) AS top FROM b) WHERE fv = top),
svc AS (
  SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag,
         l_linestatus = 'F' OR l_linenumber > 2 AS started, {_FOLDER} AS folder
  FROM lineitem WHERE l_returnflag IN ('A', 'N')),
s2 AS (
  SELECT l_orderkey, l_linenumber, folder, CASE WHEN l_returnflag = 'A' THEN 'MSSQLSERVER' ELSE 'I' || l_linenumber END AS inst,
         CASE WHEN l_linenumber % 2 = 1 THEN '20' || (10 + l_linenumber) || '.0110.50' || l_linenumber || '.00 ((Main).1)'
              ELSE '20' || (10 + l_linenumber) || '.0.1' END AS fv,
         CASE WHEN l_linenumber % 2 = 1 THEN '20' || (10 + l_linenumber) || '.110.50' || l_linenumber || '.0'
              ELSE '20' || (10 + l_linenumber) || '..1' END AS odd_fv
  FROM svc WHERE started)
SELECT DISTINCT 'PC' || o_orderkey AS netbios_name, o_orderpriority AS domain,
       greatest(o_orderpriority, 'zone' || o_orderstatus, 'b/' || o_custkey) AS organizational_unit,
       'Server 2012' AS operating_system, 'MSSQL$' || l_linenumber AS service, 'Auto' AS start_mode,
       'svc' || l_linenumber AS log_on_as, 'SQL Server (' || inst || ')' AS service_name,
       CASE WHEN inst = 'MSSQLSERVER' THEN 'Default' ELSE inst END AS instance,
       '"C:' || chr(92) || 'Apps' || chr(92) || folder || '.' || l_linenumber || chr(92) || 'sqlservr.exe" -sI' AS path_name,
       CASE l_linenumber WHEN 1 THEN 'SQL Server 2008 R2' WHEN 2 THEN 'SQL Server 2008' WHEN 3 THEN 'SQL Server 2012'
            WHEN 4 THEN 'SQL Server 2014' WHEN 5 THEN 'SQL Server 2016' WHEN 6 THEN 'SQL Server 2017' ELSE 'Unknown' END AS sql_version,
       s2.fv AS file_version, CASE WHEN l_linenumber % 2 = 1 THEN odd_fv ELSE s2.fv END AS short_file_version,
       strftime(o_orderdate + INTERVAL 3 HOUR, '%d.%m.%Y %H:%M') AS last_software_scan,
       best.fv AS actual_file_version, 'B' || p_partkey AS actual_build, 'KB' || p_partkey AS kb, p_name AS update_name,
       'http://x/' || p_partkey AS link, CAST(line || '-02-03' AS TIMESTAMP) AS release_date
FROM s2 JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'
LEFT JOIN best ON best.line = left(s2.fv, 4)
"""

# -- landed pages -------------------------------------------------------------------------


def _part_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per part with a head row and two build rows, as a browser lays them out."""
    row = """concat('<tr class="r">\\n<td>15.', p_size, '.', {n}, '</td>\\n<td>x\\n<td>20', 10 + p_size % 6, '.', p_partkey, '.', {n},
        '\\n<td>q</td>\\n<td><b>KB', p_partkey, '</b></td>\\n<td><A href="http://x/', p_partkey, '">', p_name,
        '</A>\\n<td><time class="d" datetime="20', 10 + p_size % 6, '-02-03">\\n</tr>')"""
    # the line breaks around cells are what the positions count, so the row opens with its first cell
    row = row.replace('class="r">\\n<td>15.', 'class="r"><td>15.')
    return load(spark, sf, "part").selectExpr(
        "p_partkey AS page_id",
        f"concat('<html><table>', {row.format(n=1)}, {row.format(n=2)}, '</table></html>') AS html",
    )


def _build_list(spark: SparkSession, sf: str) -> DataFrame:
    return build_list(_part_pages(spark, sf))


QUERIES["build_list"] = _build_list
ORACLES["build_list"] = """
SELECT '15.' || p_size || '.' || n AS build, '20' || (10 + p_size % 6) || '.' || p_partkey || '.' || n AS file_version,
       '20' || (10 + p_size % 6) AS sql_version, 'KB' || p_partkey AS kb, 'http://x/' || p_partkey AS link,
       p_name AS update_name, '20' || (10 + p_size % 6) || '-02-03' AS release_date
FROM part, (VALUES (1), (2)) AS v(n)
"""


def _html_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = html_table_rows(_part_pages(spark, sf))
    # line breaks in the row's text stand for the positions, so they are kept
    return rows.select("page_id", "row", F.regexp_replace("inner_html", "\n", ".").alias("inner_html"))


QUERIES["html_rows"] = _html_rows
ORACLES["html_rows"] = """
SELECT p_partkey AS page_id, CAST(n - 1 AS INTEGER) AS row,
       '<td>15.' || p_size || '.' || n || '</td>.<td>x.<td>20' || (10 + p_size % 6) || '.' || p_partkey || '.' || n
         || '.<td>q</td>.<td><b>KB' || p_partkey || '</b></td>.<td><A href="http://x/' || p_partkey || '">' || p_name
         || '</A>.<td><time class="d" datetime="20' || (10 + p_size % 6) || '-02-03">.' AS inner_html
FROM part, (VALUES (1), (2)) AS v(n)
"""


def _html_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages").select("page_id", "html")
    return html_links(pages).select("page_id", "link", "href", "text")


_LINKS_SQL = """
raw AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']?[^"''\\s>]*[^>]*>.*?</a>')) AS a,
               generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']?[^"''\\s>]*[^>]*>.*?</a>'), 1) - 1 AS n
        FROM pages),
links AS (SELECT page_id, CAST(n AS INTEGER) AS link,
                 regexp_extract(a, '(?is)href\\s*=\\s*["'']?([^"''\\s>]*)', 1) AS href,
                 trim(regexp_replace(regexp_extract(a, '(?is)^<a[^>]*>(.*)</a>$', 1), '<[^>]+>', '', 'g')) AS text FROM raw)
"""
QUERIES["html_links"] = _html_links
ORACLES["html_links"] = f"WITH {_LINKS_SQL} SELECT page_id, link, href, text FROM links"


def _first_link(spark: SparkSession, sf: str) -> DataFrame:
    links = html_links(load(spark, sf, "pages").select("page_id", "html"))
    return first_link(links, "page_id", "The")


QUERIES["first_link"] = _first_link
ORACLES["first_link"] = f"""
WITH {_LINKS_SQL}
SELECT page_id, arg_min(href, link) AS href FROM links WHERE lower(text) = 'the' GROUP BY page_id
"""

# -- versions and downloads ---------------------------------------------------------------


def _new_versions(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    links = part.selectExpr(
        "CASE WHEN p_type = 'LARGE' THEN 'http://x/readme_1.txt' "
        "ELSE concat('http://x/get/Reader', 1000000 + p_partkey, '_MUI.msp') END AS href"
    )
    known = part.filter("p_type = 'PROMO'").select(
        version_from_file(F.expr("concat('R', 1000000 + p_partkey, '_x.msp')")).alias("version")
    )
    return new_versions(links, known)


QUERIES["new_versions"] = _new_versions
ORACLES["new_versions"] = """
SELECT DISTINCT left(d, 2) || '.' || substr(d, 3, 3) || '.' || substr(d, 6) AS version
FROM (SELECT CAST(1000000 + p_partkey AS VARCHAR) AS d FROM part WHERE p_type NOT IN ('LARGE', 'PROMO'))
"""


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    part, lineitem = load(spark, sf, "part"), load(spark, sf, "lineitem")
    updates = part.selectExpr(
        "CAST(p_partkey AS int) AS ci_id",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS date_posted",
        "CASE p_type WHEN 'PROMO' THEN 'Update (64-Bit)' WHEN 'LARGE' THEN 'Update for ACCESS' ELSE concat('Update ', p_name) END AS display_name",
    )
    categories = part.selectExpr(
        "CAST(p_partkey AS int) AS ci_id",
        "CASE WHEN p_size < 25 THEN 'office' ELSE 'other' END AS category_id",
    )
    contents = lineitem.select("l_partkey", "l_suppkey").distinct().selectExpr(
        "CAST(l_partkey AS int) AS ci_id", "concat(l_partkey, '-', l_suppkey) AS content_id"
    )
    files = lineitem.selectExpr(
        "concat(l_partkey, '-', l_suppkey) AS content_id",
        """concat(CASE l_returnflag WHEN 'A' THEN 'word' WHEN 'N' THEN 'Visio' ELSE 'excel' END, l_linenumber,
           CASE WHEN l_linenumber < 3 THEN '-EN-us.cab' WHEN l_linenumber < 5 THEN '-de-de.cab' ELSE '-all.exe' END) AS file_name""",
        "concat('http://X/', l_partkey, '/', l_suppkey, '/', l_orderkey, '/', l_linenumber, '.cab') AS source_url",
    )
    return catalog_files(updates, categories, contents, files, "office")


_CATALOG_SQL = """
cat AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'word' ELSE 'excel' END || l_linenumber
           || CASE WHEN l_linenumber < 3 THEN '-EN-us.cab' ELSE '-all.exe' END AS file_name,
         'http://X/' || l_partkey || '/' || l_suppkey || '/' || l_orderkey || '/' || l_linenumber || '.cab' AS source_url,
         l_linenumber || '.cab' AS leaf, l_linestatus AS ls
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE p_size < 25 AND p_type NOT IN ('PROMO', 'LARGE') AND l_returnflag <> 'N' AND l_linenumber NOT IN (3, 4))
"""


def _new_downloads(spark: SparkSession, sf: str) -> DataFrame:
    manifest = load(spark, sf, "lineitem").filter("l_linestatus = 'F'").selectExpr(
        "lower(concat('http://X/', l_partkey, '/', l_suppkey, '/', l_orderkey, '/', l_linenumber, '.cab')) AS source_url"
    )
    return new_downloads(_catalog(spark, sf), manifest)


QUERIES["new_downloads"] = _new_downloads
ORACLES["new_downloads"] = f"""
WITH {_CATALOG_SQL}, known AS (
  SELECT DISTINCT 'http://X/' || l_partkey || '/' || l_suppkey || '/' || l_orderkey || '/' || l_linenumber || '.cab' AS url
  FROM lineitem WHERE l_linestatus = 'F')
SELECT file_name, source_url, leaf FROM cat WHERE source_url NOT IN (SELECT url FROM known)
"""


def _current_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return current_manifest(_catalog(spark, sf))


QUERIES["current_manifest"] = _current_manifest
ORACLES["current_manifest"] = f"WITH {_CATALOG_SQL} SELECT file_name, source_url FROM cat"

# -- cache and retention ------------------------------------------------------------------


def _evictable(spark: SparkSession, sf: str) -> DataFrame:
    orders, lineitem = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    cache = orders.selectExpr(
        "concat('ID-', o_orderkey) AS content_id",
        "concat('C:/cache/', o_orderkey) AS location",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS persist_in_cache",
        "CASE WHEN month(o_orderdate) = 1 THEN 0 ELSE o_orderkey END AS size_bytes",
    )
    apps = lineitem.filter("l_returnflag = 'A'").selectExpr(
        "concat('app', l_partkey) AS full_name",
        "CASE WHEN l_linenumber < 5 THEN 'Installed' ELSE 'NotInstalled' END AS install_state",
        "l_linestatus = 'F' AS is_machine_target",
        "concat('id-', l_orderkey) AS content_id",
    )
    programs = lineitem.filter("l_returnflag = 'N'").selectExpr(
        "concat('id-', l_orderkey) AS package_id",
        "'p' AS package_name",
        "CASE WHEN l_linestatus = 'F' THEN 'Succeeded' ELSE 'Failed' END AS last_run_status",
        "CASE WHEN l_quantity > 40 THEN 'RerunAlways' END AS repeat_run_behavior",
    )
    updates = lineitem.filter("l_returnflag = 'R'").selectExpr(
        "concat('id-', l_orderkey) AS unique_id",
        "'t' AS title",
        "CASE WHEN l_linestatus = 'F' THEN 'Installed' ELSE 'Missing' END AS status",
    )
    return evictable(cache, apps, programs, updates)


_EVICT_SQL = """
votes AS (
  SELECT l_orderkey AS k,
         coalesce(bool_or(l_returnflag = 'A' AND l_linenumber < 5 AND l_linestatus = 'F'), false) AS app_yes,
         coalesce(bool_or(l_returnflag = 'N' AND l_linestatus = 'F' AND l_quantity <= 40), false) AS pkg_yes,
         coalesce(bool_or(l_returnflag = 'N' AND NOT (l_linestatus = 'F' AND l_quantity <= 40)), false) AS pkg_no,
         coalesce(bool_or(l_returnflag = 'R' AND l_linestatus = 'F'), false) AS upd_yes,
         coalesce(bool_or(l_returnflag = 'A' AND NOT (l_linenumber < 5 AND l_linestatus = 'F')
              OR l_returnflag = 'R' AND l_linestatus <> 'F'), false) AS other_no
  FROM lineitem GROUP BY 1),
evicted AS (
  SELECT 'ID-' || o_orderkey AS content_id, 'C:/cache/' || o_orderkey AS location, o_orderkey AS size_bytes,
         CASE WHEN app_yes THEN 'application' WHEN pkg_yes AND NOT pkg_no THEN 'package' WHEN upd_yes THEN 'update'
              WHEN NOT coalesce(pkg_no OR other_no, false) THEN 'orphan' END AS reason
  FROM orders LEFT JOIN votes ON k = o_orderkey
  WHERE o_orderpriority <> '1-URGENT' AND month(o_orderdate) <> 1 AND o_orderkey > 0)
"""
QUERIES["cache_eviction"] = _evictable
ORACLES["cache_eviction"] = f"""
WITH {_EVICT_SQL}
SELECT content_id, location, size_bytes, reason FROM evicted WHERE reason IS NOT NULL
"""


def _eviction_totals(spark: SparkSession, sf: str) -> DataFrame:
    return eviction_totals(_evictable(spark, sf))


QUERIES["cache_eviction_totals"] = _eviction_totals
ORACLES["cache_eviction_totals"] = f"""
WITH {_EVICT_SQL}
SELECT reason, count(*) AS items, CAST(sum(size_bytes) AS BIGINT) AS bytes,
       round_even(CAST(sum(size_bytes) AS BIGINT) / 1048576, 2) AS megabytes
FROM evicted WHERE reason IS NOT NULL GROUP BY reason
"""

_POLICIES = [
    Policy("C:\\Temp\\Logs\\", days=21),
    Policy("C:\\Windows\\Temp\\", exclude="src7"),
    Policy("C:\\Windows\\logs\\", mask="*.log"),
    Policy("C:\\Users\\*\\AppData\\Temp\\", days=2000),
    Policy("C:\\Nowhere\\"),
]


def _retention_report(spark: SparkSession, sf: str) -> DataFrame:
    files = load(spark, sf, "documents").selectExpr(
        f"""concat('c:{_B}', CASE WHEN lang = 'en' AND doc_id % 2 = 0 THEN 'temp{_B}LOGS{_B}'
            WHEN lang = 'en' THEN 'Windows{_B}Temp{_B}sub{_B}' WHEN lang = 'de' THEN 'Windows{_B}Logs{_B}'
            WHEN doc_id % 3 = 0 THEN 'Users{_B}a{_B}b{_B}AppData{_B}Temp{_B}' ELSE 'Users{_B}joe{_B}AppData{_B}Temp{_B}x{_B}' END,
            source, '-', doc_id, CASE WHEN doc_id % 5 = 0 THEN '.log' ELSE '.txt' END) AS full_name""",
        "n_chars AS length",
        "TIMESTAMP_NTZ'2024-01-31 00:00:00' - make_dt_interval(CAST(doc_id % 40 AS int)) AS last_write_time",
    )
    return retention_report(files, _POLICIES, "2024-01-31 00:00:00")


QUERIES["retention_report"] = _retention_report
ORACLES["retention_report"] = """
WITH f AS (SELECT *, doc_id % 40 AS age FROM documents),
hits AS (
  SELECT 0 AS policy, n_chars FROM f WHERE lang = 'en' AND doc_id % 2 = 0 AND age > 21
  UNION ALL SELECT 1, n_chars FROM f WHERE lang = 'en' AND doc_id % 2 = 1 AND age > 0 AND source NOT LIKE 'src7%'
  UNION ALL SELECT 2, n_chars FROM f WHERE lang = 'de' AND doc_id % 5 = 0 AND age > 0)
SELECT CAST(p.policy AS INTEGER) AS policy, path, mask, CAST(days AS INTEGER) AS days, count(n_chars) AS files,
       CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS bytes, round_even(CAST(coalesce(sum(n_chars), 0) AS BIGINT) / 1048576, 2) AS megabytes
FROM (VALUES (0, 'C:' || chr(92) || 'Temp' || chr(92) || 'Logs' || chr(92), '*.*', 21),
             (1, 'C:' || chr(92) || 'Windows' || chr(92) || 'Temp' || chr(92), '*.*', 0),
             (2, 'C:' || chr(92) || 'Windows' || chr(92) || 'logs' || chr(92), '*.log', 0),
             (3, 'C:' || chr(92) || 'Users' || chr(92) || '*' || chr(92) || 'AppData' || chr(92) || 'Temp' || chr(92), '*.*', 2000),
             (4, 'C:' || chr(92) || 'Nowhere' || chr(92), '*.*', 0)) AS p(policy, path, mask, days)
LEFT JOIN hits USING (policy)
GROUP BY ALL
"""


def _retention_policy_table(spark: SparkSession, sf: str) -> DataFrame:
    """Hundreds of policies from a table: plain folders, wild folders, masks, exclusions."""
    files = load(spark, sf, "documents").selectExpr(
        f"""concat('c:{_B}data{_B}S', doc_id % 50, '{_B}u', doc_id % 7, '{_B}Logs{_B}', source, '-', doc_id,
            CASE WHEN doc_id % 5 = 0 THEN '.log' ELSE '.txt' END) AS full_name""",
        "n_chars AS length",
        "TIMESTAMP_NTZ'2024-01-31 00:00:00' - make_dt_interval(CAST(doc_id % 40 AS int)) AS last_write_time",
    )
    policies = load(spark, sf, "part").withColumn("age", F.col("p_size") % 25).selectExpr(
        "CAST(p_partkey AS int) AS policy",
        f"""CASE p_partkey % 3 WHEN 0 THEN concat('C:{_B}Data{_B}s', p_partkey % 60, '{_B}')
            WHEN 1 THEN concat('C:{_B}DATA{_B}*{_B}U', p_partkey % 9, '{_B}logs')
            ELSE concat('c:{_B}data{_B}s', p_partkey % 50, '{_B}*', p_partkey % 7, '{_B}') END AS path""",
        "CASE WHEN age < 12 THEN '*.*' WHEN age < 20 THEN '*.LOG' END AS mask",
        "CASE WHEN age % 4 = 0 THEN concat(age, '.') END AS exclude",
        "CAST(age AS int) AS days",
    )
    return retention_report(files, policies, "2024-01-31 00:00:00")


QUERIES["retention_policy_table"] = _retention_policy_table
ORACLES["retention_policy_table"] = """
WITH f AS (SELECT *, doc_id % 50 AS s, doc_id % 7 AS u, doc_id % 40 AS age, doc_id % 5 = 0 AS log,
                  'c:' || chr(92) || 'data' || chr(92) || 's' || (doc_id % 50) || chr(92) || 'u' || (doc_id % 7) || chr(92) || 'logs' || chr(92)
                  || lower(source) || '-' || doc_id || CASE WHEN doc_id % 5 = 0 THEN '.log' ELSE '.txt' END AS name FROM documents),
p AS (SELECT p_partkey, p_size % 25 AS days, CASE p_partkey % 3
        WHEN 0 THEN 'C:' || chr(92) || 'Data' || chr(92) || 's' || (p_partkey % 60) || chr(92)
        WHEN 1 THEN 'C:' || chr(92) || 'DATA' || chr(92) || '*' || chr(92) || 'U' || (p_partkey % 9) || chr(92) || 'logs'
        ELSE 'c:' || chr(92) || 'data' || chr(92) || 's' || (p_partkey % 50) || chr(92) || '*' || (p_partkey % 7) || chr(92) END AS path,
        CASE WHEN p_size % 25 < 12 THEN '*.*' WHEN p_size % 25 < 20 THEN '*.LOG' END AS mask FROM part)
SELECT CAST(p_partkey AS INTEGER) AS policy, path, mask, CAST(days AS INTEGER) AS days, count(doc_id) AS files,
       CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS bytes, round_even(CAST(coalesce(sum(n_chars), 0) AS BIGINT) / 1048576, 2) AS megabytes
FROM p LEFT JOIN f ON age > days
  AND CASE p_partkey % 3 WHEN 0 THEN s = p_partkey % 60 WHEN 1 THEN u = p_partkey % 9 ELSE s = p_partkey % 50 AND u = p_partkey % 7 END
  AND (days < 12 OR days >= 20 OR log) AND (days % 4 > 0 OR NOT contains(name, days || '.'))
GROUP BY ALL
"""


def _linux_update_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """A base package on every host: its rows are spread over the tasks."""
    system, programs = _linux_tables(spark, sf)
    base = load(spark, sf, "orders").selectExpr(
        "o_orderkey AS resource_id", "'lib2-1.0-1.x86_64' AS display_name", "'1.0' AS version", "'base' AS publisher",
        "date_format(o_orderdate, 'yyyyMMdd') || '000000' AS install_date", "o_orderdate AS time_stamp",
    )
    return linux_update_compliance(system, programs.unionByName(base), _updates(spark, sf), spread=8)


QUERIES["linux_update_skewed"] = _linux_update_skewed
ORACLES["linux_update_skewed"] = ORACLES["linux_update_compliance"].replace("""
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'),""", """
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, 'PC' || o_orderkey, o_orderdate, 'lib2', 0, 'base', strftime(o_orderdate, '%Y%m%d') || '000000',
         date_trunc('day', o_orderdate), false FROM orders WHERE o_orderstatus <> 'P'),""")
