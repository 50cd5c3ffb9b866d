"""Reports and operators over texts that compare as the source databases do: without case and trailing blanks.

The same texts stand in several spellings in the tables below. Which spelling is shown is open, so results are shown
lower-cased and trimmed, as plain text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fleetquarry.bindings.common import load
from fleetquarry.operators.latest import dense_rank_of, top_rank
from fleetquarry.operators.snapshots import insert_new
from fleetquarry.plans.collections import device_collections
from fleetquarry.plans.compliance import cve_supersedence
from fleetquarry.session import shared_dir
from fleetquarry.sources.tables import COLLATION, collated, schema_of, tables

QUERIES, ORACLES = {}, {}


def _spelled(text: str, by: str) -> Column:
    """One of four spellings of a text, by a number."""
    return F.expr(f"CASE {by} % 4 WHEN 0 THEN upper({text}) WHEN 1 THEN lower({text}) WHEN 2 THEN concat({text}, '  ') ELSE {text} END")


def _shown(df: DataFrame) -> DataFrame:
    text = lambda name: F.lower(F.rtrim(F.col(name).cast("string"))).alias(name)
    return df.select(*[text(f.name) if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema])


def _landed(spark: SparkSession, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Written as parquet with the declared plain schemas, read back under the collation."""
    root = shared_dir(spark, "collated")
    for name, frame in frames.items():
        typed = [
            (F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema_of(name)
        ]
        frame.select(*typed).write.parquet(f"{root}/{name}")
    return tables(spark, root, frames, collation=COLLATION)


def _collated_collections(spark: SparkSession, sf: str) -> DataFrame:
    """Collection ids are joined although each table spells them its own way."""
    nation = load(spark, sf, "nation")
    t = _landed(spark, {
        "full_collection_membership": load(spark, sf, "customer").select(
            _spelled("concat('Nation', c_nationkey)", "c_custkey").alias("collection_id"), F.col("c_name").alias("name")
        ),
        "collection": nation.select(
            _spelled("concat('Nation', n_nationkey)", "(n_nationkey + 1)").alias("collection_id"), F.col("n_name").alias("name"),
            F.lit("2024-01-01 00:00:00").alias("last_refresh"),
        ),
        "folder_member": nation.select(
            _spelled("concat('Nation', n_nationkey)", "(n_nationkey + 2)").alias("instance_key"),
            F.col("n_regionkey").alias("container_node_id"), F.lit(5000).alias("object_type"),
        ),
        "folder": load(spark, sf, "region").selectExpr("r_regionkey AS container_node_id", "r_name AS name"),
    })
    return _shown(device_collections(*t.values(), ordered=False))


QUERIES["collated_collections"] = _collated_collections
ORACLES["collated_collections"] = """
SELECT lower(c_name) AS member, 'nation' || n_nationkey AS collection_id, lower(n_name) AS collection_name, CAST(NULL AS VARCHAR) AS comment,
       lower(r_name) AS folder_name, TIMESTAMP '2024-01-01 00:00:00' AS last_refresh
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey
"""


def _collated_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles and vulnerabilities in several spellings: made distinct and joined as one each."""
    part = load(spark, sf, "part")
    t = _landed(spark, {
        "update_info": part.select(F.col("p_partkey").cast("int").alias("ci_id"), _spelled("concat('KB', p_partkey)", "p_size").alias("article_id")),
        "cve_article": load(spark, sf, "lineitem").select(
            _spelled("concat('Cve-', l_suppkey)", "l_linenumber").alias("cve"), _spelled("concat('Kb', l_partkey)", "l_orderkey").alias("article")
        ),
        "ci_relation": part.where("p_partkey % 3 = 0").selectExpr(
            "CAST(p_partkey - 1 AS int) AS ci_id", "CAST(p_partkey AS int) AS referenced_ci_id", "CAST(p_size % 7 AS int) AS relation_type"
        ),
    })
    return _shown(cve_supersedence(*t.values()))


QUERIES["collated_articles"] = _collated_articles
ORACLES["collated_articles"] = """
WITH f AS (SELECT DISTINCT 'cve-' || l_suppkey AS cve, 'kb' || l_partkey AS article_id, l_partkey AS ci_id FROM lineitem JOIN part ON p_partkey = l_partkey),
e AS (SELECT p_partkey - 1 AS ci_id, p_partkey AS referenced_ci_id FROM part WHERE p_partkey % 3 = 0 AND p_size % 7 = 6)
SELECT cve, article_id, article_id AS newer_article_id, CAST(ci_id AS INTEGER) AS ci_id FROM f
UNION
SELECT cve, article_id, CASE WHEN p_partkey IS NOT NULL THEN 'kb' || e.ci_id END, CAST(p_partkey AS INTEGER)
FROM e JOIN f ON f.ci_id = e.referenced_ci_id LEFT JOIN part ON p_partkey = e.ci_id
"""


def _spelled_lines(spark: SparkSession, sf: str) -> DataFrame:
    return collated(load(spark, sf, "lineitem").select(
        _spelled("nullif(l_returnflag, 'N')", "l_linenumber").alias("severity"),
        _spelled("concat('Kb', l_partkey)", "l_orderkey").alias("article"),
        _spelled("concat('Line ', l_linestatus)", "(l_orderkey + l_linenumber)").alias("impact"),
        "l_shipdate",
    ))


def _collated_insert(spark: SparkSession, sf: str) -> DataFrame:
    """The known rows are found again in other spellings, NULL and blanks included; the rest is appended once."""
    lines = _spelled_lines(spark, sf)
    known = lines.filter("l_shipdate < TIMESTAMP_NTZ'1997-01-01 00:00:00'").drop("l_shipdate")
    known = known.withColumn("severity", F.coalesce("severity", F.lit(" ")))
    return _shown(insert_new(known, lines.drop("l_shipdate"), ["severity", "article", "impact"]))


QUERIES["collated_insert"] = _collated_insert
ORACLES["collated_insert"] = """
WITH s AS (SELECT lower(nullif(l_returnflag, 'N')) AS severity, 'kb' || l_partkey AS article, 'line ' || lower(l_linestatus) AS impact, l_shipdate FROM lineitem)
SELECT DISTINCT severity, article, impact FROM s
WHERE NOT EXISTS (SELECT 1 FROM s k WHERE k.l_shipdate < TIMESTAMP '1997-01-01 00:00:00'
  AND coalesce(k.severity, '') = coalesce(s.severity, '') AND k.article = s.article AND k.impact = s.impact)
"""


def _collated_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks within groups and by values that are each spelled in several ways; equal spellings share a rank."""
    lines = collated(load(spark, sf, "lineitem").select(
        "l_orderkey", _spelled("concat('Line ', l_linenumber)", "l_suppkey").alias("line"),
        _spelled("concat('Sup', l_suppkey % 50)", "l_orderkey").alias("supplier"),
    ))
    ranked = dense_rank_of(lines, ["line"], "supplier", "rank", descending=True)
    return _shown(ranked.unionByName(top_rank(lines, ["line"], "supplier").withColumn("rank", F.lit(0))))


QUERIES["collated_ranks"] = _collated_ranks
ORACLES["collated_ranks"] = """
WITH l AS (SELECT l_orderkey, 'line ' || l_linenumber AS line, 'sup' || (l_suppkey % 50) AS supplier FROM lineitem),
r AS (SELECT *, dense_rank() OVER (PARTITION BY line ORDER BY supplier DESC) AS rank, min(supplier) OVER (PARTITION BY line) AS least FROM l)
SELECT l_orderkey, line, supplier, CAST(rank AS INTEGER) AS rank FROM r
UNION ALL SELECT l_orderkey, line, supplier, 0 FROM r WHERE supplier = least
"""
