"""Landed text files: pipe-delimited builds, CSV sheets and manifests, the update feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetquarry.functions.text import remove_all, without_apostrophes
from fleetquarry.functions.times import NTZ

BUILD_SCHEMA = (
    "build string, file_version string, sql_version string, kb string, link string, "
    "update_name string, release_date string"
)
SHEET_SCHEMA = (
    "`Date` string, `Product` string, `Product Family` string, `Platform` string, "
    "`Article` string, `Download` string, `Severity` string, `Impact` string, `Details` string"
)
MANIFEST_SCHEMA = "file_name string, source_url string"

_REFERENCE = T.StructType().add("_id", "string").add("_href", "string")
_PACKAGE = (
    T.StructType()
    .add("_name", "string")
    .add("_version", "string")
    .add("_release", "string")
    .add("filename", "string")
)
# every level is declared as it may repeat: a feed with one package per update must not
# turn the list into a single struct, and versions must stay text
UPDATE_SCHEMA = (
    T.StructType()
    .add("_status", "string")
    .add("_type", "string")
    .add("id", "string")
    .add("title", "string")
    .add("issued", T.StructType().add("_date", "string"))
    .add("references", T.StructType().add("reference", T.ArrayType(_REFERENCE)))
    .add(
        "pkglist",
        T.StructType().add(
            "collection",
            T.ArrayType(T.StructType().add("package", T.ArrayType(_PACKAGE))),
        ),
    )
)
FILE_SUFFIXES = [".x86_64", ".i686", ".noarch"]
PACKAGE_SUFFIXES = [*FILE_SUFFIXES, ".rpm"]


def read_builds(spark: SparkSession, path: str) -> DataFrame:
    """The pipe-delimited build list, every column as text."""
    return spark.read.csv(path, sep="|", schema=BUILD_SCHEMA, quote="")


def read_cve_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The vulnerability sheet, landed as CSV with its header row."""
    return normalise_cve_sheet(spark.read.csv(path, header=True, schema=SHEET_SCHEMA, multiLine=False))


def normalise_cve_sheet(sheet: DataFrame) -> DataFrame:
    """Sheet columns under their table names; article numbers lose stray apostrophes."""
    return sheet.select(
        F.col("Date").try_cast(NTZ).alias("release_date"),
        F.coalesce("Product", F.lit("")).alias("product"),
        F.coalesce("Product Family", F.lit("")).alias("product_family"),
        F.coalesce("Platform", F.lit("")).alias("platform"),
        F.coalesce(without_apostrophes("Article"), F.lit("")).alias("article"),
        F.coalesce("Download", F.lit("")).alias("update_classification"),
        F.coalesce("Severity", F.lit("")).alias("severity"),
        F.coalesce("Impact", F.lit("")).alias("impact"),
        F.coalesce("Details", F.lit("")).alias("cve"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=MANIFEST_SCHEMA)


#: A whole update element; a tag that closes itself has no content. Quoted values may hold any sign.
_UPDATE = r"""(?s)<update(?:\s(?:[^>"']|"[^"]*"|'[^']*')*)?(?:/>|(?<!/)>.*?</update>)"""


def read_updateinfo(spark: SparkSession, path: str) -> DataFrame:
    """The update feed, one row per update element; attributes carry a leading underscore.

    The XML source reads a file in one task. Here a file is cut at the ends of its elements like text at line ends, so one large
    feed is read by many tasks; each holds one element at a time.
    """
    ended = spark.read.text(path, lineSep="</update>").select(F.concat("value", F.lit("</update>")).alias("xml"))
    return _parsed(ended.select(F.explode(F.regexp_extract_all("xml", F.lit(_UPDATE), F.lit(0))).alias("xml")), "xml")


def updates_from_text(df: DataFrame, column: str) -> DataFrame:
    """Update rows from a column that holds one update element per row.

    Reading XML takes far longer than its bytes let expect, so the rows are dealt out to all cores first.
    """
    return _parsed(df.select(column).repartition(4 * df.sparkSession.sparkContext.defaultParallelism), column)


def _parsed(df: DataFrame, column: str) -> DataFrame:
    parsed = df.select(F.from_xml(F.col(column), UPDATE_SCHEMA).alias("u"))
    return parsed.select("u.*")


def update_packages(updates: DataFrame) -> DataFrame:
    """One row per update and package; an update without packages keeps one row."""
    collections = updates.select(
        F.col("_status").alias("status"),
        F.col("_type").alias("type"),
        "id",
        "title",
        F.col("issued._date").alias("date"),
        F.explode_outer("pkglist.collection").alias("collection"),
    )
    packages = collections.withColumn("package", F.explode_outer("collection.package"))
    return packages.select(
        "status",
        "type",
        "id",
        "title",
        "date",
        F.col("package._name").alias("name"),
        F.col("package._version").alias("version"),
        F.col("package._release").alias("release"),
        remove_all("package.filename", PACKAGE_SUFFIXES).alias("file_name"),
    )


def update_references(updates: DataFrame) -> DataFrame:
    """One row per update and reference; an update without references keeps one row."""
    refs = updates.select("id", F.explode_outer("references.reference").alias("reference"))
    return refs.select(
        "id", F.col("reference._id").alias("cve"), F.col("reference._href").alias("cve_link")
    )
