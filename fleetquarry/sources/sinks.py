"""Writers. A rerun of any of them after a lost executor or driver gives the same files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.operators.snapshots import insert_new
from fleetquarry.session import exists, remove, shared_dir
from fleetquarry.sources.files import BUILD_SCHEMA, MANIFEST_SCHEMA


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def write_builds(df: DataFrame, path: str) -> None:
    """The pipe-delimited build list, without header or quotes."""
    columns = [F.coalesce(c, F.lit("")).alias(c) for c in _names(BUILD_SCHEMA)]
    df.select(*columns).write.mode("overwrite").csv(path, sep="|", quote="", emptyValue="")


def write_manifest(df: DataFrame, path: str) -> None:
    """The current download set as a new manifest; never over the one being read."""
    df.select(*_names(MANIFEST_SCHEMA)).write.mode("errorifexists").csv(path, header=True)


def write_version(df: DataFrame, root: str, version: int) -> str:
    """The next version of a state table in its own folder; the previous one stays intact."""
    path = f"{root.rstrip('/')}/v{version:08d}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_version(spark: SparkSession, root: str, version: int, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/v{version:08d}")


def append_new(target: DataFrame, batch: DataFrame, keys: Sequence[str], path: str) -> None:
    """Append unseen rows of ``batch`` as a new folder ``path`` of the target table."""
    insert_new(target, batch, keys).write.mode("overwrite").parquet(path)


def write_html_rows(df: DataFrame, path: str, html: str = "html") -> None:
    """One HTML table row per line; the page around them is the mail job's business."""
    df.select(html).write.mode("overwrite").text(path)


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back, for plans that read it often.

    The copy survives lost executors and keeps column pruning and filter pushdown. With a ``path`` of its own,
    named by the run, a complete copy that is there already is read and not written again; ``discard``
    removes it when the run is over.
    """
    spark = df.sparkSession
    if path is None:
        path = shared_dir(spark, name)
    if not exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a materialised copy; nothing happens where there is none."""
    remove(spark, path)
