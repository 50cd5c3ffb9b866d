"""Landed HTML: table rows, links, and the build list found in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.functions.text import ColumnOrName, as_column, split_pick, strip_tags, xml_escape

_ROW = r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr>"
_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]*)[^>]*>(.*?)</a>"""


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as one page per row."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "html")


def html_table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per table row: its position on the page and its inner HTML."""
    rows = F.regexp_extract_all(F.col(html), F.lit(_ROW), F.lit(1))
    return pages.select(*[c for c in pages.columns if c != html], F.posexplode(rows).alias("row", "inner_html"))


def html_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per link: position, address and text without tags."""
    page = F.col(html)
    pairs = F.arrays_zip(
        F.regexp_extract_all(page, F.lit(_LINK), F.lit(1)).alias("href"),
        F.regexp_extract_all(page, F.lit(_LINK), F.lit(2)).alias("text"),
    )
    exploded = pages.select(
        *[c for c in pages.columns if c != html], F.posexplode(pairs).alias("link", "pair")
    )
    return exploded.select(
        *[c for c in exploded.columns if c != "pair"],
        F.col("pair.href").alias("href"),
        F.trim(strip_tags("pair.text")).alias("text"),
    )


def first_link(links: DataFrame, page_key: str, text: str) -> DataFrame:
    """Address of the first link of each page whose text is ``text``."""
    hit = links.filter(F.lower("text") == text.lower())
    return hit.groupBy(page_key).agg(F.min_by("href", "link").alias("href"))


def builds_from_rows(rows: DataFrame, inner_html: str = "inner_html") -> DataFrame:
    """Build list columns from table rows, picked by line and piece of the row's HTML."""

    def line(position: int) -> Column:
        return F.trim(F.regexp_replace(split_pick(inner_html, "\n", position), "\r", ""))

    version = split_pick(line(2), ">", 1)
    name = split_pick(line(5), ">", 2)
    return rows.select(
        strip_tags(line(0)).alias("build"),
        version.alias("file_version"),
        split_pick(version, ".", 0).alias("sql_version"),
        strip_tags(line(4)).alias("kb"),
        split_pick(line(5), '"', 1).alias("link"),
        F.btrim(name, F.lit("</A")).alias("update_name"),
        split_pick(line(6), '"', 3).alias("release_date"),
    )


def html_row(*cells: ColumnOrName, css_class: str = "tg-0pky", escaped: bool = True) -> Column:
    """A table row of the given cells; NULL cells are empty, text is escaped unless told not to."""
    parts = []
    for cell in cells:
        text = F.coalesce(as_column(cell).cast("string"), F.lit(""))
        parts += [
            F.lit(f'<td class="{css_class}">'),
            xml_escape(text) if escaped else text,
            F.lit("</td>"),
        ]
    return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))
