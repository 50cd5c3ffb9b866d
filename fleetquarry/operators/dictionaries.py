"""Codes and bit masks named by dictionary tables, for dictionaries that are not known when the plan is made.

What is looked up are the distinct masks and texts of a column, each taken apart, named by an equi-join, and put together
again in order by one aggregation; the rows themselves are joined to the result once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.functions.text import plain


#: Rows up to which a counted dictionary is sent to every task.
DICTIONARY_ROWS = 50_000


def dictionary(rows: DataFrame) -> DataFrame:
    """A dictionary to join with: broadcast if it has at most DICTIONARY_ROWS rows, which are counted, else as it is.

    Codes are few and some are on most rows, so a shuffle by code would leave most rows to a few tasks.
    """
    return F.broadcast(rows) if rows.limit(DICTIONARY_ROWS + 1).count() <= DICTIONARY_ROWS else rows


def with_mask_names(df: DataFrame, mask: str, names: DataFrame, out: str, separator: str = ", ") -> DataFrame:
    """``df`` with the names of the bits set in ``mask`` as ``out``, lowest bit first.

    ``names(bits, name)`` holds one-bit masks; entries of several bits, or of none, name nothing. A set bit without an entry is shown as its value in
    hexadecimal (0x...). NULL masks and masks of 0 give ''. Repeated entries of a bit are shown each, by name.
    """
    bits = names.select(F.col("bits").cast("long").alias("__bit"), F.col("name").cast("string").alias("__name"))
    bits = bits.where((F.bit_count("__bit") == 1) & F.col("__name").isNotNull()).distinct()
    masks = df.select(F.col(mask).cast("long").alias("__mask")).where("__mask is not null").distinct()
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", F.col("__mask"), i) == 1)
    apart = masks.select("__mask", F.explode(set_bits).alias("__place"))
    apart = apart.withColumn("__value", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__place")))
    named = apart.join(bits, F.col("__value") == F.col("__bit"), "left")
    shown = F.coalesce("__name", F.concat(F.lit("0x"), F.hex("__value")))
    text = _listed(named.withColumn("__shown", shown), "__mask", "__place, __shown", separator)
    joined = df.join(dictionary(text), F.col(mask).cast("long") == F.col("__mask"), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce("__text", F.lit("")).alias(out))


def _listed(rows: DataFrame, key: str, order: str, separator: str) -> DataFrame:
    literal = separator.replace("\\", "\\\\").replace("'", "\\'")
    return rows.groupBy(key).agg(F.expr(f"listagg(__shown, '{literal}') WITHIN GROUP (ORDER BY {order})").alias("__text"))


def with_readable_sd(df: DataFrame, sd: str, names: DataFrame, out: str) -> DataFrame:
    """``df`` with the access entries of security descriptors as ``out``: ``who: type (rights) | ...``, as ``readable_sd`` shows
    them with dictionaries that are known beforehand.

    ``names(kind, code, name)`` holds the kinds "sid", "type" and "rights"; a code that a kind lacks stays as it is. Text without whole
    entries is returned unchanged, NULL stays NULL. Of several names of a code the least counts.
    """
    known = names.where("name IS NOT NULL").groupBy("kind", "code").agg(F.min("name").alias("__name"))
    texts = df.select(plain(sd).alias("__sd")).where("__sd IS NOT NULL").distinct()
    dacl = F.substring_index(F.get(F.split("__sd", "D:"), 1), "S:", 1)
    entries = F.transform(F.regexp_extract_all(dacl, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda e: F.split(e, ";"))
    listed = texts.select("__sd", entries.alias("__entries")).where("size(__entries) > 0 AND NOT exists(__entries, e -> size(e) < 6)")
    apart = listed.select("__sd", F.posexplode("__entries").alias("__at", "__entry"))
    # each part of an entry is a row of its own, in the order in which it is shown
    places = [("sid", 5, ""), ("type", 0, ": "), ("rights", 2, " (")]

    def part(kind: str, place: int, before: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.get("__entry", place).alias("code"), F.lit(before).alias("before"), F.lit(")" if kind == "rights" else "").alias("after")
        )

    parts = apart.select("__sd", "__at", F.posexplode(F.array(*[part(*p) for p in places])).alias("__place", "__part"))
    parts = parts.select("__sd", "__at", "__place", "__part.*")
    named = parts.join(known, ["kind", "code"], "left")
    # a bar between entries, nothing between the parts of one
    bar = F.when((F.col("__at") > 0) & (F.col("__place") == 0), F.lit(" | ")).otherwise(F.lit(""))
    shown = F.concat(bar, "before", F.coalesce("__name", "code"), "after")
    text = _listed(named.withColumn("__shown", shown), "__sd", "__at, __place", "")
    joined = df.join(text, plain(sd) == F.col("__sd"), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce("__text", plain(sd)).alias(out))
