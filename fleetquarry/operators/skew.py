"""Joins of a fact whose key has heavy hitters: those keys are spread over many tasks, all others joined plainly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries that the sketch tracks for each heavy key that can exist: keys beyond the share cannot be missed.
TRACKED = 8


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Values of ``key`` that at least ``share`` of the rows have, most frequent first, NULL left out.

    Found by a frequent-items sketch in one pass, of a size that depends on ``share`` alone. Its counts are estimates
    from above, so a key a little under the share may be among them; none over it is missing.
    """
    most = max(1, round(1 / share))
    top = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(most * TRACKED)).alias("top")
    found = df.where(F.col(key).isNotNull()).agg(top, F.count("*").alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"]]


def split_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, heavy: Sequence, salts: int, how: str = "left"
) -> DataFrame:
    """``left`` joined to ``right`` on one key, rows of ``heavy`` keys spread over ``salts`` parts.

    A left row's part follows from its own columns, so a retried task deals it out the same way; right rows of heavy keys, few by
    their nature, are repeated once a part. Other rows all have part 0. ``how`` is "left" or "inner". The rows are those of the
    plain join, whatever ``heavy`` holds.
    """
    if not heavy:
        return left.join(right, left[left_key] == right[right_key], how)

    def is_heavy(df: DataFrame, key: str) -> Column:
        return F.coalesce(df[key].isin(list(heavy)), F.lit(False))

    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    dealt = left.withColumn("__part", F.when(is_heavy(left, left_key), spread).otherwise(0))
    parts = F.when(is_heavy(right, right_key), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("__copy", F.explode(parts))
    match = (dealt[left_key] == repeated[right_key]) & (F.col("__part") == F.col("__copy"))
    return dealt.join(repeated, match, how).drop("__part", "__copy")
