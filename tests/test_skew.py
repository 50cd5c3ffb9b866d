"""Heavy hitters spread over tasks, and names from dictionary tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetquarry.functions.numbers import mask_names
from fleetquarry.operators import dictionaries, skew
from fleetquarry.sources.messages import readable_sd


def fact(spark, n=20_000):
    """A third of the rows has one key, a tenth another, some have none."""
    key = "CASE WHEN id % 3 = 0 THEN 'base' WHEN id % 10 = 1 THEN 'libc' WHEN id % 50 = 2 THEN NULL ELSE concat('p', id % 500) END"
    return spark.range(n).selectExpr("id", f"{key} AS package")


def test_heavy_keys_are_found_and_no_others(spark):
    assert skew.heavy_keys(fact(spark), "package", 0.05) == ["base", "libc"]
    assert skew.heavy_keys(fact(spark).limit(0), "package") == []
    assert skew.heavy_keys(fact(spark).where("package IS NULL"), "package") == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_split_join_has_the_rows_of_the_plain_one(spark, how):
    left = fact(spark, 3000)
    right = spark.sql("SELECT * FROM VALUES ('base', 1), ('base', 2), ('p7', 3), ('none', 4), (NULL, 5), ('libc', 6) AS t(name, v)")
    plain = left.join(right, left["package"] == right["name"], how)
    for heavy in ([], ["base", "libc"], ["p7", "not there"]):
        got = skew.split_join(left, right, "package", "name", heavy, 5, how)
        assert got.columns == plain.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))


def test_the_largest_task_is_bounded(spark):
    """What AQE does at run time is off, so that the deal itself shows."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left, right = fact(spark), fact(spark).select(F.col("package").alias("name")).distinct()
        sizes = lambda df: [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("name").alias("n")).collect()]
        plain = max(sizes(left.join(right, left["package"] == right["name"], "left")))
        heavy = skew.heavy_keys(left, "package", 0.05)
        split = max(sizes(skew.split_join(left, right, "package", "name", heavy, 16)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plain > 20_000 / 3 and split < 20_000 / 6


def test_masks_named_by_a_table_are_those_named_by_a_dictionary(spark):
    names = {1: "Read", 2: "Write", 4: "Append", 1 << 40: "Far", -(1 << 63): "Sign"}
    rng = random.Random(1)
    masks = [sum(b for b in names if rng.random() < 0.5) for _ in range(40)] + [0, None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(masks)], "name int, mask bigint")
    table = spark.createDataFrame([*names.items(), (3, "both"), (0, "none"), (8, None), (1, "Read")], "bits bigint, name string")
    got = dictionaries.with_mask_names(df, "mask", table, "text")
    assert got.columns == ["name", "mask", "text"]
    want = df.select("name", "mask", mask_names("mask", names).alias("text"))
    assert rows(got) == rows(want)


def test_unknown_bits_and_several_names(spark):
    df = spark.createDataFrame([(1 | 8 | 256,), (1 | 8 | 256,), (None,)], "mask bigint")
    table = spark.createDataFrame([(1, "b"), (1, "a")], "bits int, name string")
    assert rows(dictionaries.with_mask_names(df, "mask", table, "t"), "t") == [("",), ("a, b, 0x8, 0x100",), ("a, b, 0x8, 0x100",)]
    assert rows(dictionaries.with_mask_names(df, "mask", table.limit(0), "t"), "t")[1] == ("0x1, 0x8, 0x100",)


def test_descriptors_named_by_a_table(spark):
    texts = [
        "O:BAG:SYD:(A;;FR;;;WD)(D;OICI;0x1f;;;S-1-5-7)S:(AU;;FR;;;WD)", "D:(A;;FR)", "no descriptor", "", None, "D:", "D:(A;;FR;;;WD)",
        "D:(A;;FR;;;WD)(A;;FR;;;WD)", "D:(;;;;;)",
    ]
    names = {"sid": {"WD": "Every|one"}, "type": {"A": "Allow", "D": "Deny"}, "rights": {"FR": "Read", "WD": "wrong kind"}}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "kind int, code string")
    table = spark.createDataFrame([(k, c, n) for k, d in names.items() for c, n in d.items()] + [("sid", "X", None)], "kind string, code string, name string")
    got = dictionaries.with_readable_sd(df, "code", table, "text")
    assert rows(got, "kind", "text") == rows(df.select("kind", readable_sd("code", names).alias("text")))
    assert dictionaries.with_readable_sd(df, "code", table.limit(0), "t").where("kind = 6").first()["t"] == "WD: A (FR)"
