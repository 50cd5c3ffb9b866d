"""Stages judge each row by its own text: repeated and missing doc_ids, clashing columns, empty tables."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as pipeline
from fleetquarry.llm import decontaminate, language_id, simhash

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, __text string, fp int"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("w%d" % rng.randrange(500) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", k) for k, (i, t) in enumerate(rows)], DOCUMENT)


def kept(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_near_duplicates_are_decided_by_row(spark):
    a, b, c, d = (prose(k, 200) for k in range(4))
    rows = [(3, a), (3, b), (5, a + " more"), (None, a), (None, c), (None, c), (7, d), (7, d), (2, None), (9, ""), (None, None)]
    df = documents(spark, rows)
    out = simhash.keep_first(df)
    assert out.columns == df.columns
    # one row of each group: unlike texts under id 3 both stay, c has no row with an id, null and '' are one group
    assert kept(out) == Counter([(3, a), (3, b), (None, c), (7, d), (2, None)])
    same = spark.createDataFrame([(1, a, "x")] * 4, "doc_id long, text string, mark string")
    assert kept(simhash.keep_first(same)) == Counter([(1, a)])


def test_languages_are_decided_by_row(spark):
    rows = [(k, "el perro come en la casa verde %d" % k) for k in range(40)] + [(1, None), (1, "123"), (None, "el perro come"), (None, "...")]
    out = language_id.keep_known(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    assert kept(out) == Counter(r for r in rows if r[1] and "el" in r[1])


def test_contaminated_rows_go_by_row(spark):
    item, clean = prose(9, 40), prose(8, 60)
    rows = [(1, f"{clean} {item}"), (1, clean), (None, item), (None, clean), (2, None), (3, clean), (3, clean)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = documents(spark, rows)
    out = decontaminate.remove_contaminated(df, benchmark)
    assert out.columns == df.columns and kept(out) == Counter(r for r in rows if item not in (r[1] or ""))
    assert kept(decontaminate.remove_contaminated(df, benchmark.limit(0))) == Counter(rows)


def plain_similarity(a, b):
    grams = [Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in (a, b)]
    return sum((grams[0] & grams[1]).values()) / sum((grams[0] | grams[1]).values())


@pytest.mark.parametrize("size", [40, 76, 100, 130])
def test_passages_that_differ_in_a_repeated_word_are_found(size):
    rng, missed, tried = random.Random(size), 0, 0
    for _ in range(60):
        item = [f"a{rng.randrange(9000)}" for _ in range(size)]
        tail = size // 10 + 1
        for end in (["b"] * tail, ["b", "c"] * (tail // 2), [f"d{k}" for k in range(tail)]):
            item[-tail:] = ["z"] * tail
            window = item[: size - len(end)] + end
            if plain_similarity(item, window) < 0.8:
                continue
            tried += 1
            index = decontaminate.build_index([(1, " ".join(item))])
            hashes, _ = decontaminate.words(pa.array([" ".join(["x"] * 50 + window + ["y"] * 50)]))
            found = decontaminate.find(hashes, index, index.has(decontaminate.shingles(hashes)))
            missed += 1 not in found
    assert tried > 20 and missed == 0


def test_a_long_text_that_repeats_a_passage_in_bounded_steps():
    item = prose(4, 50)
    index = decontaminate.build_index([(1, item)])
    hashes, _ = decontaminate.words(pa.array([(item + " ") * 6000]))
    hit = index.has(decontaminate.shingles(hashes))
    marks = list(decontaminate._marked(decontaminate.shingles(hashes), np.arange(len(hit) - 45), 46))
    # the passage begins anew after 50 words, so there are that many different windows
    assert len(marks) == 50 and [m[0] for m in marks] == list(range(50))
    assert decontaminate.find(hashes, index, hit)[1] == (1.0, 0, 50)


def test_the_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    full = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], full).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
    texts = [(k, "una casa verde con perro %d" % k if k % 2 else "the green house has a dog %d" % k) for k in range(60)]
    rows = [(i, t, "es" if i % 2 else "en", None, None) for i, t in texts] + [(None, None, None, None, None), (5, "una casa roja y otra cosa", None, "x", 3)]
    spark.createDataFrame(rows, full).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(r["n_tokens"] > 0 for r in out) and sum(r["doc_id"] == 5 for r in out) <= 2
