"""Terms that reveal entities of any number of texts, against plain counts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from fleetquarry.llm import pii


def plain_terms(rows):
    texts = {t for _, t in rows}
    terms = {t: set(re.findall(r"(?<![^\W\d_])[^\W\d_]{4,}", t.lower())) for t in texts}
    held = {t: set(re.findall(r"[a-z]+@[a-z.]+", t.lower())) for t in texts}
    n_term, n_entity, joint = Counter(w for t in texts for w in terms[t]), Counter(e for t in texts for e in held[t]), Counter()
    for t in texts:
        joint.update((e, w) for e in held[t] for w in terms[t])
    out = {}
    for i, t in rows:
        found = {}
        for e in held[t]:
            content = math.log2(len(texts) / n_entity[e])
            for w in terms[t]:
                hidden = math.log2(n_term[w] / (joint[e, w] - 0.6))
                if content - hidden >= 0.5 * content and hidden <= 1.75:
                    found[w] = min(hidden, found.get(w, 9))
        out[i] = sorted((w, "remove" if h <= 0.25 else "generalise") for w, h in found.items())
    return out


def test_entities_of_one_text_reveal_terms(spark):
    rng = random.Random(4)
    common = [a + b for a in ("alpha", "beta", "gamma", "delta") for b in ("one", "two", "three", "four")]
    rows = [(i, " ".join(rng.sample(common, 8)) + f" note {'abcdefghij'[i // 10 % 10]}{'klmnopqrst'[i % 10]}{'uvwxyzabcd'[i // 100]}") for i in range(600)]
    rows[0] = (0, "write to lone@corp.example about qwertyuiop alphaone betatwo")
    rows[1] = (1, "pair@corp.example and asdfgh with alphatwo")
    rows[2] = (2, "pair@corp.example and asdfgh with betaone")
    for i in range(3, 10):
        rows[i] = (i, f"many@corp.example for zxcvbn and {common[i]}")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {}
    for r in df.join(pii.scan(df).select("doc_id", "spans"), "doc_id").select("doc_id", "text", F.col("spans")).collect():
        got[r["doc_id"]] = sorted({(r["text"][s["start"] : s["end"]].lower(), s["value"]) for s in r["spans"] if s["kind"] == "term"})
    assert got == plain_terms(rows)
    # weaker evidence than that of many texts
    assert ("qwertyuiop", "generalise") in got[0] and ("alphaone", "generalise") not in got[0]
    assert ("asdfgh", "generalise") in got[1] and ("zxcvbn", "remove") in got[5]


def test_decisions_do_not_depend_on_the_size_of_the_corpus(spark):
    """The same documents, and the same ones among ten times as many others; copies and clashing columns change nothing."""
    def told(others, copies):
        rows = [(1, "write to lone@corp.example about qwertyuiop"), (2, "pair@corp.example and asdfgh"), (3, "pair@corp.example and asdfgh")]
        rows += [(10 + i, f"many@corp.example for zxcvbn {'abcdefgh'[i] * 5}") for i in range(8)]
        rows += [(3, rows[2][1] + " twice"), (None, None), (None, "")] + [(2, rows[1][1])] * copies
        rows += [(100 + i, f"plain words {'abcdefghij'[i % 10] * 4} {i}") for i in range(others)]
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, hash string, copies int")
        out = pii.scan(df).select("doc_id", "spans").where("doc_id < 100").collect()
        return sorted({(r["doc_id"], s["start"], s["value"]) for r in out for s in r["spans"] if s["kind"] == "term"})

    small = told(300, 0)
    assert (1, 33, "generalise") in small and (10, 22, "remove") in small
    assert told(3000, 0) == small and told(300, 40) == small


def test_terms_are_found_in_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert pii.report(docs).where("n_term > 0").count() > 0
