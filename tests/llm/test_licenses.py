"""License templates against regular expressions over words, odd rows included."""

from __future__ import annotations

import random
import re

import pytest

from fleetquarry.llm import licenses, queries


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_matches(words, templates, phrases):
    """Each template as a greedy regular expression from each word on; the longest of all ways by trying every end."""
    out = []
    for kind, phrase in ((phrases, True), (templates, False)):
        for label in sorted(kind):
            for template in kind[label]:
                pattern = re.compile(licenses.as_pattern(template))
                for start in range(len(words)):
                    for stop in range(len(words), start, -1):
                        if pattern.fullmatch("".join(w + " " for w in words[start:stop])):
                            out.append((label, start, stop, licenses.mandatory(licenses.parts_of(template)), phrase))
                            break
    return sorted(out)


SMALL = {
    "one": ["a b [[c]] d", "x {{name:1-3}} y", "a [[b [[c c]] {{n:0-1}}]] e"],
    "two": ["b {{n:2-2}} [[d d]]  a", "[[a]] c {{n:0-2}} [[c]] c"],
}


def test_small_templates_on_random_words(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("aabbccdexyz") for _ in range(rng.randrange(14))) for _ in range(250)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    phrases = {"three": ["a b", "c c"]}
    for row in licenses.scan(docs, SMALL, phrases).collect():
        words = plain_words(texts[row["doc_id"]])
        assert row["n_words"] == len(words)
        assert sorted(tuple(m) for m in row["matches"]) == plain_matches(words, SMALL, phrases), words


@pytest.mark.parametrize("bad", ["{{n:1-2}} a", "[[a]]", "a [[b", "a ]] b", ""])
def test_templates_that_cannot_be_compiled(bad):
    with pytest.raises(ValueError):
        licenses.compiled({"x": [bad]}, {})


def filled(template, holder="Some Holder Ltd"):
    """A text of the template: every optional region there, replaceable ones filled."""
    return re.sub(r"\{\{[^{}]*\}\}", holder, template.replace("[[", " ").replace("]]", " "))


def bare(template, holder="H"):
    """The same without its optional regions."""
    while "[[" in template:
        template = re.sub(r"\[\[(?:(?!\[\[|\]\]).)*\]\]", " ", template, flags=re.S)
    return re.sub(r"\{\{[^{}]*\}\}", holder, template)


def test_every_template_accepts_its_texts_and_no_changed_wording():
    automaton = licenses.compiled(licenses.TEMPLATES, {})
    for label, templates in licenses.TEMPLATES.items():
        for template in templates:
            for text in (filled(template, "x y" if "quoted" in template else "Some Holder Ltd"), bare(template)):
                words = licenses.words_of("Preface. " + text + " End.")
                found = {automaton.entries[e][0] for e, *_ in automaton.matches(words)}
                assert label in found, (label, text)
            own = licenses.compiled({label: [template]}, {})
            words = licenses.words_of(bare(template))
            for k in range(len(words)):
                changed = words[:k] + [b"zzz"] + words[k + 1 :]
                if words[k] != b"h":  # what stands for a replaceable region
                    assert not own.matches(changed), (label, k)


def plain_row(doc_id, text):
    words = plain_words(text)
    found = plain_matches(words, licenses.TEMPLATES, licenses.PHRASES)
    base = [m for m in found if m[4]]
    scores = [0.5 if m[4] else m[3] / (m[3] + 1) for m in found]
    return (
        doc_id, len(words), len(base), min((m[1] for m in base), default=None), max((m[1] for m in base), default=None),
        ",".join(sorted({m[0] for m in base})), ",".join(sorted({m[0] for m in found})), max(scores, default=0.0),
    )


def test_every_document_against_plain_matching(spark, tmp_path):
    mit = filled(licenses.TEMPLATES["mit-text"][0])
    texts = [
        None, "", "...", "MIT-License, mit license; MIT\nLICENSE", "the İmit license", "general public license general public license",
        "Licensed under the Apache License, Version 2.0.", "licensed under the apache license version 3", "é license mit", mit, mit[:-20],
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "license " * 200,
        "MIT License Copyright (c) 2020 A. Person Permission is hereby granted, free of charge, to nobody",
    ]
    rows = [(i, t, "x", 7) for i, t in enumerate(texts)] + [(None, "mit license", "y", 1), (4, "a", None, None), (4, "a", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, labels string, matches int").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_license_scan(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(i, t) for i, t, *_ in rows), key=str)


def test_a_very_long_text(spark):
    text = "the software is mit " * 100_000 + "license"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_words"] == 400_001 and [tuple(m) for m in row["matches"]] == [("mit", 399_999, 400_001, 2, True)]


def test_no_documents(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
