"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams; a linear layer and a softmax
give the language (the model of Joulin et al. 2017). It is trained by stochastic gradient
descent in numpy on a bounded sample of labelled rows. Part of the sample calibrates a
temperature and the score below which a prediction is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import all_columns, enter, packed, ragged, slices, unused

NGRAMS = (2, 3, 4)
BUCKETS = 1 << 15
DIMENSIONS = 16
#: Labelled rows to learn from, in equal shares of the languages; rows are taken by a hash.
SAMPLE_ROWS = 3000
STEPS = 1200
RATE = 20.0
BATCH = 32
#: Share of the sample that calibrates instead of training, and the share of its right
#: predictions that rejection may cost.
CALIBRATION = 0.25
REJECTED_RIGHT = 0.002
BATCH_BYTES = 1 << 19


def subwords(buffer: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the bucket at every byte, and whether the n-gram ends inside its text."""
    total = len(buffer)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(total)  # bytes to the text's end
    padded = np.concatenate([buffer, np.zeros(max(NGRAMS), np.uint8)]).astype(np.uint32)
    gram = np.zeros(total, np.uint32)
    for size in range(1, max(NGRAMS) + 1):
        gram = gram << np.uint32(8) | padded[size - 1 : size - 1 + total]
        if size in NGRAMS:
            mixed = (gram + np.uint32(size * 0x01234567)) * np.uint32(0x9E3779B1)
            mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x85EBCA6B)
            yield (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32), left >= size


@dataclass(frozen=True)
class Model:
    """weights: for each language, a bucket's share in the logit (embedding times linear layer)."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        buffer, offsets = packed(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        sizes = np.diff(offsets)
        counts = sum(np.maximum(sizes - (n - 1), 0) for n in NGRAMS)
        # invalid n-grams go to a last bucket that weighs nothing
        grams = [np.where(ok, h, BUCKETS) for h, ok in subwords(buffer, offsets)]
        out = np.empty((len(sizes), len(self.languages)))
        for k in range(len(self.languages)):
            row = np.append(self.weights[k], 0).astype(np.float32)
            sums = np.zeros(len(buffer) + 1)
            np.cumsum(sum(row[g] for g in grams), dtype=np.float64, out=sums[1:])
            out[:, k] = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(counts, 1) + self.bias[k]
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return _softmax(self.logits(texts) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, the buckets it has and their share; at most BUCKETS entries, however long it is."""
    for batch in slices(batches, "text", BATCH_BYTES):
        buffer, offsets = packed(pc.utf8_lower(batch.column("text").cast(pa.large_string())))
        grams = list(subwords(buffer, offsets))
        buckets, shares = [], []
        for s, e in zip(offsets[:-1], offsets[1:]):
            counts = np.bincount(np.concatenate([h[s:e][ok[s:e]] for h, ok in grams]), minlength=BUCKETS)
            own = np.flatnonzero(counts)
            buckets.append(own.astype(np.int32))
            shares.append((counts[own] / max(1, counts.sum())).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lang"), pa.array(buckets, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
            ["doc_id", "lang", "buckets", "shares"],
        )


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> Model:
    """A model of ``labelled(doc_id, text, lang)``, null labels and texts left out.

    Only a hash sample of about ``sample_rows`` rows reaches the driver, as bucket shares of whole
    texts, so its size is bounded by the parameters. Without any labelled row every
    prediction is 'und'.
    """
    rows = labelled.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = rows.where("doc_id is not null and text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), 1.0, 0.0)
    each = max(1, sample_rows // len(counts))
    take = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    kind = "doc_id long, lang string, buckets array<int>, shares array<float>"
    sample = rows.where(draw < take[F.col("lang")]).mapInArrow(_features, kind).toArrow().sort_by("doc_id")
    languages = sorted(set(sample["lang"].to_pylist()))
    if not languages:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), 1.0, 0.0)
    label = np.array([languages.index(x) for x in sample["lang"].to_pylist()])
    lists = sample["buckets"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    index = lists.flatten().to_numpy().astype(np.int64)
    share = sample["shares"].combine_chunks().flatten().to_numpy()
    return _fit(languages, label, ends, index, share, seed)


def _fit(languages, label, ends, index, share, seed) -> Model:
    rng, count = np.random.default_rng(seed), len(languages)
    # texts too short for any n-gram teach nothing
    full = np.flatnonzero(np.diff(ends) > 0)
    held = rng.random(len(full)) < CALIBRATION
    if held.all() or not held.any():
        held[:] = False
    embed = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    linear = np.zeros((count, DIMENSIONS), np.float32)
    bias = np.zeros(count, np.float32)
    if not len(full):
        return Model(languages, np.zeros((count, BUCKETS), np.float32), bias.astype(np.float64), 1.0, 0.0)

    def averages(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = ends[rows + 1] - ends[rows]
        at = ragged(ends[rows], sizes)
        x = np.add.reduceat(embed[index[at]] * share[at, None], np.cumsum(sizes) - sizes)
        return x, index[at], share[at], np.repeat(np.arange(len(rows)), sizes)

    train_rows = full[~held]
    epochs = -(-STEPS * BATCH // len(train_rows))  # about as many steps for any sample
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(train_rows)
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            x, at, weight, own = averages(rows)
            error = _softmax(x @ linear.T + bias)
            error[np.arange(len(rows)), label[rows]] -= 1
            error /= len(rows)
            back = (error @ linear).astype(np.float32)
            linear -= 0.1 * rate * (error.T @ x).astype(np.float32)
            bias -= 0.01 * rate * error.sum(axis=0)
            for k in range(DIMENSIONS):
                embed[:, k] -= rate * np.bincount(at, back[own, k] * weight, BUCKETS).astype(np.float32)
    check = full[held] if held.any() else train_rows
    logits = averages(check)[0] @ linear.T + bias
    right = label[check]
    grid = np.geomspace(0.05, 20, 60)
    losses = [-np.log(_softmax(logits / t)[np.arange(len(right)), right] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    scores = _softmax(logits / temperature)
    good = scores.max(axis=1)[scores.argmax(axis=1) == right]
    # never above one half: a prediction that outweighs all others together is kept
    least = min(0.5, float(np.quantile(good, REJECTED_RIGHT))) if len(good) else 0.0
    return Model(languages, (linear @ embed.T).astype(np.float32), bias.astype(np.float64), temperature, least)


def _judged(texts: pa.Array, letter: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predicted names, scores and rejections of a batch."""
    names = np.array([*model.languages, "und"], object)
    known = letter.to_numpy(zero_copy_only=False).astype(bool) & bool(model.languages)
    best, score = np.full(len(known), len(names) - 1), np.zeros(len(known))
    if known.any():
        p = model.scores(texts)
        best[known], score[known] = p.argmax(axis=1)[known], p.max(axis=1)[known]
    return names[best], score, ~known | (score < model.least)


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row of ``docs(doc_id, text)``.

    A text that is null or without a letter is 'und' with score 0 and rejected; so is every text
    if the model knows no language. Nothing but the text counts. Repeated rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("language_id")
        for batch in slices(batches, "text", BATCH_BYTES):
            names, score, rejected = _judged(batch.column("text"), batch.column("letter"), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), _has_letter(text).alias("letter"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is told with enough confidence, each judged by its own text: rows that share a
    doc_id or have none are no exception. All columns pass through the map, nothing is shuffled."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    text, name, letter = F.col("text").cast("string"), unused(docs, "__text"), unused(docs, "__letter")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("language_id")
        for batch in slices(batches, name, BATCH_BYTES):
            _, _, rejected = _judged(batch.column(name), batch.column(letter), model)
            kept = batch.filter(pa.array(~rejected))
            yield pa.RecordBatch.from_arrays(kept.columns[:-2], kept.schema.names[:-2])

    rows = docs.select(*all_columns(docs), text.alias(name), _has_letter(text).alias(letter))
    return rows.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected): learned from the other folds, predicted for all."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
