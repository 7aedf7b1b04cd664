"""A quality classifier learnt from trusted positives and unlabelled web text.

The features describe the form of a whole text: shares of symbols, capitals,
digits and repeated words and lines, and hashed word shapes.  A small network is
fitted by minimising the non-negative unbiased risk: with class prior p, positive
risk ``p * E_P[l(g, +)]`` plus ``max(0, E_U[l(g, -)] - p * E_P[l(g, -)])``.  Where a
step's negative part falls below zero, its gradient is turned around, so that the
fit can't gain from it.  The prior is estimated as the share of good rows among the
labelled ones; labels of bad rows serve nothing else.

The fit uses samples of at most ``MOST_ROWS`` positives and ``MOST_ROWS`` unlabelled
texts, in the order of a hash of the id; scoring covers every row and whole texts.
Null and empty texts have zero features and get the score of those.  Rows that
repeat an id are scored one by one.  Without a positive label every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.scratch import kept
from tidemart.llm.tokens import Words, mix, passes

MOST_ROWS = 15_000
SHAPES = 64
HIDDEN = 16
STEPS, BATCH, RATE = 1500, 512, 0.01
#: Classes of bytes in a word's shape: 0 small letter, 1 capital, 2 digit, 3 other letter byte, 4 on: marks.
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3
for _k, _mark in enumerate("""#*$%&|<>!?.,;:'"()[]{}-_=+/\\@~^`"""):
    _CLASS[ord(_mark)] = 4 + _k
N_FEATURES = 16 + SHAPES


def features(texts: list[bytes]) -> np.ndarray:
    """One row of features per text, by array operations over all words at once."""
    words = Words(texts)
    n_texts = len(texts)
    out = np.zeros((n_texts, N_FEATURES), np.float32)
    counts = np.diff(words.first)
    owner = np.repeat(np.arange(n_texts), counts)
    n = np.maximum(counts, 1).astype(np.float64)
    kind = _CLASS[words.buffer]
    starts = words.text_start[:-1]

    def per_byte(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (total[words.text_start[1:]] - total[starts]).astype(np.float64)

    solid = np.maximum(np.bincount(owner, words.end - words.start, n_texts), 1)
    lines = np.maximum(per_byte(words.buffer == 10), 1)
    out[:, 0] = np.log1p(counts)
    out[:, 1] = solid / n
    out[:, 2] = per_byte((kind >= 4) & (kind <= 11)) / n
    out[:, 3] = per_byte(kind == 1) / solid
    out[:, 4] = per_byte(kind == 2) / solid
    out[:, 5] = per_byte(kind >= 4) / n
    out[:, 6] = per_byte(words.buffer == ord("!")) / n
    out[:, 7] = per_byte(words.buffer == ord("|")) / n
    out[:, 8] = per_byte((words.buffer == ord(".")) | (words.buffer == ord("?"))) / n
    out[:, 9] = np.log1p(n / lines)
    same = np.zeros(len(owner), bool)
    if len(owner) > 1:
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    out[:, 10] = np.bincount(owner, same, n_texts) / n
    # words and word pairs that the text has had before
    for column, value in ((11, words.hash), (12, mix(words.hash * np.uint64(3) + np.roll(words.hash, 1)))):
        tagged = mix(value + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first = np.unique(tagged, return_index=True)
        out[:, column] = 1 - np.bincount(owner[first], minlength=n_texts) / n
    out[:, 13] = np.bincount(owner, kind[words.end - 1] >= 4, n_texts) / n  # words that end in a mark
    out[:, 14] = counts < 5
    out[:, 15] = counts < 20
    # a shape is the run-collapsed sequence of classes of a word
    solid_bytes = np.ones(len(kind) + 1, bool)
    solid_bytes[1:-1] = kind[1:] != kind[:-1]
    head = np.zeros(len(kind), bool)
    head[words.start] = True
    used = np.flatnonzero(solid_bytes[:-1] | head)
    word_of = np.searchsorted(words.start, used, side="right") - 1
    inside = (word_of >= 0) & (used < words.end[np.maximum(word_of, 0)]) if len(words.start) else np.zeros(len(used), bool)
    used, word_of = used[inside], word_of[inside]
    place = used - words.start[word_of] if len(used) else used
    step = np.cumsum(np.ones(len(used), np.int64)) if len(used) else used
    if len(used):
        begin = np.flatnonzero(place == 0)
        step -= np.repeat(step[begin], np.diff(np.append(begin, len(used))))
        codes = mix((kind[used].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.minimum(step, 6).astype(np.uint64))
        shape = np.add.reduceat(codes, begin)
        bucket = (mix(shape) >> np.uint64(58)).astype(np.int64)
        table = np.bincount(owner * SHAPES + bucket, minlength=n_texts * SHAPES).reshape(n_texts, SHAPES)
        out[:, 16:] = table / n[:, None]
    return out


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.inner + self.inner_bias) @ self.outer + self.outer_bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Minimise the non-negative risk by small steps (Adam) over a bounded sample."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([positive, unlabelled])
    mean, scale = every.mean(0), every.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    weights = [rng.normal(0, 0.3, (p.shape[1], HIDDEN)) / np.sqrt(p.shape[1]), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def gradient(x: np.ndarray, slope: np.ndarray, hidden: np.ndarray) -> list[np.ndarray]:
        back = (slope[:, None] * weights[2]) * (1 - hidden**2)
        return [x.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()])]

    for step in range(1, STEPS + 1):
        xp, xu = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        hp, hu = (np.tanh(x @ weights[0] + weights[1]) for x in (xp, xu))
        gp, gu = (h @ weights[2] + weights[3][0] for h in (hp, hu))
        # logistic loss: of label + log(1 + e^-g), of label - log(1 + e^g)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        minus = [a - b for a, b in zip(gradient(xu, _sigmoid(gu) / BATCH, hu), gradient(xp, prior * _sigmoid(gp) / BATCH, hp), strict=True)]
        if negative >= 0:
            plus = gradient(xp, -prior * _sigmoid(-gp) / BATCH, hp)
            grad = [a + b for a, b in zip(plus, minus, strict=True)]
        else:
            grad = [-m for m in minus]
        rate = RATE * (1 - step / (STEPS + 1))
        for k, g in enumerate(grad):
            g = g + 1e-4 * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, weights[0], weights[1], weights[2], float(weights[3][0]))


def _first_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    return rows.orderBy(F.xxhash64(key), key).limit(most)


def score(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(doc_id, score) of every row of ``docs``, learnt from ``labels`` (doc_id, quality) and the texts of ``docs``."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    seen, good = known.agg(F.count("*"), F.sum("quality")).first()
    prior = (good or 0) / max(seen, 1)
    trusted = _first_by_hash(known.where("quality = 1").select("doc_id"), "doc_id", most).withColumn("trusted", F.lit(True))
    web = _first_by_hash(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id", most).withColumn("web", F.lit(True))
    chosen = trusted.join(web, "doc_id", "full").withColumnRenamed("doc_id", "chosen_id")  # at most 2 * most ids

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in passes(batches):
            rows = pa.array(features(texts).tolist(), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("chosen_id", "trusted", "web")), rows], names=["chosen_id", "trusted", "web", "x"])

    model = None
    if good:
        joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("chosen_id", "text", "trusted", "web")
        described = joined.mapInArrow(describe, "chosen_id long, trusted boolean, web boolean, x array<float>")
        # one row for each chosen id, also where ids repeat, in an order of their own: reruns fit the same model
        sample = kept(described.groupBy("chosen_id").agg(*[F.max(c).alias(c) for c in ("trusted", "web", "x")]), "quality-sample")
        table = sample.orderBy("chosen_id").toArrow()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(np.float64)
        is_p, is_u = (np.array([bool(v) for v in table.column(c).to_pylist()], bool) for c in ("trusted", "web"))
        if is_p.any() and is_u.any():
            model = fit(x[is_p], x[is_u], prior)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in passes(batches):
            found = shared.value
            value = np.zeros(len(texts)) if found is None else _sigmoid(found.logit(features(texts).astype(np.float64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(value, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(rate, "doc_id long, score double")
