"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme values.

Counts of words in toxic and clean labelled texts give each word a log-odds with a
Dirichlet prior: a word leans on its first six bytes, these on the first four,
these on all words, each with a prior weight.  Words and beginnings are counted
in hashed slots, so the model has one size whatever the corpus.

A linear scan finds all maximal scoring segments of a text.  The best segment of
clean texts follows an extreme-value law in the text's length, whose scale and
rate are fitted to quantiles over clean texts kept out of the counts.  A segment
is significant if that law makes it rarer than ``ALPHA``; a text's statistic is
the summed excess of its significant segments, and a logistic curve over those
held-back texts turns it into a probability.

Null and empty texts have no segment and get the probability of statistic 0.
Rows that repeat an id are scored one by one.  Without usable labels every score
is 0.  Labels are taken from a sample of at most ``MOST_LABELS`` rows in the order
of a hash of the id; everything else runs over whole tables and whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.scratch import kept
from tidemart.llm.tokens import Words, passes

#: Bound of the labelled sample, whose ids are broadcast.
MOST_LABELS = 40_000
#: Slots for the first four bytes, the first six, and whole words, as bits.
SLOT_BITS = (16, 18, 20)
PRIOR = 4.0
#: Cost of a token beside its log-odds, and the bounds of a token's log-odds.
DRIFT, LOW, HIGH = 1.0, -3.0, 8.0
ALPHA = 0.05
BINS = 400
#: Median and ninth decile of the standard extreme-value law.
MEDIAN, DECILE = -math.log(math.log(2)), -math.log(-math.log(0.9))


class Model(NamedTuple):
    toxic: list[np.ndarray]
    total: list[np.ndarray]
    rate: float


def word_slots(words: Words) -> list[np.ndarray]:
    """Slots of every word: by four bytes, six bytes, and whole."""
    out = []
    for bits, reach in zip(SLOT_BITS, (4, 6, None), strict=True):
        value = words.hash if reach is None else words.span_hash(words.start, np.minimum(words.end, words.start + reach))
        out.append((value >> np.uint64(64 - bits)).astype(np.int64))
    return out


def count_slots(rows: DataFrame) -> DataFrame:
    """(level, slot, clean, toxic): how often each slot occurs in rows of (text, toxic)."""
    schema = pa.schema([("level", pa.int32()), ("slot", pa.int32()), ("clean", pa.int64()), ("toxic", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, 1 << bits), np.int64) for bits in SLOT_BITS]
        for batch, texts in passes(batches):
            label = np.array(batch.column("toxic").to_pylist(), np.int64)
            words = Words(texts)
            owner = np.repeat(label, np.diff(words.first))
            for total, slots in zip(sums, word_slots(words), strict=True):
                for y in (0, 1):
                    total[y] += np.bincount(slots[owner == y], minlength=total.shape[1])
        for level, total in enumerate(sums):
            used = np.flatnonzero(total.any(axis=0))
            for at in range(0, len(used), 50_000):
                part = used[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), level, np.int32)), pa.array(part.astype(np.int32)), *(pa.array(total[y][part]) for y in (0, 1))], schema=schema
                )

    counted = rows.select("text", "toxic").mapInArrow(count, "level int, slot int, clean long, toxic long")
    return counted.groupBy("level", "slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def fit(rows: DataFrame) -> Model:
    """The model of rows (text, toxic).  What is gathered is bounded by the number of slots."""
    table = count_slots(rows).toArrow()
    level, slot, clean, toxic = (np.asarray(table.column(c)) for c in ("level", "slot", "clean", "toxic"))
    toxics, totals = [], []
    for k, bits in enumerate(SLOT_BITS):
        mine = level == k
        ones, every = np.zeros(1 << bits, np.float32), np.zeros(1 << bits, np.float32)
        ones[slot[mine]], every[slot[mine]] = toxic[mine], clean[mine] + toxic[mine]
        toxics.append(ones)
        totals.append(every)
    n1, n = float(toxics[2].sum()), float(totals[2].sum())
    return Model(toxics, totals, min(max(n1 / n, 1e-6), 1 - 1e-6) if n else 0.5)


def token_scores(words: Words, model: Model) -> np.ndarray:
    """Log-odds of every word against the share of toxic words, less the drift."""
    share = np.full(len(words.start), model.rate, np.float32)
    for slots, toxic, total in zip(word_slots(words), model.toxic, model.total, strict=True):
        share = (toxic[slots] + PRIOR * share) / (total[slots] + PRIOR)
    odds = np.log(share / (1 - share)) - math.log(model.rate / (1 - model.rate))
    return np.clip(odds, LOW, HIGH) - DRIFT


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in one pass over its positive scores.

    Open candidates carry the running sum before and after them.  A new one is
    merged with the last candidate that began lower, if that one also ended lower.
    """
    gains = np.flatnonzero(scores > 0)
    if not len(gains):
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    stack: list[tuple[int, int, float, float]] = []
    back: list[int] = []  # of each candidate: the last one below it that began lower, or -1
    for k in gains.tolist():
        start, end, low, high = k, k + 1, sums[k], sums[k + 1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = back[j]
            if j < 0 or stack[j][3] >= high:
                stack.append((start, end, low, high))
                back.append(j)
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:], back[j:]
    return [(a, b, float(high - low)) for a, b, low, high in stack]


def scan(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_tokens`` and ``segments`` (start word, end word, score) above ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [f for f in docs.schema.fields if f.name != "text"]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in passes(batches):
            words = Words(texts)
            scores = token_scores(words, shared.value)
            found = [[{"start": a, "stop": b, "score": s} for a, b, s in segments(scores[i:j]) if s > least] for _, i, j in words.texts()]
            n = pa.array(np.diff(words.first).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in others), n, pa.array(found, kind)], names=[*(f.name for f in others), "n_tokens", "segments"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return docs.mapInArrow(score, f"{shape}{', ' if others else ''}n_tokens long, segments array<struct<start:int,stop:int,score:double>>")


class Law(NamedTuple):
    """Extreme-value law of the best segment, and the logistic curve over the statistic."""

    rate: float
    log_k: float
    offset: float = -30.0
    slope: float = 0.0

    def statistic(self) -> Column:
        """Summed excess of the segments that are rarer than ``ALPHA`` in a text of that length."""
        floor = self.log_k + F.ln(F.greatest("n_tokens", F.lit(1))) + math.log(1 / ALPHA)
        excess = F.transform("segments", lambda s: F.greatest(s["score"] * self.rate - floor, F.lit(0.0)))
        return F.aggregate(excess, F.lit(0.0), lambda a, x: a + x)

    def probability(self, statistic: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.offset) + self.slope * F.ln(1 + statistic))))


def fit_law(scanned: DataFrame) -> Law:
    """Fit rate and K by quantiles over clean rows of (n_tokens, segments, toxic), then the curve over all rows."""
    best = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0))
    x, y = F.ln(F.greatest("n_tokens", F.lit(1))), best
    clean = scanned.where("toxic = 0 and n_tokens > 0").select(x.alias("x"), y.alias("y"))
    if clean.limit(3).count() < 3:
        return Law(1.0, 0.0)
    rate = 1.0
    for _ in range(8):  # median and ninth decile of the best score less ln(n) / rate; a few odd texts don't move them
        half, most = clean.agg(F.percentile_approx(F.col("y") - F.col("x") / rate, [0.5, 0.9], 10_000)).first()[0]
        rate = 0.5 * rate + 0.5 * (DECILE - MEDIAN) / max(most - half, 1e-3)
    law = Law(rate, rate * half - MEDIAN)
    binned = scanned.select("toxic", F.least(F.lit(BINS), F.floor(20 * F.ln(1 + law.statistic()))).alias("bin")).groupBy("bin").agg(F.sum("toxic").alias("ones"), F.count("*").alias("n"))
    rows = np.array([(r.bin, r.ones, r.n) for r in binned.collect()], float)  # at most BINS + 1 rows
    z, ones, n = (rows[:, 0] + 0.5 * (rows[:, 0] > 0)) / 20, rows[:, 1], rows[:, 2]
    w = np.zeros(2)
    design = np.stack([np.ones_like(z), z], 1)
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (ones - n * p) - ridge @ w
        w += np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + ridge, grad)
    return law._replace(offset=float(w[0]), slope=float(max(w[1], 0)))


def labelled(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """(text, toxic, fold) of the documents in a sample of at most ``most`` label rows; fold 0 of 4 is for calibration."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("label_id")), F.lit(4)).alias("fold")
    return docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("text", "toxic", fold)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score, passages) of every row of ``docs``, learnt from ``labels`` (doc_id, toxic).

    ``passages`` are the significant segments as word positions.
    """
    rows = labelled(docs, labels)
    model = fit(rows.where("fold > 0"))
    law = fit_law(kept(scan(rows.where("fold = 0").select("text", "toxic"), model), "calibration"))
    # a segment that is significant in a text of one word is needed at least
    least = max(0.0, (law.log_k + math.log(1 / ALPHA)) / law.rate)
    scanned = scan(docs.select("doc_id", "text"), model, least)
    floor = law.log_k + F.ln(F.greatest("n_tokens", F.lit(1))) + math.log(1 / ALPHA)
    passages = F.filter("segments", lambda s: s["score"] * law.rate > floor)
    return scanned.select("doc_id", law.probability(law.statistic()).alias("score"), passages.alias("passages"))
