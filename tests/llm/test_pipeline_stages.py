"""Stages of the corpus pipeline on rows without id, repeated rows and clashing columns."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(31)
    vocabulary = [f"{a}{b}" for a in "ka le mi no pu ra se ti vo zu".split() for b in "ban del fir gos hum".split()]
    return lambda n=60: " ".join(rng.choice(vocabulary) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(d, t, "en", "web", len(t or "")) for d, t in texts], SCHEMA).repartition(3)


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_copies_without_id_and_repeated_rows_go(spark, prose):
    a, b, c, d = (prose() for _ in range(4))
    near = " ".join([*c.split()[:-1], "changed"])
    rows = [(None, a), (None, a), (5, b), (5, b), (7, c), (9, near), (None, c), (11, d), (11, prose()), (None, None), (None, None), (12, "")]
    docs = frame(spark, rows)
    got = left(corpus_pipeline.near_duplicates(spark, docs, ""))
    assert got == sorted([(None, a), (5, b), (7, c), (11, d), (11, rows[8][1]), (None, None), (None, None), (12, "")], key=repr)
    assert left(corpus_pipeline.near_duplicates(spark, docs.limit(0), "")) == []


def test_near_duplicates_keep_one_of_each_plain_group(spark, small, small_docs, crowded_docs):
    """Against the plain version, for rows with an id and a word."""
    rows = [(r[0], r[1]) for r in small if r[0] is not None]
    keep = {d for d, n, c in brute.near_duplicates(rows) if d == c}
    for docs in (small_docs, crowded_docs.withColumn("own_id", crowded_docs.doc_id)):
        result = corpus_pipeline.near_duplicates(spark, docs, "")
        assert result.columns == docs.columns
        got = [r.doc_id for r in result.collect() if r.doc_id is not None]
        assert set(got) == keep
        worded = [d for d in got if brute.words(dict(rows)[d])]
        assert len(worded) == len(set(worded))


def test_rows_without_id_that_hold_an_item_go(spark, prose, tmp_path):
    item = "The train leaves Oslo at 17 km per hour and meets Anna after 45 minutes near the old bridge by the river."
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = prose()
    docs = frame(spark, [(None, item), (None, clean), (3, f"{prose()} {item.replace('17', '28')} {prose()}"), (4, clean), (4, item), (6, None), (None, "")])
    assert left(corpus_pipeline.decontamination(spark, docs, str(tmp_path))) == sorted([(None, clean), (6, None), (None, "")], key=repr)


def test_toxic_rows_without_id_go(spark, prose, tmp_path):
    rng = random.Random(4)
    toxic = lambda: " ".join([prose(20), *(rng.choice("vile scum filth rot".split()) for _ in range(15)), prose(20)])
    texts = [(k, toxic() if k % 4 == 0 else prose()) for k in range(400)]
    spark.createDataFrame([(k, int(k % 4 == 0), 1) for k in range(400)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark, [*texts, (None, toxic()), (None, "a clean " + prose()), (None, None)])
    got = left(corpus_pipeline.toxicity(spark, docs, str(tmp_path)))
    ids = [d for d, _ in got if d is not None]
    assert all(k % 4 for k in ids) and len(ids) >= 295
    without = [t for d, t in got if d is None]
    assert len(without) == 2 and None in without and not any("scum" in (t or "") for t in without)
