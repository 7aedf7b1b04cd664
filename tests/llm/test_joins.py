"""Near-duplicate sets and passages against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemart.llm import jaccard_join, passages
from tidemart.llm.graph import components
from tidemart.llm.tokens import Words, shingles


def as_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_words_are_those_of_the_rule():
    texts = ["Ab  cD\n\x0b\x0cé x \x1cq", "", "  ", "one", None, "a" * 5000 + " b"]
    words = Words([(t or "").encode() for t in texts])
    ids: dict[int, str] = {}
    for (_, i, j), t in zip(words.texts(), texts, strict=True):
        expected = brute.words(t)
        assert j - i == len(expected)
        for h, w in zip(words.hash[i:j].tolist(), expected, strict=True):
            assert ids.setdefault(h, w) == w
    assert len(ids) == len(set(ids.values()))


def test_near_duplicates_match_brute_force(small, small_docs, crowded_docs):
    expected = sorted(brute.near_duplicates([(r[0], r[1]) for r in small]), key=repr)
    for docs in (small_docs, crowded_docs):
        assert as_rows(jaccard_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == expected


def test_near_duplicates_of_sets_around_the_threshold(spark):
    rng = random.Random(11)
    rows = []
    for group in range(60):
        w = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([4, 5, 6, 7, 8, 9, 12, 16, 24, 40, 70, 150, 400]))]
        for _ in range(rng.choice([1, 2, 3, 6])):
            v = list(w)
            for _ in range(rng.randrange(0, max(2, len(w) // 30 + 2))):
                v[rng.randrange(len(v))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.5:
                v += [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 1 + len(w) // 4))]
            rows.append((len(rows), " ".join(v)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert as_rows(jaccard_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == sorted(brute.near_duplicates(rows), key=repr)


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for k in range(400):
        w = list(base)
        w[rng.randrange(200)] = f"x{k}"
        w[rng.randrange(200)] = f"z{k}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert as_rows(jaccard_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == sorted(brute.near_duplicates(rows), key=repr)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 9, 13, 30, 80, 200])
def test_sets_at_the_limit_share_a_key(size):
    """Any two sets with similarity 3/4 or more share an index key of one and a probe key of the other."""
    rng = np.random.default_rng(size)
    bands = frozenset(range(jaccard_join.band_of(jaccard_join.SMALL)))
    for _ in range(200):
        x = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        add = int(rng.integers(0, size // 3 + 1))
        drop = int(rng.integers(0, size // 4 + 1))
        y = np.unique(np.concatenate([rng.permutation(x)[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        common = len(np.intersect1d(x, y))
        if not len(y) or 100 * common < 75 * (len(x) + len(y) - common):
            continue
        try:
            (kx, rx), (ky, ry) = (jaccard_join.keys_of(s, bands, frozenset()) for s in (x, y))
        except AssertionError:
            (kx, rx), (ky, ry) = (jaccard_join.keys_of(s, bands, bands) for s in (x, y))
        shared = [(a, b) for k, a in zip(kx, rx, strict=True) for b in ry[ky == k]]
        assert any((a & 1 and b & 2) or (a & 2 and b & 1) for a, b in shared)


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = brute.components([p for p in pairs if p[0] != p[1]], {n for p in pairs[:-1] for n in p})
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_compact_windows_cover_every_run_once():
    rng = np.random.default_rng(2)
    for n in (0, 3, 8, 60):
        values = rng.integers(0, 9, n).astype(np.uint64)  # with ties
        cover = {}
        for a, at, b in passages.compact_windows(values, 5):
            for i in range(a, at + 1):
                for j in range(at, b + 1):
                    if j - i + 1 >= 5:
                        assert (i, j) not in cover
                        cover[i, j] = at
        assert set(cover) == {(i, j) for i in range(n) for j in range(i + 4, n)}
        assert all(values[at] == values[i : j + 1].min() for (i, j), at in cover.items())


def shared_runs(rows):
    """Pairs of documents with 46 equal shingles in a row."""
    grams = {}
    for d, t in rows:
        if d is not None and t:
            w = brute.words(t)
            for k in range(len(w) - 49):
                grams.setdefault(tuple(w[k : k + 50]), set()).add(d)
    return grams


def test_every_equal_passage_is_found(small, small_docs, crowded_docs):
    grams = shared_runs([(r[0], r[1]) for r in small])
    repeated = {d for ds in grams.values() if len(ds) > 1 for d in ds}
    texts = {r[0]: brute.words(r[1]) for r in small}
    for docs in (small_docs, crowded_docs):
        rows = passages.repeated_passages(docs).collect()
        found = {r.doc_id for r in rows} | {r.other_id for r in rows}
        assert repeated <= found
        for r in rows:
            assert r.other_id < r.doc_id
            for p in r.passages:
                assert p.stop - p.start >= 50
                x = {*brute.five_grams(" ".join(texts[r.doc_id][p.start : p.stop]))}
                y = {*brute.five_grams(" ".join(texts[r.other_id][p.other_start : p.other_stop]))}
                assert len(x & y) >= 0.75 * len(x | y)


def test_near_passages_are_found_and_prose_is_not(spark):
    rng = random.Random(8)

    def prose(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    rows, planted = [], set()
    for k in range(40):
        passage = prose(90)
        other = list(passage)
        other[45] = "changed"
        for copy in (passage, other):
            planted.add(len(rows))
            rows.append((len(rows), " ".join([*prose(100), *copy, *prose(100)])))
        rows.append((len(rows), " ".join(prose(300))))
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {d for r in found for d in (r.doc_id, r.other_id)} == planted


def alike(a, b):
    """Whether two lists of shingles have a run of 46 or more at the same place with a similarity of 0.75."""
    sums = np.concatenate(([0], np.cumsum([x == y for x, y in zip(a, b, strict=True)])))
    runs = [(j - i, sums[j] - sums[i]) for i in range(len(a)) for j in range(i + 46, len(a) + 1)]
    return any(4 * same >= 3 * (2 * n - same) for n, same in runs)


def test_variants_of_an_edited_first_copy_are_found(spark):
    rng = random.Random(21)

    def prose(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    rows, grams = [], {}
    for n in (60, 60, 70, 70, 80):  # every copy is edited, the first one as well
        passage = prose(n)
        for _ in range(30):
            copy = list(passage)
            copy[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
            grams[len(rows)] = n, passage, brute.five_grams(" ".join(copy))
            rows.append((len(rows), " ".join([*prose(40), *copy, *prose(40)])))
    pairs = [(a, b) for a in grams for b in grams if a < b and grams[a][1] is grams[b][1] and alike(grams[a][2], grams[b][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = [tuple(r) for r in passages.repeated_passages(docs).select("doc_id", "other_id").collect()]
    assert all(a // 30 == b // 30 for a, b in found) and len(found) == len(set(found))
    reached = brute.components(found, {d for d, _ in rows})
    assert len(pairs) > 1000 and not [p for p in pairs if reached[p[0]] != reached[p[1]]]


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.near_duplicates(none).count() == 0
    assert passages.repeated_passages(none).count() == 0


def test_shingles_need_enough_words():
    assert len(shingles(np.arange(4, dtype=np.uint64), 5)) == 0


def test_a_pair_is_made_at_its_first_common_key(spark):
    """Variants of one passage below the threshold share many keys; the last round makes each pair once."""
    member = spark.createDataFrame([(d, k, 3) for d in range(20) for k in range(40) if (d + k) % 5], "doc long, key long, role int")
    least = {r.doc: (r.indexed, r.looked) for r in jaccard_join._least_keys(member).collect()}
    keys = {d: [k for k in range(40) if (d + k) % 5] for d in range(20)}
    assert {d: (sorted(a), sorted(b)) for d, (a, b) in least.items()} == {d: (v[: jaccard_join.LEAST_KEYS],) * 2 for d, v in keys.items()}


def test_many_variants_around_one_passage_match_brute_force(spark):
    rng = random.Random(21)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for k in range(160):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(8, 40))]
        rows.append((k, " ".join([*own, *passage])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert as_rows(jaccard_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == sorted(brute.near_duplicates(rows), key=repr)
