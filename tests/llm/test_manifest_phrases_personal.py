"""Merkle manifest, phrase mining and personal data against plain versions, and their defined edge cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import collocations, merkle, personal

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# manifest


def plain_manifest(rows, arity, chosen):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root) of rows (doc_id, text, lang, source, n_chars)."""
    encoded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: sha("".join(map(encoded, (r[0], r[3], r[2], n, r[1]))))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
        return out

    def path(tree, i):
        out = []
        for level in tree[:-1]:
            begin = i - i % arity
            out.append(("".join(level[begin:i]), "".join(level[i + 1 : begin + arity])))
            i //= arity
        return out

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
    trees = {g: levels([x[2] for x in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for i, (*_, own, r) in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, place)
            h = leaf(r, r[4] + 1) if chosen(r) and r[4] is not None else own
            for left, right in steps:
                h = sha(left + h + right)
            out.append((r[0], own, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), h))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_matches_the_plain_tree(small, small_docs, crowded_docs, arity):
    expected = plain_manifest(small, arity, lambda r: r[0] is not None and r[0] % 7 == 0)
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    for docs in (small_docs, crowded_docs)[: 3 - arity]:
        found = merkle.manifest(docs, F.col("doc_id") % 7 == 0, arity).collect()
        assert sorted((tuple(r[n] for n in names) for r in found), key=repr) == expected
        assert all(r.verified == (r.folded_root == r.root) for r in found)
        changed = {(r[0], r[4]) for r in small if r[0] is not None and r[0] % 7 == 0}
        assert {r.doc_id for r in found if not r.verified} == {d for d, n in changed if n is not None}


def test_manifest_of_few_rows(spark):
    for rows in ([], [(1, "a", "x", "s", 1)], [(1, "a", "x", "s", 1), (2, None, None, None, None)], [(1, "a", "x", "s", 1)] * 5):
        found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), arity=2).collect()
        assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in found) == plain_manifest(rows, 2, lambda r: False)
        assert all(r.verified for r in found)


def test_numbers_within_a_hot_group(spark):
    rows = [("hot" if k % 3 else f"g{k}", k // 4) for k in range(600)]
    found = merkle.numbered(spark.createDataFrame(rows, "g string, k int"), "g", ["k"]).collect()
    by = collections.defaultdict(list)
    for r in found:
        by[r.g].append((r["index"], r.k, r.size))
    for got in by.values():
        got.sort()
        assert [g[0] for g in got] == list(range(len(got))) and [g[1] for g in got] == sorted(g[1] for g in got)
        assert {g[2] for g in got} == {len(got)}


# phrases


def plain_phrases(rows, least, longest, covered, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, words = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    counts[lang][tuple(w[i : i + size])] += 1
    out = []
    for lang, c in counts.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= covered * c[p[i : i + k]]}
        ranked = []
        for p, a in candidates.items():
            if p not in inside:
                score, _, left, right = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def crowd(rng, n):
    """Texts over few words, some of them in most places, with phrases that repeat and punctuation."""
    vocabulary = ["the", "of", "The", "ÉTÉ", "a", "x y", "\U0001f600"] + [f"w{k}" for k in range(40)]
    phrase = ["new york city hall", "of the of the", "the the the the", "w1 w2, w3 w4", "w5 w6\nw7 w8"]
    for _ in range(n):
        words = [rng.choice(phrase) if rng.random() < 0.1 else rng.choice(vocabulary[:7] if rng.random() < 0.5 else vocabulary) for _ in range(rng.randint(0, 30))]
        yield rng.choice(["en", "en", "de", None, "und"]), " ".join(words) + rng.choice(["", ".", "  \t "])


@pytest.mark.parametrize("least", [1, 3, 30])
def test_phrases_match_the_plain_count(spark, least):
    rows = list(crowd(random.Random(least), 300)) + [("en", None), ("en", ""), (None, "w1"), ("fr", "only once here")]
    docs = spark.createDataFrame([(lang, text, 1, 2) for lang, text in rows], "lang string, text string, n int, part int").repartition(4)
    found = sorted(tuple(r) for r in collocations.collocations(docs, least=least, top=50).collect())
    assert found == plain_phrases(rows, least, 4, 80, 50)


def test_phrases_of_other_lengths_and_of_no_rows(spark):
    rows = list(crowd(random.Random(9), 150))
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=4, longest=3, covered=50, top=20).collect()) == plain_phrases(rows, 4, 3, 50, 20)
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_sorted_prefixes_keep_what_hot_words_split():
    rng = np.random.default_rng(2)
    rows = np.full((4000, 4), -1, np.int32)
    for k in range(4):
        going = rng.random(4000) < 0.9 if k else np.ones(4000, bool)
        rows[:, k] = np.where(going & (rows[:, k - 1] >= 0 if k else True), np.minimum(rng.geometric(0.2, 4000), 30), -1)
    weight, hot = rng.integers(1, 4, 4000), np.arange(31) < 3
    counts = collections.Counter()
    for row, n in zip(rows.tolist(), weight.tolist()):
        for size in range(2, 5):
            if row[size - 1] >= 0:
                counts[tuple(row[:size])] += n
    found = {}
    for example, size, n in collocations.frequent_prefixes(rows, weight, hot, 25):
        for row, count in zip(rows[example, :size].tolist(), n.tolist()):
            assert found.setdefault(tuple(row), count) == count
    partial = lambda p: len(p) < 4 and all(hot[w] for w in p)
    assert found == {p: n for p, n in counts.items() if n >= 25 or partial(p)}


def test_a_long_text_is_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 40)
    text = b"one two three. four five six seven eight nine ten eleven twelve thirteen; a b c d e f g h i j k l m n o p! q"
    parts = collocations._cut(text)
    assert b"|".join(parts).replace(b"|", b"#") != text and len(parts) > 1
    pieces = lambda t: [p.split() for p in re.split(rb"[.;!]", t)]
    assert [p for part in parts for p in pieces(part)] == pieces(text)


# personal data


def luhn(number):
    worth = [int(c) for c in reversed(number)]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(worth)) % 10 == 0


def plain_base(text):
    text, out = text or "", []
    count = lambda m: len(re.sub("[^0-9]", "", m))
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= count(m) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= count(m) <= 15),
    }
    for kind, (pattern, good) in checks.items():
        out += [(kind, *m.span()) for m in re.finditer(pattern, text) if good(m.group(0))]
    return out


TOKENS = (
    "1 2 22 4111_1111_1111_1111 . - _ @ a.b x@y.com + +1_(212)_555-0123 (212)_555-0123 10.0.0.1 300.1.2.3 DE89_3704_0044_0532_0130_00 "
    "GB29NWBK60161331926819 _phone_ _ssn_ 123-45-6789 é \U0001f600 % 0005 255 ABCD 1234567890123"
).split()


def test_spans_hold_the_base_and_positions_are_code_points(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(TOKENS).replace("_", " ") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += [None, "", "a." * 300 + "@b.c", "4111111111111111 x " * 600, "x@y.zz " * 600]
    docs = spark.createDataFrame([(k, t, "taken") for k, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    for r in personal.digest(docs).collect():
        base = plain_base(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        kinds = collections.Counter(k for k, *_ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == sha(listed) and (r.spans == listed or r.spans.startswith(f"{listed}," if listed else ""))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("pay to DE89 3704 0044 0532 0130 00 SOON", "iban:7:34"),
        ("pay to GB29NWBK60161331926819.", "iban:7:29"),
        ("pay to DE89 3704 0044 0532 0130 01", ""),
        ("xDE89 3704 0044 0532 0130 00", ""),
        ("social security 123-45-6789", "ssn:16:27"),
        ("part number 123-45-6789", ""),
        ("call (212) 555-0123 now", "local:5:19"),
        ("model (212) 555-0123 now", ""),
        ("tel. +1 (212) 555-0123", "phone:5:22"),
        ("card 4111 1111 1111 1112", ""),
    ],
)
def test_checksums_and_context_decide(spark, text, expected):
    assert personal.digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans == expected


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([(1, "10.0.0.1 x"), (2, "host 10.0.0.1")], "doc_id long, text string")
    assert [r.spans[0]["score"] for r in personal.found(docs).orderBy("doc_id").collect()] == [60, 90]
    assert personal.found(docs.limit(0)).collect() == []


def test_masked_texts_hold_no_base_span(spark, small_docs):
    docs = spark.createDataFrame([(1, "é a@b.cd, 10.0.0.1 and +1 212 555 0123 end", "kept"), (2, None, "x"), (3, "plain", "y")], "doc_id long, text string, spans string")
    found = {r.doc_id: r for r in personal.masked(docs).collect()}
    assert found[1].text == "é [email], [ip] and [phone] end" and found[2].text is None and found[3].text == "plain"
    assert personal.masked(small_docs).columns == small_docs.columns


@pytest.mark.parametrize("text", ["a" * 100_000, "1" * 100_000, "1 " * 30_000, "a@" * 30_000, "+1" * 30_000, "AB12" * 20_000])
def test_long_runs_take_linear_time(spark, text):
    assert personal.digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).count() == 1


