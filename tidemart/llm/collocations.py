"""Phrases whose words belong together, per language.

A phrase is two to ``longest`` words in a row within a piece of text; pieces end at
``.,;:!?`` and line ends.  Counting is a multikey three-way quicksort of suffix
pointers.  Every word is the start of a suffix of at most ``longest`` words.  The
suffixes are dealt by their leading words to tasks, each task sorts its own, and
the partition of the rows equal to the pivot has, by its size, the count of a phrase.
A partition below the least count is abandoned unsorted.

Dealing: words are counted first.  A suffix ends before its first infrequent word
(looked up in a bitmap of fixed size; a false hit costs work, never a result).
It goes to the task of its first word, or, while its words are hot, that is, hold
more than half a task's share of all words, to the task of its first two, three
and so on; so no task gets much more than its share however common a phrase is.
The list of hot words is at most twice as long as there are tasks.  A prefix of hot words alone is
counted by several tasks; their counts are added up.  Equal suffixes of a block of
texts travel as one row with their number.  Words travel as text, so no result rests
on a hash.

Score of a phrase: each cut into two parts has ``2000000 * a // (l + r)`` with the
counts of the phrase and its parts; the cut with the lowest score counts, the first
of equals.  Phrases inside a longer one with ``covered`` percent of their count go.

Null texts are empty and a null language is ``und``.  Empty texts and texts
without words add nothing; repeated rows count each time; ids and further columns are never
read.  An empty table gives an empty result.  Ties in the ranking break by the
phrase's bytes.  A text longer than a block is cut at ends of pieces; one piece is never cut.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.bitmap import bitmap, held
from tidemart.llm.scratch import kept, width
from tidemart.llm.tokens import hand_back, mix

_END = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(_END)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text counted or cut into suffixes at once.
BLOCK = 12 << 20

COUNTED = "lang string, word string, hash long, n long"
DEALT = "lang string, part int, words string, at binary, n binary"
SORTED = "lang string, phrase string, n long"


def _cut(text: bytes) -> list[bytes]:
    """A text in parts of about ``BLOCK`` bytes that end where a piece ends."""
    if len(text) <= BLOCK:
        return [text]
    ends = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8)] == 2)
    out, begin = [], 0
    while len(text) - begin > BLOCK:
        k = np.searchsorted(ends, begin + BLOCK)
        if k == len(ends):
            break
        out.append(text[begin : ends[k]])
        begin = int(ends[k]) + 1
    return [*out, text[begin:]]


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, gathered until all languages together fill a block."""
    waiting: dict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for k, text in enumerate(batch.column("text").cast(pa.binary())):
            for part in _cut(text.as_py() or b""):
                waiting[langs[k]].append(part)
                size += len(part) + 1
                if size > BLOCK:
                    yield from waiting.items()
                    waiting.clear()
                    size = 0
                    hand_back()
    yield from waiting.items()


def tokens(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The lower-cased words of all texts in order, and the number of the piece each is in."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[buffer]
    solid = kind == 0
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    letters = _LOWER[buffer[solid]]
    words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode(), np.cumsum(kind == 2)[start]


def _hashes(lang: str, names: list[str]) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names), np.uint64, len(names))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The count of each word of a block; a row without a word has the number of all."""
    for lang, texts in blocks(batches):
        words, _ = tokens(texts)
        names = words.dictionary.to_pylist()
        n = np.bincount(words.indices.to_numpy(), minlength=len(names))
        hashes = np.append(_hashes(lang, names).view(np.int64), 0)
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * (len(names) + 1), pa.string()),
                "word": pa.array([*names, None], pa.string()),
                "hash": hashes,
                "n": np.append(n, len(words)).astype(np.int64),
            }
        )


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, word, hash, n) of the words found ``least`` times, and the number of all words where the word is null."""
    counted = _texts(docs).mapInArrow(_count, COUNTED)
    summed = counted.groupBy("lang", "word").agg(F.min("hash").alias("hash"), F.sum("n").alias("n"))
    return summed.where(F.col("word").isNull() | (F.col("n") >= least))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")


def _suffixes(words: pa.DictionaryArray, piece: np.ndarray, frequent: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of two words or more as rows of word numbers (-1: ended before), and how often each occurs."""
    at = words.indices.to_numpy().astype(np.int32)
    going = frequent[at]
    columns = [at]
    for k in range(1, longest):
        ahead = np.full(len(at), -1, np.int32)
        ahead[:-k] = at[k:] if len(at) > k else ahead[:-k]
        within = np.zeros(len(at), bool)
        within[:-k] = piece[k:] == piece[:-k] if len(at) > k else within[:-k]
        going = going & within & frequent[ahead]
        columns.append(np.where(going, ahead, np.int32(-1)))
    whole = columns[1] >= 0
    names = [f"w{k}" for k in range(longest)]
    table = pa.table({name: c[whole] for name, c in zip(names, columns)})
    table = table.group_by(names).aggregate([([], "count_all")])
    return np.stack([table[name].to_numpy() for name in names], axis=1), table["count_all"].to_numpy().astype(np.int32)


def _dealer(frequent: np.ndarray, hot: dict[str, set[str]], parts: int, longest: int):
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in blocks(batches):
            words, piece = tokens(texts)
            if not len(words):
                continue
            names = words.dictionary.to_pylist()
            hashes = _hashes(lang, names)
            rows, n = _suffixes(words, piece, held(frequent, hashes), longest)
            if not len(rows):
                continue
            hot_here = hot.get(lang, set())
            is_hot = np.fromiter((w in hot_here for w in names), bool, len(names))
            key, going = hashes[rows[:, 0]], is_hot[rows[:, 0]]
            for k in range(1, longest):  # the first word that is not hot is the last to count
                key = np.where(going & (rows[:, k] >= 0), mix(key + hashes[rows[:, k]]), key)
                going &= (rows[:, k] >= 0) & is_hot[rows[:, k]]
            part = (mix(key) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            rows, n, part = rows[order], n[order], part[order]
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            for i, j in zip(begins, [*begins[1:], len(part)]):
                used, place = np.unique(rows[i:j], return_inverse=True)
                place = place.reshape(-1, longest).astype(np.int32) - np.int32(used[0] < 0)
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang], pa.string()),
                        "part": pa.array([part[i]], pa.int32()),
                        "words": pa.array([" ".join([names[w] for w in used.tolist() if w >= 0])], pa.string()),
                        "at": pa.array([place.tobytes()], pa.binary()),
                        "n": pa.array([n[i:j].tobytes()], pa.binary()),
                    }
                )
            hand_back()

    return deal


def frequent_prefixes(rows: np.ndarray, n: np.ndarray, hot: np.ndarray, least: int, seed: int = 0) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Multikey three-way quicksort of suffixes: (an example row, number of words, count) of each frequent prefix.

    ``rows`` has one suffix a row, as numbers of words, -1 after its end; ``n`` its
    weight.  All open segments of the pointer array are partitioned together, each
    around a pivot of its own: smaller rows to the front, larger ones to the back, the
    equal ones between; those go on with the next word.  Segments lighter than
    ``least`` are abandoned, unless they have a prefix of hot words alone, as
    that prefix is counted elsewhere too; such prefixes are given whatever their count.
    """
    longest = rows.shape[1]
    rng = np.random.default_rng(seed)
    pointer = np.arange(len(rows))
    size = np.array([len(rows)] if len(rows) else [], np.int64)
    depth = np.zeros(len(size), np.int64)
    opened = np.ones(len(size), bool)  # the prefix so far is of hot words alone
    while len(size):
        start = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(size)), size)
        key = rows[pointer, depth[segment]]
        pivot = key[start + (rng.random(len(size)) * size).astype(np.int64)]
        split = np.sign(key - pivot[segment]) + 1  # 0: before the pivot, 1: equal, 2: after it
        # a place for each row: by segment, then by side, in the order they had
        bucket = segment * 3 + split
        held_by = np.bincount(bucket, minlength=3 * len(size))
        rank = np.empty(len(key), np.int64)
        for side in range(3):
            here = split == side
            seen = np.cumsum(here)
            before = np.concatenate(([0], seen))[start]
            rank[here] = (seen - 1 - before[segment])[here]
        moved = np.empty_like(pointer)
        place = (np.cumsum(held_by) - held_by)[bucket] + rank
        moved[place] = pointer
        key_moved = np.empty_like(key)
        key_moved[place] = key
        pointer = moved

        filled = held_by > 0
        size = held_by[filled]
        start = np.cumsum(size) - size
        side = np.tile(np.arange(3), len(depth))[filled]
        depth, opened = np.repeat(depth, 3)[filled], np.repeat(opened, 3)[filled]
        weight = np.add.reduceat(n[pointer], start)
        equal = side == 1
        first = key_moved[start]
        # an equal segment has one more word in common
        ended = equal & (first < 0)
        opened = opened & np.where(equal, (first >= 0) & hot[first], True)
        depth = depth + equal
        partial = opened & (depth < longest)
        found = equal & ~ended & (depth >= 2) & ((weight >= least) | partial)
        for words in range(2, longest + 1):
            these = found & (depth == words)
            if these.any():
                yield pointer[start[these]], words, weight[these]
        # what may still hold a frequent prefix, or one that is counted in parts
        any_hot = np.logical_or.reduceat((key_moved >= 0) & hot[key_moved], start)
        worth = (weight >= least) | np.where(equal, partial, partial & any_hot)
        stays = worth & ~ended & (depth < longest)
        pointer = pointer[np.repeat(stays, size)]
        size, depth, opened = size[stays], depth[stays], opened[stays]


def _sorter(hot: dict[str, set[str]], least: int, longest: int):
    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(count().__next__))
        rows: dict[str, list[np.ndarray]] = defaultdict(list)
        weights: dict[str, list[np.ndarray]] = defaultdict(list)
        for batch in batches:
            for r in batch.to_pylist():
                number, words = numbers[r["lang"]], r["words"].split(" ")
                own = np.fromiter((number[w] for w in words), np.int32, len(words))
                at = np.frombuffer(r["at"], np.int32).reshape(-1, longest)
                rows[r["lang"]].append(np.where(at >= 0, own[at], np.int32(-1)))
                weights[r["lang"]].append(np.frombuffer(r["n"], np.int32))
        for lang, number in numbers.items():
            names, hot_here = list(number), hot.get(lang, set())
            is_hot = np.fromiter((w in hot_here for w in names), bool, len(names))
            table = np.concatenate(rows.pop(lang))
            for example, words, n in frequent_prefixes(table, np.concatenate(weights.pop(lang)).astype(np.int64), is_hot, least):
                phrases = [" ".join([names[w] for w in row]) for row in table[example, :words].tolist()]
                yield pa.record_batch({"lang": pa.array([lang] * len(phrases), pa.string()), "phrase": pa.array(phrases, pa.string()), "n": n})
        hand_back()

    return sort


def phrase_counts(docs: DataFrame, words: DataFrame, least: int = 30, longest: int = 4) -> DataFrame:
    """(lang, phrase, n) of the phrases of two to ``longest`` words found ``least`` times; ``words`` has the stored word counts."""
    parts = width(docs.sparkSession)
    total = words.where("word is null").agg(F.sum("n")).first()[0] or 0
    hot: dict[str, set[str]] = defaultdict(set)
    for r in words.where(F.col("word").isNotNull() & (F.col("n") > total / (2 * parts))).select("lang", "word").collect():
        hot[r.lang].add(r.word)
    frequent = bitmap(words.where("word is not null"))
    dealt = _texts(docs).mapInArrow(_dealer(frequent, dict(hot), parts, longest), DEALT)
    found = dealt.repartitionById(parts, F.col("part")).mapInArrow(_sorter(dict(hot), least, longest), SORTED)
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _run(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Add the counts ``l`` and ``r`` of the lowest-scoring cut's parts and its ``score`` to (lang, phrase, n)."""
    counts = phrases.unionByName(words.where("word is not null").select("lang", F.col("word").alias("phrase"), "n"))
    parts = F.split("phrase", " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(parts) - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "k", _run(parts, F.lit(1), F.col("k")).alias("left"), _run(parts, F.col("k") + 1, F.size(parts) - F.col("k")).alias("right")
    )
    first = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(first, ["lang", "left"]).join(rest, ["lang", "right"])
    exact = F.expr("(cast(a as decimal(19, 0)) * 2000000bd) div (cast(l as decimal(19, 0)) + r)")
    lowest = F.min(F.struct(exact.alias("score"), "k", "l", "r"))
    return both.groupBy("lang", "phrase", "a").agg(lowest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covering(phrases: DataFrame) -> DataFrame:
    """The greatest count of a longer phrase around each phrase that has one: (lang, phrase, around)."""
    parts, size = F.split("phrase", " "), F.size(F.split("phrase", " "))
    lengths = phrases.where(size > 2).withColumn("length", F.explode(F.sequence(F.lit(2), size - 1)))
    starts = lengths.withColumn("start", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)))
    inner = starts.select("lang", _run(parts, F.col("start"), F.col("length")).alias("phrase"), "n")
    return inner.groupBy("lang", "phrase").agg(F.max("n").alias("around"))


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, covered: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n (all words of the language), score."""
    words = kept(word_counts(docs, least), "words")
    phrases = kept(phrase_counts(docs, words, least, longest), "phrases")
    around = F.col("around").cast("decimal(19, 0)") * 100 >= F.col("a").cast("decimal(19, 0)") * covered
    open_ = scored(phrases, words).join(covering(phrases), ["lang", "phrase"], "left").where(~F.coalesce(around, F.lit(False)))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share first, so that no task ranks a whole language
    share = F.pmod(F.xxhash64("phrase"), F.lit(width(docs.sparkSession)))
    some = open_.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    totals = words.where("word is null").select("lang", F.col("n").alias("all_words"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")
