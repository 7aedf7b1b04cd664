"""Score texts with an n-gram model held in Elias-Fano tries.

Probabilities interpolate three orders: the word by its count (add one half), the
word after the word before, and after the two before.  Contexts are the words
themselves, as hashes: the model grows with the corpus, and the probabilities of
all words after a context sum to one.

Tokens travel to a task chosen by the word before, with their word, the word before that
one and their document.  There the training tokens are counted into tries rooted at the word
before: its children are the words that follow it, and the words before it, which have the words
that follow both as children.  A level holds children as a monotone
sequence, pointers to each node's children as another, and quantised (rounded
down) discounted probabilities.  The distinct n-grams of the task are then looked up: a
node's pointers give the range of its children, and a search for the successor
of the child in that range finds it.

A task asks for the counts it cannot have, those of the words that follow: it sends each distinct word
with its own count to a task chosen by that word, which adds them up and answers.  A word before
with more tokens than a part should hold is spread by the two words before; the counts of its pairs are then
asked for in the same way.  Words with at least one in ``CODED_SHARE`` of all tokens are known to every task and travel as numbers.

Words are compared by 56 bits of their hash, words before by 48 within a part, those before them by 40 after the same word.

Null and empty texts are one end token.  Rows that repeat an id are scored one by
one and returned as often as they came.  A null id hashes as the empty string.
Without training text all counts are zero.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.elias_fano import Arena, EliasFano
from tidemart.llm.scratch import kept, width
from tidemart.llm.tokens import Words, mix, passes

END, START = np.uint64(0x656E6400), np.uint64(0x73746100)
#: Words are hashes without their last byte: it tells them from hashes of pairs.
WORD_BITS = ~np.uint64(0xFF)
PAIR_BIT = np.uint64(1)
#: Bits of the word before within a part, and of the one before it after the same word (and one to tell if it is coded).
BEFORE_BITS, CONTEXT_BITS = 48, 40
CODED_CONTEXT = 1 << CONTEXT_BITS
#: Interpolation weights of the two higher orders; the rest is the word's own.
WEIGHTS = (0.3, 0.4)
CODED_SHARE = 65_000
PACKED_TOKENS = 800_000
PACKED_TEXTS = 30_000
PARTS_PER_TASK = 4
STEPS = 4095


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


class Tokens(NamedTuple):
    """Tokens of some texts in order: word, the word before, hash of the two words before, number of the text, and the first of the two words before."""

    word: np.ndarray
    one: np.ndarray
    two: np.ndarray
    text: np.ndarray
    first: np.ndarray


def tokens_of(texts: list[bytes]) -> Tokens:
    words = Words(texts)
    n = len(texts)
    counts = np.diff(words.first)
    text = np.repeat(np.arange(n), counts + 1)
    word = np.full(len(text), END, np.uint64)
    ends = np.cumsum(counts + 1) - 1
    inner = np.ones(len(text), bool)
    inner[ends] = False
    word[inner] = words.hash & WORD_BITS
    before, before2 = np.roll(word, 1), np.roll(word, 2)
    begins = np.concatenate(([0], ends[:-1] + 1)) if n else ends
    before[begins] = START
    before2[begins] = START
    second = begins[counts > 0] + 1
    before2[second] = START
    two = mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(before2))
    return Tokens(word, before, two, text, before2)


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) over training texts."""

    def rows(words: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(words), 50_000):
            part = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(words[part].view(np.int64)), pa.array(n[part].astype(np.int64))], names=["word", "n"])

    def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        words, n = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        order = np.argsort(words, kind="stable")
        words, n = words[order], n[order]
        begin = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        return words[begin], np.add.reduceat(n, begin)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch, texts in passes(batches):
            train = np.array([not is_held_out(d) for d in batch.column("doc_id").to_pylist()], bool)
            tokens = tokens_of(texts)
            used = train[tokens.text]
            if used.any():
                found.append(np.unique(tokens.word[used], return_counts=True))
                size += len(found[-1][0])
            if size > 2_000_000:
                found = [merged(found)]
                size = 0
                if len(found[0][0]) > 1_000_000:
                    yield from rows(*found[0])
                    found = []
        if found:
            yield from rows(*merged(found))

    found = docs.select("doc_id", "text").mapInArrow(count, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Totals(NamedTuple):
    """What every task knows: corpus totals, the coded words with their counts, and over how many parts each is spread as the word before."""

    tokens: int
    words: int
    coded: np.ndarray
    counts: np.ndarray
    spread: np.ndarray

    def place(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word among the coded ones, and whether it is one."""
        at = np.minimum(np.searchsorted(self.coded, word), len(self.coded) - 1)
        return at, self.coded[at] == word


def totals(counts: DataFrame, parts: int) -> Totals:
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    found = counts.where((F.col("n") * CODED_SHARE >= n) | (F.col("word") == int(END))).toArrow()  # at most CODED_SHARE + 1 rows
    word = np.asarray(found.column("word")).astype(np.int64).view(np.uint64)
    count = np.asarray(found.column("n")).astype(np.int64)
    # a text starts as often as it ends
    word, count = np.append(word, START), np.append(count, count[word == END].sum())
    order = np.argsort(word)
    word, count = word[order], count[order]
    return Totals(n, v, word, count, np.where(count * parts >= max(n, 1), np.minimum(count * parts // max(n, 1) + 1, parts), 1))


class Level:
    """Children of the nodes of the level above: class, pointers, quantised log10 of the discounted probability."""

    def __init__(self, parents: int, bits: int, keys: np.ndarray, probability: np.ndarray):
        self.bits = bits
        self.children = EliasFano(keys, max(1, parents.bit_length()) + bits)
        offsets = np.searchsorted(keys >> np.uint64(bits), np.arange(parents + 1, dtype=np.uint64))
        self.pointers = EliasFano(offsets, max(1, len(keys).bit_length()))
        logs = np.log10(probability) if len(keys) else np.zeros(1)
        self.least, top = float(logs.min()), float(logs.max())
        self.step = max(top - self.least, 1e-9) / STEPS
        self.codes = np.floor((logs - self.least) / self.step).astype(np.uint16)

    def nbytes(self) -> int:
        return self.children.nbytes() + self.pointers.nbytes() + -(-self.codes.nbytes // 8) * 8

    def move(self, arena: Arena) -> None:
        self.children.move(arena)
        self.pointers.move(arena)
        self.codes = arena.put(self.codes)

    def find(self, parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node (or -1) and discounted probability (or 0) of a class below each parent (-1: none)."""
        node, value = np.full(len(parent), -1, np.int64), np.zeros(len(parent))
        live = np.flatnonzero(parent >= 0)
        if not len(live) or not self.children.n:
            return node, value
        above = parent[live]
        begin, end = (self.pointers.access(above + k).astype(np.int64) for k in (0, 1))
        key = (above.astype(np.uint64) << np.uint64(self.bits)) | child[live].astype(np.uint64)
        place = self.children.successor(key, begin, end)
        hit = place < end
        hit[hit] = self.children.access(place[hit]) == key[hit]
        node[live[hit]] = place[hit]
        value[live[hit]] = 10.0 ** (self.least + self.step * self.codes[place[hit]])
        return node, value


class Trie:
    """Training n-grams by the word before: the words that follow it, and the words before it with the words that follow both."""

    def __init__(self, roots: int, bits: int, follows: np.ndarray, p_follows: np.ndarray, contexts: np.ndarray, both: np.ndarray, p_both: np.ndarray):
        self.levels = (Level(roots, bits, follows, p_follows), Level(roots, CONTEXT_BITS + 1, contexts, np.ones(len(contexts))), Level(len(contexts), bits, both, p_both))
        arena = Arena(sum(level.nbytes() for level in self.levels))
        for level in self.levels:
            level.move(arena)


def planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on: these compress better."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def of_planes(raw: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def squeezed(*columns: np.ndarray) -> bytes:
    return pa.compress(b"".join(map(planes, columns)), "zstd", asbytes=True)


def of_squeezed(raw: bytes, *columns: tuple[int, type]) -> list[np.ndarray]:
    """The columns, given their lengths and kinds."""
    sizes = [n * np.dtype(kind).itemsize for n, kind in columns]
    flat = np.frombuffer(pa.decompress(raw, sum(sizes), "zstd", asbytes=True), np.uint8)
    return [of_planes(part, kind) for part, (_, kind) in zip(np.split(flat, np.cumsum(sizes)[:-1]), columns, strict=True)]


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending values, the first one from 0: their upper bytes are mostly empty."""
    return np.diff(ascending, prepend=np.uint64(0))


def cut_bytes(values: np.ndarray, begin: int, end: int) -> bytes:
    """These bytes of each 64-bit value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, begin:end].tobytes()


def of_bytes(raw: np.ndarray, begin: int, end: int) -> np.ndarray:
    out = np.zeros((len(raw) // (end - begin), 8), np.uint8)
    out[:, begin:end] = raw.reshape(-1, end - begin)
    return out.view("<u8").ravel()


class Slice(NamedTuple):
    """Tokens of a block in a part: distinct words before (ascending) with counts, then of each token its word and the first of the two before (number of the coded word, or 0 and next in ``rest``), and text."""

    before: np.ndarray
    count: np.ndarray
    code: np.ndarray
    first: np.ndarray
    text: np.ndarray
    rest: np.ndarray
    rest_first: np.ndarray

    def packed(self) -> bytes:
        small = squeezed(steps(self.before), self.count, self.code, self.first, self.text)
        sizes = np.array([len(self.before), len(self.code), len(self.rest), len(self.rest_first), len(small)], np.uint32)
        return b"".join((sizes.tobytes(), small, cut_bytes(self.rest, 1, 8), cut_bytes(self.rest_first, 0, CONTEXT_BITS // 8)))

    @classmethod
    def of(cls, raw: bytes) -> Slice:
        n_before, n, n_rest, n_first, n_small = np.frombuffer(raw, np.uint32, 5).tolist()
        small = of_squeezed(raw[20 : 20 + n_small], (n_before, np.uint64), (n_before, np.uint32), *[(n, np.uint16)] * 3)
        at = 20 + n_small
        rest = of_bytes(np.frombuffer(raw, np.uint8, 7 * n_rest, at), 1, 8)
        first = of_bytes(np.frombuffer(raw, np.uint8, CONTEXT_BITS // 8 * n_first, at + 7 * n_rest), 0, CONTEXT_BITS // 8)
        return cls(np.cumsum(small[0], dtype=np.uint64), *small[1:], rest, first)


def part_count(docs: DataFrame) -> int:
    return min(PARTS_PER_TASK * width(docs.sparkSession), (1 << 16) - 1)


def packed(docs: DataFrame, known: Totals) -> DataFrame:
    """Tokens in blocks by part, as slices.

    ``block`` numbers the blocks, whose first ``train`` texts are training texts; the document ids of a block are a row without tokens.
    """
    parts, tasks = part_count(docs), width(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    names = ["task", "part", "block", "train", "tokens", "ids", "missing"]

    def coded_words(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the coded words (else 0), the others, and how many of these come before each word."""
        at, coded = shared.value.place(words)
        return np.where(coded, at + 1, 0).astype(np.uint16), words[~coded], np.concatenate(([0], np.cumsum(~coded)))

    def block(pile: list[Tokens], ids: list[int | None], number: int) -> pa.RecordBatch:
        know = shared.value
        word, before, two, text, first = (np.concatenate([t[k] for t in pile]) for k in range(5))
        held = np.array([is_held_out(d) for d in ids], bool)
        turn = np.argsort(held, kind="stable")
        place = np.empty(len(ids), np.uint16)
        place[turn] = np.arange(len(ids))
        ids = [ids[k] for k in turn]
        route = mix(before ^ np.uint64(5)) >> np.uint64(32)
        part = route * np.uint64(parts) >> np.uint64(32)
        at, coded = know.place(before)
        wide = np.flatnonzero(coded & (know.spread[at] > 1))
        part[wide] = (part[wide] + mix(two[wide]) % know.spread[at[wide]].astype(np.uint64)) % np.uint64(parts)
        # the words before by the bits they are compared by
        key = (part << np.uint64(BEFORE_BITS)) | (before >> np.uint64(64 - BEFORE_BITS))
        order = np.argsort(key)
        key = key[order]
        word, first, text = word[order], first[order], place[text[order]]
        (code, rest, upto), (code_first, rest_first, upto_first) = coded_words(word), coded_words(first)
        rest_first >>= np.uint64(64 - CONTEXT_BITS)
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        many = np.diff(np.append(new, len(key))).astype(np.uint32)
        own = key[new] & np.uint64((1 << BEFORE_BITS) - 1)
        cuts = np.searchsorted(key >> np.uint64(BEFORE_BITS), np.arange(parts + 1, dtype=np.uint64))
        cuts_new = np.searchsorted(new, cuts)
        used = np.flatnonzero(np.diff(cuts)).tolist()
        slices = []
        for p in used:
            a, b = cuts[p], cuts[p + 1]
            mine = slice(cuts_new[p], cuts_new[p + 1])
            rests = rest[upto[a] : upto[b]], rest_first[upto_first[a] : upto_first[b]]
            slices.append(Slice(own[mine], many[mine], code[a:b], code_first[a:b], text[a:b], *rests).packed())
        none, k = [b""] * len(used), len(used)
        columns = [[p % tasks for p in used] + [number % tasks], [*used, -1], [number] * (k + 1), [len(ids) - int(held.sum())] * (k + 1), [*slices, b""]]
        columns += [[*none, np.array([0 if d is None else d for d in ids], np.int64).tobytes()], [*none, np.array([d is None for d in ids], np.uint8).tobytes()]]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pile, ids, size = [], [], 0
        number = TaskContext.get().partitionId() << 24
        for batch, texts in passes(batches):
            rows = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for at in range(0, len(texts), PACKED_TEXTS):
                tokens = tokens_of(texts[at : at + PACKED_TEXTS])
                if pile and (size + len(tokens.word) > PACKED_TOKENS or len(ids) + len(texts) > PACKED_TEXTS):
                    yield block(pile, ids, number)
                    pile, ids, size, number = [], [], 0, number + 1
                pile.append(tokens._replace(text=tokens.text + len(ids)))
                ids += rows[at : at + PACKED_TEXTS]
                size += len(tokens.word)
        if pile:
            yield block(pile, ids, number)

    return docs.select("doc_id", "text").mapInArrow(pack, "task int, part int, block long, train int, tokens binary, ids binary, missing binary")


class Part:
    """The tokens of a part: word before as a number (``root``), the one before it, word as a number, and text."""

    def __init__(self, rows: list[tuple[int, int, bytes]], known: Totals):
        slices = [Slice.of(raw) for _, _, raw in rows]
        lengths = [len(s.code) for s in slices]
        self.roots, at = np.unique(np.concatenate([s.before for s in slices]), return_inverse=True)
        self.root = np.repeat(at, np.concatenate([s.count for s in slices]))
        self.first = CODED_CONTEXT + np.concatenate([s.first for s in slices]).astype(np.int64)
        self.first[self.first == CODED_CONTEXT] = np.concatenate([s.rest_first for s in slices]).astype(np.int64)
        code = np.concatenate([s.code for s in slices])
        self.train = np.concatenate([s.text for s in slices]) < np.repeat([train for _, train, _ in rows], lengths)
        self.name = (np.repeat(np.array([block for block, _, _ in rows], np.int64), lengths) << 15) + np.concatenate([s.text for s in slices])
        # words as numbers: the coded ones, then the others
        rest, place = np.unique(np.concatenate([s.rest for s in slices]), return_inverse=True)
        self.word = code.astype(np.int64) - 1
        self.word[code == 0] = len(known.coded) + place
        self.words = len(known.coded) + len(rest)
        self.bits = max(1, self.words.bit_length())
        before = known.coded >> np.uint64(64 - BEFORE_BITS)
        at = np.minimum(np.searchsorted(before, self.roots), len(before) - 1)
        coded = before[at] == self.roots
        self.coded_root = np.where(coded, at, -1)
        wide = coded & (known.spread[at] > 1)
        # words and pairs whose count lies in other parts too
        self.follows, self.at_follows = np.unique((self.root << self.bits) | self.word, return_inverse=True)
        self.n_follows = np.bincount(self.at_follows[self.train], minlength=len(self.follows))
        self.asked_pairs = np.flatnonzero(wide[self.follows >> self.bits])
        pairs = self.follows[self.asked_pairs]
        hashes = np.concatenate((known.coded, rest))
        pairs = mix(self.roots[pairs >> self.bits] * np.uint64(0x9E3779B97F4A7C15) + mix(hashes[pairs & ((1 << self.bits) - 1)])) | PAIR_BIT
        n_rest = np.bincount(place[self.train[code == 0]], minlength=len(rest))
        asked = np.concatenate((rest, pairs))
        self.order = np.argsort(asked, kind="stable")
        self.asked = asked[self.order]
        self.n_asked = np.concatenate((n_rest, self.n_follows[self.asked_pairs]))[self.order]

    def sums(self, known: Totals, answer: np.ndarray) -> np.ndarray:
        """Rows (text, sums) of the part; ``answer`` has the counts of what it asked for."""
        n_asked = np.empty(len(answer), np.int64)
        n_asked[self.order] = answer
        n_rest = self.words - len(known.coded)
        count = np.concatenate((known.counts, n_asked[:n_rest]))
        p1 = (count + 0.5) / (known.tokens + 0.5 * (known.words + 1))
        n_follows = self.n_follows.copy()
        n_follows[self.asked_pairs] = n_asked[n_rest:]
        n_root = np.bincount(self.root[self.train], minlength=len(self.roots))
        n_root = np.where(self.coded_root >= 0, known.counts[self.coded_root], n_root)
        contexts, at_context = np.unique((self.root << CONTEXT_BITS + 1) | self.first, return_inverse=True)
        n_context = np.bincount(at_context[self.train], minlength=len(contexts))
        both, at_both = np.unique((at_context << self.bits) | self.word, return_inverse=True)
        n_both = np.bincount(at_both[self.train], minlength=len(both))
        # the trie holds the training n-grams, its contexts numbered among themselves
        held = [np.flatnonzero(n) for n in (n_follows, n_context, n_both)]
        number = np.cumsum(n_context > 0) - 1
        mask = (1 << self.bits) - 1
        context_of = both >> self.bits
        trie = Trie(
            len(self.roots),
            self.bits,
            self.follows[held[0]].astype(np.uint64),
            WEIGHTS[0] * n_follows[held[0]] / np.maximum(n_root[self.follows[held[0]] >> self.bits], 1),
            contexts[held[1]].astype(np.uint64),
            ((number[context_of[held[2]]] << self.bits) | (both[held[2]] & mask)).astype(np.uint64),
            WEIGHTS[1] * n_both[held[2]] / np.maximum(n_context[context_of[held[2]]], 1),
        )
        _, p2 = trie.levels[0].find(self.follows >> self.bits, self.follows & mask)
        node, _ = trie.levels[1].find(contexts >> CONTEXT_BITS + 1, contexts & (2 * CODED_CONTEXT - 1))
        _, p3 = trie.levels[2].find(node[context_of], both & mask)
        # an order whose context was never seen leaves its weight to the word's own probability
        some = np.empty(len(both), np.int64)
        some[at_both] = np.arange(len(at_both))
        own = 1 - WEIGHTS[0] * (n_root > 0)[self.root[some]] - WEIGHTS[1] * (node >= 0)[context_of]
        p = own * p1[self.word[some]] + p2[self.at_follows[some]] + p3
        names, text = np.unique(self.name, return_inverse=True)
        tokens = (None, (count > 0)[self.word], np.log10(p1)[self.word], np.log10(p)[at_both])
        sums = [np.bincount(text, weights, len(names)) for weights in tokens]
        return np.stack([names, *(s.view(np.int64) if s.dtype == float else s for s in sums)])


def answered(blocks: DataFrame, known: Totals) -> DataFrame:
    """(task, part, giver, counts): the corpus counts of all that the parts ask for, in the order they ask."""
    givers = width(blocks.sparkSession)
    shared = blocks.sparkSession.sparkContext.broadcast(known)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(task: int, number: int, pile: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            part = Part(pile, shared.value)
            giver = (part.asked >> np.uint64(32)) * np.uint64(givers) >> np.uint64(32)
            cuts = np.searchsorted(giver, np.arange(givers + 1, dtype=np.uint64))
            used = np.flatnonzero(np.diff(cuts)).tolist()
            n = part.n_asked.astype(np.uint32)
            columns = [np.diff(cuts)[used].tolist(), [squeezed(steps(part.asked[cuts[g] : cuts[g + 1]]), n[cuts[g] : cuts[g + 1]]) for g in used]]
            arrays = [pa.array(c, pa.int32()) for c in ([task] * len(used), [number] * len(used), used, columns[0])]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[1], pa.binary())], names=["task", "part", "giver", "n", "asked"])

        now, pile = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                task, number, *raw = (batch.column(c)[row].as_py() for c in range(5))
                if number < 0:
                    continue
                if (task, number) != now and pile:
                    yield rows(*now, pile)
                    pile = []
                now = (task, number)
                pile.append(tuple(raw))
        if pile:
            yield rows(*now, pile)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, keys, counts = [], [], []
        for batch in batches:
            heads += zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
            for n, raw in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                key, count = of_squeezed(raw, (n, np.uint64), (n, np.uint32))
                keys.append(np.cumsum(key, dtype=np.uint64))
                counts.append(count)
        if not heads:
            return
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(found)).astype(np.uint32)[place]
        cuts = np.cumsum([0, *map(len, keys)])
        for at in range(0, len(heads), 1000):
            some = range(at, min(at + 1000, len(heads)))
            blobs = [squeezed(total[cuts[k] : cuts[k + 1]]) for k in some]
            arrays = [pa.array([heads[k][c] for k in some], pa.int32()) for c in range(3)] + [pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["task", "part", "giver", "counts"])

    # all rows and columns as they were sent: then the exchange is read again, not made again
    asked = blocks.sortWithinPartitions("task", "part").mapInArrow(ask, "task int, part int, giver int, n int, asked binary")
    return asked.repartition(givers, "giver").mapInArrow(answer, "task int, part int, giver int, counts binary")


SUMS = ("n_tokens", "n_known", "base_score", "score")


def scored_parts(blocks: DataFrame, known: Totals) -> DataFrame:
    """Per task and block: the block's texts with token and known-word counts and the sums of base and model logarithms; and each block's ids once."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(known)
    names = ["block", "texts", "sums", "ids", "missing"]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())

    def rows(found: list[np.ndarray]) -> Iterator[tuple]:
        """The parts of a task, summed by text; a row for each block."""
        table = np.concatenate(found, axis=1)
        name, place = np.unique(table[0], return_inverse=True)
        sums = [np.bincount(place, table[1], len(name)), *(np.bincount(place, table[k].view(float), len(name)) for k in (2, 3, 4))]
        number, begin = np.unique(name >> 15, return_index=True)
        cuts = np.append(begin, len(name))
        for k, block in enumerate(number.tolist()):
            part = slice(cuts[k], cuts[k + 1])
            counts = [x[part].astype(np.uint32) for x in sums[:2]]
            yield block, (name[part] & 0x7FFF).astype(np.uint16).tobytes(), squeezed(*counts, *(x[part] for x in sums[2:])), b"", b""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        piles: dict[int, list[tuple[int, int, bytes]]] = {}
        out, found = [], []
        for number, block, train, tokens, ids, missing in zip(*(left.column(c).to_pylist() for c in ("part", "block", "train", "tokens", "ids", "missing")), strict=True):
            if number < 0:
                out.append((block, b"", b"", ids, missing))
            else:
                piles.setdefault(number, []).append((block, train, tokens))
        answers: dict[int, list[tuple[int, bytes]]] = {}
        for number, giver, counts in zip(*(right.column(c).to_pylist() for c in ("part", "giver", "counts")), strict=True):
            answers.setdefault(number, []).append((giver, counts))
        for number, pile in piles.items():
            part = Part(pile, shared.value)
            givers = (part.asked >> np.uint64(32)) * np.uint64(tasks) >> np.uint64(32)
            sizes = np.bincount(givers.astype(np.int64), minlength=tasks)
            given = [of_squeezed(c, (int(sizes[g]), np.uint32))[0] for g, c in sorted(answers.get(number, []))]
            found.append(part.sums(shared.value, np.concatenate([np.zeros(0, np.uint32), *given])))
        if found:
            out += rows(found)
        return pa.table([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names=names)

    tasks = width(spark)
    sent = blocks.repartition(tasks, "task")
    replies = answered(sent, known).repartition(tasks, "task")
    schema = "block long, texts binary, sums binary, ids binary, missing binary"
    return sent.groupBy("task").cogroup(replies.groupBy("task")).applyInArrow(score, schema)


def merged_texts(parts: DataFrame) -> DataFrame:
    """(doc_id, sums) of every text, from what each task has for its block."""

    def total(pile: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        ids = next(p[2] for p in pile if p[2])
        missing = next(p[3] for p in pile if p[3])
        sums = np.zeros((len(SUMS), len(ids) // 8))
        for texts, own, *_ in pile:
            if texts:
                # a text occurs once in what a task has
                n = len(texts) // 2
                sums[:, np.frombuffer(texts, np.uint16)] += np.stack(of_squeezed(own, *[(n, np.uint32)] * 2, *[(n, float)] * 2))
        arrays = [pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(missing, np.uint8).astype(bool))]
        arrays += [pa.array(s.astype(np.int64) if k < 2 else s) for k, s in enumerate(sums)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *SUMS])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pile = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                block, *raw = (c[row].as_py() for c in batch.columns)
                if block != now and pile:
                    yield total(pile)
                    pile = []
                now = block
                pile.append(raw)
        if pile:
            yield total(pile)

    spread = parts.repartition(width(parts.sparkSession), "block").sortWithinPartitions("block", "texts")
    return spread.mapInArrow(merge, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document, learnt from those not held out."""
    known = totals(kept(counted(docs), "ngram-counts"), part_count(docs))
    total = merged_texts(scored_parts(packed(docs, known), known))
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 1
    return total.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score")
