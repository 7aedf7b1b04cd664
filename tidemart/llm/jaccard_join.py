"""Exact Jaccard self-join on word shingles by partitioning the universe of shingles.

Sets fall into size bands such that two sets with similarity 3/4 lie in one band
or in neighbouring ones.  For each band the shingles are hashed into segments.
Two linked sets differ in at most (|x| + |y|) / 7 shingles, so of any more
segments of the larger set than that, the smaller one has at least one unchanged.

*Index.* A set indexes the part of it in each segment that it has something in,
in the partition of its band.  *Probe.* It looks in its own band and in the one
below, and needs only as many segments as may differ, plus one, and none that it
has nothing in.  Of the segments it has beyond that number it leaves out those whose
keys the most sets share.  Where a set has too few filled segments, one with two
shingles or more may count twice: it is then also looked up with one shingle
missing on either side.  Bands in which some set needs that index these
one-deletion neighbourhoods as well; bands in which it would not suffice index
single shingles.  So the search misses no pair, and every candidate is
verified on the whole sets.  Before that a parity bitmap of each set (a shingle
flips one bit) rules out pairs that share a passage only: two bitmaps differ in no
more bits than the sets do in shingles, and linked sets in at most (|x| + |y|) / 7.

Keys are exchanged in packed blocks.  Of the sets that share a key in one block
only the first goes on, so a key of a third of all rows reaches a task once per block.  Of the sets of a key first the pairs
with one centre are verified; pairs within a component need no look.  Further
centres follow as long as they halve the pairs across components, then all that
are left, each at the least key that both sets hold.  For that a row has the
``LEAST_KEYS`` least keys of its set; a pair whose common keys lie all beyond
those is made at each of them, so none is lost.  Equal sets are one set from the
start.  Nothing is capped.

Null and empty texts have an empty set, are linked with nothing and are their
own component.  A row without id is returned with its set size and no component,
and links nothing.  Rows that repeat an id are one document with several sets: it
is linked if one of them is.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.graph import components
from tidemart.llm.ids import of_ids
from tidemart.llm.scratch import kept, width
from tidemart.llm.tokens import Words, mix, passes, shingles

WIDTH = 5
#: Segments of a band as a share of its least size.
SEGMENTS = 0.6
#: Below this size a band always indexes one-deletion neighbourhoods.
SMALL = 48
PACKED_KEYS = 500_000
PACKED_DOCS = 4_000
PARTS_PER_TASK = 4
#: Open pairs for each row of the groups from which on they are first thinned out by centres.
MOST_PAIRS = 2
#: Least keys of a set that go with its rows, of those it is indexed by and of those it looks for.
LEAST_KEYS = 8
#: Bits of a set's parity bitmap, kept in columns of 64; of sets much larger than that it rules out little.
BITS = 512
MARKS = [f"bits{k}" for k in range(BITS // 64)]
_KEY = np.uint64((1 << 48) - 1)
INDEX, PROBE = 1, 2


def band_edges(most: int) -> list[int]:
    """Least size of each band: a set is at most 4/3 of one in the band below."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, 4 * (edges[-1] - 1) // 3 + 1))
    return edges


EDGES = np.array(band_edges(1 << 40), np.int64)


def band_of(size: int) -> int:
    return int(np.searchsorted(EDGES, size, side="right")) - 1


def segment_count(band: int) -> int:
    low, high, above = int(EDGES[band]), int(EDGES[band + 1]) - 1, int(EDGES[band + 2]) - 1
    return max(1, int(SEGMENTS * low), (high + above) // 7 + 1 if low < SMALL else 1)


def may_differ(size: int, band: int) -> int:
    """Most shingles by which a set of this size may differ from one in ``band`` that is not larger and linked with it."""
    return (min(size, int(EDGES[band + 1]) - 1) + size) // 7


class Parts:
    """One set cut into the segments of a band: sizes and sums of the non-empty parts."""

    def __init__(self, shingle_set: np.ndarray, band: int, single: bool):
        self.band = band
        if single:
            segment = np.arange(len(shingle_set))
        else:
            place = ((shingle_set >> np.uint64(32)) * np.uint64(segment_count(band))) >> np.uint64(32)
            segment = place.astype(np.int64)
        # sets are sorted by value, so segments come in order
        self.begin = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        self.sizes = np.diff(np.append(self.begin, len(segment)))
        self.members = mix(shingle_set)
        self.sums = np.add.reduceat(self.members, self.begin)
        self.numbers = segment[self.begin].astype(np.uint64) if not single else np.zeros(len(self.begin), np.uint64)

    def keys(self, sums: np.ndarray, numbers: np.ndarray, kind: int) -> np.ndarray:
        tag = mix((numbers << np.uint64(9)) + np.uint64(self.band * 2 + kind) + np.uint64(1))
        return mix(sums ^ tag)

    def exact(self, which: np.ndarray | slice = slice(None), kind: int = 0) -> np.ndarray:
        return self.keys(self.sums[which], self.numbers[which], kind)

    def deletions(self, which: np.ndarray, kind: int) -> np.ndarray:
        """Keys of the chosen parts (of two shingles or more) with one shingle less."""
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        chosen = np.isin(owner, which) & (self.sizes[owner] > 1)
        return self.keys(self.sums[owner[chosen]] - self.members[chosen], self.numbers[owner[chosen]], kind)

    def allocate(self, needed: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Parts to look up exactly and those to look up with a deletion, ``needed`` in all with the latter counted twice; None if too few."""
        n = len(self.sizes)
        if n >= needed:
            return np.argsort(-self.sizes, kind="stable")[:needed], np.zeros(0, np.int64)
        twice = np.flatnonzero(self.sizes > 1)
        twice = twice[np.argsort(self.sizes[twice], kind="stable")][: needed - n]
        if n + len(twice) < needed:
            return None
        return np.setdiff1d(np.arange(n), twice), twice


def set_of(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle as a whole."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(shingles(words, min(WIDTH, len(words))) ^ np.uint64(0 if len(words) >= WIDTH else len(words)))


def fingerprint(shingle_set: np.ndarray) -> tuple[int, int]:
    a = np.add.reduce(mix(shingle_set)) if len(shingle_set) else np.uint64(0)
    b = np.add.reduce(mix(shingle_set ^ np.uint64(0x5851F42D4C957F2D))) if len(shingle_set) else np.uint64(0)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def parity(shingle_set: np.ndarray) -> np.ndarray:
    """The bitmap in which each shingle flips one bit, as 64-bit numbers."""
    odd = np.bincount((shingle_set & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch, texts in passes(batches):
        words = Words(texts)
        yield batch.column("doc_id").cast(pa.int64()).to_pylist(), [set_of(words.hash[i:j]) for _, i, j in words.texts()]


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, n, f1, f2, needs, band, spare, spare_below, bits*): set size, fingerprint, what the search may leave out, and bitmap.

    ``needs`` has the bands in which the set needs more than exact parts (2 * band, odd: single shingles).
    ``spare`` is the number of filled segments beyond those needed, in the set's band and the one below.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches):
            prints = [fingerprint(s) for s in sets]
            needs, bands, spares = [], [], ([], [])
            for s in sets:
                need, spare = [], [0, 0]
                own = band_of(len(s)) if len(s) else -1
                for k, band in enumerate((own, own - 1)):
                    if band >= 0:
                        parts, needed = Parts(s, band, False), may_differ(len(s), band) + 1
                        found = parts.allocate(needed)
                        if found is None or len(found[1]):
                            need.append(2 * band + (found is None))
                        spare[k] = len(parts.sizes) - needed
                needs.append(need)
                bands.append(own)
                for k in (0, 1):
                    spares[k].append(0 if need else spare[k])
            arrays = [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1))]
            arrays += [pa.array(needs, pa.list_(pa.int32())), pa.array(bands, pa.int32()), *(pa.array(x, pa.int64()) for x in spares)]
            arrays += [pa.array(bits) for bits in np.array([parity(s) for s in sets], np.int64).reshape(-1, len(MARKS)).T.copy()]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "f1", "f2", "needs", "band", "spare", "spare_below", *MARKS])

    marks = "".join(f", {c} long" for c in MARKS)
    return docs.select("doc_id", "text").mapInArrow(describe, f"doc_id long, n long, f1 long, f2 long, needs array<int>, band int, spare long, spare_below long{marks}")


def keys_of(shingle_set: np.ndarray, deleted: frozenset[int], single: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set and their roles."""
    size, own = len(shingle_set), band_of(len(shingle_set))
    keys, roles = [], []

    def add(found: np.ndarray, role: int) -> None:
        keys.append(found)
        roles.append(np.full(len(found), role, np.uint8))

    for band in (own, own - 1):
        if band < 0:
            continue
        parts = Parts(shingle_set, band, band in single)
        lookup = parts.allocate(may_differ(size, band) + 1)  # always enough with single shingles
        if lookup is None:
            raise AssertionError(f"band {band} lacks segments for {size} shingles")
        _, twice = lookup
        # every filled segment is looked up; the join leaves out the costliest of those beyond the needed number
        add(parts.exact(), INDEX | PROBE if band == own else PROBE)
        if band == own and band in deleted and band not in single:
            add(parts.deletions(np.arange(len(parts.sizes)), 1), INDEX)
        if len(twice):
            add(parts.exact(twice, 1), PROBE)
            add(parts.deletions(twice, 0), PROBE)
    return np.concatenate(keys), np.concatenate(roles)


class Block:
    """Keys of some documents, joined within the block and packed by part."""

    def __init__(self, parts: int):
        self.parts = np.uint64(parts)
        self.reset()

    def reset(self) -> None:
        self.ids: list[int] = []
        self.keys: list[np.ndarray] = []
        self.tags: list[np.ndarray] = []
        self.size = 0
        self.seen: set[tuple[int, int]] = set()

    def add(self, doc: int, keys: np.ndarray, roles: np.ndarray) -> None:
        self.tags.append(roles.astype(np.uint16) + np.uint16(16 * len(self.ids)))
        self.ids.append(doc)
        self.keys.append(keys)
        self.size += len(keys)

    def full(self) -> bool:
        return self.size >= PACKED_KEYS or len(self.ids) >= PACKED_DOCS

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        ids = np.array(self.ids, np.int64)
        keys, tags = np.concatenate(self.keys), np.concatenate(self.tags)
        keys, docs, roles, groups = joined(keys, ids[tags >> 4], (tags & 15).astype(np.uint8))
        where = (keys >> np.uint64(48)) % self.parts
        order = np.lexsort((keys, where))
        keys, docs, roles, where = keys[order], docs[order], roles[order], where[order]
        cuts = np.searchsorted(where, np.arange(int(self.parts) + 1, dtype=np.uint64))
        local, place = np.unique(docs, return_inverse=True)
        tags = (16 * place + roles).astype(np.uint16)
        raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        columns: list[list] = [[], [], [], []]
        for part in range(int(self.parts)):
            a, b = cuts[part], cuts[part + 1]
            if a < b:
                used, again = np.unique(tags[a:b] >> 4, return_inverse=True)
                packed = (again.astype(np.uint16) << 4) | (tags[a:b] & 15)
                for column, v in zip(columns, (part, raw[a:b].tobytes(), packed.tobytes(), local[used].tobytes()), strict=True):
                    column.append(v)
        if len(groups):
            # what has met here passes through the exchange in a row of its own
            for column, v in zip(columns, (int(ids[0] % int(self.parts)), b"", b"", groups.tobytes()), strict=True):
                column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["part", "keys", "tags", "docs"])
        self.reset()


def joined(keys: np.ndarray, docs: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sets that share a key of which some are indexed and some probe.

    A role has two bits of the set's own and two of sets it stands for.  Returns
    the rows that go on (of such a key only its first document, standing for the
    others), and (key, document, own role) of all such keys.
    """
    order = np.lexsort((docs, keys))
    keys, docs, roles = keys[order], docs[order], roles[order]
    if not len(keys):
        return keys, docs, roles, np.zeros((0, 3), np.int64)
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(begin, len(keys)))
    all_roles = np.bitwise_or.reduceat(roles | roles >> 2, begin) & 3
    member = np.repeat((all_roles == INDEX + PROBE) & (docs[begin] != docs[begin + sizes - 1]), sizes)
    first = np.zeros(len(keys), bool)
    first[begin] = True
    goes = first | ~member
    groups = np.stack([(keys[member] & _KEY).astype(np.int64), docs[member], (roles[member] & 3).astype(np.int64)], 1) if member.any() else np.zeros((0, 3), np.int64)
    roles = np.where(member, roles & 3 | np.repeat(all_roles, sizes) << 2, roles)
    return keys[goes], docs[goes], roles[goes], groups


def candidates(docs: DataFrame, deleted: frozenset[int], single: frozenset[int], parts: int) -> DataFrame:
    """(key, doc, role) of the documents that share a key."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(parts)
        for ids, sets in _sets(batches):
            for doc, s in zip(ids, sets, strict=True):
                if doc is None or not len(s):
                    continue
                mark = fingerprint(s)
                if mark in block.seen:  # equal sets are linked by their fingerprints
                    continue
                block.seen.add(mark)
                block.add(doc, *keys_of(s, deleted, single))
                if block.full():
                    yield from block.rows()
        yield from block.rows()

    def found(groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(groups), 50_000):
            columns = np.ascontiguousarray(groups[at : at + 50_000].T)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "doc", "role"])

    def match(pile: list[tuple[bytes, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        keys, tags, docs = [], [], []
        for key, tag, doc in pile:
            wide = np.zeros((len(key) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(key, np.uint8).reshape(-1, 6)
            tag = np.frombuffer(tag, np.uint16)
            keys.append(wide.view("<u8").ravel())
            tags.append((tag & 15).astype(np.uint8))
            docs.append(np.frombuffer(doc, np.int64)[tag >> 4])
        yield from found(joined(np.concatenate(keys), np.concatenate(docs), np.concatenate(tags))[-1])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pile = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                part, key, tag, doc = (batch.column(k)[row].as_py() for k in range(4))
                if not key:
                    yield from found(np.frombuffer(doc, np.int64).reshape(-1, 3))
                    continue
                if part != now and pile:
                    yield from match(pile)
                    pile = []
                now = part
                pile.append((key, tag, doc))
        if pile:
            yield from match(pile)

    packed = docs.select("doc_id", "text").mapInArrow(pack, "part int, keys binary, tags binary, docs binary")
    return packed.repartition(max(1, parts // PARTS_PER_TASK), "part").sortWithinPartitions("part").mapInArrow(search, "key long, doc long, role long")


def sets_of(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles) as sorted arrays."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches):
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32), np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(make, "doc_id long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= 75 * union of some of their sets."""
    one, two = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    n = F.col("n")
    both = pairs.join(one, "a").join(two, "b").withColumn("n", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * n >= 75 * (F.size("sa") + F.size("sb") - n)).select("a", "b").distinct()


def links(docs: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between documents of different sets that join all components, and (doc_id, rep) of equal sets."""
    spark = docs.sparkSession
    needs = {r[0] for r in facts.select(F.explode("needs")).distinct().collect()}  # at most two for each band
    single = frozenset(x // 2 for x in needs if x % 2)
    deleted = frozenset(x // 2 for x in needs if x % 2 == 0) | frozenset(range(band_of(SMALL)))
    equal = facts.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    several = F.count_distinct("n", "f1", "f2") > 1  # such a document stands for itself
    reps = facts.where("doc_id is not null").join(equal, ["n", "f1", "f2"]).groupBy("doc_id")
    reps = kept(reps.agg(F.when(several, F.col("doc_id")).otherwise(F.min("rep")).alias("rep")), "reps")
    found = kept(candidates(docs, deleted, single, PARTS_PER_TASK * width(spark)), "candidates")

    # sizes of a representative: the least and the most of its sets
    size = facts.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("n").alias("low"), F.max("n").alias("high"), *[
        F.when(several | F.max(F.col("band").isin(*single) | (F.col("band") - 1).isin(*single)), 0).otherwise(F.min(c)).alias(c) for c in ("spare", "spare_below")
    ], *[F.when(~several, F.min(c)).alias(c) for c in MARKS])
    known = kept(reps.join(size.withColumnRenamed("doc_id", "rep"), "rep"), "known")

    own = known.select(F.col("doc_id").alias("doc"), "rep", "low", "high")
    member = found.join(own, "doc").groupBy("key", F.col("rep").alias("doc")).agg(F.bit_or("role").alias("role"), F.max("low").alias("low"), F.max("high").alias("high"))
    member = kept(_spared(kept(_meeting(member), "groups"), known), "spared")
    sets = kept(sets_of(of_ids(docs, kept(member.select("doc").distinct(), "members"))), "sets")

    proven = done = spark.createDataFrame([], "a long, b long")
    turn, before = 0, None
    while True:
        labels = components(proven).toDF("doc", "component") if turn else proven.toDF("doc", "component")
        told = member.join(labels, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        centre = F.min(F.struct(F.xxhash64(F.lit(turn), "doc") if turn else F.lit(0), "doc"))["doc"]
        split = told.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), centre.alias("centre"))
        told = kept(told.join(split.where("least <> most").select("key", "centre"), "key"), "open-groups")
        member = told.select(member.columns)
        # pairs across components, at most; centres go on as long as they halve them
        parts = told.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inner"))
        rows, open_pairs = parts.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("inner")) / 2)).first()
        if not rows:
            break
        stars = open_pairs > MOST_PAIRS * rows and (before is None or open_pairs < before / 2)
        before = open_pairs
        if not stars:
            told = kept(told.join(_least_keys(told), "doc"), "least-keys")
        about = ["doc", "role", "low", "high", "component", *MARKS, *([] if stars else ["indexed", "looked"])]
        # the larger set looks for the smaller one's index
        one = told.select("key", "centre", *[F.col(c).alias(f"{c}_a") for c in about])
        two = told.select("key", *[F.col(c).alias(f"{c}_b") for c in about])
        met = "(role_a & 1 > 0 and role_b & 2 > 0 and low_a <= high_b or role_a & 2 > 0 and role_b & 1 > 0 and low_b <= high_a)"
        near = "4 * high_a >= 3 * low_b and 4 * high_b >= 3 * low_a"
        differ = " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in MARKS)
        alike = f"coalesce(7 * ({differ}) <= high_a + high_b, true)"  # no bitmap: a document with several sets
        earlier = "coalesce(array_min(if({}, array_intersect(indexed_{}, looked_{}), null)) < key, false)"
        first = f"not {earlier.format('low_a <= high_b', 'a', 'b')} and not {earlier.format('low_b <= high_a', 'b', 'a')}"
        chosen = "doc_a = centre" if stars else f"doc_a < doc_b and {first}"
        pairs = one.join(two.withColumnRenamed("key", "key_b"), (F.col("key") == F.col("key_b")) & F.expr(f"component_a <> component_b and {met} and {near} and {alike} and {chosen}"))
        rest = pairs.select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b")).distinct()
        rest = kept(rest.join(done, ["a", "b"], "left_anti"), "rest")
        proven = kept(proven.unionByName(verified(rest, sets)), "proven")
        if not stars:
            break
        done = done.unionByName(rest)
        turn += 1
    return proven, reps


def _least_keys(member: DataFrame) -> DataFrame:
    """(doc, indexed, looked): the least keys a set is indexed by and those it looks for."""
    roles = member.select("doc", "key", F.explode(F.expr(f"filter(array({INDEX}, {PROBE}), x -> role & x > 0)")).alias("kind"))
    place = F.row_number().over(Window.partitionBy("doc", "kind").orderBy("key"))
    rows = roles.withColumn("place", place).where(F.col("place") <= LEAST_KEYS)
    own = [F.collect_list(F.when(F.col("kind") == k, F.col("key"))).alias(c) for k, c in ((INDEX, "indexed"), (PROBE, "looked"))]
    return rows.groupBy("doc").agg(*own)


def _meeting(member: DataFrame) -> DataFrame:
    """Rows of keys that some sets are indexed by and others look for."""
    keys = member.groupBy("key").agg(F.bit_or("role").alias("roles"), F.min("doc").alias("least"), F.max("doc").alias("most"))
    return member.join(keys.where("roles = 3 and least <> most").select("key"), "key", "left_semi")


def _spared(member: DataFrame, known: DataFrame) -> DataFrame:
    """Cost-based allocation: each set stops looking in the segments whose keys the most sets share, as far as it has spare ones."""
    cost = member.groupBy("key").agg(F.count("*").alias("cost"))
    spare = known.where("doc_id = rep").select(F.col("rep").alias("doc"), "spare", "spare_below", *MARKS)
    rows = member.join(cost, "key").join(spare, "doc").withColumn("own", F.expr("role & 1 > 0"))
    place = F.row_number().over(Window.partitionBy("doc", "own", F.expr("role & 2 > 0")).orderBy(F.desc("cost"), "key"))
    rows = rows.withColumn("place", place).withColumn("role", F.expr("if(place <= if(own, spare, spare_below), role & 1, role)"))
    rows = kept(_meeting(rows.where("role > 0").select(*member.columns, *MARKS)), "met")
    # keys of the same sets in the same roles bring the same pairs: one is enough
    made = rows.groupBy("key").agg(*[F.bit_xor(F.xxhash64(F.lit(k), "doc", "role")).alias(f"x{k}") for k in (0, 1)], F.count("*").alias("n"))
    return rows.join(made.groupBy("x0", "x1", "n").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    facts = kept(described(docs), "sets-described")
    proven, reps = links(docs, facts)
    # a document may have sets of its own under several representatives
    by_set = facts.where("n > 0 and doc_id is not null").select("doc_id", "n", "f1", "f2").distinct()
    smallest = by_set.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("b"))
    equal = by_set.join(smallest, ["n", "f1", "f2"]).where("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
    found = components(proven.unionByName(equal)).toDF("node", "component")
    return facts.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )
