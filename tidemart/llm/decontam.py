"""Find benchmark items in documents, also with other numbers, names or units.

Words lose the marks at their ends and are turned into a template: words with a
digit become a number slot, a unit after a number a unit slot, a capitalised word
inside a sentence a name slot.  A second template has the lower-cased words in
place of the names, for copies in other case.  In a third one capitalised words
that open a sentence or line are names as well and a run of names is one slot, for
renamed or re-wrapped openers and names of another word count.  Five-word windows
of all three that hold ``LITERALS`` words or more outside slots are hash-joined with those of the benchmark.  Other
windows, as of number tables or lists of names, are no evidence as templates: they are joined by their
words as they stand, and as templates only where they continue a diagonal that the join has found.  The matched windows of a document and
an item that lie on one diagonal make an occurrence; it counts if its slots are
consistent, that is each value of the item always stands for one value in the
document; of the third template only values that change are judged.  A document
holds an item if the windows of its occurrences cover at
least ``COVER`` of the item's.  Names that are changed and not capitalised either
are not recognised.

A bitmap of fixed size over the benchmark's windows drops other windows in the
task that reads a document; the join behind it is exact, so the benchmark may
have any size.  Items with fewer than five words are one window of all their
words, and so are documents; such an item is not looked for inside longer documents.  Null and empty texts have no window.  Rows that
repeat an id are judged together; a null id is an id.  Repeated items are items
of their own if their ids differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.bitmap import bitmap, held
from tidemart.llm.scratch import kept
from tidemart.llm.tokens import Words, mix, passes, shingles

WINDOW = 5
COVER = 0.75
CONSISTENT = 0.75
#: Words outside slots (of a shorter window: all its words, if fewer) that a window needs to be found as a template.
LITERALS = 2
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x6E756D626572, 0x6E616D65, 0x756E6974))
#: Units of measure and currencies that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz pound pounds ounce ounces ton tons "
    "gram grams kilogram kilograms ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years % percent degree degrees meter meters metre metres kilometer kilometers usd eur gbp dollar "
    "dollars cent cents euro euros hz khz mhz ghz kb mb gb tb mph kmh"
).split()
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "%$"]] = True


#: The template with collapsed names has windows of its own.
COLLAPSED = np.uint64(0x636F6C6C61707365)
#: And so have windows compared by their words.
AS_IT_STANDS = np.uint64(0x6173206974207374)


class Template(NamedTuple):
    value: np.ndarray
    slot: np.ndarray
    #: Where runs are one slot: whether the word is a name.
    name: np.ndarray | None = None


def templates(texts: list[bytes]) -> tuple[Words, tuple[Template, ...], np.ndarray, np.ndarray, np.ndarray]:
    """Words, the templates (value of each word and whether it is a slot), and hash, start and end byte of the words' bare forms."""
    words = Words(texts)
    start, end = words.start.copy(), words.end.copy()
    for _ in range(4):  # marks at the ends, closing ones first; a word of marks keeps its last
        end -= (end - start > 1) & _MARK[words.buffer[end - 1]]
        start += (end - start > 1) & _MARK[words.buffer[np.minimum(start, len(words.buffer) - 1)]]
    value = words.span_hash(start, end)
    first, second = words.buffer[start], words.buffer[np.minimum(start + 1, len(words.buffer) - 1)]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    digits = np.concatenate(([0], np.cumsum((words.buffer >= 48) & (words.buffer <= 57))))
    number = digits[end] > digits[start]
    opens = np.ones(len(start), bool)
    if len(start) > 1:
        last = words.buffer[words.end[:-1] - 1]
        lines = np.concatenate(([0], np.cumsum(words.buffer == 10)))
        opens[1:] = (last == ord(".")) | (last == ord("!")) | (last == ord("?")) | (last == ord(":")) | (lines[words.start[1:]] > lines[words.end[:-1]])
    name = capital & ~opens & ~number
    unit = np.zeros(len(start), bool)
    if len(start) > 1:
        listed = Words([" ".join(UNITS).encode()]).hash
        unit[1:] = number[:-1] & ~number[1:] & np.isin(value[1:], listed)
    name &= ~unit
    every = capital & ~number & ~unit
    plain = np.where(number, NUMBER, np.where(unit, UNIT, value))
    forms = (
        Template(np.where(name, NAME, plain), number | name | unit),
        Template(plain, number | unit),
        Template(np.where(every, NAME, plain), number | every | unit, every),
    )
    return words, forms, value, start, end


def places_of(forms: tuple[Template, ...], i: int, j: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of the words ``i`` to ``j``, for each template: its number, window hashes, which of them are new, and the first word of each token (``j`` at the end)."""
    known: list[np.ndarray] = []
    for number, form in enumerate(forms):
        if form.name is None:
            size = min(width, j - i)
            hashes, begin = shingles(form.value[i:j], size), np.arange(i, j + 1)
            new = np.ones(len(hashes), bool) if not known else hashes != known[0]
            known.append(hashes)
        else:
            name = form.name[i:j]
            begin = np.append(np.flatnonzero(~(name & np.concatenate(([False], name[:-1])))) + i, j)
            size = width
            hashes = shingles(form.value[begin[:-1]], size)
            if not len(hashes):
                continue
            hashes, new = hashes ^ COLLAPSED, np.ones(len(hashes), bool)
        yield number, hashes, np.flatnonzero(new), begin


def windows(rows: DataFrame, key: str, wanted: np.ndarray | None = None, width: int = WINDOW) -> DataFrame:
    """(key, pos, hash, template, slots, n, first, stop, runs) of every template window of each text, or of those with a bit in ``wanted``.

    ``template`` is the hash of the template; ``hash`` is the same in windows with enough literal words, that of the words
    themselves in others, and null in others of which runs of names are one slot.
    ``slots`` has the values at the slots of the window, in order; ``n`` the number of plain windows of the text, of which
    this one stands for those from ``first`` up to ``stop``; ``runs`` if runs of names are one slot, and ``pos`` counts such.
    """
    spark = rows.sparkSession
    shared = None if wanted is None else spark.sparkContext.broadcast(wanted)
    kinds = {key: pa.int64(), "pos": pa.int32(), "hash": pa.int64(), "template": pa.int64(), "slots": pa.list_(pa.string()), "n": pa.int32(), "first": pa.int32(), "stop": pa.int32(), "runs": pa.bool_()}
    schema = pa.schema(list(kinds.items()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in passes(batches):
            words, forms, bare, start, end = templates(texts)
            ids = batch.column(key).cast(pa.int64()).to_pylist()
            out: list[list] = [[] for _ in schema]
            for k, i, j in words.texts():
                if i == j:
                    continue
                n = j - i - min(width, j - i) + 1
                for number, hashes, places, begin in places_of(forms, i, j, width):
                    form = forms[number]
                    size = len(begin) - len(hashes)
                    literal = np.concatenate(([0], np.cumsum(~form.slot[begin[:-1]])))
                    weak = literal[size:] - literal[:-size] < min(LITERALS, size)
                    # runs of names have no words of their own to be compared by
                    seeds = hashes if form.name is not None else np.where(weak, shingles(bare[i:j], size) ^ AS_IT_STANDS, hashes)
                    if shared is not None:
                        places = places[held(shared.value, hashes[places]) | held(shared.value, seeds[places])]
                    for p in places.tolist():
                        # a token goes up to the next one's first word
                        tokens = [(begin[q], begin[q + 1] if form.name is not None and form.name[begin[q]] else begin[q] + 1) for q in range(p, p + size)]
                        values = [" ".join(bytes(words.lower[start[w] : end[w]]).decode(errors="replace") for w in range(x, y)) for x, y in tokens if form.slot[x]]
                        stop = n if p + 1 == len(hashes) else min(n, int(begin[p + 1]) - i)
                        for column, v in zip(out, (ids[k], p, None if weak[p] and form.name is not None else int(seeds[p].astype(np.int64)), int(hashes[p].astype(np.int64)), values, n, int(begin[p]) - i, stop, form.name is not None), strict=True):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return rows.select(key, "text").mapInArrow(cut, f"{key} long, pos int, hash long, template long, slots array<string>, n int, first int, stop int, runs boolean")


def leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, consistent: float = CONSISTENT) -> DataFrame:
    """(doc_id, item_id, coverage, exact): the items each document holds; ``exact`` if no slot has another value."""
    items = kept(windows(benchmark, "item_id").where("item_id is not null").withColumnsRenamed({"pos": "item_pos", "slots": "item_slots", "n": "item_n"}), "benchmark-windows")
    wanted = items.select(F.explode(F.array("hash", "template")).alias("hash")).where("hash is not null").distinct()
    found = kept(windows(docs, "doc_id", bitmap(wanted)).drop("n", "first", "stop"), "document-windows")
    seeds = found.drop("template", "runs").join(items.drop("template"), "hash").withColumn("diagonal", F.col("pos") - F.col("item_pos")).drop("hash", "pos", "item_pos")
    seeds = kept(seeds, "seeds")
    # windows of slots that continue a diagonal: the place in the document follows from that in the item
    weak = "hash is null or hash <> template"
    ahead = seeds.select("doc_id", "item_id", "runs", "diagonal").distinct().join(items.where(weak).drop("hash"), ["item_id", "runs"])
    ahead = ahead.withColumn("pos", F.col("diagonal") + F.col("item_pos")).withColumnRenamed("doc_id", "seed_doc").drop("item_pos")
    here = F.col("doc_id").eqNullSafe(F.col("seed_doc"))
    more = found.where(weak).drop("hash").join(ahead, "template pos runs".split()).where(here)
    matched = seeds.unionByName(more.select(seeds.columns))
    by = ("doc_id", "item_id", "runs", "diagonal")
    pairs = matched.select(*by, F.explode(F.arrays_zip("item_slots", "slots")).alias("pair"))
    bound = pairs.groupBy(*by, F.col("pair.item_slots").alias("was")).agg(F.min("pair.slots").alias("low"), F.max("pair.slots").alias("high"))
    unchanged = (F.col("low") == F.col("was")) & (F.col("high") == F.col("was"))
    slots = bound.groupBy(*by).agg(
        F.avg(F.when(~(F.col("runs") & unchanged), (F.col("low") == F.col("high")).cast("double"))).alias("steady"), F.min(unchanged.cast("int")).alias("same")
    )
    slots = slots.withColumnsRenamed({"doc_id": "s_doc", "item_id": "s_item", "runs": "s_runs", "diagonal": "s_diagonal"})
    spots = matched.select(*by, "item_n", F.explode(F.sequence("first", F.col("stop") - 1)).alias("item_pos")).groupBy(*by, "item_pos").agg(F.max("item_n").alias("item_n"))
    on = F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("item_id") == F.col("s_item")) & (F.col("runs") == F.col("s_runs")) & (F.col("diagonal") == F.col("s_diagonal"))
    good = spots.join(slots, on, "left").where(F.coalesce("steady", F.lit(1.0)) >= consistent)
    return (
        good.groupBy("doc_id", "item_id", "item_pos")
        .agg(F.max("item_n").alias("item_n"), F.max(F.coalesce("same", F.lit(1))).alias("same"))
        .groupBy("doc_id", "item_id")
        .agg((F.count("*") / F.max("item_n")).alias("coverage"), (F.min("same") == 1).alias("exact"))
        .where(F.col("coverage") >= cover)
    )
