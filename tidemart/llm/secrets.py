"""Find secrets with a trigram inverted index over blocks of documents.

Every rule is a regex.  From its parse tree a Boolean query over trigrams is
derived that any matching text satisfies.  A block of documents is indexed for
the trigrams that the queries ask for: one pass over the bytes of the block
gives the postings, sets of document numbers.  The query's postings are
intersected and united, and the rule's regex runs on the candidates only.  A rule
without mandatory trigrams scans every document.  A block is indexed and searched
in the task that reads it, so nothing is shuffled and a lost task is simply run again.

Spans are in code points with an exclusive end.  A null text has no spans.  Rows
that repeat an id are searched one by one; a null id is returned as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from re import _constants as c
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tokens import passes


class Rule(NamedTuple):
    kind: str
    pattern: str
    #: Group whose length is checked, and the least length.
    group: int = 0
    least: int = 0
    any_case: bool = False


#: The base kinds, in their order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: A key in PEM form goes through its END line; without one through its base64 block (lines of 16 or more and
#: a shorter last one, after any header lines), and where the text breaks off through its end.
_LABEL, _CODE, _GAP = "[A-Z0-9 ]{0,24}PRIVATE KEY(?: BLOCK)?", "[A-Za-z0-9+/=]", r"""(?:\\[nrt]|[\s"'>#*|,\\])"""
_BLOCK = rf"(?:\s*[A-Za-z][A-Za-z0-9-]*:[^\n]*\n){{0,8}}{_GAP}*{_CODE}{{16,}}(?:{_GAP}+{_CODE}{{16,}})*(?:{_GAP}+{_CODE}+)?"
#: Further kinds by the published shapes of common credentials.
MORE = (
    Rule("private", rf"-----BEGIN {_LABEL}-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END {_LABEL}-----|{_BLOCK}|{_GAP}*{_CODE}+\s*\Z)?"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("cloud", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login", r"[a-z]{2,12}://[A-Za-z0-9_.-]{1,64}:[^\s/@:]{3,64}@[A-Za-z0-9.-]+"),
)
RULES = BASE + MORE

#: Strings that a part of a regex may stand for are listed up to this number.
MOST_STRINGS = 16
ANY = ("and", frozenset())


def _both(kind: str, parts: Iterable) -> tuple:
    """AND or OR of queries; an AND of nothing holds for every text."""
    flat = set()
    for part in parts:
        if part == ANY:
            if kind == "or":
                return ANY
        elif isinstance(part, tuple) and part[0] == kind:
            flat |= part[1]
        else:
            flat.add(part)
    return next(iter(flat)) if len(flat) == 1 else (kind, frozenset(flat))


def _grams(strings: set[str] | None) -> tuple | bytes:
    """Query of a text that holds one of the strings."""
    if not strings:
        return ANY
    coded = [s.encode() for s in strings]
    return _both("or", [_both("and", [s[k : k + 3] for k in range(len(s) - 2)]) for s in coded])


def _exact(items: Iterable) -> set[str] | None:
    """The characters of a class, in lower case, if there are few."""
    chars: set[str] = set()
    for op, value in items:
        if op is c.LITERAL:
            chars.add(chr(value).lower())
        elif op is c.RANGE and value[1] - value[0] < MOST_STRINGS:
            chars |= {chr(x).lower() for x in range(value[0], value[1] + 1)}
        else:
            return None
    return chars if len(chars) <= MOST_STRINGS else None


def _analyse(nodes: Iterable) -> tuple[set[str] | None, tuple | bytes]:
    """Of a sequence: its strings if they are few, and the query of a text that holds a match."""
    run, parts, whole = {""}, [], True
    for op, value in nodes:
        exact: set[str] | None = None
        query: tuple | bytes = ANY
        if op is c.LITERAL:
            exact = {chr(value).lower()}
        elif op is c.IN:
            exact = _exact(value)
        elif op is c.SUBPATTERN:
            exact, query = _analyse(value[-1])
        elif op is c.BRANCH:
            found = [_analyse(x) for x in value[1]]
            if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= MOST_STRINGS:
                exact = set().union(*(s for s, _ in found))
            query = _both("or", [_both("and", [q, _grams(s)]) for s, q in found])
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, high, inner = value
            strings, asked = _analyse(inner)
            if (low, high) == (1, 1):
                exact, query = strings, asked
            elif (low, high) == (0, 1) and strings is not None:
                exact = strings | {""}
            elif low:
                query = _both("and", [asked, _grams(strings)])
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
        else:
            parts += [_grams(run), query if exact is None else _grams(exact)]
            run, whole = {""}, False
            continue
        parts.append(query)
    return (run, _both("and", parts)) if whole else (None, _both("and", [*parts, _grams(run)]))


def trigram_query(pattern: str) -> tuple | bytes:
    """What every text with a match holds, in lower-case trigrams: a trigram, or ("and" | "or", parts); ``ANY`` if nothing is mandatory."""
    strings, query = _analyse(_parser.parse(pattern))
    return _both("and", [query, _grams(strings)])


def _leaves(query: tuple | bytes) -> set[bytes]:
    return {query} if isinstance(query, bytes) else set().union(*map(_leaves, query[1]), set())


class TrigramIndex:
    """Postings of a block of texts for a fixed set of trigrams."""

    def __init__(self, texts: list[bytes], wanted: dict[int, int], slots: np.ndarray):
        block = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        block = np.where((block >= 65) & (block <= 90), block + 32, block).astype(np.uint32)
        codes = block[:-2] << 16 | block[1:-1] << 8 | block[2:] if len(block) > 2 else np.zeros(0, np.uint32)
        found = slots[codes]
        places = np.flatnonzero(found)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        pairs = np.unique(found[places].astype(np.int64) * len(texts) + np.searchsorted(ends, places, side="right"))
        gram, doc = np.divmod(pairs, max(1, len(texts)))
        cuts = np.searchsorted(gram, np.arange(len(wanted) + 2))
        self.postings = {code: set(doc[cuts[slot] : cuts[slot + 1]].tolist()) for code, slot in wanted.items()}
        self.every = set(range(len(texts)))

    def candidates(self, query: tuple | bytes) -> set[int]:
        if isinstance(query, bytes):
            return self.postings[int.from_bytes(query, "big")]
        found = sorted((self.candidates(part) for part in query[1]), key=len)
        if query[0] == "or":
            return set().union(*found)
        return set.intersection(self.every, *found) if found else self.every


class Finder:
    """Rules with their queries, ready to search blocks of texts."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        # runs that must be long enough are searched by their least length at once
        self.regexes = [re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)) for r in rules]
        grams = sorted(set().union(*map(_leaves, self.queries)))
        self.wanted = {int.from_bytes(g, "big"): k + 1 for k, g in enumerate(grams)}
        self.slots = np.zeros(1 << 24, np.uint8 if len(grams) < 256 else np.uint16)
        self.slots[list(self.wanted)] = list(self.wanted.values())
        self.long_hex = re.compile(r"[0-9a-f]{24,}")

    def spans(self, rule: int, text: str) -> list[tuple[int, int, int]]:
        r = self.rules[rule]
        regex = self.long_hex if r == BASE[2] else self.regexes[rule]
        return [(m.start(), rule, m.end()) for m in regex.finditer(text) if m.end(r.group) - m.start(r.group) >= r.least]

    def search(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans as (start, rule number, end), sorted."""
        index = TrigramIndex(texts, self.wanted, self.slots)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        decoded: dict[int, str] = {}
        for rule, query in enumerate(self.queries):
            for k in index.candidates(query):
                if k not in decoded:
                    decoded[k] = texts[k].decode()
                found[k] += self.spans(rule, decoded[k])
        return [sorted(f) for f in found]


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text); spans are (start, kind, end) by start, then rule."""
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(rules)
        for batch, texts in passes(batches):
            spans = [[{"start": a, "kind": rules[k].kind, "end": b} for a, k, b in f] for f in finder.search(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(spans, schema.field(1).type)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(search, "doc_id long, spans array<struct<start:long,kind:string,end:long>>")


def masked(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mask`` and ``n_chars`` set anew; all other columns as they are."""

    def cover(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for start, _, end in spans:
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mask]
            at = end
        return "".join([*out, text[at:]])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(rules)
        for batch, texts in passes(batches):
            old = batch.column("text").to_pylist()
            new = [cover(t.decode(), f) if f else o for t, f, o in zip(texts, finder.search(texts), old, strict=True)]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["text"] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([n if x is o else len(x) for x, o, n in zip(new, old, batch.column("n_chars").to_pylist(), strict=True)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(search, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    """The counts of base kinds, the hash of the base spans, and all spans as a string, for every row."""
    found = find(docs)
    names = [r.kind for r in BASE]
    joined = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = f"filter(spans, s -> s.kind in ({', '.join(map(repr, names))}))"
    counts = [F.expr(f"size(filter(spans, s -> s.kind = '{n}'))").cast("long").alias(f"n_{n}") for n in names]
    return found.select("doc_id", *counts, F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"), F.expr(joined.format("spans")).alias("spans"))

