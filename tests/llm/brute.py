"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text: str | None) -> frozenset:
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def components(pairs, nodes) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_duplicates(rows) -> list[tuple]:
    """(doc_id, n_shingles, component_id) for rows of (doc_id, text)."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    holders = defaultdict(list)
    for k, (d, s) in enumerate(sets):
        if d is not None:
            for g in s:
                holders[g].append(k)
    shared = Counter()
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                shared[a, b] += 1
    links = [(sets[a][0], sets[b][0]) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n)]
    found = components(links, {d for d, _ in rows if d is not None})
    return [(d, len(s), None if d is None else found[d]) for d, s in sets]


def base_scores(rows) -> dict:
    """doc_id -> (n_tokens, n_known, train tokens, base score)."""
    counts = Counter()
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 5 != 1:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, t in rows:
        tokens = [*words(t), None]
        out[d] = (len(tokens), sum(counts[x] > 0 for x in tokens), n, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text: str | None) -> list[tuple[int, str, int]]:
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, k, b) for a, _, k, b in sorted(out)]


def digest(spans) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def quality(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for k in range(len(w) - 7):
        places[tuple(w[k : k + 8])].append(k)
    covered = {k + j for ks in places.values() if len(ks) > 1 for k in ks for j in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def best_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments by the recursive definition."""
    best, where = 0.0, None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > best + 1e-9:
                best, where = total, (a, b + 1)
    if where is None:
        return []
    a, b = where
    left, right = best_segments(scores[:a]), best_segments(scores[b:])
    return [*left, (a, b, best), *((x + b, y + b, s) for x, y, s in right)]


def five_grams(text: str) -> list[tuple]:
    w = words(text)
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
