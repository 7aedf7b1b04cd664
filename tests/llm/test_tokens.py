"""Words and their hashes against a plain reading of the text."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pytest

from tidemart.llm import tokens
from tidemart.llm.tokens import Words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(texts):
    return [[w.lower() for w in WORD.findall(t)] for t in texts]


def test_words_of_awkward_texts(monkeypatch):
    rng = random.Random(3)
    alphabet = b"aAbZz \t\n\x0b\x0c\r\x00\xff\xc3\xa9."
    texts = [b"", b" ", b"x", b"\n\nX y\n"] + [bytes(rng.choices(alphabet, k=rng.randint(0, 90))) for _ in range(200)]
    texts.append(b"w" * 700 + b" " + b"W" * 700 + b" " + b"w" * 699)
    whole = Words(texts)
    monkeypatch.setattr(tokens, "STEP_BYTES", 7)
    monkeypatch.setattr(tokens, "STEP_WORDS", 3)
    stepped = Words(texts)
    assert (whole.hash == stepped.hash).all() and (whole.start == stepped.start).all() and (whole.end == stepped.end).all()
    by_word, by_hash = {}, {}
    for (_, a, b), expected in zip(whole.texts(), plain(texts), strict=True):
        assert [bytes(whole.lower[whole.start[w] : whole.end[w]]) for w in range(a, b)] == expected
        for h, w in zip(whole.hash[a:b].tolist(), expected, strict=True):
            assert by_word.setdefault(w, h) == h and by_hash.setdefault(h, w) == w


@pytest.mark.parametrize("power", range(3, 14))
def test_thue_morse_words_differ(power):
    turns = [bin(k).count("1") & 1 for k in range(1 << power)]
    one = bytes(97 + t for t in turns)
    other = bytes(98 - t for t in turns)
    assert len(set(Words([one + b" " + other]).hash.tolist())) == 2


def test_words_that_differ_in_one_byte_differ():
    rng = random.Random(8)
    made = set()
    for n in (1, 7, 8, 9, 16, 17, 255, 256, 257, 1000):
        word = bytearray(rng.choices(b"abcdefghij", k=n))
        made.add(bytes(word))
        for k in range(n):
            word[k] ^= 16
            made.add(bytes(word))
            word[k] ^= 16
    listed = sorted(made)
    assert len(np.unique(Words([b" ".join(listed)]).hash)) == len(listed)


def test_memory_of_a_long_text():
    """A text of n bytes with words of six takes less than nine n beside itself."""
    text = b"words " * 2_000_000
    tracemalloc.start()
    made = Words([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made.hash) == 2_000_000 and peak < 9 * len(text)
