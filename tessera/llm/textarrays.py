"""Whole batches of texts as arrays: word hashes and shingles without a loop.

A word is a maximal run of letters, digits and marks of the lower-cased text:
ASCII signs, and signs and blanks of the blocks in ``_SIGNS``, divide words. Its
hash is a polynomial of its bytes
modulo 2**64, from one running sum over the batch, mixed at the end.
"""

from __future__ import annotations

import re

import numpy as np

#: Latin-1 signs, general punctuation, currency, arrows to symbols, CJK and full-width punctuation.
_SIGNS = re.compile("[\x80-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\xd7\xf7\u2000-\u206f\u20a0-\u20cf\u2190-\u2bff\u3000-\u3004\u3008-\u3020\u3030\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _SEED.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
IS_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i < n."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        out = []
        for base in (_BASE, inverse):
            values = np.full(size, base, dtype=np.uint64)
            values[0] = 1
            out.append(np.multiply.accumulate(values))
        _powers = (out[0], out[1])
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def plain(text: str) -> str:
    """Lower case, with signs beyond ASCII as blanks."""
    text = text.lower()
    return text if text.isascii() else _SIGNS.sub(" ", text)


def joined(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes, each text followed by a newline, and where each starts."""
    parts = [(plain(t) if lower else t).encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8), starts


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the count at the end)."""
    if not texts:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    data, starts = joined(texts)
    word = IS_WORD[data]
    edge = np.diff(np.concatenate(([False], word)).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(data) + 1)
    running = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * up[1:], dtype=np.uint64)))
    return mix((running[last] - running[first]) * down[first]), np.searchsorted(first, starts)


def shingles(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their offsets.

    A text of fewer words than ``size`` has one shingle of all its words, one
    without a word has none.
    """
    words, at = word_hashes(texts)
    count = np.diff(at)
    grams = np.maximum(count - size + 1, (count > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), grams)
    place = np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams) + at[:-1][doc]
    left = np.minimum(at[1:][doc] - place, size)
    value = np.zeros(len(doc), dtype=np.uint64)
    padded = np.concatenate((words, np.zeros(size, dtype=np.uint64)))
    for k in range(size):
        value += np.where(left > k, padded[place + k] * _STEP[k], np.uint64(0))
    value = mix(value + left.astype(np.uint64))
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[keep], np.searchsorted(doc[keep], np.arange(len(texts) + 1))


def slices(texts: list[str], most: int = 2_000_000):
    """Runs of texts of about ``most`` characters; a longer text is a run alone."""
    begin, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > most:
            yield begin, k
            begin, size = k, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)
