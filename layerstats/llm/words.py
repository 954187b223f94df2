"""Words of many texts at once, as arrays of 64-bit hashes.

Texts arrive as Arrow strings. Their bytes are hashed in place by prefix sums of
a polynomial over a table of random values, so no Python string is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_rng = np.random.Generator(np.random.PCG64(20240601))
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings, and where each text starts and the last ends. Null: empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """A hash of each ``data[start:end]``; ranges in order of their starts, at most overlapping a little."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(starts, begin + BLOCK)))
        end = int(ends[at:stop].max())
        up, down = _power(max(BLOCK, end - begin))
        sums = np.empty(end - begin + 1, np.uint64)
        sums[0] = 0
        np.cumsum(table[data[begin:end]] * up[: end - begin], out=sums[1:])
        s, e = starts[at:stop] - begin, ends[at:stop] - begin
        out[at:stop] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        at = stop
    return mix(out)


def spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word: a run of bytes for which ``gap`` is false, within one text."""
    if not len(data):
        return (np.empty(0, np.int64),) * 3
    inside = ~gap[data]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (first | ~before))
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = ~inside[1:] | first[1:]
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased and split at ASCII white space, and its text's number."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    starts, ends, owner = spans(data, offsets)
    return range_hashes(data, starts, ends), owner


def shingle_hashes(words: np.ndarray, owner: np.ndarray, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words, and its text's number.

    A text of fewer words, but at least one, has one shingle of all its words.
    """
    counts = np.bincount(owner, minlength=n_texts)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    first = np.repeat(np.cumsum(counts) - counts, runs)
    step = np.arange(len(first)) - np.repeat(np.cumsum(runs) - runs, runs)
    at, length = first + step, np.repeat(np.minimum(counts, size), runs)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        here = length > k
        if here.all():
            out = mix(out * np.uint64(3) + words[at + k] + np.uint64(k + 1))
        else:
            out[here] = mix(out[here] * np.uint64(3) + words[at[here] + k] + np.uint64(k + 1))
    return out, np.repeat(np.arange(n_texts), runs)


def as_sets(values: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text in order, and where each text's begin and the last end."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_texts))])
