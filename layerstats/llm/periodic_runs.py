"""Runs of words that repeat with a period, by a sparse diagonal program.

A run of period q is a stretch in which each word equals the one q words before: a
diagonal of matches at lag q. Words are gone through in order. A word's earlier
occurrences raise the match lengths of their lags; a lag that is not raised ends, and
if it was raised for long enough its run is emitted there and then.

The program is kept sparse, and its work bounded for any text, by the context in which
a word has to occur before. A run has at least four periods, so at lag q at least 3q
words match in a row, and an occurrence at a lag in (c/2, c] only counts if the c words
up to it are equal. Of these occurrences only the last one can raise a lag of use:
inside a run of smallest period q, c words with q <= c < 2q occur q words before and at
no smaller lag, as two periods that fit into one stretch have their greatest common
divisor as a period. So each word raises at most one lag for each c = 1, 2, 4, ..., and
words whose context occurs once drop out of all longer ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from layerstats.llm.frames import with_columns
from layerstats.llm.words import SPACE, buffers, spans

#: A run has at least so many words, and at least so many periods.
LEAST, PERIODS = 6, 4

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    solid = np.ascontiguousarray(data[~SPACE[data]])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(solid)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def find_runs(code: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, in order of text, start and period.

    ``code`` numbers the words of all texts one after the other, ``owner`` their texts.
    """
    sizes = np.bincount(owner, minlength=n_texts)
    first = np.cumsum(sizes) - sizes
    at = np.arange(len(code))
    name = owner * (int(code.max(initial=0)) + 1) + code
    out = []
    context = 1
    while len(at):
        order = np.argsort(name, kind="stable")
        ranked = name[order]
        again = ranked[1:] == ranked[:-1]
        later, before = order[1:][again], order[:-1][again]
        lag = at[later] - at[before]
        raised = np.flatnonzero((lag > context // 2) & (lag <= context))
        raised = raised[np.argsort(later[raised])]
        word, lag = at[later[raised]], lag[raised]
        if len(word):
            # A lag's match length is one more than at the word before, if that raised it too.
            opens = np.ones(len(word), bool)
            opens[1:] = (word[1:] != word[:-1] + 1) | (lag[1:] != lag[:-1])
            begin = np.flatnonzero(opens)
            period = lag[begin]
            length = np.diff(np.append(begin, len(word))) + context - 1 + period
            start = word[begin] - period - context + 1
            long = length >= np.maximum(LEAST, PERIODS * period)
            out.append((start[long], length[long], period[long]))
        # Contexts of twice the size, where both halves have occurred before or will again.
        repeated = np.zeros(len(at), bool)
        repeated[later] = repeated[before] = True
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(np.append(False, ~again)) if len(at) else 0
        at, rank = at[repeated], rank[repeated]
        enough = sizes[owner[at]] >= PERIODS * (context + 1)
        at, rank = at[enough], rank[enough]
        if not len(at):
            break
        half = np.minimum(np.searchsorted(at, at - context), len(at) - 1)
        whole = (at[half] == at - context) & (owner[at[half]] == owner[at])
        name = (rank[half] * (int(rank.max()) + 1) + rank)[whole]
        at = at[whole]
        context *= 2
    if not out:
        return (np.empty(0, np.int64),) * 4
    start, length, period = (np.concatenate(x) for x in zip(*out, strict=True))
    text = owner[start]
    order = np.lexsort((period, start, text))
    return text[order], (start - first[text])[order], length[order], period[order]


def _collapsed(texts: pa.Array) -> list[pa.Array]:
    n = len(texts)
    data, offsets = buffers(texts)
    starts, ends, owner = spans(data, offsets)
    text, start, length, period = find_runs(word_codes(data, starts, ends), owner, n)
    sizes = np.bincount(owner, minlength=n)
    first = np.cumsum(sizes) - sizes

    # Words after the first period of any run go.
    change = np.zeros(len(owner) + 1, np.int64)
    np.add.at(change, first[text] + start + period, 1)
    np.add.at(change, first[text] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    last = np.ones(len(kept), bool)
    last[:-1] = owner[kept][1:] != owner[kept][:-1]
    # A kept word takes along the white space after it, unless it is the text's last.
    until = ends[kept] + ~last
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[kept]] += 1
    np.add.at(edge, until, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    spaced = data.copy()
    spaced[ends[kept][~last]] = 0x20
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(owner[kept], until - starts[kept], n).astype(np.int64), out=bounds[1:])
    body = np.ascontiguousarray(spaced[inside])
    joined = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(bounds), pa.py_buffer(body)]).cast(pa.string())

    places = np.append(0, np.cumsum(np.bincount(text, minlength=n))).astype(np.int32)
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    return [pa.ListArray.from_arrays(pa.array(places), runs), pa.array(sizes, pa.int64()), joined]


def collapse(df: DataFrame, text: str = "text", runs: str = "runs", n_words: str = "n_words", collapsed: str = "collapsed") -> DataFrame:
    """``df`` with the runs of each text, its number of words, and its words without what runs repeat.

    Words are separated by ASCII white space and numbered from 0; case counts. A run is
    a stretch of consecutive words with a smallest period q, of at least ``LEAST`` words
    and ``PERIODS`` periods, that no neighbouring word extends; runs may overlap and are
    in order of start, then period. ``collapsed`` has all words joined by one space but
    those that any run holds after its first q words.

    Null, empty and blank texts have no words, no runs, and an empty ``collapsed``. Texts
    may be of any length: work grows as n log n, also for a text of a single word. Each
    row is worked on by itself, so repeated rows give equal results, and empty tables no
    rows. Columns named as a new one are replaced.
    """
    added = [(runs, T.ArrayType(RUN)), (n_words, T.LongType()), (collapsed, T.StringType())]
    return with_columns(df, text, added, _collapsed)
