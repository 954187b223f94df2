"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Items are partitioned by size, in powers of two. For a partition of items of up to
S shingles a document is cut into windows of 2S shingles, S apart: any S shingles
in a row lie in one of them. A window whose MinHash signature meets an item's in
one value is a candidate, with enough values that an item contained to the
threshold is met with the recall asked for. The whole document's shingles then
confirm or refute a candidate exactly. Items of fewer words than a shingle are partitioned
by their length, and met by the documents' runs of so many words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstats.llm.frames import free_name, with_columns
from layerstats.llm.store import written, written_in_turn
from layerstats.llm.words import as_sets, shingle_hashes, word_hashes

SLOTS = 22


def hashes_needed(threshold: float, recall: float) -> int:
    """MinHash values so that one meets, at the least Jaccard similarity that a contained item has to its window.

    That is an item of S/2 shingles, contained to the threshold in a window of 2S.
    """
    least = threshold * 0.5 / (2 + 0.5 - threshold * 0.5)
    return math.ceil(math.log(1 - recall) / math.log(1 - least))


class Index:
    """Signatures and shingles of one block of benchmark items."""

    def __init__(self, texts: pa.Array, size: int, threshold: float, recall: float):
        words, owner = word_hashes(texts)
        length = np.bincount(owner, minlength=len(texts))
        shingles, owner = shingle_hashes(words, owner, len(texts), size)
        self.shingles, self.bounds = as_sets(shingles, owner, len(texts))
        self.size, self.threshold = size, threshold
        # Short items by length: their only run, and which item it is.
        self.short = {}
        for n in np.unique(length[(length > 0) & (length < size)]).tolist():
            items = np.flatnonzero(length == n)
            runs = self.shingles[self.bounds[items]]
            order = np.argsort(runs, kind="stable")
            self.short[n] = (runs[order], items[order])
        counts = np.where(length < size, 0, np.diff(self.bounds))
        k = hashes_needed(threshold, recall)
        rng = np.random.Generator(np.random.PCG64(977))
        self.factors = rng.integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.parts: list[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]] = []
        classes = np.where(counts > 0, np.ceil(np.log2(np.maximum(counts, 1))).astype(int), -1)
        for c in sorted(set(classes.tolist()) - {-1}):
            items = np.flatnonzero(classes == c)
            tables, least = [], []
            for factor in self.factors:
                order = [self._order(self.shingles[self.bounds[i] : self.bounds[i + 1]], factor) for i in items]
                low = np.array([o.min() for o in order], np.uint64)
                least += [self.shingles[self.bounds[i] + o.argmin()] for i, o in zip(items, order, strict=True)]
                rank = np.argsort(low, kind="stable")
                tables.append((low[rank], items[rank]))
            self.parts.append((1 << c, np.unique(np.array(least, np.uint64)), tables))
        every = np.concatenate([p[1] for p in self.parts]) if self.parts else np.empty(0, np.uint64)
        self.slots = np.zeros(1 << SLOTS, bool)
        self.slots[every >> np.uint64(64 - SLOTS)] = True

    @staticmethod
    def _order(shingles: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (shingles ^ (shingles >> np.uint64(29))) * factor

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, item number and containment of every item found in a text, in that order."""
        words, word_owner = word_hashes(texts)
        shingles, owner = shingle_hashes(words, word_owner, len(texts), self.size)
        begin = np.searchsorted(owner, np.arange(len(texts) + 1))
        maybe = np.flatnonzero(self.slots[shingles >> np.uint64(64 - SLOTS)])
        pairs: set[tuple[int, int]] = set()
        for length, least, tables in self.parts:
            # Only a window that holds an item's least shingle can have its least value.
            near = np.searchsorted(least, shingles[maybe])
            near[near == len(least)] = 0
            at = maybe[least[near] == shingles[maybe]]
            if not len(at):
                continue
            text, block = owner[at], (at - begin[owner[at]]) // length
            keys = np.unique(np.concatenate([text << 40 | block, (text << 40 | block - 1)[block > 0]]))
            text, block = keys >> 40, keys & ((1 << 40) - 1)
            first = begin[text] + block * length
            last = np.minimum(first + 2 * length, begin[text + 1])
            for start in range(0, len(first), 4096):
                pairs.update(self._candidates(shingles, text, first, last, slice(start, start + 4096), tables))
        found = [(t, i, 1.0) for t, i in self._short(words, word_owner, len(texts))]
        held: tuple[int, np.ndarray] = (-1, np.empty(0, np.uint64))
        for t, i in sorted(pairs):
            if held[0] != t:
                held = (t, np.unique(shingles[begin[t] : begin[t + 1]]))
            item = self.shingles[self.bounds[i] : self.bounds[i + 1]]
            at = np.minimum(np.searchsorted(held[1], item), len(held[1]) - 1)
            share = float((held[1][at] == item).sum() / len(item))
            if share >= self.threshold:
                found.append((t, i, share))
        found.sort()
        columns = zip(*found, strict=True) if found else ((), (), ())
        return tuple(np.array(c, kind) for c, kind in zip(columns, (np.int64, np.int64, np.float64), strict=True))

    def _short(self, words: np.ndarray, owner: np.ndarray, n: int) -> set[tuple[int, int]]:
        """Short items and the texts that hold all their words in a row."""
        pairs = set()
        for length, (runs, items) in self.short.items():
            held, text = shingle_hashes(words, owner, n, length)
            left, right = np.searchsorted(runs, held, side="left"), np.searchsorted(runs, held, side="right")
            for at in np.flatnonzero(right > left):
                pairs.update((int(text[at]), int(i)) for i in items[left[at] : right[at]])
        return pairs

    def _candidates(self, shingles, text, first, last, part, tables) -> Iterator[tuple[int, int]]:
        first, size, text = first[part], (last - first)[part], text[part]
        start = np.cumsum(size) - size
        held = shingles[np.repeat(first - start, size) + np.arange(int(size.sum()))]
        for factor, (low, items) in zip(self.factors, tables, strict=True):
            least = np.minimum.reduceat(self._order(held, factor), start)
            left, right = np.searchsorted(low, least, side="left"), np.searchsorted(low, least, side="right")
            for w in np.flatnonzero(right > left):
                for item in items[left[w] : right[w]]:
                    yield int(text[w]), int(item)


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "found_items",
    threshold: float = 0.8,
    size: int = 5,
    recall: float = 0.999,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """Add ``out``: item and containment of every benchmark item of which the text holds ``threshold`` or more.

    Containment is the share of an item's distinct runs of ``size`` words (A-Z
    lower-cased, split at ASCII white space) that occur in the whole text. An item
    of fewer words is one run of all its words, found wherever a text has them in a row;
    items without words are never found, nor is anything in null or empty
    texts. Texts may be of any length. Repeated items are found as often as they occur;
    repeated rows stay. Without items, or documents, nothing is found. A
    column named like ``out`` is replaced; other names do not clash.

    The benchmark is broadcast in blocks of about ``block_bytes`` of text, one after
    the other. With a single block the documents are never shuffled; with several, each
    passes over them, and what they found is joined to the documents by row number.
    """
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    fields = T.StructType([T.StructField("item", items.schema["item"].dataType), T.StructField("containment", T.DoubleType())])

    def marked(rows: DataFrame, b: int) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).toArrow()
        names = part["item"].combine_chunks()
        shared = docs.sparkSession.sparkContext.broadcast((Index(part["text"].combine_chunks(), size, threshold, recall), names))

        def work(texts: pa.Array) -> list[pa.Array]:
            index, names = shared.value
            row, number, share = index.find(texts)
            found = pa.StructArray.from_arrays([names.take(pa.array(number)), pa.array(share)], ["item", "containment"])
            bounds = np.searchsorted(row, np.arange(len(texts) + 1))
            return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found)]

        return with_columns(rows, text, [(out, T.ArrayType(fields))], work)

    if blocks == 1:
        return marked(docs, 0)
    row, hits = free_name(docs, "__row"), free_name(docs, "__hits")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = written_in_turn(
        (marked(numbered.select(row, text), b).where(F.size(out) > 0).select(F.col(row), F.col(out).alias(hits)) for b in range(blocks)), "found"
    )
    found = found.groupBy(row).agg(F.array_sort(F.flatten(F.collect_list(hits))).alias(hits))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return numbered.join(found, row, "left").select(*kept, F.coalesce(F.col(hits), F.array().cast(T.ArrayType(fields))).alias(out))


def search(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """doc_id, item_id and containment of every item found (see :func:`mark`), one row for each."""
    found = mark(docs, benchmark, **options).select(F.col(key).alias("doc_id"), F.explode("found_items").alias("found"))
    return found.select("doc_id", F.col("found.item").alias("item_id"), F.col("found.containment").alias("containment"))
