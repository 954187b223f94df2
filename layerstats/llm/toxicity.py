"""Toxicity by multiple-instance learning.

Labels are given for documents; what offends is a sentence. Each sentence gets a
probability from a logistic model over its hashed words and their beginnings, and
a document's is the noisy-or of its sentences': 1 - prod(1 - p). The model is
trained on document labels through the noisy-or, and then says which sentences
offend.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstats.llm.frames import give_back, with_columns
from layerstats.llm.words import LOWER, buffers, range_hashes, spans

GAP = np.ones(256, bool)
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
BREAK = np.zeros(256, np.int64)
BREAK[[*b".!?\n"]] = 1

#: Beginnings of words, in bytes, that are features besides the word itself.
BEGINNINGS = (4, 6, 8)

SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )
)


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters, byte for byte."""
    out = LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[accented] += 0x20
    return out


class Sentences:
    """Words and sentences of an array of texts, flat. A text without words has one sentence without words."""

    def __init__(self, texts: pa.Array, bits: int):
        self.data, offsets = buffers(texts)
        n = len(texts)
        self.starts, self.ends, owner = spans(self.data, offsets, GAP)
        low = lowered(self.data)
        ends = [self.ends, *(np.minimum(self.starts + k, self.ends) for k in BEGINNINGS)]
        self.feature = np.empty((len(owner), len(ends)), np.int32)
        for k, end in enumerate(ends):
            hashes = range_hashes(low, self.starts, end) * np.uint64(2 * k + 1)
            self.feature[:, k] = hashes >> np.uint64(64 - bits)
        breaks = np.concatenate([[0], np.cumsum(BREAK[self.data])])
        new = np.ones(len(owner), bool)
        if len(owner):
            new[1:] = (owner[1:] != owner[:-1]) | (breaks[self.starts[1:]] > breaks[self.ends[:-1]])
        self.first = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.first, len(owner)))
        per_text = np.bincount(owner[self.first], minlength=n)
        self.with_words = per_text > 0
        self.per_text = np.maximum(per_text, 1)
        self.text_first = np.cumsum(self.per_text) - self.per_text
        # Sentences that have words, among all sentences.
        self.place = np.flatnonzero(np.repeat(self.with_words, self.per_text))
        self.offsets = offsets

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        out = np.full(int(self.per_text.sum()), bias)
        if len(self.first):
            out[self.place] += np.add.reduceat(weights[self.feature].sum(axis=1), self.first)
        return out


def noisy_or(logits: np.ndarray, text_first: np.ndarray) -> np.ndarray:
    """1 - prod(1 - sigmoid(logit)) over each text's sentences."""
    return -np.expm1(-np.add.reduceat(np.logaddexp(0, logits), text_first))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _told_apart(with_one: np.ndarray, with_zero: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """Log-likelihood ratio of each feature's document counts; 0 where it is no likelier under label 1."""
    total, n = with_one + with_zero, ones + zeros

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    ratio = part(with_one, total * ones / n) + part(with_zero, total * zeros / n)
    ratio += part(ones - with_one, (n - total) * ones / n) + part(zeros - with_zero, (n - total) * zeros / n)
    return np.where(with_one * zeros > with_zero * ones, 2 * ratio, 0)


def train(
    texts: pa.Array, labels: np.ndarray, bits: int, steps: int, least: float = 20.0, rate: float = 0.1, block: int = 500, block_bytes: int = 1 << 22
) -> tuple[np.ndarray, float]:
    """Weights and bias of the sentence model with the likeliest document labels (Adam, all rows a step).

    Only features whose document counts tell the labels apart (log-likelihood
    ratio from ``least``) have weights: others could only learn labels by heart.
    """
    sizes = np.concatenate([buffers(c)[1][1:] - buffers(c)[1][:-1] for c in getattr(texts, "chunks", [texts])] or [np.empty(0, np.int64)])
    total, blocks, at = np.concatenate([[0], np.cumsum(sizes)]), [], 0
    while at < len(labels):
        stop = min(at + block, max(at + 1, int(np.searchsorted(total, total[at] + block_bytes, side="right")) - 1), len(labels))
        blocks.append((at, stop - at))
        at = stop
    counts = np.zeros((2, 1 << bits))
    for at, size in blocks:
        s = Sentences(texts.slice(at, size), bits)
        owner = np.repeat(np.repeat(np.arange(len(s.per_text)), s.per_text)[s.place], s.sizes)
        keys = np.unique((owner[:, None] << bits | s.feature).ravel())
        for label in (0, 1):
            counts[label] += np.bincount(keys[labels[at + (keys >> bits)] == label] & ((1 << bits) - 1), minlength=1 << bits)
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    if not ones or not zeros:
        return np.zeros(1 << bits, np.float32), 8.0 if ones else -8.0
    used = np.flatnonzero(_told_apart(counts[1], counts[0], ones, zeros) >= least)
    place = np.full(1 << bits, -1, np.int32)
    place[used] = np.arange(len(used))
    found, where, per_text, total = [], [], [], 0
    for at, size in blocks:
        s = Sentences(texts.slice(at, size), bits)
        feature = place[s.feature]
        row, _ = np.nonzero(feature >= 0)
        where.append(np.repeat(s.place, s.sizes)[row] + total)
        found.append(feature[feature >= 0])
        per_text.append(s.per_text)
        total += int(s.per_text.sum())
    feature, sentence, per_text = np.concatenate(found), np.concatenate(where), np.concatenate(per_text)
    first, owner = np.cumsum(per_text) - per_text, np.repeat(np.arange(len(labels)), per_text)
    share = np.where(labels == 1, ones**-0.5, zeros**-0.5)
    share /= share.sum()
    shrink = 0.3 * share[labels == 1][0]
    w, bias = np.zeros(len(used)), -5.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, steps + 1):
        z = np.bincount(sentence, w[feature], total) + bias
        doc = np.clip(noisy_or(z, first), 1e-9, 1 - 1e-12)
        pull = np.where(labels == 1, (1 - doc) / doc, -1.0) * share
        up = sigmoid(z) * pull[owner]
        grad = np.append(np.bincount(feature, up[sentence], len(used)) - shrink * w, up.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        w, bias = w + move[:-1], bias + move[-1]
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = w
    return weights, float(bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "toxic",
    text: str = "text",
    learn: Column | None = None,
    sample: int = 16_000,
    sample_bytes: int = 1 << 28,
    bits: int = 20,
    steps: int = 200,
) -> tuple[np.ndarray, float]:
    """The sentence model, from a bounded sample of the labelled documents.

    About ``sample`` documents at most, those with the smallest hash of their
    key, are learned from, whole and whatever their length, in one task, as far as
    they fit into ``sample_bytes`` together. ``learn`` says which keys may be learned
    from. A key with several labels has the largest, one with several rows teaches the
    text with the least hash, once; null keys and labels teach nothing.
    Without both labels every document scores near 0 (or, with only 1s, near 1).
    """
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    usable = usable.where(learn) if learn is not None else usable
    usable = usable.groupBy(F.col(key).alias("__key")).agg(F.max(label).cast("int").alias("__label"))
    place = F.pmod(F.xxhash64("__key"), F.lit(1 << 30)) / float(1 << 30)
    few = place * usable.count() < sample
    chosen = F.broadcast(usable.where(few))  # some ``sample`` rows of two numbers, whatever the input
    found = (
        docs.where(F.col(key).isNotNull())
        .select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
        .join(chosen, "__key")
    )
    # Of each key the text with the least hash; keys by their hash, as far as their texts have room.
    hashed, size = F.xxhash64("__text"), F.coalesce(F.octet_length("__text"), F.lit(0)).cast("long")
    least = found.groupBy("__key").agg(F.min(F.struct(hashed.alias("hash"), size.alias("size"))).alias("__least"))
    lengths = least.select("__key", F.col("__least.hash").alias("__hash"), F.col("__least.size").alias("__size"))
    room = Window.orderBy(place, "__key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = lengths.where(F.col("__size") <= sample_bytes).withColumn("__until", F.sum("__size").over(room))
    rows = (
        found.join(F.broadcast(fitting.where(F.col("__until") <= sample_bytes).select("__key", "__hash")), "__key")
        .where(hashed == F.col("__hash"))
        .select("__key", "__label", "__text")
        .distinct()
        .select("__label", "__text")
        .repartition(1)
        .sortWithinPartitions("__label", "__text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), rows_schema)
        weights, bias = train(table["__text"], table["__label"].to_numpy(), bits, steps)
        del table
        give_back()
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "bias": [bias]})

    rows_schema = pa.schema([("__label", pa.int32()), ("__text", pa.string())])
    model = rows.mapInArrow(work, "weights binary, bias double").first()
    if model is None:
        return np.zeros(1 << bits, np.float32), -8.0
    return np.frombuffer(model["weights"], np.float32), model["bias"]


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    text: str = "text",
    threshold: float = 0.5,
    out: str = "score",
    offending: str = "offending",
) -> DataFrame:
    """Add ``out``, the probability that a text is toxic, and ``offending``.

    ``offending`` lists start, end (in characters) and probability of every
    sentence from ``threshold``, in text order. Null, empty and wordless texts
    have the score of a sentence without words and no offending one. Texts may be of any
    length; repeated rows get equal scores; empty tables give no rows. Columns of
    these names in ``docs`` are replaced.
    """
    weights, bias = model
    bits = int(np.log2(len(weights)))

    def work(texts: pa.Array) -> list[pa.Array]:
        s = Sentences(texts, bits)
        z = s.logits(weights, bias)
        docs_score = noisy_or(z, s.text_first)
        p = sigmoid(z[s.place])
        bad = np.flatnonzero(p >= threshold)
        letters = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])
        last = s.first[bad] + s.sizes[bad] - 1
        owner = np.repeat(np.arange(len(texts)), s.per_text)[s.place][bad]
        base = letters[s.offsets[owner]]
        found = pa.StructArray.from_arrays(
            [
                pa.array(letters[s.starts[s.first[bad]]] - base, pa.int32()),
                pa.array(letters[s.ends[last]] - base, pa.int32()),
                pa.array(p[bad], pa.float64()),
            ],
            ["start", "end", "score"],
        )
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
        return [pa.array(docs_score), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found)]

    return with_columns(docs, text, [(out, T.DoubleType()), (offending, SPANS)], work)
