"""Byte-pair encoding and decoding with a published word vocabulary.

Texts are normalised and cut into words as the vocabulary file says (composed
characters, lower case, white space dropped, pieces of letters, single digits or
other signs). Words are then merged together in rounds: the symbols of all words
lie in one flat array, a binary search over the sorted keys of all mergeable
pairs finds every neighbouring pair's rank, and each word merges its lowest pair,
until no word has one. Only words not seen before are merged.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstats.llm.frames import with_columns

#: Words remembered by a task; beyond it the memory starts anew, which changes no result.
REMEMBERED = 200_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A vocabulary file whose words end in a suffix, ready to encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.vocabulary = dict(model["vocab"])
        pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.vocabulary.update(self.special)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        self.inner = np.array([self.vocabulary[c] for c in letters], np.int64)
        self.final = np.array([self.vocabulary[c + suffix] for c in letters], np.int64)
        self.width = max(self.vocabulary.values()) + 1
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([self.vocabulary[a] * self.width + self.vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([self.vocabulary[a + b] for a, b in pairs], np.int64)
        tokens = [""] * self.width
        for token, number in self.vocabulary.items():
            tokens[number] = token
        self.tokens = pa.array(tokens, pa.string())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)
        for mark, number in self.special.items():
            self.known[mark] = len(self.known)
            self.flat = np.append(self.flat, np.int32(number))
            self.starts = np.append(self.starts, len(self.flat))

    def words(self, text: str) -> list[str]:
        """The words of a text in order; a special token's string stands for itself."""
        if not text:
            return []
        if self.marks is not None and "<|" in text:
            return [
                word
                for i, part in enumerate(self.marks.split(text))
                for word in ([part] if i % 2 else self._plain_words(part))
            ]
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower case is taken letter by letter, so a capital sigma has one lower form.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.split.findall(text.lower())

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's begin and the last end."""
        raw = [w.encode("utf-8") for w in words]
        lengths = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.final[data[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        none = len(self.merged)
        done_symbols, done_owner = [], []
        while len(symbols):
            rank = np.full(len(symbols), none, np.int64)
            left = np.flatnonzero(owner[1:] == owner[:-1])
            pair = symbols[left] * self.width + symbols[left + 1]
            at = np.searchsorted(self.keys, pair)
            at[at == len(self.keys)] = 0
            found = self.keys[at] == pair
            rank[left[found]] = self.ranks[at[found]]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(first, len(owner)))
            best = np.minimum.reduceat(rank, first)
            active = np.repeat(best < none, size)
            if not active.all():
                done_symbols.append(symbols[~active])
                done_owner.append(owner[~active])
                symbols, owner, rank = symbols[active], owner[active], rank[active]
                size, best = size[best < none], best[best < none]
                if not len(symbols):
                    break
            site = rank == np.repeat(best, size)
            place = np.flatnonzero(site)
            # Sites in a row overlap, as in "aaa": every second one of a row merges.
            run = np.concatenate([[True], np.diff(place) != 1])
            begin = np.maximum.accumulate(np.where(run, np.arange(len(place)), 0))
            place = place[(np.arange(len(place)) - begin) % 2 == 0]
            symbols[place] = self.merged[rank[place]]
            keep = np.ones(len(symbols), bool)
            keep[place + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if done_symbols:
            symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
            order = np.argsort(owner, kind="stable")
            symbols, owner = symbols[order], owner[order]
        return symbols.astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])

    def encode(self, texts: pa.Array) -> pa.Array:
        """A list of ids for each text; null and empty texts have none."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known, counts, index, fresh = self.known, [], [], []
        for text in texts:
            words = self.words(text.as_py() or "")
            counts.append(len(words))
            for word in words:
                number = known.get(word)
                if number is None:
                    number = known[word] = len(known)
                    fresh.append(word)
                index.append(number)
        if fresh:
            flat, starts = self.merge(fresh)
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.flat)])
            self.flat = np.concatenate([self.flat, flat])
        word = np.array(index, np.int64)
        begin, size = self.starts[word], self.starts[word + 1] - self.starts[word]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        bounds = total[np.concatenate([[0], np.cumsum(np.array(counts, np.int64))]).astype(np.int64)]
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))

    def decode(self, ids: pa.Array) -> pa.Array:
        """The token strings of each list, joined by one space: the file names no decoder. Null: empty."""
        ids = pc.fill_null(ids, []) if ids.null_count else ids
        bounds = ids.offsets.to_numpy()
        tokens = self.tokens.take(ids.flatten())
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), tokens), " ")


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """The vocabulary at ``path``, read once by each worker."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the column ``ids`` (array of int), the tokens of each whole text.

    ``path`` is the vocabulary file, at the same place on every executor. Strings
    of special tokens inside a text become those tokens. Null and empty texts have
    an empty array; rows are neither dropped nor reordered within a partition, so
    repeated rows stay repeated. Texts may be of any length, empty tables give no rows.
    An input column named like ``ids`` is replaced.
    """
    added = [(ids, T.ArrayType(T.IntegerType()))]
    # An idle worker keeps the vocabulary, not the words it has met.
    return with_columns(docs, text, added, lambda texts: [load(path).encode(texts)], after=lambda: load(path).forget())


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the column ``text``: the tokens of ``ids`` as one string. Null: empty.

    An input column named like ``text`` is replaced.
    """
    kept = [f for f in df.schema.fields if f.name.lower() != text.lower()]
    schema = T.StructType([*kept, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, load(path).decode(batch.column(ids))], schema.names)

    return df.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, schema)
