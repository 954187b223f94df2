"""A hierarchical Pitman-Yor language model, and a unigram model beside it.

Text is scored as the bytes of its words: A-Z lower-cased, a space after each word
and a line feed at the end, so every text has a probability, whatever its words. A
context of up to ``DEPTH`` bytes is a restaurant whose dishes are next bytes; its
parent is the same context without its first byte, shared with all contexts that
end alike, and a table opened here is a customer there. Seatings are sampled by Gibbs
sweeps, in which the tables of a dish are drawn given all others (``seating``), and
predictive probabilities averaged over the sampled seatings.

Texts are dealt into chunks. A chunk asks for the counts of its distinct words and
for the probabilities of its distinct byte runs, and gives its own training counts
with the request; requests meet in buckets, by hash for words, by the three bytes nearest
to the predicted one for runs, where all restaurants below those three bytes are
together. Only the restaurants of up to two bytes, whose number is bounded whatever the
corpus, are seated on the driver, once in every sweep.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstats.llm.frames import give_back
from layerstats.llm.seating import STRENGTH, draw
from layerstats.llm.store import forget, settled, written
from layerstats.llm.words import LOWER, SPACE, buffers, mix, word_hashes

DEPTH = 6
#: Discounts of restaurants by the length of their context, and their common strength.
DISCOUNTS = (0.2, 0.5, 0.6, 0.7, 0.75, 0.8, 0.8)
#: Contexts of up to so many bytes are seated on the driver, longer ones in buckets.
TOP = 2
BURN_IN, SAMPLES = 2, 3
CHUNK_BYTES, BUCKET_BYTES, BLOCK = 8 << 20, 16 << 20, 1 << 21
#: Chunks whose requests one task of a bucket merges or answers.
LOT = 256
#: The token at the end of each text among the hashes of words.
END = np.uint64(0x454E44)
REQUEST = "kind string, bucket int, chunk int, keys binary, counts binary"


def packed(values: np.ndarray) -> bytes:
    """Numbers compressed byte plane by byte plane, as the high bytes of most are alike."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as the steps between them."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts with ``DEPTH`` line feeds before each, and where each text's first and last one (its end) stand."""
    data, offsets = buffers(texts)
    n = len(texts)
    space = SPACE[data]
    word = ~space
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = word[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    before[starts] = False
    keep = word | before
    last = np.zeros(n, bool)
    last[np.diff(offsets) > 0] = word[offsets[1:][np.diff(offsets) > 0] - 1]
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    first = DEPTH + kept[:-1] + np.cumsum(last + DEPTH) - (last + DEPTH)
    out = np.full(DEPTH + int(kept[-1]) + int(last.sum()) + DEPTH * n, 0x0A, np.uint8)
    size = np.diff(kept)
    place = np.repeat(first - kept[:-1], size) + np.arange(int(kept[-1]))
    data = np.where(space, np.uint8(0x20), LOWER[data])[keep]
    out[place] = data
    end = first + size
    out[end[last]] = 0x20
    return out, first, end + last


def runs(out: np.ndarray, at: int, stop: int) -> np.ndarray:
    """The symbol at each place and the ``DEPTH`` before it as one number, the symbol itself in the lowest byte."""
    keys, have = out[at - DEPTH : stop].astype(np.uint64), 1
    while have < DEPTH + 1:
        # To the nearest ``have`` symbols come ``more`` from before them; places too near the start are cut off below.
        more = min(have, DEPTH + 1 - have)
        before = (keys[:-have] & np.uint64((1 << 8 * more) - 1)) << np.uint64(8 * have)
        keys[have:] |= before
        have += more
    return keys[DEPTH:]


def _blocks(texts: pa.Array, most: int) -> Iterator[slice]:
    sizes = np.diff(buffers(texts)[1])
    total, at = np.concatenate([[0], np.cumsum(sizes)]), 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield slice(at, stop)
        at = stop


def _distinct(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    keys = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint64)
    counts = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
    # The parts are in order, which this sort makes use of.
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    return keys[first], np.add.reduceat(counts, first, dtype=np.int64) if len(first) else counts


def _counted(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(keys, return_inverse=True)
    return keys, np.bincount(where, learn, len(keys)).astype(np.int64)


def _distinct_runs(texts: pa.Array, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of a chunk, and how often each occurs in the texts learned from."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for learned in (False, True):
        some = texts.filter(pa.array(learn == learned))
        for block in _blocks(some, BLOCK):
            out, first, end = symbols(some.slice(block.start, block.stop - block.start))
            real = _inside(out, first, end)
            for at in range(DEPTH, len(out), BLOCK):
                stop = min(len(out), at + BLOCK)
                keys, counts = np.unique(runs(out, at, stop)[real[at:stop]], return_counts=True)
                parts.append((keys, counts if learned else np.zeros(len(keys), np.int64)))
            if len(parts) > 4:
                parts = [_distinct(parts)]
    return _distinct(parts)


def _inside(out: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which symbols belong to a text, its end included, and not to what stands between texts."""
    change = np.zeros(len(out) + 1, np.int8)
    change[first] = 1
    change[end + 1] = -1
    return np.cumsum(change[:-1], dtype=np.int8) > 0


def _run_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys >> np.uint64(8) & np.uint64((1 << 8 * (TOP + 1)) - 1)) % np.uint64(buckets)).astype(np.int64)


def _word_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys) % np.uint64(buckets)).astype(np.int64)


def _chunk_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text, the end included, and their text's number."""
    words, owner = word_hashes(texts)
    return np.concatenate([words, np.full(len(texts), END)]), np.concatenate([owner, np.arange(len(texts))])


def _requests(buckets: int) -> object:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        chunk = table["chunk"][0].as_py()
        texts = table["text"].combine_chunks()
        learn = table["learn"].to_numpy(zero_copy_only=False).astype(np.int64)
        tokens, owner = _chunk_words(texts)
        rows = []
        for kind, (keys, counts), deal in (
            ("word", _counted(tokens, learn[owner]), _word_bucket),
            ("run", _distinct_runs(texts, learn), _run_bucket),
        ):
            bucket = deal(keys, buckets)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(bounds)):
                here = order[bounds[b] : bounds[b + 1]]
                rows.append((kind, int(b), chunk, packed_keys(keys[here]), packed(counts[here])))
        give_back()
        columns = zip(*rows, strict=True)
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "bucket", "chunk", "keys", "counts"])

    return run


def _arrays(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts."""
    return [(unpacked_keys(k.as_py()), unpacked(c.as_py(), np.int64)) for k, c in zip(table["keys"], table["counts"], strict=True)]


def _merge(table: pa.Table) -> pa.Table:
    keys, counts = _distinct(_arrays(table))
    return pa.table({"bucket": table["bucket"].slice(0, 1), "keys": pa.array([packed_keys(keys)], pa.binary()), "counts": pa.array([packed(counts)], pa.binary())})


def _answer_words(table: pa.Table) -> pa.Table:
    """Each chunk's words with their counts in the corpus, and the bucket's tokens and distinct words."""
    parts = _arrays(table)
    keys, counts = _distinct(parts)
    values = [packed(counts[np.searchsorted(keys, k)]) for k, _ in parts]
    n = len(parts)
    return pa.table(
        {
            "kind": table["kind"],
            "bucket": table["bucket"],
            "chunk": table["chunk"],
            "values": pa.array(values, pa.binary()),
            "tokens": pa.array([int(counts.sum())] * n, pa.int64()),
            "distinct": pa.array([int((counts > 0).sum())] * n, pa.int64()),
        }
    )


class Uniform:
    """What stands above the restaurant without context: all symbols alike."""

    def odds(self, dish: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # As in a restaurant of very many customers, where a few more change nothing.
        return np.full(len(dish), 1e9 / 256), np.full(len(dish), 1e9)

    def add(self, dish: np.ndarray, tables: np.ndarray) -> None:
        pass


class Above:
    """The dishes of parent restaurants, while the restaurants below are seated anew.

    ``base`` is each dish's probability one restaurant further up.
    """

    def __init__(self, discount: float, customers: np.ndarray, tables: np.ndarray, restaurant: np.ndarray, in_all: np.ndarray, tables_in_all: np.ndarray, base: np.ndarray):
        self.discount, self.customers, self.tables, self.restaurant = discount, customers.copy(), tables, restaurant
        self.in_all, self.tables_in_all, self.base = in_all.copy(), tables_in_all, base

    def odds(self, dish: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For :func:`seating.draw`, when ``tables`` of a dish's customers have left."""
        restaurant, left = self.restaurant[dish], np.maximum(self.customers[dish] - tables, 0)
        seated = np.minimum(self.tables[dish], left)
        # With the last customer a table closes; who comes first opens one again.
        tables_there = self.tables_in_all[restaurant] - self.tables[dish] + np.maximum(seated, 1)
        inside = left - self.discount * np.maximum(seated, 1) + (STRENGTH + self.discount * tables_there) * self.base[dish]
        return inside, STRENGTH + self.in_all[restaurant] - tables

    def add(self, dish: np.ndarray, tables: np.ndarray) -> None:
        self.customers += np.bincount(dish, tables, len(self.customers)).astype(np.int64)
        self.in_all += np.bincount(self.restaurant[dish], tables, len(self.in_all)).astype(np.int64)


#: Dishes of a restaurant that are seated one after the other; of more, an eighth of those before at a time.
IN_TURN = 16
TURNS = np.minimum(np.arange(257), IN_TURN + np.ceil(np.log(np.maximum(np.arange(257), IN_TURN) / IN_TURN) / np.log(9 / 8)).astype(np.int64))


class Level:
    """Dishes of the restaurants whose contexts have one length, in order of context and dish."""

    def __init__(self, keys: np.ndarray, length: int):
        self.keys, self.discount = keys, DISCOUNTS[length]
        context = keys >> np.uint64(8)
        new = np.ones(len(keys), bool)
        new[1:] = context[1:] != context[:-1]
        self.first = np.flatnonzero(new)
        self.restaurant = np.cumsum(new) - 1
        above = keys & np.uint64((1 << 8 * length) - 1)
        # Up to 256 stretches that are in order, which this sort makes use of.
        order = np.argsort(above, kind="stable")
        ranked = above[order]
        other = np.ones(len(ranked), bool)
        other[1:] = ranked[1:] != ranked[:-1]
        self.parents, self.parent = ranked[other], np.empty(len(keys), np.int64)
        self.parent[order] = np.cumsum(other) - 1
        self.customers = np.zeros(len(keys), np.int64)
        self.tables = np.zeros(len(keys), np.int64)

    def in_all(self, values: np.ndarray) -> np.ndarray:
        """Sums by restaurant."""
        return np.add.reduceat(values, self.first) if len(values) else values

    def sent(self) -> np.ndarray:
        """The parents' customers: the tables here."""
        return np.bincount(self.parent, self.tables, len(self.parents)).astype(np.int64)

    def open(self, customers: np.ndarray) -> np.ndarray:
        """One table for each dish with customers, to begin with; the parents' customers."""
        self.customers, self.tables = customers, np.minimum(customers, 1)
        return self.sent()

    def predict(self, above: np.ndarray) -> np.ndarray:
        """Probability of each dish, given its probability in the parent."""
        own = np.maximum(self.customers - self.discount * self.tables, 0)
        share = (STRENGTH + self.discount * self.in_all(self.tables))[self.restaurant]
        return (own + share * above[self.parent]) / (STRENGTH + self.in_all(self.customers))[self.restaurant]

    def above(self, base: np.ndarray) -> Above:
        """This level as the one above another; ``base`` is the probability of its dishes' parents."""
        return Above(self.discount, self.customers, self.tables, self.restaurant, self.in_all(self.customers), self.in_all(self.tables), base[self.parent])

    def sweep(self, customers: np.ndarray, above: Above | Uniform, rng: np.random.Generator) -> np.ndarray:
        """Seat each dish's customers anew, given all that stay seated; the parents' customers.

        The dishes of a restaurant go one after the other, those of different
        restaurants at once. All of a dish's tables leave the parent first.
        """
        # Tables that closed for want of customers are gone before anyone sits down.
        tables = np.clip(self.tables, np.minimum(customers, 1), customers)
        above.add(self.parent, tables - self.tables)
        self.customers, self.tables = customers, tables
        there = self.in_all(tables)
        # A single customer has a table, whatever the others do.
        moving = np.flatnonzero(customers > 1)
        place = self.restaurant[moving]
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        turn = TURNS[np.arange(len(place)) - np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))]
        order = np.argsort(turn, kind="stable")
        for part in np.split(order, np.cumsum(np.bincount(turn))[:-1]) if len(turn) else ():
            dish, where = moving[part], place[part]
            own, parent = tables[dish], self.parent[dish]
            inside, of = above.odds(parent, own)
            now = draw(self.discount, customers[dish], there[where] - own, inside, of, rng)
            tables[dish] = now
            above.add(parent, now - own)
            np.add.at(there, where, now - own)
        return self.sent()


class Subtree:
    """The restaurants of contexts from ``longest`` down to ``shortest`` bytes, and the dishes above them."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, longest: int = DEPTH, shortest: int = TOP + 1):
        self.levels, self.counts = [], counts
        customers = counts
        for length in range(longest, shortest - 1, -1):
            level = Level(keys, length)
            customers = level.open(customers)
            self.levels.append(level)
            keys = level.parents
        self.top, self.top_customers = keys, customers

    def predict(self, p: np.ndarray) -> np.ndarray:
        """Probability of each run's last symbol, given that of the dishes above all levels."""
        for level in reversed(self.levels):
            p = level.predict(p)
        return p

    def sweep(self, p: np.ndarray, above: Above | Uniform, rng: np.random.Generator) -> None:
        """One sweep from the longest contexts up, each level given the one above as it was."""
        views = [above]
        for level in self.levels[:0:-1]:
            views.append(level.above(p))
            p = level.predict(p)
        customers = self.counts
        for level in self.levels:
            customers = level.sweep(customers, views.pop(), rng)
        self.top_customers = customers

    def seating(self) -> bytes:
        return packed(np.concatenate([level.tables for level in self.levels]))

    def restore(self, seating: bytes) -> None:
        """The seating that :meth:`seating` told of."""
        flat, at, customers = unpacked(seating, np.int64), 0, self.counts
        for level in self.levels:
            level.customers, level.tables = customers, flat[at : at + len(level.keys)]
            customers = level.sent()
            at += len(level.keys)
        self.top_customers = customers


class Top:
    """The restaurants of up to ``TOP`` bytes, which all buckets share."""

    def __init__(self, keys: np.ndarray, customers: np.ndarray):
        self.rng = np.random.Generator(np.random.PCG64(1))
        self.keys, self.tree = keys, Subtree(keys, customers, TOP, 0)
        for _ in range(BURN_IN):
            self.sweep(customers)

    def sweep(self, customers: np.ndarray) -> None:
        self.tree.counts = customers
        self.tree.sweep(np.full(1, 1 / 256), Uniform(), self.rng)

    def told(self) -> dict[str, np.ndarray]:
        """What restaurants below have to know."""
        own, rest = self.tree.levels[0], self.tree.levels[1:]
        base = np.full(1, 1 / 256)
        for level in reversed(rest):
            base = level.predict(base)
        view = own.above(base)
        held = ("customers", "tables", "restaurant", "in_all", "tables_in_all", "base")
        return {"keys": self.keys, "p": own.predict(base), **{name: getattr(view, name) for name in held}}


def _within(top: dict[str, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, Above]:
    """Probabilities and parents of some dishes of the top."""
    at = np.searchsorted(top["keys"], keys)
    places, restaurant = np.unique(top["restaurant"][at], return_inverse=True)
    return top["p"][at], Above(
        DISCOUNTS[TOP], top["customers"][at], top["tables"][at], restaurant, top["in_all"][places], top["tables_in_all"][places], top["base"][at]
    )


def _collected(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Dishes of the restaurants of ``TOP`` bytes in order, and their customers, summed over buckets.

    There are at most 256 to the power of ``TOP`` + 1, whatever the corpus, and far fewer in UTF-8 text.
    """
    each = rows.select(F.explode(F.arrays_zip("dishes", "customers")).alias("x"))
    table = each.groupBy(F.col("x.dishes").alias("dish")).agg(F.sum("x.customers").alias("n")).toArrow()
    keys, customers = table["dish"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order].astype(np.uint64), customers[order].astype(np.int64)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each bucket sends to the top when every dish with customers has one table."""
    for batch in batches:
        for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
            keys, counts = unpacked_keys(keys.as_py()), unpacked(counts.as_py(), np.int64)
            mask = np.uint64((1 << 8 * (TOP + 1)) - 1)
            dishes = np.unique(keys & mask)
            below = np.unique(keys[counts > 0] & np.uint64((1 << 8 * (TOP + 2)) - 1))
            sent = np.bincount(np.searchsorted(dishes, below & mask), minlength=len(dishes))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(dishes)], pa.int32()), pa.array(x.astype(np.int64))) for x in (dishes, sent)]
            yield pa.RecordBatch.from_arrays(lists, ["dishes", "customers"])


SEATED = "bucket int, keys binary, counts binary, seating binary, sampled array<binary>, dishes array<long>, customers array<long>"


def _seated(top: dict[str, np.ndarray], step: int) -> object:
    """One sweep of each bucket, kept as a sample after ``BURN_IN`` of them, and what it sends to the top."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = Subtree(unpacked_keys(row["keys"]), unpacked(row["counts"], np.int64))
                if step:
                    tree.restore(row["seating"])
                p, above = _within(top, tree.top)
                tree.sweep(p, above, np.random.Generator(np.random.PCG64([7919, row["bucket"], step])))
                seating = tree.seating()
                new = {
                    "bucket": row["bucket"], "keys": row["keys"], "counts": row["counts"], "seating": seating,
                    "sampled": (row["sampled"] if step else []) + ([seating] if step >= BURN_IN else []),
                    "dishes": tree.top.astype(np.int64), "customers": tree.top_customers,
                }
                del tree, p, above
                give_back()
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(new.values(), kinds, strict=True)], list(new))

    return run


def _answer_runs(tops: list[tuple[np.ndarray, np.ndarray]]) -> object:
    def run(requests: pa.Table, model: pa.Table) -> pa.Table:
        if not requests.num_rows:
            return pa.table({"kind": pa.array([], pa.string()), "bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int32()), "values": pa.array([], pa.binary())})
        tree = Subtree(unpacked_keys(model["keys"][0].as_py()), unpacked(model["counts"][0].as_py(), np.int64))
        keys = tree.levels[0].keys
        total = np.zeros(len(keys))
        for (top, p), seating in zip(tops, model["sampled"][0], strict=True):
            tree.restore(seating.as_py())
            total += tree.predict(p[np.searchsorted(top, tree.top)])
        value = np.log10(total / SAMPLES).astype(np.float32)
        asked = (unpacked_keys(k.as_py()) for k in requests["keys"])
        values = [packed(value[np.searchsorted(keys, k)]) for k in asked]
        del tree, total
        give_back()
        return pa.table({"kind": requests["kind"], "bucket": requests["bucket"], "chunk": requests["chunk"], "values": pa.array(values, pa.binary())})

    return run


def _scored(buckets: int, train_tokens: int, distinct: int) -> object:
    def looked_up(keys: np.ndarray, deal, answers: dict[int, bytes], kind: type) -> np.ndarray:
        bucket = deal(keys, buckets)
        out = np.zeros(len(keys), kind)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b, values in answers.items():
            out[order[bounds[b] : bounds[b + 1]]] = unpacked(values, kind)
        return out

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        texts = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
        given: dict[str, dict[int, bytes]] = {"word": {}, "run": {}}
        for kind, bucket, values in zip(*(answers[c].to_pylist() for c in ("kind", "bucket", "values")), strict=True):
            given[kind][bucket] = values
        n = len(texts)
        tokens, owner = _chunk_words(texts)
        keys, where = np.unique(tokens, return_inverse=True)
        count = looked_up(keys, _word_bucket, given["word"], np.int64)[where]
        base = np.log10((count + 1) / (train_tokens + distinct + 1))
        # Each block's distinct runs, and which of them stands at each place.
        blocks, every = [], []
        for block in _blocks(texts, BLOCK):
            out, first, end = symbols(texts.slice(block.start, block.stop - block.start))
            real, parts = _inside(out, first, end), []
            for at in range(DEPTH, len(out), BLOCK):
                told = pa.array(runs(out, at, min(len(out), at + BLOCK))).dictionary_encode()
                here, place = told.dictionary.to_numpy(), told.indices.to_numpy()
                # Looked up in order below, which is much faster.
                order = np.argsort(here)
                parts.append((at, here[order], order, place))
                asked = np.zeros(len(here), bool)
                asked[place[real[at : at + BLOCK]]] = True
                every.append(here[asked])
            blocks.append((block, first, end, real, parts))
        keys = np.sort(np.concatenate(every)) if every else np.empty(0, np.uint64)
        keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
        value = looked_up(keys, _run_bucket, given["run"], np.float32)
        score = np.zeros(n)
        for block, first, end, real, parts in blocks:
            sums = np.zeros(len(real) + 1)
            for at, here, order, place in parts:
                known = np.empty(len(here), np.float32)
                known[order] = value[np.minimum(np.searchsorted(keys, here), len(keys) - 1)]
                sums[at + 1 : at + 1 + len(place)] = known[place]
            np.cumsum(sums, out=sums)
            score[block] = sums[end + 1] - sums[first]
        del blocks, every, keys, value
        give_back()
        return pa.table(
            {
                "key": table["key"],
                "n_tokens": pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                "n_known": pa.array(np.bincount(owner, count > 0, n).astype(np.int64)),
                "train_tokens": pa.array(np.full(n, train_tokens, np.int64)),
                "base_score": pa.array(np.bincount(owner, base, n)),
                "score": pa.array(score),
            }
        )

    return run


def score(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row's whole text.

    The model learns from the rows for which ``learn`` is true. A text's tokens are its words (A-Z
    lower-cased, split at ASCII white space) and one end. ``base_score`` is the
    sum of log10((c + 1) / (N + V + 1)) over tokens, c a token's count, N
    (``train_tokens``) and V all and distinct tokens learned; ``n_known`` counts
    tokens with c > 0. ``score`` is the log10 probability of the text by the
    averaged Pitman-Yor predictions, and ``perplexity`` is 10^(-score / n_tokens).
    Null texts are empty and have the end alone. Texts may be of any length. Repeated rows are scored, and
    learned from, as often as they occur; rows that agree in key and text share a chunk. With nothing to learn from all symbols are equally likely.
    Empty tables give no rows; other columns are not looked at, whatever their names.
    """
    scored = settled(docs.sparkSession, lambda: _score(docs, learn, key, text), "scores")
    return scored.withColumnRenamed("key", key).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def _score(docs: DataFrame, learn: Column, key: str, text: str) -> DataFrame:
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = max(1, math.ceil(total / CHUNK_BYTES)), max(8, math.ceil(total / BUCKET_BYTES))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(chunks)).cast("int"))

    requests = written(dealt.groupBy("chunk").applyInArrow(_requests(buckets), REQUEST), "requests")
    words = written(
        requests.where("kind = 'word'")
        .groupBy("bucket")
        .applyInArrow(_answer_words, "kind string, bucket int, chunk int, values binary, tokens long, distinct long"),
        "words",
    )
    by_bucket = words.groupBy("bucket").agg(F.first("tokens").alias("tokens"), F.first("distinct").alias("distinct"))
    tokens, distinct = by_bucket.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()

    # Very common pairs of bytes are in every chunk's requests: those of a bucket are merged and
    # answered in lots of ``LOT`` chunks, so that no task's share grows with the number of chunks.
    lots = math.ceil(chunks / LOT)
    asked = requests.where("kind = 'run'").withColumn("lot", F.pmod("chunk", F.lit(lots)))
    merged = "bucket int, keys binary, counts binary"
    model = asked.groupBy("bucket", "lot").applyInArrow(_merge, merged)
    model = written(model.groupBy("bucket").applyInArrow(_merge, merged) if lots > 1 else model, "runs")
    top = Top(*_collected(model.mapInArrow(_opened, "dishes array<long>, customers array<long>")))
    seated, tops = model, []
    for step in range(BURN_IN + SAMPLES):
        before, seated = seated, written(seated.mapInArrow(_seated(top.told(), step), SEATED), "seatings")
        if step:
            forget(before)
        if step >= BURN_IN:
            told = top.told()
            tops.append((told["keys"], told["p"]))
        top.sweep(_collected(seated)[1])
    trained = seated.select("bucket", "keys", "counts", "sampled").withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    answers = (
        asked.groupBy("bucket", "lot")
        .cogroup(trained.groupBy("bucket", "lot"))
        .applyInArrow(_answer_runs(tops), "kind string, bucket int, chunk int, values binary")
    )
    replies = words.select("kind", "bucket", "chunk", "values").unionByName(answers)
    out = rows.select("key").schema["key"].dataType.simpleString()
    return (
        dealt.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(
            _scored(buckets, int(tokens), int(distinct)),
            f"key {out}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
