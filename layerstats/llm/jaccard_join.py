"""All pairs of texts whose sets of word runs are similar, by MinHash banding.

1. Texts with the same set of runs are one class; classes are compared.
2. Bands of MinHash values are shuffled; classes that share a band are candidates
   and stay if their whole signatures agree well below the threshold. What they
   form is a graph of which a spanning forest is enough, so nothing as large as
   all pairs is ever a row.
3. In each component of that graph the full sets of all members are compared, and
   every pair from the threshold is a link. A set travels as what it lacks and has more
   than the component's first one, which is little among near copies: only components
   of very many members are compared in several blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstats.llm.components import components
from layerstats.llm.frames import give_back, with_columns
from layerstats.llm.store import files_for, settled, written
from layerstats.llm.words import as_sets, mix, shingle_hashes, word_hashes

#: Members of a band that one task compares, and numbers in the differences of a component's block.
BAND_BLOCK = 1000
SET_BLOCK = 400_000
#: Cells of a matrix of members by members, or by numbers, that a task holds at a time.
CELLS = 1 << 20
#: Classes in a file; of their signatures and bands, which take most, a class has less than a KB.
CLASSES = 20_000
#: Signatures that agree in this share less than the threshold are not followed up.
SLACK = 0.25


def choose_bands(threshold: float, recall: float, most: int = 256) -> tuple[int, int]:
    """Bands and rows: the most rows, hence fewest false candidates, that reach the recall with ``most`` values."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def sets_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    words, owner = word_hashes(texts)
    shingles, owner = shingle_hashes(words, owner, len(texts), size)
    return as_sets(shingles, owner, len(texts))


def digests(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """16 bytes that name each set; null for an empty one."""
    filled = np.flatnonzero(np.diff(bounds) > 0)
    halves = np.zeros((len(bounds) - 1, 2), np.uint64)
    if len(filled):
        for k, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            halves[filled, k] = np.add.reduceat(mix(values * np.uint64(odd) + np.uint64(k)), bounds[:-1][filled])
    raw = mix(halves).astype(">u8").tobytes()
    filled = set(filled.tolist())
    return pa.array([raw[16 * i : 16 * i + 16] if i in filled else None for i in range(len(halves))], pa.binary())


class Signer:
    """MinHash signatures and their bands."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        rng = np.random.Generator(np.random.PCG64(4181))
        n = bands * rows
        self.factors = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = rng.integers(0, 1 << 32, n, dtype=np.uint32)

    def sign(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """One row of 32-bit minima for each set; empty sets have zeros."""
        out = np.zeros((len(bounds) - 1, len(self.factors)), np.uint32)
        filled = np.flatnonzero(np.diff(bounds) > 0)
        if len(filled):
            short, first = (values >> np.uint64(32)).astype(np.uint32), bounds[:-1][filled]
            for k, (factor, shift) in enumerate(zip(self.factors, self.shifts, strict=True)):
                out[filled, k] = np.minimum.reduceat(short * factor + shift, first)
        return out

    def band_hashes(self, signatures: np.ndarray) -> np.ndarray:
        parts = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64)
        out = np.broadcast_to(np.arange(self.bands, dtype=np.uint64), parts.shape[:2]).copy()
        for r in range(self.rows):
            out = mix(out * np.uint64(3) + parts[:, :, r] + np.uint64(1))
        return out.view(np.int64)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of ``n`` nodes is connected to by edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root[a] == root[b]).all():
            break
    while (root[root] != root).any():
        root = root[root]
    return root


def _band_edges(least: float) -> object:
    """Edges of a spanning forest of each band block's classes whose signatures agree from ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            tail = table if tail is None else pa.concat_tables([tail, table]).combine_chunks()
            keys = _group_keys(tail)
            last = int(np.searchsorted(keys, keys[-1]))
            if last and tail.num_rows > 4 * BAND_BLOCK:
                yield from pairs(tail.slice(0, last), keys[:last])
                tail = tail.slice(last)
        if tail is not None:
            yield from pairs(tail, _group_keys(tail))
            give_back()

    def pairs(table: pa.Table, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = table["cid"].combine_chunks()
        data = b"".join(table["signature"].to_pylist())
        signatures = np.frombuffer(data, np.uint16).reshape(table.num_rows, -1)
        side = table["side"].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        stop = np.append(first[1:], len(keys))
        left, right = [], []
        for f, s in zip(first[stop - first > 1], stop[stop - first > 1], strict=True):
            a, b = np.triu_indices(s - f, 1)
            a, b = a + f, b + f
            across = side[a] != side[b]
            # Block pairs compare across; what lies within a block was compared by itself.
            if side[f] != 2 and across.any():
                a, b = a[across], b[across]
            elif side[f] != 2:
                continue
            for at in range(0, len(a), 20_000):
                x, y = a[at : at + 20_000], b[at : at + 20_000]
                near = (signatures[x] == signatures[y]).mean(axis=1) >= least
                left.append(x[near]), right.append(y[near])
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            root = _forest(len(keys), a, b)
            moved = np.flatnonzero(root != np.arange(len(keys)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(root[moved])), ids.take(pa.array(moved))], ["a", "b"])

    return run


def _near_pivot(least: float) -> object:
    """Whether each member's signature agrees from ``least`` with that of its band's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot = batch.column("pivot")
            own, other = (
                np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                for x in (batch.column("signature"), pivot.field("signature"))
            )
            near = (own == other).mean(axis=1) >= least if batch.num_rows else np.empty(0, bool)
            kept = [batch.column(c) for c in ("cid", "band", "blocks", "signature")]
            yield pa.RecordBatch.from_arrays([*kept, pivot.field("cid"), pa.array(near)], ["cid", "band", "blocks", "signature", "pivot", "near"])
        give_back()

    return run


def _group_keys(table: pa.Table) -> np.ndarray:
    """Numbers that rise from one group of neighbouring rows to the next."""
    columns = [table[c].to_numpy() for c in ("band", "i", "j")]
    new = np.zeros(table.num_rows, bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def _dealt(members: DataFrame, key: str, blocks: str, cid: str) -> DataFrame:
    """Each member once for every pair (i, j) of blocks that its own block is in; side is 2 if i = j, else 0 or 1."""
    own = F.pmod(F.xxhash64(cid), F.col(blocks))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    placed = members.withColumn("own", own.cast("long")).withColumn("other", other)
    return placed.withColumns(
        {
            "i": F.least("own", "other"),
            "j": F.greatest("own", "other"),
            "side": F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1),
        }
    ).drop("own", "other", blocks)


#: Changes what a set lacks into other numbers than what it has more.
LACKS = np.uint64(0x9E3779B97F4A7C15)


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each set lacks and has more than its component's first set, both as one set of numbers."""
    for batch in batches:
        rows, lacking = [], []
        for held, core in zip(batch.column("shingles"), batch.column("core"), strict=True):
            held, core = np.frombuffer(held.as_py(), np.uint64), np.frombuffer(core.as_py(), np.uint64)
            lacks = np.setdiff1d(core, held, assume_unique=True)
            rows.append(np.concatenate([np.setdiff1d(held, core, assume_unique=True), lacks * LACKS ^ LACKS]).tobytes())
            lacking.append(len(lacks))
        columns = [batch.column(c) for c in ("root", "cid", "n_rows", "size", "core_size")]
        names = ["root", "cid", "n_rows", "size", "core_size", "lacks", "differs"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(lacking, pa.int64()), pa.array(rows, pa.binary())], names)
    give_back()


def _verified(threshold: float) -> object:
    """Links of each member of a block pair, and the least member it is linked to, directly or not."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cid", ignore_index=True)
        sets = [np.frombuffer(x, np.uint64) for x in group["differs"]]
        sizes, lacks = group["size"].to_numpy(np.float32), group["lacks"].to_numpy(np.float32)
        core = np.float32(group["core_size"].iloc[0])
        weights, side, n = group["n_rows"].to_numpy(np.float64), group["side"].to_numpy(), len(group)
        owner = np.repeat(np.arange(n), [len(s) for s in sets])
        number = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(owner) else owner
        common = np.bincount(number) > 1 if len(owner) else np.empty(0, bool)
        place = np.cumsum(common) - 1
        here = common[number]
        owner, number = owner[here], place[number[here]]
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        links, root = np.zeros(n), np.arange(n)
        step, columns = (max(1, min(most, CELLS // n)) for most in (1024, 2048))
        for at in range(0, n, step):
            rows = slice(at, min(n, at + step))
            # The first set without what either lacks, with what both lack, and with what both have more.
            shared = core - lacks[rows, None] - lacks[None, :]
            for c in range(0, int(common.sum()), columns):
                lo, hi = np.searchsorted(number, [c, c + columns])
                held = np.zeros((n, columns), np.float32)
                held[owner[lo:hi], number[lo:hi] - c] = 1
                shared += held[rows] @ held.T
            similar = shared >= threshold * (sizes[rows, None] + sizes[None, :] - shared) - 1e-4
            similar[np.arange(rows.stop - at), np.arange(at, rows.stop)] = False
            similar &= (side[rows, None] == 2) | (side[rows, None] != side[None, :])
            links[rows] = similar @ weights
            # Of the links met so far a spanning forest is kept; all of them would be a list of all pairs.
            a, b = np.nonzero(similar)
            moved = np.flatnonzero(root != np.arange(n))
            root = _forest(n, np.concatenate([moved, a + at]), np.concatenate([root[moved], b]))
        del sets, number, owner, order
        give_back()
        return pd.DataFrame({"cid": group["cid"], "links": links.astype(np.int64), "root": group["cid"].to_numpy()[root]})

    return run


def name_sets(docs: DataFrame, text: str = "text", size: int = 5) -> DataFrame:
    """Put ``cid``, 16 bytes that name the set of a text's word runs, in the text's place; null for texts without words."""
    return with_columns(docs, text, [("cid", T.BinaryType())], lambda texts: [digests(*sets_of(texts, size))], keep_text=False)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row for each distinct set of word runs: cid, set_id, class_id, root, n_rows and n_links.

    ``set_id`` is the least key with that set. ``root`` names, and ``class_id`` is the
    least key of, everything linked to it, directly or over others. ``n_links`` counts
    the other rows whose Jaccard similarity to it is ``threshold`` or more.
    Texts without words have no row. See :func:`join` for the rest.
    """
    return settled(docs.sparkSession, lambda: _classes(docs, key, text, size, threshold, recall), "classes")


def _classes(docs: DataFrame, key: str, text: str, size: int, threshold: float, recall: float) -> DataFrame:
    bands, rows = choose_bands(threshold, recall)
    signer = Signer(bands, rows)
    files = files_for(docs.sparkSession, docs.count(), CLASSES)

    def sign(texts: pa.Array) -> list[pa.Array]:
        values, bounds = sets_of(texts, size)
        signatures = signer.sign(values, bounds)
        hashes = signer.band_hashes(signatures)
        short = signatures.astype(np.uint16)
        return [
            digests(values, bounds),
            pa.array(np.diff(bounds), pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * bands, pa.int32()), pa.array(hashes.ravel())),
            pa.array([row.tobytes() for row in short], pa.binary()),
        ]

    added = [("cid", T.BinaryType()), ("size", T.LongType()), ("bands", T.ArrayType(T.LongType())), ("signature", T.BinaryType())]
    signed = with_columns(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", added, sign, keep_text=False)
    sets = written(
        signed.where("cid is not null")
        .groupBy("cid")
        .agg(F.min("key").alias("set_id"), F.count("*").alias("n_rows"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("signature").alias("signature")),
        "sets",
        files,
    )

    band = sets.select("cid", F.explode("bands").alias("band"))
    crowded = band.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = band.join(crowded, "band").withColumn("blocks", F.ceil(F.col("n") / BAND_BLOCK).cast("long")).drop("n")
    members = members.join(sets.select("cid", "signature"), "cid")
    # In a crowded band all are compared to one member; who resembles it needs no more, as one edge is enough.
    pivot = members.where("blocks > 1").groupBy("band").agg(F.min(F.struct("cid", "signature")).alias("pivot"))
    crowd = written(
        members.where("blocks > 1").join(pivot, "band").select("cid", "band", "blocks", "signature", "pivot").mapInArrow(
            _near_pivot(threshold - SLACK), "cid binary, band long, blocks long, signature binary, pivot binary, near boolean"
        ),
        "crowd",
    )
    # All others are compared to everybody, in blocks.
    rest = crowd.where("not near").groupBy("band").agg(F.ceil(F.count("*") / BAND_BLOCK).cast("long").alias("rest_blocks"))
    crowd = crowd.join(rest, "band", "left").withColumn("rest_blocks", F.coalesce("rest_blocks", F.lit(0)))
    hashed, each = F.xxhash64("cid"), lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    pairs = ("cid", "band", "i", "j", "side", "signature")
    small = members.where("blocks = 1").withColumns({"i": F.lit(0).cast("long"), "j": F.lit(0).cast("long"), "side": F.lit(2)}).select(*pairs)
    few = crowd.where("not near").withColumns({"i": F.pmod(hashed, F.col("rest_blocks")), "j": each(F.col("blocks")), "side": F.lit(0)}).select(*pairs)
    many = crowd.where("rest_blocks > 0").withColumns({"i": each(F.col("rest_blocks")), "j": F.pmod(hashed, F.col("blocks")), "side": F.lit(1)}).select(*pairs)
    dealt = small.unionByName(few).unionByName(many).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "cid")
    edges = dealt.mapInArrow(_band_edges(threshold - SLACK), "a binary, b binary")
    stars = crowd.where("near and cid != pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
    candidates = components(edges.unionByName(stars), files)

    # Full sets of the candidates, from one text of each class.
    named = candidates.join(sets.select("cid", "set_id", "n_rows", "size"), candidates["node"] == sets["cid"]).drop("node")
    wanted = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(
        named.select(F.col("set_id").alias("set_key")).distinct(), F.col("key").eqNullSafe(F.col("set_key")), "left_semi"
    )

    def held(texts: pa.Array) -> list[pa.Array]:
        values, bounds = sets_of(texts, size)
        raw = [values[bounds[i] : bounds[i + 1]].tobytes() for i in range(len(texts))]
        return [digests(values, bounds), pa.array(raw, pa.large_binary()).cast(pa.binary())]

    full = with_columns(wanted, "text", [("cid", T.BinaryType()), ("shingles", T.BinaryType())], held).select("cid", "shingles")
    whole = named.join(full.dropDuplicates(["cid"]), "cid").select("root", "cid", "n_rows", "size", "shingles")
    core = whole.where("cid = root").select("root", F.col("shingles").alias("core"), F.col("size").alias("core_size"))
    slim = written(
        whole.join(core, "root").mapInArrow(
            _differences, "root binary, cid binary, n_rows long, size long, core_size long, lacks long, differs binary"
        ),
        "differences",
        4 * files,
    )
    weight = slim.groupBy("root").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.octet_length("differs") / 8 + 1) / SET_BLOCK)).cast("long").alias("blocks"))
    checked = written(
        _dealt(slim.join(weight, "root"), "root", "blocks", "cid")
        .groupBy("root", "i", "j")
        .applyInPandas(_verified(threshold), "cid binary, links long, root binary"),
        "links",
        4 * files,
    )
    linked = components(checked.select(F.col("root").alias("a"), F.col("cid").alias("b")), files)
    links = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    table = (
        sets.select("cid", "set_id", "n_rows")
        .join(links, "cid", "left")
        .join(linked.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n_rows") - 1)
        .drop("links")
    )
    least = table.groupBy("root").agg(F.min("set_id").alias("class_id"))
    return table.join(least, "root").select("cid", "set_id", "class_id", "root", "n_rows", "n_links").coalesce(files)


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: its key as doc_id, class_id, set_id and n_links.

    Words are split at ASCII white space, A-Z lower-cased; a text is the set of its
    runs of ``size`` words (5), or of all its words if it has fewer. Two rows are
    linked if the Jaccard similarity of their sets is ``threshold`` (0.8) or more.
    ``class_id`` is the least key among all rows connected by links, ``set_id`` among
    the rows with the same set, ``n_links`` the number of other rows linked to this
    one, copies and repeated rows included. A text without words (null, empty) is linked to nothing
    and its own class. Null keys are never the least unless a class has no other.
    Texts may be of any length; an empty table gives no rows; other columns are not looked at,
    whatever their names.
    """
    found = classes(docs, key, text, **options)
    rows = name_sets(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", options.get("size", 5))
    table = rows.join(found, "cid", "left").select(
        "doc_id",
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("set_id")).alias("set_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    return table.coalesce(files_for(docs.sparkSession, docs.count(), CLASSES))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the least key, and one only.

    Of rows with the same least key that with the least hash of its text stays, and of
    those that agree in both, the one with the least hash of all columns.
    Texts without words all stay, and may be of any length. Empty tables give no rows. Which rows stay is decided on keys and hashes
    alone; the texts are shuffled once, to be met by that decision.
    """
    found = classes(docs, key, text, **options).select("cid", "root")
    plain = F.col(text).cast("string")
    slim = docs.select(F.col(key).alias("key"), F.xxhash64(plain).alias("hash"), plain.alias("text"))
    rows = name_sets(slim, "text", options.get("size", 5)).join(found, "cid")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "hash")
    stays = rows.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.key").alias("__key"), F.col("best.hash").alias("__best"))
    worded = F.coalesce(plain.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    hashed = docs.where(worded).withColumn("__hash", F.xxhash64(plain))
    met = hashed.join(stays, hashed[key].eqNullSafe(stays["__key"]) & (F.col("__hash") == F.col("__best")))
    # Of rows that agree in key and text, the one with the least hash of all that can be hashed.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    single = met.groupBy("__key", "__best").agg(F.min_by(F.struct(*columns), F.xxhash64(*hashable)).alias("__row"))
    return single.select(*(F.col(f"__row.`{c}`") for c in docs.columns)).unionByName(docs.where(~worded).select(*columns))
