"""Removing lines that occur in several documents, with two Bloom filters.

Every task makes two filters of its documents' lines: hashes seen once, and hashes
seen twice. Filters merge: what was seen once on both sides has been seen twice.
They are cut into segments of fixed size, so that merging is spread over tasks.
Only lines that the merged twice-seen filter suspects are shuffled, to be compared
as whole texts and to find the smallest document of each; documents without such
a line never move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstats.llm.frames import pieces
from layerstats.llm.store import written
from layerstats.llm.words import LOWER, buffers, mix, range_hashes, spans

#: Bits of the filter for each line, bits that a line sets, and the bits of a segment as a power of two.
BITS_PER_LINE, HASHES, SEGMENT_BITS = 16, 3, 19
#: Hashes that a task gathers before it makes filters of them.
GATHERED = 1 << 20
#: A twice-seen filter of up to so many bytes is broadcast; beyond, hashes of lines meet its segments in a join.
BROADCAST_BYTES = 64 << 20
#: Shares that a line's occurrences are spread over while they are compared, so that a frequent line is no one task's work.
SHARES = 64

_LOST = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("lines", T.ArrayType(T.IntegerType()))])


class Lines:
    """Lines of many texts, flat: bounds, owner, bounds of the key, and a hash of the key of each that is long enough."""

    def __init__(self, texts: pa.Array, least: int):
        self.data, offsets = buffers(texts)
        n = len(texts)
        breaks = np.flatnonzero(self.data == 10)
        self.counts = np.bincount(np.searchsorted(offsets, breaks, side="right") - 1, minlength=n) + 1
        self.first = np.cumsum(self.counts) - self.counts
        total = int(self.counts.sum())
        opens = np.zeros(total, bool)
        opens[self.first] = True
        closes = np.zeros(total, bool)
        closes[self.first + self.counts - 1] = True
        self.starts, self.ends = np.empty(total, np.int64), np.empty(total, np.int64)
        self.starts[opens], self.starts[~opens] = offsets[:-1], breaks + 1
        self.ends[closes], self.ends[~closes] = offsets[1:], breaks
        self.owner = np.repeat(np.arange(n), self.counts)
        # A key goes from the first word's start to the last word's end.
        begin, end, _ = spans(self.data, offsets)
        begin, end = np.append(begin, len(self.data)), np.append(end, len(self.data))
        key_start = begin[np.searchsorted(begin[:-1], self.starts)]
        key_end = end[np.searchsorted(end[:-1], self.ends, side="right") - 1] if len(end) > 1 else key_start
        wide = np.flatnonzero((key_start < self.ends) & (key_end - key_start >= least))
        self.low = LOWER[self.data]
        # Characters take up to four bytes: only keys of few bytes are counted.
        short = wide[key_end[wide] - key_start[wide] < 4 * least]
        bounds = np.stack([key_start[short], key_end[short]], 1).ravel()
        if len(bounds):
            heads = np.append((self.data & 0xC0) != 0x80, False)
            points = np.add.reduceat(heads, bounds, dtype=np.int32)[::2]
            wide = np.setdiff1d(wide, short[points < least], assume_unique=True)
        self.line, self.key_start, self.key_end = wide, key_start[wide], key_end[wide]
        self.hash = range_hashes(self.low, self.key_start, self.key_end)

    def key(self, i: int) -> bytes:
        return self.low[self.key_start[i] : self.key_end[i]].tobytes()


def _places(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Each hash's segment, and its bits there."""
    segment = ((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    bits = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    shifts = np.arange(HASHES, dtype=np.uint64) * np.uint64(SEGMENT_BITS)
    return segment.astype(np.int64), ((bits[:, None] >> shifts) & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)


def _by_segment(hashes: np.ndarray, segments: int) -> dict[int, np.ndarray]:
    segment, bits = _places(hashes, segments)
    flat = np.unique((segment[:, None] << SEGMENT_BITS) | bits)
    where = flat >> SEGMENT_BITS
    cuts = np.flatnonzero(np.diff(where)) + 1
    parts = np.split((flat & ((1 << SEGMENT_BITS) - 1)).astype(np.uint32), cuts)
    return dict(zip(where[np.append(0, cuts)].tolist(), parts, strict=True)) if len(flat) else {}


def _merged(group: pa.Table) -> pa.Table:
    """The twice-seen filter of one segment from all tasks' filters."""
    once, twice = np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
    for seen, again in zip(group["once"], group["twice"], strict=True):
        here = np.frombuffer(seen.as_py(), np.uint32)
        twice[here[once[here]]] = True
        once[here] = True
        twice[np.frombuffer(again.as_py(), np.uint32)] = True
    words = np.packbits(twice, bitorder="little").view(np.int64)
    bits = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words))
    return pa.table({"segment": group["segment"].slice(0, 1), "bits": bits})


def twice_seen(texts: DataFrame, segments: int, least: int = 10) -> DataFrame:
    """segment, bits: the filter that holds every key found in at least two rows of ``texts`` (one text column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def filters(gathered: list[np.ndarray]) -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(gathered), return_counts=True)
            once, twice = _by_segment(hashes, segments), _by_segment(hashes[counts > 1], segments)
            none = np.empty(0, np.uint32)
            rows = [(s, bits.tobytes(), twice.get(s, none).tobytes()) for s, bits in once.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))],
                ["segment", "once", "twice"],
            )

        gathered, held = [], 0
        for batch in batches:
            for part in pieces(batch, "text"):
                lines = Lines(part.column("text"), least)
                owner = lines.owner[lines.line]
                order = np.lexsort((lines.hash, owner))
                found, owner = lines.hash[order], owner[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
                gathered.append(found[new])
                held += len(gathered[-1])
                if held >= GATHERED:
                    yield filters(gathered)
                    gathered, held = [], 0
        if held:
            yield filters(gathered)

    made = texts.mapInArrow(run, "segment int, once binary, twice binary")
    return made.groupBy("segment").applyInArrow(_merged, "segment int, bits array<long>")


def _held(bits: np.ndarray, hashes: np.ndarray, segments: int) -> np.ndarray:
    segment, place = _places(hashes, segments)
    at = (segment[:, None] << SEGMENT_BITS) | place
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1)


def _suspects(lines: Lines, here: np.ndarray, n: int) -> pa.Array:
    """For each of n texts its suspected keys, each with the numbers of the lines that have it."""
    found: list[dict[bytes, list[int]]] = [{} for _ in range(n)]
    for i in np.flatnonzero(here):
        line = int(lines.line[i])
        owner = int(lines.owner[line])
        found[owner].setdefault(lines.key(i), []).append(line - int(lines.first[owner]))
    kind = pa.list_(pa.struct([("key", pa.binary()), ("lines", pa.list_(pa.int32()))]))
    return pa.array([[{"key": k, "lines": v} for k, v in keys.items()] for keys in found], kind)


def _probed(rows: DataFrame, filters: DataFrame, segments: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Rows with suspected lines and those lines; and the rows without any."""
    schema = rows.schema
    with_lines = T.StructType([*schema.fields, T.StructField("suspected", T.ArrayType(_LOST))])
    if segments << (SEGMENT_BITS - 3) <= BROADCAST_BYTES:
        bits = np.zeros(segments << (SEGMENT_BITS - 3), np.uint8)
        table = filters.toArrow()
        for s, words in zip(table["segment"].to_pylist(), table["bits"], strict=True):
            at = s << (SEGMENT_BITS - 3)
            bits[at : at + (1 << (SEGMENT_BITS - 3))] = words.values.to_numpy().view(np.uint8)
        shared = rows.sparkSession.sparkContext.broadcast(bits)

        def probe(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text"):
                    lines = Lines(part.column("text"), least)
                    here = _held(shared.value, lines.hash, segments)
                    some = np.zeros(part.num_rows, bool)
                    some[lines.owner[lines.line[here]]] = True
                    if wanted:
                        part = part.append_column("suspected", _suspects(lines, here, part.num_rows))
                    yield part.filter(pa.array(some == wanted))

        suspected = rows.mapInArrow(lambda batches: probe(batches, True), with_lines)
        return suspected, rows.mapInArrow(lambda batches: probe(batches, False), schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                lines = Lines(part.column("text"), least)
                owner = lines.owner[lines.line]
                segment, place = _places(lines.hash, segments)
                ids = [part.column(c).take(pa.array(owner)) for c in ("key", "print")]
                columns = [*ids, pa.array(lines.hash.view(np.int64)), pa.array(segment.astype(np.int32))]
                columns += [pa.array(place[:, j].astype(np.int32)) for j in range(HASHES)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "print", "hash", "segment", *(f"p{j}" for j in range(HASHES))])

    kind = schema["key"].dataType.simpleString()
    named = f"key {kind}, print string, hash long, segment int, " + ", ".join(f"p{j} int" for j in range(HASHES))
    asked = rows.select("key", "print", "text").mapInArrow(hashed, named).distinct()
    held = F.lit(True)
    for j in range(HASHES):
        held = held & (F.expr(f"shiftright(bits[p{j} div 64], p{j} % 64) & 1") == 1)
    met = asked.join(filters, "segment").where(held).groupBy("key", "print").agg(F.collect_list("hash").alias("hashes"))
    joined = rows.alias("r").join(
        met.alias("m"), F.col("r.key").eqNullSafe(F.col("m.key")) & (F.col("r.print") == F.col("m.print")), "left"
    )
    joined = written(joined.select("r.*", "m.hashes"), "probed")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                lines = Lines(part.column("text"), least)
                lists = part.column("hashes")
                sizes = np.diff(lists.offsets.to_numpy())
                asked = np.repeat(np.arange(part.num_rows), sizes), lists.flatten().to_numpy()
                pairs = np.rec.fromarrays([lines.owner[lines.line], lines.hash.view(np.int64)], names="o,h")
                here = np.isin(pairs, np.rec.fromarrays(asked, names="o,h")) if len(asked[0]) else np.zeros(len(pairs), bool)
                columns = [part.column(c) for c in schema.names]
                yield pa.RecordBatch.from_arrays([*columns, _suspects(lines, here, part.num_rows)], [*schema.names, "suspected"])

    suspected = joined.where("hashes is not null").mapInArrow(gather, with_lines)
    return suspected, joined.where("hashes is null").select(*schema.names)


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose numbers go with them."""
    for batch in batches:
        for part in pieces(batch, "text"):
            kept, lost = [], []
            for text, numbers in zip(part.column("text"), part.column("gone"), strict=True):
                gone = set(numbers.as_py() or ())
                lines = (text.as_py() or "").split("\n")
                kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone))
                lost.append(len(gone))
            columns = [part.column("row"), part.column("text"), pa.array(lost, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "n_dropped", "kept"])


def remove_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept, the text without lines that a smaller document has.

    Texts are split at ``\\n``; null and empty texts are one empty line, and ``kept``
    is then empty. A line's key is the line without ASCII white space at both ends,
    A-Z lower-cased. A key of at least ``least`` code points that is found under two
    keys of documents or more stays only in the smallest of these, with all its lines
    there. Rows that share a document's key are one document, also with different
    texts: what is found in them alone stays. A null key is one document, after all
    others. Texts may be of any length. Repeated rows are treated alike. Empty tables
    give no rows. Columns of ``docs`` named as a new one are replaced; other names do
    not clash.
    """
    names = {"n_lines", "n_dropped", "kept"}
    carried = [c for c in docs.columns if c.lower() not in names]
    source = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        source.alias("text"),
        F.col(f"`{key}`").alias("key"),
        F.sha2(F.coalesce(source, F.lit("")).cast("binary"), 256).alias("print"),
        F.struct(*(F.col(f"`{c}`") for c in carried if c != text), F.lit(0).alias("__")).alias("row"),
    )
    n_lines: Column = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    n_lines = F.coalesce(n_lines, F.lit(1)).cast("long")
    total = rows.agg(F.sum(n_lines)).first()[0] or 0
    segments = max(1, -(-total * BITS_PER_LINE >> SEGMENT_BITS))
    filters = written(twice_seen(rows.select("text"), segments, least), "twice-seen")
    suspected, clear = _probed(rows, filters, segments, least)
    suspected = written(suspected, "suspected-lines")

    # The smallest document of each suspected key, by whole keys. A frequent key's occurrences are
    # reduced share by share; afterwards a digest names the key.
    found = suspected.select("key", "print", F.explode("suspected").alias("s")).select(
        F.struct(F.col("key").isNull().alias("last"), F.col("key").alias("key")).alias("doc"),
        "print",
        F.col("s.key").alias("line"),
        F.unhex(F.sha2("s.key", 256)).alias("digest"),
        F.col("s.lines").alias("lines"),
        F.pmod(F.xxhash64("key", "print"), F.lit(SHARES)).cast("int").alias("share"),
    )
    shares = found.groupBy("line", "digest", "share").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    several = (
        shares.groupBy("line", "digest")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_list("share").alias("shares"))
        .where("low != high")
        .select("digest", F.explode("shares").alias("share"), F.col("low").alias("first"))
    )
    gone = (
        found.select("doc", "print", "digest", "lines", "share")
        .join(several, ["digest", "share"])
        .where("doc != first")
        .groupBy("doc", "print")
        .agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("gone"))
    )
    doc = F.struct(F.col("key").isNull().alias("last"), F.col("key").alias("key"))
    marked = suspected.select("text", "row", "print", doc.alias("doc")).join(gone, ["doc", "print"], "left")
    shorter = marked.select("row", "text", "gone").mapInArrow(
        _dropped, T.StructType([rows.schema["row"], rows.schema["text"], T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())])
    )
    whole = clear.select("row", "text", F.lit(0).cast("long").alias("n_dropped"), F.coalesce("text", F.lit("")).alias("kept"))
    both = whole.unionByName(shorter).withColumn("n_lines", n_lines)
    back = [F.col("text").cast(docs.schema[text].dataType).alias(c) if c == text else F.col(f"row.`{c}`") for c in carried]
    return both.select(*back, "n_lines", "n_dropped", "kept")
