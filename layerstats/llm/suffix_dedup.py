"""Removal of long repeated strings, by sorting suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
else. Sorting all suffixes finds these, equal ones being neighbours, but a corpus
has a suffix for each byte. So only those that can matter are sorted:

1. Every window of ``length`` bytes elects an anchor, the place in it whose
   following ``gram`` bytes hash least. Equal windows elect the same place, so a
   window can only repeat if its anchor's gram does. Windows in a row mostly share
   an anchor; they and their bytes are its segment.
2. Grams that occur once need no more, nor do segments that occur whole again:
   all their windows repeat. What is left are the segments at the edges of
   repeats.
3. Their bytes are dealt out by ranges of leading bytes, between splitters that
   Spark samples. Equal grams never part, so no window has an equal one across a
   boundary. Each bucket sorts the suffixes that start at its windows by multikey
   quicksort, eight bytes a symbol; windows still tied after ``length`` bytes repeat.

A gram with more different segments than a bucket should hold is not dealt out
by its bytes: its windows are counted by digests of 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstats.llm.frames import free_name, give_back, pieces
from layerstats.llm.store import settled, written
from layerstats.llm.words import _TABLE, _power, buffers, mix

LENGTH, GRAM = 200, 48
#: Bits of an anchor's place within the bytes that are hashed at a time.
PLACE_BITS = 20
#: Segments that a bucket sorts at a time, and of one gram at most; windows a task is given.
SORTED, CROWDED, TASK_WINDOWS = 10_000, 20_000, 4_000_000

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n, step = len(values) - width + 1, 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[:n], values[width - step : width - step + n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of all windows: text number, place of the first window, windows, anchor's offset, gram and segment hashes."""
    names = ("text", "start", "windows", "offset", "gram", "segment")
    found: dict[str, list[np.ndarray]] = {name: [] for name in names}
    size = (1 << PLACE_BITS) - 1
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, max(0, len(data) - length + 1), size - length + 1):
        part = data[at : at + size]
        n = len(part) - length + 1
        if n <= 0:
            break
        up, down = _power(1 << PLACE_BITS)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_TABLE[part] * up[: len(part)], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1])
        places = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_least(places, length - gram + 1) & mask).astype(np.int64)
        starts = np.arange(at, at + n)
        text = np.searchsorted(offsets, starts[0], side="right") - 1
        limits = offsets[text + 1 : np.searchsorted(offsets, at + n + length, side="left") + 1]
        # A window is valid if no text ends inside it.
        valid = np.ones(n + 1, bool)
        for end in limits - at:
            valid[max(0, end - length + 1) : max(0, min(n, end))] = False
        valid[n] = False
        good = np.flatnonzero(valid[:n])
        if not len(good):
            continue
        new = np.ones(len(good), bool)
        new[1:] = (np.diff(good) != 1) | (anchor[good[1:]] != anchor[good[:-1]])
        first = good[new]
        count = np.diff(np.append(np.flatnonzero(new), len(good)))
        stop = first + count - 1 + length
        place = anchor[first]
        whole = (sums[stop] - sums[first]) * down[first]
        owner = np.searchsorted(offsets, first + at, side="right") - 1
        shape = ((place - first) * 4096 + count).astype(np.uint64)
        values = (owner, first + at - offsets[owner], count, place - first, grams[place], mix(whole * np.uint64(5) + mix(shape)))
        for name, value in zip(names, values, strict=True):
            found[name].append(value)
    return {name: np.concatenate(parts) if parts else np.empty(0, np.int64) for name, parts in found.items()}


def tied(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each place equal those of another place in its group: multikey quicksort.

    Suffixes of a group are sorted by their next eight bytes, and only those that
    are still tied go on to the eight after; ``length`` is a multiple of eight.
    """
    symbols = np.ndarray(len(data) - 7, ">u8", np.ascontiguousarray(data), strides=(1,))
    result = np.zeros(len(at), bool)
    active = np.argsort(group, kind="stable")
    group = group[active]
    for depth in range(0, length, 8):
        symbol = symbols[at[active] + depth]
        same = group[1:] == group[:-1]
        split = same & (symbol[1:] != symbol[:-1])
        if split.any():
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            sizes = np.diff(np.append(first, len(group)))
            uneven = np.logical_or.reduceat(np.append(split, False), first)
            place = np.flatnonzero(np.repeat(uneven, sizes))
            order = np.lexsort((symbol[place], group[place]))
            active[place], symbol[place] = active[place][order], symbol[place][order]
            same &= symbol[1:] == symbol[:-1]
        group = np.concatenate([[0], np.cumsum(~same)])
        more = np.zeros(len(group), bool)
        more[1:] |= same
        more[:-1] |= same
        active, group = active[more], group[more]
        if not len(active):
            return result
    result[active] = True
    return result


def _runs(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of true flags with one owner."""
    place = np.flatnonzero(flags)
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (owner[place[1:]] != owner[place[:-1]])
    first = place[new]
    last = place[np.append(np.flatnonzero(new)[1:], len(place)) - 1] if len(place) else first
    return first, last


def _sorted_bucket(length: int) -> object:
    """Repeated stretches of the segments of a bucket, whose rows come in order of their grams."""
    names = ["print", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.Table] = []
        held = 0
        for batch in batches:
            rest.append(pa.Table.from_batches([batch]))
            held += batch.num_rows
            if held >= SORTED:
                table = pa.concat_tables(rest).combine_chunks()
                grams = table["gram"].to_numpy()
                last = int(np.flatnonzero(grams != grams[-1])[-1]) + 1 if (grams != grams[-1]).any() else 0
                if last:
                    yield from work(table.slice(0, last))
                rest = [table.slice(last)]
                held = table.num_rows - last
        if held:
            yield from work(pa.concat_tables(rest).combine_chunks())
        rest.clear()
        give_back()

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        # The rows come in order of their leads, and equal grams have equal leads, but grams of one lead may alternate.
        table = table.sort_by("gram")
        data, begin = buffers(table["bytes"].combine_chunks().cast(pa.large_binary()))
        windows, offset = table["windows"].to_numpy(), table["offset"].to_numpy()
        gram = table["gram"].to_numpy()
        number = np.concatenate([[0], np.cumsum(gram[1:] != gram[:-1])])
        row = np.repeat(np.arange(len(windows)), windows)
        step = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        # Equal windows lie at the same distance before their anchor.
        group = number[row] * (2 * length) + offset[row] - step
        flags = tied(np.append(data, np.zeros(8, np.uint8)), begin[row] + step, group, length)
        flags &= (table["n"].to_numpy() == 1)[row]
        first, last = _runs(flags, row)
        owner = table.take(pa.array(row[first]))
        start = owner["start"].to_numpy() + step[first]
        columns = [owner["print"].combine_chunks(), pa.array(start), pa.array(start + step[last] - step[first] + length)]
        yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _print(text: str) -> Column:
    """What names a text: rows of equal text have the same spans, and are counted and cut as one."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")))


def repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """print and spans (start, end in bytes, some overlapping) of all strings of ``length`` bytes that occur again.

    ``print`` is the MD5 digest of the text: spans are found once for rows of equal text.
    """
    if length % 8 or not 8 <= gram < length or length - gram >= 4096:
        raise ValueError("length must be a multiple of eight, and gram from 8 to less than it")
    texts = docs.select(_print(text).alias("print"), F.col(f"`{text}`").cast("string").alias("text")).where(F.octet_length("text") >= length)
    schema = T.StructType(
        [T.StructField("print", T.BinaryType())]
        + [T.StructField(n, k) for n, k in (("start", T.LongType()), ("windows", T.IntegerType()), ("offset", T.IntegerType()), ("gram", T.LongType()), ("segment", T.LongType()))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = segments(*buffers(part.column("text")), length, gram)
                owner = pa.array(found["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("print").take(owner),
                        pa.array(found["start"], pa.int64()),
                        pa.array(found["windows"].astype(np.int32)),
                        pa.array(found["offset"].astype(np.int32)),
                        pa.array(found["gram"].view(np.int64)),
                        pa.array(found["segment"].view(np.int64)),
                    ],
                    schema.names,
                )

    anchors = written(texts.mapInArrow(cut, schema), "anchors")
    grams = (
        anchors.groupBy("gram")
        .agg(F.count("*").alias("of_gram"), (F.min("segment") == F.max("segment")).alias("uniform"))
        .where("of_gram > 1")
    )
    # As a table of its own it lets Spark split the other side of the join where a gram has very many anchors.
    grams = written(grams.select("gram", "uniform"), "grams")
    again = written(anchors.join(grams, "gram"), "again")
    mixed = again.where("not uniform")
    kinds = written(
        mixed.groupBy("gram", "segment").agg(
            F.count("*").alias("n"), F.min(F.struct("print", "start", "windows", "offset")).alias("one")
        ).select("gram", "segment", "n", "one.*"),
        "kinds",
    )
    end = F.col("start") + F.col("windows") - 1 + length
    whole = again.where("uniform").unionByName(mixed.join(kinds.where("n > 1").select("gram", "segment"), ["gram", "segment"]))
    whole = whole.select("print", "start", end.alias("end"))

    # Only segments of which there is one are open, but they are compared to all of their gram.
    crowd = kinds.groupBy("gram").agg(F.count("*").alias("of_gram"), F.min("n").alias("least")).where("least = 1")
    open_kinds = kinds.join(crowd.select("gram", (F.col("of_gram") > crowded).alias("crowded")), "gram")
    wanted = open_kinds.groupBy("print").agg(F.collect_list(F.struct("gram", "start", "windows", "offset", "n", "crowded")).alias("wanted"))
    # One of the rows of equal text gives the bytes.
    source = texts.groupBy("print").agg(F.first("text").alias("text")).join(wanted, "print")
    fetched = source.select("print", F.encode("text", "utf-8").alias("raw"), F.explode("wanted").alias("w")).select(
        "print", "w.*", F.substring("raw", F.col("w.start").cast("int") + 1, F.col("w.windows") - 1 + length).alias("bytes")
    )
    total = kinds.agg(F.sum("windows")).first()[0] or 0
    lead = F.substring("bytes", F.col("offset") + 1, gram)
    buckets = (
        fetched.where("not crowded")
        .withColumn("lead", lead)
        .repartitionByRange(max(1, math.ceil(total / TASK_WINDOWS), docs.sparkSession.sparkContext.defaultParallelism), "lead")
        .sortWithinPartitions("lead")
        .drop("lead", "crowded")
    )
    edges = buckets.mapInArrow(_sorted_bucket(length), "print binary, start long, end long")

    # Crowded grams, window by window.
    step = F.explode(F.sequence(F.lit(0), F.col("windows") - 1))
    single = fetched.where("crowded").withColumn("step", step).withColumn("window", F.substring("bytes", F.col("step") + 1, length))
    digest = F.substring(F.sha2("window", 256), 1, 32)
    single = single.select("print", "n", (F.col("start") + F.col("step")).alias("start"), digest.alias("digest"))
    twice = single.groupBy("digest").agg(F.sum("n").alias("in_all")).where("in_all > 1").select("digest")
    hot = single.where("n = 1").join(twice, "digest").select("print", "start", (F.col("start") + length).alias("end"))
    spans = whole.unionByName(edges).unionByName(hot)
    # Rows of equal text have given the same spans, which each task keeps once.
    return spans.groupBy("print").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _cut_out(texts: pa.Array, spans: pa.Array, characters: bool) -> tuple[list[bytes], np.ndarray, pa.Array]:
    """Bytes kept of each text, bytes removed, and the maximal removed runs."""
    data, offsets = buffers(texts)
    spans = spans.fill_null([]) if spans.null_count else spans
    bounds = spans.offsets.to_numpy()
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    flat = spans.flatten()
    change = np.zeros(len(data) + 1, np.int32)
    for name, by in (("start", 1), ("end", -1)):
        np.add.at(change, flat.field(name).to_numpy(zero_copy_only=False) + offsets[owner], by)
    gone = np.cumsum(change[:-1]) > 0
    if characters and len(data):
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        gone = np.repeat(np.logical_and.reduceat(gone, lead), np.diff(np.append(lead, len(data))))
    text_of = np.repeat(np.arange(len(texts)), np.diff(offsets))
    first, last = _runs(gone, text_of)
    at = text_of[first]
    runs = pa.StructArray.from_arrays([pa.array(first - offsets[at]), pa.array(last + 1 - offsets[at])], ["start", "end"])
    counts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(texts)))])
    removed = np.bincount(text_of[gone], minlength=len(texts))
    kept = data[~gone].tobytes()
    place = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)])
    return (
        [kept[place[i] : place[i + 1]] for i in range(len(texts))],
        removed,
        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), runs),
    )


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    characters: bool = False,
    kept: str = "kept",
    removed: str = "removed",
    **options,
) -> DataFrame:
    """Add ``kept`` (binary), what is left of each text's UTF-8 bytes, and ``removed``, the maximal runs cut out.

    Every byte goes that lies in a string of ``length`` bytes which also starts
    anywhere else, in another row or the same text; strings are judged on the
    input, and overlaps count. Nothing matches across texts. With ``characters`` a
    character stays whole unless all its bytes go. Null texts are empty; texts
    shorter than ``length`` stay, and texts may be of any length. Rows of equal text
    remove each other's text if it is long enough, however many they are, and are worked
    on as one. Keys are not looked at. An empty table gives no rows. Columns of the added
    names are replaced; other names do not clash.

    Bytes are compared for all windows but those of segments that occur whole again, which
    two hashes of 64 bits tell, one of the gram and one of the segment, and those of crowded
    grams, which 128 bits of SHA-256 tell.
    """
    spans, print_of, of = (free_name(docs, name) for name in ("__spans", "__print", "__of"))
    found = settled(
        docs.sparkSession,
        lambda: repeats(docs, text, length, **options).select(F.col("print").alias(of), F.col("spans").alias(spans)),
        "spans",
    )
    kept_fields = [f for f in docs.schema.fields if f.name.lower() not in (kept.lower(), removed.lower())]
    rows = docs.select(*(F.col(f"`{f.name}`") for f in kept_fields), _print(text).alias(print_of))
    rows = rows.join(found, rows[print_of] == found[of], "left").drop(print_of, of)
    schema = T.StructType([*kept_fields, T.StructField(kept, T.BinaryType()), T.StructField(removed, SPAN)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                left, _, runs = _cut_out(part.column(text).cast(pa.string()), part.column(spans), characters)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept_fields), pa.array(left, pa.binary()), runs], schema.names
                )

    return rows.mapInArrow(run, schema)
