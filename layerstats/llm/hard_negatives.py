"""Hard negatives: rows of another label that score nearly as high as a positive.

Anchors and candidates are packed into tiles of int64 components. Each block of
anchors meets each group of candidates once: their inner products come from
Strassen's recursive multiplication, whose additions are exact in integers, and
leave as short lists that merge: first each anchor's best positives, then, once
these set the windows, the best negatives in each window.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerstats.llm.store import written

#: Rows of a packed tile of candidates, candidates of a group, and anchors of a block.
TILE, GROUP, BLOCK = 2048, 16384, 1024
#: Products of a slice of a block held at once.
CELLS = 1 << 21
#: Side down to which Strassen's recursion goes.
LEAF = 32
#: Products below this are exact in float64, which multiplies leaves faster than int64 does.
EXACT = 2.0**53


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if 0 <= most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for sides that are halved as long as all are above ``LEAF``."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF or m % 2 or k % 2 or n % 2:
        return _leaf(a, b)
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.empty((2 * m, 2 * n), np.int64)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    p = _strassen(a11 + a22, b11 + b22)
    c11[:], c22[:] = p, p
    p = _strassen(a21 + a22, b11)
    c21[:] = p
    c22 -= p
    p = _strassen(a11, b12 - b22)
    c12[:] = p
    c22 += p
    p = _strassen(a22, b21 - b11)
    c11 += p
    c21 += p
    p = _strassen(a11 + a12, b22)
    c11 -= p
    c12 += p
    c22 += _strassen(a21 - a11, b11 + b12)
    c11 += _strassen(a12 - a22, b21 + b22)
    return out


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of int64 matrices by Strassen's method, padded with zeros; beyond 64 bits it wraps, as int64 does."""
    (m, k), n = a.shape, b.shape[1]
    if not min(m, k, n):
        return np.zeros((m, n), np.int64)
    halvings = max(0, min(math.ceil(math.log2(side / LEAF)) for side in (m, k, n)))
    step = 1 << halvings
    up = lambda side: -(-side // step) * step
    left, right = np.zeros((up(m), up(k)), np.int64), np.zeros((up(k), up(n)), np.int64)
    left[:m, :k], right[:k, :n] = a, b
    with np.errstate(over="ignore"):
        return _strassen(left, right)[:m, :n]


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of components; shorter rows end in zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _packed(rows: DataFrame, size: int, width: int) -> DataFrame:
    """Rows of ``rows`` (vector and others) in tiles of ``size`` or fewer, each with a random number."""
    others = [c for c in rows.columns if c != "vector"]
    kinds = ", ".join(f"{c} array<{rows.schema[c].dataType.simpleString()}>" for c in others)

    def tiles(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(table), size):
            part = table.slice(at, size).combine_chunks().to_batches()[0]
            bounds = pa.array([0, part.num_rows], pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, part.column(c)) for c in others]
            block = pa.array([_matrix(part.column("vector"), width).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([secrets.randbits(62)], pa.int64()), block, *lists], ["tile", "components", *others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                table, whole = pa.Table.from_batches(held), n // size * size
                yield from tiles(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                n -= whole
        if n:
            yield from tiles(pa.Table.from_batches(held))

    return rows.mapInArrow(run, f"tile long, components binary, {kinds}")


class _Rows:
    """The rows of some tiles, one below the other; with ``by_id`` in order of id, null last."""

    def __init__(self, table: pa.Table, width: int, by_id: bool = False):
        table = table.combine_chunks()
        self.components = np.concatenate([np.frombuffer(c.as_py(), np.int64).reshape(-1, width) for c in table["components"]])
        lists = [c for c in table.column_names if pa.types.is_list(table.schema.field(c).type)]
        self.columns = {c: pa.concat_arrays([v.values for v in table[c]]) for c in lists}
        if by_id:
            order = pc.sort_indices(self.columns["id"], null_placement="at_end")
            self.components = self.components[order.to_numpy()]
            self.columns = {c: v.take(order) for c, v in self.columns.items()}

    def numbers(self, name: str) -> np.ndarray:
        return self.columns[name].to_numpy(zero_copy_only=False)


def _labels(*rows: _Rows) -> list[np.ndarray]:
    """Numbers for labels, equal on all sides for equal labels."""
    codes = pa.concat_arrays([r.columns["label"] for r in rows]).dictionary_encode().indices.to_numpy()
    return np.split(codes, np.cumsum([len(r.components) for r in rows])[:-1])


def _best(scores: np.ndarray, fits: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and column of each row's highest score that fits, k times; the first column of equal ones."""
    lowest = np.iinfo(np.int64).min
    fits, masked = fits.copy(), np.where(fits, scores, lowest)
    left = np.flatnonzero(fits.any(1))
    for _ in range(k):
        if not len(left):
            return
        column = masked[left].argmax(1)
        # The lowest number may itself be a score.
        wrong = ~fits[left, column]
        column[wrong] = fits[left[wrong]].argmax(1)
        yield left, column
        masked[left, column], fits[left, column] = lowest, False
        left = left[fits[left].any(1)]


def _slices(rows: int, columns: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, columns))
    for at in range(0, rows, step):
        yield slice(at, min(rows, at + step))


def _met(blocks: DataFrame, tiles: DataFrame, n_blocks: int, groups: int, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each block of anchors with each group of candidates, both of bounded size, once."""
    left = blocks.withColumn("block", F.pmod("tile", F.lit(n_blocks)).cast("int"))
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = tiles.withColumn("group", F.pmod("tile", F.lit(groups)).cast("int"))
    right = right.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    return left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(work, schema)


def _taken(anchors: _Rows, names: dict[str, str], at: np.ndarray) -> dict[str, pa.Array]:
    return {new: anchors.columns[old].take(pa.array(at)) for old, new in names.items()}


def mine(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    A score is the inner product of two rows' components ``floor(256 * x)``, x as double.
    An anchor is a row that ``anchors`` chooses; its positives are the first ``positives``
    other rows of its label. For each of them come the first ``negatives`` rows of another
    label that score from ``low`` to ``high`` hundredths of the positive's score, numbered
    from 1; a window without any gives no row. First is higher in score, then smaller in
    key, null last.

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    Empty vectors do, and shorter ones end in zeros. Components beyond 62 bits are cut to
    that, and inner products wrap at 64 bits. Of several rows with one key, also when they
    are repeated in full, each counts, and mines if it is an anchor. Empty tables give no
    rows. Other columns are not looked at, whatever their names. Vectors may be as long as
    leaves room for ``GROUP`` of them in memory.
    """
    x = F.col(f"`{vector}`")
    bound = float(1 << 62)
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    whole = lambda v: F.floor(F.least(F.lit(bound), F.greatest(F.lit(-bound), v.cast("double") * 256)))
    rows = df.where(F.col(f"`{label}`").isNotNull() & x.isNotNull() & finite).select(
        F.col(f"`{key}`").alias("id"),
        F.col(f"`{label}`").alias("label"),
        F.transform(x, whole).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    rows = written(rows, "vectors")
    kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    count, width, asking = rows.agg(F.count("*"), F.max(F.size("vector")), F.count_if("asks")).first()
    width, groups, n_blocks = max(1, width or 0), max(1, math.ceil(count / GROUP)), max(1, math.ceil(asking / BLOCK))
    tiles = written(_packed(rows, TILE, width), "tiles")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = _Rows(pa.Table.from_batches([batch.slice(i, 1)]), width)
                at = np.flatnonzero(held.numbers("asks"))
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * width), pa.array(held.components[at].ravel()))
                tile = pa.array(np.full(len(at), batch.column("tile")[i].as_py(), np.int64))
                both = [held.columns[c].take(pa.array(at)) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([tile, pa.array(at), *both, vectors], ["of_tile", "of_row", "id", "label", "vector"])

    asked = written(tiles.mapInArrow(ask, f"of_tile long, of_row long, id {kind}, label {label_kind}, vector array<long>"), "anchors")
    candidates = tiles.withColumn("row", F.transform("id", lambda _, i: i.cast("long"))).drop("asks")
    candidates = candidates.withColumn("from_tile", F.transform("id", lambda _: F.col("tile")))

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            a, c = _Rows(left, width), _Rows(right, width, by_id=True)
            mine, theirs = _labels(a, c)
            for code in np.intersect1d(mine, theirs):
                rows_a, rows_c = np.flatnonzero(mine == code), np.flatnonzero(theirs == code)
                for part in _slices(len(rows_a), len(rows_c)):
                    ra = rows_a[part]
                    scores = multiply(a.components[ra], c.components[rows_c].T)
                    same = (a.numbers("of_tile")[ra, None] == c.numbers("from_tile")[rows_c]) & (a.numbers("of_row")[ra, None] == c.numbers("row")[rows_c])
                    for r, col in _best(scores, ~same, positives):
                        head = _taken(a, {"of_tile": "of_tile", "of_row": "of_row"}, ra[r])
                        found.append(pa.table({**head, "positive_id": c.columns["id"].take(pa.array(rows_c[col])), "positive_score": scores[r, col]}))
        return pa.concat_tables(found) if found else near.empty_table()

    near = pa.schema([("of_tile", pa.int64()), ("of_row", pa.int64()), ("positive_id", to_arrow_type(rows.schema["id"].dataType)), ("positive_score", pa.int64())])
    blocks = _packed(asked.repartition(n_blocks), BLOCK, width)
    lists = _met(blocks, candidates, n_blocks, groups, nearest, f"of_tile long, of_row long, positive_id {kind}, positive_score long")
    order = Window.partitionBy("of_tile", "of_row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    lists = lists.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= positives)
    wanted = lists.groupBy("of_tile", "of_row").agg(F.array_sort(F.collect_list(F.struct("slot", "positive_id", "positive_score"))).alias("positives"))
    windows = written(asked.join(wanted, ["of_tile", "of_row"]), "windows")

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            a, c = _Rows(left, width), _Rows(right, width, by_id=True)
            mine, theirs = _labels(a, c)
            held = a.columns["positives"]
            first, flat = held.offsets.to_numpy(), held.values
            score = flat.field("positive_score").to_numpy()
            for part in _slices(len(mine), len(theirs)):
                at = np.arange(len(mine))[part]
                scores = multiply(a.components[at], c.components.T)
                other = mine[at, None] != theirs
                for slot in range(positives):
                    some = np.flatnonzero(first[at] + slot < first[at + 1])
                    if not len(some):
                        break
                    positive = first[at[some]] + slot
                    hundreds, rest = np.divmod(score[positive], 100)
                    least, most = low * hundreds - (-low * rest) // 100, high * hundreds + high * rest // 100
                    fits = other[some] & (scores[some] >= least[:, None]) & (scores[some] <= most[:, None])
                    for r, col in _best(scores[some], fits, negatives):
                        head = _taken(a, {"of_tile": "of_tile", "of_row": "of_row", "id": "anchor_id"}, at[some][r])
                        which = flat.take(pa.array(positive[r]))
                        body = {name: which.field(name) for name in ("slot", "positive_id", "positive_score")}
                        found.append(pa.table({**head, **body, "negative_id": c.columns["id"].take(pa.array(col)), "negative_score": scores[some][r, col]}))
        return pa.concat_tables(found) if found else hardest.empty_table()

    id_type = to_arrow_type(rows.schema["id"].dataType)
    hardest = pa.schema([("of_tile", pa.int64()), ("of_row", pa.int64()), ("anchor_id", id_type), ("slot", pa.int32()), ("positive_id", id_type), ("positive_score", pa.int64()), ("negative_id", id_type), ("negative_score", pa.int64())])
    blocks = _packed(windows.repartition(n_blocks), BLOCK, width)
    schema = f"of_tile long, of_row long, anchor_id {kind}, slot int, positive_id {kind}, positive_score long, negative_id {kind}, negative_score long"
    pairs = _met(blocks, candidates, n_blocks, groups, hard, schema)
    order = Window.partitionBy("of_tile", "of_row", "slot").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    pairs = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
