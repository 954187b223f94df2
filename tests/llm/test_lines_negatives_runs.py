"""Line deduplication, hard negatives and periodic runs against plain versions."""

import collections
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from brute import LONG
from layerstats.llm import hard_negatives, line_dedup, periodic_runs
from layerstats.llm.queries import QUERIES, planted_periods


# -- lines


def some_lines(rng, n):
    pool = [f"common line number {i}" for i in range(5)] + ["short", "Ünïcödé", "ünïcödé zeile", "  common LINE number 1\t", "\r", "", "123456789", "1234567890"]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool) if rng.random() < 0.4 else f"own line {rng.integers(1 << 40)}" for _ in range(rng.integers(0, 12))]
        rows.append((int(i), "\n".join(lines)))
    return rows


def check_lines(spark, rows, **options):
    docs = spark.createDataFrame([(*r, i, f"k{i}") for i, r in enumerate(rows)], "doc_id long, text string, n_lines long, key string").repartition(5)
    out = line_dedup.remove_lines(docs, **options)
    assert out.columns == ["doc_id", "text", "key", "n_lines", "n_dropped", "kept"]
    got = {r.key: (r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept) for r in out.collect()}
    want = {f"k{i}": (*row, *kept) for i, (row, kept) in enumerate(zip(rows, brute.lines_kept(rows), strict=True))}
    assert got == want


@pytest.mark.parametrize("broadcast", [True, False], ids=["broadcast", "joined"])
def test_lines(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    rows = some_lines(np.random.default_rng(1), 200)
    rows += [(None, None), (None, "common line number 2\nonly without an id"), (500, None), (501, ""), (502, LONG), (503, LONG + "\nx"), (503, "common line number 0"), (504, "a\n" * 5000 + "common line number 3")]
    rows += [(505, "a line of one document alone\n" * 3), (505, "a line of one document alone"), (506, "repeated in full\nrepeated in full")] * 2
    check_lines(spark, rows)


def test_lines_of_many_equal_rows(spark):
    check_lines(spark, [(7, "the very same line\nand another one\nshort")] * 3000 + [(i, "the very same line") for i in range(2000)])


def test_lines_in_more_than_one_segment(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BITS_PER_LINE", 3000)
    monkeypatch.setattr(line_dedup, "GATHERED", 100)
    check_lines(spark, some_lines(np.random.default_rng(2), 300))


def test_full_filters_only_cost_time(spark, monkeypatch):
    """With every bit set, all lines are suspects, and whole keys decide."""
    monkeypatch.setattr(line_dedup, "_held", lambda bits, hashes, segments: np.ones(len(hashes), bool))
    check_lines(spark, some_lines(np.random.default_rng(3), 100))


def test_twice_seen_misses_nothing(spark):
    rng = np.random.default_rng(4)
    rows = some_lines(rng, 300)
    texts = spark.createDataFrame([(t,) for _, t in rows], "text string").repartition(7)
    table = line_dedup.twice_seen(texts, 3).toArrow()
    bits = np.zeros(3 << (line_dedup.SEGMENT_BITS - 3), np.uint8)
    for s, words in zip(table["segment"].to_pylist(), table["bits"], strict=True):
        bits[s << (line_dedup.SEGMENT_BITS - 3) :][: 1 << (line_dedup.SEGMENT_BITS - 3)] = words.values.to_numpy().view(np.uint8)
    lines = line_dedup.Lines(pa.array([t for _, t in rows]), 10)
    held = line_dedup._held(bits, lines.hash, 3)
    owners = collections.defaultdict(set)
    for i, line in enumerate(lines.line):
        owners[lines.key(i)].add(int(lines.owner[line]))
    several = np.array([len(owners[lines.key(i)]) > 1 for i in range(len(held))])
    assert held[several].all() and several.any() and held[~several].mean() < 0.02


def test_no_lines(spark):
    assert line_dedup.remove_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# -- hard negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (65, 130, 67), (200, 33, 511), (0, 4, 4), (4, 0, 4)])
def test_strassen(shape):
    m, k, n = shape
    rng = np.random.default_rng(5)
    for most in (300, 1 << 40, 1 << 62):
        a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
        with np.errstate(over="ignore"):
            assert np.array_equal(hard_negatives.multiply(a, b), a @ b)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(c) for c in ("id", "tile", "vector", "score")})
    out = hard_negatives.mine(df.repartition(4), F.col("vec_id") % 50 == 0, **options)
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("tiny", [False, True], ids=["one block", "many blocks"])
def test_hard_negatives(spark, monkeypatch, tiny):
    if tiny:
        for name, size in (("TILE", 16), ("GROUP", 64), ("BLOCK", 2), ("CELLS", 100)):
            monkeypatch.setattr(hard_negatives, name, size)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(4, 20))
    rows = [(i, (centre[i % 3] + centre[3] + rng.normal(size=20) * 0.5).round(1).tolist(), i % 3) for i in range(400)]
    # Ties, nulls, numbers that are none, short and empty vectors, huge and negative scores.
    rows += [(1000 + i, rows[1][1], 2) for i in range(20)]
    rows += [(2000, None, 1), (2050, [None, 1.0], 1), (2100, [float("nan")] * 20, 1), (2150, [float("inf")] * 20, 0), (2200, [1.0, 2.0], 0)]
    rows += [(2250, [], 1), (2300, [1e9] * 20, None), (None, rows[5][1], 0), (None, rows[4][1], 1), (2350, [-3.0] * 20, 0), (2400, [2e4] * 20, 7)]
    want = sorted(brute.negatives(rows, lambda i: i is not None and i % 50 == 0), key=repr)
    assert len(want) > 50 and mined(spark, rows) == want


def test_hard_negatives_of_repeated_rows(spark):
    rows = [(i, [1.0, i / 64], i % 2) for i in range(30)] + [(50, [1.0, 0.5], 1)] * 3 + [(3, [1.0, 0.25], 0)] * 4
    assert mined(spark, rows) == sorted(brute.negatives(rows, lambda i: i % 50 == 0), key=repr)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []


def test_hard_negatives_with_labels_of_text(spark):
    rows = [(i, [1.0, i / 7], "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = hard_negatives.mine(df, F.col("vec_id") == 0).collect()
    want = brute.negatives([(i, np.float32(v).astype(float).tolist(), y) for i, v, y in rows], lambda i: i == 0)
    assert sorted(map(tuple, got)) == sorted(want)


# -- periodic runs


def check_runs(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, runs string, words string").repartition(3)
    out = periodic_runs.collapse(df)
    assert out.columns == ["doc_id", "text", "words", "runs", "n_words", "collapsed"]
    for r in out.collect():
        words = [w for w in brute.GAP.split(texts[r.doc_id] or "") if w]
        want = brute.periodic(words)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(words) and r.text == texts[r.doc_id]
        assert r.collapsed == brute.collapsed(words, want)


def test_runs(spark):
    rng = np.random.default_rng(7)
    texts = [None, "", " \n", "a", "a " * 5, "a " * 6, "A a A a A a A a", "x " + "a b c " * 4 + "a b", "a b " * 4 + "a\tb\n c", "ü é " * 9 + "end"]
    for letters in (1, 2, 3, 5, 40):
        for _ in range(60):
            texts.append(" ".join(f"w{i}" for i in rng.integers(0, letters, rng.integers(0, 90))))
    for _ in range(60):
        # Nested and overlapping periods.
        period = list(rng.integers(0, 3, rng.integers(1, 9)))
        texts.append(" ".join(map(str, [*rng.integers(0, 3, 5), *(period * 9)[: rng.integers(1, 60)], *(period[:2] * 12), *(period * 5), *rng.integers(0, 3, 4)])))
    check_runs(spark, texts)


def test_runs_of_long_texts(spark):
    rng = np.random.default_rng(8)
    long = [str(x) for x in rng.integers(0, 2, 150)]
    check_runs(spark, [LONG.split(" ", 900)[-1][:3000], " ".join(long * 5 + ["0"] * 40 + long[:77] * 6), "same " * 900])
    big = spark.createDataFrame([(0, "same " * 200_000), (1, "a b c d e f g " * 30_000), (2, LONG)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.collapse(big).collect()}
    assert [tuple(x) for x in got[0].runs] == [(0, 200_000, 1)] and got[0].collapsed == "same"
    assert [tuple(x) for x in got[1].runs] == [(0, 210_000, 7)] and got[1].collapsed == "a b c d e f g"
    # i * i % 9973 has that period, and 40,000 words hold it four times.
    assert [tuple(x) for x in got[2].runs] == [(0, 40_000, 9973)] and got[2].collapsed == " ".join(LONG.split(" ")[:9973])


def test_runs_of_nothing(spark):
    assert periodic_runs.collapse(spark.createDataFrame([], "text string")).collect() == []


def test_periodic_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op13_periodic"](spark, sf_dir).collect()}
    read = {r.doc_id: r.text for r in planted_periods(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert len(got) == len(documents)
    found = 0
    for doc_id, text, _ in documents:
        words = [w for w in brute.GAP.split(text or "") if w]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert [w for w in brute.GAP.split(read[doc_id] or "") if w] == words
        if n > 3000:
            continue
        runs, r = brute.periodic(words), got[doc_id]
        found += len(runs)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute.collapsed(words, runs).encode()).hexdigest()
    assert found > 5
