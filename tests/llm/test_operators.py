"""Operators against plain versions, and on odd and empty input."""

import collections
import hashlib
import math
import re
import sys
import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from brute import LONG, PASSAGE
from layerstats.llm import bpe, chat, contamination, jaccard_join, language, pitman_yor, seating, store, suffix_dedup, topk, toxicity, url_filter
from layerstats.llm.components import components

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def plain(df):
    """Rows of key and text with what else is asked for, in one order."""
    return sorted(map(tuple, df.collect()), key=repr)


# -- toxicity


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def test_toxic_sentences_are_located(spark):
    rng = np.random.default_rng(5)
    clean = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(clean, 8)) for _ in range(4)]
        if i % 4 == 0:
            sentences[1] = "you awfulword " + sentences[1]
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trained = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for r in toxicity.score(docs, trained).collect():
        assert (r.score >= 0.5) == (r.doc_id % 4 == 0)
        assert [("awfulword" in r.text[s.start : s.end]) for s in r.offending] == [True] * (r.doc_id % 4 == 0)


def test_long_clean_documents_are_learned_from(spark):
    rng = np.random.default_rng(6)
    clean = [f"w{i}" for i in range(300)]
    said = lambda n: ". ".join(" ".join(rng.choice(clean, 8)) for _ in range(n)) + "."
    rows = [(i, ("you awfulword. " if i % 4 == 0 else "") + said(4), int(i % 4 == 0)) for i in range(400)]
    # One toxic text has no telling word, so that the odds of neutral sentences are not near 0.
    rows += [(400, said(4), 1)] + [(500 + i, said(4000), 0) for i in range(5)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    trained = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    new = spark.createDataFrame([(0, said(4000)), (1, said(4) + " you awfulword.")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(new, trained).collect()}
    assert scores[0] < 0.5 <= scores[1]


def test_a_key_of_many_rows_teaches_once(spark):
    rng = np.random.default_rng(9)
    said = lambda: ". ".join(" ".join(rng.choice([f"w{i}" for i in range(300)], 8)) for _ in range(4)) + "."
    rows = [(i, ("you awfulword. " if i % 4 == 0 else "") + said()) for i in range(400)]
    rows += [(1001, "you awfulword. " + said())] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trained = toxicity.fit(docs, spark.createDataFrame([(r, int(r % 4 == 0)) for r in [*range(400), 1001]], "doc_id long, toxic int"))
    new = spark.createDataFrame([(0, "you awfulword. " + said()), (1, said())], "doc_id long, text string")
    assert {r.doc_id: r.score >= 0.5 for r in toxicity.score(new, trained).collect()} == {0: True, 1: False}


def test_noisy_or():
    z = np.array([-2.0, 1.0, 0.5])
    p = 1 / (1 + np.exp(-z))
    assert toxicity.noisy_or(z, np.array([0, 2])) == pytest.approx([1 - (1 - p[0]) * (1 - p[1]), p[2]])


def test_toxicity_of_odd_input(spark, odd, model):
    out = toxicity.score(odd, model)
    assert set(out.columns) == set(odd.columns) | {"score", "offending"}
    rows = out.collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    bare = {r.score for r in rows if r.text is None or not r.text.strip()}
    assert len(bare) == 1 and bare.pop() < 0.5
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.score < 0.5 for r in toxicity.score(odd, toxicity.fit(odd, none)).collect())
    assert all(r.score < 0.5 for r in toxicity.score(odd, toxicity.fit(odd.limit(0), none)).collect())


# -- chat


def test_windows_keep_budget_and_learn_each_text_once(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, ("user", "assistant")[t % 2], f"t{t} " + "word " * (7 * t % 90)) for t in range(1, 200)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.windows(turns, budget=200, history=40)
    windows = out.orderBy("window").collect()
    assert len(windows) > 5 and all(w.n_tokens <= 200 for w in windows if not w.over_budget)
    assert all(w.formatted.startswith("### system: be kind </turn>\n") for w in windows)
    assert all(not w.over_budget or w.n_turns == 1 for w in windows)
    assert any(w.n_repeated > 1 for w in windows) and windows[0].n_repeated == 0
    read = chat.read_back(out).orderBy("window").collect()
    assert [(t.role, t.text) for w in read for t in w.turns][-199:] == [(r[2], r[3]) for r in rows[1:]]
    assert [x for w in read for x in w.learned] == [r[3] for r in rows if r[2] == "assistant"]


def test_chat_round_trip_of_odd_turns(spark):
    nasty = ["\\### Assistant: </turn> ok", "####", "\\", "\\b\\h\\t", " </turn>\n### user: x", "", None, "é😀:", "#" * 7 + "\\"]
    rows = [(c, t, r, nasty[(3 * t + i) % len(nasty)]) for i, c in enumerate([None, 1, 2]) for t, r in enumerate(["a: b", None, "assistant", "system", "assistant", "x\ny"])]
    rows += [(3, None, "user", "no turn"), (3, 1, "user", "one"), (3, 1, "user", "one"), (4, 0, "system", "alone"), (5, 0, "system", None), (5, 1, "assistant", "w " * 5000)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = collections.defaultdict(list)
    for w in sorted(chat.read_back(chat.windows(turns)).collect(), key=lambda w: w.window):
        got[w.conv_id] += [(t.role, t.text) for t in w.turns]
    want = collections.defaultdict(list)
    for c, _, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want[c].append((r or "", x or ""))
    assert got == want
    assert chat.windows(turns.limit(0)).count() == 0


@pytest.mark.parametrize("case", ["equal", "mixed", "long"])
def test_windows_are_as_full_as_one_after_the_other(spark, case):
    """The windows that a walk through the turns would make, in conversations of very many turns too."""
    rng = np.random.default_rng(11)
    lengths = {"equal": [8] * 2000, "mixed": rng.integers(0, 120, 700), "long": rng.choice([3, 50, 1500], 300)}[case]
    rows = [(1, 0, "system", "be kind")] + [(1, t, ("user", "assistant")[t % 2], " ".join(["word"] * int(n))) for t, n in enumerate(lengths, 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    budget, history = 1024, 128
    got = chat.windows(turns, budget, history).orderBy("window").collect()
    # Three hashes are one sign each, as are the colon, both slants of the closing mark and its two angles; then one more a turn.
    cost = lambda r: 1 + len(re.findall(r"\w+|[^\s\w]", f"### {r[2]}: {r[3]} </turn>"))
    room, want, used = budget - history - cost(rows[0]), [0], 0
    for r in rows[1:]:
        if want[-1] and used + cost(r) > room:
            want.append(0)
            used = 0
        want[-1] += 1
        used += cost(r)
    assert [w.n_turns for w in got] == [want[0] + 1, *want[1:]]
    # The first window counts the system turn as one of its own.
    assert all(w.n_tokens <= budget or (w.over_budget and w.n_turns == (2 if w is got[0] else 1)) for w in got)
    if case == "equal":
        assert np.mean([w.n_tokens for w in got]) > 0.9 * budget


# -- language model


def test_model_base_score_and_probabilities(spark, documents):
    docs = spark.createDataFrame([d[:2] for d in documents], "doc_id long, text string")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2
    out = {r.doc_id: r for r in pitman_yor.score(docs, learn).collect()}
    tokens = {i: [*brute.words(t), None] for i, t, _ in documents}
    count = collections.Counter(w for i, ws in tokens.items() if brute.remainder(i, 7) != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = out[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
        assert r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def seated(keys, counts, sweeps=3):
    """A bucket of all runs and the top above it, after some sweeps."""
    tree = pitman_yor.Subtree(keys, counts)
    top = pitman_yor.Top(tree.top, tree.top_customers)
    for step in range(sweeps):
        p, above = pitman_yor._within(top.told(), tree.top)
        tree.sweep(p, above, np.random.default_rng(step))
        top.sweep(tree.top_customers)
    return tree, top


def test_predictions_sum_to_one():
    """After any context, all 256 symbols together have probability one, at every level."""
    rng = np.random.default_rng(3)
    text = pa.array([" ".join(rng.choice(["ab", "abc", "b", "cab"], 400))])
    keys, counts = pitman_yor._distinct_runs(text, np.ones(1, np.int64))
    context = keys[len(keys) // 2] >> np.uint64(8)
    every = (context << np.uint64(8)) + np.arange(256, dtype=np.uint64)
    keys, counts = pitman_yor._distinct([(keys, counts), (every, np.zeros(256, np.int64))])
    tree, top = seated(keys, counts)
    p = tree.predict(top.told()["p"])
    assert p[np.searchsorted(keys, every)].sum() == pytest.approx(1)
    again = pitman_yor.Subtree(keys, counts)
    again.restore(tree.seating())
    assert np.array_equal(again.predict(top.told()["p"]), p)


def test_predictions_against_a_plain_version():
    """The same seating, in dictionaries by context."""
    rng = np.random.default_rng(4)
    text = pa.array([" ".join(rng.choice(["ab", "abc", "b", "cab", "é"], 300))])
    keys, counts = pitman_yor._distinct_runs(text, np.ones(1, np.int64))
    tree, top = seated(keys, counts)
    held = collections.defaultdict(dict)
    for length, level in zip(range(pitman_yor.DEPTH, -1, -1), [*tree.levels, *top.tree.levels], strict=True):
        for key, c, t in zip(level.keys.tolist(), level.customers, level.tables, strict=True):
            held[length, key >> 8][key & 0xFF] = int(c), int(t)

    def p(length, context, symbol):
        if length < 0:
            return 1 / 256
        d, room = pitman_yor.DISCOUNTS[length], held[length, context]
        c, t = room.get(symbol, (0, 0))
        above = p(length - 1, context & ((1 << 8 * max(0, length - 1)) - 1), symbol)
        tables = sum(x[1] for x in room.values())
        return (max(0, c - d * t) + (seating.STRENGTH + d * tables) * above) / (seating.STRENGTH + sum(x[0] for x in room.values()))

    got = tree.predict(top.told()["p"])
    assert [p(pitman_yor.DEPTH, k >> 8, k & 0xFF) for k in keys.tolist()] == pytest.approx(got.tolist())
    for level in [*tree.levels, *top.tree.levels]:
        assert (level.tables <= level.customers).all() and ((level.tables > 0) == (level.customers > 0)).all()


def exact_tables(c, p, others, d):
    """Chance of each number of tables from 1 on, by all ways to sit."""
    ways = np.append(0.0, np.full(c, -np.inf))
    with np.errstate(divide="ignore"):
        for n in range(c):
            ways = np.logaddexp(np.append(-np.inf, ways[:-1]), ways + np.log(np.maximum(0, n - d * np.arange(c + 1))))
    chance = np.array([ways[t] + sum(np.log(p * (seating.STRENGTH + d * (others + i))) for i in range(1, t)) for t in range(1, c + 1)])
    chance = np.exp(chance - chance.max())
    return chance / chance.sum()


@pytest.mark.parametrize("c, p, others, d", [
    (10, 1.0, 0, 0.75), (10, 0.01, 20, 0.75), (15, 0.1, 50, 0.8), (30, 0.01, 100, 0.8), (50, 0.02, 30, 0.6),
    (64, 0.5, 3, 0.2), (65, 0.5, 3, 0.2), (150, 0.02, 30, 0.6), (150, 0.3, 5000, 0.8), (150, 0.0001, 10, 0.5), (400, 0.2, 300, 0.75),
])
def test_tables_follow_the_exact_posterior(c, p, others, d):
    n, much = 20_000, 1e8
    chance = exact_tables(c, p, others, d)
    drawn = seating.draw(d, np.full(n, c), np.full(n, others), np.full(n, p * much), np.full(n, much), np.random.default_rng(1))
    t = np.arange(1, c + 1)
    assert drawn.min() >= 1 and drawn.max() <= c
    assert drawn.mean() == pytest.approx((chance * t).sum(), rel=0.03)
    assert np.abs(np.bincount(drawn, minlength=c + 1)[1:].cumsum() / n - chance.cumsum()).max() < 0.05


def test_sweeps_follow_the_exact_posterior_of_a_restaurant():
    """Two dishes whose numbers of tables depend on each other; the parent's probabilities are fixed."""

    class Fixed(pitman_yor.Uniform):
        def odds(self, dish, tables):
            return np.array([0.3, 0.05])[dish] * 1e8, np.full(len(dish), 1e8)

    c, d = (8, 6), pitman_yor.DISCOUNTS[3]
    ways = [seating.log_stirling(d, n, n)[n] for n in c]
    weight = np.array([
        [np.exp(ways[0][x] + ways[1][y] + x * np.log(0.3) + y * np.log(0.05) + sum(np.log(seating.STRENGTH + d * i) for i in range(x + y))) for y in range(1, c[1] + 1)]
        for x in range(1, c[0] + 1)
    ])
    weight /= weight.sum()
    want = (weight.sum(1) @ np.arange(1, 9), weight.sum(0) @ np.arange(1, 7))
    level, rng = pitman_yor.Level(np.array([0x61626330, 0x61626331], np.uint64), 3), np.random.default_rng(2)
    level.open(np.array(c))
    seen = []
    for _ in range(8000):
        level.sweep(np.array(c), Fixed(), rng)
        seen.append(level.tables.copy())
    assert np.mean(seen, 0) == pytest.approx(want, rel=0.03)


def test_six_bytes_are_remembered():
    """What follows five equal bytes is told by the sixth; two sweeps go before the three seatings that count."""
    text = pa.array([" ".join(["xabcdeq", "yabcdez"] * 200)])
    keys, counts = pitman_yor._distinct_runs(text, np.ones(1, np.int64))
    tree, top = seated(keys, counts)
    p = tree.predict(top.told()["p"])
    ends = {int(k).to_bytes(8, "big")[-7:]: x for k, x in zip(keys, p, strict=True)}
    assert [k for k in ends if k[-3:-1] == b"de"] and all(x > 0.9 for k, x in ends.items() if k[-3:-1] == b"de")
    assert (pitman_yor.DEPTH, pitman_yor.BURN_IN, pitman_yor.SAMPLES) == (6, 2, 3)


def test_scores_do_not_depend_on_buckets(spark, documents, monkeypatch):
    """Counts and probabilities of one bucket and of many, up to what chance does."""
    docs = spark.createDataFrame([d[:2] for d in documents[:60]], "doc_id long, text string")
    learn = F.col("doc_id") % 7 != 2
    one = {r.doc_id: r for r in pitman_yor.score(docs, learn).collect()}
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 1 << 13)
    monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 1 << 14)
    monkeypatch.setattr(pitman_yor, "LOT", 3)
    for r in pitman_yor.score(docs, learn).collect():
        assert (r.n_tokens, r.n_known, r.base_score) == (one[r.doc_id].n_tokens, one[r.doc_id].n_known, pytest.approx(one[r.doc_id].base_score))
        assert abs(r.score - one[r.doc_id].score) < 0.6 - 0.03 * r.score


def test_symbols():
    out, first, end = pitman_yor.symbols(pa.array(["A b", None, "  c  ", "", "é"]))
    texts = [bytes(out[f : e + 1]).decode() for f, e in zip(first, end, strict=True)]
    assert texts == ["a b \n", "\n", "c \n", "\n", "é \n"]
    assert all((out[f - pitman_yor.DEPTH : f] == 10).all() for f in first)
    keys = pitman_yor.runs(out, pitman_yor.DEPTH, len(out))
    for at, key in enumerate(keys.tolist(), pitman_yor.DEPTH):
        assert key.to_bytes(8, "big")[-pitman_yor.DEPTH - 1 :] == bytes(out[at - pitman_yor.DEPTH : at + 1])


def test_model_on_odd_input(spark, odd):
    rows = pitman_yor.score(odd, F.col("doc_id") % 2 == 0).collect()
    assert len(rows) == odd.count() and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    nothing = pitman_yor.score(odd, F.lit(None).cast("boolean")).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in nothing)
    assert next(r.score for r in nothing if r.doc_id == 2) == pytest.approx(-math.log10(256), abs=1e-5)
    assert pitman_yor.score(odd.limit(0), F.lit(True)).count() == 0


# -- suffixes


@pytest.mark.parametrize("crowded", [suffix_dedup.CROWDED, 2])
def test_repeats_are_cut_out(spark, documents, crowded):
    docs = spark.createDataFrame([d[:2] for d in documents], "doc_id long, text string").repartition(7)
    want = dict(zip([d[0] for d in documents], brute.cut([d[1] for d in documents]), strict=True))
    for r in suffix_dedup.remove_repeats(docs, crowded=crowded).collect():
        assert (bytes(r.kept), sum(s.end - s.start for s in r.removed), len(r.removed)) == want[r.doc_id]


def test_repeats_of_odd_texts(spark, odd):
    rng = np.random.default_rng(2)
    rows = [(i, "".join(rng.choice(list("ab"), 900))) for i in range(4)]
    rows += [(4, "ab" * 300), (5, "é" * 150), (6, "x" + "é" * 150), (7, rows[0][1][100:299]), (8, rows[0][1][100:300]), (8, rows[0][1][100:300])]
    table = odd.select("doc_id", "text").collect() + rows
    docs = spark.createDataFrame([tuple(r) for r in table], "doc_id long, text string")
    want = sorted((i is None, i or 0, b, n, k) for (i, _), (b, n, k) in zip(table, brute.cut([t for _, t in table]), strict=True))
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.kept), sum(s.end - s.start for s in r.removed), len(r.removed)) for r in got) == want
    for r in suffix_dedup.remove_repeats(docs, characters=True).collect():
        bytes(r.kept).decode()
    wide = suffix_dedup.remove_repeats(odd)
    assert set(wide.columns) == set(odd.columns) and wide.count() == odd.count()
    assert suffix_dedup.remove_repeats(odd.limit(0)).count() == 0


@pytest.mark.parametrize("keys", ["own", "equal", "null"])
def test_repeats_of_very_many_equal_rows(spark, keys):
    """Equal rows cost as much as their number, not its square."""
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 1 << 40, 200))
    other = "before " + text[500:900] + " after"
    key = {"own": F.col("id"), "equal": F.lit(7), "null": F.lit(None)}[keys].cast("long")
    docs = spark.range(0, 5000, 1, 16).select(key.alias("doc_id"), F.lit(text).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(-1, other), (-2, "short")], docs.schema))
    got = suffix_dedup.remove_repeats(docs)
    rows = got.groupBy("kept", "removed").agg(F.count("*").alias("n")).collect()
    found = sorted((bytes(r.kept), [tuple(x) for x in r.removed], r.n) for r in rows)
    assert found == sorted([(b"", [(0, len(text))], 5000), (b"before  after", [(7, 407)], 1), (b"short", [], 1)])


def test_blocks_of_hashing_do_not_matter(monkeypatch):
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abc "), 5000))
    whole = suffix_dedup.segments(*suffix_dedup.buffers(pa.array([text, text[:700]])), 200, 48)
    starts = {(t, s + k) for t, s, n in zip(whole["text"], whole["start"], whole["windows"], strict=True) for k in range(n)}
    assert starts == {(0, p) for p in range(4801)} | {(1, p) for p in range(501)}


def test_multikey_sort():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    data[1000:1100], data[3000:3100] = data[100:200], data[100:200]
    at, group = rng.permutation(3900), rng.integers(0, 2, 3900)
    seen = collections.Counter((g, data[a : a + 24].tobytes()) for a, g in zip(at, group, strict=True))
    want = [seen[g, data[a : a + 24].tobytes()] > 1 for a, g in zip(at, group, strict=True)]
    assert suffix_dedup.tied(np.append(data, np.zeros(8, np.uint8)), at, group, 24).tolist() == want


# -- Jaccard join


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.99), (0.9, 0.95)):
        bands, rows = jaccard_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall


@pytest.mark.parametrize("block", [None, 3])
def test_links_against_all_pairs(spark, documents, odd, block, monkeypatch):
    if block:
        monkeypatch.setattr(jaccard_join, "BAND_BLOCK", block)
        monkeypatch.setattr(jaccard_join, "SET_BLOCK", 600)
    rows = [d[:2] for d in documents] + [(i and i + 10**6, t) for i, t in map(tuple, odd.select("doc_id", "text").collect())]
    base = [f"n{i}" for i in range(80)]
    rows += [(2 * 10**6 + i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = brute.links(rows)
    degree = collections.Counter(x for p in pairs for x in p)
    root = brute.groups(len(rows), pairs)
    least = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    want = sorted(((rows[i][0], least.get(root[i]), degree[i]) for i in range(len(rows))), key=repr)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join(docs).collect()), key=repr) == want


def test_many_near_copies_take_no_list_of_pairs():
    n = 4000
    group = pd.DataFrame(
        {
            "cid": [i.to_bytes(16) for i in range(n)],
            "n_rows": 1,
            "size": 100,
            "core_size": 100,
            "lacks": 0,
            "differs": [np.array([i // 2 + 1 << 20, 7], np.uint64).tobytes() for i in range(n)],
            "side": 2,
        }
    )
    tracemalloc.start()
    try:
        found = jaccard_join._verified(0.8)(group)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (found["links"] == n - 1).all() and (found["root"] == group["cid"][0]).all()
    assert peak < 150e6


@pytest.mark.parametrize("cells", [1, 50, 1 << 20])
def test_links_of_a_component_by_rows(cells, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELLS", cells)
    rng = np.random.default_rng(cells)
    core = np.arange(1, 21, dtype=np.uint64)
    sets = [np.union1d(core[rng.random(20) < 0.9], rng.integers(100, 104, rng.integers(0, 4)).astype(np.uint64)) for _ in range(60)]
    differs = [np.concatenate([np.setdiff1d(s, core), np.setdiff1d(core, s) * jaccard_join.LACKS ^ jaccard_join.LACKS]) for s in sets]
    group = pd.DataFrame(
        {
            "cid": [i.to_bytes(16) for i in range(60)],
            "n_rows": rng.integers(1, 4, 60),
            "size": [len(s) for s in sets],
            "core_size": 20,
            "lacks": [len(np.setdiff1d(core, s)) for s in sets],
            "differs": [d.tobytes() for d in differs],
            "side": 2,
        }
    )
    close = [(i, j) for i in range(60) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) - 1e-9]
    links = np.zeros(60, int)
    for i, j in close:
        links[i] += group["n_rows"][j]
        links[j] += group["n_rows"][i]
    root = brute.groups(60, close)
    found = jaccard_join._verified(0.8)(group)
    assert found["links"].tolist() == links.tolist()
    assert [int.from_bytes(x) for x in found["root"]] == [root[i] for i in range(60)]


def test_small_tables_are_few_files(spark, documents, monkeypatch):
    files = {}

    def counted(df, name, *args):
        table = store.written(df, name, *args)
        files[name] = max(files.get(name, 0), len(table.inputFiles()))
        return table

    monkeypatch.setattr(jaccard_join, "written", counted)
    monkeypatch.setattr(sys.modules[components.__module__], "written", counted)
    rows = [d[:2] for d in documents] + [(10**6 + i, f"{t} and {i}") for i, (_, t, _) in enumerate(documents)]
    cores = spark.sparkContext.defaultParallelism
    held = {"spark.sql.shuffle.partitions": str(16 * cores), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.rdd.getNumPartitions() <= cores
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files["sets"] <= cores and files["edges"] <= cores
    assert files["differences"] <= 4 * cores and files["links"] <= 4 * cores


def test_one_of_each(spark, documents, odd):
    rows = [d[:2] for d in documents] + [(i and i + 10**6, t) for i, t in map(tuple, odd.select("doc_id", "text").collect())]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string")
    root = brute.groups(len(rows), brute.links(rows))
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    wordless = sum(not brute.words(t) for _, t in rows)
    assert kept.count() == len({r for r, (_, t) in zip(root, rows, strict=True) if brute.words(t)}) + wordless
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0 and jaccard_join.join(docs.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(6)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    root = brute.groups(1100, pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root[x] for p in pairs if p[0] != p[1] for x in p}


# -- URLs


@pytest.mark.parametrize("most_shapes", [url_filter.MOST_SHAPES, 1])
def test_rules(spark, monkeypatch, most_shapes):
    monkeypatch.setattr(url_filter, "MOST_SHAPES", most_shapes)
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("a.example.com", "/en/pri", "allow"), ("example.com", "/en/private/", "allow"), ("net", "", "block"), ("net", "", "allow"), ("B.org", "/x", "block")]
    urls = [
        "http://example.com/en/x", "http://a.example.com/en/private/y", "http://a.example.com/en/prix", "http://notexample.com/en/", "http://com/", "http://EXAMPLE.com", "https://x.net", "x.net", None, "", "http://", "ftp://b.org/xy?z#f",
        "http://b.org/y/x", "http://x.net?/a", "http://a.b.c.example.com/en/#/", "http://example.com/en?/en/", "http://é.com/ü/" + "p/" * 500, "http://x.net",
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    ready = spark.createDataFrame(rules, "host string, path string, verdict string")

    def judged(url):
        rest = (url or "").split("://", 1)
        rest = rest[1] if len(rest) == 2 else ""
        cut = min([len(rest)] + [rest.find(c) for c in "/?#" if c in rest])
        host, tail = brute.low(rest[:cut]), rest[cut:]
        path = tail[: min([len(tail)] + [tail.find(c) for c in "?#" if c in tail])]
        fits = [(-len(h + p), v != "block", h + p, v) for h, p, v in ((brute.low(h), p, v) for h, p, v in rules) if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = min(fits, default=(0, 0, None, "allow"))
        return host, path, best[2], best[3]

    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, ready).collect()}
    assert got == {i: judged(u) for i, u in enumerate(urls)}
    assert url_filter.judge(pages.limit(0), ready).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, ready.limit(0)).collect()} == {"allow"}


# -- search


@pytest.mark.parametrize("frequent", [256, 4])
def test_best_rows(spark, documents, odd, monkeypatch, frequent):
    monkeypatch.setattr(topk, "FREQUENT", frequent)
    monkeypatch.setattr(topk, "TOGETHER", 7)
    monkeypatch.setattr(topk, "POSTINGS", 50)
    monkeypatch.setattr(topk, "AHEAD", (3, 2))
    monkeypatch.setattr(topk, "SHARD_DOCS", 20)
    monkeypatch.setattr(topk, "QUERY_BLOCK_TERMS", 500)
    rows = [d[:2] for d in documents] + [(i and i + 10**6 + 3, t) for i, t in map(tuple, odd.select("doc_id", "text").collect())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.bm25(rows, [j for j, (i, _) in enumerate(rows) if i is not None and i % 20 == 0])
    got = collections.defaultdict(list)
    for r in sorted(topk.search(docs, F.col("doc_id") % 20 == 0).collect(), key=lambda r: r["rank"]):
        got[r.query_id].append(r)
    assert {rows[j][0] for j in want if want[j]} == set(got)
    for j, best in want.items():
        found = got[rows[j][0]]
        assert [r.doc_id for r in found] == [i for _, i in best]
        assert [r.score for r in found] == pytest.approx([-s for s, _ in best])
    assert topk.search(docs.limit(0), F.lit(True)).count() == 0


def test_few_rows_are_scored_exactly(monkeypatch):
    """A query without a k-th score looks through whole blocks, but scores exactly only what can be among its first."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{w}" for w in rng.zipf(1.3, rng.integers(20, 60)) % 3000)) for i in range(2000)]
    texts = pa.array([t for _, t in rows])
    table = pa.table({"group": pa.array([0] * len(rows), pa.int32()), "key": pa.array([i for i, _ in rows]), "text": texts})
    row = topk._indexed(table).to_pylist()[0]
    doc, term, count = topk.terms(texts)
    distinct, place, df = np.unique(term, return_inverse=True, return_counts=True)
    weight = count * np.log1p((len(rows) - df[place] + 0.5) / (df[place] + 0.5))
    n, k = 40, 10
    bounds = np.searchsorted(doc, np.arange(n + 1))
    queries = topk.Queries(bounds, term[: bounds[-1]], weight[: bounds[-1]])
    scored, raised = [], topk.raise_best
    monkeypatch.setattr(topk, "raise_best", lambda best, owner, score, k: (scored.append(len(owner)), raised(best, owner, score, k)))
    ids = pa.array(row["ids"])
    found = topk.Shard(row, row["length"] / len(rows), ids).search(queries, k, np.zeros((n, k)))
    query, place, score = (np.concatenate(x) for x in zip(*found, strict=True))
    assert scored[0] <= 2 * k * n
    want = brute.bm25(rows, range(n))
    for j in range(n):
        mine = np.flatnonzero(query == j)
        best = sorted(zip(-score[mine].round(4), ids.take(pa.array(place[mine])).to_pylist(), strict=True))[:k]
        assert [i for _, i in best] == [i for _, i in want[j]]
        assert [s for s, _ in best] == pytest.approx([s for s, _ in want[j]], abs=1e-4)


def test_most_frequent_term():
    def term(word):
        return topk.terms(pa.array([word]))[1][0]

    words = topk.terms(pa.array(["b a b", "", "c", None, "d e"]))
    assert topk._most_frequent(*words, 5).tolist() == [term("b"), 0, term("c"), 0, max(term("d"), term("e"))]
    assert topk._most_frequent(*topk.terms(pa.array(["", None])), 2).tolist() == [0, 0]


# -- language


def test_language(spark, documents, odd):
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    dictionaries = language.fit(docs, learn=~held_out)
    assert set(dictionaries) == {d[2] for d in documents} and all(len(d) <= 1 << 16 for d in dictionaries.values())
    found = language.classify(docs.where(held_out), dictionaries).collect()
    long_enough = [r for r in found if len(r.text) > 80]
    assert sum(r.lang == r.lang_pred for r in long_enough) >= 0.95 * len(long_enough)
    rows = language.classify(odd, dictionaries).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(r.lang_pred in dictionaries for r in rows if r.doc_id in (4, 5, 9))
    assert language.fit(docs.limit(0)) == {} and language.classify(odd.limit(0), dictionaries).count() == 0
    assert {r.lang_pred for r in language.classify(odd, {}).collect()} == {"und"}


def test_copies_and_long_texts_leave_room_in_dictionaries(spark):
    rng = np.random.default_rng(7)
    said = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))
    copied = said(1000)
    rows = [(copied, "aa")] * 3000 + [(said(200), "aa") for _ in range(300)]
    rows += [(said(3000), "bb") for _ in range(12)] + [("1234567 " * 1000 + said(2), "cc") for _ in range(20)]
    dictionaries = language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(4))
    assert set(dictionaries) == {"aa", "bb", "cc"}
    assert len(dictionaries["aa"]) == len(dictionaries["bb"]) == 1 << 16
    assert dictionaries["aa"].count(copied[:100].encode()) <= 1
    assert len(dictionaries["cc"]) == 20 * len(" abcdef abcdef ")


# -- benchmark


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000])
def test_items_are_found(spark, documents, sf_dir, odd, block_bytes):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, PASSAGE), (901, "one two"), (905, "Z7"), (906, "z8 z9\tz10 Z11"), (907, "z8 z10"), (902, None), (903, ""), (904, PASSAGE.replace("passage30", "other"))]
    docs = [d[:2] for d in documents]
    docs += [(10**6, " ".join(f"z{i}" for i in range(9000)) + " " + PASSAGE + " " + LONG), (10**6 + 1, "One two"), (10**6 + 2, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.containment for r in contamination.search(frame, benchmark, block_bytes=block_bytes).collect()}
    assert got == brute.contained(docs, items) and {(10**6, i) for i in (900, 904, 905, 906)} <= set(got) and (10**6, 907) not in got
    marked = contamination.mark(odd, benchmark, block_bytes=block_bytes)
    assert set(marked.columns) == set(odd.columns) and marked.count() == odd.count()
    assert contamination.search(frame.limit(0), benchmark).count() == 0
    assert contamination.search(frame, benchmark.limit(0)).count() == 0


# -- byte pairs


def test_tokens_equal_the_library(spark, documents, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    texts = [d[1] for d in documents] + [r.text for r in odd.select("text").collect()]
    texts += ["<|endoftext|> Hi <|startoftext|>don't", "ΣΑΣ İstanbul ẞ aaa aaaa aaaaa 123½", "\x1c\x1fa\x85b​c　d é", "we'RE 'S x's <|EndOfText|> <|", "a\x00b"]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(odd.limit(0), VOCABULARY).count() == 0


def test_memory_of_words_changes_nothing(monkeypatch):
    texts = pa.array([f"word{i} and word{i // 2}" for i in range(50)])
    whole = bpe.WordBpe(VOCABULARY).encode(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    small = bpe.WordBpe(VOCABULARY)
    assert pa.concat_arrays([small.encode(texts.slice(i, 5)) for i in range(0, 50, 5)]).to_pylist() == whole.to_pylist()
