"""Registered queries against their SQL, their contracts, and the pipeline against plain versions."""

import hashlib
import os
import zlib

import duckdb
import pytest

import brute
import corpus_pipeline
from layerstats.llm.oracles import ORACLES
from layerstats.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {file.split('.')[0]} as select * from '{sf_dir}/{file}'")
    return con


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("name, columns", [
    ("op1_toxicity", "doc_id bigint, held_out boolean, score double, predicted int"),
    ("op3_pitman_yor", "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"),
    ("op4_suffix_dedup", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"),
    ("op8_language", "doc_id bigint, held_out boolean, lang_pred string, score double"),
    ("op10_bpe", "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"),
])
def test_contract(spark, sf_dir, documents, name, columns):
    out = QUERIES[name](spark, sf_dir)
    kinds = dict(out.dtypes)
    for column in columns.split(", "):
        assert kinds[column.split()[0]] == column.split()[1]
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(d[0] for d in documents)
    by = {"op1_toxicity": (5, 0), "op8_language": (5, 0), "op3_pitman_yor": (7, 2)}.get(name)
    if by:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % by[0] == by[1]) for r in rows)
    if name == "op4_suffix_dedup":
        want = dict(zip([d[0] for d in documents], brute.cut([d[1] for d in documents]), strict=True))
        for r in rows:
            kept, removed, spans = want[r.doc_id]
            assert (r.n_bytes, r.n_removed, r.n_spans) == (len(kept) + removed, removed, spans)
            assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, sf_dir).cache()
    assert clean.columns == columns and 0.8 * len(before) < clean.count() < len(before)

    single = stages["near duplicates"](spark, clean, sf_dir).cache()
    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    root = brute.groups(len(rows), brute.links(rows))
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == [rows[i][0] for i in range(len(rows)) if root[i] == i]

    shorter = stages["repeated passages"](spark, single, sf_dir).cache()
    rows = sorted((r.doc_id, r.text) for r in single.collect())
    cut = dict(zip([i for i, _ in rows], brute.cut([t for _, t in rows]), strict=True))
    assert shorter.columns == columns and shorter.count() == len(rows)
    want = brute.cut_characters([t for _, t in rows])
    want = dict(zip([i for i, _ in rows], want, strict=True))
    for r in shorter.collect():
        assert r.text == want[r.doc_id] and r.n_chars == len(r.text)
    assert any(c[1] for c in cut.values())

    fresh = stages["decontamination"](spark, shorter, sf_dir).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {d for d, _ in brute.contained([(r.doc_id, r.text) for r in shorter.collect()], items)}
    assert fresh.columns == columns
    assert {r.doc_id for r in fresh.collect()} == {r.doc_id for r in shorter.collect()} - found

    done = stages["tokens"](spark, fresh, sf_dir)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(r.doc_id for r in done.collect())


def test_stages_on_odd_input(spark, odd, sf_dir):
    """Nulls in any column, empty and long texts, repeated rows, clashing names, and an empty table."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = given.unionByName(odd, allowMissingColumns=True).unionByName(given.limit(3), allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, docs.limit(0), sf_dir)
        assert nothing.count() == 0
        out = stage(spark, docs, sf_dir).cache()
        if name != "tokens":
            assert sorted(out.columns) == sorted(docs.columns)
        else:
            assert set(docs.columns) <= set(out.columns)
        assert out.count() <= docs.count()
        null_texts = docs.where("text is null").count()
        assert out.where("text is null").count() == null_texts
        if name in ("repeated passages", "tokens"):
            assert out.count() == docs.count()
        docs = out
    ids = {r.doc_id: r.ids for r in docs.where("doc_id is not null").collect()}
    assert ids[1] == [] and all(i is not None for i in ids.values())
