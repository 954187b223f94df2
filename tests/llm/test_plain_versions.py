"""Scores and predictions against plain versions that share no code with the operators but hashing."""

import math
import re
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brute import LONG
from layerstats.llm import bpe, language, toxicity
from layerstats.llm.words import range_hashes

ODD = [None, "", " \n.", "One. two! THREE? four\nfive", "ÀÉß ñandú. x", "no stop at the end", "... . !", "a" * 300 + ". b", "😀 b. c"]


def toxic_score(text, weights, bias):
    """Sentence by sentence and word by word."""
    bits = int(math.log2(len(weights)))
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
    alive = 1.0
    for sentence in [s for s in re.split("[.!?\n]", plain) if re.search("[0-9a-z\u0080-\U0010ffff]", s)] or [""]:
        z = bias
        for word in re.findall("[0-9a-z\u0080-\U0010ffff]+", sentence):
            raw = np.frombuffer(word.encode(), np.uint8)
            for k, most in enumerate((len(raw), *toxicity.BEGINNINGS)):
                h = int(range_hashes(raw, np.array([0]), np.array([min(most, len(raw))]))[0]) * (2 * k + 1) % (1 << 64)
                z += float(weights[h >> (64 - bits)])
        alive *= 1 - 1 / (1 + math.exp(-z)) if z > -500 else 1.0
    return 1 - alive


def test_toxicity_against_a_plain_version(spark, documents):
    rng = np.random.default_rng(1)
    weights, bias = (rng.normal(size=1 << 12) * 0.5 - 0.1).astype(np.float32), -4.0
    texts = ODD + [t for _, t, _ in documents[:40]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in toxicity.score(docs, (weights, bias)).collect():
        assert r.score == pytest.approx(toxic_score(r.text, weights, bias), abs=1e-6)


def test_training_climbs_the_likelihood():
    """The document labels' balanced likelihood under noisy-or, by hand, before and after."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(60)]
    texts, labels = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(words, 6)) for _ in range(3)]
        if i % 3 == 0:
            sentences[i % 2] += " vile"
        texts.append(". ".join(sentences)), labels.append(int(i % 3 == 0))
    weights, bias = toxicity.train(pa.array(texts), np.array(labels), 14, 150)

    def loss(w, b):
        p = np.clip([toxic_score(t, w, b) for t in texts], 1e-9, 1 - 1e-9)
        y = np.array(labels)
        return -np.log(np.where(y == 1, p, 1 - p)).mean()

    assert loss(weights, bias) < 0.1 < loss(np.zeros_like(weights), -1.0)
    assert all((toxic_score(t, weights, bias) >= 0.5) == bool(y) for t, y in zip(texts, labels, strict=True))


def test_language_against_plain_compression(spark, documents):
    docs = spark.createDataFrame([*documents, *((10**6 + i, t, None) for i, t in enumerate([*ODD, LONG[:30_000]]))], "doc_id long, text string, lang string")
    dictionaries = language.fit(docs, learn=F.col("doc_id") % 5 != 0)
    for r in language.classify(docs, dictionaries).collect():
        plain = " ".join(re.findall(r"[^\W\d_]+", r.text or "")).lower()
        if not plain:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        size = {}
        for name, content in dictionaries.items():
            packer = zstandard.ZstdCompressor(
                level=6, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False
            )
            size[name] = len(packer.compress(f" {plain} ".encode()))
        low = min(size.values())
        assert size[r.lang_pred] == low and 0 < r.score <= 1
        rest = sorted(size[n] for n in size if n != r.lang_pred)[0]
        assert r.margin == pytest.approx((rest - low) / rest) and r.confident == (r.margin >= 0.02)


def test_every_assigned_character_is_encoded_as_the_library_does():
    """Alone and between letters. Characters that Unicode 15.1 does not know, and the order of U+09FE among marks, may differ."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    known = [chr(i) for i in range(0x20000) if unicodedata.category(chr(i)) not in ("Cn", "Cs", "Co")]
    texts = [x for c in known for x in (c, f"ab{c}cd")]
    for at in range(0, len(texts), 20_000):
        part = texts[at : at + 20_000]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        got = own.encode(pa.array(part)).to_pylist()
        assert [t for t, a, b in zip(part, want, got, strict=True) if a != b] == []


def test_random_strings_of_assigned_characters():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    rng = np.random.default_rng(3)
    known = [chr(i) for i in range(0x20000) if unicodedata.category(chr(i)) not in ("Cn", "Cs", "Co") and i != 0x09FE]
    texts = ["".join(rng.choice(known, rng.integers(1, 12))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(pa.array(texts)).to_pylist() == want
