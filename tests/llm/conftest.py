import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import LONG, PASSAGE  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """(doc_id, text, lang) of all documents."""
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows and keys, and columns with names that operators use."""
    rows = [
        (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, LONG), (5, LONG), (6, LONG + " end"),
        (7, "a " + PASSAGE), (8, PASSAGE + " ü"), (8, "other text of the same key"), (None, "text without a key"),
        (9, "ÀÉ ß 😀 \\### </turn> <|endoftext|>"), (10, "x" * 3000), (11, "One TWO"),
    ]
    names = ["score", "ids", "found_items", "kept", "removed", "offending", "lang_pred", "cid", "key", "gram", "__text", "decoded"]
    return spark.createDataFrame(
        [(k, t, *(f"{n}{i}" for n in names)) for i, (k, t) in enumerate(rows)],
        "doc_id long, text string, " + ", ".join(f"{n} string" for n in names),
    ).repartition(3)
