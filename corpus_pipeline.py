"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept. All but the last return the columns of ``documents``.

What holds for all stages: a null or empty text is a text without words, which no stage
removes by itself; texts may be of any length and are worked on whole; rows
repeated in full are treated alike, and ties have one outcome whatever the order of
rows; an empty table gives an empty table; columns besides ``doc_id``, ``text`` and
``n_chars`` go through unchanged, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerstats.llm import bpe, contamination, jaccard_join, suffix_dedup, toxicity
from layerstats.llm.store import forget, settled


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from ``labels`` scores below 0.5; all others go.

    Documents with a null key are scored like others, but teach nothing.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, out="__score", offending="__offending")
    return scored.where("__score < 0.5").select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the least doc_id.

    A null doc_id is the last. Documents without words are nobody's duplicates, and all stay.
    """
    return jaccard_join.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes that occur again; n_chars follows the text.

    Characters stay whole. Null texts stay null, and have null n_chars. Of a document that is
    all repeats the row stays, with an empty text.
    """
    cut = suffix_dedup.remove_repeats(docs, characters=True, kept="__kept", removed="__removed")
    text = F.when(F.col("text").isNotNull(), F.decode("__kept", "utf-8"))
    return cut.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even 0.8 of its runs of five words.

    Without benchmark items all documents stay.
    """
    marked = contamination.mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out="__found")
    return marked.where(F.size("__found") == 0).select(docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their tokens, ``ids``, and the number of them; null and empty texts have none.

    Columns named ``ids`` or ``n_tokens`` are replaced.
    """
    encoded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", one_of_each),
    ("repeated passages", without_repeats),
    ("decontamination", without_benchmark),
    ("tokens", tokenised),
]

#: A trained model decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is a written table that the next one reads.

    What a stage wrote on its way, and the table before it, go once its own table is written.
    """
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, lambda: stage(spark, before, sf_dir), name.replace(" ", "-"))
        if hasattr(before, "written_to"):
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
