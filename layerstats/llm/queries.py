"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerstats.llm import (
    bpe,
    chat,
    contamination,
    hard_negatives,
    jaccard_join,
    language,
    line_dedup,
    periodic_runs,
    pitman_yor,
    suffix_dedup,
    topk,
    toxicity,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, by: int) -> Column:
    """crc32 of a key as text, modulo ``by``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(by))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), learn=remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
        F.transform("offending", lambda s: s["start"]).alias("offending_starts"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = "\\### Assistant: </turn> ok"
    columns = ("conv_id", "turn", "role", "text")
    turns = _table(spark, sf_dir, "conversations").select(*columns)
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(planted).alias("text"),
    )
    read = chat.read_back(chat.windows(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select(
        "conv_id",
        F.struct("window", said.alias("said"), F.array_join("learned", "").alias("learned")).alias("part"),
        F.size("turns").alias("n_turns"),
        "formatted_chars",
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.array_sort(F.collect_list("part")).alias("parts"),
        F.sum("formatted_chars").cast("long").alias("formatted_chars"),
    )
    joined = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return whole.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2(joined("said").cast("binary"), 256).alias("turns_sha256"),
        F.length(joined("learned")).cast("long").alias("loss_chars"),
        F.sha2(joined("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = pitman_yor.score(docs, remainder("doc_id", 7) != 2)
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return cut.select(
        "doc_id",
        (F.octet_length("kept") + lost).cast("long").alias("n_bytes"),
        lost.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The rules, as host, path and verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(str(rule) for rule in URL_RULES)
    rules = spark.sql(f"select * from values {values} as t(host, path, verdict)")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = topk.search(docs, F.col("doc_id") % 20 == 0)
    return found.select("query_id", "doc_id", F.round("score", 4).alias("score"), "rank")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = language.fit(docs, learn=remainder("doc_id", 5) != 0)
    found = language.classify(docs.select("doc_id", "text"), dictionaries)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "margin", "confident")


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination.search(docs, _table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, path).select("doc_id", "ids")
    decoded = bpe.decode(ids, path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.remove_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, the texts of a tenth of all documents made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    docs = docs.withColumn("n", F.size("words"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_periods(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.collapse(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", longest)
    length, start, period = (F.col(f"longest.{c}") for c in ("length", "col2", "col3"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.expr("1000 * longest.length div -longest.col3").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_chat": op2_chat,
    "op3_pitman_yor": op3_pitman_yor,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_jaccard": op5_jaccard,
    "op6_urls": op6_urls,
    "op7_topk": op7_topk,
    "op8_language": op8_language,
    "op9_contamination": op9_contamination,
    "op10_bpe": op10_bpe,
    "op11_lines": op11_lines,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic": op13_periodic,
}
