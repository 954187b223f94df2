"""Language by compression: a text is in the language whose dictionary packs it smallest."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstats.llm.frames import with_columns

UNDETERMINED = "und"
MOST_LANGUAGES = 1000
_other = regex.compile(r"[^\p{L}]+")


def letters_only(text: str | None) -> bytes:
    """Runs of letters in lower case, one space between and around; empty if there is no letter."""
    plain = _other.sub(" ", text).strip().lower() if text else ""
    return f" {plain} ".encode() if plain else b""


def fit(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    learn: Column | None = None,
    dictionary_bytes: int = 1 << 16,
    longest: int = 1 << 13,
) -> dict[str, bytes]:
    """A raw dictionary of each language: training texts up to ``dictionary_bytes``.

    The sample is bounded by that size: of each language the distinct texts with the
    smallest hashes are taken until they fill it, texts being compared and measured
    by their letters. Of a text with more than ``longest`` characters a stretch of so
    many, chosen by its hash, is taken. Rows without language or without a letter
    teach nothing. More than ``MOST_LANGUAGES`` languages are refused.
    """
    usable = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), *([learn.alias("learn")] if learn is not None else []))
    usable = usable.where("learn").drop("learn") if learn is not None else usable
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.withColumn("text", F.trim(F.regexp_replace("text", r"\P{L}+", " ")))
    hashed = F.xxhash64("text")
    each = usable.groupBy("lang", hashed.alias("place")).agg(F.max(F.least(F.length("text"), F.lit(longest))).alias("size"))
    sizes = each.groupBy("lang").agg(F.sum("size").alias("size")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return {}
    size = F.create_map(*(x for row in sizes for x in (F.lit(row["lang"]), F.lit(float(row["size"])))))[F.col("lang")]
    share = lambda place: F.pmod(place, F.lit(1 << 30)) / float(1 << 30)
    start = F.pmod(F.xxhash64("place"), F.greatest(F.length("text") - longest, F.lit(0)) + 1).cast("int") + 1
    thin = usable.where(share(hashed) * size < 6 * dictionary_bytes).withColumn("place", hashed)
    thin = thin.withColumn("text", F.col("text").substr(start, F.lit(longest))).distinct()
    order = Window.partitionBy("lang").orderBy(share(F.col("place")), "place", "text")
    before = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = thin.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < dictionary_bytes)
    texts: dict[str, list[bytes]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["before"])):
        texts.setdefault(row["lang"], []).append(letters_only(row["text"]))
    return {name: b"".join(parts)[:dictionary_bytes] for name, parts in sorted(texts.items())}


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, content in dictionaries:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_checksum=False))
    return made


def classify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    text: str = "text",
    out: str = "lang_pred",
    margin: float = 0.02,
    level: int = 6,
) -> DataFrame:
    """Add ``out`` and its ``score`` (0 to 1), ``margin`` and ``confident``.

    Letters of the whole text, in lower case, are compressed once with each
    language's dictionary. ``margin`` is how much smaller the best is than the
    second, as a share of it; below the parameter ``margin`` the prediction is
    rejected: ``confident`` is false, ``out`` still names the smallest. Equal sizes
    go to the language whose dictionary shares most four-letter runs with the text, then to the first
    name. Null texts, texts without a letter, and all texts when no language was
    learned are ``und`` with score 0. Texts may be of any length; repeated rows get equal
    results; empty tables give no rows. Columns of these names are replaced.
    """
    names = sorted(dictionaries)
    frozen = tuple((name, dictionaries[name]) for name in names)
    least = margin

    def work(texts: pa.Array) -> list[pa.Array]:
        packers = _compressors(frozen, level)
        grams = _grams(frozen)
        best, scores, margins = [], [], []
        for value in texts:
            raw = letters_only(value.as_py())
            if not raw or not names:
                best.append(UNDETERMINED), scores.append(0.0), margins.append(0.0)
                continue
            sizes = np.array([len(p.compress(raw)) for p in packers], np.float64)
            low = sizes.min()
            tied = np.flatnonzero(sizes == low)
            choice = int(tied[0])
            if len(tied) > 1:
                seen = {raw[i : i + 4] for i in range(len(raw) - 3)}
                choice = max(tied, key=lambda k: (len(seen & grams[k]), -k))
            rest = np.delete(sizes, choice)
            gap = (rest.min() - low) / rest.min() if len(rest) else 1.0
            best.append(names[choice]), margins.append(float(gap))
            scores.append(float(1 / (1 + np.exp((low - rest) / 4).sum())))
        gaps = np.array(margins, np.float64)
        return [pa.array(best, pa.string()), pa.array(scores, pa.float64()), pa.array(gaps), pa.array(gaps >= least)]

    added = [(out, T.StringType()), ("score", T.DoubleType()), ("margin", T.DoubleType()), ("confident", T.BooleanType())]
    return with_columns(docs, text, added, work)


@lru_cache(maxsize=4)
def _grams(dictionaries: tuple[tuple[str, bytes], ...]) -> list[set[bytes]]:
    return [{content[i : i + 4] for i in range(len(content) - 3)} for _, content in dictionaries]
