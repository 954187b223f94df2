import math
import random
import re

import pytest
from pyspark.sql import functions as F

from layerstats import (
    count_value,
    integer_text,
    keep_digits,
    percent_value,
    round_of,
    season_of,
    strict_double_value,
    strict_int_value,
)

NAN, INF = float("nan"), float("inf")

# text, digits as int, percent as double, text as int
CASES = [
    ("12", 12, 12.0, 12),
    ("", None, None, None),
    ("  7 ", 7, 7.0, 7),
    ("-5", 5, -5.0, -5),
    ("+5", 5, 5.0, 5),
    ("12.0", 120, 12.0, 12),
    ("12.", 12, 12.0, 12),
    ("3.9", 39, 3.9, 3),
    ("-3.9", 39, -3.9, -3),
    ("1.234", 1234, 1.234, 1),
    (".5", 5, 0.5, None),
    ("1.2.3", 123, None, None),
    ("None", None, None, None),
    ("61%", 61, 61.0, None),
    ("61,5%", 615, None, None),
    ("%", None, None, None),
    ("NaN", None, NAN, None),
    ("Infinity", None, INF, None),
    ("1e2", 12, 100.0, None),
    ("5d", 5, 5.0, None),
    ("99999999999", None, 99999999999.0, None),
    ("2147483647", 2147483647, 2147483647.0, 2147483647),
    ("-2147483648", None, -2147483648.0, -2147483648),
    ("2147483648", None, 2147483648.0, None),
    ("１２", None, None, None),
    ("\t7\n", 7, 7.0, 7),
    ("abc3x4", 34, None, None),
    (None, None, None, None),
]


def same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a):
        return math.isnan(b)
    return a == b


def evaluate(spark, texts, *columns):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [row[1:] for row in sorted(rows.select("i", *columns).collect())]


def test_each_kind_of_text(spark, ansi):
    got = evaluate(
        spark,
        [case[0] for case in CASES],
        count_value("t"),
        percent_value("t"),
        integer_text("t"),
        strict_int_value("t"),
        strict_double_value("t"),
    )
    for (text, digits, percent, whole), row in zip(CASES, got):
        assert row[0] == (digits or 0), text
        assert same(row[1], 0.0 if percent is None else percent), text
        assert row[2] == whole, text
        assert row[3] == (whole or 0), text
        strict = 0.0 if text and "%" in text or percent is None else percent
        assert same(row[4], strict), text


def test_defaults(spark):
    got = evaluate(spark, ["", None, "x", "0"], count_value("t", -1), percent_value("t", 0.5))
    assert got == [(-1, 0.5), (-1, 0.5), (-1, 0.5), (0, 0.0)]


def test_random_text_against_plain_casts(spark):
    """Feeding casts NULL instead of blank text changes no result."""
    rng = random.Random(7)
    alphabet = list("0123456789") * 2 + list(" .,-+%eEdfNnaIix\t\n") + ["é", "１"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(20000)]
    got = evaluate(
        spark,
        texts,
        count_value("t"),
        F.coalesce(F.regexp_replace("t", "[^0-9]", "").try_cast("int"), F.lit(0)),
        percent_value("t"),
        F.coalesce(F.regexp_replace("t", "[%]", "").try_cast("double"), F.lit(0.0)),
    )
    for text, (count, plain_count, percent, plain_percent) in zip(texts, got):
        digits = re.sub("[^0-9]", "", text)
        value = int(digits) if digits else 0
        assert count == plain_count == (value if value < 2**31 else 0), text
        assert same(percent, plain_percent), text


def test_random_text_as_whole_number_against_legacy_cast(spark):
    """Equal to the pre-ANSI cast, but for a bare fraction such as ``.5``."""
    rng = random.Random(11)
    alphabet = list("0123456789") * 2 + list(" .-+ex\t\n\x00\x7f") + ["é", "１"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 8))) for _ in range(20000)]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = evaluate(spark, texts, integer_text("t"), F.col("t").cast("int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    compared = 0
    for text, (whole, legacy) in zip(texts, got):
        if re.search(r"[0-9]", text.split(".")[0]):
            assert whole == legacy, repr(text)
            compared += whole is not None
        else:
            assert whole is None
    assert compared > 1000


@pytest.mark.parametrize("kind,digits", [("int", "17"), ("double", "170"), ("string", "17")])
def test_digits_come_from_the_printed_form(spark, kind, digits):
    rows = spark.createDataFrame([("17",)], "t string").select(F.col("t").cast(kind).alias("t"))
    assert rows.select(keep_digits("t")).first()[0] == digits


def test_season_token(spark, ansi):
    texts = ["2023-1", "2023-38", "2024-05", "7", "", None, "2023-", "23-1", "2023-100", " 2023-5 ", "x"]
    got = evaluate(spark, texts, season_of("t", 2000), season_of("t"), round_of("t"))
    assert got == [
        (2023, 2023, 1),
        (2023, 2023, 38),
        (2024, 2024, 5),
        (2000, None, 7),
        (2000, None, None),
        (2000, None, None),
        (2000, None, None),
        (2000, None, None),
        (2023, 2023, 100),
        (2023, 2023, 5),
        (2000, None, None),
    ]
