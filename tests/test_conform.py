import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import fixture
from layerstats import ConformSpec, Measure, conform, football_plan, ingest_csv, round_of, season_of

from planned import final_plan

SILVER_TYPES = [
    ("id_partida", "int"),
    ("rodada_texto", "string"),
    ("clube", "string"),
    ("chutes", "int"),
    ("chutes_no_alvo", "int"),
    ("posse_de_bola", "double"),
    ("passes", "int"),
    ("precisao_passes", "double"),
    ("faltas", "int"),
    ("cartao_amarelo", "int"),
    ("cartao_vermelho", "int"),
    ("impedimentos", "int"),
    ("escanteios", "int"),
    ("origem_arquivo", "string"),
    ("ano_temporada", "int"),
    ("rodada_numero", "int"),
]


def without_source(df):
    return [tuple(row) for row in df.drop("origem_arquivo").collect()]


def test_a_dirty_file(spark, ansi, tmp_path):
    bronze = ingest_csv(spark, fixture.write(tmp_path))
    silver = conform(bronze, football_plan().spec)
    assert silver.dtypes == SILVER_TYPES
    # repr, because NaN is not equal to itself
    assert sorted(map(repr, without_source(silver))) == sorted(map(repr, fixture.CLEANED))
    assert silver.select("origem_arquivo").distinct().first()[0].endswith("/statistics.csv")


def test_inferred_columns_print_their_fraction(spark, ansi, tmp_path):
    bronze = ingest_csv(spark, fixture.write(tmp_path), infer_schema=True)
    assert dict(bronze.dtypes)["passes"] == "double"
    got = conform(bronze, football_plan().spec).where("clube = 'São Paulo' and rodada_numero = 1")
    assert got.select("passes", "impedimentos", "rodada_texto").first() == (4200, 10, "1")


def test_inferred_numbers_are_cast_not_read(spark):
    rows = spark.createDataFrame(
        [(12.7, 3.0, "a"), (1e12, None, "b")], "match double, round double, club string"
    )
    spec = ConformSpec("match", "club", "round", "round_no", (), 2023)
    assert [(r.match, r.round_no) for r in conform(rows, spec).collect()] == [(12, 3), (None, None)]


def test_renames_are_tolerant_and_required_columns_are_not(spark):
    spec = ConformSpec(
        "id", "club", "round", "round_no", (Measure("n"),), 2023, renames={"ID_RAW": "id", "no": "x"}
    )
    rows = spark.createDataFrame([("1", "a", "1", "2")], "id_raw string, club string, round string, N string")
    assert conform(rows, spec).columns == ["id", "round", "club", "n", "season", "round_no"]
    assert conform(rows.withColumnRenamed("id_raw", "id"), spec).count() == 1
    with pytest.raises(AnalysisException):
        conform(rows.drop("N"), spec)
    with pytest.raises(AnalysisException):
        conform(rows.withColumn("id", F.lit("2")), spec)


def test_unlisted_columns_are_dropped_and_kinds_checked(spark):
    schema = "id string, club string, round string, n string, z string"
    rows = spark.createDataFrame([("1", "a", "1", "-2", "x")], schema)
    spec = ConformSpec("id", "club", "round", "r", (Measure("n", "strict_int"),), F.lit(7))
    assert conform(rows, spec).first().asDict() == {
        "id": 1, "round": "1", "club": "a", "n": -2, "season": 7, "r": 1,
    }
    with pytest.raises(ValueError, match="unknown kind"):
        Measure("n", "text")


def test_season_from_the_round_text(spark, tmp_path):
    text = fixture.HEADER + "1,2022-37,A,1\n2,2023-1,A,1\n3,5,A,1\n"
    path = tmp_path / "s.csv"
    path.write_text(text)
    plan = football_plan(season=season_of("rodada_texto", 2023), period_expression=round_of("rodada_texto"))
    got = conform(ingest_csv(spark, str(path)), plan.spec).orderBy("id_partida")
    assert [(r.ano_temporada, r.rodada_numero) for r in got.collect()] == [(2022, 37), (2023, 1), (2023, 5)]


def test_one_narrow_code_generated_stage(spark, tmp_path):
    bronze = ingest_csv(spark, fixture.write(tmp_path))
    plan = final_plan(conform(bronze, football_plan().spec))
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("*(1)") >= 1 and "*(2)" not in plan


def test_generated_code_is_small_enough_to_be_compiled(spark, tmp_path):
    """The JVM only interprets methods of 8,000 bytes and more."""
    bronze = ingest_csv(spark, fixture.write(tmp_path))
    conform(bronze, football_plan().spec).createOrReplaceTempView("conformed")
    text = spark.sql("explain codegen select * from conformed").first()[0]
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000
