import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import fixture
import run_football
from layerstats import (
    BRONZE,
    GOLD,
    SILVER,
    ConformSpec,
    LayerConfig,
    LayerPlan,
    Measure,
    Report,
    Summary,
    build_bronze,
    build_gold,
    build_silver,
    football_plan,
    publish,
    read_layer,
    run_layers,
    run_reports,
    shared_summaries,
    summarise_together,
)

CLUBS = "gold_clube_estatisticas_temporada"
ROUNDS = "gold_resumo_estatisticas_rodada"
CARDS = "gold_clube_cartoes_totais"


@pytest.fixture
def built(spark, cfg, tmp_path):
    return run_layers(spark, fixture.write(tmp_path / "in"), cfg, football_plan())


def test_summary_tables(spark, cfg, built):
    assert list(built) == [CLUBS, ROUNDS, CARDS]
    rounds = {r.rodada_numero: r for r in spark.table(cfg.table(ROUNDS)).collect()}
    # round: entries, shots, possession, accuracy
    expected = {None: (0, 3.0, 50.0, 80.0), 1: (2, 6.0, 50.0, 42.5), 2: (2, 3.5, 0.0, math.nan)}
    for number, row in rounds.items():
        got = (
            row.total_entradas_rodada,
            row.media_chutes_rodada,
            row.media_posse_de_bola_rodada,
            row.media_precisao_passes_rodada,
        )
        assert repr(got) == repr(expected[number])
    cards = {r.clube: tuple(r)[2:] for r in spark.table(cfg.table(CARDS)).collect()}
    assert cards == {"São Paulo": (3, 1), "Grêmio": (0, 0), None: (0, 0), "A, B": (0, 0)}
    assert len(spark.table(cfg.table(CLUBS)).columns) == len(spark.table(cfg.table(ROUNDS)).columns) == 13


def test_the_script_shows_layers_and_reports(spark, cfg, tmp_path, capsys):
    path = fixture.write(tmp_path / "in")
    run_football.main([path, cfg.base, "--database", cfg.database, "--season", "2024", "--sort"])
    shown = capsys.readouterr().out
    for title in ("bronze: ", "silver: ", f"gold: {CARDS}", "club_shots", "club_cards"):
        assert title in shown
    assert "|São Paulo|" in shown and "|2024 " in shown


def test_a_plan_of_ones_own(spark, cfg, tmp_path):
    spec = ConformSpec(
        event="match_id",
        entity="player",
        period_text="week",
        period_number="week_no",
        measures=(Measure("points"), Measure("accuracy", "percent")),
        season=2024,
        renames={"id": "match_id"},
        source=("source_file", "origin"),
    )
    means = Summary(
        "player_means",
        ("season", "player"),
        counts={"match_id": "matches"},
        means={"points": "avg_points", "accuracy": "avg_accuracy"},
    )
    best = Report(
        "best_players",
        "player_means",
        season="season",
        columns=("season", "player", "avg_points"),
        order=(("avg_points", "desc"),),
        tie_break=("player",),
    )
    plan = LayerPlan("bronze_players", "silver_players", spec, (means,), (best,), delimiter=";")
    path = tmp_path / "players.csv"
    path.write_text("id;player;week;points;accuracy\n1;Ann;1;9;50%\n2;Ann ;2;6;\n3;Bo;2;8;40%\n")
    build_bronze(spark, str(path), cfg, plan)
    build_silver(spark, cfg, plan)
    tables = build_gold(spark, cfg, plan)
    assert sorted(map(tuple, tables["player_means"].collect())) == [
        (2024, "Ann", 2, 7.5, 25.0),
        (2024, "Bo", 1, 8.0, 40.0),
    ]
    report = run_reports(spark, cfg, plan)["best_players"]
    assert [tuple(row) for row in report.collect()] == [(2024, "Bo", 8.0), (2024, "Ann", 7.5)]


def test_nothing_is_lost_between_layers(spark, cfg, built):
    plan = football_plan()
    bronze = read_layer(spark, cfg, BRONZE, plan.bronze)
    silver = read_layer(spark, cfg, SILVER, plan.silver)
    assert bronze.count() == silver.count() == 5
    assert len(bronze.columns) == 14 and len(silver.columns) == 16
    ids = silver.agg(F.count("id_partida")).first()[0]
    assert built[CLUBS].agg(F.sum("jogos_disputados")).first()[0] == ids
    assert built[ROUNDS].agg(F.sum("total_entradas_rodada")).first()[0] == ids
    sums = silver.agg(F.sum("cartao_amarelo"), F.sum("cartao_vermelho")).first()
    assert built[CARDS].agg(F.sum("total_cartoes_amarelos"), F.sum("total_cartoes_vermelhos")).first() == sums


def test_reports_match_sql_on_the_tables(spark, cfg, built):
    spark.catalog.setCurrentDatabase(cfg.database)
    try:
        statements = {
            "club_shots": f"select ano_temporada, clube, jogos_disputados, media_chutes_por_jogo, "
            f"media_chutes_no_alvo_por_jogo, media_posse_de_bola from {CLUBS} where ano_temporada = "
            f"(select max(ano_temporada) from {CLUBS}) "
            "order by media_chutes_no_alvo_por_jogo desc, clube limit 10",
            "round_discipline": f"select ano_temporada, rodada_numero, media_faltas_rodada, "
            f"media_cartao_amarelo_rodada, media_cartao_vermelho_rodada from {ROUNDS} where "
            f"ano_temporada = (select max(ano_temporada) from {ROUNDS}) order by rodada_numero limit 10",
            "club_cards": f"select * from {CARDS} where ano_temporada = "
            f"(select max(ano_temporada) from {CARDS}) order by total_cartoes_vermelhos desc, "
            "total_cartoes_amarelos desc, clube limit 10",
        }
        reports = run_reports(spark, cfg, football_plan())
        for name, statement in statements.items():
            assert reports[name].collect() == spark.sql(statement).collect()
        assert len(reports["club_overview"].columns) == 9
        assert reports["round_discipline"].first().rodada_numero is None
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_rerun_is_idempotent_and_follows_the_input(spark, cfg, tmp_path, built):
    before = sorted(map(repr, spark.table(cfg.table(CLUBS)).collect()))
    path = fixture.write(tmp_path / "in")
    run_layers(spark, path, cfg, football_plan(), sort=True)
    assert sorted(map(repr, spark.table(cfg.table(CLUBS)).collect())) == before
    with open(path, "a", encoding="utf-8") as file:
        file.write("9,3,Novo,1,1,1%,1,1%,1,1,1,1,1\n")
    again = run_layers(spark, path, cfg, football_plan(), partition_by=("ano_temporada",))
    assert again[CLUBS].where("clube = 'Novo'").count() == 1
    assert again[CLUBS].count() == len(before) + 1


def test_partition_values_keep_their_type(spark, cfg, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(fixture.HEADER + "1,1,007,1\n2,1,08,3\n3,1,007,2\n4,1,,9\n")
    tables = run_layers(spark, str(path), cfg, football_plan(), partition_by=("clube",))
    clubs = {row.clube: row.media_chutes_por_jogo for row in tables[CLUBS].collect()}
    assert clubs == {"007": 1.5, "08": 3.0, None: 9.0}


def test_a_missing_input_stops_the_run(spark, cfg, tmp_path):
    with pytest.raises(AnalysisException):
        run_layers(spark, str(tmp_path / "none"), cfg, football_plan())
    assert not spark.catalog.tableExists(cfg.table("silver_estatisticas"))


def test_a_missing_column_stops_the_run(spark, cfg, tmp_path):
    (tmp_path / "bad.csv").write_text("partida_id,rodata\n1,1\n")
    with pytest.raises(AnalysisException):
        run_layers(spark, str(tmp_path / "bad.csv"), cfg, football_plan())


def test_a_header_alone_gives_empty_tables(spark, cfg, tmp_path):
    (tmp_path / "empty.csv").write_text(fixture.HEADER)
    tables = run_layers(spark, str(tmp_path / "empty.csv"), cfg, football_plan())
    assert [len(df.columns) for df in tables.values()] == [13, 13, 4]
    assert all(df.count() == 0 for df in tables.values())
    assert run_reports(spark, cfg, football_plan())["club_shots"].collect() == []


def test_unknown_provider_is_an_error(spark, cfg):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND|nosuch"):
        publish(spark.range(1), LayerConfig(cfg.base, "nosuch", cfg.database), BRONZE, "t")


def test_summaries_read_silver_once(spark, cfg, built):
    plan = football_plan()
    silver = read_layer(spark, cfg, SILVER, plan.silver)
    tables = summarise_together(silver, plan.summaries)
    text = tables[CARDS]._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    scan = text[text.index("ReadSchema") :].split("\n")[0]
    assert "origem_arquivo" not in scan and "rodada_texto" not in scan
    with shared_summaries(silver, plan.summaries) as shared:
        for df in shared.values():
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "silver" not in text and "Exchange" not in text
            assert "PartitionFilters: [isnotnull(grouping_level" in text


def test_a_bad_header_leaves_bronze(spark, cfg, tmp_path):
    plan, folder = football_plan(), tmp_path / "in"
    path = fixture.write(folder)
    before = build_bronze(spark, path, cfg, plan).count()
    names = fixture.HEADER.replace("partida_id,rodata", "rodata,partida_id")
    (folder / "swapped.csv").write_text(names + "1,1,A,1\n")
    with pytest.raises(Exception, match="header"):
        build_bronze(spark, f"{folder}/*.csv", cfg, plan)
    assert spark.table(cfg.table(plan.bronze)).count() == before
    assert read_layer(spark, cfg, BRONZE, plan.bronze).count() == before


def test_a_failed_gold_table_leaves_all(spark, cfg, built):
    """The second table's name belongs to another path, so the first may not switch either."""
    plan = football_plan()
    names = [summary.name for summary in plan.summaries]
    rows = {name: spark.table(cfg.table(name)).collect() for name in names}
    spark.sql(f"drop table {cfg.table(names[1])}")
    spark.sql(f"create table {cfg.table(names[1])} (x int) using parquet location '{cfg.base}-foreign'")
    fewer = read_layer(spark, cfg, SILVER, plan.silver).limit(1)
    with pytest.raises(ValueError, match="move=True"):
        build_gold(spark, cfg, plan, silver=fewer)
    for name in (names[0], names[2]):
        assert sorted(map(str, spark.table(cfg.table(name)).collect())) == sorted(map(str, rows[name]))
    assert read_layer(spark, cfg, GOLD, names[1]).count() == len(rows[names[1]])
