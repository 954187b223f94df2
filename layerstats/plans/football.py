"""Club-per-match football statistics: the layers a ready-made plan builds."""

from __future__ import annotations

from pyspark.sql import Column

from layerstats.operators.aggregate import Summary
from layerstats.operators.conform import ConformSpec, Measure
from layerstats.operators.report import Report
from layerstats.plans.layers import LayerPlan
from layerstats.sources.delimited import SOURCE_FILE

# The columns of the statistics file, in file order.
RAW_COLUMNS = (
    "partida_id",
    "rodata",
    "clube",
    "chutes",
    "chutes_no_alvo",
    "posse_de_bola",
    "passes",
    "precisao_passes",
    "faltas",
    "cartao_amarelo",
    "cartao_vermelho",
    "impedimentos",
    "escanteios",
)

# Cleaned names of the renamed and added columns, and the season
# the file stands for.
RENAMES = {"partida_id": "id_partida", "rodata": "rodada_texto"}
SOURCE_NAME = "origem_arquivo"
SEASON_NAME = "ano_temporada"
ROUND_NAME = "rodada_numero"
SEASON = 2023

# Summary table names and their columns.
CLUB_SEASON = "gold_clube_estatisticas_temporada"
ROUND_SUMMARY = "gold_resumo_estatisticas_rodada"
CARD_TOTALS = "gold_clube_cartoes_totais"
CLUB_MATCHES = "jogos_disputados"
ROUND_ENTRIES = "total_entradas_rodada"
CLUB_MEANS = {
    "chutes": "media_chutes_por_jogo",
    "chutes_no_alvo": "media_chutes_no_alvo_por_jogo",
    "posse_de_bola": "media_posse_de_bola",
    "passes": "media_passes_por_jogo",
    "precisao_passes": "media_precisao_passes",
    "faltas": "media_faltas_por_jogo",
    "cartao_amarelo": "media_cartao_amarelo_por_jogo",
    "cartao_vermelho": "media_cartao_vermelho_por_jogo",
    "impedimentos": "media_impedimentos_por_jogo",
    "escanteios": "media_escanteios_por_jogo",
}
CARD_SUMS = {
    "cartao_amarelo": "total_cartoes_amarelos",
    "cartao_vermelho": "total_cartoes_vermelhos",
}

# Fixed value: the columns that hold percentages.
PERCENTAGES = ("posse_de_bola", "precisao_passes")


def football_plan(
    bronze: str = "bronze_estatisticas",
    silver: str = "silver_estatisticas",
    season: int | Column = SEASON,
    period_expression: Column | None = None,
    infer_schema: bool = False,
    exact: bool = False,
) -> LayerPlan:
    """The plan for one statistics file.

    ``season`` is the season all rows belong to, or an expression for files
    holding several, such as ``season_of("rodada_texto", 2023)`` with
    ``round_of("rodada_texto")`` as ``period_expression``. ``exact`` takes the
    means in decimal arithmetic, so that fractional percentages have the same
    mean in whatever order rows arrive; a percentage of ``NaN`` is an error then.
    """
    statistics = RAW_COLUMNS[3:]
    measures = tuple(
        Measure(name, "percent" if name in PERCENTAGES else "count") for name in statistics
    )
    spec = ConformSpec(
        event="id_partida",
        entity="clube",
        period_text="rodada_texto",
        period_number=ROUND_NAME,
        period_expression=period_expression,
        measures=measures,
        season=season,
        season_name=SEASON_NAME,
        renames=RENAMES,
        source=(SOURCE_FILE, SOURCE_NAME),
    )
    by_club, by_round = (SEASON_NAME, "clube"), (SEASON_NAME, ROUND_NAME)
    round_means = {name: f"media_{name}_rodada" for name in statistics}
    summaries = (
        Summary(CLUB_SEASON, by_club, {"id_partida": CLUB_MATCHES}, CLUB_MEANS, exact=exact),
        Summary(ROUND_SUMMARY, by_round, {"id_partida": ROUND_ENTRIES}, round_means, exact=exact),
        Summary(CARD_TOTALS, by_club, sums=CARD_SUMS),
    )
    # The columns of each report and what it is sorted by.
    shots_first = (("media_chutes_no_alvo_por_jogo", "desc"),)
    shots = (
        *by_club,
        CLUB_MATCHES,
        "media_chutes_por_jogo",
        "media_chutes_no_alvo_por_jogo",
        "media_posse_de_bola",
    )
    discipline = (
        "media_faltas_por_jogo",
        "media_cartao_amarelo_por_jogo",
        "media_cartao_vermelho_por_jogo",
    )
    round_discipline = (
        "media_faltas_rodada",
        "media_cartao_amarelo_rodada",
        "media_cartao_vermelho_rodada",
    )
    reports = (
        Report("club_shots", CLUB_SEASON, SEASON_NAME, shots, shots_first, ("clube",)),
        Report(
            "club_overview",
            CLUB_SEASON,
            SEASON_NAME,
            (*shots, *discipline),
            shots_first,
            ("clube",),
        ),
        Report(
            "round_discipline",
            ROUND_SUMMARY,
            SEASON_NAME,
            (*by_round, *round_discipline),
            ((ROUND_NAME, "asc"),),
        ),
        Report(
            "club_cards",
            CARD_TOTALS,
            SEASON_NAME,
            (*by_club, *CARD_SUMS.values()),
            (("total_cartoes_vermelhos", "desc"), ("total_cartoes_amarelos", "desc")),
            ("clube",),
        ),
    )
    return LayerPlan(bronze, silver, spec, summaries, reports, infer_schema=infer_schema)
