"""DuckDB statements that answer the registered queries independently."""

from __future__ import annotations

from layerstats_checks.raw import FINE_PERCENT, PERCENTS, RAW, STATISTICS, raw_columns

# Column names of the football file, and of the means per club.
FOOTBALL_NAMES = {
    "match_id": "partida_id",
    "round_text": "rodata",
    "club": "clube",
    "shots": "chutes",
    "shots_on_target": "chutes_no_alvo",
    "possession": "posse_de_bola",
    "passes": "passes",
    "pass_accuracy": "precisao_passes",
    "fouls": "faltas",
    "yellow_cards": "cartao_amarelo",
    "red_cards": "cartao_vermelho",
    "offsides": "impedimentos",
    "corners": "escanteios",
}
FOOTBALL_MEANS = {
    "shots": "media_chutes_por_jogo",
    "shots_on_target": "media_chutes_no_alvo_por_jogo",
    "possession": "media_posse_de_bola",
    "passes": "media_passes_por_jogo",
    "pass_accuracy": "media_precisao_passes",
    "fouls": "media_faltas_por_jogo",
    "yellow_cards": "media_cartao_amarelo_por_jogo",
    "red_cards": "media_cartao_vermelho_por_jogo",
    "offsides": "media_impedimentos_por_jogo",
    "corners": "media_escanteios_por_jogo",
}


def mean(x: str) -> str:
    """Mean of non-negative values with at most two decimals, half up to two."""
    return (
        f"((2 * sum(cast(round({x} * 100) as bigint)) + count({x})) // (2 * count({x}))) / 100.0"
    )


def count_value(x: str) -> str:
    return f"coalesce(try_cast(regexp_replace({x}, '[^0-9]', '', 'g') as int), 0)"


def percent_value(x: str) -> str:
    return f"coalesce(try_cast(regexp_replace({x}, '[%]', '', 'g') as double), 0.0::double)"


def _cleaned(name: str) -> str:
    return percent_value(name) if name in PERCENTS else count_value(name)


def silver_sql(**instead: str) -> str:
    return (
        "select try_cast(match_id as int) as match_id, round_text, trim(club) as club, "
        + ", ".join(f"{_cleaned(name)} as {name}" for name in STATISTICS)
        + ", season, try_cast(round_text as int) as round_no "
        + f"from (select {', '.join(raw_columns(**instead))} from lineitem)"
    )


SILVER = silver_sql()

MEANS = ", ".join(f"{mean(name)} as avg_{name}" for name in STATISTICS)

PROFILE = (
    f"select season, club, count(match_id) as matches, {MEANS} "
    f"from ({SILVER}) group by season, club"
)
ROUND_SUMMARY = (
    f"select season, round_no, count(match_id) as entries, {MEANS} "
    f"from ({SILVER}) group by season, round_no"
)
TOTALS = (
    "select season, club, cast(sum(yellow_cards) as bigint) as total_yellow_cards, "
    "cast(sum(red_cards) as bigint) as total_red_cards "
    f"from ({SILVER}) group by season, club"
)


def top(table: str, columns: str, order: str, season: str = "season") -> str:
    return (
        f"with g as ({table}) select {columns} from g "
        f"where {season} = (select max({season}) from g) order by {order} limit 10"
    )


PROFILE_ORDER = "avg_shots_on_target desc nulls last, club asc nulls first"
TOP_PROFILE = top(
    PROFILE,
    "season, club, matches, avg_shots, avg_shots_on_target, avg_possession",
    PROFILE_ORDER,
)

FOOTBALL_SILVER = (
    "select match_id as id_partida, round_text as rodada_texto, club as clube, "
    + ", ".join(f"{name} as {FOOTBALL_NAMES[name]}" for name in STATISTICS)
    + f", 2023 as ano_temporada, round_no as rodada_numero from ({SILVER})"
)


def football_clubs(silver: str) -> str:
    return (
        "select 2023 as ano_temporada, club as clube, count(match_id) as jogos_disputados, "
        + ", ".join(f"{mean(name)} as {alias}" for name, alias in FOOTBALL_MEANS.items())
        + f" from ({silver}) group by club"
    )


FOOTBALL_CLUBS = football_clubs(SILVER)
# Inference reads ``12.340`` as a number, of which ``12.34`` is the text.
INFERRED_PASSES = f"cast(try_cast({RAW['passes']} as double) as varchar)"
FOOTBALL_ROUNDS = (
    "select ano_temporada, rodada_numero, count(id_partida) as total_entradas_rodada, "
    + ", ".join(
        f"{mean(FOOTBALL_NAMES[name])} as media_{FOOTBALL_NAMES[name]}_rodada"
        for name in STATISTICS
    )
    + f" from ({FOOTBALL_SILVER}) group by ano_temporada, rodada_numero"
)
FOOTBALL_CARDS = (
    "select ano_temporada, clube, cast(sum(cartao_amarelo) as bigint) as total_cartoes_amarelos, "
    "cast(sum(cartao_vermelho) as bigint) as total_cartoes_vermelhos "
    f"from ({FOOTBALL_SILVER}) group by ano_temporada, clube"
)
FOOTBALL_CLUB_ORDER = "media_chutes_no_alvo_por_jogo desc nulls last, clube asc nulls first"
FOOTBALL_SHOTS = (
    "ano_temporada, clube, jogos_disputados, media_chutes_por_jogo, "
    "media_chutes_no_alvo_por_jogo, media_posse_de_bola"
)


ORACLES = {
    "csv_roundtrip": "select * from part",
    "csv_inferred": "select *, 'c_custkey int, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string' as inferred_types from customer",
    "ingest_provenance": "select *, 'events_csv' as source_folder from events",
    "layer_readback": "select * from orders",
    "publish_overwrite": TOTALS,
    "publish_refused": f"select *, true as refused from ({TOTALS})",
    "bronze_refused": "select *, true as refused from part",
    "silver_refused": f"select *, true as refused from ({SILVER})",
    "publish_sorted": f"select *, true as in_order from ({TOTALS})",
    "publish_partitioned": SILVER,
    "clean_counts_brand": f"select p_partkey, {count_value('p_brand')} as brand_no from part",
    "clean_counts_name": f"select p_partkey, {count_value('p_name')} as name_no from part",
    "clean_counts_props": f"select event_id, {count_value('props')} as props_no from events",
    "clean_counts_priority": "select o_orderkey, "
    f"{count_value('o_orderpriority')} as priority_no from orders",
    "clean_counts_typed": "select l_orderkey, l_linenumber, "
    f"{count_value('cast(l_quantity as varchar)')} as quantity_no from lineitem",
    "clean_percent": "select l_orderkey, l_linenumber, round(l_discount * 100) as discount_pct, "
    "round(l_tax * 100) as tax_pct from lineitem",
    "clean_percent_text": "select p_partkey, "
    f"{percent_value('p_brand')} as brand_pct from part",
    "integer_text": "select l_orderkey, l_linenumber, cast(l_quantity as int) as quantity, "
    "cast(trunc(l_extendedprice) as int) as price, "
    "cast(null as int) as flag from lineitem",
    "trim_entity": "select cast(c_custkey as int) as c_custkey, "
    "case when c_custkey % 2 = 0 then c_name || chr(9) else c_name end as name from customer",
    "rename_columns": "select cast(s_suppkey as int) as id, cast(s_nationkey as varchar) as nation, "
    "trim(s_name) as supplier_name, cast(s_acctbal as double) as balance, "
    "2023 as season, cast(s_nationkey as int) as nation_no from supplier",
    "conform": SILVER,
    "season_token": "select o_orderkey, cast(year(o_orderdate) as int) as season, "
    "cast(month(o_orderdate) as int) as round_no from orders",
    "season_token_wide": "select o_orderkey, cast(year(o_orderdate) as int) as season, "
    "cast(dayofyear(o_orderdate) as int) as round_no from orders",
    "season_token_inferred": "select cast(year(l_shipdate) as int) as ano_temporada, "
    "cast(month(l_shipdate) as int) as rodada_numero, "
    f"count(match_id) as total_entradas_rodada from (select l_shipdate, try_cast({RAW['match_id']} as int) "
    "as match_id from lineitem) group by year(l_shipdate), month(l_shipdate)",
    "profile": PROFILE,
    "round_summary": ROUND_SUMMARY,
    "totals": TOTALS,
    "profile_exact": "select l_returnflag, l_linestatus, count(l_orderkey) as lines, "
    + ", ".join(
        f"{mean(x)} as avg_{x}" for x in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    + " from lineitem group by l_returnflag, l_linestatus",
    "profile_exact_fine": "select l_returnflag, count(l_orderkey) as lines, "
    "((20 * sum(l_linenumber) + count(l_linenumber)) // (2 * count(l_linenumber))) / 100000000.0 "
    "as avg_value from lineitem group by l_returnflag",
    "summaries_one_pass": "select 'club' as level, p.season, p.club as member, matches as events, "
    "avg_shots, avg_possession, avg_passes, total_yellow_cards, total_red_cards "
    f"from ({PROFILE}) p join ({TOTALS}) t using (season) "
    "where p.club is not distinct from t.club "
    "union all select 'round', season, cast(round_no as varchar), entries, avg_shots, "
    f"avg_possession, avg_passes, null, null from ({ROUND_SUMMARY})",
    "latest_season": f"with s as ({SILVER}) select * from s "
    "where season = (select max(season) from s)",
    "top_profile": TOP_PROFILE,
    "top_profile_wide": top(
        PROFILE,
        "season, club, matches, avg_shots, avg_shots_on_target, avg_possession, "
        "avg_fouls, avg_yellow_cards, avg_red_cards",
        PROFILE_ORDER,
    ),
    "top_rounds": top(
        ROUND_SUMMARY,
        "season, round_no, avg_fouls, avg_yellow_cards, avg_red_cards",
        "round_no asc nulls first",
    ),
    "top_totals": top(
        TOTALS,
        "season, club, total_yellow_cards, total_red_cards",
        "total_red_cards desc nulls last, total_yellow_cards desc nulls last, "
        "club asc nulls first",
    ),
    "verify_layer": "select row_number() over () as position, column_name, "
    "case column_type when 'INTEGER' then 'int' when 'VARCHAR' then 'string' "
    f"else lower(column_type) end as data_type from (describe {SILVER})",
    "layer_sample": "select least(count(*), 5) as found_rows from orders",
    "layers_end_to_end": TOP_PROFILE,
    "football_clubs": FOOTBALL_CLUBS,
    "football_clubs_exact": football_clubs(silver_sql(pass_accuracy=FINE_PERCENT)),
    "football_inferred": football_clubs(silver_sql(passes=INFERRED_PASSES)),
    "football_source": "select id_partida, clube, chutes_no_alvo, "
    "case when chutes_no_alvo % 2 = 1 then 'odd' else 'even' end as origem_arquivo "
    f"from ({FOOTBALL_SILVER})",
    "football_rounds": FOOTBALL_ROUNDS,
    "football_cards": FOOTBALL_CARDS,
    "football_club_shots": top(
        FOOTBALL_CLUBS, FOOTBALL_SHOTS, FOOTBALL_CLUB_ORDER, "ano_temporada"
    ),
    "football_club_overview": top(
        FOOTBALL_CLUBS,
        f"{FOOTBALL_SHOTS}, media_faltas_por_jogo, media_cartao_amarelo_por_jogo, "
        "media_cartao_vermelho_por_jogo",
        FOOTBALL_CLUB_ORDER,
        "ano_temporada",
    ),
    "football_round_discipline": top(
        FOOTBALL_ROUNDS,
        "ano_temporada, rodada_numero, media_faltas_rodada, media_cartao_amarelo_rodada, "
        "media_cartao_vermelho_rodada",
        "rodada_numero asc nulls first",
        "ano_temporada",
    ),
    "football_club_cards": top(
        FOOTBALL_CARDS,
        "ano_temporada, clube, total_cartoes_amarelos, total_cartoes_vermelhos",
        "total_cartoes_vermelhos desc nulls last, total_cartoes_amarelos desc nulls last, "
        "clube asc nulls first",
        "ano_temporada",
    ),
}
