"""``lineitem`` as a dirty statistics file.

An order is a match, a supplier a club, the ship month a round, the ship year a
season. The expressions run on Spark and DuckDB alike and plant the faults a
statistics file has: blanks, ``None``, percent signs, thousands dots, minus
signs, padding, unreadable ids, missing clubs.
"""

RAW = {
    "match_id": "case when l_partkey % 97 = 0 then 'x' else cast(l_orderkey as string) end",
    "round_text": "case when l_linenumber = 6 then '' else cast(month(l_shipdate) as string) end",
    "club": "case when l_suppkey % 50 = 0 then null"
    " else '  S' || cast(l_suppkey as string) || ' ' end",
    "shots": "case when l_linenumber = 7 then '' when l_linenumber = 5 then 'None'"
    " else cast(cast(l_quantity as int) as string) end",
    "shots_on_target": "cast(l_linenumber as string)",
    "possession": "case when l_linenumber = 7 then ''"
    " else cast(cast(round(l_discount * 100) as int) as string)"
    " || case when l_linenumber = 3 then '.5%' else '%' end end",
    "passes": "cast(cast(floor(l_extendedprice / 1000) as int) as string) || '.'"
    " || lpad(cast(cast(floor(l_extendedprice) as bigint) % 1000 as string), 3, '0')",
    "pass_accuracy": "cast(cast(round(l_tax * 100) as int) as string) || '%'",
    "fouls": "cast(cast(l_quantity as int) % 10 as string)",
    "yellow_cards": "case when l_returnflag = 'A' then '1' else '' end",
    "red_cards": "case when l_returnflag = 'R' then '1' else '' end",
    "offsides": "'-' || cast(l_linenumber % 3 as string)",
    "corners": "cast(l_partkey % 10 as string)",
    "season": "cast(year(l_shipdate) as int)",
}

COUNTS = (
    "shots",
    "shots_on_target",
    "passes",
    "fouls",
    "yellow_cards",
    "red_cards",
    "offsides",
    "corners",
)
PERCENTS = ("possession", "pass_accuracy")
# Column order of the raw file.
STATISTICS = tuple(list(RAW)[3:13])


# Percentages with decimals that no double holds to the last digit.
FINE_PERCENT = (
    "cast(cast(round(l_tax * 100) as int) as string) || '.'"
    " || lpad(cast(l_partkey % 100 as string), 2, '0') || '%'"
)
# The year and month as one token: inference would take it for a date.
TOKEN = "cast(year(l_shipdate) as string) || '-' || cast(month(l_shipdate) as string)"


def raw_columns(names: dict[str, str] | None = None, **instead: str) -> list[str]:
    """Select-list entries, optionally under other names or with other expressions."""
    names = names or {name: name for name in RAW}
    source = {**RAW, **instead}
    return [f"{source[name]} as {alias}" for name, alias in names.items()]
