from layerstats.functions.clean import (
    count_value,
    drop_percent,
    integer_text,
    keep_digits,
    percent_value,
    strict_double_value,
    strict_int_value,
)
from layerstats.functions.season import round_of, season_of

__all__ = [
    "count_value",
    "drop_percent",
    "integer_text",
    "keep_digits",
    "percent_value",
    "round_of",
    "season_of",
    "strict_double_value",
    "strict_int_value",
]
