from weekloom.functions.dates import (
    is_payday,
    is_weekend,
    season_cos,
    season_sin,
    week_of_year,
    week_start,
)
from weekloom.functions.numbers import (
    clip,
    exact_sum,
    floored_ratio,
    rounded,
    safe_ratio,
    truncated,
)
from weekloom.functions.text import grouped, padded_id, percent, prefixed, thousands

__all__ = [
    "clip",
    "exact_sum",
    "floored_ratio",
    "grouped",
    "is_payday",
    "is_weekend",
    "padded_id",
    "percent",
    "prefixed",
    "rounded",
    "safe_ratio",
    "season_cos",
    "season_sin",
    "thousands",
    "truncated",
    "week_of_year",
    "week_start",
]
