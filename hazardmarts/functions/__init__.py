"""Column expressions; all built-in, so they stay inside generated code."""

from hazardmarts.functions.bands import band, level_of, past_or_forecast, severity_of
from hazardmarts.functions.casts import measure, strict_cast, utc_wall_time
from hazardmarts.functions.keys import row_key
from hazardmarts.functions.numbers import python_float_text, round_half_away, round_half_even
from hazardmarts.functions.sphere import haversine_km
from hazardmarts.functions.text import normalize_city

__all__ = [
    "band",
    "haversine_km",
    "level_of",
    "measure",
    "normalize_city",
    "past_or_forecast",
    "python_float_text",
    "round_half_away",
    "round_half_even",
    "row_key",
    "severity_of",
    "strict_cast",
    "utc_wall_time",
]
