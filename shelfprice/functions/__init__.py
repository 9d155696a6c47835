"""Column expressions: every one stays inside Spark's generated code."""

from .prices import scale_for_category, unit_price, unit_price_milli
from .stores import city_of
from .text import collapse_whitespace, pack_size, pack_size_text
from .time import parse_stamp, stamp_text, utc_wallclock

__all__ = [
    "city_of", "collapse_whitespace", "pack_size", "pack_size_text", "parse_stamp",
    "scale_for_category", "stamp_text", "unit_price", "unit_price_milli", "utc_wallclock",
]
