"""Column-expression helpers. All return ``Column`` objects (JVM-side, codegen'd)."""

from airlake.functions.timestamps import (
    as_of_column,
    iso_utc_text,
    parse_timestamp,
    to_utc_wallclock,
    to_wallclock,
)
from airlake.functions.checks import non_negative, all_true

__all__ = [
    "as_of_column",
    "iso_utc_text",
    "parse_timestamp",
    "to_utc_wallclock",
    "to_wallclock",
    "non_negative",
    "all_true",
]
