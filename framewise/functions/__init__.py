"""Column-level helpers: JVM-side expressions only (no Python per row)."""

from framewise.functions.columns import (
    basename,
    flag_as_int,
    not_true,
    round6,
    time_of_day,
)

__all__ = ["basename", "flag_as_int", "not_true", "round6", "time_of_day"]
