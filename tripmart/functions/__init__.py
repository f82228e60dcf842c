"""Column-level helpers (pure ``Column -> Column`` functions)."""

from tripmart.functions.core import (  # noqa: F401
    exact_avg,
    exact_sum,
    guarded_ratio,
    half_up,
    money,
    to_double,
    to_int,
    to_timestamp,
    normalise_text,
)
