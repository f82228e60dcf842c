"""Seeded synthetic trips.

One synthetic trip per input row (any DataFrame with key columns, e.g. the
lineitem keys), so the generator scales with its input and runs in parallel
on every partition.  Randomness comes from ``md5(seed, salt, keys)``,
not ``rand()``: a row's values do not depend on partitioning, so a task
recomputed after a lost executor yields the same trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.core import half_up

# Stations, cargo types (probability, weight range in tons,
# rate per ton), operators (probability), delay and dirty-row parameters.
STATIONS = [
    "SANTOS", "SAO_PAULO", "CAMPINAS", "RIBEIRAO_PRETO", "UBERLANDIA", "GOIANIA", "BRASILIA",
    "BELO_HORIZONTE", "CURITIBA", "PARANAGUA", "PORTO_ALEGRE", "CAMPO_GRANDE", "RONDONOPOLIS",
    "CUIABA", "MANAUS",
]
CARGO = [
    ("GRAIN", 0.25, 2000, 8000, 35),
    ("FUEL", 0.15, 1000, 5000, 50),
    ("IRON_ORE", 0.20, 5000, 12000, 28),
    ("CONTAINER", 0.10, 500, 3000, 120),
    ("SUGAR", 0.10, 1500, 6000, 40),
    ("SOYBEAN", 0.15, 2000, 9000, 38),
    ("OTHER", 0.05, 100, 2000, 60),
]
OPERATORS = [("RUMO", 0.40), ("VLI", 0.20), ("FCA", 0.15), ("MRS", 0.15), ("VALE_LOG", 0.10)]
DELAYED_SHARE = 0.28
MEAN_DELAY_MIN = 45
DIRTY_SHARE = 0.02

_TWO52 = float(2**52)


def _uniform(seed: int, salt: int, keys) -> Column:
    """Deterministic uniform in [0, 1) from the row keys: 52 bits of an MD5, which
    every engine has."""
    text = F.concat_ws("|", F.lit(seed), F.lit(salt), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint").cast("double") / _TWO52


def _pick(u: Column, options) -> Column:
    """Categorical choice by cumulative probability."""
    expr, acc = None, 0.0
    for value, p in options:
        acc += p
        cond = u < acc
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(options[-1][0]))


def synthesize(keys: DataFrame, key_cols, seed: int = 42, start: str = "2024-01-01", days: int = 180) -> DataFrame:
    """Raw trips (times as text, like a landing file) with ~28 % delayed
    trips and ~2 % dirty rows (a third each: weight -1, value -100, no
    departure)."""
    k = [F.col(c) for c in key_cols]
    u = {i: _uniform(seed, i, k) for i in range(1, 18)}
    n = len(STATIONS)
    stations = F.array(*[F.lit(s) for s in STATIONS])
    o = F.floor(u[1] * n).cast("int")
    d = (o + 1 + F.floor(u[2] * (n - 1)).cast("int")) % n
    cargo = _pick(u[3], [(c, p) for c, p, *_ in CARGO])
    lo = _pick(u[3], [(lo_, p) for _, p, lo_, _, _ in CARGO]).cast("double")
    hi = _pick(u[3], [(hi_, p) for _, p, _, hi_, _ in CARGO]).cast("double")
    rate = _pick(u[3], [(r_, p) for _, p, _, _, r_ in CARGO]).cast("double")
    weight = half_up(lo + u[4] * (hi - lo), 2)
    dist = 300 + u[5] * 2200
    speed = 50 + u[6] * 30
    dep = F.timestamp_seconds(
        F.unix_timestamp(F.lit(start).cast("timestamp"))
        + F.floor(u[7] * days) * 86400
        + F.floor(u[8] * 23 * 3600)
    )
    arr = F.timestamp_seconds(F.unix_timestamp(dep) + F.floor(dist / speed * 3600))
    delay = F.when(u[9] < DELAYED_SHARE, F.floor(-MEAN_DELAY_MIN * F.log1p(-u[10]))).otherwise(0).cast("int")
    value = half_up(weight * rate * dist / 1000 * (0.8 + 0.4 * u[11]), 2)
    fuel = half_up(dist * (8 + 6 * u[12]), 2)
    dirty = u[15] < DIRTY_SHARE
    third = u[16]
    h = F.md5(F.concat_ws("|", F.lit(seed), *[c.cast("string") for c in k]))
    trip_id = F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)
    )
    fmt = "yyyy-MM-dd HH:mm:ss"
    return keys.select(
        trip_id.alias("trip_id"),
        F.element_at(stations, o + 1).alias("origin_station"),
        F.element_at(stations, d + 1).alias("destination_station"),
        cargo.alias("cargo_type"),
        F.when(dirty & (third < 1 / 3), F.lit(-1.0)).otherwise(weight).alias("cargo_weight_tons"),
        F.when(dirty & (third >= 2 / 3), F.lit(None).cast("string")).otherwise(F.date_format(dep, fmt)).alias(
            "departure_time"
        ),
        F.date_format(arr, fmt).alias("arrival_time"),
        F.concat(F.lit("BR-"), (1000 + F.floor(u[13] * 8999)).cast("int").cast("string")).alias("train_id"),
        _pick(u[14], OPERATORS).alias("operator"),
        F.when(dirty & (third >= 1 / 3) & (third < 2 / 3), F.lit(-100.0)).otherwise(value).alias("freight_value_brl"),
        fuel.alias("fuel_cost_brl"),
        delay.alias("delay_minutes"),
    )
