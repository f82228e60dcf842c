"""Column names, raw schema and serving contracts (M1, M4)."""

from __future__ import annotations

# The 12 expected columns of a raw trip file, in file order.
EXPECTED_COLUMNS = [
    "trip_id",
    "origin_station",
    "destination_station",
    "cargo_type",
    "cargo_weight_tons",
    "departure_time",
    "arrival_time",
    "train_id",
    "operator",
    "freight_value_brl",
    "fuel_cost_brl",
    "delay_minutes",
]

NATURAL_KEY = ["trip_id", "departure_time"]

# Serving contracts (decimal precision, varchar length, NOT NULL keys).
# Each entry: (column, spark type, nullable).
SERVING_CONTRACTS: dict[str, list[tuple[str, str, bool]]] = {
    "daily_kpis": [
        ("trip_date", "date", False),
        ("total_trips", "int", False),
        ("total_cargo_tons", "decimal(15,2)", True),
        ("total_revenue_brl", "decimal(18,2)", True),
        ("avg_revenue_per_trip", "decimal(12,2)", True),
        ("total_margin_brl", "decimal(18,2)", True),
        ("avg_duration_hours", "decimal(8,2)", True),
        ("avg_delay_min", "decimal(8,1)", True),
        ("delayed_trips", "int", True),
        ("unique_origins", "int", True),
        ("unique_trains", "int", True),
        ("on_time_rate_pct", "decimal(5,2)", True),
        ("margin_rate_pct", "decimal(5,2)", True),
    ],
    "route_performance": [
        ("origin_station", "varchar(100)", False),
        ("destination_station", "varchar(100)", False),
        ("trip_date", "date", False),
        ("total_trips", "int", True),
        ("total_tons", "decimal(15,0)", True),
        ("total_revenue_brl", "decimal(18,2)", True),
        ("avg_revenue_per_ton", "decimal(10,2)", True),
        ("avg_delay_min", "decimal(8,1)", True),
        ("avg_duration_hours", "decimal(8,2)", True),
        ("revenue_rank_daily", "int", True),
    ],
    "cargo_mix": [
        ("cargo_type", "varchar(50)", False),
        ("trip_date", "date", False),
        ("total_trips", "int", True),
        ("total_tons", "decimal(15,0)", True),
        ("total_revenue_brl", "decimal(18,2)", True),
        ("avg_revenue_per_trip", "decimal(12,2)", True),
        ("avg_revenue_per_ton", "decimal(10,2)", True),
        ("avg_delay_min", "decimal(8,1)", True),
        ("revenue_share_pct", "decimal(5,2)", True),
    ],
    "operator_ranking": [
        ("operator", "varchar(100)", False),
        ("trip_date", "date", False),
        ("total_trips", "int", True),
        ("total_revenue_brl", "decimal(18,2)", True),
        ("avg_delay_min", "decimal(8,1)", True),
        ("delayed_trips", "int", True),
        ("avg_duration_hours", "decimal(8,2)", True),
        ("on_time_rate_pct", "decimal(5,2)", True),
    ],
}

# Compound sort keys of the serving tables.
SERVING_SORT_KEYS = {
    "daily_kpis": ("trip_date",),
    "route_performance": ("trip_date", "origin_station", "destination_station"),
    "cargo_mix": ("trip_date", "cargo_type"),
    "operator_ranking": ("trip_date", "operator"),
}
