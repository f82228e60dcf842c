"""Historical enrichment: W3-W5 and the H1 job body.

Two forms of each window:

* plain window functions (``*_window``), as the original job wrote them.  A
  window partition is sorted by one task, so a cargo type or route holding a
  third of all rows puts a third of the data through one task; AQE cannot
  split a window partition.
* skew-safe forms (the defaults), built from aggregates and joins:
  - route history = ``groupBy(route)`` with map-side partial aggregation,
    joined back; the join is broadcast when the route table is small (AQE
    measures it) or shuffled with AQE skew-join splitting otherwise.
  - percent_rank = exact counts per distinct (part, value) (partial
    aggregation collapses repeated values), range-partitioned by
    (part, value) so a hot part spans many tasks, local running counts per
    range partition, and per-partition offsets from a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.core import half_up, money
from tripmart.session import staged

ROUTE = ("origin_station", "destination_station")
SLICE_ROWS = 1_000_000


# ── W3: percentile of value within a part ───────────────────────────────────


def percent_rank_window(
    df: DataFrame, part: str = "cargo_type", order: str = "freight_value_brl", out: str = "revenue_percentile"
) -> DataFrame:
    """W3, plain: percent_rank() over (partition by part order by value),
    NULL values first."""
    w = Window.partitionBy(part).orderBy(F.col(order).asc_nulls_first())
    return df.withColumn(out, F.percent_rank().over(w))


def percent_rank_ranks(
    df: DataFrame, part: str = "cargo_type", order: str = "freight_value_brl", num_partitions: int | None = None
) -> DataFrame:
    """(part, value, percent_rank) for every distinct (part, value)."""
    counts = staged(df.groupBy(part, order).agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    n = num_partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), counts.count() // SLICE_ROWS + 1)
    # The slice number becomes a stored value: whatever is planned from here on,
    # with or without exchange reuse, reads the same slices.
    ranged = staged(
        counts.repartitionByRange(n, F.col(part).asc_nulls_first(), F.col(order).asc_nulls_first())
        .withColumn("_pid", F.spark_partition_id()), "value-slices")
    # running count of rows strictly before each value inside its range slice
    local_w = (
        Window.partitionBy("_pid", part)
        .orderBy(F.col(order).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.withColumn("_before_local", F.sum("_c").over(local_w) - F.col("_c"))
    # slice totals: at most (#slices + #parts) rows
    slices = ranged.groupBy("_pid", part).agg(F.sum("_c").alias("_slice_rows"))
    offset_w = Window.partitionBy(part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumns(
        {
            "_offset": F.coalesce(F.sum("_slice_rows").over(offset_w), F.lit(0)),
            "_part_rows": F.sum("_slice_rows").over(Window.partitionBy(part)),
        }
    )
    ranks = local.join(
        slices, (local["_pid"] == slices["_pid"]) & local[part].eqNullSafe(slices[part]), "inner"
    ).select(
        local[part].alias(part),
        local[order].alias(order),
        F.when(F.col("_part_rows") > 1, (F.col("_offset") + F.col("_before_local")) / (F.col("_part_rows") - 1))
        .otherwise(F.lit(0.0))
        .alias("_pr"),
    )
    return ranks


def percent_rank_scalable(
    df: DataFrame,
    part: str = "cargo_type",
    order: str = "freight_value_brl",
    out: str = "revenue_percentile",
    num_partitions: int | None = None,
) -> DataFrame:
    """W3, skew-safe: same values as ``percent_rank_window`` row for row."""
    ranks = percent_rank_ranks(df, part, order, num_partitions)
    ranks = ranks.select(F.col(part).alias("_rk_part"), F.col(order).alias("_rk_value"), F.col("_pr"))
    joined = df.join(
        ranks,
        F.col(part).eqNullSafe(F.col("_rk_part")) & F.col(order).eqNullSafe(F.col("_rk_value")),
        "left",
    )
    return joined.withColumn(out, F.col("_pr")).drop("_rk_part", "_rk_value", "_pr")


# ── W4, W5: whole-history route statistics ──────────────────────────────────


def route_history_window(df: DataFrame, route=ROUTE, value: str = "freight_value_brl") -> DataFrame:
    """W4 + W5, plain windows over the whole route partition."""
    w = Window.partitionBy(*route)
    avg = F.try_divide(F.sum(money(value)).over(w).cast("double"), F.count(value).over(w))
    return df.withColumns(
        {
            "route_avg_revenue_historical": half_up(avg, 2),
            "route_trip_count_historical": F.count(F.lit(1)).over(w),
        }
    )


def route_stats(df: DataFrame, route=ROUTE, value: str = "freight_value_brl") -> DataFrame:
    """One row per route: rounded average value and trip count."""
    return df.groupBy(*route).agg(
        half_up(F.try_divide(F.sum(money(value)).cast("double"), F.count(value)), 2).alias(
            "route_avg_revenue_historical"
        ),
        F.count(F.lit(1)).alias("route_trip_count_historical"),
    )


def route_history(df: DataFrame, route=ROUTE, value: str = "freight_value_brl", trips: DataFrame | None = None) -> DataFrame:
    """W4 + W5, skew-safe: aggregate per route, join back (NULL-safe).  ``trips``: the same
    rows from where they are cheaper to read, if ``df`` is made from them."""
    stats = route_stats(df if trips is None else trips, route, value)
    renamed = stats.select(*[F.col(c).alias(f"_rs_{c}") for c in route], *stats.columns[len(route):])
    cond = None
    for c in route:
        e = F.col(c).eqNullSafe(F.col(f"_rs_{c}"))
        cond = e if cond is None else cond & e
    return df.join(renamed, cond, "left").drop(*[f"_rs_{c}" for c in route])


def enrich_history(df: DataFrame, scalable: bool = True) -> DataFrame:
    """H1: silver + revenue_percentile + route history columns."""
    if scalable:
        return route_history(percent_rank_scalable(df), trips=df)  # the ranks add no row
    return route_history_window(percent_rank_window(df))
