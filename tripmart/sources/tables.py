"""Table scans (S3, S4) and the ``trips`` fact view shaped from the star schema.

The driver's test data is a TPC-H-like star schema; ``trips`` maps it onto the
trip fact table.  All joins are plain equi-joins: the planner broadcasts a
side only when its measured size is under the broadcast threshold (the
25-row nation table always is), and AQE re-plans the growing dimensions at
runtime from real shuffle sizes, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import tasks_for

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Extra lineitem columns carried by ``trips``: with them every row is unique,
# so the dedup order is total.
TIE_BREAK_COLUMNS = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_tax"]


_SCANS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S3: scan one Parquet input table; Catalyst prunes columns and pushes
    filters.  The scan (file listing + footer schema) is built once per
    session: the input tables are static, and every query reuses the same
    relation instead of re-listing and re-reading footers."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


_ROWS: dict[tuple[str, str], int] = {}


def rows_of(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of an input table, from its footers, once a session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir.rstrip('/')}/{name}")
    if key not in _ROWS:
        _ROWS[key] = table(spark, sf_dir, name).count()
    return _ROWS[key]


#: Orders from which their join with the line items is dealt by its rows: they are no
#: longer broadcast, and a task must not get more than it sorts in memory.
MANY_ORDERS = 500_000


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables to SQL as temp views."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip facts: one row per lineitem, typed like a bronze table."""
    t = lambda n: table(spark, sf_dir, n)
    li = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate",
    )
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    part = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    supplier = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    customer = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nation = t("nation")
    s_nation = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin_station"))
    c_nation = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("destination_station"))

    # customers join the orders, which are fewer and narrower than the line items; these
    # meet the orders last of what may be large, so a task has its trips in the order of
    # their ids; station names come when nothing is moved any more
    placed, items, tasks = orders.join(customer, "o_custkey"), li.join(part, "l_partkey"), None
    if rows_of(spark, sf_dir, "orders") > MANY_ORDERS:
        tasks = tasks_for(spark, rows_of(spark, sf_dir, "lineitem"))
        dealt = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))  # Spark joins by no fewer
        items, placed = items.repartition(dealt, "l_orderkey"), placed.repartition(dealt, "l_orderkey")
    joined = items.join(placed, "l_orderkey")
    joined = joined.coalesce(tasks) if tasks and tasks < dealt else joined
    joined = joined.join(supplier, "l_suppkey").join(s_nation, "s_nationkey").join(c_nation, "c_nationkey")
    return joined.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("trip_id"),
        "origin_station",
        "destination_station",
        F.col("p_type").alias("cargo_type"),
        F.when(F.col("l_quantity") == 50, F.lit(None).cast("double"))
        .otherwise((F.col("l_quantity") - 1) * 400)
        .alias("cargo_weight_tons"),
        F.col("o_orderdate").alias("departure_time"),
        F.col("l_shipdate").alias("arrival_time"),
        F.concat(F.lit("TRAIN-"), F.col("l_suppkey").cast("string")).alias("train_id"),
        F.col("c_mktsegment").alias("operator"),
        (F.col("l_extendedprice") - 1000).alias("freight_value_brl"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("fuel_cost_brl"),
        ((F.col("l_partkey") % 11).cast("int") * 15 - 15).alias("delay_minutes"),
        *TIE_BREAK_COLUMNS,
    )


# The cargo types the warning rule treats as known on ``trips``: all but PROMO.
TRIPS_KNOWN_CARGO = ["STANDARD", "LARGE", "SMALL", "ECONOMY", "MEDIUM"]
