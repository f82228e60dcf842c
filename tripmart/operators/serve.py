"""Typed serving tables.

A contract lists column, type and nullability.  ``conform`` casts with
``try_cast`` and ``contract_violations`` counts what the serving store would
reject: NULL in a NOT NULL column, values lost to a too-small decimal, text
longer than its varchar.  Spark does not enforce NOT NULL on a Parquet table,
so the count is the check.

``publish`` (J7) loads each table as a new version beside the old one and switches the
name, a view, when all versions are in place.  ``load`` keeps one table in monthly
partitions for incremental loads (K6).
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.functions.core import half_up
from tripmart.operators.sinks import MONTH, layout, observed_rows, remove, slots
from tripmart.schema import SERVING_CONTRACTS, SERVING_SORT_KEYS

_VARCHAR = re.compile(r"varchar\((\d+)\)")


def _spark_type(t: str) -> str:
    return "string" if _VARCHAR.fullmatch(t) else t


def conform(df: DataFrame, contract) -> DataFrame:
    """Select the contract's columns in order, cast to its types."""
    return df.select(*[F.col(c).try_cast(_spark_type(t)).alias(c) for c, t, _ in contract])


def contract_violations(df: DataFrame, contract, table_name: str) -> DataFrame:
    """M4: one row per contract column: NOT NULL violations, values that a
    cast turned into NULL (overflow / unparsable) and too-long text."""
    aggs = []
    for c, t, nullable in contract:
        cast = F.col(c).try_cast(_spark_type(t))
        m = _VARCHAR.fullmatch(t)
        aggs += [
            (F.count_if(F.col(c).isNull()) if not nullable else F.lit(0).cast("bigint")).alias(f"{c}__nn"),
            F.count_if(F.col(c).isNotNull() & cast.isNull()).alias(f"{c}__lost"),
            (F.count_if(F.length(F.col(c)) > int(m.group(1))) if m else F.lit(0).cast("bigint")).alias(f"{c}__len"),
        ]
    counts = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(f"{c}__nn").alias("not_null_violations"),
            F.col(f"{c}__lost").alias("cast_lost_values"),
            F.col(f"{c}__len").alias("too_long_values"),
        )
        for c, _, _ in contract
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def create_table(spark: SparkSession, name: str, contract, location: str, month_col: str = MONTH):
    """M6: external Parquet table with the contract's columns + loaded_at, in
    monthly partitions: marts are small, a partition a day would be a file a row."""
    cols = ", ".join(f"`{c}` {_spark_type(t)}" for c, t, _ in contract)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, loaded_at TIMESTAMP, `{month_col}` STRING) USING parquet "
        f"PARTITIONED BY (`{month_col}`) LOCATION '{location}'"
    )


def register_layer(spark: SparkSession, name: str, path: str, partitioned: bool = True) -> list[str]:
    """M6: expose a layer directory as a table and refresh its partitions.
    Columns that newer files added are added to the table; columns they lack stay.
    Returns the names of the added columns."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    known = set(spark.table(name).columns)
    added = [f for f in spark.read.option("mergeSchema", "true").parquet(path).schema.fields if f.name not in known]
    if added:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return [f.name for f in added]


def row_violates(contract):
    """M4 as a row condition: what the serving store would reject."""
    bad = F.lit(False)
    for c, t, nullable in contract:
        m = _VARCHAR.fullmatch(t)
        if not nullable:
            bad = bad | F.col(c).isNull()
        if m:
            bad = bad | F.coalesce(F.length(F.col(c)) > int(m.group(1)), F.lit(False))
        else:
            bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(_spark_type(t)).isNull())
    return bad


class ContractError(ValueError):
    """A load was refused; the message names table, columns and counts."""


def load(spark: SparkSession, df: DataFrame, table: str, contract, full_refresh: bool = True, sort_cols=()) -> None:
    """K5 (``full_refresh``: truncate-and-load) or K6 (incremental: the months in
    ``df`` are replaced, so ``df`` must hold them whole), sorted by the table's
    compound key."""
    key = tuple(sort_cols) or ("trip_date",)
    typed = conform(df, contract).withColumns({"loaded_at": F.current_timestamp(), MONTH: F.date_format("trip_date", "yyyy-MM")})
    cols = [c for c, _, _ in contract] + ["loaded_at", MONTH]  # insertInto matches by position
    name = "spark.sql.sources.partitionOverwriteMode"
    path = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    writer = layout(typed.select(*cols), (MONTH,), key, tasks=slots(spark)).write.partitionBy(MONTH).mode("overwrite")
    writer.option(name.rsplit(".", 1)[1], "static" if full_refresh else "dynamic").parquet(path)
    if full_refresh:
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():  # one row a month
            k, v = row["partition"].split("=", 1)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({k}='{v}')")
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def whole_months(df: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of ``df`` in a month that ``touched`` has a trip_date in."""
    months = touched.select(F.date_format("trip_date", "yyyy-MM").alias("_m")).distinct()
    return df.join(months, F.date_format("trip_date", "yyyy-MM") == F.col("_m"), "left_semi")


def analyze(spark: SparkSession, table: str) -> None:
    """M7: table and column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def load_counts(spark: SparkSession, tables) -> DataFrame:
    """A9 + U1: row count per table, stacked."""
    parts = [
        spark.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in tables
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ── versions: load beside, check, then switch ────────────────────────────────

#: Distribution key of all serving tables and how many files each is dealt into by it.
DISTRIBUTION_KEY, BUCKETS = "trip_date", 16
_VERSION = re.compile(r".*__v(\d+)")


def write_version(spark: SparkSession, df: DataFrame, name: str, contract, location: str, sort_cols=(), buckets: int = BUCKETS) -> int:
    """K5 + M5: the typed rows as a table of their own, dealt by the distribution key
    into ``buckets`` files that are sorted by the compound key; returns its rows.

    Joins of such tables on the key, and windows and aggregates by it, need no
    exchange.  All rows of a key lie in one file: the key must be spread (a mart has at
    most a few thousand rows a day)."""
    typed = conform(df, contract).withColumn("loaded_at", F.current_timestamp())
    keys = tuple(sort_cols) or (DISTRIBUTION_KEY,)
    obs = Observation("version-" + name)
    dealt = typed.repartition(buckets, DISTRIBUTION_KEY).observe(obs, F.count(F.lit(1)).alias("rows"))
    dealt.write.format("parquet").bucketBy(buckets, DISTRIBUTION_KEY).sortBy(*keys).option("path", location).saveAsTable(name)
    return observed_rows(obs)


def versions(spark: SparkSession, name: str) -> list[str]:
    """Tables with the versions of a serving table, oldest first."""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{name}__v*'").collect()]
    return sorted(t for t in found if _VERSION.fullmatch(t) and t.rsplit("__v", 1)[0] == name)


def current(spark: SparkSession, name: str) -> str | None:
    """The version that readers of ``name`` see."""
    if not spark.catalog.tableExists(name):
        return None
    row = spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key = 'tripmart.version'").first()
    return row["value"] if row else None


def switch(spark: SparkSession, name: str, version: str) -> None:
    """Let ``name`` show ``version``: one change of the catalog.  Queries that already
    run go on with the files of the version they began with."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a table from before versions; its files stay
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('tripmart.version' = '{version}') AS SELECT * FROM {version}")


def _shown(spark: SparkSession, name: str) -> list[str]:
    """Versions that readers have seen, oldest first; a load that died left none."""
    return [v for v in versions(spark, name) if spark.sql(f"SHOW TBLPROPERTIES {v}").filter("key = 'tripmart.shown'").first()]


def roll_back(spark: SparkSession, name: str) -> str:
    """Let ``name`` show the version before the one it shows; returns that version."""
    now = current(spark, name)
    older = [v for v in _shown(spark, name) if now is not None and v < now]
    if not older:
        raise ValueError(f"{name} has no older version")
    switch(spark, name, older[-1])
    return older[-1]


def clean_up(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Delete tables and files of versions that were never shown, and of those older than
    the ``keep`` newest up to the one that is shown; returns the deleted ones."""
    now, shown = current(spark, name), _shown(spark, name)
    if now is None:
        return []
    kept = {*[v for v in shown if v <= now][-max(1, keep) :], *[v for v in shown if v > now]}
    gone = [v for v in versions(spark, name) if v not in kept]
    for version in gone:
        path = spark.sql(f"DESCRIBE FORMATTED {version}").filter("col_name = 'Location'").first()["data_type"]
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        remove(spark, path)
    return gone


def publish(
    spark: SparkSession, marts: dict[str, DataFrame], root: str, prefix: str = "serving_", on_violation: str = "refuse",
    buckets: int = BUCKETS, keep: int = 2,
) -> DataFrame:
    """Count contract violations, load the typed tables as new versions, analyze
    them, and only then show them to readers; returns the row counts of what is shown.

    Any violation in any table refuses the whole load (``refuse``), or sends the
    offending rows to ``<root>/rejected/<table>`` (``route``).  Until the last table is
    loaded and its rows are counted, readers see the old versions; a run that dies
    leaves them as they are.  ``keep`` versions stay for :func:`roll_back`."""
    if on_violation not in ("refuse", "route"):
        raise ValueError("on_violation must be 'refuse' or 'route'")
    found = []
    for key, df in marts.items():
        report = contract_violations(df, SERVING_CONTRACTS[key], key)
        bad = report.filter("not_null_violations + cast_lost_values + too_long_values > 0")
        found += [tuple(r) for r in bad.collect()]  # at most a row a column
    if found and on_violation == "refuse":
        raise ContractError("; ".join(f"{t}.{c}: {a} missing, {b} out of range, {n} too long" for t, c, a, b, n in found))
    touched = {t for t, *_ in found}
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    loaded = {}
    for key, df in marts.items():
        contract, name = SERVING_CONTRACTS[key], f"{prefix}{key}"
        if key in touched:
            bad = row_violates(contract)
            df.filter(bad).write.mode("overwrite").parquet(f"{root}/rejected/{key}")
            df = df.filter(~bad)
        version = f"{name}__v{stamp}"
        written = write_version(spark, df, version, contract, f"{root}/{key}/v{stamp}", SERVING_SORT_KEYS[key], buckets)
        analyze(spark, version)
        if spark.table(version).count() != written:
            raise ContractError(f"{version}: {written} rows written, others read back")
        loaded[name] = version
    for name, version in loaded.items():
        spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('tripmart.shown' = 'true')")
        switch(spark, name, version)
    for name in loaded:
        clean_up(spark, name, keep)
    return load_counts(spark, list(loaded))


def with_day_totals(spark: SparkSession, rows: str, days: str, amount: str = "total_revenue_brl") -> DataFrame:
    """A serving table joined with the daily KPIs on the distribution key: each row's
    share of its day and its rank in it.  Both sides are dealt alike, so the plan has
    no exchange."""
    day = spark.table(days).select(DISTRIBUTION_KEY, F.col(amount).alias("day_amount"))
    of_day = Window.partitionBy(DISTRIBUTION_KEY).orderBy(F.col(amount).desc_nulls_last())
    joined = spark.table(rows).drop("loaded_at").join(day.hint("merge"), DISTRIBUTION_KEY)
    share = half_up(F.try_divide(F.col(amount).cast("double"), F.col("day_amount").cast("double")) * 100, 2)
    return joined.withColumns({"share_of_day_pct": share, "rank_in_day": F.rank().over(of_day)}).drop("day_amount")
