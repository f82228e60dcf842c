import time

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.oracle_check import compare
from tripmart.sources.tables import TABLES

# Read-only queries, and jobs that write; the full set runs with tools/oracle_check.py.
FAST = [
    "p_refine", "q_split_quarantine", "q_reason_compat", "q_unknown_drop", "q_audit", "q10_run_counts",
    "d_dedup", "a1_daily_kpis", "a2_route_performance", "a3_cargo_mix", "a4_operator_ranking",
    "a5_route_features", "a6_daily_30d", "a7_cargo_90d", "a8_top20_routes", "w3_percent_rank_scalable",
    "h1_history", "f2_model_score", "f3_heuristic", "m4_contract_violations", "p5_prefilter_nulls", "q_amount_limit",
    "s1_corrupt", "s1_drift", "s5_events", "s5_rejected", "s8_synth",
    "s1_quoted_lines", "s1_inferred_types", "a1_a4_from_partials", "a7_from_partials",
]
JOBS = [
    "j2_refine_job", "j2_quarantine_job", "j3_gold_job", "k5_serving_roundtrip", "a9_load_counts", "m7_statistics", "m5_sorted_files",
    "m5_bucketed_join", "m6_registered_layer", "j5_score_job", "f7_clusters", "f8_cluster_sizes", "f2_spark_model_score", "j1_changed_landing",
    "t3_stream_dedup", "t4_late_days",
]
#: Seconds a query may take on sf0.001.
LIMIT = 120


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_trips" in df.columns


def test_every_query_has_an_oracle_or_is_listed_rows_only():
    from tripmart.plans.oracle import oracle_queries
    from tripmart.plans.queries import QUERIES

    assert set(QUERIES) == set(oracle_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST + JOBS)
def test_query_matches_oracle(spark, duck, name):
    began = time.monotonic()
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert time.monotonic() - began < LIMIT
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    same, _, _ = compare(rows, df.columns, res.fetchall(), dcols)
    assert same


def test_marts_are_written_by_several_tasks(spark):
    from pyspark.sql import functions as F

    from tripmart.operators import sinks
    from tripmart.session import scratch_path

    path = scratch_path(spark, "tasks")
    df = spark.range(600).select((F.col("id") % 60).cast("string").alias("trip_month"), "id")
    sinks.overwrite_partitioned(df, path, "trip_month", tasks=sinks.slots(spark))
    names = [r[0].rsplit("/", 1)[1].split("-")[1] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()]
    assert len(names) == 60 and len(set(names)) == sinks.slots(spark)
