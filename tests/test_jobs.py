import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import silver_frame
from tripmart.operators import marts, serve, sinks
from tripmart.plans import jobs
from tripmart.schema import SERVING_CONTRACTS
from tripmart.session import scratch_path
from tripmart.sources.synth import synthesize


def bronze_of(spark, change=None, n=60):
    raw = synthesize(spark.range(n).withColumnRenamed("id", "k"), ["k"], days=3)
    raw = raw.withColumn("_ingestion_timestamp", F.lit("2024-01-09T00:00:00+00:00")).withColumn("_ingestion_date", F.lit("2024-01-09").cast("date"))
    return change(raw) if change else raw


def run(spark, root, df):
    sinks.overwrite(df, f"{root}/bronze")
    return jobs.refine_job(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine")


def sane(df):
    return df.withColumns({"cargo_weight_tons": F.lit(10.0), "freight_value_brl": F.lit(5.0), "departure_time": F.lit("2024-01-02 05:00:00"), "arrival_time": F.lit("2024-01-02 09:00:00")})


def test_input_without_a_bad_row(spark):
    root = scratch_path(spark, "clean")
    counts = run(spark, root, bronze_of(spark, sane))
    assert (counts["rows_read"], counts["rows_clean"], counts["rows_quarantined"], counts["duplicates_removed"]) == (60, 60, 0, 0)
    assert spark.read.parquet(f"{root}/silver").count() == 60


def test_input_without_a_good_row(spark):
    root = scratch_path(spark, "bad")
    counts = run(spark, root, bronze_of(spark, lambda d: d.withColumn("cargo_weight_tons", F.lit(-1.0))))
    assert (counts["rows_clean"], counts["rows_quarantined"]) == (0, 60)


def test_empty_input(spark):
    counts = run(spark, scratch_path(spark, "empty"), bronze_of(spark).limit(0))
    assert (counts["rows_read"], counts["rows_clean"], counts["rows_quarantined"]) == (0, 0, 0)


def test_second_run_leaves_nothing_stale(spark):
    root = scratch_path(spark, "rerun")
    run(spark, root, bronze_of(spark, sane).unionByName(bronze_of(spark, lambda d: sane(d).withColumns({"trip_id": F.lit("old"), "departure_time": F.lit("2024-01-01 05:00:00")}))))
    assert spark.read.parquet(f"{root}/silver").select("trip_date").distinct().count() == 2
    run(spark, root, bronze_of(spark, lambda d: sane(d).withColumn("delay_minutes", F.when(F.col("train_id") > "BR-5", -1).otherwise(0))))
    silver = spark.read.parquet(f"{root}/silver")
    assert silver.select("trip_date").distinct().collect()[0][0] == dt.date(2024, 1, 2)
    assert silver.count() + spark.read.parquet(f"{root}/quarantine").count() == 60


def test_touched_days_are_replaced_and_emptied_ones_deleted(spark):
    path = scratch_path(spark, "days")
    df = spark.range(30).select((F.col("id") % 3).cast("string").alias("trip_date"), "id")
    sinks.overwrite_partitioned(df, path)
    sinks.replace_partitions(df.filter("trip_date = '1' and id < 9"), path, ["1", "2"])
    left = {str(r[0]): r[1] for r in spark.read.parquet(path).groupBy("trip_date").count().collect()}
    assert left == {"0": 10, "1": 3}


def test_load_is_refused_or_routed(spark):
    rows = [("A" * 101, "2024-01-01", 1, 10.0), (None, "2024-01-01", 1, 10.0), ("RUMO", "2024-01-01", 1, 1e20), ("VLI", "2024-01-02", 2, 7.5)]
    df = spark.createDataFrame(rows, "operator string, d string, total_trips long, total_revenue_brl double").select(
        "operator", F.col("d").cast("date").alias("trip_date"), "total_trips", "total_revenue_brl", F.lit(0.0).alias("avg_delay_min"),
        F.lit(0).alias("delayed_trips"), F.lit(1.0).alias("avg_duration_hours"), F.lit(100.0).alias("on_time_rate_pct"))
    root = scratch_path(spark, "gate")
    with pytest.raises(serve.ContractError, match="operator_ranking.operator: 1 missing, 0 out of range, 1 too long"):
        serve.publish(spark, {"operator_ranking": df}, root, "refused_")
    assert not spark.catalog.tableExists("refused_operator_ranking")
    out = serve.publish(spark, {"operator_ranking": df}, root, "routed_", on_violation="route").collect()
    assert [tuple(r) for r in out] == [("routed_operator_ranking", 1)]
    assert spark.read.parquet(f"{root}/rejected/operator_ranking").count() == 3


def test_layer_gets_new_columns(spark):
    path, name = scratch_path(spark, "layer"), "layer_with_drift"
    sinks.overwrite_partitioned(spark.range(4).select("id", F.lit("2024-01-01").alias("trip_date")), path)
    assert serve.register_layer(spark, name, path) == []
    sinks.overwrite_partitioned(spark.range(2).select("id", F.lit(7).alias("extra"), F.lit("2024-01-02").alias("trip_date")), path)
    assert serve.register_layer(spark, name, path) == ["extra"]
    assert spark.table(name).agg(F.count("*"), F.sum("extra")).first()[:] == (6, 14)


def test_command_line(spark, capsys):
    from pyspark.ml import PipelineModel  # noqa: F401  the saved kind
    from tripmart.operators.scoring import fit_delay_model

    root = scratch_path(spark, "cli")
    sinks.overwrite_partitioned(silver_frame(spark, 400), f"{root}/silver")
    fit_delay_model(spark.read.parquet(f"{root}/silver"), max_iter=3).write().save(f"{root}/model")
    calls = [
        ["--mode", "gold", "--output", f"{root}/gold"],
        ["--mode", "score", "--output", f"{root}/scores"],
        ["--mode", "score", "--output", f"{root}/model-scores", "--model", f"{root}/model"],
        ["--mode", "report", "--output", f"{root}/report", "--report", "top_routes", "--as-of", "2024-01-10"],
    ]
    outs = []
    for call in calls:
        assert jobs.main([*call, "--input", f"{root}/silver"]) == 0
        outs.append(json.loads(capsys.readouterr().out.strip().splitlines()[-1]))
    assert set(outs[0]) == {f"gold_{k}" for k in SERVING_CONTRACTS}
    assert outs[1]["model_used"] == "heuristic" and outs[2]["model_used"] == "PipelineModel"
    assert outs[3]["rows"] == 20


def test_both_sides_without_the_rows_that_do_not_reach_them(spark):
    from tripmart.operators.refine import cast_types
    from tripmart.plans import pipeline

    raw = bronze_of(spark, n=200)
    # copies: a worse and a newer one, equal ones from two sources, all of them bad, keys without values
    bad = raw.filter("train_id > 'BR-5'").withColumn("cargo_weight_tons", F.lit(None).cast("double"))
    newer = raw.filter("train_id < 'BR-4'").withColumns({"operator": F.lit("NEW"), "_ingestion_timestamp": F.lit("2024-01-10T00:00:00+00:00")})
    nobody = raw.limit(30).withColumns({"trip_id": F.lit(None).cast("string"), "departure_time": F.lit(None).cast("string")})
    every = raw.unionByName(bad).unionByName(newer).unionByName(nobody).withColumn("_source_path", F.lit("a"))
    every = every.unionByName(raw.withColumn("_source_path", F.lit("b"))).withColumn("_source_path", F.concat("_source_path", "operator"))
    rows = lambda df: sorted(map(repr, df.collect()))
    for on_unknown in ("quarantine", "drop"):
        flagged = pipeline.flag_and_dedup(every, None, on_unknown)
        silver, quar = pipeline.split_silver(flagged, None, on_unknown=on_unknown)
        got = pipeline.clean_silver(cast_types(every))
        assert got.schema == silver.schema and rows(got) == rows(silver)
        rest = pipeline.rejected(cast_types(every), None, on_unknown)
        assert rows(rest) == rows(flagged.filter("_dq_status <> 'clean'")) and rest.columns == flagged.columns
        root = scratch_path(spark, "sides")
        sinks.overwrite(every, f"{root}/bronze")
        counts = jobs.refine_job(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", on_unknown=on_unknown)
        by = flagged.groupBy("_dq_status").count().rdd.collectAsMap()
        assert counts == {"rows_read": every.count(), "duplicates_removed": every.count() - flagged.count(), "rows_clean": by["clean"],
                          "rows_quarantined": by.get("quarantine", 0), "rows_dropped": by.get("dropped", 0)}
        assert rows(spark.read.parquet(f"{root}/silver").select(*silver.columns)) == rows(silver)
        assert rows(spark.read.parquet(f"{root}/quarantine").select(*quar.columns)) == rows(quar)


def test_refine_job_moves_rows_once_for_each_output(spark):
    import glob

    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{base.removeprefix('file:')}/tripmart/flagged-*"))
    root = scratch_path(spark, "once")
    run(spark, root, bronze_of(spark, n=400))
    assert set(glob.glob(f"{base.removeprefix('file:')}/tripmart/flagged-*")) == before  # nothing is written to be read back
    days = glob.glob(f"{root.removeprefix('file:')}/silver/trip_date=*")
    assert len(days) > 1 and all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in days)


def test_trips_are_the_same_when_dealt_by_their_number(spark, monkeypatch):
    from conftest import SF_SMALL
    from tripmart.sources import tables

    want = sorted(map(repr, tables.trips(spark, SF_SMALL).collect()))
    monkeypatch.setattr(tables, "MANY_ORDERS", 0)
    monkeypatch.setattr(tables, "tasks_for", lambda spark, rows: 3)
    dealt = tables.trips(spark, SF_SMALL)
    assert sorted(map(repr, dealt.collect())) == want
    assert dealt.rdd.getNumPartitions() == 3


def test_only_the_columns_of_the_marts_are_cached(spark, monkeypatch):
    root, cached = scratch_path(spark, "cached"), []
    silver = silver_frame(spark, 40)
    silver.write.parquet(f"{root}/silver")
    monkeypatch.setattr(type(silver), "persist", lambda df, *level: cached.append(df.columns) or df)
    with_cache = jobs.build_marts(spark, f"{root}/silver", f"{root}/a", cache=True)
    assert cached == [list(marts.INPUTS)] and with_cache == jobs.build_marts(spark, f"{root}/silver", f"{root}/b")
    for name in marts.MARTS:
        one, two = (spark.read.parquet(f"{root}/{x}/{name}") for x in "ab")
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_a_rerun_holds_one_bronze(spark, monkeypatch):
    from conftest import SF_SMALL
    from tripmart.plans import queries

    held = []

    def refined(_, bronze, *args, **kwargs):
        held.append(sinks.exists(spark, bronze[:-1] + "0"))
        if len(held) == 2:
            raise InterruptedError
    monkeypatch.setattr(queries.jobs, "refine_job", refined)
    with pytest.raises(InterruptedError):
        queries.j2_rerun_shrunk_bronze(spark, SF_SMALL)
    assert held == [True, False]
