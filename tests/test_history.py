import random

from tripmart.operators import history as h


def _frame(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # skewed part (half the rows in 'A'), repeated values, NULLs
        part = "A" if rnd.random() < 0.5 else rnd.choice(["B", "C", None])
        value = None if rnd.random() < 0.05 else float(rnd.choice(range(30)))
        rows.append((i, part, value, rnd.choice(["X", "Y"]), rnd.choice(["P", "Q", None])))
    return spark.createDataFrame(
        rows, "id long, cargo_type string, freight_value_brl double, origin_station string, destination_station string"
    )


def test_scalable_percent_rank_equals_window(spark):
    df = _frame(spark)
    a = {r["id"]: r["revenue_percentile"] for r in h.percent_rank_window(df).collect()}
    for parts in (1, 3, 8):
        b = {r["id"]: r["revenue_percentile"] for r in h.percent_rank_scalable(df, num_partitions=parts).collect()}
        assert a == b


def test_percent_rank_does_not_depend_on_exchange_reuse(spark):
    df = _frame(spark, 3000)
    expected = {r["id"]: r["revenue_percentile"] for r in h.percent_rank_window(df).collect()}
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r["id"]: r["revenue_percentile"] for r in h.percent_rank_scalable(df, num_partitions=8).collect()}
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert got == expected


def test_scalable_route_history_equals_window(spark):
    df = _frame(spark)
    key = lambda r: r["id"]
    a = sorted(h.route_history_window(df).collect(), key=key)
    b = sorted(h.route_history(df).select(*h.route_history_window(df).columns).collect(), key=key)
    assert a == b


def test_single_row_partition_percent_rank_is_zero(spark):
    df = spark.createDataFrame([(1, "Z", 5.0, "X", "Y")], "id long, cargo_type string, freight_value_brl double, origin_station string, destination_station string")
    assert h.percent_rank_scalable(df).first()["revenue_percentile"] == 0.0


def test_route_statistics_are_not_made_from_the_ranked_rows(spark):
    from conftest import silver_frame
    from tripmart.operators import history
    from tripmart.session import staged

    silver = staged(silver_frame(spark, 60), "silver")
    plan = history.enrich_history(silver)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2  # the ranks and the statistics, once each
