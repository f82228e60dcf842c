import numpy as np
import pytest

from conftest import silver_frame
from tripmart.operators import scoring as sc


def test_heuristic_null_policy(spark):
    df = spark.createDataFrame([(None, 10.0), (10000.0, 48.0), (100.0, 1.0)], "cargo_weight_tons double, trip_duration_hours double")
    strict = [r["delay_probability"] for r in sc.heuristic_score(df).collect()]
    compat = [r["delay_probability"] for r in sc.heuristic_score(df, compat=True).collect()]
    assert strict[0] is None and compat[0] == 1.0
    assert strict[1] == 0.8 and strict[2] == pytest.approx(round(0.003 + 1 / 48 * 0.4 + 0.1, 4))


def test_model_score_matches_numpy(spark):
    df = sc.scoring_features(silver_frame(spark, 50))
    model = sc.LogisticModel(coef=np.linspace(-1e-4, 1e-4, 8), intercept=0.1)
    out = sc.model_score(df, model).select(*sc.FEATURES, "delay_probability").collect()
    x = np.array([[r[c] for c in sc.FEATURES] for r in out])
    expected = model.predict_proba(x)[:, 1]
    assert np.allclose([r["delay_probability"] for r in out], expected)


def test_score_reports_model_used(spark):
    df = silver_frame(spark, 20)
    assert {r["model_used"] for r in sc.score(df).collect()} == {"heuristic"}
    model = sc.LogisticModel(coef=np.zeros(8))
    rows = sc.score(df, model=model).collect()
    assert {r["model_used"] for r in rows} == {"LogisticModel"}
    assert all(r["delay_probability"] == pytest.approx(0.5) for r in rows)


def test_route_clusters(spark):
    from tripmart.operators.segment import segment_routes

    clusters, report = segment_routes(silver_frame(spark, 300), k=3, min_trips=5)
    rows = clusters.collect()
    assert {r["cluster"] for r in rows} <= {0, 1, 2}
    assert sum(report["cluster_sizes"]) == len(rows)
    assert -1.0 <= report["silhouette"] <= 1.0
