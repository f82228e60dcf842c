"""Route features and clustering.

The route table is one hash aggregation over silver (map-side partial, so a
hot route costs one row per task).  Clustering runs distributed MLlib on it:
VectorAssembler -> StandardScaler (mean 0, sample std 1) -> KMeans.  Only the
k centres and the quality numbers come back to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.core import exact_avg
from tripmart.session import staged

ROUTE = ("origin_station", "destination_station")
# Names of the route features.
FEATURES = ["trip_count", "avg_weight", "avg_revenue", "avg_delay", "avg_duration", "cargo_diversity"]


def route_features(df: DataFrame, min_trips: int = 10) -> DataFrame:
    """A5 + P23: per route over all history; routes with fewer than
    ``min_trips`` trips are left out."""
    return (
        df.groupBy(*ROUTE)
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            exact_avg("cargo_weight_tons").alias("avg_weight"),
            exact_avg("freight_value_brl").alias("avg_revenue"),
            exact_avg("delay_minutes").alias("avg_delay"),
            exact_avg("trip_duration_hours").alias("avg_duration"),
            F.count_distinct("cargo_type").alias("cargo_diversity"),
        )
        .filter(F.col("trip_count") >= min_trips)
    )


def cluster_pipeline(k: int = 6, seed: int = 42, max_iter: int = 100) -> Pipeline:
    """F5-F7 as one MLlib pipeline."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features_raw", handleInvalid="error"),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
            KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=max_iter),
        ]
    )


def segment_routes(df: DataFrame, k: int = 6, seed: int = 42, max_iter: int = 100, min_trips: int = 10):
    """Returns ``(clusters, report)``; clusters = route features +
    ``cluster`` with the vectors dropped; report = silhouette, sizes, k, centres.

    Labels are numbered by the clusters' centres, from the fewest trips a route up (then
    by the other features), so they do not depend on where k-means began."""
    # a row a route: staged once for scaler, k-means, evaluator and output
    routes = staged(route_features(df, min_trips), "routes")
    model = cluster_pipeline(k, seed, max_iter).fit(routes)
    scored = model.transform(routes)
    silhouette = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(scored)
    scaler, km = model.stages[-2], model.stages[-1]
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    raw = [tuple(float(x) for x in np.asarray(c) * std + mean) for c in km.clusterCenters()]  # in the units of the features
    order = sorted(range(len(raw)), key=lambda i: raw[i])
    label = {old: new for new, old in enumerate(order)}
    number = F.element_at(F.create_map(*[F.lit(x) for pair in label.items() for x in pair]), F.col("cluster"))
    report = {
        "silhouette": float(silhouette),
        "cluster_sizes": [int(km.summary.clusterSizes[i]) for i in order],
        "k": k,
        "centres": [raw[i] for i in order],
        "scale": [float(x) for x in std],
    }
    return scored.withColumn("cluster", number.cast("int")).drop("features_raw", "features"), report


def centre_table(spark: SparkSession, report: dict) -> DataFrame:
    """The centres as rows: cluster, routes, and a column a feature in its own units."""
    rows = [(i, n, *centre) for i, (n, centre) in enumerate(zip(report["cluster_sizes"], report["centres"]))]
    return spark.createDataFrame(rows, "cluster int, routes long, " + ", ".join(f"{f} double" for f in FEATURES))


def nearest_centre(clusters: DataFrame, centres: DataFrame, scale) -> DataFrame:
    """Adds ``nearest``: the cluster whose written centre is nearest to each route in
    scaled features (ties to the smaller number)."""
    listed = centres.agg(F.sort_array(F.collect_list(F.struct("cluster", *FEATURES))).alias("_centres"))  # k rows
    square = lambda c: sum((((F.col(f).cast("double") - c[f]) / (s or 1.0)) ** 2 for f, s in zip(FEATURES, scale)), F.lit(0.0))
    away = F.transform("_centres", lambda c: F.struct(square(c).alias("d"), c["cluster"].alias("cluster")))
    return clusters.join(F.broadcast(listed)).withColumn("nearest", F.array_min(away)["cluster"]).drop("_centres")
