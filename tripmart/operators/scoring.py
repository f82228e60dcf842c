"""Delay scoring.

F1 features are native expressions.  F2 runs any model with a
``predict_proba`` method through an iterator pandas UDF: Arrow batches, the
model unpickled once per Python worker, not per row.  F3 is the native
heuristic used when no model is given.  Which path ran is part of the output
(``model_used``), never a silent fallback.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.core import half_up

# The literal used for 2*pi in the hour features, and the
# model's feature order.
TWO_PI_LITERAL = 2 * 3.14159
FEATURES = [
    "cargo_weight_tons",
    "freight_value_brl",
    "fuel_cost_brl",
    "trip_duration_hours",
    "hour_sin",
    "hour_cos",
    "log_weight",
    "log_revenue",
]
SCORED_COLUMNS = ["trip_id", "trip_date", "origin_station", "destination_station", "cargo_type", "delay_probability"]


def scoring_features(df: DataFrame, hour: str = "departure_hour") -> DataFrame:
    """cyclic hour features and log features."""
    angle = F.lit(TWO_PI_LITERAL) * F.col(hour) / 24
    return df.withColumns(
        {
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
            "log_weight": F.log1p("cargo_weight_tons"),
            "log_revenue": F.log1p("freight_value_brl"),
        }
    )


def heuristic_score(
    df: DataFrame,
    weight: str = "cargo_weight_tons",
    duration: str = "trip_duration_hours",
    out: str = "delay_probability",
    compat: bool = False,
) -> DataFrame:
    """min(1, round(w/10000*0.3 + h/48*0.4 + 0.1, 4)).  NULL input
    gives NULL; ``compat=True`` lets ``least`` skip the NULL and score 1.0."""
    raw = half_up(F.col(weight) / 10000 * 0.3 + F.col(duration) / 48 * 0.4 + 0.1, 4)
    capped = F.least(F.lit(1.0), raw)
    score = capped if compat else F.when(raw.isNotNull(), capped)
    return df.withColumn(out, score.cast("double"))


class LogisticModel:
    """A small NumPy logistic model with the ``predict_proba`` interface."""

    def __init__(self, coef, intercept: float = 0.0, mean=None, scale=None):
        self.coef = np.asarray(coef, dtype=float)
        self.intercept = float(intercept)
        self.mean = np.zeros_like(self.coef) if mean is None else np.asarray(mean, dtype=float)
        self.scale = np.ones_like(self.coef) if scale is None else np.asarray(scale, dtype=float)

    def predict_proba(self, x) -> np.ndarray:
        z = ((np.asarray(x, dtype=float) - self.mean) / self.scale) @ self.coef + self.intercept
        p = 1.0 / (1.0 + np.exp(-z))
        return np.column_stack([1.0 - p, p])


def model_score(df: DataFrame, model, features=FEATURES, out: str = "delay_probability") -> DataFrame:
    """``model.predict_proba(X)[:, 1]`` per Arrow batch, ``X`` a frame with the
    features by name.  Rows with a missing feature get NULL instead of a made-up
    score.  The model is sent once per worker: it must fit a worker's memory."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(model)
    names = list(features)

    @F.pandas_udf(T.DoubleType())
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        m = bc.value
        for cols in batches:
            frame = pd.DataFrame(dict(zip(names, cols)))
            known = frame.dropna()
            scores = pd.Series(np.nan, index=frame.index)
            if not known.empty:
                scores.loc[known.index] = np.asarray(m.predict_proba(known))[:, 1]
            yield scores

    return df.withColumn(out, predict(*[F.col(c).cast("double") for c in names]))


def score(df: DataFrame, model=None, compat: bool = False) -> DataFrame:
    """Features, model or heuristic, then the scored columns plus
    ``model_used``."""
    feats = scoring_features(df)
    if model is not None and hasattr(model, "transform"):
        scored = spark_model_score(df, model).withColumn("model_used", F.lit(type(model).__name__))
    elif model is None:
        scored = heuristic_score(feats, compat=compat).withColumn("model_used", F.lit("heuristic"))
    else:
        scored = model_score(feats, model).withColumn("model_used", F.lit(type(model).__name__))
    return scored.select(*SCORED_COLUMNS, "model_used")


def fit_delay_model(df: DataFrame, label: str = "is_delayed", features=FEATURES, max_iter: int = 50):
    """Train a logistic model with distributed MLlib on rows with all
    features and a label; returns the fitted ``PipelineModel``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    train = scoring_features(df).dropna(subset=[*features, label]).withColumn(
        "_label", F.col(label).cast("double")
    )
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_x_raw"),
            StandardScaler(inputCol="_x_raw", outputCol="_x", withMean=True, withStd=True),
            LogisticRegression(featuresCol="_x", labelCol="_label", maxIter=max_iter),
        ]
    )
    return pipe.fit(train)


def to_numpy_model(pipeline_model) -> LogisticModel:
    """The fitted MLlib pipeline as a ``LogisticModel`` (8 coefficients) for
    the pandas-UDF path."""
    scaler, lr = pipeline_model.stages[1], pipeline_model.stages[2]
    return LogisticModel(
        coef=lr.coefficients.toArray(),
        intercept=lr.intercept,
        mean=scaler.mean.toArray(),
        scale=np.where(scaler.std.toArray() == 0, 1.0, scaler.std.toArray()),
    )


def spark_model_score(df: DataFrame, pipeline_model, out: str = "delay_probability") -> DataFrame:
    """F2 on the JVM: ``PipelineModel.transform`` and P(class 1).  Rows with a
    missing feature get NULL."""
    from pyspark.ml.functions import vector_to_array

    feats = scoring_features(df)
    ok = F.lit(True)
    for c in FEATURES:
        ok = ok & F.col(c).isNotNull()
    scored = pipeline_model.transform(feats.filter(ok))
    scored = scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "_x_raw", "_x", "rawPrediction", "probability", "prediction"
    )
    missing = feats.filter(~ok).withColumn(out, F.lit(None).cast("double"))
    return scored.unionByName(missing)


def formula_score(df: DataFrame, pipeline_model, out: str = "delay_probability") -> DataFrame:
    """F2 as one expression from the fitted coefficients: what ``spark_model_score``
    must give, without vectors; it can be pushed into any SQL engine."""
    m = to_numpy_model(pipeline_model)
    scale = pipeline_model.stages[1].std.toArray()
    # a constant feature is scaled to 0
    terms = [F.lit(float(c)) * (F.col(f) - F.lit(float(mu))) / F.lit(float(s)) for f, c, mu, s, sd in zip(FEATURES, m.coef, m.mean, m.scale, scale) if sd]
    z = sum(terms, F.lit(m.intercept))
    return scoring_features(df).withColumn(out, 1 / (1 + F.exp(-z)))
