"""The model-based fraud engine: train on labels, store a version, score with it.

Training reads the features of labelled transactions once (a written table), fits a ``pyspark.ml`` logistic regression on four fifths of
them (by a hash of the id) and calibrates on the rest: the decision threshold is the probability with the best F1 there. A version
holds the fitted pipeline and one row of weights, intercept and threshold; it is published by a marker written last, so a scorer sees a whole
model or the one before. Scoring needs no Python and no vector column: the probability is one expression of the stored weights, equal to the
pipeline's.

The engine gives its own signal. The probability p is put on the engines' scale so that the threshold t becomes 0.5 (p / 2t below it, 0.5 +
(p - t) / 2(1 - t) above), which makes risk_score, and with the common cuts risk_level and decision; the alert is ``ml_prediction``.
Transactions of a null feature count it as 0.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import risk
from ..sinks.tables import current_version, write_versioned

ALERT = "ml_prediction"
FEATURES = ("amount", "prior_count", "location_changed", "device_mismatch")
MODEL_ROW = "weights map<string,double>, intercept double, threshold double, trained_rows long, pipeline string"
CALIBRATION_SHARE = 5  # one of so many labelled rows calibrates
BINS = 1000


@dataclass(frozen=True)
class FraudModel:
    weights: dict[str, float]
    intercept: float
    threshold: float
    trained_rows: int = 0
    pipeline: str | None = None


def features(transactions: DataFrame, amount="amount", prior_count="prior_count", previous_location="previous_location", current_location="current_location",
             device_mismatch="device_mismatch") -> DataFrame:
    """Adds ``f_<feature>`` doubles, from the context that the rules use too."""
    previous, current = F.col(previous_location), F.col(current_location)
    changed = (F.length(previous) > 0) & (F.length(current) > 0) & (previous != current)
    values = {"amount": F.col(amount), "prior_count": F.col(prior_count), "location_changed": changed.cast("int"), "device_mismatch": F.col(device_mismatch).cast("int")}
    return transactions.withColumns({f"f_{n}": F.coalesce(values[n].cast("double"), F.lit(0.0)) for n in FEATURES})


def save_model(spark: SparkSession, model: FraudModel, root: str) -> int:
    row = spark.createDataFrame([(model.weights, model.intercept, model.threshold, model.trained_rows, model.pipeline)], MODEL_ROW)
    write_versioned(row.coalesce(1), root)
    return current_version(spark, root)


def load_model(spark: SparkSession, root: str, version: int | None = None) -> FraudModel:
    """A version of the model, by default the published one."""
    version = current_version(spark, root) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no published model under {root}")
    return FraudModel(**spark.read.schema(MODEL_ROW).parquet(f"{root.rstrip('/')}/v={version}").first().asDict())


def train(transactions: DataFrame, labels: DataFrame, root: str, key: str = "transaction_id", label: str = "label", max_iter: int = 50) -> FraudModel:
    """Fit on ``transactions`` (with ``features``) that ``labels`` (key, label 0/1) names, calibrate and publish a new version.
    An id that is labelled more than once counts as its highest label."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    spark, columns = transactions.sparkSession, [f"f_{n}" for n in FEATURES]
    known = labels.groupBy(key).agg(F.max(F.col(label).cast("double")).alias("label")).filter("label is not null")
    base = f"{root.rstrip('/')}/training/{uuid.uuid4().hex}"
    transactions.select(key, *columns).join(known, key).withColumn("part", F.pmod(F.xxhash64(key), F.lit(CALIBRATION_SHARE))).write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"),
                              LogisticRegression(maxIter=max_iter, featuresCol="features", labelCol="label")]).fit(rows.filter("part > 0"))
    fitted.write().save(f"{base}/pipeline")
    lr = fitted.stages[-1]
    model = FraudModel({n: float(w) for n, w in zip(FEATURES, lr.coefficients)}, float(lr.intercept), 0.5, rows.count(), f"{base}/pipeline")
    model = FraudModel(model.weights, model.intercept, calibrated_threshold(rows.filter("part = 0"), model), model.trained_rows, model.pipeline)
    save_model(spark, model, root)
    return model


def probability(model: FraudModel) -> Column:
    linear = F.lit(model.intercept)
    for n in FEATURES:
        linear = linear + F.lit(float(model.weights.get(n, 0.0))) * F.col(f"f_{n}")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))


def calibrated_threshold(rows: DataFrame, model: FraudModel) -> float:
    """The probability (in 1/BINS) with the best F1 over labelled rows; 0.5 without a positive one. The curve has BINS + 1 rows at most."""
    binned = rows.select(F.floor(probability(model) * BINS).alias("bin"), "label").groupBy("bin").agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n"))
    from_bin = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)  # of the binned rows
    curve = binned.select("bin", F.sum("hits").over(from_bin).alias("hits"), F.sum("n").over(from_bin).alias("n"))
    total = binned.agg(F.sum("hits")).first()[0] or 0.0
    best = curve.withColumn("f1", 2 * F.col("hits") / (F.col("n") + F.lit(total))).orderBy(F.desc("f1"), F.desc("bin")).first()
    if best is None or total == 0:
        return 0.5
    return min(max(best["bin"] / BINS, 1 / BINS), 1 - 1 / BINS)


def ml_score(transactions: DataFrame, model: FraudModel) -> DataFrame:
    """Adds the engine's risk_score, risk_level, alerts, decision, case_status and ml_scores to rows with ``features``."""
    t = model.threshold
    out = transactions.withColumn("_p", probability(model))
    scale = F.when(F.col("_p") < t, F.col("_p") / F.lit(2 * t)).otherwise(F.lit(0.5) + (F.col("_p") - F.lit(t)) / F.lit(2 * (1 - t)))
    out = out.withColumn("risk_score", F.round(scale, 2).cast("decimal(3,2)"))
    out = out.withColumns({"risk_level": risk.score_to_level("risk_score"), "alerts": F.array(F.lit(ALERT))})
    return out.withColumns({
        "decision": risk.decide("risk_level", "alerts"), "case_status": F.lit("pending"),
        "ml_scores": F.create_map(F.lit("model_score"), F.col("_p"), F.lit("confidence"), F.greatest(F.col("_p"), 1 - F.col("_p")))}).drop("_p")
