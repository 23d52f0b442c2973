"""The model-based engine: training, versions, calibration, scoring."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import ml
from ledgerlake.session import scratch_path

TX = "transaction_id string, amount decimal(18,2), prior_count long, previous_location string, current_location string, device_mismatch boolean"


@pytest.fixture(scope="module")
def data(spark):
    """Fraud follows amount and device, with some noise; location and velocity say nothing."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(3000):
        amount, device = rng.randint(1, 400), rng.random() < 0.3
        rows.append((f"T{i}", amount, rng.randint(0, 6), rng.choice(["A", "B", None, ""]), rng.choice("AB"), device))
        labels.append((f"T{i}", int(rng.random() < 1 / (1 + math.exp(-(0.03 * amount + 3 * device - 9))))))
    rows = [(i, Decimal(a), v, p, c, d) for i, a, v, p, c, d in rows]
    labels += [("T1", 0), ("gone", 1), ("T2", None)]
    return ml.features(spark.createDataFrame(rows, TX)), spark.createDataFrame(labels, "transaction_id string, label int")


def test_training_publishes_a_version_that_scores_like_its_pipeline(spark, data):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    tx, labels = data
    root = scratch_path(spark, "test-model")
    model = ml.train(tx, labels, root)
    assert ml.load_model(spark, root) == model and model.trained_rows == 3000
    scored = ml.ml_score(tx, model).select("transaction_id", F.col("ml_scores")["model_score"].alias("p"))
    theirs = PipelineModel.load(model.pipeline).transform(tx).select("transaction_id", vector_to_array("probability")[1].alias("q"))
    assert scored.join(theirs, "transaction_id").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-12
    assert model.weights["device_mismatch"] > 1 and abs(model.weights["location_changed"]) < 0.6 and 0 < model.threshold < 1
    caught = ml.ml_score(tx, model).join(labels.filter("label = 1"), "transaction_id").agg(F.avg(F.col("risk_level").isin("high", "critical").cast("int"))).first()[0]
    passed = ml.ml_score(tx, model).join(labels.filter("label = 0"), "transaction_id").agg(F.avg(F.col("risk_level").isin("low", "medium").cast("int"))).first()[0]
    assert caught > 0.6 and passed > 0.9
    again = ml.FraudModel({"amount": 1.0}, 0.0, 0.5)
    assert ml.save_model(spark, again, root) == 2 and ml.load_model(spark, root).weights == {"amount": 1.0} and ml.load_model(spark, root, 1) == model


def test_threshold_is_the_best_f1(spark):
    model = ml.FraudModel({"amount": 1.0}, 0.0, 0.5)
    rows = [(math.log(p / (1 - p)), y) for p, y in [(0.9, 1.0), (0.8, 1.0), (0.7, 0.0), (0.6, 1.0), (0.3, 0.0), (0.2, 0.0)]]
    df = spark.createDataFrame([(x, 0.0, 0.0, 0.0, y) for x, y in rows], "f_amount double, f_prior_count double, f_location_changed double, f_device_mismatch double, label double")
    assert abs(ml.calibrated_threshold(df, model) - 0.6) < 0.0021
    assert ml.calibrated_threshold(df.filter("label = 0"), model) == 0.5 and ml.calibrated_threshold(df.limit(0), model) == 0.5


def test_signal_columns_and_null_features(spark):
    df = ml.features(spark.createDataFrame([("a", None, None, None, None, None), ("b", Decimal("1000"), 0, "A", "B", True)], TX))
    rows = {r["transaction_id"]: r for r in ml.ml_score(df, ml.FraudModel({"amount": 0.01, "device_mismatch": 1.0}, -3.0, 0.25)).collect()}
    p = 1 / (1 + math.exp(3))
    assert rows["a"]["ml_scores"] == pytest.approx({"model_score": p, "confidence": 1 - p}) and float(rows["a"]["risk_score"]) == round(p / 0.5, 2)
    assert (rows["a"]["risk_level"], rows["a"]["decision"]) == ("low", "approve")
    assert (rows["b"]["risk_level"], rows["b"]["decision"], rows["b"]["alerts"], rows["b"]["case_status"]) == ("critical", "block", ["ml_prediction"], "pending")
    with pytest.raises(FileNotFoundError):
        ml.load_model(spark, scratch_path(spark, "no-model"))
