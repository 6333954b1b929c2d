"""Splits that repeat, models that beat a guess on a planted signal, metrics."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import functions as F

from sendero.operators import learning as le


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1200, 3))
    frame = pd.DataFrame(x, columns=["a", "b", "c"])
    frame["y"] = 3 * frame.a - 2 * frame.b + rng.normal(scale=0.1, size=1200)
    frame["kind"] = ((frame.a > 0).astype(int) + 2 * (frame.b > 0.3).astype(int)).astype(float)
    frame["id"] = range(1200)
    return le.assemble(spark.createDataFrame(frame), ["a", "b", "c"]).cache()


def test_assemble_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert le.assemble(df, ["a", "b"], invalid="skip").count() == 1
    with pytest.raises(Exception, match="null"):
        le.assemble(df, ["a", "b"]).collect()


def test_split_is_complete_and_repeats(planted):
    train, test = le.split(planted, ["id"], 0.7, 3)
    ids = [{r.id for r in part.select("id").collect()} for part in (train, test)]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 1200 and 770 < len(ids[0]) < 910
    again, _ = le.split(planted.repartition(7), ["id"], 0.7, 3)
    assert {r.id for r in again.select("id").collect()} == ids[0]
    other, _ = le.split(planted, ["id"], 0.7, 4)
    assert {r.id for r in other.select("id").collect()} != ids[0]
    assert 900 < le.sample_rows(planted, ["id"], 0.8).count() < 1020


def test_tree_classifier_and_saved_model(planted, tmp_path):
    train, test = le.split(planted, ["id"], 0.7)
    model = le.tree_classifier(train, "kind", 8)
    predictions = model.transform(test)
    score = le.accuracy(predictions, "kind")
    row = le.accuracy_table(predictions, "kind").first()
    assert score > 0.9 and row.accuracy == pytest.approx(score) and row.error == pytest.approx(1 - score)
    loaded = DecisionTreeClassificationModel.load(le.save_model(model, f"{tmp_path}/m"))
    assert le.accuracy(loaded.transform(test), "kind") == score


@pytest.mark.parametrize("shares, depths", [([0.6, 0.8], [1, 2, 4, 7]), ([0.7], [3])])
def test_depths_of_one_tree_equal_trees_of_their_own(planted, shares, depths):
    noise = F.when(F.md5(F.col("id").cast("string")) < "4", 3.0 - F.col("kind")).otherwise(F.col("kind"))  # so that deep trees go astray
    noisy = planted.withColumn("kind", noise)
    got = [tuple(r) for r in le.grid_search(noisy, ["id"], "kind", shares, depths).orderBy("trial").collect()]
    want = []
    for share in shares:
        train, test = le.split(noisy, ["id"], share)
        for depth in depths:
            want.append((len(want), share, depth, le.accuracy(le.tree_classifier(train, "kind", depth).transform(test), "kind")))
    assert got == [(*w[:3], pytest.approx(w[3], abs=1e-12)) for w in want]
    assert len({a for *_, a in got}) > len(got) / 2


def test_depths_of_a_tree_with_categories(spark):
    rows = spark.createDataFrame([(i, float(i % 5), float(i % 7), float((i % 5 in (1, 4)) + 2 * (i % 7 > 2))) for i in range(400)],
                                 "id int, c double, x double, kind double")
    marked = rows.withColumn("c", F.col("c").alias("c", metadata={"ml_attr": {"type": "nominal", "name": "c", "vals": list("abcde")}}))
    data = le.assemble(marked, ["c", "x"])
    model = le.tree_classifier(data, "kind", 4)
    assert le.tree_nodes(spark, model).where("below is not null").count() > 0
    got = le.accuracy_by_depth(model, data, "kind", [0, 1, 2, 4])
    assert got == pytest.approx({d: le.accuracy(le.tree_classifier(data, "kind", d).transform(data), "kind") for d in (0, 1, 2, 4)})
    assert np.isnan(le.accuracy_by_depth(model, data.where("id < 0"), "kind", [2])[2])


@pytest.mark.parametrize("penalty, l1_share", [(0.0, 0.5), (0.3, 0.8), (1.0, 0.0), (1.0, 1.0), (50.0, 0.8)])
def test_elastic_net_equals_sparks(planted, penalty, l1_share):
    from pyspark.ml.regression import LinearRegression
    shifted = planted.withColumns({"a": F.col("a") * 100 + 5000, "k": F.lit(7.0), "c": F.col("c") + F.col("a") / 2}).drop("features")
    data = le.assemble(shifted, ["a", "b", "c", "k"])
    fit = le.elastic_net(shifted, ["a", "b", "c", "k"], "y", penalty, l1_share, rounds=500)
    theirs = LinearRegression(labelCol="y", regParam=penalty, elasticNetParam=l1_share, maxIter=500, tol=1e-12).fit(data)
    assert list(fit.coefficients.values()) == pytest.approx(theirs.coefficients.toArray().tolist(), abs=1e-4)
    assert fit.intercept == pytest.approx(theirs.intercept, abs=1e-2)
    assert all(a >= b - 1e-12 for a, b in zip(fit.objective, fit.objective[1:])) and fit.objective[0] == 0.5
    assert fit.rounds < 500 and fit.coefficients["k"] == 0
    mine = le.regression_table(shifted.withColumn("prediction", fit.predict()), "y").first()
    assert mine.rmse == pytest.approx(le.regression_metric(theirs.transform(data), "y", "rmse"), abs=1e-4)


def test_elastic_net_of_odd_rows(spark):
    schema = "a double, b double, y double"
    rows = [(1.0, 2.0, 3.0), (2.0, 2.5, 5.0), (3.0, 1.0, 7.0), (None, 1.0, 100.0), (1.0, None, 100.0), (1.0, 1.0, None)]
    fit = le.elastic_net(spark.createDataFrame(rows, schema), ["a", "b"], "y", penalty=0.0, rounds=200)
    assert fit.coefficients == pytest.approx({"a": 2.0, "b": 0.0}, abs=1e-6) and fit.intercept == pytest.approx(1.0, abs=1e-5)
    flat = le.elastic_net(spark.createDataFrame([(1.0, 2.0, 4.0), (2.0, 3.0, 4.0)], schema), ["a", "b"], "y")
    assert flat.coefficients == {"a": 0.0, "b": 0.0} and flat.intercept == 4.0
    none = le.elastic_net(spark.createDataFrame([], schema), ["a", "b"], "y")
    assert np.isnan(none.intercept)


def test_linear_regression(planted):
    train, test = le.split(planted, ["id"], 0.8)
    model = le.linear_regression(train, "y")
    summary = le.regression_summary(model)
    assert summary["coefficients"][0] > 2 and summary["coefficients"][1] < -1 and summary["r2"] > 0.9
    assert summary["iterations"] <= 10 and len(summary["objective"]) >= 2
    assert le.residuals(model).count() == train.count()
    predictions = model.transform(test)
    row = le.regression_table(predictions, "y").first()
    assert row.rmse == pytest.approx(le.regression_metric(predictions, "y", "rmse"))
    assert row.r2 == pytest.approx(le.regression_metric(predictions, "y", "r2"))


@pytest.mark.parametrize("fit", [le.tree_regressor, le.boosted_regressor])
def test_tree_regressors(planted, fit):
    train, test = le.split(planted, ["id"], 0.8)
    predictions = fit(train, "y").transform(test)
    mean = train.agg(F.avg("y")).first()[0]
    guess = test.select("y", F.lit(mean).alias("prediction"))
    assert le.regression_metric(predictions, "y", "rmse") < 0.5 * le.regression_metric(guess, "y", "rmse")


def test_grid_search_prefers_the_first_of_equals(spark, planted):
    trials = le.grid_search(planted, ["id"], "kind", [0.7, 0.8], [1, 5], parallelism=2)
    got = [(r.trial, r.train_share, r.depth) for r in trials.orderBy("trial").collect()]
    assert got == [(0, 0.7, 1), (1, 0.7, 5), (2, 0.8, 1), (3, 0.8, 5)]
    assert le.best_trial(trials).first().depth == 5
    same = spark.createDataFrame([(0, 0.7, 3, 0.5), (1, 0.7, 4, 0.9), (2, 0.8, 3, 0.9)], trials.schema)
    assert le.best_trial(same).first().trial == 1


def test_boosting_fits_rows_of_equal_features_once(spark, monkeypatch):
    fitted, learner = [], le.GBTRegressor

    class Counted(learner):
        def fit(self, rows):
            fitted.append(rows.count())
            return super().fit(rows)
    monkeypatch.setattr(le, "GBTRegressor", Counted)
    rows = le.assemble(spark.range(0, 4000, 1, 4).select(
        (F.col("id") % 7).alias("x"), (F.col("id") % 5).alias("y"),
        (F.col("id") % 7 * 3 + F.pow(F.col("id") % 5, F.lit(2.0)) + F.col("id") % 11 / 10).alias("label")), ["x", "y"])
    found = le.boosted_regressor(rows, "label", 5).transform(rows)
    plain = learner(featuresCol="features", labelCol="label", maxIter=5, seed=3).fit(rows).transform(rows)
    assert fitted == [35]
    by_features = {tuple(r.features): r.prediction for r in plain.select("features", "prediction").distinct().collect()}
    for r in found.select("features", "prediction").distinct().collect():
        assert abs(r.prediction - by_features[tuple(r.features)]) < 1e-9
