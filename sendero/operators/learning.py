"""Supervised learning with pyspark.ml over repeatable splits."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   LinearRegressionModel)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sendero.functions.hashing import unit_hash
from sendero.session import materialize, table_path


def assemble(df: DataFrame, columns: list[str], name: str = "features", invalid: str = "error") -> DataFrame:
    """Numeric columns as one vector; ``invalid`` is "error", "skip" or "keep" for missing values."""
    return VectorAssembler(inputCols=columns, outputCol=name, handleInvalid=invalid).transform(df)


def mark_split(df: DataFrame, key: list[str], train: float = 0.7, seed: int = 3) -> DataFrame:
    """Add ``part``, "train" or "test", fixed by key and seed however the rows are partitioned."""
    return df.withColumn("part", F.when(unit_hash(*key, seed=seed) < train, "train").otherwise("test"))


def split(df: DataFrame, key: list[str], train: float = 0.7, seed: int = 3) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, key, train, seed)
    return marked.where("part = 'train'").drop("part"), marked.where("part = 'test'").drop("part")


def sample_rows(df: DataFrame, key: list[str], fraction: float = 0.8, seed: int = 0) -> DataFrame:
    """A sample without replacement that is the same in every run."""
    return df.where(unit_hash(*key, seed=seed) < fraction)


def tree_classifier(train: DataFrame, label: str, depth: int = 8, seed: int = 3) -> Model:
    return DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=depth, seed=seed).fit(train)


def linear_regression(train: DataFrame, label: str, rounds: int = 10, penalty: float = 0.3,
                      l1_share: float = 0.8) -> LinearRegressionModel:
    return LinearRegression(featuresCol="features", labelCol=label, maxIter=rounds, regParam=penalty,
                            elasticNetParam=l1_share).fit(train)


class LinearFit(NamedTuple):
    """A linear model: coefficients by column, intercept, and the objective at the start and after each round."""
    coefficients: dict[str, float]
    intercept: float
    objective: list[float]

    @property
    def rounds(self) -> int:
        return len(self.objective) - 1

    def predict(self) -> Column:
        """The prediction as an expression, columns added in the order of the fit."""
        total = F.lit(self.intercept)
        for column, factor in self.coefficients.items():
            total = total + F.lit(factor) * F.col(column)
        return total


def moments(df: DataFrame, columns: list[str]) -> tuple[list[float], list[list[float]]]:
    """Means and population covariances of numeric columns in one pass; rows with a null in any of them are left out.

    The sums are merged around running means, so large means lose no digits. Only one number per pair of columns
    reaches the driver. Without rows all are NaN.
    """
    values = [F.col(c).cast("double") for c in columns]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    row = df.dropna(subset=columns).agg(*[F.avg(v) for v in values], *[F.covar_pop(values[i], values[j]) for i, j in pairs]).first()
    known = [math.nan if v is None else v for v in row]
    covariance = [[0.0] * len(columns) for _ in columns]
    for (i, j), value in zip(pairs, known[len(columns):]):
        covariance[i][j] = covariance[j][i] = value
    return known[:len(columns)], covariance


def elastic_net(train: DataFrame, columns: list[str], label: str, penalty: float = 0.3, l1_share: float = 0.8,
                rounds: int = 10, tolerance: float = 1e-12) -> LinearFit:
    """Linear regression with a penalty on standardised coefficients, by coordinate descent on second moments.

    Minimises, with all columns and the label divided by their standard deviations, half the mean squared error plus
    ``penalty / deviation of the label`` times (``l1_share`` of the absolute and half of the rest of the squared
    coefficients). Each round updates the coefficients in the order of ``columns``; it ends after ``rounds``, or when no
    coefficient moves by more than ``tolerance``. The data is read once, however many rounds there are. A constant column
    gets 0; a constant label gives its mean.
    """
    means, covariance = moments(train, [*columns, label])
    deviations = [math.sqrt(max(covariance[i][i], 0.0)) for i in range(len(means))]
    d, own = len(columns), deviations[-1]

    def shared(i: int, j: int) -> float:
        return covariance[i][j] / (deviations[i] * deviations[j]) if deviations[i] and deviations[j] else 0.0
    between = [[shared(i, j) for j in range(d)] for i in range(d)]
    towards = [shared(i, d) for i in range(d)]
    strength = penalty / own if own else 0.0
    absolute, squared = strength * l1_share, strength * (1 - l1_share)
    weights = [0.0] * d

    def objective() -> float:
        fit = 0.5
        for i in range(d):
            fit += weights[i] * (0.5 * sum(between[i][j] * weights[j] for j in range(d)) - towards[i])
        return fit + absolute * sum(map(abs, weights)) + 0.5 * squared * sum(w * w for w in weights)
    history = [objective()]
    for _ in range(rounds):
        moved = 0.0
        for i in range(d):
            rest = towards[i]
            for j in range(d):
                rest -= between[i][j] * weights[j] if j != i else 0.0
            new = math.copysign(max(abs(rest) - absolute, 0.0), rest) / (1 + squared) if deviations[i] else 0.0
            moved = max(moved, abs(new - weights[i]))
            weights[i] = new
        history.append(objective())
        if moved <= tolerance:
            break
    factors = [w * own / s if s else 0.0 for w, s in zip(weights, deviations)]
    intercept = means[-1]
    for factor, mean in zip(factors, means):
        intercept -= factor * mean
    return LinearFit(dict(zip(columns, factors)), intercept, history)


def tree_regressor(train: DataFrame, label: str) -> Model:
    return DecisionTreeRegressor(featuresCol="features", labelCol=label).fit(train)


def boosted_regressor(train: DataFrame, label: str, rounds: int = 10, seed: int = 3) -> Model:
    """Boosted trees by squared error.

    Rows with equal features always get equal predictions, so all rounds see them as one row with their mean label and
    their number as its weight: gains of splits and means of nodes stay the same. What the rounds read and keep grows with
    the distinct features, not with the rows. Weights go into the bounds of the bins, too.
    """
    alike = materialize(train.groupBy("features").agg(F.avg(F.col(label).cast("double")).alias("_mean"),
                                                      F.count("*").cast("double").alias("_rows")))
    return GBTRegressor(featuresCol="features", labelCol="_mean", weightCol="_rows", maxIter=rounds, seed=seed).fit(alike)


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    """Share of right predictions; the error is one minus it."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(predictions)


def regression_metric(predictions: DataFrame, label: str, metric: str) -> float:
    """``metric`` "r2" or "rmse"."""
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric).evaluate(predictions)


def accuracy_table(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """``accuracy`` and ``error`` as a one-row table."""
    right = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return predictions.agg(right.alias("accuracy"), (1 - right).alias("error"))


def regression_table(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """``rmse`` and ``r2`` as a one-row table, in one pass."""
    squared = F.pow(F.col(label) - F.col(prediction), F.lit(2.0))
    spread = F.var_pop(label) * F.count(label)
    return predictions.agg(F.sqrt(F.avg(squared)).alias("rmse"), (1 - F.sum(squared) / spread).alias("r2"))


def regression_summary(model: LinearRegressionModel) -> dict:
    """Coefficients, intercept, fit quality and progress of a trained linear model."""
    s = model.summary
    return {"coefficients": model.coefficients.toArray().tolist(), "intercept": model.intercept,
            "rmse": s.rootMeanSquaredError, "r2": s.r2, "iterations": s.totalIterations,
            "objective": list(s.objectiveHistory)}


def residuals(model: LinearRegressionModel) -> DataFrame:
    return model.summary.residuals


def tree_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """``(id, prediction, feature, threshold, below, left, right)`` of a tree, a node per row, root 0, as a saved model has it.

    Inner nodes have the prediction they would give as leaves; leaves have no feature. ``below`` lists the categories that
    go left where the feature has categories.
    """
    saved = spark.read.parquet(f"{save_model(model, table_path(spark, 'tree'))}/data")
    inner, numeric = F.col("leftChild") >= 0, F.col("split.numCategories") < 0
    sides = F.col("split.leftCategoriesOrThreshold")
    return saved.select(
        "id", "prediction", F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & numeric, F.get(sides, F.lit(0))).alias("threshold"), F.when(inner & ~numeric, sides).alias("below"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"))


def accuracy_by_depth(model: Model, test: DataFrame, label: str, depths: list[int]) -> dict[int, float]:
    """Accuracy of the tree cut off at each depth, all in one pass over ``test``; NaN for no rows.

    Growing picks splits greedily from the root, so a tree of a lesser depth is the top of a deeper one: a row's walk
    passes the leaves of all of them. A step looks its node up in the table of nodes, whose size the depth bounds.
    """
    nodes = F.broadcast(tree_nodes(test.sparkSession, model))
    rows = test.select(F.col(label).alias("_label"), vector_to_array("features").alias("_x"), F.lit(0).alias("_at"))
    right = []
    for depth in range(max(depths) + 1):
        rows = rows.join(nodes, rows["_at"] == nodes["id"])
        value = F.element_at("_x", F.col("feature") + 1)
        left = F.when(F.col("below").isNull(), value <= F.col("threshold")).otherwise(F.array_contains("below", value))
        onward = F.when(F.col("feature").isNull(), F.col("_at")).when(left, F.col("left")).otherwise(F.col("right"))
        hit = (F.col("prediction") == F.col("_label")).cast("double").alias(f"_d{depth}")
        rows = rows.select("_label", "_x", onward.alias("_at"), *right, *([hit] if depth in depths else []))
        right += [f"_d{depth}"] if depth in depths else []
    means = rows.agg(*[F.avg(c).alias(c) for c in right]).first()
    return {int(c[2:]): math.nan if means[c] is None else means[c] for c in right}


def grid_search(df: DataFrame, key: list[str], label: str, train_shares: list[float], depths: list[int],
                seed: int = 3, parallelism: int = 8) -> DataFrame:
    """``(trial, train_share, depth, accuracy)`` of every pair, from one tree per share; several fits run at a time."""
    data = df.select(*key, label, "features").persist(StorageLevel.MEMORY_AND_DISK)

    def scores(share: float) -> dict[int, float]:
        train, test = split(data, key, share, seed)
        return accuracy_by_depth(tree_classifier(train, label, max(depths), seed), test, label, depths)

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            found = list(pool.map(inheritable_thread_target(df.sparkSession)(scores), train_shares))
    finally:
        data.unpersist()
    pairs = [(share, depth, by_depth[depth]) for share, by_depth in zip(train_shares, found) for depth in depths]
    rows = [(i, *pair) for i, pair in enumerate(pairs)]
    return df.sparkSession.createDataFrame(rows, "trial int, train_share double, depth int, accuracy double")


def best_trial(trials: DataFrame) -> DataFrame:
    """The most accurate trial; of equal ones the first."""
    return trials.orderBy(F.desc("accuracy"), "trial").limit(1)


def save_model(model: Model, path: str) -> str:
    """The fitted model, replacing one already there."""
    model.write().overwrite().save(path)
    return path
