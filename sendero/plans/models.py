"""Learning queries."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sendero.operators import learning
from sendero.plans.registry import query, table
from sendero.session import table_path

MEASURES = ["l_quantity", "l_discount", "l_tax"]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
HASHED = "('0x' || substr(md5('{seed}:' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE < {share}"


def lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_extendedprice", *MEASURES)
    return learning.split(learning.assemble(rows, MEASURES), LINE_KEY, 0.8)


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem")
def ml_assemble(spark, sf_dir):
    rows = learning.assemble(table(spark, sf_dir, "lineitem").select(*LINE_KEY, *MEASURES), MEASURES)
    parts = vector_to_array("features")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", *[parts[i].alias(f"f{i}") for i in range(3)])


@query("SELECT o_orderkey, CASE WHEN " + HASHED.format(seed=3, share=0.7) + " THEN 'train' ELSE 'test' END AS part FROM orders")
def ml_split(spark, sf_dir):
    return learning.mark_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.7, 3)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE " + HASHED.format(seed=0, share=0.8))
def sample_rows(spark, sf_dir):
    return learning.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.8)


@query()
def ml_tree_classify(spark, sf_dir):
    train, test = learning.split(vectors(spark, sf_dir), ["vec_id"], 0.7)
    return learning.tree_classifier(train, "label", 8).transform(test).select("vec_id", "label", "prediction")


@query("""SELECT round(avg((quality = 1 - toxic)::INT), 6) AS accuracy, round(1 - avg((quality = 1 - toxic)::INT), 6) AS error
          FROM labels""")
def ml_accuracy(spark, sf_dir):
    judged = table(spark, sf_dir, "labels").select("quality", (1 - F.col("toxic")).alias("prediction"))
    scores = learning.accuracy_table(judged, "quality")
    return scores.select(F.round("accuracy", 6).alias("accuracy"), F.round("error", 6).alias("error"))


@query()
def ml_grid_search(spark, sf_dir):
    return learning.grid_search(vectors(spark, sf_dir), ["vec_id"], "label", [0.7, 0.8, 0.9], list(range(3, 12)))


PENALTY, L1_SHARE, ROUNDS = 60.0, 0.8, 10


def descent() -> str:
    """SQL of the moments of the training lines and of the same descent steps on them: table ``fit``, a row per step."""
    names = [*MEASURES, "l_extendedprice"]
    d = len(MEASURES)
    hashed = HASHED.format(seed=3, share=0.8).replace("o_orderkey", " || ':' || ".join(LINE_KEY))
    pairs = [(i, j) for i in range(d + 1) for j in range(i + 1)]
    aggregates = [f"avg({n}) AS m{i}" for i, n in enumerate(names)] + [f"covar_pop({names[i]}, {names[j]}) AS v{i}{j}" for i, j in pairs]

    def v(i, j):
        return f"v{max(i, j)}{min(i, j)}"
    shared = [f"{v(i, j)} / (s{i} * s{j}) AS c{i}{j}" for i in range(d + 1) for j in range(d + 1) if i != j]

    def update(i):
        rest = f"c{i}{d}" + "".join(f" - c{i}{j} * w{j}" for j in range(d) if j != i)
        return f"CASE WHEN i % {d} = {i} THEN sign({rest}) * greatest(abs({rest}) - l1, 0) / (1 + l2) ELSE w{i} END AS w{i}"
    objective = "0.5" + "".join(f" + w{i} * (0.5 * (" + " + ".join(f"{'1' if i == j else f'c{i}{j}'} * w{j}" for j in range(d)) + f") - c{i}{d})"
                                for i in range(d))
    objective += f" + l1 * ({' + '.join(f'abs(w{i})' for i in range(d))}) + 0.5 * l2 * ({' + '.join(f'w{i} * w{i}' for i in range(d))})"
    factors = ", ".join(f"w{i} * s{d} / s{i} AS f{i}" for i in range(d))
    return f"""WITH RECURSIVE marked AS (SELECT *, {hashed} AS training FROM lineitem),
        a AS (SELECT {", ".join(aggregates)} FROM marked WHERE training),
        b AS (SELECT *, {", ".join(f"sqrt(v{i}{i}) AS s{i}" for i in range(d + 1))} FROM a),
        m AS (SELECT *, {", ".join(shared)}, {PENALTY}::DOUBLE / s{d} * {L1_SHARE}::DOUBLE AS l1,
              {PENALTY}::DOUBLE / s{d} * (1 - {L1_SHARE}::DOUBLE) AS l2 FROM b),
        steps AS (SELECT 0 AS i, {", ".join(f"0.0::DOUBLE AS w{i}" for i in range(d))} UNION ALL
            SELECT i + 1, {", ".join(map(update, range(d)))} FROM steps, m WHERE i < {d * ROUNDS}),
        fit AS (SELECT i, {objective} AS objective, {factors}, m{d}{"".join(f" - w{i} * s{d} / s{i} * m{i}" for i in range(d))} AS f{d}
                FROM steps, m),
        fitted AS (SELECT * FROM fit WHERE i = {d * ROUNDS}) """


PREDICTED = f"f{len(MEASURES)}" + "".join(f" + f{i} * {c}" for i, c in enumerate(MEASURES))


def penalised(spark, sf_dir):
    """The fit on the training lines, and both parts."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_extendedprice", *MEASURES)
    train, test = learning.split(rows, LINE_KEY, 0.8)
    return learning.elastic_net(train, MEASURES, "l_extendedprice", PENALTY, L1_SHARE, ROUNDS, tolerance=-1.0), train, test


@query(descent() + f"""SELECT {", ".join(LINE_KEY)}, l_extendedprice, round({PREDICTED}, 2) AS prediction
        FROM marked, fitted WHERE NOT training""")
def ml_linear_regression(spark, sf_dir):
    fit, _, test = penalised(spark, sf_dir)
    return test.select(*LINE_KEY, "l_extendedprice", F.round(fit.predict(), 2).alias("prediction"))


@query(descent() + f""", errors AS (SELECT avg(power(l_extendedprice - ({PREDICTED}), 2)) AS mse, var_pop(l_extendedprice) AS spread
        FROM marked, fitted WHERE training)
    SELECT measure, round(value, 5) AS value FROM (
        {" UNION ALL ".join(f"SELECT 'coefficient of {c}' AS measure, f{i} AS value FROM fitted" for i, c in enumerate(MEASURES))}
        UNION ALL SELECT 'intercept', f{len(MEASURES)} FROM fitted UNION ALL SELECT 'rmse', sqrt(mse) FROM errors
        UNION ALL SELECT 'r2', 1 - mse / spread FROM errors
        UNION ALL SELECT 'thousandfold objective after round ' || (i // {len(MEASURES)}), 1000 * objective FROM fit WHERE i % {len(MEASURES)} = 0)""")
def ml_lr_summary(spark, sf_dir):
    """Coefficients, fit to the training lines, and the objective round by round."""
    fit, train, _ = penalised(spark, sf_dir)
    quality = learning.regression_table(train.withColumn("prediction", fit.predict()), "l_extendedprice")
    known = ([(f"coefficient of {c}", f) for c, f in fit.coefficients.items()] + [("intercept", fit.intercept)]
             + [(f"thousandfold objective after round {i}", 1000 * o) for i, o in enumerate(fit.objective)])
    told = spark.createDataFrame(known, "measure string, value double")
    both = told.unionByName(quality.select(F.explode(F.create_map(F.lit("rmse"), "rmse", F.lit("r2"), "r2")).alias("measure", "value")))
    return both.select("measure", F.round("value", 5).alias("value"))


@query("""SELECT round(sqrt(avg(power(1000 * l_quantity - l_extendedprice, 2))), 4) AS rmse,
            round(1 - sum(power(1000 * l_quantity - l_extendedprice, 2)) / sum(power(l_extendedprice - m, 2)), 6) AS r2
          FROM lineitem, (SELECT avg(l_extendedprice) AS m FROM lineitem)""")
def ml_regression_metrics(spark, sf_dir):
    guessed = table(spark, sf_dir, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 1000).alias("prediction"))
    scores = learning.regression_table(guessed, "l_extendedprice")
    return scores.select(F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query()
def ml_tree_regress(spark, sf_dir):
    train, test = lines(spark, sf_dir)
    model = learning.tree_regressor(train, "l_extendedprice")
    return model.transform(test).select(*LINE_KEY, "l_extendedprice", "prediction")


@query()
def ml_gbt_regress(spark, sf_dir):
    train, test = lines(spark, sf_dir)
    model = learning.boosted_regressor(train, "l_extendedprice")
    return model.transform(test).select(*LINE_KEY, "l_extendedprice", "prediction")


# Planted rules: labels that a fitted model has to reproduce row by row. A line number has few values, so each is a bin.
RULE = "CASE WHEN l_linenumber >= 4 THEN {high}::DOUBLE ELSE {low}::DOUBLE END AS prediction"
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def ruled_lines(spark, sf_dir, label):
    rows = table(spark, sf_dir, "lineitem").select(*ROW_KEY, "l_tax", "l_discount").withColumn("label", label)
    return learning.assemble(rows, ["l_linenumber", "l_discount"])


def by_line(low, high):
    return F.when(F.col("l_linenumber") >= 4, F.lit(float(high))).otherwise(F.lit(float(low)))


def predicted(model, rows):
    return model.transform(rows).select(*ROW_KEY, F.round("prediction", 6).alias("prediction"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, {RULE.format(high=1, low=0)} FROM lineitem")
def ml_tree_rule(spark, sf_dir):
    rows = ruled_lines(spark, sf_dir, by_line(0, 1))
    return predicted(learning.tree_classifier(rows, "label", 3), rows)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, {RULE.format(high=0, low=1)} FROM lineitem")
def ml_saved_tree_rule(spark, sf_dir):
    """The model is saved, loaded and then used."""
    rows = ruled_lines(spark, sf_dir, by_line(1, 0))
    path = learning.save_model(learning.tree_classifier(rows, "label", 3), table_path(spark, "tree"))
    return predicted(DecisionTreeClassificationModel.load(path), rows)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, {RULE.format(high=12.5, low=-3)} FROM lineitem")
def ml_tree_regress_rule(spark, sf_dir):
    rows = ruled_lines(spark, sf_dir, by_line(-3, 12.5))
    return predicted(learning.tree_regressor(rows, "label"), rows)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, {RULE.format(high=10, low=2)} FROM lineitem")
def ml_boosted_rule(spark, sf_dir):
    rows = ruled_lines(spark, sf_dir, by_line(2, 10))
    return predicted(learning.boosted_regressor(rows, "label", rounds=3), rows)


def linear_lines(spark, sf_dir):
    return ruled_lines(spark, sf_dir, F.col("l_linenumber") * 3.0 - F.col("l_discount") * 2.0 + 5.0)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(3 * l_linenumber - 2 * l_discount + 5, 4) AS prediction
          FROM lineitem""")
def ml_linear_rule(spark, sf_dir):
    rows = linear_lines(spark, sf_dir)
    fitted = learning.linear_regression(rows, "label", penalty=0.0)
    return predicted(fitted, rows).withColumn("prediction", F.round("prediction", 4))


@query("SELECT 3.0::DOUBLE AS line, -2.0::DOUBLE AS discount, 5.0::DOUBLE AS intercept, 1.0::DOUBLE AS r2, 0.0::DOUBLE AS residual")
def ml_linear_rule_summary(spark, sf_dir):
    """Coefficients, fit and largest residual of an exact linear label."""
    fitted = learning.linear_regression(linear_lines(spark, sf_dir), "label", penalty=0.0)
    known = learning.regression_summary(fitted)
    values = [*known["coefficients"], known["intercept"], known["r2"]]
    worst = learning.residuals(fitted).agg(F.round(F.max(F.abs("residuals")), 4).alias("residual"))
    return worst.select(*[F.lit(round(v, 4)).alias(n) for v, n in zip(values, ("line", "discount", "intercept", "r2"))], "residual")


@query("SELECT 2 AS depth, 1.0::DOUBLE AS accuracy")
def ml_grid_rule(spark, sf_dir):
    """Two thresholds take a tree of depth 2; of equally good trees the first wins."""
    label = F.when(F.col("l_linenumber") <= 2, 0.0).when(F.col("l_linenumber") <= 4, 1.0).otherwise(2.0)
    trials = learning.grid_search(ruled_lines(spark, sf_dir, label), ROW_KEY, "label", [0.8], [1, 2, 3])
    return learning.best_trial(trials).select("depth", "accuracy")
