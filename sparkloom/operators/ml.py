"""Training and scoring on tables with Spark ML, splits, scaling and reports."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import Bucketizer, Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.math import min_max, z_score
from sparkloom.operators.groups import whole
from sparkloom.session import checkpointed

ROWS_PER_TASK = 1 << 20


def key_hash(key: str, seed: int = 42) -> Column:
    """Number from 0 to 255 that depends on the key alone, so a split is the same in each run."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), 1, 2), 16, 10).cast("int")


def in_train(key: str, train_share: float = 0.8, seed: int = 42) -> Column:
    return key_hash(key, seed) < int(256 * train_share)


def split(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    low = in_train(key, train_share, seed)
    return df.filter(low), df.filter(~low)


def scaled(df: DataFrame, train: DataFrame, cols: list[str], method: str = "standard") -> DataFrame:
    """Scale with statistics of the training rows: standard (population std), minmax or log."""
    if method == "log":
        return df.withColumns({c: F.log(c) for c in cols})
    aggs = {}
    for c in cols:
        pair = (F.avg(c), F.stddev_pop(c)) if method == "standard" else (F.min(c), F.max(c))
        aggs.update({f"{c}_a": pair[0], f"{c}_b": pair[1]})
    stats = whole(train, **aggs)
    scale = z_score if method == "standard" else min_max
    return df.withColumns({c: scale(F.col(c), stats[f"{c}_a"], stats[f"{c}_b"]) for c in cols})


CLASSIFIERS = {
    "logistic": lambda: C.LogisticRegression(standardization=False),
    "linear_svc": lambda: C.LinearSVC(maxIter=20, regParam=0.01),
    "nb_gaussian": lambda: C.NaiveBayes(modelType="gaussian"),
    "nb_bernoulli": lambda: C.NaiveBayes(modelType="bernoulli"),
    "nb_multinomial": lambda: C.NaiveBayes(modelType="multinomial"),
    "tree": lambda: C.DecisionTreeClassifier(seed=42),
    "forest": lambda: C.RandomForestClassifier(seed=42),
    "boosted": lambda: C.GBTClassifier(maxIter=10, seed=42),
}
REGRESSORS = {
    "linear": lambda: R.LinearRegression(),
    "lasso": lambda: R.LinearRegression(elasticNetParam=1.0, regParam=1.0),
    "ridge": lambda: R.LinearRegression(elasticNetParam=0.0, regParam=1.0),
    "elastic_net": lambda: R.LinearRegression(elasticNetParam=0.5, regParam=1.0),
    "tree": lambda: R.DecisionTreeRegressor(seed=42),
    "forest": lambda: R.RandomForestRegressor(seed=42),
    "boosted": lambda: R.GBTRegressor(maxIter=10, seed=42),
}


def estimator(name: str, label: str, features: str = "features", **params) -> Estimator:
    """Estimator by name with hyperparameters set by name."""
    made = {**{f"regressor.{k}": v for k, v in REGRESSORS.items()}, **CLASSIFIERS}[name]()
    known = {p.name: p for p in made.params}
    unknown = set(params) - set(known)
    if unknown:
        raise ValueError(f"{name} has no parameter {sorted(unknown)}")
    values = {"labelCol": label, "featuresCol": features, **params}
    return made.copy({known[n]: v for n, v in values.items()})


def spread(df: DataFrame, most: int) -> DataFrame:
    """The rows in partitions of about ``most`` where one holds more; others stay as they lie, since models draw by partition."""
    held = df.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("largest"), F.sum("count").alias("rows")).first()
    return df.repartition(-(-held.rows // most)) if held.largest and held.largest > most else df


def fit(train: DataFrame, cols: list[str], model: Estimator) -> PipelineModel:
    """Assemble the feature columns and fit; rows with a null feature or label are left out.

    Trees and iterative models keep their rows in memory as objects, several times the size of a table's file, and a
    task reads a whole partition of them in each round, so these get partitions of at most about ``ROWS_PER_TASK``.
    """
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip")
    rows = train.na.drop(subset=[*cols, model.getLabelCol()])
    keeps_rows = not isinstance(model, (R.LinearRegression, C.NaiveBayes))
    return Pipeline(stages=[assembler, model]).fit(spread(rows, ROWS_PER_TASK) if keeps_rows else rows)


def same_moments(train: DataFrame, cols: list[str], label: str) -> tuple[DataFrame | None, int]:
    """Weighted rows with the weight, means and covariances of all rows (None if those are not finite), and the number of rows.

    Linear regression by normal equations depends on its rows through these alone, so one pass serves any number of
    such models. Two rows lie on both sides of the mean along each column of the covariances' root.
    """
    names = [*cols, label]
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    found = train.agg(F.count(F.lit(1)), *[F.avg(c) for c in names], *[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    n, means, covariances = found[0], found[1:1 + len(names)], found[1 + len(names):]
    if not n or not np.isfinite(found[1:]).all():
        return None, n
    c = np.zeros((len(names), len(names)))
    for (i, j), x in zip(pairs, covariances):
        c[i, j] = c[j, i] = x
    scale = np.sqrt(np.diag(c))
    scale[scale == 0] = 1
    values, vectors = np.linalg.eigh(c / np.outer(scale, scale))
    root = (scale[:, None] * vectors * np.sqrt(np.maximum(values, 0))).T * np.sqrt(len(names))
    points = [(np.array(means) + sign * r).tolist() for r in root for sign in (1, -1)]
    rows = [(Vectors.dense(p[:-1]), p[-1], n / len(points)) for p in points]
    return train.sparkSession.createDataFrame(rows, ["features", label, "weight"]).coalesce(1), n


def candidates(rows: DataFrame, cols: list[str], n: int, model: Estimator) -> list[list[float]]:
    """The thresholds Spark's trees choose from: it takes them from a sample of about max(10,000, maxBins squared) rows.

    The sample has the same rows as that of ``model.fit``; as there, where a sample is smaller than was expected zeros
    stand for what is missing.
    """
    bins = min(model.getMaxBins(), n)
    wanted = max(model.getMaxBins() ** 2, 10_000)
    share = wanted / n if wanted < n else 1.0
    spark, picked = rows.sparkSession, rows.select(*[F.col(c).cast("double").alias(c) for c in cols])
    if share < 1:
        seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(model.getSeed()).nextInt()
        sample = picked._jdf.toJavaRDD().sample(False, share, seed)
        picked = DataFrame(spark._jsparkSession.createDataFrame(sample, picked._jdf.schema()), spark)
    values = np.array([tuple(r) for r in picked.collect()]).reshape(-1, len(cols))
    return [_thresholds(values[:, i], share * n, bins - 1) for i in range(len(cols))]


def _thresholds(values: np.ndarray, expected: float, most: int) -> list[float]:
    at, counts = np.unique(values[values != 0], return_counts=True)
    at, counts = at.tolist(), counts.astype(float).tolist()
    held = sum(counts)
    if not at:
        return []
    if expected - held > 2.220446049250313e-16 * held * 100:
        i = bisect_left(at, 0.0)
        at.insert(i, 0.0)
        counts.insert(i, expected - held)
    if len(at) - 1 <= most:
        return [(a + b) / 2 for a, b in zip(at, at[1:])]
    stride = target = expected / (most + 1)
    out, seen = [], counts[0]
    for i in range(1, len(at)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append((at[i - 1] + at[i]) / 2)
            target += stride
    return out


def with_bins(df: DataFrame, cols: list[str], limits: list[list[float]], names: list[str]) -> DataFrame:
    """One more than the number of limits below each value, which must not be null.

    The values are negated, since a bucket begins with its limit and a value at a threshold goes to the lower side.
    """
    for c, limit, name in zip(cols, limits, names):
        if limit:
            splits = [-float("inf"), *(0.0 - x for x in reversed(limit)), float("inf")]
            negated = df.withColumn(f"{name}_from", F.lit(0.0) - F.col(c))
            df = Bucketizer(splits=splits, inputCol=f"{name}_from", outputCol=f"{name}_at").transform(negated) \
                .withColumn(name, F.lit(len(limit) + 1.0) - F.col(f"{name}_at")).drop(f"{name}_from", f"{name}_at")
        else:
            df = df.withColumn(name, F.lit(1.0))
    return df


def cells(train: DataFrame, cols: list[str], label: str, limits: list[list[float]]) -> DataFrame:
    """One row for each combination of bins: their numbers as ``cols``, the mean label and the number of rows.

    A tree that takes all rows and features sees of a row its bins and of the labels their sums by bin, so it grows the
    same on these. There are at most as many as rows, and no more than the product of the numbers of bins.
    """
    names = [f"{c}_bin" for c in cols]
    sums = with_bins(train, cols, limits, names).groupBy(*names).agg(F.sum(label).alias("total"), F.count(F.lit(1)).alias("n"))
    return sums.select(*[F.col(b).alias(c) for b, c in zip(names, cols)], (F.col("total") / F.col("n")).alias(label),
                       F.col("n").cast("double").alias("weight"))


def on_cells(train: DataFrame, cols: list[str], limits: list[list[float]], models: list[Estimator]) -> list[PipelineModel]:
    """Fit trees of all rows and features on ``cells``; they score rows whose ``cols`` are numbers of bins."""
    label = models[0].getLabelCol()
    table = checkpointed(cells(train, cols, label, limits), "cells")
    bins = int(np.sqrt(table.count())) + 2  # so that all cells are looked at for candidates
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip")
    out = []
    for model in models:
        if model.hasParam("subsamplingRate") and model.getOrDefault("subsamplingRate") != 1:
            raise ValueError("a model that draws rows needs the rows themselves")
        named = model.copy({model.weightCol: "weight", model.maxBins: max(model.getMaxBins(), bins)})
        out.append(Pipeline(stages=[assembler, named]).fit(table))
    return out


def regressors(train: DataFrame, test: DataFrame, cols: list[str], label: str, models: dict[str, Estimator]) -> DataFrame:
    """(r2, model): R² on the test rows of each model; rows with a null feature are left out, in training also those without a label.

    Linear models are fitted to rows of the same moments, trees that take all rows to cells of their bins; others,
    such as forests, whose trees draw rows, to the rows. The test rows are scored in one pass.
    """
    rows = train.na.drop(subset=[*cols, label])
    few, n = same_moments(rows, cols, label)
    if not n:
        raise ValueError("there are no rows to train on")
    vector = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip")
    scored = vector.transform(test)
    trees = {k: m for k, m in models.items() if isinstance(m, (R.DecisionTreeRegressor, R.GBTRegressor))}
    if trees:
        some = next(iter(trees.values()))
        limits = candidates(rows, cols, n, some)
        binned = [f"{c}_bin" for c in cols]
        scored = with_bins(scored, cols, limits, binned)
        bin_vector = VectorAssembler(inputCols=binned, outputCol="bins")
        scored = bin_vector.transform(scored)
        fitted = dict(zip(trees, on_cells(rows, cols, limits, list(trees.values()))))
    for name, model in models.items():
        if name in trees:
            done, features = fitted[name].stages[-1], "bins"
        elif few is not None and isinstance(model, R.LinearRegression):
            done, features = model.copy({model.weightCol: "weight"}).fit(few), "features"
        else:
            done, features = fit(train, cols, model).stages[-1], "features"
        scored = done.setFeaturesCol(features).setPredictionCol(f"prediction_{name}").transform(scored)
    gap = {k: F.col(label) - F.col(f"prediction_{k}") for k in models}
    r2 = scored.agg(*[(1 - F.try_divide(F.sum(g * g), F.var_pop(label) * F.count(label))).alias(k) for k, g in gap.items()])
    return r2.select(F.explode(F.array(*[F.struct(F.col(k).alias("r2"), F.lit(k).alias("model")) for k in models])).alias("x")).select("x.*")


def probability(col: str = "probability", index: int = 1) -> Column:
    return vector_to_array(col)[index]


def ridge_strength(n: int, c: float = 1.0) -> float:
    """Penalty that gives the usual inverse-strength ``C`` for a mean loss over n rows."""
    return 1.0 / (c * max(n, 1))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Per class: precision, recall, f1, support; then accuracy and the two averages.

    A class that is only predicted has support and recall 0 and counts in the macro average.

    Counted as a confusion table, so all that follows runs on classes squared rows.
    """
    cells = df.groupBy(F.col(label).alias("y"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    truth = cells.groupBy(F.col("y").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"))
    guess = cells.groupBy(F.col("p").alias("class")).agg(F.sum("n").alias("guessed"))
    both = truth.join(guess, "class", "full").na.fill(0, subset=["guessed", "support", "hit"])
    zero = F.lit(0.0)
    per = both.select(F.col("class").cast("string").alias("class"),
                      F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("guessed")), zero).alias("precision"),
                      F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("support")), zero).alias("recall"), "support", "hit")
    total = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), total), zero))
    measures = ["precision", "recall", "f1"]
    n = F.sum("support")
    accuracy = F.sum("hit").cast("double") / n
    summary = [
        per.agg(F.lit("accuracy").alias("class"), *[accuracy.alias(m) for m in measures], n.alias("support")),
        per.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], n.alias("support")),
        per.agg(F.lit("weighted avg").alias("class"),
                *[(F.sum(F.col(m) * F.col("support")) / n).alias(m) for m in measures], n.alias("support"))]
    out = per.select("class", *measures, "support")
    for row in summary:
        out = out.unionByName(row)
    return out


def r2_score(df: DataFrame, label: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """One minus residual over total sum of squares, in one pass; null for a constant label."""
    gap = F.col(label) - F.col(predicted)
    return df.groupBy(*(by or [])).agg(
        (1 - F.try_divide(F.sum(gap * gap), F.var_pop(label) * F.count(label))).alias("r2"))


def simple_regression(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Slope, intercept and R² of a line per group, in closed form."""
    pair = F.col(x).isNotNull() & F.col(y).isNotNull()
    return df.filter(pair).groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.count(F.lit(1)).alias("n"))


def impute(df: DataFrame, cols: list[str], strategy: str = "mean") -> DataFrame:
    """Spark ML imputer; its median is approximate, ``nulls.fill_statistic`` gives the exact one."""
    return Imputer(strategy=strategy, inputCols=cols, outputCols=[f"{c}_imputed" for c in cols]).fit(df).transform(df)


def model_fill(df: DataFrame, target: str, cols: list[str], out: str, model: Estimator) -> DataFrame:
    """Fill nulls of a column with a model trained on the rows where it is known."""
    fitted = fit(df.filter(F.col(target).isNotNull()), cols, model)
    guess = fitted.transform(df)
    return guess.select(*df.columns, F.coalesce(F.col(target), F.col("prediction")).alias(out))
