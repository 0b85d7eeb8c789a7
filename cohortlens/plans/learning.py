"""At-risk classifiers on the early features: data preparation, five models, metrics, scoring."""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import exprs as E
from cohortlens.operators import forest
from cohortlens.operators.neighbors import nearest_neighbors, votes
from cohortlens.operators.selection import smallest, uniform_bits
from cohortlens.schemas import FEATURE_COLUMNS
from cohortlens.session import ensure_checkpoint_dir

KEY = ["student_id", "course_id"]
SEED = 42
# Rows of a partition at fitting. Trees sample by partition, so the partitioning follows the rows,
# never the cores.
FIT_ROWS = 250_000
FIT_PARTITIONS, FEW_ROWS = 4, 5_000
# Rows of a partition where much is computed for each row, up to so many partitions.
MAPPED_ROWS, MAPPED_PARTITIONS = 25_000, 12
# Train rows the kernel SVM's fits (256 numbers a row, kept by each) run side by side for; more rows
# are fitted on by one after another, so that only one keeps its copy.
SVM_ROWS = 500_000
NOISE = 0.15
TEST_SHARE = 0.2
# Model names in the order that settles ties.
MODEL_ORDER = ["Logistic Regression", "Random Forest", "Gradient Boosting", "SVM", "KNN"]
METRICS = ["accuracy", "precision", "recall", "f1"]


# -- preparation ----------------------------------------------------------------------------
def matrix(training: DataFrame, pass_mark: float = 5) -> DataFrame:
    """Key, seven finite features and the clean label; pairs without submissions are left out."""
    label = (F.col("course_final_avg") < pass_mark).cast("int")
    return training.filter(
        (F.col("course_submission_count") > 0) & F.col("course_final_avg").isNotNull()
    ).select(
        *KEY,
        *[E.finite_or_zero(F.col(c).cast("double")).alias(c) for c in FEATURE_COLUMNS],
        label.alias("label"),
    )


def key_bits(salt: str) -> Column:
    """A number from the row key: the same in every run and on every partitioning."""
    return uniform_bits(F.concat_ws("-", *[F.col(c).cast("string") for c in KEY], F.lit(salt)))


def with_label_noise(rows: DataFrame, share: float = NOISE, seed: int = SEED) -> DataFrame:
    """Flips exactly ``floor(share * rows)`` labels into ``noisy_label``; the clean label stays.

    The flipped rows are those with the smallest hashes of their keys. ``rows`` is counted a few
    times, so it should be a checkpoint or a table.
    """
    numbered = rows.withColumn("_bits", key_bits(f"noise{seed}"))
    flipped = smallest(numbered, [], "_bits", KEY, F.floor(F.col("size") * share), "flipped")
    noisy = F.when(F.col("flipped"), 1 - F.col("label")).otherwise(F.col("label"))
    return flipped.drop("_bits").withColumn("noisy_label", noisy)


def with_split(rows: DataFrame, share: float = TEST_SHARE, seed: int = SEED, label: str = "noisy_label") -> DataFrame:
    """Marks the share of each label's rows, rounded to a whole number, as test rows: those with
    the smallest hashes of their keys. ``rows`` should be a checkpoint or a table."""
    numbered = rows.withColumn("_bits", key_bits(f"split{seed}"))
    wanted = F.floor(F.col("size") * share + 0.5)
    return smallest(numbered, [label], "_bits", KEY, wanted, "is_test").drop("_bits")


def scaler(train: DataFrame) -> DataFrame:
    """One row of means and population deviations of the train rows."""
    stats = [F.avg(c).alias(f"mean_{c}") for c in FEATURE_COLUMNS]
    stats += [F.stddev_pop(c).alias(f"dev_{c}") for c in FEATURE_COLUMNS]
    return train.agg(*stats)


def standardize(rows: DataFrame, train: DataFrame) -> DataFrame:
    """(x - mean) / population deviation, both from the train rows; a constant column gives 0."""
    return scale(rows, scaler(train))


def scale(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows standardized with a scaler; its one row is joined as a scalar subquery."""
    row = known.select(F.struct(*known.columns).alias("s")).scalar()
    scaled = {
        c: (F.col(c) - F.col(f"_s.mean_{c}"))
        / F.when(F.col(f"_s.dev_{c}") == 0, 1.0).otherwise(F.col(f"_s.dev_{c}"))
        for c in FEATURE_COLUMNS
    }
    return rows.withColumn("_s", row).withColumns(scaled).drop("_s")


@dataclass(frozen=True)
class Prepared:
    """Standardized rows with ``label`` (clean), ``noisy_label`` and ``is_test``, and the scaler."""

    rows: DataFrame
    scaler: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(~F.col("is_test"))

    @property
    def test(self) -> DataFrame:
        return self.rows.filter("is_test")


def settled(rows: DataFrame) -> DataFrame:
    """Rows in partitions and an order that depend on nothing but the rows."""
    n = rows.count()
    parts = max(1, min(FIT_PARTITIONS, -(-n // FEW_ROWS)), -(-n // FIT_ROWS))
    return rows.repartition(parts, *KEY).sortWithinPartitions(*KEY)


def finer(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows, if there are few, in more partitions, in an order that depends on nothing but the
    rows; many rows are left as they are."""
    parts = min(MAPPED_PARTITIONS, -(-n // MAPPED_ROWS))
    if parts <= max(FIT_PARTITIONS, -(-n // FIT_ROWS)):
        return rows
    return rows.repartition(parts, *KEY).sortWithinPartitions(*KEY)


def prepare(training: DataFrame, noise: float = NOISE, seed: int = SEED) -> Prepared:
    """Computes the features once and keeps them in a reliable checkpoint for all five fits."""
    ensure_checkpoint_dir(training.sparkSession)
    noisy = with_label_noise(matrix(training).checkpoint(), noise, seed).checkpoint()
    base = with_split(noisy, seed=seed).checkpoint()
    known = scaler(base.filter(~F.col("is_test"))).checkpoint()
    return Prepared(settled(scale(base, known)).checkpoint(), known)


# -- models ---------------------------------------------------------------------------------
def _assembled() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features")


def _scored(frame: DataFrame, probability: Column, prediction: Column) -> DataFrame:
    return frame.select(
        *KEY, "label", "noisy_label", "is_test",
        probability.alias("risk_probability"), prediction.cast("int").alias("prediction"),
    )


def apply_model(model: PipelineModel | forest.Forest, rows: DataFrame) -> DataFrame:
    out = model.transform(rows)
    return _scored(out, vector_to_array("probability")[1], F.col("prediction"))


def fit_logistic(train: DataFrame, penalty: float = 1.0, iterations: int = 1000) -> PipelineModel:
    """L2 logistic regression; the penalty is per data set, Spark's is per row."""
    n = max(train.count(), 1)
    estimator = LogisticRegression(
        labelCol="noisy_label", maxIter=iterations, regParam=1.0 / (penalty * n),
        elasticNetParam=0.0, standardization=False,
    )
    return Pipeline(stages=[_assembled(), estimator]).fit(train)


def fit_forest(train: DataFrame, trees: int = 100, depth: int = 30, seed: int = SEED) -> forest.Forest:
    """Deep trees, grown and kept in parts: neither fit nor scoring holds a whole forest anywhere."""
    return forest.fit(train, FEATURE_COLUMNS, KEY, "noisy_label", trees, depth, seed)


def fit_boosting(train: DataFrame, rounds: int = 100, seed: int = SEED) -> PipelineModel:
    ensure_checkpoint_dir(train.sparkSession)
    estimator = GBTClassifier(
        labelCol="noisy_label", maxIter=rounds, stepSize=0.1, maxDepth=3, seed=seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[_assembled(), estimator]).fit(train)


@dataclass(frozen=True)
class KernelSvm:
    """RBF-kernel SVM: landmark features, a linear SVM on them, and a logistic fit of margins that
    the SVM of other rows gave."""

    landmarks: np.ndarray
    gamma: float
    weights: np.ndarray
    svm: object
    platt: object

    def margins(self, rows: DataFrame) -> DataFrame:
        return _margins(self.svm, _with_landmarks(rows, self.landmarks, self.gamma, self.weights))

    def score(self, rows: DataFrame) -> DataFrame:
        out = self.platt.transform(self.margins(rows))
        return _scored(out, vector_to_array("probability")[1], F.col("side"))


def kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    """exp(-gamma |x - y|^2) for all rows of x and y."""
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(squares, 0.0))


def landmark_weights(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """Turns kernel values with the landmarks into features whose inner products are the kernel,
    exactly between landmarks and closely between others (Nystroem)."""
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks, gamma))
    kept = values > 1e-10 * values.max()
    return vectors[:, kept] / np.sqrt(values[kept])


def _with_landmarks(rows: DataFrame, landmarks: np.ndarray, gamma: float, weights: np.ndarray) -> DataFrame:
    @F.arrow_udf("array<double>")
    def mapped(x: pa.Array) -> pa.Array:
        columns = [c.to_numpy(zero_copy_only=False) for c in x.flatten()]
        values = kernel(np.stack(columns, axis=1), landmarks, gamma) @ weights
        ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))

    return rows.withColumn("features", array_to_vector(mapped(F.struct(*FEATURE_COLUMNS))))


def _margins(svm: object, rows: DataFrame) -> DataFrame:
    margin = vector_to_array("rawPrediction")[1]
    return svm.transform(rows).select(
        *KEY, "label", "noisy_label", "is_test",
        array_to_vector(F.array(margin)).alias("margin"), F.col("prediction").alias("side"),
    )


def at_most(train: DataFrame, rows: int) -> DataFrame:
    """All train rows, or a fixed sample of exactly ``rows`` by a hash of their key if there are
    more."""
    if train.limit(rows + 1).count() <= rows:
        return train
    numbered = train.withColumn("_bits", key_bits("fit"))
    chosen = smallest(numbered, [], "_bits", KEY, F.lit(rows), "_chosen").where("_chosen").drop("_bits", "_chosen")
    return chosen.repartition(-(-rows // FIT_ROWS), *KEY).sortWithinPartitions(*KEY)


def fit_kernel_svm(
    train: DataFrame, penalty: float = 0.5, landmarks: int = 256, folds: int = 3, rows: int = SVM_ROWS
) -> KernelSvm:
    """Fitted on all train rows; beyond ``rows`` of them, one fit runs after another. The kernel width
    is 1 / (features * variance of all values fitted on).

    Landmarks are the train rows with the smallest hashes of their keys. Probabilities come from
    margins of rows that the SVM giving them has not seen: each fold's from a fit of the others.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    stats = [F.sum(c) for c in FEATURE_COLUMNS], [F.sum(F.col(c) * F.col(c)) for c in FEATURE_COLUMNS]
    total, squares = (reduce(lambda a, b: a + b, columns) for columns in stats)
    row = train.agg(total.alias("s"), squares.alias("q"), F.count("*").alias("n")).first()
    values = max(row["n"], 1) * len(FEATURE_COLUMNS)
    variance = row["q"] / values - (row["s"] / values) ** 2
    gamma = 1.0 / (len(FEATURE_COLUMNS) * variance) if variance > 0 else 1.0
    chosen = at_most(train, landmarks).select(*KEY, *FEATURE_COLUMNS).orderBy(*KEY).collect()  # a fixed number
    known = np.array([r[len(KEY) :] for r in chosen], float)
    weights = landmark_weights(known, gamma)
    fold = F.pmod(key_bits("fold"), F.lit(folds)).cast("int").alias("fold")
    # Mapped in more parts than fitted on: a fit's rounds take a second stage beyond a few parts.
    mapped = _with_landmarks(finer(train, row["n"]), known, gamma, weights).select("*", fold).checkpoint()
    mapped = mapped.coalesce(max(FIT_PARTITIONS, -(-row["n"] // FIT_ROWS)))

    def fit(some: DataFrame, share: float):
        return LinearSVC(
            labelCol="noisy_label", maxIter=100, regParam=1.0 / (penalty * max(share * row["n"], 1)), standardization=False,
        ).fit(some)

    left_out = {f"fold {k}": partial(fit, mapped.where(F.col("fold") != k), 1 - 1 / folds) for k in range(folds)}
    tasks = {"all": partial(fit, mapped, 1.0), **left_out}
    fitted = side_by_side(spark, tasks) if row["n"] <= rows else {name: task() for name, task in tasks.items()}
    unseen = [_margins(fitted[f"fold {k}"], mapped.where(F.col("fold") == k)) for k in range(folds)]
    margins = reduce(DataFrame.unionByName, unseen).checkpoint()  # read twice
    platt = LogisticRegression(featuresCol="margin", labelCol="noisy_label").fit(margins)
    return KernelSvm(known, gamma, weights, fitted["all"], platt)


def score_knn(train: DataFrame, rows: DataFrame, k: int = 5) -> DataFrame:
    """Share of positive labels among the k nearest of all train rows."""
    found = nearest_neighbors(train, rows, FEATURE_COLUMNS, KEY, "noisy_label", k)
    share = votes(found, FEATURE_COLUMNS, "noisy_label")
    joined = rows.join(share, FEATURE_COLUMNS)
    return _scored(joined, F.col("probability"), F.col("probability") > 0.5)


def fit_with(name: str, data: Prepared) -> Callable[[DataFrame], DataFrame]:
    """Fit one model by name on the train rows; returns what scores rows with it."""
    if name == "Logistic Regression":
        return partial(apply_model, fit_logistic(data.train))
    if name == "Random Forest":
        return partial(apply_model, fit_forest(data.train))
    if name == "Gradient Boosting":
        return partial(apply_model, fit_boosting(data.train))
    if name == "SVM":
        return fit_kernel_svm(data.train).score
    if name == "KNN":
        return partial(score_knn, data.train)
    raise ValueError(f"unknown model {name!r}")


def side_by_side(spark: SparkSession, tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Results of driver-side tasks that run at the same time, each with its jobs in a pool of its
    own name.

    A fit is a long row of small jobs with waits between them; others fill the waits. Pools share
    the cores evenly where spark.scheduler.mode is FAIR, else the oldest job goes first. Nested
    calls are fine. The first error is raised once all tasks have ended.
    """
    context = spark.sparkContext

    def run(name: str):
        context.setLocalProperty("spark.scheduler.pool", name)
        return tasks[name]()

    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        # Wrapped for each task: threads of one wrapper share its properties, the pool among them.
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in tasks}
    return {name: job.result() for name, job in started.items()}


def score_with(name: str, data: Prepared, rows: DataFrame) -> DataFrame:
    return fit_with(name, data)(rows)


def save_model(model: PipelineModel, known: DataFrame, path: str) -> None:
    """The fitted model and the scaler its features went through."""
    model.write().overwrite().save(os.path.join(path, "model"))
    known.write.mode("overwrite").parquet(os.path.join(path, "scaler"))


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    model = PipelineModel.load(os.path.join(path, "model"))
    return model, spark.read.parquet(os.path.join(path, "scaler"))


def score_new(training: DataFrame, model: PipelineModel, known: DataFrame) -> DataFrame:
    """Key, probability and prediction of raw training rows that the fit need not have seen."""
    rows = matrix(training).withColumns({"noisy_label": F.col("label"), "is_test": F.lit(True)})
    return apply_model(model, scale(rows, known)).select(*KEY, "risk_probability", "prediction")


# -- evaluation -----------------------------------------------------------------------------
def _confusion(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def _share(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(E.ratio(a, b), F.lit(0.0))


def binary_metrics(
    predictions: DataFrame, by: list[str] | None = None,
    label: str = "label", prediction: str = "prediction",
) -> DataFrame:
    """Confusion counts and the four metrics, one row per group of ``by``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    counts = predictions.groupBy(*(by or [])).agg(*_confusion(label, prediction))
    return counts.withColumns(
        {
            "accuracy": _share(tp + tn, tp + fp + fn + tn),
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "f1": _share(2 * tp, 2 * tp + fp + fn),
        }
    )


# -- checks of a fit ------------------------------------------------------------------------
# What a fit must satisfy whatever its numbers are; a score that is the same for all rows fails.
def log_loss(scored: DataFrame, label: str = "noisy_label") -> tuple[float, float]:
    """Mean log loss of the scores, and that of the best constant, the share of the label."""
    p = F.least(F.greatest("risk_probability", F.lit(1e-9)), F.lit(1 - 1e-9))
    loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))
    mean, base = scored.agg(F.avg(loss), F.avg(label)).first()
    constant = -sum(x * math.log(x) for x in (base, 1 - base) if x > 0)
    return mean, constant


def area_under_curve(scored: DataFrame, label: str = "label") -> float:
    """How often a row with the label scores above one without it; 0.5 for a constant score."""
    of_model = scored.select(F.col("risk_probability").alias("score"), F.col(label).cast("double").alias("label"))
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(of_model)


def linear_score(model: PipelineModel, *features: str) -> Column:
    """The probability that follows from a logistic model's coefficients alone."""
    fitted = model.stages[-1]
    terms = [F.lit(float(w)) * F.col(c) for w, c in zip(fitted.coefficients, features or FEATURE_COLUMNS, strict=True)]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(float(fitted.intercept)))))


def logistic_gradient(model: PipelineModel, train: DataFrame, penalty: float = 1.0) -> float:
    """Largest slope of the penalized mean log loss at the fitted coefficients; near 0 at its
    minimum."""
    fitted = model.stages[-1]
    off = linear_score(model) - F.col("noisy_label")
    row = train.agg(F.count("*"), F.avg(off), *[F.avg(off * F.col(c)) for c in FEATURE_COLUMNS]).first()
    slopes = [row[1], *[g + w / (penalty * row[0]) for g, w in zip(row[2:], fitted.coefficients, strict=True)]]
    return max(abs(g) for g in slopes)


def class_report(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, f1 and support per class, and their macro and weighted averages."""
    counts = predictions.agg(*_confusion(label, prediction))
    per_class = counts.select(
        F.expr("stack(2, '0', tn, fn, fp, '1', tp, fp, fn) AS (class, hit, wrong, missed)")
    ).select(
        "class",
        _share(F.col("hit"), F.col("hit") + F.col("wrong")).alias("precision"),
        _share(F.col("hit"), F.col("hit") + F.col("missed")).alias("recall"),
        _share(2 * F.col("hit"), 2 * F.col("hit") + F.col("wrong") + F.col("missed")).alias("f1"),
        (F.col("hit") + F.col("missed")).alias("support"),
    )
    metrics = ["precision", "recall", "f1"]
    macro = [F.avg(m).alias(m) for m in metrics]
    total = F.sum("support").alias("support")
    weighted = [_share(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in metrics]
    averages = [
        per_class.agg(*macro, total).withColumn("class", F.lit("macro avg")),
        per_class.agg(*weighted, total).withColumn("class", F.lit("weighted avg")),
    ]
    return reduce(DataFrame.unionByName, averages, per_class)


def comparison_long(comparison: DataFrame) -> DataFrame:
    """(model, metric, score) rows of a one-row-per-model comparison."""
    return comparison.unpivot("model", METRICS, "metric", "score").select(
        "model", F.initcap("metric").alias("metric"), "score"
    )


def best_model(comparison: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Highest f1; on a tie the model listed first."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order or MODEL_ORDER]), F.col("model"))
    return comparison.orderBy(F.desc("f1"), rank).limit(1)


def evaluation_rows(best: DataFrame) -> DataFrame:
    """The four metrics of the best model under their published names."""
    names = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall", "f1": "F1-Score"}
    renamed = best.select("model", *[F.col(c).alias(n) for c, n in names.items()])
    return renamed.unpivot("model", list(names.values()), "metric", "score")


@dataclass(frozen=True)
class Outcome:
    comparison: DataFrame
    best: str
    scores: DataFrame
    report: DataFrame


def compare_models(data: Prepared, models: list[str] | None = None) -> Outcome:
    """Fit all models side by side, each scoring the test rows as soon as it is fitted, compare them
    and score the other pairs with the best one only."""
    names, spark = models or MODEL_ORDER, data.rows.sparkSession
    ensure_checkpoint_dir(spark)

    def fit_and_test(name: str) -> tuple[Callable[[DataFrame], DataFrame], DataFrame]:
        scorer = fit_with(name, data)
        return scorer, scorer(data.test).checkpoint()

    fitted = side_by_side(spark, {m: partial(fit_and_test, m) for m in names})
    tagged = [fitted[m][1].select(F.lit(m).alias("model"), "noisy_label", "prediction") for m in names]
    predictions = reduce(DataFrame.unionByName, tagged)
    comparison = binary_metrics(predictions, ["model"], label="noisy_label").checkpoint()
    best = best_model(comparison, names).first()["model"]
    scorer, tested = fitted[best]
    scores = tested.unionByName(scorer(data.train)).checkpoint()
    report = class_report(tested, label="noisy_label")
    return Outcome(comparison, best, scores, report)


def attach_scores(training: DataFrame, scores: DataFrame) -> DataFrame:
    """Training rows with the model's probability and prediction."""
    wanted = scores.select(*KEY, "risk_probability", F.col("prediction").alias("predicted_at_risk"))
    return training.join(wanted, KEY)


def train_single(training: DataFrame, data: Prepared | None = None) -> tuple[PipelineModel, DataFrame]:
    """Logistic regression alone on clean labels; returns the model and all scored pairs. ``data`` are
    the training rows prepared without noise, if at hand."""
    data = prepare(training, noise=0.0) if data is None else data
    model = fit_logistic(data.train)
    return model, apply_model(model, data.rows)
