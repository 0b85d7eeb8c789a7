"""Models, metrics and neighbor search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens import catalog, schemas
from cohortlens.operators import neighbors
from cohortlens.plans import features, learning, marts
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources.fixtures import coursework


@pytest.fixture(scope="module")
def training(spark, data):
    ensure_checkpoint_dir(spark)
    return features.training_dataset(coursework(spark, data)).checkpoint()


@pytest.fixture(scope="module")
def prepared(training):
    return learning.prepare(training)


def test_shares(prepared):
    n = prepared.rows.count()
    assert prepared.rows.filter(F.col("label") != F.col("noisy_label")).count() == int(0.15 * n)
    for side in (0, 1):
        rows = prepared.rows.filter(F.col("noisy_label") == side)
        assert rows.filter("is_test").count() == int(0.2 * rows.count() + 0.5)


def test_standardized_train_rows(prepared):
    for name in schemas.FEATURE_COLUMNS:
        mean, dev = prepared.train.agg(F.avg(name), F.stddev_pop(name)).first()
        assert abs(mean) < 1e-9 and (abs(dev - 1) < 1e-9 or dev == 0)


def test_constant_feature_becomes_zero(spark, training):
    rows = learning.matrix(training.withColumn("early_late_ratio", F.lit(0.5)))
    got = learning.standardize(rows, rows).agg(F.max(F.abs("early_late_ratio"))).first()[0]
    assert got == 0.0


@pytest.mark.parametrize("model", ["Logistic Regression", "SVM", "KNN"])
def test_model_beats_guessing(prepared, model):
    scored = learning.score_with(model, prepared, prepared.test)
    row = learning.binary_metrics(scored, label="noisy_label").first()
    always_one_class = max(row.tp + row.fn, row.tn + row.fp) / (row.tp + row.fn + row.tn + row.fp)
    assert row.accuracy > always_one_class
    low, high = scored.agg(F.min("risk_probability"), F.max("risk_probability")).first()
    assert 0 <= low <= high <= 1


def test_small_forest_and_boosting(prepared):
    for model in (learning.fit_forest(prepared.train, trees=10, depth=6), learning.fit_boosting(prepared.train, 5)):
        scored = learning.apply_model(model, prepared.test)
        assert learning.binary_metrics(scored, label="noisy_label").first().accuracy > 0.6


def test_logistic_is_deterministic_and_reloads(spark, prepared, tmp_path):
    model = learning.fit_logistic(prepared.train)
    first = learning.apply_model(model, prepared.test).orderBy(*learning.KEY).collect()
    learning.save_model(model, prepared.scaler, str(tmp_path / "m"))
    loaded, _ = learning.load_model(spark, str(tmp_path / "m"))
    assert learning.apply_model(loaded, prepared.test).orderBy(*learning.KEY).collect() == first


def test_saved_model_scores_raw_rows_as_the_fit_did(spark, training, prepared, tmp_path):
    model = learning.fit_logistic(prepared.train)
    learning.save_model(model, prepared.scaler, str(tmp_path / "m"))
    raw = learning.score_new(training, *learning.load_model(spark, str(tmp_path / "m")))
    fitted = learning.apply_model(model, prepared.rows).select(*raw.columns)
    assert sorted(raw.collect()) == sorted(fitted.collect())


def test_forest_does_not_depend_on_the_input_partitioning(training):
    found = []
    for parts in (1, 7):
        data = learning.prepare(training.repartition(parts))
        model = learning.fit_forest(data.train, trees=8, depth=5)
        found.append(learning.binary_metrics(learning.apply_model(model, data.test)).first())
        assert data.rows.rdd.getNumPartitions() == 1  # few rows
    assert found[0] == found[1]


def test_partitions_of_a_fit_follow_the_rows(spark):
    for n, parts in ((10, 1), (5_001, 2), (90_000, learning.FIT_PARTITIONS), (1_100_000, 5)):
        rows = spark.range(n).select(F.col("id").alias("student_id"), F.lit(1).alias("course_id"))
        assert learning.settled(rows).rdd.getNumPartitions() == parts


def test_fits_side_by_side_equal_fits_in_turn(prepared):
    names = ["Logistic Regression", "Random Forest", "KNN"]
    outcome = learning.compare_models(prepared, names)
    for row in outcome.comparison.collect():
        alone = learning.binary_metrics(learning.score_with(row.model, prepared, prepared.test), label="noisy_label").first()
        assert [row[m] for m in learning.METRICS] == [alone[m] for m in learning.METRICS]


def test_a_comparison_scores_test_rows_once_and_beside_the_fits(prepared, monkeypatch):
    """Each model scores the test rows in its own pool; the best one is asked for the train rows only."""
    fit_with, asked = learning.fit_with, []

    def told(name, data):
        scorer = fit_with(name, data)

        def score(rows):
            pool = rows.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool")
            asked.append((name, pool == name, {r.is_test for r in rows.select("is_test").distinct().collect()}))
            return scorer(rows)

        return score

    monkeypatch.setattr(learning, "fit_with", told)
    outcome = learning.compare_models(prepared, ["Logistic Regression", "KNN"])
    assert sorted(asked[:2]) == [("KNN", True, {True}), ("Logistic Regression", True, {True})]
    assert [(name, kinds) for name, _, kinds in asked[2:]] == [(outcome.best, {False})]
    alone = fit_with(outcome.best, prepared)(prepared.rows)
    assert outcome.scores.columns == alone.columns
    assert outcome.scores.exceptAll(alone).count() == 0 and alone.exceptAll(outcome.scores).count() == 0


def test_costly_rows_are_dealt_to_more_partitions(spark):
    for n, parts in ((10, 4), (90_000, 4), (150_000, 6), (500_000, learning.MAPPED_PARTITIONS), (4_000_000, 4)):
        rows = spark.range(20).select(F.col("id").alias("student_id"), F.lit(1).alias("course_id")).repartition(4)
        assert learning.finer(rows, n).rdd.getNumPartitions() == parts


def test_landmark_features_equal_the_kernel(spark):
    rng = np.random.default_rng(5)
    x, names = rng.normal(size=(40, len(schemas.FEATURE_COLUMNS))), schemas.FEATURE_COLUMNS
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *names]).repartition(3)
    weights = learning.landmark_weights(x[:8], 0.2)
    mapped = learning._with_landmarks(rows, x[:8], 0.2, weights).orderBy("id")
    found = np.array([r.features.toArray() for r in mapped.collect()])
    assert np.allclose(found, learning.kernel(x, x[:8], 0.2) @ weights, atol=1e-12)


def test_an_error_of_one_task_is_raised_after_all_ended(spark):
    ended = []
    with pytest.raises(ZeroDivisionError):
        learning.side_by_side(spark, {"a": lambda: 1 / 0, "b": lambda: ended.append(spark.range(1000).count())})
    assert ended == [1000]
    assert learning.side_by_side(spark, {}) == {}


def test_checks_fail_a_constant_score(prepared):
    model = learning.fit_logistic(prepared.train)
    assert learning.logistic_gradient(model, prepared.train) < 1e-4
    scored = learning.apply_model(model, prepared.test)
    assert learning.area_under_curve(scored) > 0.75
    expected = prepared.test.select(*learning.KEY, learning.linear_score(model).alias("p"))
    off = scored.join(expected, learning.KEY).agg(F.max(F.abs(F.col("p") - F.col("risk_probability")))).first()[0]
    assert off < 1e-9
    constant = scored.withColumn("risk_probability", F.lit(0.5))
    loss, best = learning.log_loss(constant)
    assert learning.area_under_curve(constant) == 0.5 and loss >= best
    none = learning.fit_logistic(prepared.train, penalty=1e-9)  # all coefficients near zero
    assert learning.logistic_gradient(none, prepared.train) > 1e-2


def _exact_svm(k, y, c, steps=200_000):
    """Dual of the kernel SVM by pairs of variables: decision values of the rows."""
    alpha, slope = np.zeros(len(y)), -np.ones(len(y))
    for _ in range(steps):
        up = ((y > 0) & (alpha < c)) | ((y < 0) & (alpha > 0))
        low = ((y > 0) & (alpha > 0)) | ((y < 0) & (alpha < c))
        value = -y * slope
        i, j = np.where(up, value, -np.inf).argmax(), np.where(low, value, np.inf).argmin()
        if value[i] - value[j] < 1e-4:
            break
        step = (value[i] - value[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        step = min(step, c - alpha[i] if y[i] > 0 else alpha[i], alpha[j] if y[j] > 0 else c - alpha[j])
        alpha[i] += y[i] * step
        alpha[j] -= y[j] * step
        slope += y * step * (k[:, i] - k[:, j])
    return k @ (alpha * y) + (value[i] + value[j]) / 2


def test_landmark_svm_agrees_with_an_exact_kernel_svm(prepared):
    train = prepared.train.orderBy(*learning.KEY).limit(300).checkpoint()
    rows = train.orderBy(*learning.KEY).collect()
    x = np.array([[r[c] for c in schemas.FEATURE_COLUMNS] for r in rows])
    y = np.array([1.0 if r.noisy_label else -1.0 for r in rows])
    gamma = 1 / (x.shape[1] * x.var())
    exact = _exact_svm(learning.kernel(x, x, gamma), y, 0.5)
    for landmarks, least in ((300, 0.98), (100, 0.95)):
        model = learning.fit_kernel_svm(train, 0.5, landmarks)
        assert abs(model.gamma - gamma) < 1e-9 and len(model.landmarks) == landmarks
        scored = model.margins(train).orderBy(*learning.KEY).collect()
        margin = np.array([r.margin[0] for r in scored])
        assert np.mean((margin > 0) == (exact > 0)) >= least
        assert np.corrcoef(margin, exact)[0, 1] > 0.97


def test_probabilities_of_the_svm_are_of_rows_it_has_not_seen(prepared):
    model = learning.fit_kernel_svm(prepared.train)
    scored = model.score(prepared.test).checkpoint()
    loss, constant = learning.log_loss(scored)
    assert loss < 0.95 * constant
    told, base = scored.agg(F.avg("risk_probability"), F.avg("noisy_label")).first()
    assert abs(told - base) < 0.08
    # Monotone in the margin.
    margins = model.margins(prepared.test).select(*learning.KEY, F.col("margin")).collect()
    by_key = {(r.student_id, r.course_id): r.margin[0] for r in margins}
    ranked = sorted((by_key[r.student_id, r.course_id], r.risk_probability) for r in scored.collect())
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(ranked, ranked[1:]))


def test_fits_on_a_bounded_number_of_rows(prepared):
    train = prepared.train
    some = learning.at_most(train, 100)
    assert some.count() == 100 and some.exceptAll(train).count() == 0
    assert learning.at_most(train, 10_000) is train


def test_the_svm_is_fitted_on_all_train_rows(prepared):
    train = prepared.train
    x = np.array(train.select(*schemas.FEATURE_COLUMNS).collect(), float)
    models = [learning.fit_kernel_svm(train, landmarks=20, rows=rows) for rows in (100, len(x))]
    for model in models:
        assert model.gamma == pytest.approx(1 / (x.shape[1] * x.var()))
    assert np.allclose(models[0].svm.coefficients.toArray(), models[1].svm.coefficients.toArray())
    assert np.allclose(models[0].platt.coefficients.toArray(), models[1].platt.coefficients.toArray())


def test_ties_go_to_the_first_model(spark):
    rows = [("SVM", 0.9, 0.9, 0.9, 0.9), ("Logistic Regression", 0.9, 0.9, 0.9, 0.9), ("KNN", 0.1, 0.1, 0.1, 0.1)]
    frame = spark.createDataFrame(rows, ["model", *learning.METRICS])
    best = learning.best_model(frame)
    assert best.first().model == "Logistic Regression"
    assert [r.metric for r in learning.evaluation_rows(best).collect()] == ["Accuracy", "Precision", "Recall", "F1-Score"]


def test_metrics_without_positives(spark):
    frame = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    row = learning.binary_metrics(frame).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_marts_from_scores(training, prepared):
    outcome = learning.compare_models(prepared, ["Logistic Regression"])
    scores = marts.student_course_scores(learning.attach_scores(training, outcome.scores))
    assert scores.columns == schemas.SCORE_COLUMNS and scores.count() == training.count()
    assert marts.student_features(scores).columns == schemas.STUDENT_COLUMNS
    assert marts.risk_by_course(scores).columns == schemas.RISK_BY_COURSE_COLUMNS


def _brute(train, queries, k):
    found = {}
    t = np.array([r[2:] for r in train], dtype=float)
    keys = [(r[0], r[1]) for r in train]
    for q in queries:
        d = ((t - np.array(q)) ** 2).sum(axis=1)
        found[q] = sorted((round(x, 9), key) for x, key in zip(d, keys))[:k]
    return found


def test_neighbors_match_brute_force_on_skewed_points(spark, tmp_path):
    """A third of the points are copies of one vector, another part shares most coordinates."""
    ensure_checkpoint_dir(spark)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 4)).round(2)
    x[:300] = 0.0
    x[300:500, :3] = 1.0
    train = [(i, i % 2, *map(float, row)) for i, row in enumerate(x)]
    queries = sorted({tuple(map(float, r)) for r in np.vstack([rng.normal(size=(60, 4)).round(2), x[::20]])})
    names = ["a", "b", "c", "d"]
    points = spark.createDataFrame(train, ["id", "label", *names])
    asked = spark.createDataFrame(queries, names)
    got = neighbors.nearest_neighbors(points, asked, names, ["id"], "label", k=5, cell_rows=40).collect()
    found = {}
    for r in got:
        found.setdefault(tuple(r[n] for n in names), []).append((round(r.distance, 9), (r.id, r.label)))
    assert {q: sorted(v) for q, v in found.items()} == _brute(train, queries, 5)


def _points(spark, x):
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = [(i, i % 2, *map(float, row)) for i, row in enumerate(x)]
    return names, rows, spark.createDataFrame(rows, ["id", "label", *names])


@pytest.mark.parametrize("cell_rows, k", [(12, 5), (100, 1), (10_000, 7)])
def test_neighbors_match_brute_force_on_grids_and_lines(spark, cell_rows, k):
    """Many equal distances and equal coordinates; far queries; cells smaller than k copies."""
    rng = np.random.default_rng(11)
    grid = rng.integers(0, 4, size=(300, 3)).astype(float)
    line = np.zeros((200, 3))
    line[:, 1] = np.arange(200) / 8
    names, train, points = _points(spark, np.vstack([grid, line, [[1e9, -1e9, 0]]]))
    queries = sorted({tuple(map(float, r)) for r in np.vstack([grid[:40], line[::9], rng.normal(size=(20, 3)), [[1e12, 0, 0]]])})
    got = neighbors.nearest_neighbors(points, spark.createDataFrame(queries, names), names, ["id"], "label", k, cell_rows).collect()
    found = {}
    for r in got:
        found.setdefault(tuple(r[n] for n in names), []).append((round(r.distance, 9), (r.id, r.label)))
    assert {q: sorted(v) for q, v in found.items()} == _brute(train, queries, k)


def test_fewer_points_than_neighbors(spark):
    names, _, points = _points(spark, np.array([[0.0, 1.0], [2.0, 3.0]]))
    asked = spark.createDataFrame([(0.0, 0.0)], names)
    assert neighbors.nearest_neighbors(points, asked, names, ["id"], "label", 5).count() == 2
    assert neighbors.nearest_neighbors(points.limit(0), asked, names, ["id"], "label", 5).count() == 0


def test_visits_of_a_query_stay_few_as_cells_grow_tenfold(spark):
    rng = np.random.default_rng(5)
    mean = []
    for n in (4_000, 40_000):
        names = ["a", "b", "c"]
        x = rng.normal(size=(n, 3))
        frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *names])
        tree, placed = neighbors._cut(frame, names, ["id"], 1, 100)
        sizes = placed.groupBy("cell").count().agg(F.max("count"), F.count("*")).first()
        assert sizes[0] <= 100 and n / 100 <= sizes[1] <= 6 * n / 100
        boxes = neighbors._boxed(tree, placed, names)
        near = np.sort(((x[:200, None, :] - x[None, :, :]) ** 2).sum(axis=2), axis=1)[:, 5]
        row, _ = boxes.walk(x[:200], np.zeros(200, np.int64), near, np.full(200, -1))
        mean.append(len(row) / 200)
    assert mean[1] < 1.5 * mean[0] and mean[1] < 12


def test_a_fit_and_its_checks_compute_the_features_once(spark, data, monkeypatch):
    built = []
    real = features.pair_statistics
    monkeypatch.setattr(features, "pair_statistics", lambda *a, **k: built.append(1) or real(*a, **k))
    row = catalog.queries()["m5_logistic_regression"](spark, data).first()
    assert row.stationary and len(built) == 1


def test_the_single_model_computes_the_features_once(spark, data, monkeypatch):
    built = []
    real = features.pair_statistics
    monkeypatch.setattr(features, "pair_statistics", lambda *a, **k: built.append(1) or real(*a, **k))
    prepared = []
    prepare = learning.prepare
    monkeypatch.setattr(learning, "prepare", lambda *a, **k: prepared.append(1) or prepare(*a, **k))
    assert catalog.queries()["m15_single_model"](spark, data).where("not scored").count() == 0
    assert len(built) == 1 and len(prepared) == 1


def test_the_saved_model_reads_stored_training_rows(spark, data, monkeypatch):
    given = []
    real = learning.score_new
    monkeypatch.setattr(learning, "score_new", lambda rows, *a: given.append(rows) or real(rows, *a))
    assert catalog.queries()["m14_saved_model"](spark, data).first().same_after_reload
    assert "training-" in given[0].inputFiles()[0]


def test_a_search_emits_nothing_beyond_the_bound(spark):
    names, _, points = _points(spark, np.arange(40, dtype=float).reshape(-1, 1))
    visits = spark.createDataFrame([(10.0, 4.0, 0), (30.2, float("inf"), 0)], "x0 double, bound double, cell bigint")
    placed = points.withColumn("cell", F.lit(0).cast("bigint"))
    got = neighbors._search(visits, placed, names, ["id"], "label", 5).collect()
    assert sorted((r.x0, r.id) for r in got) == [(10.0, i) for i in range(8, 13)] + [(30.2, i) for i in range(28, 33)]
    close = visits.withColumn("bound", F.lit(1.0))
    got = neighbors._search(close, placed, names, ["id"], "label", 5).collect()
    assert sorted((r.x0, r.id) for r in got) == [(10.0, 9), (10.0, 10), (10.0, 11), (30.2, 30), (30.2, 31)]
