"""The classifier against a solver of its own, in numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from poststream.operators import model as ml


def rows(spark, n=240, classes=("Backend", "Frontend", "Cloud")):
    rng = np.random.default_rng(11)
    words = ["python", "aws", "react", "css", "sql", "go"]
    made = []
    for i in range(n):
        c = int(rng.integers(0, len(classes)))
        near = [words[2 * c % 6], words[(2 * c + 1) % 6]]
        own = [w for w in words if rng.random() < (0.6 if w in near else 0.2)] or ["sql"]
        own += [own[0]] * int(rng.integers(0, 2))       # repeated skills count twice
        made.append((str(i), ", ".join(own), classes[c]))
    return spark.createDataFrame(made, "id string, skills string, category string").cache()


def counts(data):
    """(tokens, rows x tokens counts, label numbers, label names) by the definitions."""
    got = [(r.id, r.skills, r.category) for r in data.collect()]
    names = sorted({c for _, _, c in got}, key=lambda c: (-sum(g[2] == c for g in got), c))
    tokens = sorted({t for _, s, _ in got for t in s.split(", ")})
    x = np.array([[s.split(", ").count(t) for t in tokens] for _, s, _ in got], float)
    y = np.array([names.index(c) for _, _, c in got])
    return [g[0] for g in got], tokens, x, y, names


def solve(x, y, k, reg, steps=60):
    """Softmax regression by Newton steps: mean log loss plus an L2 penalty on the
    weights of the columns scaled to unit deviation; intercepts are free."""
    sd = x.std(axis=0, ddof=1)
    z = np.hstack([np.where(sd > 0, x / np.where(sd > 0, sd, 1), 0), np.ones((len(x), 1))])
    d = z.shape[1]
    penalty = np.kron(np.eye(k), np.diag([reg] * (d - 1) + [0.0]))
    w, hot = np.zeros(k * d), np.eye(k)[y]
    for _ in range(steps):
        m = z @ w.reshape(k, d).T
        p = np.exp(m - m.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = ((p - hot).T @ z / len(x)).ravel() + penalty @ w
        h = penalty.copy()
        for a in range(k):
            for b in range(k):
                s = p[:, a] * ((a == b) - p[:, b])
                h[a * d:(a + 1) * d, b * d:(b + 1) * d] += (z * s[:, None]).T @ z / len(x)
        w -= np.linalg.lstsq(h, g, rcond=None)[0]
    w = w.reshape(k, d)
    w[:, -1] -= w[:, -1].mean()         # intercepts are told apart by their mean alone
    return np.where(sd > 0, w[:, :-1] / np.where(sd > 0, sd, 1), 0), w[:, -1]


def predict(x, w, b):
    return (x @ w.T + b).argmax(axis=1)


def fitted(data, train, reg, max_iter=400):
    pipeline = ml.build_classifier(ml.fit_label_indexer(data), max_iter=max_iter, reg_param=reg)
    ml._lr(pipeline).setTol(1e-12)  # noqa: SLF001
    return pipeline.fit(train)


@pytest.mark.parametrize("reg", [0.01, 0.1])
def test_weights_equal_an_independent_fit(spark, reg):
    data = rows(spark)
    model = fitted(data, data, reg)
    _, tokens, x, y, names = counts(data)
    w, b = solve(x, y, len(names), reg)
    hashing = ml._stage(model, ml.HashingTF)  # noqa: SLF001
    slots = [hashing.indexOf(t) for t in tokens]
    lr = ml._stage(model, ml.LogisticRegressionModel)  # noqa: SLF001
    assert np.abs(lr.coefficientMatrix.toArray()[:, slots] - w).max() < 1e-3
    base = lr.interceptVector.toArray()
    assert np.abs(base - base.mean() - b).max() < 1e-3


def test_holdout_accuracy_and_grid_equal_an_independent_search(spark):
    data = ml.holdout(rows(spark)).cache()
    train = data.where("split = 'train'")
    ids, _, x, y, names = counts(data)
    kept = {r.id for r in train.collect()}
    own = np.array([i in kept for i in ids])
    w, b = solve(x[own], y[own], len(names), 0.01)
    want = (predict(x[~own], w, b) == y[~own]).mean()
    got = ml.accuracy(ml.score(data.where("split = 'test'"), fitted(data, train, 0.01))).first()[0]
    assert abs(got - want) < 1e-3
    # all four grid points: run to their end, the number of steps makes no difference
    pipeline = ml.build_classifier(ml.fit_label_indexer(data))
    ml._lr(pipeline).setTol(1e-12)  # noqa: SLF001
    grid = ml.param_grid(pipeline, max_iter=(300, 400), reg_param=(0.01, 0.1))
    report = ml.tune_report(ml.tune(train, pipeline, grid, folds=3))
    assert len(report) == 4
    folds = {r.id: r.f for r in train.select("id", ml.bucket("id", 3).alias("f")).collect()}
    fold = np.array([folds.get(i, -1) for i in ids])
    for _, reg, mean in report:
        want = []
        for f in range(3):
            w, b = solve(x[own & (fold != f)], y[own & (fold != f)], len(names), reg)
            want.append((predict(x[fold == f], w, b) == y[fold == f]).mean())
        assert abs(mean - np.mean(want)) < 1e-3


@pytest.mark.parametrize("classes", [("a", "b"), ("a", "b", "c")])
def test_score_by_join_equals_the_pipeline(spark, classes):
    data = rows(spark, 120, classes)
    model = ml.build_classifier(ml.fit_label_indexer(data), max_iter=20).fit(data)
    odd = data.unionByName(spark.createDataFrame(
        [("n1", "", "a"), ("n2", "never seen, nor this", "a"), ("n3", "aws,, ,aws , go", "b")], data.schema))
    want = {r.id: r.predicted_category for r in ml.score(odd, model).collect()}
    got = {r.id: r.predicted_category for r in ml.score_by_join(odd.repartition(5), model).collect()}
    assert got == want and len(set(want.values())) == len(classes)
    weights, labels = ml.weights_table(spark, model)
    assert weights.count() <= 6 * len(classes) and labels.count() == len(classes)
    assert ml.score_by_join(data.limit(0), model).count() == 0
    assert weights.where(F.col("weight") == 0).count() == 0
