"""The tree learner: exact sums, the same trees from tasks and from level jobs, patience, penalties."""

import numpy as np
import pytest

from tidecast.operators import boosting as B
from tidecast.operators import train as TR
from tidecast.session import fresh_path

P = {**TR.DEFAULTS, "n_estimators": 7, "max_depth": 3, "learning_rate": 0.3, "early_stopping_rounds": 3}
NAMES = ["a", "b", "c", "d"]


def data(seed=1, n=700):
    r = np.random.default_rng(seed)
    x = np.stack([r.normal(size=n), r.integers(0, 5, n), r.exponential(size=n), r.normal(size=n)], axis=1)
    y = 100 * (x[:, 0] > 0.2) + 30 * x[:, 1] * (x[:, 2] < 1) + r.normal(size=n)
    return x, y, r.random(n) < 0.2, r.integers(-(1 << 63), 1 << 63, n)


def frame(spark, model="m", seed=1, parts=1, n=700):
    x, y, held, h = data(seed, n)
    rows = [(model, int(a), float(b), bool(c), [float(v) for v in d]) for a, b, c, d in zip(h, y, held, x)]
    return spark.createDataFrame(rows, B.ROWS).repartition(parts)


def bits(model):
    return [t.row("", i) for i, t in enumerate(model.trees)], model.base


def test_histogram():
    r = np.random.default_rng(3)
    bins, node, q = r.integers(0, 256, (500, 3)).astype(np.uint8), r.integers(0, 2, 500), r.integers(-(1 << 40), 1 << 40, 500)
    want = np.zeros((2, 2, 256, 2), np.int64)
    for b, n, g in zip(bins, node, q):
        for i, c in enumerate((0, 2)):
            want[n, i, b[c]] += (g, 1)
    assert (B.histogram(bins, node, q, np.array([0, 2]), 2) == want).all()


@pytest.mark.parametrize("more", [{}, {"reg_lambda": 50.0, "reg_alpha": 40.0, "min_child_weight": 30, "gamma": 5000.0}])
def test_split_is_the_best_of_all(more):
    x, y, _, _ = data()
    p = {**P, **more}
    plan = B.Plan.of(p, len(y), float(y.mean()), float(np.abs(y).max() * 2), 4)
    edges = [np.unique(x[:, i])[:-1] if len(np.unique(x[:, i])) <= 256 else np.quantile(x[:, i], np.arange(1, 256) / 256, method="lower") for i in range(4)]
    bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1).astype(np.uint8)
    g = plan.base - y
    soft = lambda s: max(abs(s) - p.get("reg_alpha", 0), 0) ** 2
    fits = lambda s: soft(s.sum()) / (len(s) + p.get("reg_lambda", 1.0))
    best = (p["gamma"], None, None)
    for f in range(4):
        for cut in range(255):
            left = bins[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= p["min_child_weight"]:
                gain = fits(g[left]) + fits(g[~left]) - fits(g)
                if gain > best[0] + 1e-6:
                    best = (gain, f, cut)
    tree = B.Tree.empty(1)
    sums = B.histogram(bins, np.zeros(len(y), int), plan.gradients(np.full(len(y), plan.base), y), np.arange(4), 1)
    plan.split(tree, 0, sums[0], np.arange(4), False)
    assert (tree.feature[0], tree.cut[0]) == best[1:] and tree.gain[0] == pytest.approx(best[0], rel=1e-6)
    want = -p["learning_rate"] * np.sign(g.sum()) * max(abs(g.sum()) - p.get("reg_alpha", 0), 0) / (len(y) + p.get("reg_lambda", 1.0))
    assert tree.value[0] == pytest.approx(want, abs=1e-6)


def test_layouts_tasks_and_levels_agree(spark, monkeypatch):
    """Two models at once or apart, in tasks or by level jobs, from one partition or seven: the same bits."""
    monkeypatch.setattr(B, "STORE_EVERY", 2)
    both = frame(spark, "m", 1, 1).union(frame(spark, "n", 2, 1, 300))
    want = B.fit(both, NAMES, P)
    assert {m: len(b.trees) for m, b in want.items()}["m"] >= 3
    for got in (B.fit(both.repartition(7), NAMES, P), B.fit(both.repartition(3), NAMES, P, task_rows=0), B.fit(both, NAMES, P, task_rows=500)):
        assert {m: bits(b) for m, b in got.items()} == {m: bits(b) for m, b in want.items()}
    apart = B.fit(frame(spark, "m", 1, 4), NAMES, {**P, "early_stopping_rounds": 0})["m"]
    assert len(apart.trees) == 7


def test_patience_keeps_a_prefix():
    r = B.Rounds(B.Plan.of({**P, "n_estimators": 50}, 10, 0.0, 1.0, 4), True)
    for i, loss in enumerate([9, 7, 8, 7, 6, 7, 6, 8, 5]):
        if r.done:
            break
        r.add(B.Tree.empty(1), loss)
    assert (i, r.at, len(r.kept())) == (8, 5, 5)
    full = B.Rounds(B.Plan.of({**P, "n_estimators": 3}, 10, 0.0, 1.0, 4), True)
    for loss in (3, 2, 1):
        full.add(B.Tree.empty(1), loss)
    assert full.done and len(full.kept()) == 3


def test_it_learns_and_stops(spark):
    x, y, held, _ = data(5, 3000)
    model = B.fit(frame(spark, seed=5, parts=3, n=3000), NAMES, {**P, "n_estimators": 300, "early_stopping_rounds": 20})["m"]
    got = model.predict(np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(model.edges)], axis=1).astype(np.uint8))
    assert np.abs(got - y)[held].mean() < 0.1 * np.abs(y - y.mean())[held].mean()
    assert len(model.trees) < 300
    assert sum(model.importance().values()) == pytest.approx(1) and min(model.importance(), key=model.importance().get) == "d"


def test_save_and_load(spark):
    model = B.fit(frame(spark), NAMES, P)["m"]
    path = fresh_path(spark, "model")
    model.save(spark, path)
    again = B.Booster.load(spark, path)
    assert bits(again) == bits(model) and [e.tolist() for e in again.edges] == [e.tolist() for e in model.edges]
    rows = spark.createDataFrame([([0.3, 1.0, 0.5, 0.0],), ([-9.0, 99.0, 9.0, 1.0],)], "features array<double>")
    a, b = ([r["prediction"] for r in m.transform(rows).collect()] for m in (model, again))
    assert a == b and a[0] > a[1]


def test_few_rows_and_constant_features(spark):
    rows = [("one", 1, 5.0, False, [1.0, 1.0, 1.0, 1.0]), ("held", 2, 5.0, True, [1.0] * 4), *[("same", i, 2.0, False, [float(i)] * 4) for i in range(40)]]
    got = B.fit(spark.createDataFrame(rows, B.ROWS), NAMES, P)
    assert set(got) == {"one", "same"} and got["one"].base == 5.0
    assert all((t.feature < 0).all() and (t.value == 0).all() for b in got.values() for t in b.trees)
    assert B.fit(spark.createDataFrame([], B.ROWS), NAMES, P) == {}


def test_a_tree_takes_a_job_per_level(spark):
    """No job for a loss or for the last level, and one count of rows for two children."""
    sc, rows = spark.sparkContext, frame(spark, parts=3)
    sc.setJobGroup("trees", "trees of a large model")
    try:
        model = B.fit(rows, NAMES, {**P, "early_stopping_rounds": 0}, task_rows=0)["m"]
    finally:
        sc._jsc.clearJobGroup()
    assert len(model.trees) == 7
    assert len(sc.statusTracker().getJobIdsForGroup("trees")) <= 7 * P["max_depth"] + 20  # a loss and a level more: 14 jobs more, and more shuffles


def test_children_by_the_rest_of_their_parent():
    x, y, _, h = data()
    plan = B.Plan.of(P, len(y), float(y.mean()), float(np.abs(y).max() * 2), 4)
    bins = np.stack([np.searchsorted(np.quantile(x[:, i], np.arange(1, 256) / 256), x[:, i]) for i in range(4)]).astype(np.uint8)
    q, node, growth, seen = plan.gradients(np.full(len(y), plan.base), y), np.zeros(len(y), int), B.Growth(plan, 0), []
    while growth.counted:
        seen.append(int(np.isin(node, growth.counted).sum()))
        growth.take(growth.sums(bins, node, q))
        node = growth.tree.down(bins.T, node)
    assert seen[0] == len(y) and all(n <= len(y) / 2 for n in seen[1:]) and len(seen) == P["max_depth"]
    for leaf in set(node.tolist()):
        assert growth.tree.value[leaf] == plan.leaf(int(q[node == leaf].sum()), int((node == leaf).sum()))


def test_sums_of_many_tasks_are_added_in_tasks(spark, monkeypatch):
    want = B.fit(frame(spark), NAMES, P)["m"]
    monkeypatch.setattr(B, "SENT", 2)
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    assert bits(B.fit(frame(spark), NAMES, P, task_rows=0)["m"]) == bits(want)
