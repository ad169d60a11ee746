"""Forests grown together against a plain learner, and searches against refitting every draw."""

import numpy as np
import pytest

from kandela.operators import forests as R
from kandela.schemas import FEATURE_COLUMNS


def series(symbols, rows=90, seed=3):
    from datetime import datetime, timedelta

    r = np.random.default_rng(seed)
    out = []
    for s in symbols:
        for i in range(rows):
            x = np.round(r.normal(size=R.WIDTH), 1)
            y = int(x[0] + 0.5 * x[3] * (x[5] > 0) + 0.3 * r.normal() > 0)
            out.append((s, "1h", datetime(2024, 1, 1) + timedelta(hours=i), y, 2.0 if y else 0.75, *map(float, x)))
    return out


COLUMNS = "symbol string, interval string, open_time timestamp, target int, weight double, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(series(["A", "B"]), COLUMNS).repartition(3)


def plain_tree(rows, tree, fit, w0, w1, node=1, depth=0):
    """One node at a time: rows are (bins, y, times)."""
    rows = [r for r in rows if r[2]]
    if not rows:
        return []
    n = [sum(t for _, y, t in rows if y == label) for label in (0, 1)]

    def impurity(a, b):
        a, b = a * w0, b * w1
        return a + b - (a * a + b * b) / (a + b) if a + b > 0 else 0.0

    best = (1e-9, -1, -1)
    for f in R.allowed(tree, np.array([node]), fit.tried)[0] if depth < fit.depth else []:
        for cut in range(R.BINS):
            left = [sum(t for x, y, t in rows if y == label and x[f] <= cut) for label in (0, 1)]
            right = [n[0] - left[0], n[1] - left[1]]
            if min(sum(left), sum(right)) >= fit.least:
                drop = impurity(*n) - impurity(*left) - impurity(*right)
                if drop > best[0]:
                    best = (drop, int(f), cut)
    _, f, cut = best
    out = [(node, depth, f, cut, *n)]
    if f >= 0:
        out += plain_tree([r for r in rows if r[0][f] <= cut], tree, fit, w0, w1, 2 * node, depth + 1)
        out += plain_tree([r for r in rows if r[0][f] > cut], tree, fit, w0, w1, 2 * node + 1, depth + 1)
    return out


FITS = [R.Fit(trees=3, depth=4), R.Fit(trees=2, depth=3, least=4, tried=9)]


def nodes_of(df):
    return sorted(map(tuple, df.collect()))


def test_equals_a_plain_learner(train):
    rows, _ = R.quantised(train)
    got, want = nodes_of(R.grow_together(rows, FITS)), []
    for symbol in ("A", "B"):
        mine = rows.where(f"symbol = '{symbol}'").collect()
        keys = np.array([r.row for r in mine], np.int64)
        for i, fit in enumerate(FITS):
            for tree in range(fit.trees):
                bagged = [(r.bins, r.y, int(t)) for r, t in zip(mine, R.bag(keys, tree))]
                want += [(symbol, i, tree, *x) for x in plain_tree(bagged, tree, fit, 0.75, 2.0)]
    assert got == sorted(want)


@pytest.mark.parametrize("small", [20])
def test_large_series_grow_level_by_level_to_the_same_trees(train, small):
    rows, _ = R.quantised(train)
    assert nodes_of(R.grow_together(rows, FITS, small=small)) == nodes_of(R.grow_together(rows, FITS))


def test_prefix_and_truncation_are_refits(train):
    rows, _ = R.quantised(train)
    whole = [x for x in nodes_of(R.grow_together(rows, [R.Fit(trees=5, depth=5)]))]
    part = nodes_of(R.grow_together(rows, [R.Fit(trees=2, depth=3)]))
    shape = lambda nodes: [(x[0], x[2], x[3], x[6] if x[4] < 3 else -1) for x in nodes]
    assert shape(x for x in whole if x[2] < 2 and x[4] <= 3) == shape(part)


SETTINGS = [{"numTrees": t, "maxDepth": d, "minInstancesPerNode": m, "featureSubsetStrategy": "sqrt"} for t, d, m in ((2, 2, 1), (4, 3, 1), (3, 4, 2))]


def test_search_equals_refitting_every_draw(spark, train, monkeypatch):
    fits, real = [], R.grow_together
    monkeypatch.setattr(R, "grow_together", lambda rows, f, small: fits.append(len(f)) or real(rows, f, small))
    models, scored = R.search(train, [R.as_fit(s) for s in SETTINGS], "OPT")
    assert fits == [2 * (3 + 1)]  # two kinds of forests on three folds and on all rows, in one go
    monkeypatch.undo()
    f1 = {(r.symbol, r.setting): r.f1 for r in scored.collect()}
    numbered = R.with_folds(train, 3)
    rows, _ = R.quantised(numbered, fold="fold")
    held = rows.collect()
    weights = {"A": {}, "B": {}}
    for r in held:
        weights[r.symbol][r.y] = r.weight
    for symbol in ("A", "B"):
        for i, s in enumerate(SETTINGS):
            each = []
            for fold in range(3):
                fit = R.Fit(s["numTrees"], s["maxDepth"], s["minInstancesPerNode"], R.tried_features("sqrt"), fold)
                mine = [r for r in held if r.symbol == symbol and r.fold != fold]
                keys = np.array([r.row for r in mine], np.int64)
                trees = [{x[0]: x for x in plain_tree([(r.bins, r.y, int(t)) for r, t in zip(mine, R.bag(keys, k))], k, fit, 0.75, 2.0)} for k in range(fit.trees)]

                def says(bins):
                    total = 0.0
                    for tree in trees:
                        node = 1
                        while tree[node][2] >= 0:
                            node = 2 * node + (bins[tree[node][2]] > tree[node][3])
                        a, b = tree[node][4] * 0.75, tree[node][5] * 2.0
                        total += b / (a + b)
                    return total / len(trees) > 0.5

                out = [(says(r.bins), r.y) for r in held if r.symbol == symbol and r.fold == fold]
                tp, fp, fn = (sum(x == p for x in out) for p in ((True, 1), (True, 0), (False, 1)))
                each.append(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0)
            assert f1[symbol, i] == pytest.approx(np.mean(each), abs=1e-12)
        best = max(range(len(SETTINGS)), key=lambda i: (f1[symbol, i], -i))
        assert models.where(f"symbol = '{symbol}'").select("tree").distinct().count() == SETTINGS[best]["numTrees"]


def test_scores_walk_the_stored_nodes(train):
    models = R.fit_forests(train, {"one": R.Fit(trees=3, depth=3), "two": R.Fit(trees=2, depth=1)})
    rows = train.drop("weight")
    got = {(r.symbol, r.open_time, r.model): r.prob_buy for r in R.score(rows, models, chunk=25).collect()}
    nodes = {}
    for n in models.collect():
        nodes.setdefault((n.symbol, n.model), {}).setdefault(n.tree, {})[n.node] = n
    assert len(got) == 2 * rows.count()
    for r in rows.collect():
        for name in ("one", "two"):
            said = []
            for tree in nodes[r.symbol, name].values():
                n = tree[1]
                while n.feature >= 0:
                    n = tree[2 * n.node + (r[FEATURE_COLUMNS[n.feature]] > n.threshold)]
                said.append(n.value)
            assert got[r.symbol, r.open_time, name] == pytest.approx(np.mean(said), abs=1e-12)


def test_jobs_do_not_grow_with_series(spark):
    def jobs(symbols, group):
        train = spark.createDataFrame(series(symbols, rows=30), COLUMNS)
        spark.sparkContext.setJobGroup(group, group)
        R.fit_forests(train, {"one": R.Fit(trees=2, depth=2)}, small=5).count()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(list("AB"), "two") >= jobs(list("ABCDEFGHIJ"), "ten") - 3 > 0


def test_empty(spark):
    train = spark.createDataFrame([], COLUMNS)
    models = R.fit_forests(train, {"one": R.Fit(trees=2, depth=2)})
    assert models.count() == 0 and R.score(train.drop("weight"), models).count() == 0
