"""Boosted trees grown together: both ways agree, a plain learner agrees, prefixes are refits."""

import numpy as np
import pytest

from kandela.operators import boosting as B, forests as R
from kandela.schemas import FEATURE_COLUMNS
from test_forests import COLUMNS, series


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(series(["A", "B"], rows=70), COLUMNS).repartition(3)


FITS = [B.Boost(trees=3, depth=2, step=0.3), B.Boost(trees=2, depth=1, step=0.5, share=0.6, tried=5)]


def plain(rows, fit):
    """One node and one cut at a time over (row, y, weight, bins)."""
    margin, out = [0.0] * len(rows), []
    keys = np.array([r[0] for r in rows], np.int64)
    for tree in range(fit.trees):
        inside = B.seen(keys, tree, fit.share)
        features = R.allowed(tree, np.array([1]), fit.tried)[0]
        pull = [tuple(float(x[0]) for x in B.pulls(np.array([m]), np.array([r[1]]), np.array([r[2]]))) for m, r in zip(margin, rows)]
        stack = [(1, 0, list(range(len(rows))))]
        while stack:
            node, depth, mine = stack.pop()
            used = [i for i in mine if inside[i]]
            total = [sum(pull[i][j] for i in used) for j in (0, 1)]
            best = (1e-9, -1, -1)
            for f in features if depth < fit.depth else []:
                for cut in range(R.BINS):
                    left = [sum(pull[i][j] for i in used if rows[i][3][f] <= cut) * B.UNIT for j in (0, 1)]
                    right = [total[j] * B.UNIT - left[j] for j in (0, 1)]
                    if min(left[1], right[1]) >= B.LEAST_CURVATURE:
                        gain = left[0]**2 / (left[1] + 1) + right[0]**2 / (right[1] + 1) - (total[0] * B.UNIT)**2 / (total[1] * B.UNIT + 1)
                        if gain > best[0] + 1e-12:
                            best = (gain, int(f), cut)
            value = 0.0 if best[1] >= 0 else -fit.step * total[0] * B.UNIT / (total[1] * B.UNIT + 1)
            out.append((tree, node, depth, best[1], best[2], pytest.approx(value, abs=1e-12)))
            if best[1] < 0:
                for i in mine:
                    margin[i] += value
            else:
                for side in (0, 1):
                    part = [i for i in mine if (rows[i][3][best[1]] > best[2]) == side]
                    if part:
                        stack.append((2 * node + side, depth + 1, part))
    return sorted(out, key=lambda x: x[:2])


def grown(df):
    return sorted(map(tuple, df.collect()))


def test_equals_a_plain_learner(train):
    rows, _ = R.quantised(train)
    got = grown(B.boost_together(rows, FITS))
    for symbol in ("A", "B"):
        mine = sorted((r.row, r.y, r.weight, r.bins) for r in rows.where(f"symbol = '{symbol}'").collect())
        for i, fit in enumerate(FITS):
            assert [x[2:] for x in got if x[:2] == (symbol, i)] == plain(mine, fit)


def test_large_series_take_the_same_trees(train):
    rows, _ = R.quantised(train)
    large = [B.Boost(trees=2, depth=1, step=0.3, share=0.7)]
    assert grown(B.boost_together(rows, large, small=0)) == grown(B.boost_together(rows, large))


def test_first_trees_are_a_refit_and_search_takes_them(train):
    rows, _ = R.quantised(train)
    whole, part = grown(B.boost_together(rows, [B.Boost(trees=4, depth=2)])), grown(B.boost_together(rows, [B.Boost(trees=2, depth=2)]))
    assert [x for x in whole if x[2] < 2] == part
    models, scored = R.search(train, [B.Boost(trees=t, depth=2, step=0.4) for t in (1, 3)], "OPT", family=B.BOOSTED)
    f1 = {(r.symbol, r.setting): r.f1 for r in scored.collect()}
    for symbol in ("A", "B"):
        best = max((0, 1), key=lambda i: (f1[symbol, i], -i))
        assert models.where(f"symbol = '{symbol}'").select("tree").distinct().count() == (1, 3)[best]


def test_scores_are_sums_of_leaves(train):
    models = R.fit_forests(train, {"m": B.Boost(trees=3, depth=2)}, family=B.BOOSTED)
    nodes = {}
    for n in models.collect():
        nodes.setdefault(n.symbol, {}).setdefault(n.tree, {})[n.node] = n
    for r in R.score(train.drop("weight"), models).collect():
        total = 0.0
        for tree in nodes[r.symbol].values():
            n = tree[1]
            while n.feature >= 0:
                n = tree[2 * n.node + (r[FEATURE_COLUMNS[n.feature]] > n.threshold)]
            total += n.value
        assert r.prob_buy == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)


def random_rows(n, seed=5):
    r = np.random.default_rng(seed)
    bins = r.integers(0, R.BINS, (n, R.WIDTH)).astype(np.uint8)
    y = (bins[:, 3] + 0.5 * bins[:, 8] + 8 * r.normal(size=n) > 26).astype(np.int32)
    return bins, y, np.where(y == 1, 1.6, 0.7), r.integers(-2**62, 2**62, n)


def plain_nodes(levels):
    return sorted(tuple(x.item() for x in row) for level in levels for row in zip(*level))


@pytest.mark.parametrize("few, paired", [(0, 0), (0, 10**9), (3_000, 20)])
def test_every_way_of_counting_gives_the_same_trees(monkeypatch, few, paired):
    bins, y, weight, keys = random_rows(700)
    fit, columns, one = B.Boost(trees=6, depth=4, share=0.7, tried=13), np.ascontiguousarray(bins.T), np.zeros(700, np.int32)
    want = plain_nodes(B.boost(columns, y, weight, keys, one, fit))
    monkeypatch.setattr(B, "FEW", few)
    monkeypatch.setattr(B, "PAIRED", paired)
    assert plain_nodes(B.boost(columns, y, weight, keys, one, fit)) == want and len(want) > 100


def test_series_that_share_a_task_get_their_own_trees():
    bins, y, weight, keys = random_rows(600)
    of = np.random.default_rng(1).integers(0, 3, 600).astype(np.int32)
    weights = np.array([0.7, 0.8, 0.9]), np.array([1.6, 1.2, 1.1])
    boost, forest, columns = B.Boost(trees=4, depth=3), R.Fit(trees=1, depth=4, least=2), np.ascontiguousarray(bins.T)
    boosted = plain_nodes(B.boost(columns, y, weight, keys, of, boost))
    grown = plain_nodes(R.grow(columns, y, R.bag(keys, 0), of, 0, forest, *weights))
    for series in range(3):
        mine = of == series
        part, none = np.ascontiguousarray(bins[mine].T), np.zeros(mine.sum(), np.int32)
        alone = plain_nodes(B.boost(part, y[mine], weight[mine], keys[mine], none, boost))
        assert [(x[0], 0, *x[2:]) for x in boosted if x[1] == series] == alone
        alone = plain_nodes(R.grow(part, y[mine], R.bag(keys[mine], 0), none, 0, forest, weights[0][[series]], weights[1][[series]]))
        assert [(0, *x[1:]) for x in grown if x[0] == series] == alone


def test_jobs_of_a_series_of_years_do_not_grow_with_its_trees(spark):
    from pyspark.sql import functions as F

    hour = F.timestamp_seconds(F.col("id") * 3600)
    train = spark.range(20_500).select(
        F.lit("A").alias("symbol"), F.lit("1h").alias("interval"), hour.alias("open_time"), F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("target"),
        F.lit(1.0).alias("weight"), *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 10).alias(c) for i, c in enumerate(FEATURE_COLUMNS)])
    rows, _ = R.quantised(train)

    def jobs(trees):
        group = f"trees-{trees}"
        spark.sparkContext.setJobGroup(group, group)
        assert B.boost_together(rows, [B.Boost(trees=trees, depth=1)]).count() == 3 * trees
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(1) == jobs(3) > 0
