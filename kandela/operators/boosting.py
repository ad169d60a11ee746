"""Boosted trees of many series, folds and settings grown together.

Each tree follows the gradients that the trees before it leave. Gradients and curvatures are rounded to whole multiples of
``UNIT``, so their sums do not depend on the order of rows and a split is the same wherever it is found; which rows and
features a tree sees follows from hashes. A series of at most ``small`` rows is boosted in one task, which short series share. A
level counts two features at a time and only the smaller of two siblings: the other is what is left of their parent. Larger ones take
one aggregate per tree and level over (series, fit, node, feature, bin) for all of them at once; the rows' margins
are stored after every tree. So the number of jobs follows trees x depth of the large series, not their number.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kandela.operators.forests import BINS, SMALL_ROWS, WIDTH, Family, _first, _matrix, _mix, allowed, pack, series_of, spread, stacked, unpacked, with_units
from kandela.session import materialise

UNIT = 2.0**-20
PENALTY = 1.0  # on squared leaf values
LEAST_CURVATURE = 1e-3

NODES = "symbol string, fit int, tree int, node long, depth int, feature int, bin int, value double"
_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
_NAMES = ["symbol", "fit", "tree", "node", "depth", "feature", "bin", "value"]


@dataclass(frozen=True)
class Boost:
    """One boosted model per series: grown without the rows of ``left_out`` (-1: with all rows)."""

    trees: int = 150
    depth: int = 4
    step: float = 0.05
    share: float = 0.8  # of the rows each tree sees
    tried: int = math.ceil(0.8 * WIDTH)  # features each tree sees
    left_out: int = -1


def as_fit(setting: Mapping, base: Boost = Boost()) -> Boost:
    """A point of a search grid under its MLlib names; what it leaves out is as in ``base``."""
    known = {"trees": "maxIter", "depth": "maxDepth", "step": "stepSize", "share": "subsamplingRate"}
    found = {ours: setting[theirs] for ours, theirs in known.items() if theirs in setting}
    if "featureSubsetStrategy" in setting:
        found["tried"] = math.ceil(float(setting["featureSubsetStrategy"]) * WIDTH)
    return replace(base, **found)


def seen(rows: np.ndarray, tree: int, share) -> np.ndarray:
    u = _mix(rows.view(np.uint64) ^ _mix(np.array([tree + 7919], np.uint64)))
    return (u >> np.uint64(11)) * 2.0**-53 < share


def pulls(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the weighted log loss in whole units."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - y) * weight / UNIT), np.rint(np.maximum(p * (1 - p), 1e-6) * weight / UNIT)


def choose(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature (its place, -1: none) and last bin on the left of each node from sums by (node, feature, bin)."""
    g, h = g * UNIT, h * UNIT
    left_g, left_h = g.cumsum(2), h.cumsum(2)
    all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    worth = lambda a, b: a * a / (b + PENALTY)
    gain = worth(left_g, left_h) + worth(right_g, right_h) - worth(all_g, all_h)
    gain = np.where((left_h >= LEAST_CURVATURE) & (right_h >= LEAST_CURVATURE), gain, -1.0).reshape(len(g), -1)
    best = gain.argmax(1)
    found = gain[np.arange(len(best)), best] > 1e-9
    return np.where(found, best // g.shape[2], -1), np.where(found, best % g.shape[2], -1)


def leaf(g, h, step: float):
    return -step * (g * UNIT) / (h * UNIT + PENALTY)


FEW = 100_000  # cells that are counted in one call
PAIRED = 1_024  # rows a node for which two features are counted at a time


def _sums(at: np.ndarray, columns: np.ndarray, pairs: np.ndarray, values: Sequence[np.ndarray], n: int) -> list[np.ndarray]:
    """Sums of each of ``values`` by (node, feature, bin); ``at`` is the node of each row. Whole numbers, so any order is exact."""
    tried, rows = columns.shape
    if tried * rows <= FEW:
        cell = ((at * tried * BINS) + np.arange(0, tried * BINS, BINS)[:, None] + columns).ravel()
        return [np.bincount(cell, np.tile(v, tried), n * tried * BINS).reshape(n, tried, BINS) for v in values]
    out = [np.empty((n, tried, BINS)) for _ in values]
    paired = len(pairs) if rows >= PAIRED * n else 0
    base = at * BINS * BINS
    for i in range(paired):
        cell = base + pairs[i]
        for o, v in zip(out, values):
            both = np.bincount(cell, v, n * BINS * BINS).reshape(n, BINS, BINS)
            o[:, 2 * i], o[:, 2 * i + 1] = both.sum(2), both.sum(1)
    base = at * BINS
    for f in range(2 * paired, tried):
        cell = base + columns[f]
        for o, v in zip(out, values):
            o[:, f] = np.bincount(cell, v, n * BINS).reshape(n, BINS)
    return out


def boost(columns: np.ndarray, y: np.ndarray, weight: np.ndarray, keys: np.ndarray, series: np.ndarray, fit: Boost) -> list[tuple]:
    """Per level arrays (tree, series, node, depth, feature, bin, value) of all trees of several series.

    ``columns`` has the bins by (feature, row), ``series`` numbers the rows' series from 0; each is boosted by itself.
    """
    width, several = len(y), int(series.max()) + 1 if len(y) else 0
    margin, flat, out, series = np.zeros(width), columns.ravel(), [], series.astype(np.int64)
    for tree in range(fit.trees):
        g, h = pulls(margin, y, weight)
        inside = seen(keys, tree, fit.share)
        features = allowed(tree, np.array([1]), fit.tried)[0]
        # Rows the tree sees come first, ``used`` of them; the others only follow the splits.
        rows = np.concatenate([np.flatnonzero(inside), np.flatnonzero(~inside)])
        used, at = int(inside.sum()), series[rows]
        mine = columns[features][:, rows[:used]]
        pairs = mine[:fit.tried // 2 * 2:2].astype(np.uint16) * BINS + mine[1::2] if mine.size > FEW else mine[:0]
        pull = [x[rows[:used]] for x in (g, h)]
        nodes, owner, value, parents = np.ones(several, np.int64), np.arange(several), np.zeros(width), None
        for depth in range(fit.depth + 1):
            n = len(nodes)
            if not n:
                break
            here, feature, last = at[:used], np.full(n, -1), np.full(n, -1)
            if depth < fit.depth:
                if parents is None or mine.size <= FEW:
                    sums = _sums(here, mine, pairs, pull, n)
                else:
                    less = np.bincount(here, minlength=n).reshape(-1, 2).argmin(1)  # the smaller child of every parent
                    some = np.flatnonzero(less[here >> 1] == (here & 1))
                    counted = _sums(here[some] >> 1, mine[:, some], pairs[:, some], [p[some] for p in pull], n // 2)
                    sums = [np.empty((n, *c.shape[1:])) for c in counted]
                    for s, c, parent in zip(sums, counted, parents):
                        s[2 * np.arange(n // 2) + less], s[2 * np.arange(n // 2) + 1 - less] = c, parent - c
                all_g, all_h = (s[:, 0].sum(1) for s in sums)
                slot, last = choose(*sums)
                feature = np.where(slot >= 0, features[np.maximum(slot, 0)], -1)
                parents = [s[feature >= 0] for s in sums]
            else:
                all_g, all_h = (np.bincount(here, p, n) for p in pull)
            values = np.where(feature < 0, leaf(all_g, all_h, fit.step), 0.0)
            out.append((np.full(n, tree), owner, nodes, np.full(n, depth), feature, last, values))
            go = feature[at] >= 0
            if not go.all():
                value[rows[~go]] = values[at[~go]]
                kept = go[:used]
                rows, at, used = rows[go], at[go], int(kept.sum())
                mine, pairs, pull = mine[:, kept], pairs[:, kept], [p[kept] for p in pull]
            right = flat[feature[at] * width + rows] > last[at]
            deeper = np.flatnonzero(feature >= 0)
            first = np.zeros(n, np.int64)
            first[deeper] = 2 * np.arange(len(deeper))
            at = first[at] + right
            nodes, owner = (2 * nodes[deeper][:, None] + np.arange(2)).ravel(), np.repeat(owner[deeper], 2)
        margin = margin + value
    return out


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(_NAMES), _TYPES)], names=_NAMES)


def boost_together(rows: DataFrame, fits: Sequence[Boost], small: int = SMALL_ROWS) -> DataFrame:
    """``NODES`` of every fit of every series in a table of quantised rows (see ``forests.quantised``)."""
    sizes, units = with_units(materialise(rows.groupBy("symbol").agg(F.count("*").alias("n")), "series-sizes"))
    listed = F.array(*[F.struct(F.lit(i).alias("fit"), F.lit(f.left_out).alias("left_out")) for i, f in enumerate(fits)])
    sized = rows.join(sizes, "symbol")
    exploded = lambda of, *columns: of.select("*", F.explode(listed).alias("f")).where("fold != f.left_out").select(
        "symbol", "row", "y", "weight", *columns, "f.fit")

    def whole(group: pa.Table) -> pa.Table:
        index = group.column("fit")[0].as_py()
        names, of, _ = series_of(group)
        found = boost(unpacked(group), group.column("y").to_numpy(), group.column("weight").to_numpy(), group.column("row").to_numpy(), of, fits[index])
        return stacked(names, found, index, _NAMES, _TYPES) if found else _table([])

    packed = sized.where(F.col("n") <= small).select("symbol", "row", "fold", "y", "weight", "unit", *pack())
    by = ["unit", "fit"]
    nodes = spread(exploded(packed, "unit", "bins0", "bins1"), units * len(fits), *by).groupBy(*by).applyInArrow(whole, NODES)
    return nodes.unionByName(_boost_large(exploded(sized.where(F.col("n") > small), "bins"), fits))


def _boost_large(taken: DataFrame, fits: Sequence[Boost]) -> DataFrame:
    """The same for large series, one aggregate per tree and level; nothing runs when there is none."""
    key = ["symbol", "fit", "node"]
    state = materialise(taken.select("*", F.lit(0.0).alias("margin"), F.lit(1).cast("long").alias("node")), "margins")
    columns, out = state.columns, taken.sparkSession.createDataFrame([], NODES)
    if state.isEmpty():
        return out

    def summed(tree: int):
        def run(batches):
            for batch in batches:
                index, keys = batch.column("fit").to_numpy(), batch.column("row").to_numpy()
                inside = seen(keys, tree, np.array([f.share for f in fits])[index])
                part = pa.Table.from_batches([batch]).filter(pa.array(inside))
                g, h = pulls(part.column("margin").to_numpy(), part.column("y").to_numpy(), part.column("weight").to_numpy())
                bins = _matrix(part.column("bins"))
                flat = pa.table({
                    **{c: part.column(c).combine_chunks().take(pa.array(np.repeat(np.arange(len(bins)), WIDTH))) for c in key},
                    "feature": pa.array(np.tile(np.arange(WIDTH, dtype=np.int32), len(bins))), "bin": pa.array(bins.ravel().astype(np.int32)),
                    "g": pa.array(np.repeat(g, WIDTH).astype(np.int64)), "h": pa.array(np.repeat(h, WIDTH).astype(np.int64))})
                sums = flat.group_by([*key, "feature", "bin"]).aggregate([("g", "sum"), ("h", "sum")])
                yield from sums.rename_columns([*key, "feature", "bin", "g", "h"]).to_batches()
        return run

    def split(tree: int, depth: int):
        def run(group: pa.Table) -> pa.Table:
            symbol, index, node = _first(group, *key)
            fit, sums = fits[index], np.zeros((2, 1, WIDTH, BINS))
            for i, c in enumerate("gh"):
                sums[i, 0, group.column("feature").to_numpy(), group.column("bin").to_numpy()] = group.column(c).to_numpy()
            features, slot, last = allowed(tree, np.array([1]), fit.tried)[0], [-1], [-1]
            if depth < fit.depth:
                slot, last = choose(sums[0][:, features], sums[1][:, features])
            feature = int(features[slot[0]]) if slot[0] >= 0 else -1
            value = 0.0 if feature >= 0 else float(leaf(sums[0, 0, 0].sum(), sums[1, 0, 0].sum(), fit.step))
            return _table([(symbol, index, tree, node, depth, feature, int(last[0]), value)])
        return run

    for tree in range(max(f.trees for f in fits)):
        growing = [i for i, f in enumerate(fits) if f.trees > tree]
        rows, done = state.where(F.col("fit").isin(growing)), None
        for depth in range(max(fits[i].depth for i in growing) + 1):
            sums = rows.select(*columns).mapInArrow(summed(tree), "symbol string, fit int, node long, feature int, bin int, g long, h long")
            sums = sums.groupBy(*key, "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            splits = materialise(sums.groupBy(*key).applyInArrow(split(tree, depth), NODES), "splits")
            out = out.unionByName(splits)
            # Rows of a node that no sampled row reached keep their margin.
            met = materialise(rows.join(splits.select(*key, "feature", "bin", "value"), key, "left"), "met")
            stay = met.where("feature IS NULL OR feature < 0").withColumn("margin", F.col("margin") + F.coalesce("value", F.lit(0.0)))
            done = stay.select(*columns) if done is None else done.unionByName(stay.select(*columns))
            right = (F.element_at("bins", F.col("feature") + 1) > F.col("bin")).cast("long")
            rows = met.where("feature >= 0").withColumn("node", 2 * F.col("node") + right).select(*columns)
        state = materialise(done.withColumn("node", F.lit(1).cast("long")), "margins")
    return out


BOOSTED = Family(boost_together, lambda nodes, rows: nodes, lambda said: said.sum(1) > 0, ("trees",), boosted=True)
