"""Random forests of many series, folds and settings grown together.

Features are quantised once per series. A tree's bag and the features a node may split on follow from hashes of
(row, tree) and (tree, node), and a node's numbers are counts per class, so a split depends on nothing but the node's rows:
not on the order of sums, the partitions or where it was found. That allows two ways to grow the same tree:

* Nodes of more than ``small`` rows split level by level. One aggregate per level over (series, fit, tree, node, feature,
  bin) counts for all forests at once, and each node's counts (at most features x bins) choose its split.
* A node of at most ``small`` rows, nearly always the root already, is sent to one task that grows the whole subtree. Rows travel
  as two packed integers of bins, and short series share a task, in which each is a root of its own: the arrays of a level then
  hold all their nodes, so many short series cost what their rows cost.

So the number of jobs follows the depth of the largest series and not the number of series, folds or settings. Forests that
differ in trees or depth are prefixes and truncations of one forest: a search refits only what differs in the
rest (``search``, which boosted trees share). Models are tables of nodes in heap order (root 1, children 2i and 2i + 1).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from kandela.schemas import FEATURE_COLUMNS
from kandela.session import materialise

BINS = 32
SMALL_ROWS = 500_000  # of one series: 57 years of hourly candles
CHUNK_ROWS = 20_000  # scored by one task
ALONE_ROWS = 4_096  # series above it have tasks of their own, shorter ones share them
UNIT_ROWS = 16_384  # about so many rows of short series share a task
TREES_PER_TASK = 50
WIDTH = len(FEATURE_COLUMNS)
_BITS, _PER_LONG = 5, 12

NODES = "symbol string, fit int, tree int, node long, depth int, feature int, bin int, c0 long, c1 long"
MODELS = "symbol string, model string, tree int, node long, depth int, feature int, threshold double, value double, boosted boolean"
_NODE_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
_NODE_NAMES = ["symbol", "fit", "tree", "node", "depth", "feature", "bin", "c0", "c1"]


@dataclass(frozen=True)
class Fit:
    """One forest per series: grown without the rows of ``left_out`` (-1: with all rows)."""

    trees: int = 150
    depth: int = 6
    least: int = 1
    tried: int = math.ceil(math.sqrt(WIDTH))  # features a node may split on
    left_out: int = -1


def as_fit(setting: Mapping, base: Fit = Fit()) -> Fit:
    """A point of a search grid under its MLlib names; what it leaves out is as in ``base``."""
    known = {"trees": "numTrees", "depth": "maxDepth", "least": "minInstancesPerNode"}
    found = {ours: setting[theirs] for ours, theirs in known.items() if theirs in setting}
    if "featureSubsetStrategy" in setting:
        found["tried"] = tried_features(setting["featureSubsetStrategy"])
    return replace(base, **found)


def tried_features(strategy: str) -> int:
    return math.ceil({"sqrt": math.sqrt(WIDTH), "log2": math.log2(WIDTH)}[strategy])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def bag(rows: np.ndarray, tree: int) -> np.ndarray:
    """How often each row, given by its hash, is in a tree: Poisson with mean 1."""
    u = _mix(rows.view(np.uint64) ^ _mix(np.array([tree + 1], np.uint64)))
    return np.searchsorted(_POISSON, (u >> np.uint64(11)) * 2.0**-53)


def allowed(tree: int, nodes: np.ndarray, tried: int) -> np.ndarray:
    """The features each node may split on, in order: (nodes, tried)."""
    seed = _mix(np.array([tree + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    h = _mix(_mix(nodes.astype(np.uint64) ^ seed)[:, None] + np.arange(WIDTH, dtype=np.uint64)[None, :])
    return np.sort(h.argsort(axis=1, kind="stable")[:, :tried], axis=1)


def choose(c0: np.ndarray, c1: np.ndarray, least: int, w0, w1) -> tuple[np.ndarray, np.ndarray]:
    """Feature (its place among the tried ones, -1: none) and last bin on the left of each node.

    ``c0`` and ``c1`` count by (node, tried feature, bin); the weights are numbers or have one value per node. The largest drop
    of the weighted Gini impurity wins, ties go to the first feature and bin.
    """
    w0, w1 = (np.reshape(w, (-1, 1, 1)) for w in (w0, w1))
    left0, left1 = c0.cumsum(2), c1.cumsum(2)
    all0, all1 = left0[:, :, -1:], left1[:, :, -1:]

    def impurity(a, b):
        a, b = a * w0, b * w1
        total = a + b
        return np.where(total > 0, total - (a * a + b * b) / np.where(total > 0, total, 1), 0.0)

    drop = impurity(all0, all1) - impurity(left0, left1) - impurity(all0 - left0, all1 - left1)
    counts = left0 + left1
    valid = (counts >= least) & (all0 + all1 - counts >= least)
    drop = np.where(valid, drop, -1.0).reshape(len(c0), -1)
    best = drop.argmax(1)
    found = drop[np.arange(len(best)), best] > 1e-9
    return np.where(found, best // c0.shape[2], -1), np.where(found, best % c0.shape[2], -1)


def grow(columns: np.ndarray, y: np.ndarray, times: np.ndarray, series: np.ndarray, tree: int, fit: Fit, w0: np.ndarray, w1: np.ndarray,
         node: int = 1, depth: int = 0) -> list[tuple]:
    """Per level arrays (series, node, depth, feature, bin, c0, c1) of the subtrees at ``node`` of several series.

    ``columns`` has the bins by (feature, row), ``series`` the place of each row's class weights in ``w0`` and ``w1``.
    """
    rows = np.flatnonzero(times > 0)
    y, times, out = y[rows].astype(np.int64), times[rows].astype(float), []
    owner, at = np.unique(series[rows], return_inverse=True)
    nodes, flat, width = np.full(len(owner), node, np.int64), columns.ravel(), columns.shape[1]
    while len(rows):
        n = len(nodes)
        total = np.bincount(2 * at + y, times, 2 * n).reshape(n, 2)
        feature, last = np.full(n, -1), np.full(n, -1)
        # A node of one class, or too small for two sides, cannot split.
        split = np.flatnonzero((total.min(1) > 0) & (total.sum(1) >= 2 * fit.least)) if depth < fit.depth else []
        if len(split):
            heap, same = np.unique(nodes[split], return_inverse=True)
            features = allowed(tree, heap, fit.tried)[same]
            place = np.full(n, -1)
            place[split] = np.arange(len(split))
            inside = np.flatnonzero(place[at] >= 0)
            to, where = place[at[inside]], rows[inside]
            base, count = 2 * BINS * to + y[inside], np.empty((len(split), fit.tried, BINS, 2))
            for slot in range(fit.tried):
                cell = base + 2 * flat[features[:, slot][to] * width + where]
                count[:, slot] = np.bincount(cell, times[inside], len(split) * BINS * 2).reshape(-1, BINS, 2)
            slots, last[split] = choose(count[..., 0], count[..., 1], fit.least, w0[owner[split]], w1[owner[split]])
            feature[split] = np.where(slots >= 0, features[np.arange(len(split)), np.maximum(slots, 0)], -1)
        out.append((owner, nodes, np.full(n, depth), feature, last, total[:, 0], total[:, 1]))
        go = feature[at] >= 0
        rows, at, y, times = rows[go], at[go], y[go], times[go]
        right = flat[feature[at] * width + rows] > last[at]
        deeper = np.flatnonzero(feature >= 0)
        first = np.zeros(n, np.int64)
        first[deeper] = 2 * np.arange(len(deeper))
        at = first[at] + right
        nodes, owner = (2 * nodes[deeper][:, None] + np.arange(2)).ravel(), np.repeat(owner[deeper], 2)
        depth += 1
    return out


def quantised(train: DataFrame, row_column: str = "open_time", fold: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``symbol, row, fold, y, weight, bins`` of train rows, and ``symbol, thresholds`` (per feature) of each series."""
    points = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    cuts = train.groupBy("symbol").agg(F.array(*[F.array_distinct(F.percentile_approx(c, points, 10_000)) for c in FEATURE_COLUMNS]).alias("thresholds"))
    cuts = materialise(cuts, "thresholds")
    below = [F.expr(f"size(filter(thresholds[{i}], t -> {c} > t))") for i, c in enumerate(FEATURE_COLUMNS)]
    rows = train.join(cuts, "symbol").select(
        "symbol", F.xxhash64(row_column).alias("row"), (F.col(fold) if fold else F.lit(-2)).cast("int").alias("fold"),
        F.col("target").cast("int").alias("y"), "weight", F.array(*below).alias("bins"))
    return materialise(rows, "quantised"), cuts


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def pack(bins: str = "bins") -> list:
    """The bins of a row as the integers ``bins0`` and ``bins1``."""
    parts = [range(i, min(i + _PER_LONG, WIDTH)) for i in range(0, WIDTH, _PER_LONG)]
    return [F.expr(" | ".join(f"shiftleft(CAST({bins}[{i}] AS long), {_BITS * (i - part[0])})" for i in part)).alias(f"bins{k}")
            for k, part in enumerate(parts)]


def unpacked(table: pa.Table) -> np.ndarray:
    """Bins by (feature, row)."""
    out = np.empty((WIDTH, table.num_rows), np.uint8)
    for i in range(WIDTH):
        out[i] = table.column(f"bins{i // _PER_LONG}").to_numpy() >> _BITS * (i % _PER_LONG) & BINS - 1
    return out


def with_units(sizes: DataFrame) -> tuple[DataFrame, int]:
    """Sizes (symbol, n) with the ``unit`` that is worked on as a whole, a long series or some short ones, and how many there are."""
    short = F.col("n") <= ALONE_ROWS
    rows, alone = sizes.agg(F.coalesce(F.sum(F.when(short, F.col("n"))), F.lit(0)), F.count_if(~short)).first()
    shared = math.ceil(rows / UNIT_ROWS)
    bucket = F.pmod(F.xxhash64("symbol"), F.lit(max(shared, 1))).cast("string")
    return sizes.withColumn("unit", F.when(short, F.concat(F.lit("short "), bucket)).otherwise(F.concat(F.lit("long "), "symbol"))), shared + alone


def spread(rows: DataFrame, works: int, *by: str) -> DataFrame:
    """Rows dealt by key to enough tasks for ``works`` pieces of work: few bytes may be long work, so sizes must not decide."""
    return rows.repartition(max(1, min(works, 16 * rows.sparkSession.sparkContext.defaultParallelism)), *by)


def series_of(group: pa.Table, *values: str) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """Names of the series in a group, each row's place among them, and per series the first of each of ``values``."""
    coded = group.column("symbol").combine_chunks().dictionary_encode()
    of = coded.indices.to_numpy()
    _, first = np.unique(of, return_index=True)
    return coded.dictionary, of, [group.column(v).to_numpy()[first] for v in values]


def stacked(names: pa.Array, found: list[tuple], index: int, labels: Sequence[str], types: Sequence[pa.DataType]) -> pa.Table:
    """Node rows of one group from arrays (tree, series, node, depth, ...) per level."""
    tree, owner, *rest = (np.concatenate(c) for c in zip(*found))
    columns = [names.take(pa.array(owner)), np.full(len(owner), index), tree, *rest]
    return pa.table([pa.array(c) if isinstance(c, pa.Array) else pa.array(c).cast(t) for c, t in zip(columns, types)], names=list(labels))


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * len(_NODE_NAMES)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _NODE_TYPES)], names=_NODE_NAMES)


def _first(table: pa.Table, *names: str) -> list:
    return [table.column(n)[0].as_py() for n in names]


def grow_together(rows: DataFrame, fits: Sequence[Fit], small: int = SMALL_ROWS) -> DataFrame:
    """``NODES`` of every fit of every series in a table of quantised rows (see ``quantised``)."""
    spark = rows.sparkSession
    weight = rows.groupBy("symbol").agg(F.max(F.when(F.col("y") == 0, F.col("weight"))).alias("w0"),
                                        F.max(F.when(F.col("y") == 1, F.col("weight"))).alias("w1"), F.count("*").alias("n"))
    sizes, units = with_units(materialise(weight.na.fill(1.0), "class-weights"))
    rows = rows.drop("weight").join(sizes, "symbol")
    listed = F.array(*[F.struct(F.lit(i).alias("fit"), F.lit(f.left_out).alias("left_out"), F.lit(f.trees).alias("trees")) for i, f in enumerate(fits)])
    exploded = lambda of, *columns: of.select("*", F.explode(listed).alias("f")).where("fold != f.left_out").select(
        "symbol", "row", "y", *columns, "w0", "w1", "n", "f.fit", "f.trees")

    def whole_trees(group: pa.Table) -> pa.Table:
        index, block = _first(group, "fit", "block")
        fit, out = fits[index], []
        names, of, (w0, w1) = series_of(group, "w0", "w1")
        columns, y, keys = unpacked(group), group.column("y").to_numpy(), group.column("row").to_numpy()
        for tree in range(block * TREES_PER_TASK, min(fit.trees, (block + 1) * TREES_PER_TASK)):
            out += [(np.full(len(level[0]), tree), *level) for level in grow(columns, y, bag(keys, tree), of, tree, fit, w0, w1)]
        return stacked(names, out, index, _NODE_NAMES, _NODE_TYPES) if out else _table([])

    last_block = F.floor((F.col("trees") - 1) / TREES_PER_TASK)
    packed = rows.where(F.col("n") <= small).select("symbol", "row", "fold", "y", "w0", "w1", "n", "unit", *pack())
    blocks = exploded(packed, "unit", "bins0", "bins1").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    works = units * sum(math.ceil(f.trees / TREES_PER_TASK) for f in fits)
    by = ["unit", "fit", "block"]
    nodes = spread(blocks, works, *by).groupBy(*by).applyInArrow(whole_trees, NODES)
    return nodes.unionByName(_grow_large(spark, exploded(rows.where(F.col("n") > small), "bins"), fits, small))


def _grow_large(spark, taken: DataFrame, fits: Sequence[Fit], small: int) -> DataFrame:
    """The same for series above ``small`` rows, level by level; nothing runs when there is none."""
    key = ["symbol", "fit", "tree", "node"]

    def bagged(batches):
        for batch in batches:
            keys, trees = batch.column("row").to_numpy(), batch.column("tree").to_numpy()
            times = np.zeros(len(keys), np.int64)
            for tree in np.unique(trees):
                times[trees == tree] = bag(keys[trees == tree], int(tree))
            yield batch.append_column("times", pa.array(times)).filter(pa.array(times > 0))

    def counted(batches):
        for batch in batches:
            named = pa.Table.from_batches([batch])
            bins = _matrix(named.column("bins"))
            flat = pa.table({
                **{c: named.column(c).combine_chunks().take(pa.array(np.repeat(np.arange(len(bins)), WIDTH))) for c in (*key, "w0", "w1")},
                "feature": pa.array(np.tile(np.arange(WIDTH, dtype=np.int32), len(bins))), "bin": pa.array(bins.ravel().astype(np.int32)),
                **{f"c{label}": pa.array(np.repeat(np.where(named.column("y").to_numpy() == label, named.column("times").to_numpy(), 0), WIDTH))
                   for label in (0, 1)}})
            summed = flat.group_by([*key, "w0", "w1", "feature", "bin"]).aggregate([("c0", "sum"), ("c1", "sum")])
            yield from summed.rename_columns([*key, "w0", "w1", "feature", "bin", "c0", "c1"]).to_batches()

    def split(depth: int):
        def run(group: pa.Table) -> pa.Table:
            symbol, index, tree, node, w0, w1 = _first(group, *key, "w0", "w1")
            c = np.zeros((2, 1, WIDTH, BINS))
            for label in (0, 1):
                c[label, 0, group.column("feature").to_numpy(), group.column("bin").to_numpy()] = group.column(f"c{label}").to_numpy()
            features, slot, last = allowed(tree, np.array([node]), fits[index].tried), [-1], [-1]
            if depth < fits[index].depth:
                slot, last = choose(c[0][:, features[0]], c[1][:, features[0]], fits[index].least, w0, w1)
            feature = int(features[0, slot[0]]) if slot[0] >= 0 else -1
            return _table([(symbol, index, tree, node, depth, feature, int(last[0]), int(c[0, 0, 0].sum()), int(c[1, 0, 0].sum()))])
        return run

    def subtree(depth: int):
        def run(group: pa.Table) -> pa.Table:
            symbol, index, tree, node, w0, w1 = _first(group, *key, "w0", "w1")
            names, of, (w0, w1) = series_of(group, "w0", "w1")
            found = grow(np.ascontiguousarray(_matrix(group.column("bins")).T), group.column("y").to_numpy(), group.column("times").to_numpy(),
                         of, tree, fits[index], w0, w1, node, depth)
            return stacked(names, [(np.full(len(level[0]), tree), *level) for level in found], index, _NODE_NAMES, _NODE_TYPES)
        return run

    start = taken.withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1))).drop("trees", "n").withColumn("node", F.lit(1).cast("long"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in start.schema.fields)
    state, depth, out = materialise(start.mapInArrow(bagged, f"{types}, times long"), "bags"), 0, spark.createDataFrame([], NODES)
    columns = state.columns
    while not state.isEmpty():
        sizes = materialise(state.groupBy(*key).agg(F.count("*").alias("size")), "node-sizes")
        sized = state.join(sizes, key)
        fine = sized.where(F.col("size") <= small).groupBy(*key).applyInArrow(subtree(depth), NODES)
        large = sized.where(F.col("size") > small)
        cells = large.select(*columns).mapInArrow(counted, "symbol string, fit int, tree int, node long, w0 double, w1 double, feature int, bin int, c0 long, c1 long")
        cells = cells.groupBy(*key, "w0", "w1", "feature", "bin").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
        splits = materialise(cells.groupBy(*key).applyInArrow(split(depth), NODES), "splits")
        out = out.unionByName(materialise(fine, "subtrees")).unionByName(splits)
        moved = large.join(splits.where("feature >= 0").select(*key, "feature", "bin"), key)
        right = (F.element_at("bins", F.col("feature") + 1) > F.col("bin")).cast("long")
        state = materialise(moved.withColumn("node", 2 * F.col("node") + right).select(*columns), "bags")
        depth += 1
    return out


def walk(nodes: dict[str, np.ndarray], x: np.ndarray, depths: Sequence[int]) -> dict[int, np.ndarray]:
    """Per depth the value of every tree for every row of ``x``, trees cut at that depth: {depth: (rows, trees)}.

    ``nodes`` has ``tree, node, feature, threshold, value``; a row goes right where its feature is above the threshold.
    """
    key = nodes["tree"].astype(np.int64) << 40 | nodes["node"]
    order = key.argsort()
    key, feature, threshold, value = key[order], *(nodes[c][order] for c in ("feature", "threshold", "value"))
    trees = np.unique(nodes["tree"])
    roots = np.searchsorted(key, trees.astype(np.int64) << 40 | 1)
    # Where each node leads to on either side; a leaf leads to itself.
    below = (key >> 40 << 40)[:, None] | (2 * (key & (1 << 40) - 1)[:, None] + np.arange(2))
    child = np.where(feature[:, None] >= 0, np.minimum(np.searchsorted(key, below), len(key) - 1), np.arange(len(key))[:, None]).ravel()
    feature, some = np.maximum(feature, 0), max(1, 100_000 // max(len(trees), 1))
    out = {depth: np.empty((len(x), len(trees))) for depth in depths}
    for start in range(0, len(x), some):  # few rows at a time stay in the cache
        part = np.ascontiguousarray(x[start:start + some])
        flat, row, at = part.ravel(), np.arange(len(part))[:, None] * part.shape[1], np.tile(roots, (len(part), 1))
        for depth in range(max(depths) + 1):
            if depth in out:
                out[depth][start:start + some] = value[at]
            if depth < max(depths):
                at = child[2 * at + (flat[row + feature[at]] > threshold[at])]
    return out


def _arrays(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in ("tree", "node", "feature", "threshold", "value")}


def valued(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Nodes with the weighted share of class 1 as ``value``."""
    weight = rows.groupBy("symbol").agg(*[F.coalesce(F.max(F.when(F.col("y") == i, F.col("weight"))), F.lit(1.0)).alias(f"w{i}") for i in (0, 1)])
    share = lambda label: F.col(f"c{label}") * F.col(f"w{label}")
    return nodes.join(materialise(weight, "class-weights"), "symbol").withColumn("value", share(1) / (share(0) + share(1)))


def as_models(nodes: DataFrame, thresholds: DataFrame, chosen: DataFrame, boosted: bool = False) -> DataFrame:
    """``MODELS`` of ``chosen`` (symbol, fit, model, trees, max_depth): prefixes and truncations of what was grown."""
    joined = nodes.join(materialise(chosen, "chosen"), ["symbol", "fit"]).where("tree < trees AND depth <= max_depth").join(thresholds, "symbol")
    inner = (F.col("feature") >= 0) & (F.col("depth") < F.col("max_depth"))
    return joined.select(
        "symbol", "model", "tree", "node", "depth", F.when(inner, F.col("feature")).otherwise(-1).alias("feature"),
        F.when(inner, F.expr("thresholds[feature][bin]")).otherwise(0.0).alias("threshold"), "value", F.lit(boosted).alias("boosted"))


def score(rows: DataFrame, models: DataFrame, chunk: int = CHUNK_ROWS) -> DataFrame:
    """Rows with ``model, prediction, prob_buy, prob_sell``, once for each model of their symbol.

    Rows are dealt in chunks of about ``chunk`` per series, and each chunk meets the models of its series in one task.
    """
    counts = materialise(rows.groupBy("symbol").agg((F.floor((F.count("*") - 1) / chunk) + 1).cast("int").alias("chunks")), "chunks")
    dealt = rows.join(counts, "symbol").withColumn("chunk", F.pmod(F.xxhash64("open_time"), F.col("chunks")).cast("int")).drop("chunks")
    spread = models.join(counts, "symbol").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", model string, prediction int, prob_buy double, prob_sell double"
    names = rows.columns

    def run(part: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        x = np.column_stack([part.column(c).to_numpy().astype(float) for c in FEATURE_COLUMNS]) if part.num_rows else np.zeros((0, WIDTH))
        for model in known.column("model").unique().to_pylist() if part.num_rows else []:
            mine = known.filter(pc.equal(known.column("model"), model))
            deepest = int(mine.column("depth").to_numpy().max())
            said = walk(_arrays(mine), x, [deepest])[deepest]
            buy = 1 / (1 + np.exp(-said.sum(1))) if mine.column("boosted")[0].as_py() else said.mean(1)
            scored = part.select(names)
            for name, column in (("model", pa.array([model] * len(buy))), ("prediction", pa.array((buy > 0.5).astype(np.int32))),
                                 ("prob_buy", pa.array(buy)), ("prob_sell", pa.array(1 - buy))):
                scored = scored.append_column(name, column)
            out.append(scored)
        empty = part.select(names).slice(0, 0)
        for name, kind in (("model", pa.string()), ("prediction", pa.int32()), ("prob_buy", pa.float64()), ("prob_sell", pa.float64())):
            empty = empty.append_column(name, pa.array([], kind))
        return pa.concat_tables([empty, *out])

    by = ["symbol", "chunk"]
    return dealt.groupBy(*by).cogroup(spread.groupBy(*by)).applyInArrow(run, schema)


@dataclass(frozen=True)
class Family:
    """How a kind of model grows (rows, fits, small), gets node values (nodes, rows), and says 1 by (rows, trees) of values."""

    grow: Callable[[DataFrame, Sequence, int], DataFrame]
    valued: Callable[[DataFrame, DataFrame], DataFrame]
    says: Callable[[np.ndarray], np.ndarray]
    nested: tuple[str, ...]  # parameters of which smaller values are a part of the same model
    boosted: bool = False


FOREST = Family(lambda rows, fits, small: grow_together(rows, fits, small), valued, lambda said: said.mean(1) > 0.5, ("trees", "depth"))


def fit_forests(train: DataFrame, forests: Mapping[str, Fit], small: int = SMALL_ROWS, family: Family = FOREST) -> DataFrame:
    """``MODELS`` of the named fits for every series of weighted train rows, all grown together."""
    rows, cuts = quantised(train)
    nodes = family.grow(rows, list(forests.values()), small)
    listed = F.array(*[F.struct(F.lit(i).alias("fit"), F.lit(n).alias("model"), F.lit(f.trees).alias("trees"),
                                F.lit(f.depth).alias("max_depth")) for i, (n, f) in enumerate(forests.items())])
    chosen = cuts.select("symbol", F.explode(listed).alias("f")).select("symbol", "f.*")
    return materialise(as_models(family.valued(nodes, rows), cuts, chosen, family.boosted), "models")


def search(train: DataFrame, settings: Sequence[Fit], name: str, folds: int = 3, small: int = SMALL_ROWS,
           family: Family = FOREST) -> tuple[DataFrame, DataFrame]:
    """(``MODELS`` named ``name``, ``symbol, setting, f1``): per series the best of ``settings`` by mean F1 over time folds.

    Settings that differ only in ``family.nested`` share their fits: per fold one model with the largest of those values, scored
    by its first trees and upper levels; the winner is cut out of one grown on all rows. Everything grows in one go. Equal
    scores go to the first setting. Folds are blocks of time.
    """
    core = lambda s: replace(s, left_out=-1, **dict.fromkeys(family.nested, 0))
    cores = list(dict.fromkeys(map(core, settings)))
    largest = lambda c: {n: max(getattr(s, n) for s in settings if core(s) == c) for n in family.nested}
    fits = [replace(c, left_out=f, **largest(c)) for c in cores for f in (*range(folds), -1)]
    rows, cuts = quantised(with_folds(train, folds), fold="fold")
    nodes = materialise(family.valued(family.grow(rows, fits, small), rows), "grown")
    held = rows.select("symbol", "row", "fold", "y", "bins", F.explode(F.array(*[
        F.struct(F.lit(i).alias("fit"), F.lit(f.left_out).alias("left_out")) for i, f in enumerate(fits) if f.left_out >= 0])).alias("f")).where(
        "fold = f.left_out").withColumn("fit", F.col("f.fit")).drop("f")
    counts = materialise(held.groupBy("symbol", "fit").agg((F.floor((F.count("*") - 1) / max(min(small, CHUNK_ROWS), 1)) + 1).cast("int").alias("chunks")), "chunks")
    dealt = held.join(counts, ["symbol", "fit"]).withColumn("chunk", F.pmod("row", F.col("chunks")).cast("int"))
    trees = nodes.join(counts, ["symbol", "fit"]).select(
        "symbol", "fit", "tree", "node", "depth", "feature", F.col("bin").cast("double").alias("threshold"), "value",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))

    def outcomes(part: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if part.num_rows and known.num_rows:
            symbol, index = _first(part, "symbol", "fit")
            mine = [(i, s) for i, s in enumerate(settings) if core(s) == core(fits[index])]
            values = walk(_arrays(known), _matrix(part.column("bins")).astype(float), {s.depth for _, s in mine})
            y = part.column("y").to_numpy()
            for i, s in mine:
                said = family.says(values[s.depth][:, :s.trees])
                out.append((symbol, i, fits[index].left_out, int((said & (y == 1)).sum()), int((said & (y == 0)).sum()), int((~said & (y == 1)).sum())))
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], names=["symbol", "setting", "fold", "tp", "fp", "fn"])

    by = ["symbol", "fit", "chunk"]
    counted = dealt.groupBy(*by).cogroup(trees.groupBy(*by)).applyInArrow(
        outcomes, "symbol string, setting int, fold int, tp long, fp long, fn long")
    per_fold = counted.groupBy("symbol", "setting", "fold").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    scored = materialise(per_fold.groupBy("symbol", "setting").agg(F.avg(f1).alias("f1")), "search")
    best = scored.groupBy("symbol").agg(F.max(F.struct("f1", (-F.col("setting")).alias("back"))).alias("b")).select(
        "symbol", (-F.col("b.back")).alias("setting"))
    whole = {core(f): i for i, f in enumerate(fits) if f.left_out < 0}
    listed = F.array(*[F.struct(F.lit(whole[core(s)]).alias("fit"), F.lit(s.trees).alias("trees"), F.lit(s.depth).alias("max_depth")) for s in settings])
    chosen = best.withColumn("f", F.element_at(listed, F.col("setting") + 1)).select("symbol", "f.fit", F.lit(name).alias("model"), "f.trees", "f.max_depth")
    return materialise(as_models(nodes, cuts, chosen, family.boosted), "models"), scored


def with_folds(train: DataFrame, folds: int) -> DataFrame:
    """Rows with the block of time they fall in, 0 to ``folds - 1``, blocks of equal numbers of rows."""
    from kandela.operators.series import number_rows

    return number_rows(train).withColumn("fold", F.least(F.floor((F.col("rn") - 1) * folds / F.col("n")), F.lit(folds - 1)).cast("int")).drop("rn", "n")
