"""Prefix tries of conversations by truncation peeling.

A conversation is a path of turns; conversations that begin alike share nodes. The trie is found from its deepest level
up. At depth ``d`` the pool holds the conversations that end there and the nodes that survived from ``d + 1`` with their
last turn stripped; regrouping the pool by what is left merges them into the nodes of depth ``d`` and adds up
what they carry. So nodes are found and aggregated in the same pass, and a level shuffles only its own nodes.

Equal conversations are one path with a count. A path that is alone in its subtree from some depth on (looked up
at the depths 1, 2, 4, 8, ...) cannot merge with another there: that tail is peeled in one step, so rounds are needed
only to twice the deepest turn that different conversations share.

A prefix is named by its depth and 128 bits: the bitwise sums of two hashes of (place, role, text) of its turns. Such
sums, places and sizes are running values over turns; they are taken per range of the sorted turns and joined over
the ranges, so that a conversation that holds a third of all turns is spread as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kandela.llm.text import or_empty
from kandela.session import materialise, scratch_path

ENDS = "depth long, k1 long, k2 long, conv_id long, n_convs long, size long, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()


def running(rows: DataFrame, order: tuple[str, ...], values: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with running values over each ``conv_id`` in ``order``, the row itself included.

    ``values`` names (how, column) with ``how`` one of count, sum and xor. Sorted rows are cut into ranges; only one
    row per range and conversation that crosses its border is carried from range to range.
    """
    total = {"count": F.count, "sum": F.sum, "xor": F.bit_xor}
    spread = materialise(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turn-ranges")
    inside = Window.partitionBy("part", "conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most two rows for each border between ranges.
    carried = (spread.groupBy("part", "conv_id").agg(*[total[how](c).alias(name) for name, (how, c) in values.items()])
               .select("part", F.col("conv_id").alias("of"), *[total[how](F.col(name)).over(earlier).alias(f"carried_{name}")
                                                             if how != "count" else F.sum(name).over(earlier).alias(f"carried_{name}")
                                                             for name, (how, _) in values.items()],
                       F.row_number().over(Window.partitionBy("conv_id").orderBy("part")).alias("nth"))
               .where("nth > 1").drop("nth").withColumnRenamed("part", "of_part"))
    here = spread.select("*", *[total[how](c).over(inside).alias(f"here_{name}") for name, (how, c) in values.items()])
    both = here.join(materialise(carried, "turn-borders"),
                     (F.col("part") == F.col("of_part")) & F.col("conv_id").eqNullSafe(F.col("of")), "left")

    def joined(name: str, how: str) -> Column:
        before, now = F.coalesce(f"carried_{name}", F.lit(0)), F.col(f"here_{name}")
        return (before.bitwiseXOR(now) if how == "xor" else before + now).alias(name)

    return both.select(*rows.columns, *[joined(name, how) for name, (how, _) in values.items()])


def in_order(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, a, b, chars``: the turns of each conversation numbered from 1, null turns first.

    Turns with the same number come in order of their role and of ``a``, a hash of role and text; ``a`` and ``b`` stand for
    both. Null roles and texts are empty; rows without a conversation id make one conversation without id.
    """
    role, text = or_empty(F.col(role)), or_empty(F.col(text))
    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role.alias("role"),
                        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"),
                        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"))
    return running(rows, ("turn", "role", "a", "row"), {"pos": ("count", F.col("a"))}).select("conv_id", "pos", "a", "b", "chars")


def prefixes(paths: DataFrame) -> DataFrame:
    """``conv_id, depth, k1, k2, p1, p2, chars, size``: the names of each prefix and its parent, and its code points."""
    one, two = F.xxhash64("depth", "a", "b"), F.xxhash64(F.lit(2), "depth", "a", "b")
    rows = paths.select("conv_id", "depth", "chars", one.alias("h1"), two.alias("h2"))
    keyed = running(rows, ("depth",), {"k1": ("xor", F.col("h1")), "k2": ("xor", F.col("h2")), "size": ("sum", F.col("chars"))})
    return keyed.select("conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"),
                        F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "chars", "size")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of equal ``depth, k1, k2``; the ids pass by in order and are never held together."""
    names = ["depth", "k1", "k2", "conv_id", "n_convs", "size", "ends_sha256"]
    key, row, digest = None, None, None

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        types = [pa.int64()] * 6 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        done = []
        for depth, k1, k2, conv_id, size in zip(*[batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "conv_id", "size")]):
            if key != (depth, k1, k2):
                if key is not None:
                    done.append((*key, *row, digest.hexdigest()))
                key, row, digest = (depth, k1, k2), [conv_id, 0, size], hashlib.sha256()
            digest.update(b"," * (row[1] > 0) + (b"null" if conv_id is None else b"%d" % conv_id))
            row[1] += 1
        yield batch_of(done)
    if key is not None:
        yield batch_of([(*key, *row, digest.hexdigest())])


def different_paths(keyed: DataFrame, ids: DataFrame) -> DataFrame:
    """``ENDS``: each different whole path with its smallest conversation, their number and the digest of their ids."""
    length = keyed.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    last = keyed.alias("k").join(materialise(length, "lengths").alias("l"), F.col("k.conv_id").eqNullSafe(F.col("l.conv_id"))
                                 & (F.col("k.depth") == F.col("l.depth"))).select("k.conv_id", "k.depth", "k1", "k2", "size")
    last = materialise(last, "whole-paths")
    turnless = ids.alias("i").join(last.alias("p"), F.col("i.conv_id").eqNullSafe(F.col("p.conv_id")), "left_anti").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in ("depth", "k1", "k2", "size")])
    ends = last.unionByName(turnless)
    keys = ["depth", "k1", "k2"]
    return ends.repartition(*keys).sortWithinPartitions(*keys, F.col("conv_id").asc_nulls_last()).mapInArrow(_ends, ENDS)


def trie(paths: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths`` (``conv_id, depth, a, b, chars`` with depths 1, 2, ... in each conversation).

    ``ids`` lists every ``conv_id`` once; one without a path ends at the root. Per node: ``conv_id`` (smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. A null id counts last among ids and is
    written ``null`` in digests. Without ids there is no node, the root included.
    """
    spark = paths.sparkSession
    keyed = materialise(prefixes(paths), "prefixes")
    ends = materialise(different_paths(keyed, ids), "ends")

    # The turns of one conversation per different path, and from where on each is alone.
    whole = ends.select(F.col("conv_id").alias("of"), F.col("n_convs"), F.col("depth").alias("length"), F.col("size").alias("whole"))
    walk = materialise(keyed.join(whole, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of"), "walks")
    doubling = walk.where(F.col("depth").bitwiseAND(F.col("depth") - 1) == 0)
    alone = doubling.groupBy("depth", "k1", "k2").agg(F.count("*").alias("paths"), F.min("conv_id").alias("of")).where("paths = 1")
    alone = materialise(alone.groupBy("of").agg(F.min("depth").alias("head")), "heads")
    walk = walk.join(alone, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    tails = materialise(walk.where("depth >= head").select(
        "conv_id", "depth", "head", "k1", "k2", "p1", "p2", "n_convs", (F.col("depth") < F.col("length")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * (F.col("whole") - F.col("size") + F.col("chars"))).alias("saved_tokens")), "tails")
    shared = materialise(walk.where("head IS NULL OR depth < head").select("conv_id", "depth", "p1", "p2", "chars")
                         .repartitionByRange("depth", "conv_id"), "shared-turns")

    # What joins the pool at each depth: stripped heads of tails, and the ends of paths that are nowhere alone.
    stripped = tails.where("depth = head").select(
        (F.col("depth") - 1).alias("at"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv_id", "n_convs",
        F.lit(1).cast("long").alias("children"), "n_leaves", "saved_tokens")
    zero = F.lit(0).cast("long")
    ended = ends.join(alone, F.col("conv_id").eqNullSafe(F.col("of")), "left_anti").select(
        F.col("depth").alias("at"), "k1", "k2", "conv_id", "n_convs", zero.alias("children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
    arriving = materialise(stripped.unionByName(ended), "arriving")
    deepest = arriving.agg(F.max("at")).first()[0]

    root, survivors = scratch_path(spark, "levels"), None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        pool = arriving.where(F.col("at") == depth).drop("at")
        pool = pool if survivors is None else pool.unionByName(survivors)
        nodes = pool.groupBy("k1", "k2").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("children").alias("n_children"),
            F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        if depth:
            last = shared.where(F.col("depth") == depth).select(F.col("conv_id").alias("of"), "p1", "p2", "chars")
            nodes = nodes.join(last, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
        else:
            nodes = nodes.select("*", zero.alias("p1"), zero.alias("p2"), zero.alias("chars"))
        nodes.withColumn("saved_tokens", F.col("below") + (F.col("n_convs") - 1) * F.col("chars")).drop("below", "chars").write.parquet(
            f"{root}/depth={depth}")
        survivors = spark.read.parquet(f"{root}/depth={depth}").select(
            F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv_id", "n_convs", F.lit(1).cast("long").alias("children"), "n_leaves", "saved_tokens")
    if deepest is None:
        return tails.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                            "saved_tokens", F.lit(NOTHING).alias("ends_sha256"))
    merged = spark.read.parquet(root).withColumn("depth", F.col("depth").cast("long"))

    # Inside a tail the parent is the same conversation; other nodes look it up among the merged ones.
    columns = ["conv_id", "depth", "k1", "k2", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = tails.where("depth > head").select(*columns, F.col("conv_id").alias("parent_conv_id"))
    outer = materialise(merged.select(*columns, "p1", "p2").unionByName(tails.where("depth = head").select(*columns, "p1", "p2")), "outer-nodes")
    parents = materialise(merged.select((F.col("depth") + 1).alias("below"), F.col("k1").alias("q1"), F.col("k2").alias("q2"),
                                        F.col("conv_id").alias("parent_conv_id")), "parents")
    outer = outer.join(parents, (F.col("depth") == F.col("below")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")), "left")
    nodes = inner.unionByName(outer.select(*columns, "parent_conv_id"))
    digests = ends.select(F.col("depth").alias("at"), F.col("k1").alias("e1"), F.col("k2").alias("e2"), "ends_sha256")
    return nodes.join(digests, (F.col("depth") == F.col("at")) & (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, **columns: str) -> DataFrame:
    """The trie of a table of turns as they are; see ``in_order`` for order and nulls and ``trie`` for the result.

    Texts are read once, for their hashes and lengths, and never shuffled; repeated rows are turns of their own;
    other columns are not read.
    """
    ordered = in_order(turns, **columns).withColumnRenamed("pos", "depth")
    return trie(ordered, turns.select(F.col(columns.get("conv", "conv_id")).cast("long").alias("conv_id")).distinct())


def with_shared_openings(ordered: DataFrame, ids: DataFrame, base: Column, turns: Column) -> DataFrame:
    """Paths in which each conversation's first ``turns`` turns are those of conversation ``base``, both columns over ``ids``.

    All of the base's are taken if it has fewer, none if it is absent; the conversation's own later turns follow.
    """
    plan = materialise(ids.select("conv_id", base.alias("base"), turns.cast("long").alias("opening")), "openings")
    most = plan.agg(F.max("opening")).first()[0] or 0
    heads = materialise(ordered.where(F.col("pos") <= most).select(F.col("conv_id").alias("of"), "pos", "a", "b", "chars"), "first-turns")
    opening = plan.join(heads, (F.col("base") == F.col("of")) & (F.col("pos") <= F.col("opening"))).select(
        "conv_id", F.col("pos").alias("depth"), "a", "b", "chars")
    taken = heads.groupBy("of").agg(F.max("pos").alias("held"))
    shift = materialise(plan.join(taken, F.col("base") == F.col("of"), "left").select(
        F.col("conv_id").alias("of"), "opening", F.least(F.coalesce("held", F.lit(0)), "opening").alias("taken")), "shifts")
    own = ordered.join(shift, F.col("conv_id").eqNullSafe(F.col("of"))).where(F.col("pos") > F.col("opening")).select(
        "conv_id", (F.col("pos") - F.col("opening") + F.col("taken")).alias("depth"), "a", "b", "chars")
    return opening.unionByName(own)
