"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact size, so what follows works on counts, not documents. A source whose
target is ``q`` times its size and a rest takes every document ``q`` times; the rest is met per size by a
bounded knapsack over the counts (dynamic programming on reachable sums, as bits of one number), over what is to be left
out where that is less than what is to be taken. One rule holds for all sources: the smallest documents that together can
still correct any sum go through the knapsack, in a window of ``WINDOW_DOCUMENTS`` of their largest one but at least ``LEAST_WINDOW``
words; an equal share of every size's other documents comes first.
Which documents of a size are taken is a seeded order: ranges of a hash hold about ``ROWS_PER_RANGE`` documents, whole
ranges are taken by their counts and only the one in which the number runs out is ranked.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from kandela.llm.text import WORD, or_empty
from kandela.session import materialise

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 17
ROWS_PER_RANGE = 256
LEAST_WINDOW = 1 << 16
WINDOW_DOCUMENTS = 16
LEAST_SIZES = 16
ROWS_BYTES = 1 << 25


def word_count(text):
    return F.regexp_count(or_empty(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size, n``.

    Sources by code point, null last, weigh ``weights`` in turn and share the total; a target stops at
    ``most_repeats`` times the source's size and the excess goes to the others by weight, until none is above.
    """
    per_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranked = materialise(_in_order(per_source).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.col("rank") % len(weights)).cast("int") + 1)), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap, level = F.col("source_size") * float(most_repeats), 0.0
    while True:  # the level only rises and each round fills a source more, mostly many
        full = F.col("weight") * level > cap
        row = ranked.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        raised = (total - (row[0] or 0.0)) / row[1] if row[1] else level
        if raised <= level:
            break
        level = raised
    return ranked.select("source", "source_size", F.least(F.col("weight") * level, cap).alias("target"))


def _in_order(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 by code point, null last: ranges of names are counted, then numbered inside."""
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = F.col("source").cast("binary")
    ranged = materialise(sources.repartitionByRange(parts, F.col("source").isNull(), name)
                         .withColumn("range", F.spark_partition_id()), "source-ranges")
    counts = ranged.groupBy("range").agg(F.count("*").alias("n"))
    before = counts.select("range", F.coalesce(F.sum("n").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").isNull(), name)) - 1
    return ranged.withColumn("inside", inside).join(before, "range").select(
        "source", "source_size", (F.col("before") + F.col("inside")).alias("rank"))


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents to take per size so that their sizes come as near to ``budget`` as can be found, not above it.

    The sum is the best there is where the words to take or those to leave out are at most ``LEAST_WINDOW``, or at most
    ``WINDOW_DOCUMENTS`` times the largest document of use, and wherever it equals the budget. Beyond that, as many
    documents as fill such a window make up for the others, so it is seldom below the budget.
    Memory: a row of bits has a bit for each word of the window; ``ROWS_BYTES`` of them are held, and one more for each
    halving of the steps down to that.
    """
    sizes = sorted((s for s, n in counts.items() if s > 0 and n > 0), reverse=True)
    total = sum(s * counts[s] for s in sizes)
    budget = min(budget, total)
    if budget <= 0:
        return {}
    if 2 * budget <= total:
        taken = _choose(counts, [s for s in sizes if s <= budget], budget, above=False)
    else:
        left_out = _leave_out(counts, sizes, total - budget)
        taken = {s: counts[s] - left_out.get(s, 0) for s in sizes}
    return {s: k for s, k in taken.items() if k}


def _leave_out(counts: dict[int, int], sizes: list[int], goal: int) -> dict[int, int]:
    """The smallest sum from ``goal`` on: one document that is that large, or smaller ones together."""
    alone = min((s for s in sizes if s >= goal), default=None) if goal else None
    smaller = [s for s in sizes if s < goal]
    if sum(s * counts[s] for s in smaller) < goal:
        return {alone: 1}
    together = _choose(counts, smaller, goal, above=True)
    return {alone: 1} if alone is not None and alone < sum(s * k for s, k in together.items()) else together


def _choose(counts: dict[int, int], sizes: list[int], goal: int, above: bool) -> dict[int, int]:
    """Documents per size (largest first) with a sum near ``goal``: the largest up to it or, ``above``, the smallest from it on.

    The finest documents that can make up for the rest go through the knapsack, the larger ones by an equal share of
    each size. Where that misses the goal, larger ones join them, at last all.
    """
    total = sum(s * counts[s] for s in sizes)
    if not above and total <= goal:
        return {s: counts[s] for s in sizes}
    best, least = {}, None
    for cut in _cuts(sizes):
        chosen = _with_fine(counts, sizes[:cut], sizes[cut:], goal, total, above)
        if chosen is not None:
            miss = abs(goal - sum(s * k for s, k in chosen.items()))
            if least is None or miss < least:
                best, least = chosen, miss
            if miss == 0:
                break
    return best


def _cuts(sizes: list[int]) -> list[int]:
    """Where the fine documents may begin: ``LEAST_SIZES`` different sizes or more, each time up to twice as large; at last all."""
    cuts, bound = [], 0
    for i in range(len(sizes) - LEAST_SIZES, 0, -1):
        if sizes[i] > bound:
            cuts.append(i)
            bound = 2 * sizes[i]
    return [*cuts, 0]


def _with_fine(counts: dict[int, int], large: list[int], fine: list[int], goal: int, total: int, above: bool) -> dict[int, int] | None:
    """``large`` documents by equal share, the rest of ``goal`` out of ``fine`` ones; None if those are too few for a window."""
    words = sum(s * counts[s] for s in fine)
    window = max(LEAST_WINDOW, WINDOW_DOCUMENTS * fine[0]) if fine else 0
    if large and words < 2 * window:
        return None
    chosen = {s: counts[s] * goal // total for s in large}
    left = _take(counts, chosen, large, goal - sum(s * k for s, k in chosen.items()), words // 2)
    if large and not window <= left <= words - window:
        return None
    share = max(0, left - window)
    chosen.update({s: counts[s] * share // words for s in fine})
    left -= sum(s * chosen[s] for s in fine)
    _knapsack(fine, counts, chosen, _take(counts, chosen, fine, left, window), above)
    return chosen


def _take(counts: dict[int, int], chosen: dict[int, int], sizes: list[int], left: int, down_to: int) -> int:
    """Takes free documents, the largest first, while ``left`` stays at ``down_to`` or more; what is left."""
    for s in sizes:
        if left > down_to:
            more = min(counts[s] - chosen[s], (left - down_to) // s)
            chosen[s] += more
            left -= more * s
    return left


def _knapsack(sizes: list[int], counts: dict[int, int], chosen: dict[int, int], goal: int, above: bool) -> None:
    """Adds to ``chosen`` the multiset of free documents with the largest sum up to ``goal``, or the smallest from it on.

    Reachable sums are the bits of one number per step. Rows that do not fit ``ROWS_BYTES`` together are made again from
    the one half-way, so memory does not follow the steps.
    """
    if goal <= 0:
        return
    bits, steps = goal + 1 + (sizes[0] if above else 0), []
    within = (1 << bits) - 1
    for s in sizes:
        free, block = min(counts[s] - chosen[s], goal // s + above), 1
        while free > 0:
            block = min(block, free)
            steps.append((s, block))
            free -= block
            block *= 2

    def after(reach: int, first: int, last: int) -> int:
        for s, block in steps[first:last]:
            reach = (reach | reach << (s * block)) & within
        return reach

    def trace(first: int, last: int, reach: int, at: int) -> int:
        """Goes back from the sum ``at`` after the step before ``last``; the sum before ``first``, where ``reach`` holds."""
        if last - first > 1 and (last - first) * bits > 8 * ROWS_BYTES:
            middle = (first + last) // 2
            at = trace(middle, last, after(reach, first, middle), at)
            return trace(first, middle, reach, at)
        rows = [reach]
        for k in range(first, last - 1):
            rows.append(after(rows[-1], k, k + 1))
        for s, block in reversed(steps[first:last]):
            if not rows.pop() >> at & 1:
                chosen[s] += block
                at -= s * block
        return at

    reach, done = 1, 0
    while done < len(steps) and not reach >> goal & 1:
        reach = after(reach, done, done + 1)
        done += 1
    if above:
        beyond = reach >> goal
        at = goal + (beyond & -beyond).bit_length() - 1
    else:
        at = reach.bit_length() - 1 if not reach >> goal & 1 else goal
    del reach
    trace(0, done, 1, at)


def _plan(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``_source, size, n, source_size, target, copies, extra``: whole copies of each document of a size, and how many
    of its ``n`` documents get one more."""

    def per_source(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        size, target = int(first["source_size"]), float(first["target"])
        budget = int(target + 0.5)
        copies = min(budget // size, MOST_REPEATS) if size else 0
        extra = fit(dict(zip(frame["size"], frame["n"])), budget - copies * size) if size and copies < MOST_REPEATS else {}
        return frame.assign(copies=copies * (frame["size"] > 0), extra=[extra.get(s, 0) for s in frame["size"]])

    # A source's histogram has one row per different size, not per document.
    joined = sizes.join(goals, sizes["source"].eqNullSafe(goals["source"])).select(
        F.to_json(F.struct(sizes["source"]), {"ignoreNullFields": "false"}).alias("_source"), "size", "n", "source_size", "target")
    return joined.groupBy("_source").applyInPandas(
        per_source, "_source string, size long, n long, source_size long, target double, copies long, extra long")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, source, size, source_size, target, taken, copies`` and ``carry``: one row per input row, untaken ones too (taken 0).

    Size is the number of words (null: 0); documents without words are never taken; no document is taken
    more than three times. The same rows and seed give the same mix; rows of one id, source and size
    are interchangeable. Null sources are a source of their own, other columns are not read. An empty
    table gives an empty result. Whole texts are counted, however long; ``fit`` says what a long one costs. Carried
    columns named like a column of the result or a helper are the caller's to rename.
    """
    units = F.pmod(F.xxhash64(F.lit(seed), F.col(id_column)), F.lit(1 << 40)) / float(1 << 40)
    rows = materialise(docs.select(id_column, F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size"),
                                   units.alias("unit"), *carry), "sizes")
    sizes = materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    goals = materialise(targets(sizes, weights), "targets")
    plan = materialise(_plan(sizes, goals), "plan")
    key = F.to_json(F.struct("source"), {"ignoreNullFields": "false"})
    full = plan.withColumn("ranges", F.ceil(F.col("n") / ROWS_PER_RANGE))

    # Counts per source and size grow with the corpus, so they are merged, never broadcast; a hot size can split.
    placed = rows.withColumn("_source", key).join(full.hint("merge"), ["_source", "size"]).withColumn(
        "range", F.floor(F.col("unit") * F.col("ranges")))
    placed = materialise(placed, "placed")
    partial = placed.where("extra > 0 AND extra < n")
    counts = partial.groupBy("_source", "size", "range").agg(F.count("*").alias("here"), F.first("extra").alias("extra"))
    order = Window.partitionBy("_source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    quota = counts.withColumn("before", F.coalesce(F.sum("here").over(order), F.lit(0))).select(
        "_source", "size", "range", F.greatest(F.lit(0), F.least("here", F.col("extra") - F.col("before"))).alias("quota"), "here")
    ranged = partial.join(quota.hint("merge"), ["_source", "size", "range"])
    rank = F.row_number().over(Window.partitionBy("_source", "size", "range").orderBy("unit", id_column))
    cut = ranged.where("quota > 0 AND quota < here").withColumn("more", (rank <= F.col("quota")).cast("long"))
    whole = ranged.where("quota = 0 OR quota = here").withColumn("more", (F.col("quota") > 0).cast("long"))
    even = placed.where("extra = 0 OR extra >= n").withColumn("more", (F.col("extra") > 0).cast("long"))
    columns = [id_column, *carry, "source", "size", "source_size", "target", (F.col("copies") + F.col("more")).alias("copies")]
    mixed = even.select(*columns).unionByName(whole.select(*columns)).unionByName(cut.select(*columns))
    return mixed.withColumn("taken", F.col("size") * F.col("copies"))
