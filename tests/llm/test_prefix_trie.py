import hashlib
import random
import zlib
from collections import defaultdict

import xxhash

import brute
from brute import rows_of

from pyspark.sql import functions as F

from kandela.llm import prefix_trie as P

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
EXTRA = ["pos", "a", "b", "k1", "k2", "part", "depth", "row", "head", "n_convs", "size", "chars", "of"]


def table(spark, rows):
    extra = "".join(f", `{c}` string" for c in EXTRA)
    return spark.createDataFrame([r + (None,) * len(EXTRA) for r in rows], "conv_id long, turn long, role string, text string" + extra).repartition(3)


def ordered(rows):
    """{conv_id: [(role, text)]} with ties by role and the hash the operator uses."""
    tie = lambda role, text: (x := xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))) - (x >> 63 << 64)
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append(((turn is not None, turn or 0), role or "", tie(role or "", text or ""), text or ""))
    return {c: [(role, text) for _, role, _, text in sorted(v)] for c, v in convs.items()}


def plain(paths):
    """The contract's rows for {conv_id: [(role, text)]}."""
    last = lambda ids: min((i for i in ids if i is not None), default=None)
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = sorted((c for c in ids if len(paths[c]) == len(node)), key=lambda c: (c is None, c or 0))
        text = ",".join("null" if c is None else str(c) for c in ends)
        out.append((last(ids), len(node), last(members[node[:-1]]) if node else None, len(ids),
                    sum(len(n) == len(node) + 1 for n in below), sum(not any(m[:-1] == n and m for m in members) for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(text.encode()).hexdigest()))
    return out


def random_turns(seed, convs, most=9):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(convs * 3), convs):
        stem = [r.choice("ab") for _ in range(r.randrange(most))]
        rows += [(c, i, "user" if i % 2 else "assistant", "x" * (i + 1) + t) for i, t in enumerate(stem)]
    return rows


def check(spark, rows):
    assert rows_of(P.prefix_trie(table(spark, rows)), *COLUMNS) == brute.in_order(plain(ordered(rows)))


def test_equals_plain_trie(spark):
    check(spark, random_turns(3, 40))


def test_nulls_ties_repeats_and_deep_sharing(spark):
    deep = [(c, i, "user", f"é{i}") for c in (70, 71, 72) for i in range(12)] + [(72, 12, "user", "more"), (71, 12, "user", "else")]
    rows = deep + [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (2, 5, "", ""), (None, 1, "user", "é0"),
                   (None, 2, "user", "é1"), (5, 1, "user", "same"), (5, 1, "user", "same"), (6, 1, "user", "x" * 100_000)]
    check(spark, rows)


def test_conversation_over_many_ranges(spark):
    check(spark, [(9, i, "user", str(i % 7)) for i in range(130)] + [(c, 0, "user", "0") for c in range(3)])


def test_empty(spark):
    assert P.prefix_trie(table(spark, [])).count() == 0


def test_shared_openings(spark):
    rows = random_turns(5, 60, most=8) + [(300 + c, i, "user", f"{c}{i}") for c in range(40) for i in range(c % 9)]
    opening = lambda c: zlib.crc32(str(c).encode()) % 6
    convs = ordered(rows)
    rebuilt = {c: convs.get(c - c % 100, [])[:opening(c)] + turns[opening(c):] for c, turns in convs.items()}
    turns = table(spark, rows)
    ids = turns.select("conv_id").distinct()
    paths = P.with_shared_openings(P.in_order(turns), ids, F.col("conv_id") - F.col("conv_id") % 100,
                                   F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6)
    assert rows_of(P.trie(paths, ids), *COLUMNS) == brute.in_order(plain(rebuilt))
