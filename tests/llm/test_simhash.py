import random

import brute
import pytest
from brute import in_order, rows_of

from kandela.llm import graph, simhash


def test_every_pair_within_the_radius_meets_under_some_mask():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        rng = random.Random(radius)
        for _ in range(3000):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius)))
            assert any(flips & m == 0 for m in masks)


def test_fingerprints(make_docs):
    texts = [None, "", " \t\n", "one", "One TWO", "a b c", "a b c d", "É é É é", "x " * 70_000, "ß" + "\u00a0" + "y z w"]
    rows = list(enumerate(texts)) + [(None, "null id")]
    found = simhash.fingerprints(make_docs(rows), 3)
    got = {(r["doc_id"], r["fp"] % (1 << 64)) for r in found.collect()}
    assert got == {(i, brute.simhash(t)) for i, t in rows}


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_links_connect_exactly_the_pairs_within_the_radius(spark, radius):
    rng = random.Random(11)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for base in list(prints)[:12]:
        for _ in range(25):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            prints.add(base)
    rows = [(f, f) for f in sorted(prints)]
    frame = spark.createDataFrame([(simhash.signed(f),) for f in prints], "fp long").repartition(3)
    linked = {r["node"] % (1 << 64): r["component"] for r in graph.components(simhash.links(frame, radius)).collect()}
    got, want = {}, {}
    for (f, _), c in zip(rows, brute.components(rows, radius)):
        got.setdefault(linked.get(f, ("alone", f)), set()).add(f)
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_all_pairs(spark, make_docs):
    import duckdb

    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows += [(1000, None), (1001, ""), (1002, "  "), (None, ""), (3, rows[3][1]), (None, "alone without an id"), (5, "another text of five")]
    found = simhash.near_duplicates(make_docs(rows))
    prints = [(i, brute.simhash(t)) for i, t in rows]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(prints, brute.components(prints))]
    assert rows_of(found, "doc_id", "fingerprint", "component_id") == in_order(want)
    kept = found.where("kept").distinct().collect()  # id 5 names two texts, each a component of its own
    groups = {c if c is not None else f for _, f, c in want}
    assert len(kept) == len(groups) + 1 and all(r["doc_id"] == r["component_id"] for r in kept)


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
