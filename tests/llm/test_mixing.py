import random
import tracemalloc
from collections import Counter, defaultdict

import brute
import pytest
from brute import in_order, rows_of

from kandela.llm import mixing


def test_fit_reaches_the_best_sum():
    rng = random.Random(8)
    for _ in range(300):
        counts = {rng.randint(1, 900): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        sizes = [s for s, n in counts.items() for _ in range(n)]
        budget = rng.randint(0, sum(sizes) - 1)
        taken = mixing.fit(counts, budget)
        assert all(0 < k <= counts[s] for s, k in taken.items())
        assert sum(s * k for s, k in taken.items()) == brute.best_mix(sizes, budget)


def test_fit_of_large_budgets():
    rng = random.Random(9)
    counts = {s: rng.randint(1, 10**6) for s in range(1, 3000)}
    total = sum(s * n for s, n in counts.items())
    for share in (0.1, 0.5, 0.999):
        taken = mixing.fit(counts, int(total * share))
        assert sum(s * k for s, k in taken.items()) == int(total * share)
    assert mixing.fit(counts, total) == counts and mixing.fit(counts, 10 * total) == counts
    assert mixing.fit({250_000: 1, 3: 5}, 300_000) == {250_000: 1, 3: 5}
    assert mixing.fit({}, 5) == {} and mixing.fit({7: 3}, 6) == {} and mixing.fit({0: 9}, 3) == {}


def test_fit_of_large_documents():
    assert mixing.fit({120_000: 1, 100_000: 1, 90_000: 1}, 190_000) == {100_000: 1, 90_000: 1}
    assert mixing.fit({700_000: 1, 600_000: 1, 500_000: 1}, 1_100_000) == {600_000: 1, 500_000: 1}
    rng = random.Random(10)
    for n, most in ((3, 2), (8, 1), (30, 1), (100, 3)):
        counts = {rng.randint(70_000, 700_000): rng.randint(1, most) for _ in range(n)}
        sizes = [s for s, k in counts.items() for _ in range(k)]
        for budget in (rng.randint(0, sum(sizes) - 1), sum(sizes) // 2, sum(sizes) - 190_000):
            taken = mixing.fit(counts, budget)
            assert all(0 < k <= counts[s] for s, k in taken.items())
            assert sum(s * k for s, k in taken.items()) == brute.best_mix(sizes, budget)


def test_fit_of_many_large_documents():
    rng = random.Random(11)
    counts = Counter(rng.randint(70_000, 700_000) for _ in range(512))
    total = sum(s * n for s, n in counts.items())
    for share in (0.01, 0.3, 0.5, 0.8, 0.99):
        taken = mixing.fit(counts, int(total * share))
        assert all(0 < k <= counts[s] for s, k in taken.items())
        assert sum(s * k for s, k in taken.items()) == int(total * share)
    assert sum(s * k for s, k in mixing.fit({**counts, 5_000_000: 1}, total // 3).items()) == total // 3


def sizes(seed, least, most, n, *more):
    rng = random.Random(seed)
    return Counter([*(rng.randint(least, most) for _ in range(n)), *more])


@pytest.mark.parametrize("counts", [
    sizes(12, 1_000_000, 3_000_000, 250), sizes(13, 1_000_000, 3_000_000, 257),
    sizes(14, 1, 2000, 3000, 20_000_000), sizes(15, 1, 2000, 3000, 20_000_000, 20_000_000)])
def test_sums_and_memory_of_large_documents(counts):
    """Bits of numbers are counted by the allocator: rows kept, rows made again and the few in work."""
    total = sum(s * n for s, n in counts.items())
    fine = sum(s * n for s, n in counts.items() if s < 20_000_000)
    for budget in (int(fine * 0.3), int(fine * 0.6), total - int(fine * 0.2)):
        tracemalloc.start()
        taken = mixing.fit(counts, budget)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert all(0 < k <= counts[s] for s, k in taken.items())
        assert sum(s * k for s, k in taken.items()) == budget and peak < 100_000_000


def test_rows_made_again_give_the_same_sums(monkeypatch):
    rng = random.Random(16)
    cases = [({rng.randint(1, 900): rng.randint(1, 9) for _ in range(rng.randint(1, 30))}, rng.random()) for _ in range(60)]
    fits = [mixing.fit(counts, int(share * sum(s * n for s, n in counts.items()))) for counts, share in cases]
    monkeypatch.setattr(mixing, "ROWS_BYTES", 64)
    again = [mixing.fit(counts, int(share * sum(s * n for s, n in counts.items()))) for counts, share in cases]
    assert again == fits


def documents():
    rng = random.Random(3)
    sources = ["b", "a", "é", "Z", None, "", "𝒳", "tiny"]
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(sources[:7])) for i in range(700)]
    return rows + [(900, "only three words", "tiny"), (901, None, "a"), (902, "", None), (903, "x " * 70_000, "b"), (None, "a b", "a"), (5, "c d", "a"), (5, "c d", "a")]


def test_targets_and_sums(make_docs):
    rows = documents()
    mixed = mixing.mix(make_docs(rows)).collect()
    assert len(mixed) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += brute.word_count(text)
    goal, taken, found = brute.targets(sizes), Counter(), defaultdict(list)
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - goal[r["source"]]) < 1e-6
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3 and (r["size"] or r["copies"] == 0)
        taken[r["source"]] += r["taken"]
        found[r["source"]].append(r["size"])
    assert taken == {source: brute.best_mix(found[source], target) for source, target in goal.items()}
    assert in_order([(r["doc_id"], r["size"]) for r in mixed]) == in_order([(i, brute.word_count(t)) for i, t, _ in rows])


def test_reruns_and_other_partitionings_agree(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 5)
    columns = ("doc_id", "size", "taken", "target")
    rows = [r for r in documents() if r[0] != 903]
    first = rows_of(mixing.mix(make_docs(rows)), *columns)
    assert first == rows_of(mixing.mix(make_docs(rows, partitions=7)), *columns)
    assert first != rows_of(mixing.mix(make_docs(rows), seed=99), *columns)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " \n", "b")]])
def test_nothing_to_take(make_docs, rows):
    assert [r["taken"] for r in mixing.mix(make_docs(rows)).collect()] == [0] * len(rows)


def test_carried_columns(make_docs):
    mixed = mixing.mix(make_docs([(1, "a b", "s")]), carry=("lang",)).collect()
    assert [(r["lang"], r["size"]) for r in mixed] == [("en", 2)]
