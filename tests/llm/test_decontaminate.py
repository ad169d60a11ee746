import random
from collections import Counter

import numpy as np
import pytest
from brute import in_order, rows_of

from kandela.llm import decontaminate as dc

ITEMS = "item_id long, text string, question string, answer string"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocabulary}x{rng.randrange(3)}" for _ in range(n))


def index_of(items):
    rows = [dc.item_parts({"item": i, "question": t.encode(), "answer": None}) for i, t in enumerate(items)]
    parts = [s for _, q, a in rows for s in dc.segment_words(q + a)]
    df = Counter(t for s in parts for t in set(s))
    return dc.Index(rows, df, len(parts), sum(map(len, parts)) / len(parts))


def exhaustive(index, terms, threshold):
    scores = Counter()
    for t in terms:
        for segment, weight in zip(*index.postings[t]):
            scores[segment] += weight
    return {s: v for s, v in scores.items() if v >= threshold}


@pytest.mark.parametrize("block", [1, 4, 64])
def test_wand_retrieves_all_above_the_threshold(monkeypatch, block):
    monkeypatch.setattr(dc, "POSTINGS_PER_BLOCK", block)
    index = index_of([prose(i, 10 + i % 90) for i in range(120)])
    rng, found = random.Random(1), 0
    for _ in range(150):
        terms = rng.sample(range(len(index.terms)), 60)
        terms += [index.terms[w] for w in rng.choice(index.items)[1]]
        terms = sorted(set(terms))
        for threshold in (0.1, 0.3, 0.6):
            got, want = dict(index.retrieve(terms, threshold)), exhaustive(index, terms, threshold)
            assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 for s in got)
            found += len(got)
    assert found > 100


def test_bounds_skip_no_passage_that_would_retrieve(monkeypatch):
    monkeypatch.setattr(dc, "SEGMENTS_PER_MATRIX", 32)
    monkeypatch.setattr(dc, "STRIDES_PER_MATRIX", 7)
    items = [prose(i, 20 + i % 80) for i in range(100)]
    index = index_of(items)
    text = " ".join(prose(1000 + i, 150) + " " + items[i] for i in range(30)).encode()
    numbers = index.numbers(text)
    count = -(-len(numbers) // dc.STRIDE) + 1
    strides, known = np.arange(len(numbers)) // dc.STRIDE, numbers >= 0
    for threshold in (0.2, 0.5):
        chosen = set(index.passages_to_query(strides[known], numbers[known], count, threshold).tolist())
        for s in range(count):
            terms = set(numbers[s * dc.STRIDE:(s + 2) * dc.STRIDE].tolist()) - {-1}
            if exhaustive(index, terms, threshold):
                assert s in chosen
        assert len(chosen) < count or threshold < 0.5


def documents():
    items = [prose(i, n) for i, n in enumerate((12, 40, 64, 65, 150, 400, 5, 1))]
    rows = [(i, prose(100 + i, 300) + " " + items[i % 8] + " " + prose(200 + i, 200)) for i in range(16)]
    rows += [(100 + i, prose(300 + i, 500)) for i in range(20)]
    rows += [(200, None), (201, ""), (202, items[1]), (203, items[1].upper().replace(" ", ", ")), (203, items[1]), (None, items[2]),
             (204, " ".join(items[3].split()[:30])), (205, prose(7, 60_000) + " " + items[4])]
    return items, rows


def brute_leaks(items, rows):
    """Pairs by the verification alone, over all pairs."""
    out = []
    for id_, text in rows:
        flat = b" " + b" ".join(dc.words((text or "").encode())) + b" "
        for i, item in enumerate(items):
            words = dc.words(item.encode())
            half = (len(words) + 1) // 2
            share = lambda part: sum(s in flat for s in dc.shingles(part)) / len(dc.shingles(part)) if part else 1.0
            if words and share(words) >= 0.8 and min(share(words[:half]), share(words[half:])) >= 0.5:
                out.append((id_, i))
    return in_order(out)


@pytest.mark.parametrize("shard_bytes", [8 << 20, 2000])
def test_against_all_pairs(spark, make_docs, shard_bytes):
    items, rows = documents()
    benchmark = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(items)] + [(50, None, None, None), (51, "", None, None)], ITEMS)
    found = dc.benchmark_leaks(make_docs(rows), benchmark, shard_bytes=shard_bytes)
    assert rows_of(found, "doc_id", "item_id") == brute_leaks(items, rows)


@pytest.mark.parametrize("shard_bytes", [8 << 20, 4000])
def test_repeated_items_are_indexed_once(spark, make_docs, monkeypatch, shard_bytes):
    items, rows = documents()
    repeated = [(i, t) for i, t in enumerate(items)] + [(100 + i, items[4]) for i in range(60)] + [(4, items[4]), (None, items[4])]
    sizes, built = [], dc.Index.__init__
    monkeypatch.setattr(dc.Index, "__init__", lambda self, items, *rest: sizes.append(
        [sum(len(w) + 1 for w in q + a) for _, q, a in items]) or built(self, items, *rest))
    benchmark = spark.createDataFrame([(i, t, None, None) for i, t in repeated], ITEMS)
    found = dc.benchmark_leaks(make_docs(rows), benchmark, shard_bytes=shard_bytes)
    leaks = brute_leaks(items, rows)
    assert rows_of(found, "doc_id", "item_id") == in_order([(d, i) for d, k in leaks for i, t in repeated if t == items[k]])
    assert sum(map(len, sizes)) == len(items) and all(sum(s) <= shard_bytes or len(s) == 1 for s in sizes)


def test_packed_shards_keep_the_bound():
    held = {i: 1 + i * 37 % 90 for i in range(500)} | {77: 1000, 499: 500}
    runs = dc.pack(held, 100)
    assert [b for low, high in runs for b in range(low, high + 1)] == sorted(held)
    assert all(low == high or sum(held[b] for b in range(low, high + 1)) <= 100 for low, high in runs) and dc.pack({}, 5) == []


def test_question_and_answer_must_both_overlap(spark, make_docs):
    question, answer = prose(1, 40), prose(2, 8)
    benchmark = spark.createDataFrame([(1, None, question, answer), (2, None, question, None)], ITEMS)
    docs = make_docs([(1, f"{question} {answer}"), (2, f"{question} " + prose(3, 8)), (3, answer)])
    found = dc.benchmark_leaks(docs, benchmark, question_column="question", answer_column="answer")
    assert rows_of(found.where("item_id = 1"), "doc_id") == [(1,)]


def test_empty_tables(spark, make_docs):
    none, one = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b c", None, None)], ITEMS)
    columns = ["doc_id", "item_id", "bm25", "overlap", "question_overlap", "answer_overlap"]
    for docs, benchmark in ((make_docs([(1, "a b c")]), none), (make_docs([]), one), (make_docs([]), none)):
        found = dc.benchmark_leaks(docs, benchmark)
        assert found.columns == columns and found.count() == 0
