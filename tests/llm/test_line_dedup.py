import random

import brute
from brute import in_order, rows_of

from kandela.llm import line_dedup
from pyspark.sql import functions as F

SHARED = "A line that many documents share, word for word, here."


def kept(docs):
    found = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return rows_of(found, "doc_id", "n_lines", "n_dropped", "text")


def test_against_brute_force(make_docs):
    rng = random.Random(5)
    pool = [f"  Shared LINE number {i} that is É long enough to count \t" for i in range(6)] + ["short", "", "x" * 40]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(60)]
    assert kept(make_docs(rows)) == in_order(brute.drop_lines(rows))


def test_nulls_empties_repeats_and_long_texts(make_docs):
    rows = [(i, SHARED) for i in range(5)] + [(4, SHARED), (7, None), (8, ""), (None, SHARED), (None, None),
            (9, "\n".join([SHARED] * 3000 + ["own"])), (10, "\r" + SHARED.upper() + "\x0b\nend\n")]
    assert kept(make_docs(rows)) == in_order(brute.drop_lines(rows))


def test_four_documents_or_39_characters_are_not_enough(make_docs):
    rows = [(i, SHARED) for i in range(4)] + [(i, "y" * 39) for i in range(10, 20)]
    assert all(r[2] == 0 for r in kept(make_docs(rows)))


def test_non_ascii_letters_keep_their_case(make_docs):
    rows = [(i, "É" * 40) for i in range(5)] + [(i, "é" * 40) for i in range(5, 9)]
    assert [r[2] for r in kept(make_docs(rows))] == [1, 1, 1, 1, 0, 0, 0, 0, 0]


def test_bitmaps_are_runs_without_text(make_docs):
    docs = make_docs([(i, f"own {i}\n{SHARED}\n{SHARED}\nlast") for i in range(6)])
    maps = line_dedup.keep_bitmaps(docs)
    assert maps.columns == ["doc_id", "text_key", "n_lines", "n_dropped", "keep_runs"]
    first = maps.where("doc_id = 0").first()
    assert [tuple(r) for r in first["keep_runs"]] == [(0, 1), (3, 1)] and first["n_dropped"] == 2
    assert maps.where("doc_id = 5").count() == 0


def test_empty_table(make_docs):
    assert kept(make_docs([])) == []


def test_no_python_in_the_plan(make_docs):
    docs = make_docs([(1, SHARED)])
    plan = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).select(F.sha2("text", 256))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
