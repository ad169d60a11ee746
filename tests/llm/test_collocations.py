import random
import re
from collections import Counter

import brute
import numpy as np
import pytest

from kandela.llm import collocations as C


def plain(rows, least, top=2000, longest=5):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    count, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    count.setdefault(lang, Counter())[words[i:i + m]] += 1
    out = []
    for lang, f in count.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {y[i:j] for y, a in kept.items() for i in range(len(y)) for j in range(i + 2, len(y) + 1)
                   if j - i < len(y) and a >= f[y[i:j]]}
        found = []
        for p, a in kept.items():
            if p not in covered:
                score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return out


def table(spark, rows, parts=3):
    extra = "".join(f", `{c}` string" for c in ("words", "phrase", "n", "raw", "total", "score", "w", "k", "rank", "longer"))
    return spark.createDataFrame([r + (None,) * 10 for r in rows], "lang string, text string" + extra).repartition(parts)


def prose(seed, documents, words=("the", "of", "Red", "fox", "sees", "a", "cat", "über", "x")):
    r = random.Random(seed)
    one = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", ". ", "\n", ", ", "  "]) for _ in range(r.randrange(60)))
    return [(r.choice(["en", "en", None, "und", "de"]), one()) for _ in range(documents)]


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("how", [{}, {"one_in": 1000}, {"filter_bits": 64, "chunk_bytes": 40}])
def test_equals_counting_everything(spark, how):
    rows = prose(1, 60) + [(None, None), ("en", ""), ("fr", "..."), ("en", "echo " * 40), ("en", "red fox sees " * 9)] + [("de", "Ein Satz, zwei Worte")] * 7 + [("t\tab", "v w")] * 6
    got = C.collocations(table(spark, rows), least=6, **how)
    assert brute.rows_of(got, *COLUMNS) == brute.in_order(plain(rows, 6))


def test_top_and_ties(spark):
    rows = [("en", "a b. c d. e f. g h")] * 3 + [("xx", "z y")] * 3
    got = C.collocations(table(spark, rows), least=3, top=2)
    assert brute.rows_of(got, *COLUMNS) == brute.in_order(plain(rows, 3, top=2))


def test_endless_piece_and_repeats(spark):
    rows = [("en", "la " * 5000 + "end"), ("en", "x" * 9000 + " y")] + [("en", "p q r s t u")] * 4
    got = C.collocations(table(spark, rows), least=4, chunk_bytes=1000)
    assert brute.rows_of(got, *COLUMNS) == brute.in_order(plain(rows, 4))


def test_empty(spark):
    assert C.collocations(table(spark, []), least=1).count() == 0
    assert C.collocations(table(spark, [(None, None)]), least=1).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    a, n = 3_000_000_000_017, 9_000_000_000_000_029
    found = spark.createDataFrame([("en", 0, "", n), ("en", 1, "p", a + 5), ("en", 1, "q", a + 11), ("en", 2, "p q", a)], C.COUNTS)
    monkeypatch.setattr(C, "frequent_phrases", lambda *_, **__: found)
    row = C.collocations(None).first()
    assert (row.score, row.l, row.r) == (1000 * a * n // ((a + 5) * (a + 11)), a + 5, a + 11)


def test_a_failing_sample_takes_further_passes(spark, monkeypatch):
    passes, real = [], C.count_pass
    monkeypatch.setattr(C, "count_pass", lambda *args: passes.append(args[3]) or real(*args))
    rows = [("en", "one two three four five")] * 8
    found = C.frequent_phrases(table(spark, rows), least=8, one_in=10**6)
    assert found.where("words = 5").count() == 1
    assert sum(counted is not None for counted in passes) >= 2


def test_split_words():
    words, ids, piece = C.split_words("Ab  c\td. AB\nc".encode())
    assert [words[i].as_py() for i in ids] == [b"ab", b"c", b"d", b"ab", b"c"]
    assert list(np.diff(piece)) == [0, 0, 1, 1]
    for raw in (b"", b" ", b".", b"a", b" a", b"a "):
        assert len(C.split_words(raw)[1]) == len(re.findall(rb"[^ .]+", raw))


def test_hash_of_a_phrase_is_that_of_its_places():
    words, ids, _ = C.split_words(b"red fox sees")
    h = C.word_hashes(words)[ids]
    by_place = C.longer(C.longer(C.longer(np.array([C.lang_hash("en")]), h[:1]), h[1:2]), h[2:])
    assert C.phrase_hashes([b"red fox sees".split(b" ")], ["en"]) == by_place
