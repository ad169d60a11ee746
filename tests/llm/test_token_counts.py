"""Counts equal the library's on whole texts, however they are cut."""

import random

import pytest
from brute import in_order, rows_of

from kandela.llm import token_counts as tc
from kandela.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


def whole(text):
    return len(tc.tokenizer(PATH).encode(text or "", add_special_tokens=False))


def prose(seed, words):
    rng = random.Random(seed)
    parts = ["the", "Über", "foo's", "x1y22", "…", "<|endoftext|>", "e\u0301te\u0301", "\n\n", "가각", "a" * 30, "don't", "--", "\u0301"]
    return " ".join(rng.choice(parts) for _ in range(words))


CASES = [None, "", " ", "a", prose(1, 900), prose(2, 900), prose(2, 900), "z" * 9000, "q\u0301" * 3000, "9" * 5000,
         "<|startoftext|>" * 400, "word " * 2000, "'s" * 3000, "\u0301" * 4000, prose(3, 300) + "b" * 4000 + prose(4, 300)]


@pytest.mark.parametrize("whole_chars, piece, overlap", [(300, 600, 256), (1500, 1500, 300), (32768, 8192, 512)])
def test_equal_to_whole_encoding(make_docs, whole_chars, piece, overlap):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(5, CASES[5]), (None, "null id"), (None, CASES[4])]
    found = tc.token_counts(make_docs(rows), PATH, limit=700, whole_chars=whole_chars, piece_chars=piece, overlap_chars=overlap)
    want = [(i, len((t or "").encode()), whole(t), whole(t) > 700) for i, t in rows]
    assert rows_of(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == in_order(want)


def test_empty_table(make_docs):
    assert tc.token_counts(make_docs([]), PATH).count() == 0


def test_overlap_must_hold_margins(make_docs):
    with pytest.raises(ValueError):
        tc.token_counts(make_docs([]), PATH, overlap_chars=10)


def test_marks_are_pretoken_starts():
    text = "alpha beta gamma " * 40
    found = tc.tokenizer(PATH).encode(text, add_special_tokens=False)
    places = tc.marks(text, found.ids, found.word_ids, found.offsets, 0, 0, len(text))
    assert places and all(text[m["pos"] - 1] == " " and text[m["pos"]] != " " for m in places)
    assert all(tc.MARGIN <= m["pos"] <= len(text) - tc.MARGIN for m in places)


def test_words_are_only_cut_where_the_definition_proves_it():
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    assert tc.words_are_independent(tc.tokenizer(PATH))
    assert not tc.words_are_independent(tc.tokenizer(vocabulary("byte_bpe_50k.json")))
    for change in ("normalizer", "pre_tokenizer", "special"):
        other = Tokenizer.from_file(PATH)
        if change == "normalizer":
            other.normalizer = normalizers.Strip()
        elif change == "pre_tokenizer":
            other.pre_tokenizer = pre_tokenizers.ByteLevel()
        else:
            other.add_special_tokens(["a b"])
        assert not tc.words_are_independent(other)


def test_odd_white_space_inside_words():
    texts = ["a\u00a0b\u2003c", "x\x1cy\x85z", "p\rq\x0br\x0cs", "tab\there", "e \u0301 \n\u0301x", "  <|endoftext|>  <|startoftext|>q ", "İI ß K"]
    assert tc.TextCounter(PATH)(texts) == [whole(t) for t in texts]


def test_the_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(tc, "MEMO_WORDS", 50)
    count = tc.TextCounter(PATH)
    for seed in range(20):
        text = " ".join(f"w{seed}x{i}" for i in range(40))
        assert count([text, text]) == [whole(text)] * 2 and len(count.words) <= 50 + 40


def test_another_tokenizer_is_encoded_whole(make_docs):
    path = vocabulary("byte_bpe_50k.json")
    texts = ["two  words", " \n x", prose(9, 1500)]
    found = tc.token_counts(make_docs(list(enumerate(texts))), path, whole_chars=2000, piece_chars=2000, overlap_chars=400).collect()
    tk = tc.tokenizer(path)
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(tk.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}
