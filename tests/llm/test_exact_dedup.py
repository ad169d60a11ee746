import random

import brute
import pytest
from brute import in_order, rows_of

from kandela.llm import exact_dedup as ed


def want(rows, largest):
    groups = {}
    for id_, text in rows:
        groups.setdefault(text or "", []).append(id_)
    out = []
    for id_, text in rows:
        ids = groups[text or ""]
        keep = (max if largest else min)((x for x in ids if x is not None), default=None)
        out.append((id_, keep, len(ids), id_ == keep, brute.sha(text or "")))
    return in_order(out)


@pytest.mark.parametrize("prefer", ["smallest", "largest"])
@pytest.mark.parametrize("spill", [1, 1 << 20])
def test_against_brute_force(make_docs, prefer, spill):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(7))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (None, "ab"), (None, "only here"), (3, texts[3]),
                                     (902, "long " * 50_000), (903, "long " * 50_000), (904, "long " * 49_999 + "lonk ")]
    found = ed.exact_duplicates(make_docs(rows), prefer, spill)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want(rows, prefer == "largest")


def test_trie_holds_what_a_dictionary_holds():
    rng, trie, plain = random.Random(3), ed.Trie(largest=False), {}
    for i in range(3000):
        key = bytes(rng.choice(b"abc") for _ in range(rng.randrange(9)))
        trie.insert(key, i, 1)
        owner, n = plain.get(key, (i, 0))
        plain[key] = (min(owner, i), n + 1)
    spilled = list(trie.spill())
    rest = list(trie.drain())
    assert spilled and {k: (o, n) for k, o, n in spilled + rest} == plain and len(spilled + rest) == len(plain)
    assert trie.size == 0


def test_trie_is_compressed():
    trie = ed.Trie(largest=False)
    trie.insert(b"prefix-one", 1, 1)
    trie.insert(b"prefix-two", 2, 1)
    (node,) = trie.root.children.values()
    assert node.label == b"prefix-" and {c.label for c in node.children.values()} == {b"one", b"two"}


def test_empty_table(make_docs):
    assert ed.exact_duplicates(make_docs([])).count() == 0


def test_prefer_is_checked(make_docs):
    with pytest.raises(ValueError):
        ed.exact_duplicates(make_docs([]), "newest")
