import hashlib
from collections import defaultdict

import brute
import numpy as np
import pytest
import xxhash
from brute import rows_of
from hypothesis import given, settings, strategies as st

from kandela.llm import chat_format as C
from kandela.llm.queries import CONTROL_TEXT, vocabulary

PATH = vocabulary("byte_bpe_50k.json")
TEXTS = st.text(alphabet=st.sampled_from(list("\\#</turn>: \nAé\U0001f600")), max_size=30)
HARD = ["", CONTROL_TEXT, "###", "####### ", "</turn>\n", "\\", "\\\\###", "</turn", ": ", "<|endoftext|>", " \t\r\n", "é\U0001f600\u0301", "a" * 5000]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=4))
def test_written_turns_read_back(turns):
    assert C.PLAIN.read(C.PLAIN.write(turns)) == turns


def test_broken_text_is_refused():
    with pytest.raises(ValueError):
        C.PLAIN.read("### user: no end")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a: b"]), TEXTS | st.sampled_from(HARD)), max_size=4))
def test_ids_hold_the_written_text_and_the_mask_the_assistant(turns):
    tk = C.tokenizer(PATH)
    coded = C.assemble(tk, turns)
    ids, marks = [i for x, _ in coded for i in x], [m for _, x in coded for m in x]
    assert C.written(tk, ids) == C.PLAIN.write(turns)
    mask = C.loss_mask(marks)
    assert not mask[np.isin(ids, C.reserved(tk))].any()
    assert C.masked_texts(tk, ids, mask) == [text for role, text in turns if role == "assistant" and text]


def table(spark, rows):
    extra = ["place", "start", "ids", "marks", "a", "row", "part", "n_tokens"]
    columns = "conv_id long, turn long, role string, text string" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame([r + (None,) * len(extra) for r in rows], columns).repartition(3)


def plain(rows):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        a = xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))
        convs[conv].append(((turn is not None, turn or 0), role, a - (a >> 63 << 64), text))
    out = []
    for conv, turns in convs.items():
        turns = [(role, text) for _, role, _, text in sorted(turns)]
        loss = "".join(text for role, text in turns if role == "assistant")
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(C.PLAIN.write(turns))))
    return out


ROWS = ([(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)] + [(2, None, None, None), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"),
        (2, 0, "assistant", "a"), (None, 1, "system: x", "null id"), (3, 0, "user", "only"), (4, 0, "assistant", "")] + [(5, i, "assistant", f"t{i}") for i in range(90)])


def test_digests(spark):
    found = C.read_back(C.format_turns(table(spark, ROWS), PATH), PATH)
    assert rows_of(found, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars") == brute.in_order(plain(ROWS))


def test_token_stream(spark):
    """Places count up and starts add up the tokens before, also where a conversation crosses ranges."""
    rows = sorted(C.format_turns(table(spark, ROWS), PATH).where("conv_id = 5").collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(1, 91))
    assert [r.start for r in rows] == [0, *np.cumsum([len(r.ids) for r in rows])[:-1]]
    assert all(len(r.ids) == len(r.marks) == r.n_tokens for r in rows)
    text = C.written(C.tokenizer(PATH), [i for r in rows for i in r.ids])
    assert C.PLAIN.read(text) == [("assistant", f"t{i}") for i in range(90)]


def test_empty(spark):
    assert C.read_back(C.format_turns(table(spark, []), PATH), PATH).count() == 0
