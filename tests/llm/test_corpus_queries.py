"""The registered queries against their SQL or brute force on the small tables, and the whole pipeline."""

import re
import zlib
from pathlib import Path

import brute
import duckdb
import pytest
from brute import CLASHES, in_order, rows_of

from pyspark.sql import functions as F

import corpus_pipeline
from kandela.llm import quality, token_counts
from kandela.llm.queries import ORACLES, QUERIES, vocabulary
from kandela.plans.compare import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="module")
def documents(db):
    return db.execute("SELECT doc_id, text, source FROM documents ORDER BY 1").fetchall()


def test_all_are_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(QUERIES, key=lambda n: int(re.match(r"op(\d+)_", n)[1]))] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, db, name):
    assert compare(QUERIES[name](spark, FOLDER).toPandas(), db.execute(ORACLES[name]).df()) is None


def test_op1(spark, documents):
    tk = token_counts.tokenizer(vocabulary("word_bpe_49k.json"))
    want = [(i, len(t.encode()), n := len(tk.encode(t, add_special_tokens=False)), n > 2048) for i, t, _ in documents]
    assert rows_of(QUERIES["op1_token_counts"](spark, FOLDER), "doc_id", "n_bytes", "n_tokens", "over_limit") == in_order(want)


def test_op4(spark, documents):
    prints = [(i, brute.simhash(t)) for i, t, _ in documents]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(prints, brute.components(prints))]
    assert rows_of(QUERIES["op4_simhash"](spark, FOLDER), "doc_id", "fingerprint", "component_id") == in_order(want)


def test_op5(spark, documents):
    rows = QUERIES["op5_quality"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == [i for i, _, _ in documents]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.7)


def test_op5_by_plain_compression(spark, documents):
    table = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    model = quality.fit(table("documents"), table("labels").where(~quality.held_out()))
    found = {r["doc_id"]: r["score"] for r in QUERIES["op5_quality"](spark, FOLDER).collect()}
    assert model.good and model.bad and found.keys() == {i for i, _, _ in documents}
    for i, text, _ in documents:
        assert found[i] == pytest.approx(brute.quality_score(model, text), abs=1e-9)


def test_op6(spark, documents):
    want = []
    for i, t, _ in documents:
        spans = brute.secrets(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((i, *(sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex")), brute.sha(listed), listed))
    assert rows_of(QUERIES["op6_secrets"](spark, FOLDER), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans") == in_order(want)


def test_op7(spark, db, documents):
    items = db.execute("SELECT item_id, text FROM benchmark").fetchall()
    want = [(i, k) for i, t, _ in documents for k, item in items if brute.contains_item(t, item)]
    assert rows_of(QUERIES["op7_decontaminate"](spark, FOLDER), "doc_id", "item_id") == in_order(want)


def test_op8(spark, documents):
    rows = QUERIES["op8_mixing"](spark, FOLDER).collect()
    size = {i: brute.word_count(t) for i, t, _ in documents}
    total = {}
    for i, _, s in documents:
        total[s] = total.get(s, 0) + size[i]
    goal, of, taken = brute.targets(total), {i: s for i, _, s in documents}, dict.fromkeys(total, 0)
    for r in rows:
        s = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[s]) and abs(r["target"] - goal[s]) < 1e-6
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[s] += r["taken"]
    assert len(rows) == len(documents)
    assert taken == {s: brute.best_mix([size[i] for i in of if of[i] == s], t) for s, t in goal.items()}


def test_pipeline_against_brute_force(spark, db, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name.replace(" ", "-"))
        stage(spark, steps[-1], FOLDER).write.parquet(path)
        steps.append(spark.read.parquet(path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert steps[-1].columns == columns
    docs, good, lines, groups, clean, mixed = ({r["doc_id"]: r for r in s.collect()} for s in steps)
    assert all(s.count() == len(found) for s, found in zip(steps, (docs, good, lines, groups, clean, mixed)))

    model = quality.fit(steps[0], spark.read.parquet(f"{FOLDER}/labels.parquet").where(~quality.held_out()))
    score = dict(zip(docs, model.scores([r["text"].encode() for r in docs.values()])))
    assert good.keys() == {i for i, s in score.items() if s >= 0.7} and all(good[i] == docs[i] for i in good)

    want = brute.drop_lines([(i, r["text"]) for i, r in good.items()])
    assert in_order([(i, r["text"], r["n_chars"]) for i, r in lines.items()]) == in_order([(i, t, len(t)) for i, _, _, t in want])

    prints = [(i, brute.simhash(r["text"])) for i, r in lines.items()]
    assert groups.keys() == set(brute.components(prints)) and all(groups[i] == lines[i] for i in groups)

    items = [t for (t,) in db.execute("SELECT text FROM benchmark").fetchall()]
    leaking = {i for i, r in groups.items() if any(brute.contains_item(r["text"], t) for t in items)}
    assert clean.keys() == groups.keys() - leaking

    total = {}
    for r in clean.values():
        total[r["source"]] = total.get(r["source"], 0) + brute.word_count(r["text"])
    goal, taken = brute.targets(total), dict.fromkeys(total, 0)
    for i, r in mixed.items():
        assert [r[c] for c in columns] == [clean[i][c] for c in columns] and r["taken"] > 0
        taken[r["source"]] += r["taken"]
    sizes = {s: [brute.word_count(r["text"]) for r in clean.values() if r["source"] == s] for s in goal}
    assert taken == {s: brute.best_mix(sizes[s], t) for s, t in goal.items()}


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, FOLDER).where("taken > 0").count() > 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, make_docs, stage):
    odd = [(1, None), (None, None), (None, "no id, but words enough to be a text"), (2, ""), (3, "a b c", None), (3, "a b c", None),
           (3, "another text with the same id", "s"), (4, "long " * 40_000)]
    for rows in (odd, []):
        docs = make_docs(rows).withColumn("lang", F.lit(None).cast("string"))
        found = stage(spark, docs, FOLDER)
        assert set(docs.columns) <= set(found.columns) and found.count() <= len(rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_named_like_their_helpers(spark, make_docs, tmp_path, name, stage):
    """The same rows with and without clashing columns give the same documents, and each clashing value stays with its row."""
    real = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(60).collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in real]
    docs, last = make_docs(rows), name == corpus_pipeline.STAGES[-1][0]
    stage(spark, docs, FOLDER).write.parquet(str(tmp_path / "found"))
    found = spark.read.parquet(str(tmp_path / "found"))
    plain = stage(spark, make_docs(rows, clash=False), FOLDER)
    own = ["doc_id", "text", "lang", "source", "n_chars"] + (list(corpus_pipeline.MIX_COLUMNS) if last else [])
    assert found.count() > 0 and rows_of(found, *own) == rows_of(plain, *own)
    assert last or found.columns == docs.columns
    number = {i: k for k, (i, _, _) in enumerate(rows)}
    for r in found.collect():
        for c in set(CLASHES) - set(corpus_pipeline.MIX_COLUMNS if last else ()):
            assert r[c] == f"{c} {number[r['doc_id']]}"


def test_clean_rows_stay_beside_leaking_ones_of_their_id(spark, make_docs):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    rows = [(None, f"before {item} after"), (None, "a clean text"), (None, None), (7, item), (7, "another clean text"), (7, item), (8, item)]
    found = corpus_pipeline.without_benchmark(spark, make_docs(rows), FOLDER)
    assert rows_of(found, "doc_id", "text") == in_order([(None, "a clean text"), (None, None), (7, "another clean text")])
