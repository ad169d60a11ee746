import zlib
from pathlib import Path

import pytest

from kandela.llm import quality

FOLDER = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    rows = [(r["score"], r["quality"]) for r in quality.score(docs, model).join(labels.where(quality.held_out()), "doc_id").collect()]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    assert auc > 0.98 and sum(g >= 0.7 for g in good) > 0.98 * len(good) and sum(b < 0.7 for b in bad) > 0.93 * len(bad)
    assert abs(sum(s for s, _ in rows) / len(rows) - len(good) / len(rows)) < 0.03  # calibrated in the mean


def test_held_out_is_the_crc_rule(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("h", quality.held_out()).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_only_the_text_counts_and_edge_rows(spark, make_docs):
    good, bad = "a calm and useful sentence about rivers. ", "BUY!!! $$$ ### "
    rows = [(i, (good if i % 2 else bad) * (5 + i % 7)) for i in range(60)] + [(100, None), (101, ""), (None, good * 5), (7, good * 12),
            (102, good * 30_000), (103, bad * 30_000)]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (1, 1, 0), (3, None, 0), (999, 0, 0)], LABELS)
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model, carry=("doc_id", "text", "lang", "score")).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    assert all(r["lang"] == "en" for r in scored)
    by_id = {r["doc_id"]: r["score"] for r in scored}
    assert by_id[100] == by_id[101] and by_id[102] > 0.7 > 0.3 > by_id[103]
    texts = {}
    for r in scored:
        assert texts.setdefault(r["text"], r["score"]) == r["score"]


def test_labels_with_long_texts_only_still_train(spark, make_docs):
    good, bad = "a calm and useful sentence about rivers. ", "BUY!!! $$$ ### "
    rows = [(i, good * 900 if i % 2 else bad * (5 + i % 7)) for i in range(40)] + [(100, good * 9), (101, bad * 9)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], LABELS)
    by_id = {r["doc_id"]: r["score"] for r in quality.score(make_docs(rows), quality.fit(make_docs(rows), labels)).collect()}
    assert by_id[100] > 0.7 > 0.3 > by_id[101]


@pytest.mark.parametrize("some_short, rows", [(True, 4), (False, 1)])
def test_long_texts_do_not_use_up_the_sample(spark, make_docs, monkeypatch, some_short, rows):
    """Six texts in eight are short, or none; 400 bytes have room for one long text."""
    docs = make_docs([(i, f"{i} " + "x" * (5 if some_short and i % 8 < 6 else 210)) for i in range(200)])
    labels, seen = spark.createDataFrame([(i, i // 8 % 2, 0) for i in range(200)], LABELS), []
    trained = quality.train_dictionary
    monkeypatch.setattr(quality, "train_dictionary", lambda texts: seen.append(texts) or trained(texts))
    quality.fit(docs, labels, sample_rows=4, sample_bytes=100)
    assert len(seen) == 2 and all(len(texts) == rows and (max(map(len, texts)) <= 100) == some_short for texts in seen)


@pytest.mark.parametrize("labels, share", [([], 0.5), ([(1, 1, 0), (2, 1, 0)], 0.999), ([(1, 0, 0)], 0.001)])
def test_without_both_labels_the_share_is_the_score(spark, make_docs, labels, share):
    docs = make_docs([(1, "one"), (2, "two"), (3, None)])
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS))
    assert {round(r["score"], 6) for r in quality.score(docs, model).collect()} == {share}


def test_empty_tables(spark, make_docs):
    docs = make_docs([])
    assert quality.score(docs, quality.fit(docs, spark.createDataFrame([], LABELS))).count() == 0
