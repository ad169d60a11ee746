"""From documents to a training mix: each stage works on all its predecessor kept, as a Parquet table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kandela.llm import decontaminate, line_dedup, mixing, quality, simhash
from kandela.llm.text import field, or_empty, row_of
from kandela.session import scratch_path

KEEP_SCORE = 0.7

# The classifier's compressed sizes, SimHash and BM25 retrieval have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


MIX_COLUMNS = ("size", "source_size", "target", "copies", "taken")


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text, text_key, row``: what the operators read, and every other column inside a struct.

    So an input may have any further columns: none meets a helper or result column of a stage.
    """
    text = F.col("text")
    return docs.select("doc_id", "source", text.alias("text"), F.xxhash64(or_empty(text)).alias("text_key"),
                       row_of([c for c in docs.columns if c != "text"]).alias("row"))


def _unpacked(columns: list[str], **changed: Column) -> list[Column]:
    """The input's columns out of a packed table, in order; ``changed`` ones by their new expression."""
    found = {"text": F.col("text"), **changed}
    return [found[c].alias(c) if c in found else field(F.col("row"), c) for c in columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least KEEP_SCORE; learned without the held-out labels.

    In every stage but the last all columns of the input are returned with their values, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out())
    scored = quality.score(_packed(docs), quality.fit(docs, labels), carry=("text", "row"))
    return scored.where(F.col("score") >= KEEP_SCORE).select(*_unpacked(docs.columns))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that their owner keeps; a document that loses every line stays with an empty text.

    ``n_chars`` becomes the new text's.
    """
    kept = line_dedup.apply_bitmaps(_packed(docs), line_dedup.keep_bitmaps(docs))
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*_unpacked(docs.columns, n_chars=n_chars))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each SimHash component, once; null ids count last."""
    kept = simhash.near_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    chosen = _packed(docs).join(kept, same, "left_semi")
    return chosen.dropDuplicates(["doc_id", "text_key"]).select(*_unpacked(docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; rows that share the id of a leaking one but not its text stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _packed(docs)
    leaking = decontaminate.benchmark_leaks(keyed, benchmark, carry=("text_key",)).select(
        F.col("doc_id").alias("leaking_id"), F.col("text_key").alias("leaking_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("leaking_id")) & (F.col("text_key") == F.col("leaking_key"))
    return keyed.join(leaking, same, "left_anti").select(*_unpacked(docs.columns))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with ``MIX_COLUMNS``, which replace columns of the input named so; the rest go."""
    keyed = _packed(docs)
    mixed = mixing.mix(keyed, carry=("text_key",))
    # Rows that repeat id and text pair up one to one.
    nth = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("source"))
    left = keyed.withColumn("nth", nth)
    right = mixed.withColumn("nth", nth).where("taken > 0").select(
        F.col("doc_id").alias("mix_id"), F.col("text_key").alias("mix_key"), F.col("nth").alias("mix_nth"), *MIX_COLUMNS)
    same = (F.col("doc_id").eqNullSafe(F.col("mix_id")) & (F.col("text_key") == F.col("mix_key"))
            & (F.col("nth") == F.col("mix_nth")))
    return left.join(right, same).select(*_unpacked([c for c in docs.columns if c not in MIX_COLUMNS]), *MIX_COLUMNS)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_common_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
