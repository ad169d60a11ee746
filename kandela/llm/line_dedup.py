"""Lines that many documents share, as compressed keep bitmaps per document; built-in functions only.

Line keys are hashed to 128 bits. The hashes, never the text, are range-partitioned by (hash, document)
and sorted by position inside; a hash that a third of all documents hold is cut between documents, so it
spreads over as many tasks as it needs. The sorted stream marks the first occurrence of a hash in each
document; one row per hash and task then counts its documents and finds its owner, the largest id.
Occurrences outside the owner become a run-length-coded keep bitmap per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kandela.llm.text import BLANKS, ascii_lower, field, or_empty, row_of
from kandela.session import materialise

MIN_CHARS = 40
MIN_DOCS = 5


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``id, text_key, n_lines, n_dropped, keep_runs`` of every document that loses lines; no text.

    ``keep_runs`` is the keep bitmap as runs of ones: array<struct<start, length>>, line numbers from 0.
    ``text_key`` tells rows of one id with different texts apart; documents are counted by id, and a
    null id is a document of its own that owns a line only if nobody else has it. Texts are split at line feeds,
    a null or empty text is one empty line, other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), or_empty(F.col(text_column)).alias("text"))
    split = texts.select("id", F.xxhash64("text").alias("text_key"),
                         F.split(ascii_lower(F.col("text")), "\n", -1).alias("lines"))
    lines = split.select("id", "text_key", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keys = lines.withColumn("key", F.btrim("line", F.lit(BLANKS))).where(F.char_length("key") >= min_chars)
    hashed = materialise(keys.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "id", "text_key", "n_lines", "pos"), "line-hashes")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = hashed.select("h1", "h2", "id", "pos").repartitionByRange(parts, "h1", "h2", F.desc("id"))
    stream = ranged.withColumn("first", F.row_number().over(Window.partitionBy("h1", "h2", "id").orderBy("pos")) == 1)
    owners = (stream.where("first").groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("owner"))
              .where(F.col("n_docs") >= min_docs).drop("n_docs"))
    owners = materialise(owners, "line-owners")  # stored, so that the join can split a hot line
    dropped = hashed.join(owners, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("owner")))
    gathered = dropped.groupBy("id", "text_key").agg(
        F.max("n_lines").alias("n_lines"), F.array_sort(F.collect_set("pos")).alias("gone"))
    runs = F.filter(F.zip_with(
        F.concat(F.array(F.lit(-1)), "gone"), F.concat("gone", F.array("n_lines")),
        lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length"))), lambda run: run["length"] > 0)
    return gathered.select(F.col("id").alias(id_column), "text_key", "n_lines", F.size("gone").alias("n_dropped"),
                           runs.alias("keep_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the kept lines as text and the two counts; columns already named so are replaced, all others kept.

    One row per input row. A document without a bitmap keeps its text unchanged (null becomes empty);
    one that loses every line keeps an empty text.
    """
    columns = [c for c in docs.columns if c not in (n_lines, n_dropped)]
    left = docs.select(F.col(id_column).alias("id"), or_empty(F.col(text_column)).alias("text"),
                       row_of([c for c in columns if c != text_column]).alias("row"))
    left = left.withColumn("key", F.xxhash64("text"))
    maps = bitmaps.select(F.col(id_column).alias("of"), F.col("text_key").alias("of_key"), F.col("n_lines").alias("all"),
                          F.col("n_dropped").alias("gone"), F.col("keep_runs").alias("runs"))
    joined = left.join(maps, F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
    text = F.when(F.col("runs").isNull(), F.col("text")).otherwise(kept).alias(text_column)
    return joined.select(*[text if c == text_column else field(F.col("row"), c) for c in columns],
                         F.coalesce("all", F.size(lines)).cast("long").alias(n_lines),
                         F.coalesce("gone", F.lit(0)).cast("long").alias(n_dropped))
