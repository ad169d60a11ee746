"""Secret scans over an incremental ledger of content-addressed texts.

Every version of every path is named by the SHA-256 of its text (its blob). The ledger is a table of
(blob, rule, rule version, spans) in a folder, laid out by the first digits of the blob; a scan reads only the parts that can
hold its blobs, looks up which rule versions each blob still lacks, runs
only those, once per blob, appends what it found (also that nothing was found) and joins the findings back to all
paths and versions that hold the blob. A changed rule has another version and only it runs again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from kandela.llm.text import or_empty
from kandela.session import materialise

LEDGER = "blob string, rule string, version string, spans array<struct<start: int, end: int>>"
PREFIX_DIGITS = 2  # of the blob, one folder each: 256 in a ledger
TEXTS_PER_CALL = 64
REMEMBERED = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; those whose ``group`` is shorter than ``least`` are dropped."""

    name: str
    pattern: str
    least: int
    group: int = 0

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.pattern}\n{self.least}\n{self.group}".encode()).hexdigest()[:16]

    def spans(self, text: str) -> list[tuple[int, int]]:
        found, group, least = [], self.group, self.least
        for m in re.finditer(self.pattern, text):
            start, end = m.span(group)
            if end - start >= least:
                found.append(m.span())
        return found


# Fixed values of the contract. Runs of hex digits and key ids are maximal, so their least length stands in the pattern.
RULES = (
    Rule("assign", r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path_columns: tuple[str, ...] = ("doc_id",),
         text_column: str = "text") -> DataFrame:
    """``path_columns, blob, findings``: one row per input row, repeated rows included.

    ``findings`` is array<struct<start, rule, end>> by start, then rule as listed; code points, end
    exclusive; empty without findings; texts are scanned whole, however long. ``ledger`` is a folder in shared storage, made when it is not there, that
    this scan extends. A null text counts as empty, null paths stay, other columns are not read. An empty
    table gives an empty result and adds nothing.
    """
    spark = versions.sparkSession
    prefixes = update_ledger(versions, ledger, rules, text_column)
    known = read_ledger(spark, ledger, prefixes)
    listed = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.name}:{r.version}", i)])
    order = listed[F.concat_ws(":", "rule", "version")]
    found = (known.withColumn("rank", order).where("rank IS NOT NULL AND size(spans) > 0")
             .dropDuplicates(["blob", "rule", "version"])
             .select("blob", "rule", "rank", F.explode("spans").alias("s")).groupBy("blob")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("s.start"), "rank", "rule", F.col("s.end")))).alias("f")))
    found = materialise(found, "findings")  # stored, so that the join can split a hot blob
    paths = versions.select(*path_columns, F.sha2(or_empty(F.col(text_column)), 256).alias("blob"))
    none = F.array().cast("array<struct<start: int, rule: string, end: int>>")
    clean = F.transform("f", lambda x: F.struct(x["start"].alias("start"), x["rule"].alias("rule"), x["end"].alias("end")))
    return paths.join(found, "blob", "left").select(*path_columns, "blob", F.coalesce(clean, none).alias("findings"))


def _exists(spark: SparkSession, ledger: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_ledger(spark: SparkSession, ledger: str, prefixes: list[str] | None = None) -> DataFrame:
    """The ledger's rows, those of blobs with the given first digits only; an empty table when nothing was written yet."""
    if not _exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(f"{LEDGER}, prefix string").parquet(ledger)
    return (rows if prefixes is None else rows.where(F.col("prefix").isin(prefixes))).drop("prefix")


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> list[str] | None:
    """Scans every blob for the rule versions the ledger lacks and appends the outcome.

    Gives the first digits of all blobs of a table that meets an existing ledger, at most 256 strings, else None. Copies leave
    each task once and meet at their blob's; texts are shuffled once and never sorted.
    """
    spark = versions.sparkSession
    text, wanted = or_empty(F.col(text_column)), F.array(*[F.lit(r.version) for r in rules])
    blob = F.sha2(text, 256)
    blobs = versions.select(blob.alias("blob"), text.cast("binary").alias("raw"))
    prefixes = None
    if _exists(spark, ledger):
        prefixes = sorted(r[0] for r in versions.select(F.substring(blob, 1, PREFIX_DIGITS)).distinct().collect())
        held = read_ledger(spark, ledger, prefixes).groupBy("blob").agg(F.collect_set("version").alias("held"))
        blobs = blobs.join(materialise(held, "ledger-keys"), "blob", "left").withColumn(
            "lacks", F.array_except(wanted, F.coalesce("held", F.array().cast("array<string>")))).drop("held")
    else:
        blobs = blobs.withColumn("lacks", wanted)
    columns = "blob string, raw binary, lacks array<string>"
    once = blobs.where(F.size("lacks") > 0).mapInArrow(_first_ones(REMEMBERED), columns).repartition("blob").mapInArrow(_first_ones(None), columns)
    found = once.mapInArrow(_scanner(rules), LEDGER).withColumn("prefix", F.substring("blob", 1, PREFIX_DIGITS))
    found.repartition("prefix").write.mode("append").partitionBy("prefix").parquet(ledger)
    return prefixes


def _first_ones(remembered: int | None):
    """Rows whose blob has not passed before, a few at a time; at most ``remembered`` digests are kept if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_PER_CALL):
                batch = whole.slice(at, TEXTS_PER_CALL)
                digests = [bytes.fromhex(blob) for blob in batch.column("blob").to_pylist()]
                fresh = [digest not in seen and not seen.add(digest) for digest in digests]
                if any(fresh):
                    yield batch.filter(pa.array(fresh))
            if remembered is not None and len(seen) > remembered:
                seen.clear()

    return run


def _scanner(rules: tuple[Rule, ...]):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("blob", pa.string()), ("rule", pa.string()), ("version", pa.string()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_PER_CALL):
                batch, rows = whole.slice(at, TEXTS_PER_CALL), []
                for blob, raw, lacks in zip(batch.column("blob"), batch.column("raw"), batch.column("lacks")):
                    text, wanted = raw.as_py().decode("utf-8", "replace"), set(lacks.as_py())
                    rows += [{"blob": blob.as_py(), "rule": r.name, "version": r.version,
                              "spans": [{"start": a, "end": b} for a, b in r.spans(text)]} for r in rules if r.version in wanted]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run
