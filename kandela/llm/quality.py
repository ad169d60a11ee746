"""Quality scores from compressed sizes under two zstandard dictionaries.

One dictionary is trained on texts labelled good, one on texts labelled bad. A text is compressed block by
block with each; the difference of the two sizes by the text's bytes is its raw score: text that resembles the good
examples gets shorter under the good dictionary. A logistic curve, fitted on labelled texts that neither dictionary
has seen, turns it into a probability. Blocks make the score independent of a text's length, whole
texts are read, and nothing but the text enters a score.

The fit is on a bounded sample: per label and part (dictionary, calibration) the ``sample_rows`` labelled rows first in a
seeded order among those of at most ``sample_bytes``. Where most texts of a label and part are longer, the longer ones follow
by length while all together hold at most sample_rows * sample_bytes; if even the shortest is above that, it comes alone.
Without such a text that is at most 4 * sample_rows * sample_bytes on the driver.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from kandela.llm.text import or_empty
from kandela.session import materialise

DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 512
PSEUDO_BYTES = 200
LEVEL = 3
SAMPLE_ROWS = 1_500
SAMPLE_BYTES = 16_384
SEED = 29


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: float
    slope: float
    offset: float

    def scores(self, texts: list[bytes]) -> list[float]:
        raw = shrink(texts, differences(self.good, self.bad, texts), self.mean)
        return [probability(self.slope * x + self.offset) for x in raw]


def probability(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


@functools.lru_cache(maxsize=4)
def _compressor(dictionary: bytes):
    import zstandard

    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=loaded, write_content_size=False, write_dict_id=False)


def differences(good: bytes, bad: bytes, texts: list[bytes]) -> list[float]:
    """Size under the bad dictionary - size under the good one."""
    by_good, by_bad, out = _compressor(good).compress, _compressor(bad).compress, []
    for text in texts:
        blocks = (text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES))
        out.append(sum(len(by_bad(b)) - len(by_good(b)) for b in blocks))
    return out


def shrink(texts: list[bytes], found: list[float], mean: float) -> list[float]:
    return [(x + PSEUDO_BYTES * mean) / (len(t) + PSEUDO_BYTES) for t, x in zip(texts, found)]


def train_dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the raw texts themselves where there are too few to train on."""
    import zstandard

    blocks = [t[i:i + BLOCK_BYTES] for t in texts for i in range(0, len(t), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-size:]


def calibrate(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a ridge-regularised logistic curve, by Newton steps on the standardised score."""
    mean, scale = raw.mean(), raw.std() or 1.0
    z = np.stack([(raw - mean) / scale, np.ones(len(raw))], axis=1)
    w, ridge = np.zeros(2), np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (labels - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES,
        id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """Trains on the rows of ``labels`` (label 0 or 1; others and null ids are left out) that ``docs`` holds.

    With one label only, or none, every score is that label's share (0.5 without labels).
    """
    id_, text = F.col(id_column), or_empty(F.col(text_column))
    lengths = docs.groupBy(id_column).agg(F.min(F.octet_length(text)).alias("bytes"))  # of a repeated id the shortest text
    known = materialise(
        labels.where(id_.isNotNull() & F.col(label_column).isin(0, 1)).groupBy(id_column)
        .agg(F.max(label_column).alias("label")).join(lengths, id_column)
        .withColumn("turn", F.xxhash64(F.lit(SEED), id_)).withColumn("part", F.pmod(F.xxhash64(F.lit(SEED + 1), id_), F.lit(2))), "known")
    order = [F.greatest(F.col("bytes"), F.lit(sample_bytes)), F.col("turn")]
    short = F.col("bytes") <= sample_bytes
    counts = {(r["label"], r["part"]): (r["n"], r["short"]) for r in known.groupBy("label", "part").agg(
        F.count("*").alias("n"), F.count_if(short).alias("short")).collect()}  # at most four rows
    mostly_short = lambda n, short: 2 * short >= n
    first = functools.reduce(DataFrame.unionByName, [
        known.where((F.col("label") == label) & (F.col("part") == part))
        .where(short if mostly_short(*counts.get((label, part), (0, 0))) else F.lit(True)).orderBy(*order).limit(sample_rows)
        for label in (0, 1) for part in (0, 1)])
    before = F.sum(F.col("bytes").cast("long")).over(
        Window.partitionBy("label", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))  # sample_rows rows each
    chosen = first.withColumn("before", before).where(
        F.col("before").isNull() | (F.col("before") + F.col("bytes") <= sample_rows * sample_bytes)).drop("before")
    rows = (docs.select(id_column, text.cast("binary").alias("raw"))
            .join(F.broadcast(chosen), id_column)  # at most 4 * sample_rows small rows
            .where(F.octet_length("raw") == F.col("bytes"))
            .dropDuplicates([id_column]).orderBy("part", "turn").collect())
    share = {0: [], 1: []}
    for r in rows:
        share[r["label"]].append((r["part"], bytes(r["raw"])))
    if not share[0] or not share[1]:
        n = len(share[0]) + len(share[1])
        p = min(max(len(share[1]) / n, 1e-3), 1 - 1e-3) if n else 0.5
        return Model(b"", b"", 0.0, 0.0, math.log(p / (1 - p)))
    part_of = lambda label, part: [t for p, t in share[label] if p == part] or [t for _, t in share[label]]
    good, bad = train_dictionary(part_of(1, 0)), train_dictionary(part_of(0, 0))
    seen = [(t, label) for label in (0, 1) for t in part_of(label, 1)]
    texts, truth = [t for t, _ in seen], np.array([label for _, label in seen], float)
    found = differences(good, bad, texts)
    # The sample holds as many rows of either label as it can; the mean and the offset go by the labels' real shares.
    prior = {label: sum(n for (of, _), (n, _) in counts.items() if of == label) for label in (0, 1)}
    by_byte = np.array([x / max(len(t), 1) for t, x in zip(texts, found)])
    mean = sum(prior[label] * by_byte[truth == label].mean() for label in (0, 1)) / sum(prior.values())
    slope, offset = calibrate(np.array(shrink(texts, found, mean)), truth)
    odds = math.log(prior[1] / prior[0]) - math.log(truth.sum() / (1 - truth).sum())
    return Model(good, bad, float(mean), slope, offset + odds)


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The columns ``carry`` of every row and its ``score``, in one pass without a shuffle.

    One row per input row; null texts count as empty; a carried column named score is replaced. An empty table
    gives an empty result.
    """
    carry = [c for c in carry if c != "score"]
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("score", T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most DICTIONARY_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = held.value.scores([x.as_py() for x in batch.column(len(carry))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=schema.names)

    return docs.select(*carry, or_empty(F.col(text_column)).cast("binary").alias("_raw")).mapInArrow(run, schema)


def held_out(id_column: str = "doc_id"):
    """True for the rows kept from training: crc32 of the id as text leaves 2 by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 4 == 2
