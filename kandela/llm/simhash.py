"""Near duplicates by SimHash, found with covering locality-sensitive hashing.

For radius r every bit position gets a vector of r + 1 bits; mask v keeps the positions whose vector has
an odd product with v. The r + 1 bit vectors v other than zero give 2^(r+1) - 1 masks. Up to r differing positions have
vectors that span at most r dimensions, so some v is orthogonal to all of them, and under that mask the
two fingerprints are equal: every pair within the radius collides in some table. The position vectors run
through the non-zero ones in turn, so each mask keeps about 4 of 7 bits for r = 2.

Inside a bucket no pairs are listed. Two members differ only in bits the mask leaves out; they are
within two bits exactly if flipping at most one such bit in each gives the same value. Members therefore
meet at their one-bit variants; a variant has at most 65 neighbours, so its links are a small star. A
bucket of thousands spreads over its variants. Equal fingerprints are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from kandela.llm.graph import components
from kandela.llm.text import or_empty
from kandela.session import materialise

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
HASHES_PER_STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the UTF-8 text, as a signed number; a text without words has 0."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and exactly space and 0x09-0x0D
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest, seeds = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((digest(s, seeds) for s in shingles), dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), HASHES_PER_STEP):
        part = hashes[at:at + HASHES_PER_STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, text_key, fp`` of every row: the text's own hash and its SimHash, a signed 64-bit number."""
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType),
                           T.StructField("text_key", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle) for x in batch.column("raw")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), batch.column("text_key"), pa.array(found, pa.int64())], names=schema.names)

    text = or_empty(F.col(text_column))
    return docs.select(id_column, F.xxhash64(text).alias("text_key"), text.cast("binary").alias("raw")).mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS) -> list[int]:
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links between different fingerprints (column fp, distinct) that connect all within ``radius`` bits.

    Not all pairs: members of a variant are tied to its smallest. Radius 0 gives none, 1 and 2 are covered.
    """
    if radius not in (0, 1, 2):
        raise ValueError("radius must be 0, 1 or 2: half-way variants flip at most one bit")
    if radius == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    masks = [signed(m) for m in covering_masks(radius)]
    tables = F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("bucket")) for t, m in enumerate(masks)]))
    placed = prints.select("fp", tables.alias("x")).select("fp", "x.t", "x.bucket")
    shared = (placed.groupBy("t", "bucket").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
              .where("low <> high").select("t", "bucket"))
    members = placed.join(materialise(shared, "buckets"), ["t", "bucket"])
    return _stars(members, masks, radius)


def _flips(masks: list[int], table: Column) -> Column:
    """For each table: no flip, and each single bit that its mask leaves out."""
    free = [[0] + [signed(1 << i) for i in range(BITS) if not (m >> i) & 1] for m in masks]
    return F.element_at(F.array(*[F.array(*map(F.lit, bits)) for bits in free]), table + 1)


def _stars(members: DataFrame, masks: list[int], radius: int) -> DataFrame:
    met = members.select("t", "fp", F.explode(_flips(masks, F.col("t"))).alias("flip")).select(
        "t", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"), "fp")
    groups = met.groupBy("t", "variant").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    # At most 65 members; with radius 1 only those one bit apart, one of which is the variant itself.
    hub = F.array_min("fps") if radius == 2 else F.col("variant")
    ties = groups.where(F.lit(True) if radius == 2 else F.array_contains("fps", F.col("variant"))).select(
        hub.alias("b"), F.explode("fps").alias("a"))
    return ties.where("a <> b").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``id, text_key, fingerprint, component_id, kept``: one row per input row, repeated rows included.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id reachable
    (null ids count last; null if there is no other). ``kept`` marks one text of each component, that of its
    smallest id; rows that repeat both its id and text are marked too. Null, empty and blank texts have fingerprint zero
    and link like any other. Other columns are not read. An empty table gives an empty result.
    """
    marked = materialise(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    row = F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), "text_key")
    nodes = materialise(marked.groupBy("fp").agg(F.min(row).alias("first")), "nodes")
    linked = components(links(nodes.select("fp"), radius))
    joined = nodes.join(linked, nodes["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    placed = materialise(joined, "placed")
    smallest = placed.groupBy("component").agg(F.min("first").alias("owner"))
    of_print = materialise(placed.join(smallest, "component").select("fp", "owner"), "owners")
    return marked.join(of_print, "fp").select(
        id_column, "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("owner.id").alias("component_id"), row.eqNullSafe(F.col("owner")).alias("kept"))
