"""Exact duplicates by compressed radix (Patricia) tries over whole byte strings.

Every task first inserts its own rows into a trie, so a text that holds a third of all rows leaves each
task once. What is left is partitioned by length and content hash, and a second trie per partition meets
the copies of all tasks. A terminal node stores the owner (smallest or largest id) and the number of
rows. When a trie holds more than ``spill_bytes`` of labels, its heaviest subtree is spilled: its
terminals leave as partial rows and its memory is freed. Partial rows of a text merge later, since owner and
count are associative. Members then find their owner by a many-to-one join on length and digest,
which adaptive execution can split however hot a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kandela.session import materialise

SPILL_BYTES = 48 << 20
ROWS_PER_BATCH = 512


class Node:
    __slots__ = ("label", "children", "count", "owner")

    def __init__(self, label: bytes):
        self.label, self.children, self.count, self.owner = label, {}, 0, None


class Trie:
    """Compressed radix trie of byte strings; terminals hold (owner, count)."""

    def __init__(self, largest: bool):
        self.root, self.largest, self.held = Node(b""), largest, {}

    @property
    def size(self) -> int:
        return sum(self.held.values())

    def insert(self, key: bytes, owner, count: int) -> None:
        node, at, end = self.root, 0, len(key)
        while at < end:
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.held[key[0]] = self.held.get(key[0], 0) + end - at + 200
                node = child
                break
            if not key.startswith(child.label, at):
                shared = common(child.label, key, at)
                middle = Node(child.label[:shared])
                child.label = child.label[shared:]
                middle.children[child.label[0]] = child
                node.children[key[at]] = child = middle
            node, at = child, at + len(child.label)
        if not node.count or node.owner is None:
            node.owner = owner
        elif owner is not None:
            node.owner = max(node.owner, owner) if self.largest else min(node.owner, owner)
        node.count += count

    def spill(self) -> Iterator[tuple]:
        """Removes the heaviest subtree below the root and gives its terminals."""
        first = max(self.held, key=self.held.get)
        del self.held[first]
        yield from terminals(self.root.children.pop(first))

    def drain(self) -> Iterator[tuple]:
        root, self.root, self.held = self.root, Node(b""), {}
        yield from terminals(root)


def common(label: bytes, key: bytes, at: int) -> int:
    """Length of the longest common prefix of label and key[at:], by bisection over equal slices."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == key[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def terminals(node: Node) -> Iterator[tuple]:
    stack = [(node, node.label)]
    while stack:
        node, path = stack.pop()
        if node.count:
            yield path, node.owner, node.count
        stack += [(child, path + child.label) for child in node.children.values()]


def exact_duplicates(docs: DataFrame, prefer: str = "smallest", spill_bytes: int = SPILL_BYTES,
                     id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256``: one row per input row, dropped ones too.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty. ``prefer`` names which id
    stays ("smallest" or "largest"). Rows that repeat the kept id with the same text are all marked
    kept and all counted. A null id is only kept when its whole group has none. Other columns
    are not read. An empty table gives an empty result.
    """
    if prefer not in ("smallest", "largest"):
        raise ValueError("prefer is 'smallest' or 'largest'")
    largest, kind = prefer == "largest", docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).alias("owner"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    raw = F.col("text").cast("binary").alias("raw")
    partial = _through_tries(rows.select(raw, "owner", F.lit(1).cast("long").alias("n")), largest, spill_bytes, True, kind)
    dealt = partial.repartition(F.col("n_bytes"), F.xxhash64("raw"))
    merged = _through_tries(dealt.select("raw", "owner", "n"), largest, spill_bytes, False, kind)
    # Stored, so that the join below shuffles both of its sides itself and can split a hot text.
    owners = materialise(merged.groupBy("n_bytes", "text_sha256").agg(
        (F.max if largest else F.min)("owner").alias("keep_id"), F.sum("n").alias("group_size")), "owners")
    members = rows.select(F.col("owner").alias(id_column), F.octet_length("text").cast("long").alias("n_bytes"),
                          F.sha2("text", 256).alias("text_sha256"))
    return members.join(owners, ["n_bytes", "text_sha256"]).select(
        id_column, "keep_id", "group_size", F.col(id_column).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _through_tries(rows: DataFrame, largest: bool, spill_bytes: int, with_text: bool, kind: T.DataType) -> DataFrame:
    """One trie per task over (raw, owner, n); distinct texts leave as (n_bytes, owner, n, raw or text_sha256)."""
    text = T.StructField("raw", T.BinaryType()) if with_text else T.StructField("text_sha256", T.StringType())
    schema = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("owner", kind),
                           T.StructField("n", T.LongType()), text])

    def leave(found: Iterator[tuple], owner_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            keys, owners, counts = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(map(len, keys), pa.int64()), pa.array(owners, owner_type), pa.array(counts, pa.int64()),
                 pa.array(keys, pa.binary()) if with_text else
                 pa.array((hashlib.sha256(k).hexdigest() for k in keys), pa.string())], names=schema.names)

        for row in found:
            rows.append(row)
            held += len(row[0])
            if len(rows) >= ROWS_PER_BATCH or held > 4 << 20:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, owner_type = Trie(largest), None
        for batch in batches:
            owner_type = batch.column("owner").type
            owners, counts = batch.column("owner").to_pylist(), batch.column("n").to_pylist()
            for key, owner, count in zip(batch.column("raw"), owners, counts):
                trie.insert(key.as_py(), owner, count)
            while trie.held and trie.size > spill_bytes:
                yield from leave(trie.spill(), owner_type)
        if owner_type is not None:
            yield from leave(trie.drain(), owner_type)

    return rows.mapInArrow(run, schema)
