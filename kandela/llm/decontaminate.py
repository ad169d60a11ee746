"""Benchmark leaks: a BM25 index of test items that every training passage queries, with block-max WAND.

Items are cut into segments of at most ``STRIDE`` words; a segment's BM25 weights are divided by its score
against itself, so a passage that holds all of it scores 1. Passages are windows of ``2 * STRIDE`` words every
``STRIDE`` words, so any run of ``STRIDE`` words lies whole in one. Every passage queries the index and
all segments at ``threshold`` or more are retrieved; an item is a leak if the document then holds
enough of its five-word shingles, in its question as well as in its answer.

Postings are in segment order, in blocks with their largest weight, and WAND moves through them with pivots.
Before that a whole batch of passages is bounded at once: rare terms are added up per passage
and segment, frequent terms by their presence. A passage whose bound stays below the threshold for every segment
could not retrieve anything and is not queried one by one; nothing else is skipped.

Each different item text is indexed once and its leaks are joined back to the ids of all items that hold it. The index is
broadcast in shards of at most ``shard_bytes`` of text, however large the benchmark is and however often an item repeats;
hash buckets of about 1/``BUCKETS_PER_SHARD`` of that are packed into shards, so only a bucket with a longer text is larger.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kandela.llm.text import or_empty
from kandela.session import materialise

STRIDE = 64
THRESHOLD = 0.5
SHINGLE = 5
OVERLAP = 0.8
PART_OVERLAP = 0.5
SHARD_BYTES = 8 << 20
BUCKETS_PER_SHARD = 64
K1, B = 1.2, 0.75
POSTINGS_PER_BLOCK = 64
SEGMENTS_PER_MATRIX = 1024
STRIDES_PER_MATRIX = 1024
FREQUENT_SHARE = 0.4
BYTES_PER_CUT = 1 << 20

# ASCII letters lower-cased, digits and non-ASCII bytes kept, the rest separates words.
_CLEAN = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


class Index:
    """Inverted index of segments with self-normalised BM25 weights, and the bounds for batches of passages."""

    def __init__(self, items: list[tuple], frequency: dict[bytes, int], segments: int, mean_length: float):
        self.items = items  # (item_id, question words, answer words)
        self.segment_item, found = [], []
        for at, (_, question, answer) in enumerate(items):
            for segment in segment_words(question + answer):
                self.segment_item.append(at)
                found.append(Counter(segment))
        self.terms: dict[bytes, int] = {}
        self.postings: list[tuple[list[int], list[float]]] = []
        for at, counts in enumerate(found):
            length = sum(counts.values())
            weights = {t: math.log(1 + (segments - frequency[t] + 0.5) / (frequency[t] + 0.5)) * n * (K1 + 1)
                       / (n + K1 * (1 - B + B * length / mean_length)) for t, n in counts.items()}
            own = sum(weights.values())
            for term, weight in weights.items():
                number = self.terms.setdefault(term, len(self.terms))
                if number == len(self.postings):
                    self.postings.append(([], []))
                self.postings[number][0].append(at)
                self.postings[number][1].append(weight / own)
        self.largest = [max(w) for _, w in self.postings]
        self.block_largest = [[max(w[i:i + POSTINGS_PER_BLOCK]) for i in range(0, len(w), POSTINGS_PER_BLOCK)]
                              for _, w in self.postings]
        self.bounds = [_Bounds(self, low, min(low + SEGMENTS_PER_MATRIX, len(found)))
                       for low in range(0, len(found), SEGMENTS_PER_MATRIX)]

    def numbers(self, text: bytes) -> np.ndarray:
        """Term numbers of a text's words, -1 for terms of no item; long texts go piece by piece."""
        text, at, out = text.translate(_CLEAN), 0, []
        while at < len(text):
            end = at + BYTES_PER_CUT
            end = len(text) if end >= len(text) or (end := text.find(b" ", end)) < 0 else end
            part = text[at:end].split()
            out.append(np.fromiter(map(self.terms.get, part, [-1] * len(part)), dtype=np.int32, count=len(part)))
            at = end
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def retrieve(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (segment, score) with a score of at least ``threshold`` for a set of terms, by block-max WAND."""
        done = len(self.segment_item)
        lists = [self.postings[t] for t in terms]
        at = [0] * len(terms)
        here = [ids[0] for ids, _ in lists]
        order = sorted(range(len(terms)), key=here.__getitem__)
        found = []

        def move(c: int, to: int) -> None:
            ids = lists[c][0]
            at[c] = bisect.bisect_left(ids, to, at[c])
            here[c] = ids[at[c]] if at[c] < len(ids) else done

        while True:
            order.sort(key=here.__getitem__)
            bound, pivot = 0.0, -1
            for k, c in enumerate(order):
                if here[c] == done:
                    break
                bound += self.largest[terms[c]]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return found
            segment = here[order[pivot]]
            while pivot + 1 < len(order) and here[order[pivot + 1]] == segment:
                pivot += 1
            block_bound, next_block = 0.0, done
            for c in order[:pivot + 1]:
                ids = lists[c][0]
                place = bisect.bisect_left(ids, segment, at[c])
                if place < len(ids):
                    block = place // POSTINGS_PER_BLOCK
                    block_bound += self.block_largest[terms[c]][block]
                    next_block = min(next_block, ids[min((block + 1) * POSTINGS_PER_BLOCK, len(ids)) - 1] + 1)
            if block_bound < threshold:
                beyond = here[order[pivot + 1]] if pivot + 1 < len(order) else done
                for c in order[:pivot + 1]:
                    move(c, max(segment + 1, min(next_block, beyond)))
            elif here[order[0]] == segment:
                score = sum(lists[c][1][at[c]] for c in order[:pivot + 1])
                if score >= threshold:
                    found.append((segment, score))
                for c in order[:pivot + 1]:
                    move(c, segment + 1)
            else:
                for c in order[:pivot + 1]:
                    if here[c] < segment:
                        move(c, segment)

    def passages_to_query(self, strides: np.ndarray, terms: np.ndarray, count: int, threshold: float) -> np.ndarray:
        """Strides whose passage (with the next stride) may reach the threshold for some segment."""
        chosen = np.zeros(count, bool)
        for bounds in self.bounds:
            chosen |= bounds.may_reach(strides, terms, count, threshold)
        return np.flatnonzero(chosen)


class _Bounds:
    """Upper bounds of passage scores for the segments low..high."""

    def __init__(self, index: Index, low: int, high: int):
        self.width = high - low
        rows = []
        for ids, weights in index.postings:
            a, b = bisect.bisect_left(ids, low), bisect.bisect_left(ids, high)
            rows.append((np.array(ids[a:b], np.int64) - low, np.array(weights[a:b])))
        self.frequent_sum = np.zeros(self.width)
        frequent = []
        for term in sorted(range(len(rows)), key=lambda t: -len(rows[t][0])):
            ids, weights = rows[term]
            if not len(ids) or (self.frequent_sum[ids] + weights).max() > FREQUENT_SHARE:
                break
            self.frequent_sum[ids] += weights
            frequent.append(term)
        self.column = np.full(len(rows), -1)
        self.column[frequent] = np.arange(len(frequent))
        self.frequent_weights = np.zeros((len(frequent), self.width))
        for at, term in enumerate(frequent):
            self.frequent_weights[at, rows[term][0]] = rows[term][1]
            rows[term] = (np.empty(0, np.int64), np.empty(0))
        self.first = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in rows])])
        self.ids = np.concatenate([ids for ids, _ in rows])
        self.weights = np.concatenate([weights for _, weights in rows])

    def may_reach(self, strides: np.ndarray, terms: np.ndarray, count: int, threshold: float) -> np.ndarray:
        reach = np.zeros(count, bool)
        limit = threshold - 1e-9
        for low in range(0, count, STRIDES_PER_MATRIX):
            high = min(low + STRIDES_PER_MATRIX, count)
            a, b = np.searchsorted(strides, [low, high + 1])
            term, row = terms[a:b], strides[a:b] - low
            n = self.first[term + 1] - self.first[term]
            place = np.repeat(self.first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            cells = np.bincount(np.repeat(row, n) * self.width + self.ids[place], self.weights[place],
                                (high - low + 1) * self.width).reshape(-1, self.width)
            rare = cells[:-1] + cells[1:]
            near = np.flatnonzero((rare + self.frequent_sum >= limit).any(axis=1))
            if len(near) and len(self.frequent_weights):
                column = self.column[term]
                present = np.zeros((high - low + 1, len(self.frequent_weights)), bool)
                present[row[column >= 0], column[column >= 0]] = True
                sums = rare[near] + (present[near] | present[near + 1]) @ self.frequent_weights
                near = near[(sums >= limit).any(axis=1)]
            reach[low + near] = True
        return reach


def segment_words(text: list[bytes]) -> list[list[bytes]]:
    """Parts of nearly equal length, none longer than a stride."""
    parts = -(-len(text) // STRIDE)
    return [text[len(text) * i // parts:len(text) * (i + 1) // parts] for i in range(parts)]


def shingles(part: list[bytes]) -> list[bytes]:
    if not part:
        return []
    return [b" " + b" ".join(part[i:i + SHINGLE]) + b" " for i in range(max(1, len(part) - SHINGLE + 1))]


def leaks_of(index: Index, text: bytes, numbers: np.ndarray, passages: list[int], threshold: float) -> list[tuple]:
    """(item number, score, overlap, question overlap, answer overlap) of the items a document leaks."""
    best: dict[int, float] = {}
    for stride in passages:
        terms = np.unique(numbers[stride * STRIDE:(stride + 2) * STRIDE])
        for segment, score in index.retrieve([t for t in terms.tolist() if t >= 0], threshold - 1e-9):
            item = index.segment_item[segment]
            best[item] = max(score, best.get(item, 0.0))
    if not best:
        return []
    flat, out = b" " + b" ".join(words(text)) + b" ", []
    for item, score in best.items():
        _, question, answer = index.items[item]
        share = lambda part: sum(s in flat for s in part) / len(part) if part else 1.0
        whole, asked, answered = share(shingles(question + answer)), share(shingles(question)), share(shingles(answer))
        if whole >= OVERLAP and min(asked, answered) >= PART_OVERLAP:
            out.append((item, score, whole, asked, answered))
    return out


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, shard_bytes: int = SHARD_BYTES,
                    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
                    question_column: str = "text", answer_column: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, item_id, bm25, overlap, question_overlap, answer_overlap`` and ``carry``: one row per document row and leaked item.

    Without an answer column the first half of the item's words counts as question, the rest as answer.
    Null texts count as empty; items without words leak nowhere; repeated rows are reported each; ids may
    be null. Whole texts are searched, however long. An empty documents or benchmark table gives an empty result. Other
    columns are not read; carried ones named like a column of the result are left out.
    """
    carry = tuple(c for c in carry if c not in (id_column, item_column, "_item_key", "bm25", "overlap", "question_overlap", "answer_overlap"))
    answer = or_empty(F.col(answer_column)) if answer_column else F.lit(None).cast("string")
    items = benchmark.select(
        F.col(item_column).alias("item"), or_empty(F.col(question_column)).cast("binary").alias("question"),
        answer.cast("binary").alias("answer"))
    split = F.octet_length("question").cast("string").cast("binary")  # tells apart where the question ends
    items = materialise(items.withColumn("key", F.sha2(F.concat(
        split, F.lit(b" "), "question", F.coalesce("answer", F.lit(b""))), 256)), "items")
    size = F.octet_length("question") + F.coalesce(F.octet_length("answer"), F.lit(0)) + 64
    texts = items.select("key", "question", "answer", size.cast("long").alias("size")).dropDuplicates(["key"])
    total = texts.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / shard_bytes)) * BUCKETS_PER_SHARD
    texts = materialise(texts.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))), "texts")
    held = {r["bucket"]: r["held"] for r in texts.groupBy("bucket").agg(F.sum("size").alias("held")).collect()}
    terms = items.mapInArrow(_segment_terms, "term binary, length long").groupBy("term").agg(
        F.count("*").alias("df"), F.sum("length").alias("length"))
    terms = materialise(terms, "terms")
    whole = {r["term"]: r for r in terms.where(F.octet_length("term") == 0).collect()}.get(b"")
    segments, length = (whole["df"], whole["length"]) if whole else (0, 0)
    found = []
    shards = pack(held, shard_bytes)
    for low, high in shards:
        part = texts.where(F.col("bucket").between(low, high)).select(F.col("key").alias("item"), "question", "answer")
        rows = [item_parts(r) for r in part.collect()]  # at most shard_bytes, or one bucket with a longer text
        rows = [r for r in rows if r[1] or r[2]]
        if not rows:
            continue
        seen = {t for _, q, a in rows for t in q + a}
        frequency = _frequencies(terms, seen)
        index = Index(rows, frequency, segments, length / segments)
        found.append(_search(docs, index, threshold, id_column, text_column, carry))
        if len(shards) > 1:
            found[-1] = materialise(found[-1], "leaks")
    if not found:
        found = [_search(docs, Index([], {}, 0, 1.0), threshold, id_column, text_column, carry)]
    for more in found[1:]:
        found[0] = found[0].unionByName(more)
    ids = items.select(F.col("key").alias("_item_key"), F.col("item").alias(item_column))
    return found[0].join(ids, "_item_key").select(
        id_column, item_column, "bm25", "overlap", "question_overlap", "answer_overlap", *carry)


def pack(held: dict[int, int], most: int) -> list[tuple[int, int]]:
    """Runs of buckets (first, last) that hold at most ``most`` together; a bucket above that is a run of its own."""
    runs, room = [], 0
    for bucket in sorted(held):
        if runs and held[bucket] <= room:
            runs[-1] = (runs[-1][0], bucket)
            room -= held[bucket]
        else:
            runs.append((bucket, bucket))
            room = most - held[bucket]
    return runs


def item_parts(row) -> tuple[object, list[bytes], list[bytes]]:
    question = words(bytes(row["question"]))
    if row["answer"] is not None:
        return row["item"], question, words(bytes(row["answer"]))
    half = (len(question) + 1) // 2
    return row["item"], question[:half], question[half:]


def _segment_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment's different terms, and one row with an empty term that stands for the segment itself."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            _, question, answer = item_parts(row)
            for segment in segment_words(question + answer):
                rows += [(t, 0) for t in set(segment)] + [(b"", len(segment))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], names=["term", "length"])


def _frequencies(terms: DataFrame, seen: set[bytes]) -> dict[bytes, int]:
    """Document frequencies over the whole benchmark of the terms of one shard."""
    wanted = terms.sparkSession.createDataFrame([(bytearray(t),) for t in seen], "term binary")
    return {bytes(r["term"]): r["df"] for r in terms.join(wanted, "term").select("term", "df").collect()}


def _search(docs: DataFrame, index: Index, threshold: float, id_column: str, text_column: str,
            carry: tuple[str, ...]) -> DataFrame:
    """Leaks by ``_item_key``, the key of an indexed text."""
    held = docs.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("_item_key", T.StringType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("bm25", "overlap", "question_overlap", "answer_overlap")],
                           *[docs.schema[c] for c in carry]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, rows = held.value, []
        for batch in batches:
            ids, texts, carried = batch.column(0), batch.columns[-1], batch.columns[1:-1]
            for low in range(0, batch.num_rows, 256):
                part = [texts[i].as_py() for i in range(low, min(low + 256, batch.num_rows))]
                for k, found in _batch_leaks(index, part, threshold):
                    item, *figures = found
                    rows.append([ids[low + k].as_py(), index.items[item][0], *figures, *[c[low + k].as_py() for c in carried]])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [ids.type, pa.string(), *[pa.float64()] * 4, *[c.type for c in carried]])], names=schema.names)
                rows = []

    return docs.select(id_column, *carry, or_empty(F.col(text_column)).cast("binary").alias("raw")).mapInArrow(run, schema)


def _batch_leaks(index: Index, texts: list[bytes], threshold: float) -> Iterator[tuple[int, tuple]]:
    numbers = [index.numbers(t) for t in texts]
    lengths = np.array([len(n) for n in numbers])
    spans = -(-lengths // STRIDE) + 1  # one empty stride after each document keeps passages apart
    ends = np.cumsum(spans)
    flat = np.concatenate(numbers)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    strides = np.repeat(ends - spans, lengths) + within // STRIDE
    known = flat >= 0
    if not known.any():
        return
    chosen = index.passages_to_query(strides[known], flat[known], int(ends[-1]), threshold)
    owner = np.searchsorted(ends, chosen, side="right")
    for k in np.unique(owner).tolist():
        first = int(ends[k] - spans[k])
        passages = [s - first for s in chosen[owner == k].tolist() if s - first < spans[k] - 1]
        for found in leaks_of(index, texts[k], numbers[k], passages, threshold):
            yield k, found
