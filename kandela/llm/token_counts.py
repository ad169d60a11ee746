"""Token counts of whole texts; huge texts are encoded in overlapping pieces and spliced.

A text of at most ``whole_chars`` is encoded in one go, or, where the tokenizer's own definition shows that no token
crosses a blank, as the sum over its words, each different word encoded once per worker. A longer text is cut into pieces of ``piece_chars`` that overlap,
the pieces are dealt over the cluster, and each is encoded with offsets. Two neighbours are spliced at
a position that both encodings prove to be a common boundary:

* a pre-token starts there in both (a pre-tokenizer scans from left to right and keeps no state but
  its position, so from such a start on both encodings go on alike);
* the next ``WITNESS`` tokens have the same ids and places in both;
* normalisation cannot join or reorder characters across it;
* it lies ``MARGIN`` characters inside either piece, so that no cut special token, contraction or
  look-ahead reaches it.

With ``c(i, p)`` for the tokens of piece ``i`` before position ``p``, a text has
``sum(c(i, p_i) - c(i + 1, p_i))`` over its splices plus all tokens of its last piece. Texts with a pair
of neighbours that has no such boundary go to the next round with a wider overlap, until the
neighbours align or the text is one piece.
"""

from __future__ import annotations

import bisect
import functools
import json
import os
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kandela.session import materialise

WHOLE_CHARS = 32_768
PIECE_CHARS = 8_192
OVERLAP_CHARS = 512
MARGIN = 64
WITNESS = 4
WIDEN = 4
TEXTS_PER_CALL = 128
MEMO_WORDS = 400_000

# Fixed value: a pre-tokenizer pattern none of whose alternatives can hold a blank.
BLANK_FREE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

PIECES = "key string, piece int, n_pieces int, start long, text binary"
SIDES = "key string, pair int, is_left boolean, marks array<struct<pos: bigint, sig: bigint, before: bigint>>, total long"


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def flat(part: dict | None, inside: str) -> list[dict]:
    """The steps of a possibly nested sequence in a tokenizer's definition."""
    if part is None:
        return []
    return [x for p in part[inside] for x in flat(p, inside)] if part["type"] == "Sequence" else [part]


def words_are_independent(tk) -> bool:
    """Whether the definition proves that texts can be cut at space, tab and line feed without changing a token.

    The pre-tokenizer must keep only matches of a pattern that no blank can be part of, normalisation must not act across
    blanks (canonical composition, lower case and white-space runs do not), special tokens must hold
    no blank and not strip their surroundings, and merges must be fixed.
    """
    plan = json.loads(tk.to_str())
    steps, normal = flat(plan["pre_tokenizer"], "pretokenizers"), flat(plan["normalizer"], "normalizers")
    plain = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " "
                for n in normal)
    split = bool(steps) and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and (
        steps[0]["pattern"] == {"Regex": BLANK_FREE_PATTERN})
    rest = all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in steps[1:])
    added = all(not any(c.isspace() for c in t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
                for t in plan["added_tokens"])
    return plain and split and rest and added and plan["model"]["type"] == "BPE" and not plan["model"]["dropout"]


class TextCounter:
    """Token counts of short texts."""

    def __init__(self, path: str):
        self.encode = tokenizer(path).encode_batch_fast
        self.words: dict[str, int] | None = {} if words_are_independent(tokenizer(path)) else None

    def __call__(self, texts: list[str]) -> list[int]:
        if self.words is None:
            return list(map(len, self.encode(texts, add_special_tokens=False)))
        if len(self.words) > MEMO_WORDS:
            self.words.clear()
        parts = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        fresh = list(set().union(*parts).difference(self.words))
        for at in range(0, len(fresh), 4096):
            some = fresh[at:at + 4096]
            self.words.update(zip(some, map(len, self.encode(some, add_special_tokens=False))))
        return [sum(map(self.words.__getitem__, p)) for p in parts]


@functools.lru_cache(maxsize=2)
def text_counter(path: str) -> TextCounter:
    return TextCounter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, whole_chars: int = WHOLE_CHARS,
                 piece_chars: int = PIECE_CHARS, overlap_chars: int = OVERLAP_CHARS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column, n_bytes, n_tokens, over_limit``: one row per input row, repeated rows included.

    A null text counts as empty (0 tokens), a null id stays null, other columns are not read, so
    their names cannot clash. An empty table gives an empty result. ``tokenizer_path`` must be
    readable on every executor.
    """
    if not 4 * MARGIN <= overlap_chars < piece_chars:
        raise ValueError("overlap_chars must be at least four margins and less than piece_chars")
    texts = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    short = texts.where(F.char_length("text") <= whole_chars)
    long = texts.where(F.char_length("text") > whole_chars)
    counted = _count_short(short, tokenizer_path, id_column).unionByName(
        _count_long(long, tokenizer_path, piece_chars, overlap_chars, id_column))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _count_short(texts: DataFrame, path: str, id_column: str) -> DataFrame:
    kind = texts.schema[id_column].dataType
    schema = T.StructType([T.StructField(id_column, kind), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = text_counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_PER_CALL):
                part = batch.slice(at, TEXTS_PER_CALL)
                raw = part.column("raw").to_pylist()
                found = counts([x.decode("utf-8", "replace") for x in raw])
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_column), pa.array(map(len, raw), pa.int64()),
                     pa.array(found, pa.int64())], names=schema.names)

    return texts.select(id_column, F.col("text").cast("binary").alias("raw")).mapInArrow(count, schema)


def _count_long(texts: DataFrame, path: str, piece: int, overlap: int, id_column: str) -> DataFrame:
    keyed = texts.select(id_column, F.octet_length("text").cast("long").alias("n_bytes"),
                         F.sha2("text", 256).alias("key"), "text")
    pending = keyed.select("key", "text").dropDuplicates(["key"])
    rounds = []
    while True:
        table = materialise(_splice(pending, path, piece, overlap), "spliced")
        rounds.append(table.where("n_tokens IS NOT NULL"))
        unaligned = table.where("n_tokens IS NULL").select("key")
        if unaligned.isEmpty():
            break
        pending = pending.join(unaligned, "key", "left_semi")
        overlap *= WIDEN
        piece = max(piece, WIDEN * overlap)
    counts = functools.reduce(DataFrame.unionByName, rounds)
    return keyed.drop("text").join(counts, "key").select(id_column, "n_bytes", "n_tokens")


def _splice(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``key, n_tokens``; n_tokens is null where some neighbours share no proven boundary."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column("key").to_pylist(), batch.column("raw").to_pylist()):
                for rows in pieces(key, raw.decode("utf-8", "replace"), chunk, overlap):
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in rows], schema=arrow_pieces)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = tokenizer(path)
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(piece_sides(tk, row, overlap), schema=arrow_sides)

    arrow_pieces = pa.schema([("key", pa.string()), ("piece", pa.int32()), ("n_pieces", pa.int32()),
                              ("start", pa.int64()), ("text", pa.binary())])
    mark = pa.struct([("pos", pa.int64()), ("sig", pa.int64()), ("before", pa.int64())])
    arrow_sides = pa.schema([("key", pa.string()), ("pair", pa.int32()), ("is_left", pa.bool_()),
                             ("marks", pa.list_(mark)), ("total", pa.int64())])
    # A given number, so that few bytes with much work are not gathered into few tasks.
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = (texts.select("key", F.col("text").cast("binary").alias("raw")).mapInArrow(cut, PIECES)
             .repartition(parts, "key", "piece").mapInArrow(encode, SIDES))
    pairs = sides.groupBy("key", "pair").agg(
        F.max(F.when(F.col("is_left"), F.col("marks"))).alias("a"),
        F.max(F.when(~F.col("is_left"), F.col("marks"))).alias("b"), F.max("total").alias("total"))
    place = lambda marks: F.transform(marks, lambda m: F.struct(m["pos"], m["sig"]))
    before = lambda marks: F.element_at(F.filter(marks, lambda m: m["pos"] == F.col("splice")["pos"]), 1)["before"]
    spliced = pairs.withColumn("splice", F.try_element_at(F.array_intersect(place("a"), place("b")), F.lit(1)))
    share = F.coalesce(F.col("total"), F.when(F.col("splice").isNotNull(), before("a") - before("b")))
    return spliced.select("key", share.alias("share")).groupBy("key").agg(
        F.when(F.count("share") == F.count("*"), F.sum("share")).alias("n_tokens"))


def pieces(key: str, text: str, chunk: int, overlap: int) -> Iterator[tuple]:
    step = chunk - overlap
    count = max(1, -(-(len(text) - overlap) // step))
    for i in range(count):
        yield key, i, count, i * step, text[i * step:i * step + chunk].encode()


def piece_sides(tk, row: dict, overlap: int) -> list[dict]:
    """The piece as right neighbour of the one before and as left neighbour of the one after (or as the last)."""
    text, start, at, last = row["text"].decode(), row["start"], row["piece"], row["piece"] == row["n_pieces"] - 1
    found = tk.encode(text, add_special_tokens=False)
    ids, words, offsets = found.ids, found.word_ids, found.offsets
    out = []
    if at:
        out.append({"pair": at - 1, "is_left": False, "marks": marks(text, ids, words, offsets, start, 0, overlap)})
    if last:
        out.append({"pair": at, "is_left": True, "total": len(ids)})
    else:
        out.append({"pair": at, "is_left": True,
                    "marks": marks(text, ids, words, offsets, start, len(text) - overlap, len(text))})
    return [{"key": row["key"], "marks": None, "total": None} | x for x in out]


def marks(text: str, ids: list, words: list, offsets: list, start: int, low: int, high: int) -> list[dict]:
    """Stable pre-token starts well inside text[low:high], with the tokens before each and a witness of those after."""
    out = []
    first = bisect.bisect_left(offsets, (low + MARGIN, 0))  # tokens are in the order of their places
    for t in range(max(1, first - WITNESS), len(ids) - WITNESS):
        at = offsets[t][0]
        if at < low + MARGIN or words[t] == words[t - 1] or offsets[t - 1][1] > at:
            continue
        if offsets[t + WITNESS][1] > high - MARGIN:
            break
        if splits_cleanly(text, at):
            witness = tuple((ids[k], offsets[k][0] + start, offsets[k][1] + start) for k in range(t, t + WITNESS))
            out.append({"pos": at + start, "sig": hash(witness), "before": t})
    return out


def splits_cleanly(text: str, at: int) -> bool:
    """Whether canonical composition leaves the border before text[at] alone."""
    if text[at] < "\x80":
        return True
    if unicodedata.combining(text[at]):
        return False
    left, right = text[max(0, at - MARGIN // 2):at], text[at:at + MARGIN // 2]
    form = functools.partial(unicodedata.normalize, "NFC")
    return form(left + right) == form(left) + form(right)
