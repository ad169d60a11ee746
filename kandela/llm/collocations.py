"""Phrase collocations per language, mined after Toivonen.

A sample of the texts, mined level by level with a lowered threshold, proposes phrases. One pass over all
documents then counts, exactly, the proposed phrases and their negative border: the phrases that were not proposed though
their first and last words but one were, so ``S`` and its border are the phrases whose prefix and suffix are both
in ``S``. The border is never listed; a task knows its members by that test. A frequent phrase of the border is a
failure of the sample: it joins ``S`` and a further pass counts the border of the new ``S`` that no pass has
counted yet, until no pass finds a failure. Whatever the sample was, the result is that of counting everything.

Tasks ask a fixed-size bit table (``filter_bits``, on the driver and in each task) whether a phrase is in ``S``. It may say yes
wrongly, so that a task counts a phrase too many, never no: a full table costs shuffle, not results. Counts are
combined in each task before they are shuffled, and phrases travel as texts, so no two can be taken for each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from kandela.llm.text import or_empty
from kandela.session import materialise

LONGEST = 5
FILTER_BITS = 1 << 26
PROBES = 3
CHUNK_BYTES = 8 << 20
RUN_BYTES = 192

# Fixed values of the contract: blanks end words, the others end pieces too.
BLANKS = b" \t"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

COUNTS = "lang string, words int, phrase string, n long"
TOTAL = 0  # rows of so many words hold the number of all words of a language


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(BLANKS)], kinds[list(PIECE_ENDS)] = 1, 2
    return kinds


KINDS = _kinds()
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def split_words(raw: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words, the word at each place and the number of its piece."""
    text = np.frombuffer(raw.translate(LOWER), np.uint8)
    kind = KINDS[text]
    inside = kind == 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(text) and inside[0]:
        edges = np.concatenate([[0], edges])
    if len(edges) % 2:
        edges = np.concatenate([edges, [len(text)]])
    starts, ends = edges[::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text[inside])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), piece


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


POWERS = np.cumprod(np.full(4096, 0x100000001B3, np.uint64))  # of an odd number, for polynomial hashes of words


def word_hashes(words: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)
    starts = offsets[:-1] - offsets[0]
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(offsets))
    return mixed(np.add.reduceat(raw * POWERS[place % len(POWERS)], starts)) if len(words) else np.zeros(0, np.uint64)


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its prefix (of the language for a single word) and its last word."""
    return mixed(prefix + word)


def probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Places in a table of ``bits`` (a power of two) bits."""
    step = mixed(h) | np.uint64(1)
    return [(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]


def in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), bool)
    for place in probes(h, len(table) * 8):
        found &= (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found


def count_chunk(lang: str, raw: bytes, levels: tuple[int, ...], proposed: np.ndarray | None,
                counted: np.ndarray | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words, phrases, counts) of the levels' phrases whose prefix and suffix are proposed, but not both in ``counted``.

    Every phrase of the length at hand that may be proposed has a rank; a rank and the next word name one a word longer.
    """
    words, ids, piece = split_words(raw)
    n, base, top = len(ids), len(words), max(levels)
    if not n:
        return
    if 1 in levels and counted is None:
        yield 1, words, np.bincount(ids, minlength=base)
    if top == 1:
        return
    hashes = word_hashes(words)
    one = longer(np.full(base, lang_hash(lang)), hashes)
    member = lambda table, h: None if table is None else in_table(table, h)
    at, rank, h, spelled = np.arange(n), ids, one[ids], [np.arange(base)]
    new, old = member(proposed, one)[ids], None if counted is None else member(counted, one)[ids]
    for m in range(2, top + 1):
        # at, rank, h, new, old: places of phrases of m - 1 words that are left, in order
        keep = np.flatnonzero(new)
        at, rank, h, old = at[keep], rank[keep], h[keep], None if old is None else old[keep]
        follows = np.flatnonzero(at[1:] == at[:-1] + 1)  # prefix and suffix are proposed
        follows = follows[at[follows] + m - 1 < n]
        follows = follows[piece[at[follows]] == piece[at[follows] + m - 1]]
        if not len(follows):
            return
        seen = None if old is None else old[follows] & old[follows + 1]
        at, rank = at[follows], rank[follows]
        last = ids[at + m - 1]
        h, key = longer(h[follows], hashes[last]), rank * base + last
        if m in levels and (seen is None or not seen.all()):
            different, times = np.unique(key if seen is None else key[~seen], return_counts=True)
            parts = [*[s[different // base] for s in spelled], different % base]
            yield m, pc.binary_join_element_wise(*[words.take(pa.array(p)) for p in parts], b" "), times
        if m == top:
            return
        new, old = member(proposed, h), member(counted, h)
        different, inverse = np.unique(key[new], return_inverse=True)
        spelled = [*[s[different // base] for s in spelled], different % base]
        rank = np.zeros(len(key), np.int64)
        rank[new] = inverse


def _counter(levels: tuple[int, ...], proposed, counted, chunk_bytes: int):
    value = lambda shared: None if shared is None else np.frombuffer(shared.value, np.uint8)
    schema = pa.schema([("key", pa.string()), ("n", pa.int64())])

    def rows(lang: str, raw: bytes, tables) -> Iterator[pa.RecordBatch]:
        prefix = pa.scalar(lang.encode(), pa.binary())
        for m, phrases, times in count_chunk(lang, raw, levels, *tables):
            keys = pc.binary_join_element_wise(prefix, phrases, b"\t")
            yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(times.astype(np.int64))], schema=schema)
            if m == 1:
                yield pa.RecordBatch.from_arrays([pa.array([f"{lang}\t"]), pa.array([int(times.sum())])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = value(proposed), value(counted)
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("raw")):
                raw = raw.as_py()
                while len(raw) > chunk_bytes:  # phrases end with their piece, so a long text can be cut there
                    cut = max(raw.rfind(end, 0, chunk_bytes) for end in map(bytes, zip(PIECE_ENDS)))
                    if cut < 0:
                        break
                    yield from rows(lang, raw[:cut], tables)
                    raw = raw[cut + 1:]
                held.setdefault(lang, []).append(raw)
                size += len(raw)
                if size >= chunk_bytes:
                    for each, texts in held.items():
                        yield from rows(each, b".".join(texts), tables)
                    held, size = {}, 0
        for each, texts in held.items():
            yield from rows(each, b".".join(texts), tables)

    return run


def sampled(raw: bytes, chance: np.random.Generator, one_in: int) -> bytes:
    """One of every ``one_in`` runs of words in a row; they end with their piece, long ones after ``RUN_BYTES``.

    Phrases that crowd in one document or one endless piece therefore do not stand or fall with it.
    """
    text = np.frombuffer(raw, np.uint8).copy()
    kind = KINDS[text]
    begins = kind == 2
    blanks = np.flatnonzero(kind == 1)
    block = blanks // RUN_BYTES
    begins[blanks[1:][block[1:] != block[:-1]]] = True
    run = np.cumsum(begins)
    picks = chance.integers(0, one_in, len(text) // one_in + 1)
    chosen = run % one_in == picks[run // one_in]
    text[begins] = ord(".")
    return text[chosen | begins].tobytes()


def _sampler(one_in: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chance = np.random.default_rng(seed)
        for batch in batches:
            kept = [sampled(raw.as_py(), chance, one_in) for raw in batch.column("raw")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(kept, pa.binary())], names=["lang", "raw"])

    return run


def count_pass(texts: DataFrame, levels: tuple[int, ...], proposed, counted, least: int, chunk_bytes: int) -> DataFrame:
    """Phrases found at least ``least`` times by one pass, and the totals of the languages."""
    counts = texts.mapInArrow(_counter(levels, proposed, counted, chunk_bytes), "key string, n long")
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"))
    lang, phrase = F.regexp_extract("key", r"(?s)^(.*)\t", 1), F.substring_index("key", "\t", -1)
    words = F.when(phrase == "", TOTAL).otherwise(F.char_length(phrase) - F.char_length(F.replace(phrase, F.lit(" "))) + 1)
    kept = counts.where((F.col("n") >= least) | F.col("key").endswith("\t"))
    return materialise(kept.select(lang.alias("lang"), words.alias("words"), phrase.alias("phrase"), "n"), "phrases")


def phrase_hashes(phrases: list[list[bytes]], langs: list[str]) -> np.ndarray:
    """The hashes of phrases that are given as their words."""
    out = np.array([lang_hash(lang) for lang in langs], np.uint64)
    for j in range(max(map(len, phrases), default=0)):
        at = [i for i, words in enumerate(phrases) if len(words) > j]
        out[at] = longer(out[at], word_hashes(pa.array([phrases[i][j] for i in at], pa.binary())))
    return out


def _places(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = [phrase.encode().split(b" ") for phrase in batch.column("phrase").to_pylist()]
            h = phrase_hashes(phrases, batch.column("lang").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(probes(h, bits)).astype(np.int64))], names=["place"])

    return run


def bit_table(phrases: DataFrame, bits: int):
    """A broadcast table of ``bits`` bits that says yes to all ``phrases``; at most ``bits / 64`` rows reach the driver."""
    places = phrases.where(F.col("words") != TOTAL).select("lang", "phrase").mapInArrow(_places(bits), "place long")
    slots = places.groupBy(F.shiftright("place", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy()
    return phrases.sparkSession.sparkContext.broadcast(table.tobytes())


def grown(failures: DataFrame, frequent: DataFrame, longest: int) -> DataFrame:
    """Failures with the longer phrases they may be part of, as (lang, words, phrase), for the next pass to propose.

    Two phrases of the same length that overlap in all but one word make one a word longer; one of the two is a failure or
    made of one, the other is frequent or made of a failure. A frequent phrase that holds a failing pair is among them, so
    that one more pass settles all lengths. Only words that fail can call for another.
    """
    part = lambda start, length: F.array_join(F.slice(F.split("phrase", " "), start, length), " ")
    columns = ["lang", "words", "phrase"]
    fresh, out = failures.select(*columns).where("words = 2"), failures.select(*columns)
    for m in range(2, longest - 1):
        known = frequent.where(F.col("words") == m).select(*columns).unionByName(fresh).distinct()
        join = lambda lefts, rights: lefts.select("lang", F.col("phrase").alias("first"), part(F.lit(2), F.lit(m - 1)).alias("shared")).join(
            rights.select("lang", part(F.lit(1), F.lit(m - 1)).alias("shared"), F.element_at(F.split("phrase", " "), -1).alias("last")),
            ["lang", "shared"]).select("lang", F.lit(m + 1).alias("words"), F.concat_ws(" ", "first", "last").alias("phrase"))
        made = join(fresh, known).unionByName(join(known, fresh)).unionByName(failures.select(*columns).where(F.col("words") == m + 1))
        fresh = materialise(made.distinct(), "expansion")
        out = out.unionByName(fresh)
    return out.distinct()


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = LONGEST, one_in: int = 4, slack: float = 0.35,
                     seed: int = 7, text_column: str = "text", lang_column: str = "lang", filter_bits: int = FILTER_BITS,
                     chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``lang, words, phrase, n``: every phrase of 1 to ``longest`` words with at least ``least`` occurrences, and with
    ``words`` 0 and an empty phrase the number of all words of each language.

    The sample takes one of ``one_in`` runs of words and proposes what it holds ``slack * least / one_in`` times; neither changes
    the result, only the number of passes. Null texts count as empty, null languages as ``und``; repeated rows count
    each; texts above ``chunk_bytes`` are cut at ends of pieces (a single longer piece is held whole); an empty table gives an
    empty result; other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang_column), F.lit("und")).alias("lang"),
                        or_empty(F.col(text_column)).cast("binary").alias("raw"))
    some = materialise(texts.mapInArrow(_sampler(one_in, seed), "lang string, raw binary"), "phrase-sample")
    proposed, table = None, None
    for m in range(1, longest):  # the longest phrases are in the border of the others
        level = count_pass(some, (m,), table, None, max(1, int(slack * least / one_in)), chunk_bytes).where(F.col("words") == m)
        level = level.select("lang", "words", "phrase")
        proposed = level if proposed is None else proposed.unionByName(level)
        table = bit_table(proposed, filter_bits)
    found, counted = None, None
    while True:
        new = count_pass(texts, tuple(range(1, longest + 1)), table, counted, least, chunk_bytes)
        found = new if found is None else found.unionByName(new)
        failures = materialise(new.where(F.col("words").between(1, longest - 1)).join(
            proposed, ["lang", "words", "phrase"], "left_anti"), "border-failures")
        if failures.isEmpty():
            return found
        proposed, counted = proposed.unionByName(materialise(grown(failures, found, longest), "proposed")), table
        table = bit_table(proposed, filter_bits)


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, longest: int = LONGEST, **how) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases by score, count and phrase.

    The score of a phrase found ``a`` times is the least ``floor(1000 * a * n / (l * r))`` over its cuts into a first part
    found ``l`` times and a rest found ``r`` times, ties to the shortest first part; ``n`` is the number of words of the
    language. A phrase inside a longer one with the same count is left out. Arithmetic is in 38 digits. More
    options and the treatment of nulls as in ``frequent_phrases``.
    """
    found = frequent_phrases(docs, least, longest, **how)
    totals = found.where(F.col("words") == TOTAL).groupBy("lang").agg(F.sum("n").alias("total"))
    known = materialise(found.where(F.col("words") != TOTAL).select("lang", "words", "phrase", "n"), "frequent")
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    phrases = known.where("words > 1").withColumn("w", F.split("phrase", " "))

    # A longer phrase is never found more often, so whoever is inside one of the same count is inside one a word longer.
    inside = phrases.where("words > 2").select(
        "lang", F.explode(F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase"), F.col("n").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = phrases.join(inside, ["lang", "phrase"], "left").where(F.coalesce("longer", F.lit(0)) < F.col("n"))

    cuts = materialise(free.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right")), "cuts")
    side = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    cuts = materialise(cuts.join(side("left", "l"), ["lang", "left"]), "cuts")  # stored, so that the next join can split a hot part
    cuts = cuts.join(side("right", "r"), ["lang", "right"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.withColumn("thousand", F.col("a") * 1000).withColumn("over", wide("thousand") * wide("total")).withColumn(
        "under", wide("l") * wide("r")).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score").withColumn(
        "rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
