"""Chat formatting at token level.

Every turn is three segments: its role, its text and nothing but reserved ids between them. Segments are encoded apart, so
no token spans a border, and the reserved ids (above the vocabulary) are spliced in: they open the turn, end the role and
end the turn. Marks of +1 and -1 stand where the loss starts and stops; the loss mask is their prefix sum. Turns are encoded
where they lie and get their place in the token stream of their conversation by a prefix sum over sorted ranges.

Written as text, the reserved ids are control strings. Where a role or text holds one, or the escape sign, an escape sign is
put before it, so that every written conversation reads back as it was.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kandela.llm.text import or_empty
from kandela.session import materialise

TURNS_PER_CALL = 256

FORMATTED = "conv_id long, turn long, role string, a long, ids array<int>, marks array<int>, n_tokens long"
READ_BACK = "conv_id long, place long, turn_block binary, loss_block binary, written long, masked long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, loss_tokens long"


@dataclass(frozen=True)
class Template:
    """Control strings and the roles whose texts carry loss."""

    opening: str = "### "
    role_end: str = ": "
    ending: str = "</turn>\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)

    def _pattern(self, strings: tuple[str, ...]) -> re.Pattern:
        return re.compile("|".join(re.escape(x.strip()) for x in (self.escape, *strings)))

    @functools.cached_property
    def in_role(self) -> re.Pattern:
        return self._pattern((self.opening, self.ending, self.role_end))

    @functools.cached_property
    def in_text(self) -> re.Pattern:
        return self._pattern((self.opening, self.ending))

    def escaped(self, text: str, pattern: re.Pattern) -> str:
        return pattern.sub(lambda m: self.escape + m[0], text)

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", lambda m: m[1], text, flags=re.DOTALL)

    @functools.cached_property
    def _written_turn(self) -> re.Pattern:
        e = re.escape(self.escape)
        plain = lambda stop: f"((?:{e}.|(?!{stop})[^{e}])*+)"
        return re.compile(re.escape(self.opening) + plain(re.escape(self.role_end)) + re.escape(self.role_end)
                          + plain(re.escape(self.ending)) + re.escape(self.ending), re.DOTALL)

    def write(self, turns: list[tuple[str, str]]) -> str:
        return "".join(self.opening + self.escaped(role, self.in_role) + self.role_end
                       + self.escaped(text, self.in_text) + self.ending for role, text in turns)

    def read(self, written: str) -> list[tuple[str, str]]:
        """The turns of a written conversation; raises where it is not one."""
        turns, at = [], 0
        while at < len(written):
            m = self._written_turn.match(written, at)
            if m is None:
                raise ValueError(f"no turn at {at}")
            turns.append((self.unescaped(m[1]), self.unescaped(m[2])))
            at = m.end()
        return turns


PLAIN = Template()


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(path)
    tk.encode_special_tokens = True  # their strings in a text are ordinary text
    return tk


def reserved(tk) -> tuple[int, int, int]:
    """The ids of opening, role end and ending: the first three above the vocabulary."""
    size = tk.get_vocab_size(with_added_tokens=True)
    return size, size + 1, size + 2


def assemble(tk, turns: list[tuple[str, str]], template: Template = PLAIN) -> list[tuple[list[int], list[int]]]:
    """(ids, marks) of each turn; marks add up to 1 inside the loss and to 0 outside."""
    opening, role_end, ending = reserved(tk)
    parts = [x for role, text in turns for x in (template.escaped(role, template.in_role), template.escaped(text, template.in_text))]
    coded = [e.ids for e in tk.encode_batch_fast(parts, add_special_tokens=False)]
    out = []
    for i, (role, _) in enumerate(turns):
        who, what = coded[2 * i], coded[2 * i + 1]
        ids, marks = [opening, *who, role_end, *what, ending], [0] * (len(who) + len(what) + 3)
        if role in template.loss_roles:
            marks[len(who) + 2] += 1
            marks[-1] -= 1
        out.append((ids, marks))
    return out


def loss_mask(marks) -> np.ndarray:
    return np.cumsum(np.asarray(marks, np.int64)) > 0


def written(tk, ids: list[int], template: Template = PLAIN) -> str:
    """Ids as text: runs between reserved ids are decoded, reserved ids become control strings."""
    control = dict(zip(reserved(tk), (template.opening, template.role_end, template.ending)))
    out, run = [], []
    for i in [*ids, None]:
        if i is None or i in control:
            out.append(tk.decode(run, skip_special_tokens=False) if run else "")
            out.append("" if i is None else control[i])
            run = []
        else:
            run.append(i)
    return "".join(out)


def masked_texts(tk, ids: list[int], mask, template: Template = PLAIN) -> list[str]:
    """The unescaped text of every run of tokens under the mask."""
    mask = np.concatenate([[False], np.asarray(mask, bool), [False]])
    edges = np.flatnonzero(mask[1:] != mask[:-1])
    return [template.unescaped(tk.decode(ids[a:b], skip_special_tokens=False)) for a, b in zip(edges[::2], edges[1::2])]


def _formatter(path: str, template: Template):
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("a", pa.int64()),
                        ("ids", pa.list_(pa.int32())), ("marks", pa.list_(pa.int32())), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = tokenizer(path)
        for whole in batches:
            for at in range(0, whole.num_rows, TURNS_PER_CALL):
                batch = whole.slice(at, TURNS_PER_CALL)
                coded = assemble(tk, list(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())), template)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c) for c in ("conv_id", "turn", "role", "a")], pa.array([i for i, _ in coded], pa.list_(pa.int32())),
                    pa.array([m for _, m in coded], pa.list_(pa.int32())), pa.array([len(i) for i, _ in coded], pa.int64())], schema=schema)

    return run


def format_turns(turns: DataFrame, tokenizer_path: str, template: Template = PLAIN) -> DataFrame:
    """``conv_id, turn, role, ids, marks, n_tokens, place, start``: one row per turn of the formatted conversations.

    A conversation's token stream is its rows' ``ids`` by ``place`` (1, 2, ...); ``start`` is the number of tokens before the
    row. Turns are ordered by ``turn``, nulls first, ties by role and a hash of the text; repeated rows are turns of their
    own. Null roles and texts are empty; rows without an id make one conversation; other columns are not read. The
    tokenizer must give any text back from its ids (byte-level, nothing normalised). Very long conversations are spread over
    ranges; a text is encoded in one piece.
    """
    role, text = or_empty(F.col("role")), or_empty(F.col("text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        F.xxhash64(role, text).alias("a"), text.alias("text"))
    order = ("turn", "role", "a", "row")
    coded = rows.mapInArrow(_formatter(tokenizer_path, template), FORMATTED).withColumn("row", F.monotonically_increasing_id())
    spread = materialise(coded.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "formatted")
    totals = spread.groupBy("part", "conv_id").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))
    by_part = Window.partitionBy("conv_id").orderBy("part")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    # At most two rows for each border between ranges.
    carried = totals.select(F.col("part").alias("of_part"), F.col("conv_id").alias("of"), F.sum("n").over(earlier).alias("n_before"),
                            F.sum("tokens").over(earlier).alias("tokens_before"), F.row_number().over(by_part).alias("nth"))
    carried = materialise(carried.where("nth > 1").drop("nth"), "format-borders")
    inside = Window.partitionBy("part", "conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = spread.select("*", F.count("*").over(inside).alias("n_here"), F.sum("n_tokens").over(inside).alias("tokens_here"))
    both = here.join(carried, (F.col("part") == F.col("of_part")) & F.col("conv_id").eqNullSafe(F.col("of")), "left")
    zero = F.lit(0).cast("long")
    return both.select("conv_id", "turn", "role", "ids", "marks", "n_tokens", (F.coalesce("n_before", zero) + F.col("n_here")).alias("place"),
                       (F.coalesce("tokens_before", zero) + F.col("tokens_here") - F.col("n_tokens")).alias("start"))


def _reader(path: str, template: Template):
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn_block", pa.binary()), ("loss_block", pa.binary()),
                        ("written", pa.int64()), ("masked", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = tokenizer(path)
        for whole in batches:
            for at in range(0, whole.num_rows, TURNS_PER_CALL):
                batch, rows = whole.slice(at, TURNS_PER_CALL), []
                for conv_id, place, ids, marks in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "ids", "marks")]):
                    text, mask = written(tk, ids, template), loss_mask(marks)
                    turns = b"".join(f"{who}\n{what}\n".encode() for who, what in template.read(text))
                    loss = "".join(masked_texts(tk, ids, mask, template))
                    rows.append((conv_id, place, turns, loss.encode(), len(text), int(mask.sum())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation; the turns pass by in order and are never held together."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "loss_tokens"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    current, sums, turns, loss = (), None, None, None

    def row() -> tuple:
        return (*current, sums[0], turns.hexdigest(), sums[1], loss.hexdigest(), sums[2], sums[3])

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn_block", "loss_block", "written", "masked")]
        for conv_id, block, text, chars, masked in zip(*columns):
            if current != (conv_id,):
                if current:
                    done.append(row())
                current, sums, turns, loss = (conv_id,), [0, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
            turns.update(block)
            loss.update(text)
            sums = [sums[0] + 1, sums[1] + len(text.decode()), sums[2] + chars, sums[3] + masked]
        yield batch_of(done)
    if current:
        yield batch_of([row()])


def read_back(formatted: DataFrame, tokenizer_path: str, template: Template = PLAIN) -> DataFrame:
    """Per conversation what its formatted turns say: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, loss_tokens``.

    Ids are turned into written turns, those parsed and unescaped, and the tokens under the loss mask decoded, all where the
    rows lie. Only the digests need a conversation's turns in order: they stream, sorted, through one task each.
    """
    blocks = formatted.select("conv_id", "place", "ids", "marks").mapInArrow(_reader(tokenizer_path, template), READ_BACK)
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_digests, DIGESTS)
