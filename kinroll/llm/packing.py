"""Best-fit packing by exact-complement hashing.

Tokens: a text's ids by the tokenizer file, then one separator id. A document
longer than a sequence is cut into full pieces (its first piece holds the
remainder). Packing sees lengths only:

1. the pieces are counted per length (at most ``capacity`` counts);
2. the **plan** is made from those counts: the longest length left opens a
   pattern, and its gap is looked up among the sums of one, two or three
   available lengths; a combination that fills it exactly is consumed as often
   as the counts allow. Where no sum fits, the largest length that fits goes in
   (best fit) and the smaller gap is looked up again;
3. the pieces of one length are ranked without gathering them (counts per salt,
   running offsets, ranks within a salt), and a rank's interval in the plan
   gives its sequence and offset.

The driver holds the counts and the plan, both bounded by ``capacity``; ids and
texts stay on the executors.

Text ids: the tokenizer file decides, by the library's defaults: an added token
spelled out in a text has its own id. Texts of Latin-1 characters without one run
through tiktoken with the vocabulary and the pattern of that file, which gives the
same ids several times faster; any other text goes through ``tokenizers`` itself.

Defined cases: a null text is the empty text (one separator); rows that repeat
an id are packed each for itself; an empty table gives an empty result; input
columns other than id and text play no part.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinroll.llm.common import cut, map_arrow, narrow, text_bytes, to_arrow

CAPACITY = 2048
SALTS = 1024
PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as itself where it prints in
    Latin-1, and as the next code point from 256 on where it does not."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


class TextIds:
    """Ids of texts by a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, file_text: str, pattern: str):
        import tiktoken

        self.file_text = file_text
        symbols, self.added = _byte_of_symbol(), {t["content"] for t in json.loads(file_text)["added_tokens"]}
        ranks = {bytes(symbols[c] for c in token): i
                 for token, i in json.loads(file_text)["model"]["vocab"].items() if token not in self.added}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def library(self):
        """The library's own tokenizer, made when a text first needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.file_text)

    @functools.cached_property
    def exact(self):
        """The same, reading added tokens as text like the fast path."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self.file_text)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def __call__(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


@functools.lru_cache(maxsize=2)
def _text_ids(file_text: str, pattern: str) -> TextIds:
    return TextIds(file_text, pattern)


def cut_points(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first takes the rest."""
    start, length = 0, (n - 1) % capacity + 1
    while start < n:
        yield start, length
        start, length = start + length, capacity


def _piecer(file_text, pattern: str, separator: int, capacity: int, schema: pa.Schema):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _text_ids(file_text.value, pattern)
        for batch in batches:
            rows: list[tuple] = []
            owner: list[int] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(ids_of(text.decode()), np.uint32(separator)).astype("<u4")
                for piece, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    rows.append((piece, start, length, crc))
                    owner.append(row)
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())),
                 *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)

    return pieces


def token_pieces(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 separator: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``.
    The tokenizer file is read once and broadcast (a few MB, fixed)."""
    from pyspark.sql import types as T

    with open(tokenizer_path, encoding="utf-8") as f:
        file_text = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = narrow(docs, doc_id=id_col, text=text_bytes(text_col))
    schema = T._parse_datatype_string(PIECES.format(id=docs.schema[id_col].dataType.simpleString()))
    return map_arrow(rows, _piecer(file_text, pattern, separator, capacity, to_arrow(schema)), schema)


class _Lengths:
    """Available lengths as a bit set, with the sums of one, two and three of
    them looked up by shifting it against its own mirror image."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64).copy()
        self.top = len(counts) - 1
        self.used: dict[int, int] = {}
        self.bits = sum(1 << i for i in np.flatnonzero(self.counts).tolist())
        self.mirror = sum(1 << (self.top - i) for i in np.flatnonzero(self.counts).tolist())

    def left(self, length: int) -> int:
        return int(self.counts[length]) - self.used.get(length, 0)

    def _set(self, length: int) -> None:
        if self.left(length) > 0:
            self.bits |= 1 << length
            self.mirror |= 1 << (self.top - length)
        else:
            self.bits &= ~(1 << length)
            self.mirror &= ~(1 << (self.top - length))

    def take(self, length: int) -> None:
        self.used[length] = self.used.get(length, 0) + 1
        self._set(length)

    def give_back(self, length: int) -> None:
        self.used[length] -= 1
        self._set(length)

    def commit(self) -> tuple[list[tuple[int, int]], int]:
        """The open pattern and how often the counts allow it; consumes them."""
        pattern = sorted(((n, k) for n, k in self.used.items() if k), reverse=True)
        times = min(int(self.counts[n]) // k for n, k in pattern)
        self.used = {}
        for n, k in pattern:
            self.counts[n] -= k * times
            self._set(n)
        return pattern, times

    def largest(self, at_most: int) -> int:
        return (self.bits & ((2 << at_most) - 1)).bit_length() - 1 if self.bits & ((2 << at_most) - 1) else 0

    def pair(self, gap: int) -> tuple[int, ...]:
        shift = self.top - gap  # mirror bit (top - b) meets bit a where a + b == gap
        both = self.bits & (self.mirror >> shift if shift >= 0 else self.mirror << -shift) & ((1 << gap) - 1)
        while both:
            a = both.bit_length() - 1
            if a != gap - a or self.left(a) > 1:
                return (a, gap - a)
            both &= ~(1 << a)
        return ()

    def exact(self, gap: int) -> tuple[int, ...]:
        """One, two or three available lengths that fill the gap exactly."""
        if self.bits >> gap & 1:
            return (gap,)
        if found := self.pair(gap):
            return found
        first = self.largest(gap - 2) if gap > 2 else 0
        while first * 3 >= gap:  # the largest of three is a third of the gap at least
            self.take(first)
            found = self.pair(gap - first)
            self.give_back(first)
            if found:
                return (first, *found)
            first = self.largest(first - 1)
        return ()


def packing_plan(counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ``([(length, times in one sequence), ...], sequences)``.

    ``counts[n]`` pieces have length ``n``; the capacity is ``len(counts) - 1``.
    Every pattern uses some length up, so the plan is bounded by the capacity.
    """
    lengths, plan = _Lengths(counts), []
    while opener := lengths.largest(lengths.top):
        gap = lengths.top - opener
        lengths.take(opener)
        while gap:
            fill = lengths.exact(gap)
            if not fill:
                best = lengths.largest(gap)
                if not best:
                    break
                fill = (best,)
            for n in fill:
                lengths.take(n)
            gap -= sum(fill)
        plan.append(lengths.commit())
    return plan


def plan_intervals(plan) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, ranks per sequence, first sequence,
    offset of the first one): ranks from there on lie in that pattern."""
    intervals: dict[int, list[tuple]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for n, k in pattern:
            intervals.setdefault(n, []).append((ranks.get(n, 0), k, sequence, offset))
            ranks[n] = ranks.get(n, 0) + k * times
            offset += n * k
        sequence += times
    return {n: np.array(rows, dtype=np.int64) for n, rows in intervals.items()}


def _placer(intervals: dict[int, np.ndarray], schema: pa.Schema):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                rows = intervals[n][np.searchsorted(intervals[n][:, 0], ranks[at], "right") - 1]
                within = ranks[at] - rows[:, 0]
                sequence[at] = rows[:, 2] + within // rows[:, 1]
                offset[at] = rows[:, 3] + within % rows[:, 1] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], schema=schema)

    return place


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece ``sequence_id`` and ``offset``; ``pieces`` is read three
    times (counts per length and salt, ranks), so pass a cut one."""
    from pyspark.sql import types as T

    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    cells = pieces.groupBy("length", "salt").count()  # capacity * SALTS rows at most
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in cells.groupBy("length").agg(F.sum("count")).collect():  # capacity rows at most
        counts[length] = n
    intervals = plan_intervals(packing_plan(counts))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    )
    schema = T.StructType([*ranked.schema.fields[:5], *T._parse_datatype_string("sequence_id long, offset long").fields])
    return map_arrow(ranked, _placer(intervals, to_arrow(schema)), schema)


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
         separator: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``, one row per piece."""
    pieces = token_pieces(docs, tokenizer_path, pattern, id_col, text_col, separator, capacity)
    return place_pieces(cut(pieces), capacity)
