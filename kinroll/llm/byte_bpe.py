"""Byte-level BPE by backtracking over longest matches.

A text is split by the vocabulary's pattern. Each match is read as bytes, the
bytes as Latin-1 characters, and an Aho-Corasick automaton lists the tokens that
start at every byte. The encoder walks left to right: it takes the longest token
whose neighbourhood with the token before it is *compatible* (merging the two
would not have happened earlier than their own merges, memoised per pair); where
none is left it steps back and shortens the previous token, and a byte it has
given up is never tried again. That reproduces the exact merges in time linear
in the match's length.

The automaton and the tables are built once per Python worker from the rank
file, which is broadcast (under 1 MB, fixed). The memos are bounded. ASCII texts
are split by the same pattern with its Unicode classes narrowed to ASCII, which
gives the same matches faster.

Defined cases: a null text is the empty text (no ids, no bytes); a null id list
decodes to null, unknown ids raise ``KeyError``; an empty table gives an empty
result; input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import append, extended, map_arrow, quoted, without

MEMO_WORDS = 200_000   # matches in each of the two generations a worker remembers
MEMO_BYTES = 48        # longer matches are encoded each time
MEMO_PAIRS = 400_000
BLOCK = 4096           # starts whose tokens are listed at a time


def read_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, blob.splitlines()) if token}


# What the pattern's Unicode classes hold among ASCII characters.
ASCII_CLASSES = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r" \t-\r", r"\S": r"^ \t-\r"}


def ascii_pattern(pattern: str) -> re.Pattern | None:
    """``pattern`` for ASCII texts, or None where it holds a class or an escape
    without an entry in ``ASCII_CLASSES``, or brackets within a set."""
    if re.search(r"\[\^?\]|\[[^\]]*\[", pattern):
        return None
    out, in_set = [], False
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.DOTALL):
        if part[0] == "\\":
            members = ASCII_CLASSES.get(part)
            if members is None or (in_set and members[0] == "^"):
                return None
            part = members if in_set else f"[{members}]"
        elif part in "[]":
            in_set = part == "["
        out.append(part)
    return re.compile("".join(out))


def merged(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """The parts of ``token`` after all merges of a rank under ``below``."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteBpe:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick

        self.ranks, self.split = ranks, regex.compile(pattern)
        self.split_ascii = ascii_pattern(pattern) or self.split
        self.token_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}   # the two tokens whose merge made a token
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merged(token, ranks, rank)
                if len(parts) > 2:
                    continue  # no sequence of merges makes it; only a whole match can be it
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.packed = _Packed(self)
        self.spellings = pa.array([self.token_of.get(i, b"") for i in range(max(self.token_of) + 1)], pa.binary())

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens from the latest to the earliest. At
        each step the two parts that touch must not merge before the merges
        undone so far."""
        undone, spelt = len(self.ranks) + 1, self.token_of
        while True:
            if self.ranks.get(spelt[left] + spelt[right], undone) < undone:
                return False
            if left > right:
                undone, halves = left, self.halves.get(left)
                if halves is not None:
                    left = halves[1]
                    continue
                undone, halves = right + 1, self.halves.get(right)
                if halves is None:
                    return True
                right = halves[0]
            else:
                undone, halves = right + 1, self.halves.get(right)
                if halves is not None:
                    right = halves[0]
                    continue
                undone, halves = left, self.halves.get(left)
                if halves is None:
                    return True
                left = halves[1]

    def _starts(self, word: str):
        """A function of a start: its tokens (length, rank), shortest first.
        Long matches are listed block by block, a few blocks at a time."""
        n, blocks = len(word), {}

        def block(b: int) -> list[list[tuple[int, int]]]:
            first = b * BLOCK
            lists: list[list[tuple[int, int]]] = [[] for _ in range(min(BLOCK, n - first))]
            for end, token in self.automaton.iter(word, first, min(n, first + BLOCK + self.longest)):
                start = end - token[0] + 1 - first
                if 0 <= start < len(lists):
                    lists[start].append(token)
            return lists

        def at(start: int) -> list[tuple[int, int]]:
            b = start // BLOCK
            if b not in blocks:
                if len(blocks) >= 4:
                    blocks.pop(min(blocks))
                blocks[b] = block(b)
            return blocks[b][start - b * BLOCK]

        return at

    def _all_starts(self, word: str):
        """The same for a short match, listed at once."""
        lists: list[list[tuple[int, int]]] = [[] for _ in word]
        for end, token in self.automaton.iter(word):
            lists[end + 1 - token[0]].append(token)
        return lists.__getitem__

    def encode_match(self, word: str) -> tuple[int, ...]:
        """The ids of one match of the pattern, given as Latin-1 bytes."""
        n, pairs, compatible = len(word), self.pairs, self.compatible
        at = self._all_starts(word) if n <= BLOCK else self._starts(word)
        given_up = bytearray(n + 1)
        ids: list[int] = []
        steps: list[tuple[int, int]] = []  # per token: its length, its index in the list of its start
        start, tokens, last = 0, at(0), -1
        choice = len(tokens) - 1
        while True:
            while choice >= 0:
                length, rank = tokens[choice]
                if not given_up[start + length]:
                    if last < 0:
                        break
                    fits = pairs.get((last, rank))
                    if compatible(last, rank) if fits is None else fits:
                        break
                choice -= 1
            if choice >= 0:
                ids.append(rank)
                steps.append((length, choice))
                start += length
                if start == n:
                    return tuple(ids)
                tokens, last = at(start), rank
                choice = len(tokens) - 1
            else:
                given_up[start] = 1
                ids.pop()
                length, choice = steps.pop()
                start -= length
                choice -= 1
                tokens, last = at(start), ids[-1] if ids else -1

    def encode_packed(self, text: str) -> bytes:
        """The ids of a whole text, 4 bytes each."""
        split = self.split_ascii if text.isascii() else self.split
        return b"".join(map(self.packed.__getitem__, split.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<i4").tolist()

    def decode_lists(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of every list: its tokens' spellings, laid end to end."""
        known = ids.filter(ids.is_valid()) if ids.null_count else ids
        offsets = known.offsets.to_numpy()
        if len(known) and (np.any(known.values.to_numpy() < 0) or np.any(known.values.to_numpy() >= len(self.spellings))):
            raise KeyError("an id that the vocabulary does not have")
        spelt = self.spellings.take(known.values)
        ends = np.frombuffer(spelt.buffers()[1], dtype="<i4")[spelt.offset:spelt.offset + len(spelt) + 1]
        joined = pa.BinaryArray.from_buffers(pa.binary(), len(known), [None, pa.py_buffer(ends[offsets].tobytes()), spelt.buffers()[2]])
        if not ids.null_count:
            return joined
        place = np.cumsum(ids.is_valid().to_numpy(zero_copy_only=False)) - 1
        return joined.take(pa.array(place, mask=ids.is_null().to_numpy(zero_copy_only=False)))

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_lists(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


class _Packed(dict):
    """Memo: a match's ids as 4-byte integers. When it is full it becomes the
    older generation, whose matches come back when they are met again."""

    def __init__(self, coder: ByteBpe):
        super().__init__()
        self.coder = coder
        self.older: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        packed = self.older.pop(match, None)
        if packed is None:
            spelt = match.encode()
            whole = self.coder.ranks.get(spelt)
            ids = self.coder.encode_match(spelt.decode("latin-1")) if whole is None else (whole,)
            packed = struct.pack(f"<{len(ids)}i", *ids)
        if len(match) <= MEMO_BYTES:
            if len(self) >= MEMO_WORDS:
                self.older = dict(self)
                self.clear()
            self[match] = packed
        return packed


@functools.lru_cache(maxsize=2)
def _coder(blob: bytes, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(blob), pattern)


def _encoder(blob, pattern: str, at: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(blob.value, pattern)
        for batch in batches:
            packed = [coder.encode_packed(text) if text else b"" for text in batch.column(at).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
            yield append(batch, ids=pa.ListArray.from_arrays(pa.array(offsets), values))

    return encode


def _decoder(blob, pattern: str, at: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(blob.value, pattern)
        for batch in batches:
            yield append(batch, decoded=coder.decode_lists(batch.column(at)))

    return decode


def _ranks(df: DataFrame, ranks_path: str):
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>`` of the whole text, no special tokens."""
    docs = without(docs, "ids")
    fn = _encoder(_ranks(docs, ranks_path), pattern, docs.columns.index(text_col))
    return map_arrow(docs, fn, extended(docs, "ids array<int>"))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded binary``, the bytes of the ids."""
    encoded = without(encoded, "decoded")
    fn = _decoder(_ranks(encoded, ranks_path), pattern, encoded.columns.index(ids_col))
    return map_arrow(encoded, fn, extended(encoded, "decoded binary"))


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode and digest: ``id_col, n_tokens, ids_sha256, decoded_sha256``."""
    encoded = encode(docs.select(quoted(id_col), quoted(text_col)), ranks_path, pattern, text_col).drop(text_col)
    return decode(encoded, ranks_path, pattern).select(
        F.col(quoted(id_col)), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
