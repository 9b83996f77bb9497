"""Exact dedup over an extendible-hash index.

1. The scan hashes every normalised text (white space deleted) to 64 bits; the
   distinct keys are counted per leading bits, and the **directory** doubles
   until no bucket holds more bytes than a page (or the bits run out).
2. Every map task combines equal texts of a batch into one **entry** (the row
   that would stay, and a count), so a group of copies that holds a third of
   all rows ships one entry per batch.
3. **Owner tasks** take one bucket, i.e. one key range, each: entries sorted by
   key stream past, texts with the same key form a collision chain, and a text
   joins a member of its chain only if all normalised bytes are equal.
4. The owners' pages are the index, written to the shared checkpoint folder.

Memory: one Arrow batch and the chain of one key per task. The directory is an
array of at most ``2 ** MAX_DEPTH`` small integers, whatever the input size.

Defined cases: a null text is the empty text; rows that agree in text and id
are one document (they share its verdict; ``dedup`` returns one of them); a
null id counts as larger than any other; an empty table gives an empty result;
other columns, of whatever name, only ride along (``dedup``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import WHITE, WHITE_BYTES, append, cut, extended, map_arrow, quoted, to_arrow

MAX_DEPTH = 16
PAGE_BYTES = 16 * 1024 * 1024
INDEX = "text_sha256 string, group_size long, keep_id {id}"


def normal_text(text_col: str) -> Column:
    """The text without its white space, null as empty (JVM expression)."""
    return F.translate(F.coalesce(F.col(quoted(text_col)), F.lit("")), WHITE, "")


def text_key(normal: bytes) -> int:
    return xxhash.xxh64_intdigest(normal)


@dataclass(frozen=True)
class Directory:
    """``slots[leading depth bits of a key]`` is the bucket that owns it."""

    depth: int
    slots: np.ndarray
    buckets: int

    @classmethod
    def build(cls, weights: np.ndarray, capacity: int) -> Directory:
        """``weights``: bytes per key prefix of ``log2(len(weights))`` bits.
        Start with one bucket; split every overfull one by its next bit, and
        double the directory whenever a bucket's own depth would exceed it."""
        limit = int(len(weights)).bit_length() - 1
        total = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
        depth, leaves, work = 0, [], [(0, 0)]  # (own depth, prefix)
        while work:
            own, prefix = work.pop()
            span = limit - own
            held = total[(prefix + 1) << span] - total[prefix << span]
            if held > capacity and own < limit:
                work += [(own + 1, 2 * prefix), (own + 1, 2 * prefix + 1)]
                depth = max(depth, own + 1)
            else:
                leaves.append((prefix << span, own))
        slots = np.zeros(1 << depth, dtype=np.int32)
        for bucket, (start, own) in enumerate(sorted(leaves)):
            first = start >> (limit - depth)
            slots[first:first + (1 << (depth - own))] = bucket
        return cls(depth, slots, len(leaves))

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        if not self.depth:
            return np.zeros(len(keys), dtype=np.int32)
        return self.slots[(keys >> np.uint64(64 - self.depth)).astype(np.int64)]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[int, int] = {}
        for text in batch.column(0).to_pylist():
            normal = text.translate(None, WHITE_BYTES) if text else b""
            seen[text_key(normal)] = len(normal) + 64
        keys = np.fromiter(seen, dtype=np.uint64, count=len(seen))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(list(seen.values()), pa.int64())], names=["key", "bytes"])


def directory_of(docs: DataFrame, text_col: str = "text", page_bytes: int = PAGE_BYTES) -> Directory:
    """Count the distinct keys' bytes per prefix, then split and double."""
    keys = map_arrow(docs.select(F.col(quoted(text_col)).cast("binary")), _keys, "key long, bytes long")
    per_prefix = (
        keys.groupBy("key").agg(F.max("bytes").alias("bytes"))
        .groupBy(F.shiftrightunsigned("key", 64 - MAX_DEPTH).alias("prefix"))
        .agg(F.sum("bytes").alias("bytes")).toPandas()  # 2 ** MAX_DEPTH rows at most
    )
    weights = np.zeros(1 << MAX_DEPTH, dtype=np.int64)
    weights[per_prefix["prefix"].to_numpy(np.int64)] = per_prefix["bytes"].to_numpy(np.int64)
    return Directory.build(weights, page_bytes)


def _rank(chars: int, doc_id) -> tuple:
    """Smaller is better: more code points, then the smaller id, null last."""
    return (-chars, doc_id is None, doc_id if doc_id is not None else 0)


def _combiner(directory: Directory, id_at: int, text_at: int):
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(id_at).to_pylist()
            best: dict[bytes, list] = {}
            for row, text in enumerate(batch.column(text_at).to_pylist()):
                text = text or ""
                normal = text.encode().translate(None, WHITE_BYTES)
                rank = _rank(len(text), ids[row])
                entry = best.get(digest := hashlib.sha256(normal).digest())
                if entry is None:
                    best[digest] = [row, rank, 1, text_key(normal)]
                else:
                    entry[2] += 1
                    if rank < entry[1]:
                        entry[0], entry[1] = row, rank
            keys = np.fromiter((e[3] for e in best.values()), dtype=np.uint64, count=len(best))
            yield append(
                batch.take(pa.array([e[0] for e in best.values()], pa.int64())),
                _key=keys.view(np.int64), _bucket=directory.bucket_of(keys),
                _n=pa.array([e[2] for e in best.values()], pa.int64()),
            )

    return combine


class _Chain:
    """The distinct texts of one key: normalised bytes, count, best row."""

    def __init__(self):
        self.members: list[list] = []

    def add(self, normal: bytes, n: int, rank: tuple, row) -> None:
        for member in self.members:
            if member[0] == normal:
                member[1] += n
                if rank < member[2]:
                    member[2], member[3] = rank, row
                return
        self.members.append([normal, n, rank, row])


def _owner(id_at: int, text_at: int, width: int, schema: pa.Schema):
    def emit(members: list[list]) -> pa.RecordBatch:
        rows = pa.concat_tables([pa.Table.from_batches([m[3]]) for m in members]).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([
            *[c.cast(f.type) for c, f in zip(rows.columns, schema, strict=False)],
            pa.array([hashlib.sha256(m[0]).hexdigest() for m in members]),
            pa.array([m[1] for m in members], pa.int64()),
            rows.column(id_at).cast(schema.field(width + 2).type),
        ], schema=schema)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, chain = None, _Chain()
        for batch in batches:
            kept = batch.select(range(width))
            keys, counts = batch.column(width).to_pylist(), batch.column(width + 2).to_pylist()
            ids, done = kept.column(id_at).to_pylist(), []
            for row, text in enumerate(kept.column(text_at).to_pylist()):
                if keys[row] != open_key:
                    done += chain.members
                    open_key, chain = keys[row], _Chain()
                text = text or ""
                chain.add(text.encode().translate(None, WHITE_BYTES), counts[row], _rank(len(text), ids[row]),
                          kept.slice(row, 1))
            for member in chain.members:  # the open chain outlives its batch: keep copies of its rows only
                member[3] = member[3].take(pa.array([0]))
            if done:
                yield emit(done)
        if chain.members:
            yield emit(chain.members)

    return own


def hash_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_bytes: int = PAGE_BYTES) -> DataFrame:
    """One row per distinct normalised text: the columns of the row that stays,
    as ``c0, c1, ...`` in their order, and ``text_sha256``, ``group_size``,
    ``keep_id``."""
    id_at, text_at, width = docs.columns.index(id_col), docs.columns.index(text_col), len(docs.columns)
    directory = directory_of(docs, text_col, page_bytes)
    docs = docs.toDF(*[f"c{i}" for i in range(width)])
    entries = map_arrow(docs, _combiner(directory, id_at, text_at), extended(docs, "_key long, _bucket int, _n long"))
    owned = entries.repartitionById(directory.buckets, F.col("_bucket")).sortWithinPartitions("_key")
    schema = extended(docs, INDEX.format(id=docs.schema[id_at].dataType.simpleString()))
    return map_arrow(owned, _owner(id_at, text_at, width, to_arrow(schema)), schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_bytes: int = PAGE_BYTES) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    kept = hash_index(docs, id_col, text_col, page_bytes)
    return kept.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_bytes: int = PAGE_BYTES) -> DataFrame:
    """Every row's group: ``id_col``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``. The pages stay in the shared folder and are looked up by
    digest; the join is a plain one, so Spark splits the hot group's rows."""
    pages = cut(hash_index(docs.select(quoted(id_col), quoted(text_col)), id_col, text_col, page_bytes)
                .select("text_sha256", "group_size", "keep_id"))
    rows = docs.select(F.col(quoted(id_col)), F.sha2(normal_text(text_col), 256).alias("text_sha256"))
    return rows.join(pages, "text_sha256").select(
        F.col(quoted(id_col)), "keep_id", "group_size",
        F.col(quoted(id_col)).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )
