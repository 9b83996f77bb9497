"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is the set of its distinct five-word shingles (a shorter one is a
single shingle of all its words). Documents are linked when
``100 * |intersection| >= 75 * |union|``; classes are the links' components.

1. Equal word sequences are one **class**, represented by its smallest id.
2. The **sketch** keeps the ``K`` smallest shingle hashes. Two linked documents
   share at least ``need`` retained values (all but a tail of ``MISS`` of the
   binomial law; exactly for sets that fit into a sketch). With the values in
   one order, rarest first, they therefore share one of the first
   ``size - need + 1``: only those go into the **inverted lists**. What many
   documents have in common (passages, boilerplate) is frequent, comes last and
   mostly stays out.
3. Every list has a **hub**, its smallest id. Members of all lists of one hub
   are the hub's group, so documents that share a listed value are in a common
   group. Each member is compared with the hub: the union's sketch estimates the
   similarity, the full sets confirm it.
4. Members that did not match their hub may still match each other. Their groups
   are cut into blocks of bounded size, and **all pairs of blocks** pass a sieve
   first, on sketches: a link implies ``need`` shared retained values (as above)
   and sizes within the similarity. Only members that have such a partner go on,
   with their full sets, into the pair of blocks where the partner is; there the
   sets are compared exactly, as products of block matrices inside tasks, and the
   links of a spanning forest come out. No pair is left out and none is emitted
   for itself: a member that resembles nobody ships its sketch, never its set.

Sets are compared by 64-bit shingle hashes (numpy, mixed from 64-bit word
hashes).

Defined cases: a document without words has no shingle and is its own class;
rows that repeat an id count as one document; a null id takes no part and has a
null class; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import cut, map_arrow, mix64, narrow, quoted, text_bytes
from kinroll.llm.components import components

WORDS = 5
K = 64
PERCENT = 75
MISS = 1e-9
BLOCK_SHINGLES = 32_768
COLUMNS = 4096
MEMO = 100_000

_FACTORS = mix64(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def _tail_need(k: int, share: float, miss: float) -> int:
    """The largest count that a binomial of ``k`` trials stays under with
    probability ``miss`` at most."""
    total = 0.0
    for hits in range(k + 1):
        total += math.comb(k, hits) * share ** hits * (1 - share) ** (k - hits)
        if total > miss:
            return hits
    return k


NEED = _tail_need(K, PERCENT / 100, MISS)


class _WordHashes(dict):
    """Memo of word hashes, emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_word_hashes = _WordHashes()


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z and ASCII white space only


def shingles(words: list[bytes], size: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes (signed) of a word sequence."""
    if not words:
        return np.zeros(0, dtype=np.int64)
    hashed = np.fromiter(map(_word_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(size, len(words))
    n = len(words) - span + 1
    total = np.full(n, span, dtype=np.uint64)
    for i in range(span):
        total = total + mix64(hashed[i:i + n]) * _FACTORS[i]
    return np.unique(mix64(total).view(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes, sketches = [], [], []
        for text in batch.column(1).to_pylist():
            words = words_of(text)
            found = shingles(words)
            keys.append(hashlib.md5(b" ".join(words), usedforsecurity=False).digest())
            sizes.append(len(found))
            sketches.append(found[:K])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(sketches, pa.list_(pa.int64()))], names=["doc_id", "words_key", "n", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
            sets = [shingles(words_of(text)) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "hashes"])


def _needed(n: Column) -> Column:
    """Shared retained values that a link implies for a set of ``n``. Up to
    ``0.75 * K`` both sketches are whole sets."""
    return F.when(n <= K * PERCENT // 100, F.ceil(n * PERCENT / 100)).otherwise(F.lit(NEED)).cast("int")


def inverted_lists(nodes: DataFrame) -> DataFrame:
    """``(value, rep)``: the rarest retained values of every sketch, without
    values of one document. A sketch holds ``K`` values, so its list is short."""
    postings = nodes.select("rep", "n", F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    per_doc = (
        postings.join(shared, "value").groupBy("rep")
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
        .withColumn("listed", F.size("values") - _needed(F.col("n")) + 1)
        .filter("listed > 0")
    )
    return per_doc.select("rep", F.explode(F.slice("values", 1, F.col("listed"))["value"]).alias("value"))


def _linked(a: str, b: str) -> Column:
    """Estimate from the union's sketch, then the exact rule on full sets."""
    low = lambda c: F.slice(c, 1, K)
    union = F.slice(F.array_sort(F.array_union(low(a), low(b))), 1, K)
    seen = F.size(F.array_intersect(F.array_intersect(union, low(a)), low(b)))
    estimate = F.when(F.size(union) < K, seen * 100 >= F.size(union) * PERCENT).otherwise(seen >= NEED)
    both = F.size(F.array_intersect(a, b))
    return estimate & (both * 100 >= (F.size(a) + F.size(b) - both) * PERCENT)


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``.

    Counted exactly: the shared hashes are the columns of a 0/1 matrix,
    multiplied a chunk of columns at a time."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.flatnonzero(counts > 1)
    place = np.full(len(values), -1)
    place[common] = np.arange(len(common))
    at = place[column]
    rows, at = rows[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, len(common), COLUMNS):
        lo, hi = np.searchsorted(at, [first, first + COLUMNS])
        member = np.zeros((len(sets), min(COLUMNS, len(common) - first)), dtype=np.float32)
        member[rows[lo:hi], at[lo:hi] - first] = 1
        both += member[left] @ member[right].T
    return both.astype(np.int64)


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = np.flatnonzero(side == 0)
    return left, np.flatnonzero(side == 1) if (side == 1).any() else left


def block_links(reps: np.ndarray, sets: list[np.ndarray], side: np.ndarray, skip: np.ndarray) -> list[tuple[int, int]]:
    """Links among one block (``side`` all 0) or across two blocks (0 and 1),
    as a spanning forest. ``skip``: members known to be linked to each other."""
    sizes = np.array([len(s) for s in sets])
    left, right = _sides(side)
    shared = overlaps(sets, left, right)
    ok = shared * 100 >= (sizes[left][:, None] + sizes[right][None, :] - shared) * PERCENT
    ok &= ~(skip[left][:, None] & skip[right][None, :])
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(ok), strict=True):
        a, b = int(left[i]), int(right[j])
        if root(a) != root(b):
            parent[root(a)] = root(b)
            links.append((int(reps[a]), int(reps[b])))
    return links


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    links = block_links(group["rep"].to_numpy(), list(group["hashes"]), group["side"].to_numpy(),
                        group["linked"].to_numpy(dtype=bool))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def possible_pairs(sketches: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Places ``(i, j)`` of the members that may be linked: those that share the
    retained values and have the sizes which a link implies."""
    left, right = _sides(side)
    need = np.where(sizes <= K * PERCENT // 100, -(-sizes * PERCENT // 100), NEED)  # as in _needed
    one, other = sizes[left][:, None], sizes[right][None, :]
    ok = overlaps(sketches, left, right) >= np.maximum(need[left][:, None], need[right][None, :])
    ok &= np.minimum(one, other) * 100 >= np.maximum(one, other) * PERCENT
    ok &= ~(skip[left][:, None] & skip[right][None, :])
    i, j = np.nonzero(ok)
    pairs = np.stack([left[i], right[j]], axis=1)
    return pairs[pairs[:, 0] != pairs[:, 1]]


def _sieve(group: pd.DataFrame) -> pd.DataFrame:
    """The members with possible partners, once per pair of parts they share."""
    pairs = possible_pairs(list(group["sketch"]), group["n"].to_numpy(), group["side"].to_numpy(),
                           group["linked"].to_numpy(dtype=bool))
    member, partner = np.concatenate([pairs, pairs[:, ::-1]]).T
    part = group["part"].to_numpy()
    rows = np.unique(np.stack([member, np.minimum(part[member], part[partner]), np.maximum(part[member], part[partner])], axis=1), axis=0)
    member, lo, hi = rows.T
    return pd.DataFrame({
        "hub": group["hub"].to_numpy()[member], "rep": group["rep"].to_numpy()[member],
        "linked": group["linked"].to_numpy(dtype=bool)[member], "lo": lo, "hi": hi, "side": (part[member] > lo).astype(np.int32)})


def possible_members(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``(hub, rep, linked, lo, hi, side)``: the members of groups that are not
    all linked to their hub, for every pair of parts of the group in which they
    have a possible partner. A block holds ``BLOCK_SHINGLES`` retained values, and
    each of its parts about as many shingles. A member goes once to every pair of
    blocks that its block is in; sketches are added after that, so a large
    group's rows never meet in one task."""
    known = sets.select("rep", F.size("hashes").cast("long").alias("n"))
    groups = (
        members.join(known, "rep").groupBy("hub")
        .agg(F.sum("n").alias("total"), F.sum(F.least("n", F.lit(K))).alias("kept"), F.count("*").alias("members"),
             F.bool_and("linked").alias("done"))
        .filter("members > 1 and not done")
        .select("hub", F.ceil(F.col("kept") / BLOCK_SHINGLES).alias("blocks"), F.ceil(F.col("total") / BLOCK_SHINGLES).alias("total"))
        .select("hub", "blocks", F.ceil(F.col("total") / F.col("blocks")).alias("parts"))
    )
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    pairs = (
        members.join(groups, "hub").withColumn("block", block)
        .withColumn("part", F.col("block") * F.col("parts") + F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("hub", "rep", "linked", "part", F.least("block", "other").alias("lo"),
                F.greatest("block", "other").alias("hi"), (F.col("block") > F.col("other")).cast("int").alias("side"))
        .join(sets.select("rep", F.size("hashes").cast("long").alias("n"), F.slice("hashes", 1, K).alias("sketch")), "rep")
    )
    return pairs.groupBy("hub", "lo", "hi").applyInPandas(_sieve, "hub long, rep long, linked boolean, lo long, hi long, side int")


def _block_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the members of groups that are not all linked to their hub,
    on the full sets of those with possible partners."""
    pairs = possible_members(members, sets).join(sets, "rep")
    return pairs.groupBy("hub", "lo", "hi").applyInPandas(_compare, "a long, b long")


def near_links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between representatives, enough to span every class."""
    lists = cut(inverted_lists(nodes))
    hubs = lists.groupBy("value").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = cut(lists.join(hubs, "value").filter("rep <> hub").select("hub", "rep").distinct())
    wanted = members.select("rep").union(members.select("hub")).distinct()
    sets = cut(map_arrow(docs.join(wanted, docs["doc_id"] == wanted["rep"], "left_semi"), _sets, "rep long, hashes array<long>"))
    against = members.join(sets, "rep").withColumnRenamed("hashes", "own").join(
        sets.select(F.col("rep").alias("hub"), "hashes"), "hub")
    tested = cut(against.select("hub", "rep", _linked("own", "hashes").alias("linked")))
    return tested.filter("linked").select(F.col("hub").alias("a"), F.col("rep").alias("b")).unionByName(
        _block_pairs(tested, sets))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    texts = narrow(docs, doc_id=F.col(quoted(id_col)).cast("long"), text=text_bytes(text_col))
    found = cut(map_arrow(texts, _signatures, "doc_id long, words_key binary, n long, sketch array<long>"))
    nodes = (
        found.filter("n > 0 and doc_id is not null").groupBy("words_key")
        .agg(F.min(F.struct("doc_id", "n", "sketch")).alias("first"))
        .select("words_key", F.col("first.doc_id").alias("rep"), "first.n", "first.sketch")
    )
    linked = components(near_links(texts, nodes))
    classes = nodes.select("words_key", "rep").join(linked, F.col("rep") == F.col("node"), "left").select(
        "words_key", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("n") > 0, F.col("component"))
    return (
        found.select("doc_id", "words_key", "n").join(classes, "words_key", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce(own, F.col("doc_id"))))
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class (its smallest id). Documents
    without an id stay."""
    columns = [f"_{i}" for i in range(len(docs.columns))]  # the table's own names clash with nothing then
    plain = docs.toDF(*columns)
    key, text = columns[docs.columns.index(id_col)], columns[docs.columns.index(text_col)]
    dropped = near_duplicates(plain, key, text).filter("not kept").select(F.col("doc_id").alias("dropped")).distinct()
    return plain.join(dropped, F.col(key).cast("long") == F.col("dropped"), "left_anti").toDF(*docs.columns)
