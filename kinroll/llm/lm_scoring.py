"""Pseudo-likelihood of documents under a bidirectional window network.

Tokens are lower-cased words: the corpus' frequent ones have an id each, the
others share hashed ids. The network predicts a masked token from the ``SIDE``
tokens on both of its sides: position-wise embeddings are summed and passed through
tanh; a Huffman tree over the ids' counts has a logistic unit at every inner node,
and an id's probability is the product of the turns on its path, so that all ids
sum to one and a token costs as many units as it has bits. A hashed id's probability
is divided among its words by their counts, and a word never counted scores like one
counted once. A document's score is the sum of its tokens' conditional log-probabilities.

The vocabulary grows with the corpus: a word has its own id from ``sqrt(tokens) /
SPREAD`` occurrences on, and the ``VOCABULARY - OTHER`` most frequent always have
one. Counts of the other words stay in their table.

A text is split into words once. Its task writes chunks of documents: the distinct
words, their counts, and the documents as places in that list. Word counts, both
rounds of training and scoring read these chunks, so that a word is looked up once a
chunk; the counts of a chunk's hashed words are joined to it word by word.

Training is numpy inside tasks and covers the whole corpus: word counts come
from all words; in each of ``ROUNDS`` rounds every task starts from the shared
weights, runs Adagrad over its documents' windows (one position in ``ROUNDS``,
the next one each round, so that every position is a target exactly once), and
the weights are averaged over tasks by windows seen. The scores therefore follow the
input's partitioning a little, as those of any averaged model do.
The model has about 330 bytes a word of the vocabulary and is broadcast; the
driver holds it and the vocabulary.

Defined cases: null and empty texts have no tokens, score 0 and a null mean; a
null id is scored like any other; rows that repeat are scored each; an empty
table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import cut, map_arrow, narrow

VOCABULARY = 1024     # ids, at least
OTHER = 128           # hashed ids for words outside the vocabulary, at least
SPREAD = 20
SIDE = 2
WIDTH = 16
ROUNDS = 2
BATCH = 4096
RATE = 0.5
FLUSH = 150_000       # distinct words a chunk, and the text that reaches them
TOKENS = 1 << 21      # tokens a chunk, and the text that reaches them
BLOCK = 4096          # parameters averaged together
OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]


def tokens_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _shrunk(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _whole(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte by byte: the high bytes are mostly zero."""
    return _shrunk(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_whole(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)


def _words(data: bytes) -> list[str]:
    return _whole(data).decode().split()


def _sent(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


CHUNKS = "chunk long, ids binary, sizes binary, places binary, words binary, counts binary"


def _encoder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of documents, one row each: their ids, their numbers of words, every
    word as a place among the chunk's distinct ones, and those with their counts."""
    def out() -> pa.RecordBatch:
        held = np.frombuffer(places, dtype=np.int32)
        counts = np.bincount(held, minlength=len(words))
        columns = [
            pa.array([chunk], pa.int64()),
            pa.array([_sent(pa.RecordBatch.from_arrays([pa.concat_arrays(ids)], names=["doc_id"]))], pa.binary()),
            pa.array([_packed(np.array(sizes))], pa.binary()), pa.array([_packed(held)], pa.binary()),
            pa.array([_shrunk(" ".join(words).encode())], pa.binary()), pa.array([_packed(counts)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "sizes", "places", "words", "counts"])

    def empty():
        words = defaultdict()
        words.default_factory = words.__len__
        return words, [], [], array("i")

    chunk = TaskContext.get().partitionId() << 32
    words, ids, sizes, places = empty()
    for batch in batches:
        start = 0
        for row, text in enumerate(batch.column(1).to_pylist(), 1):
            tokens = tokens_of(text)
            places.extend(map(words.__getitem__, tokens))
            sizes.append(len(tokens))
            if len(words) >= FLUSH or len(places) >= TOKENS:
                ids.append(batch.column(0).slice(start, row - start))
                yield out()
                chunk, start, (words, ids, sizes, places) = chunk + 1, row, empty()
        if start < batch.num_rows:
            ids.append(batch.column(0).slice(start))
    if sizes:
        yield out()


def encoded(docs: DataFrame, id_col: str | Column = "doc_id", text_col: str = "text") -> DataFrame:
    """The chunks of ``docs``, written once."""
    return cut(map_arrow(narrow(docs, doc_id=id_col, text=text_col), _encoder, CHUNKS))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per distinct word of every chunk, with its count there."""
    for batch in batches:
        for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(_words(words), pa.string()), pa.array(_unpacked(counts))], names=["word", "n"])


class _Ids:
    """Ids of words: frequent ones by rank, the rest hashed."""

    def __init__(self, words: list[str]):
        self.known = {w: i for i, w in enumerate(words)}
        self.first = first_hashed(len(words))

    def of(self, tokens: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.known.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
        rare = np.flatnonzero(ids < 0)
        hashes = [zlib.crc32(tokens[i].encode()) for i in rare.tolist()]
        ids[rare] = self.first + np.array(hashes, dtype=np.int64) % OTHER
        return ids


def first_hashed(words: int) -> int:
    return max(words, VOCABULARY - OTHER)


class Tree(NamedTuple):
    """The Huffman tree of the ids: leaves are ids, inner nodes follow, the root is last."""

    parent: np.ndarray    # of every node but the root
    right: np.ndarray     # whether a node is its parent's right child
    depth: np.ndarray     # of the leaves
    odds: np.ndarray      # log odds of the right child, per inner node, in the counts


def tree_of(counts: np.ndarray) -> Tree:
    """The tree of ids counted ``counts`` times, each once more. Leaves by count and
    inner nodes in the order of their making are two queues, each sorted."""
    n = len(counts)
    weight = [*(np.asarray(counts) + 1.0).tolist(), *[0.0] * (n - 1)]
    leaves = iter([*np.argsort(counts, kind="stable").tolist(), None])
    parent, right, odds = [0] * (2 * n - 2), [False] * (2 * n - 2), [0.0] * (n - 1)
    leaf, inner = next(leaves), n

    for made in range(n, 2 * n - 1):
        pair = []
        for _ in range(2):
            if leaf is not None and (inner == made or weight[leaf] <= weight[inner]):
                pair.append(leaf)
                leaf = next(leaves)
            else:
                pair.append(inner)
                inner += 1
        low, high = pair
        parent[low] = parent[high] = made
        right[high] = True
        weight[made] = weight[low] + weight[high]
        odds[made - n] = math.log(weight[high] / weight[low])
    depth = [0] * (2 * n - 1)
    for node in range(2 * n - 3, -1, -1):
        depth[node] = depth[parent[node]] + 1
    return Tree(np.array(parent), np.array(right), np.array(depth[:n]), np.array(odds))


def shapes(ids: int) -> dict[str, tuple]:
    return {"embed": (len(OFFSETS) * (ids + 1), WIDTH), "hidden": (WIDTH,), "turn": (ids - 1, WIDTH), "turn_bias": (ids - 1,)}


def size(ids: int) -> int:
    return sum(math.prod(s) for s in shapes(ids).values())


SIZE = size(VOCABULARY)


def ids_in(flat: np.ndarray) -> int:
    """The vocabulary of a flat vector, whose length is linear in it."""
    return (len(flat) - size(0)) // (size(1) - size(0))


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters as named arrays that share the flat vector's memory."""
    out, at = {}, 0
    for name, shape in shapes(ids_in(flat)).items():
        n = math.prod(shape)
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def initial(tree: Tree, seed: int = 11) -> np.ndarray:
    """Small random weights; the biases start at the corpus' token counts."""
    flat = np.random.default_rng(seed).normal(0, 0.1, size(len(tree.depth))).astype(np.float32)
    p = views(flat)
    p["turn_bias"][:] = tree.odds
    p["hidden"][:] = 0
    return flat


def contexts(ids: np.ndarray, at: np.ndarray | slice = slice(None), beyond: int = VOCABULARY) -> np.ndarray:
    """The neighbours of the positions ``at`` (all), ``beyond`` the last id past the ends."""
    ends = np.full(SIDE, beyond)
    padded = np.concatenate([ends, ids, ends])
    return np.stack([padded[SIDE + o:SIDE + o + len(ids)][at] for o in OFFSETS], axis=1)


def _rows(around: np.ndarray, ids: int) -> np.ndarray:
    """Rows of ``embed`` for contexts: each side's place has its own."""
    return around + np.arange(len(OFFSETS)) * (ids + 1)


def _forward(p: dict, rows: np.ndarray) -> np.ndarray:
    total = p["embed"].take(rows[:, 0], axis=0)
    for i in range(1, len(OFFSETS)):
        total += p["embed"].take(rows[:, i], axis=0)
    total += p["hidden"]
    return np.tanh(total, out=total)


def _turns(tree: Tree, targets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The inner nodes above the targets (deepest first), with whether the way down
    turns right: one step up a round, for the targets that are not yet at the root."""
    n, node = len(tree.depth), targets
    for left in len(targets) - np.searchsorted(tree.depth[targets][::-1], np.arange(1, tree.depth.max(initial=0) + 1)):
        if not left:
            return
        node = node[:left]
        right, node = tree.right.take(node), tree.parent.take(node)
        yield node - n, right


def log_probabilities(p: dict, tree: Tree, around: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Conditional log-probability of every target, a batch at a time."""
    out = np.empty(len(targets))
    for start in range(0, len(targets), BATCH):
        part = slice(start, start + BATCH)
        order = np.argsort(-tree.depth[targets[part]], kind="stable")
        h = _forward(p, _rows(around[part][order], len(tree.depth)))
        score = np.zeros(len(order))
        for node, right in _turns(tree, targets[part][order]):
            z = np.einsum("ij,ij->i", h[:len(node)], p["turn"].take(node, axis=0)) + p["turn_bias"].take(node)
            z[right] *= -1
            score[:len(node)] -= np.maximum(z, 0) + np.log(1 + np.exp(-np.abs(z)))
        out[start + order] = score
    return out


def _distinct(keys: np.ndarray, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the place of every key among them. ``scratch`` has an
    entry a possible key, of any content, so that nothing needs sorting."""
    places = np.arange(len(keys))
    scratch[keys] = places
    found = keys[scratch[keys] == places]
    scratch[found] = places[:len(found)]
    return found, scratch[keys]


def _adagrad(weights: np.ndarray, squares: np.ndarray, at: np.ndarray, grad: np.ndarray) -> None:
    """The update of the rows ``at``; those with no gradient do not move."""
    total = squares.take(at, axis=0)
    total += grad * grad
    squares[at] = total
    total += 1e-8
    np.sqrt(total, out=total)
    weights[at] = weights.take(at, axis=0) - RATE * grad / total


def _sums(place: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """Per place the sum of its entries in every column."""
    return np.stack([np.bincount(place, c, n) for c in columns], axis=1).astype(np.float32)


def step(flat: np.ndarray, squares: np.ndarray, around: np.ndarray, targets: np.ndarray, tree: Tree, scratch: np.ndarray) -> None:
    """One Adagrad step on a batch, in place; ``scratch`` has an entry a row of ``embed``."""
    p, q, n = views(flat), views(squares), len(targets)
    order = np.argsort(-tree.depth[targets], kind="stable")
    rows = _rows(around[order], len(tree.depth))
    h = _forward(p, rows)
    d_h, nodes, errors = np.zeros_like(h), [], []
    for node, right in _turns(tree, targets[order]):
        unit = p["turn"].take(node, axis=0)
        z = np.einsum("ij,ij->i", h[:len(node)], unit) + p["turn_bias"].take(node)
        error = (1 / (1 + np.exp(-z)) - right).astype(np.float32) / np.float32(n)
        unit *= error[:, None]
        d_h[:len(node)] += unit
        nodes.append(node)
        errors.append(error)
    d_sum = d_h * (1 - h * h)
    across = np.ascontiguousarray(h.T)
    found, place = _distinct(np.concatenate(nodes), scratch)
    error = np.concatenate(errors)
    pulls = (np.concatenate([e * column[:len(e)] for e in errors]) for column in across)
    _adagrad(p["turn"], q["turn"], found, _sums(place, pulls, len(found)))
    _adagrad(p["turn_bias"], q["turn_bias"], found, np.bincount(place, error, len(found)).astype(np.float32))
    _adagrad(p["hidden"], q["hidden"], np.arange(WIDTH), d_sum.sum(axis=0))
    found, place = _distinct(rows.T.ravel(), scratch)
    _adagrad(p["embed"], q["embed"], found, _sums(place, (np.tile(c, len(OFFSETS)) for c in d_sum.T), len(found)))


class Documents(NamedTuple):
    """Documents' words as ids, one after the other."""

    ids: np.ndarray
    sizes: np.ndarray

    def of_words(self) -> np.ndarray:
        """The document of every word."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def apart(self, doc: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids with ``SIDE`` times ``beyond`` between two documents, and where
        each now stands."""
        place = np.arange(len(self.ids)) + SIDE * doc
        out = np.full(len(self.ids) + SIDE * len(self.sizes), beyond)
        out[place] = self.ids
        return out, place


def _documents(batches: Iterator[pa.RecordBatch], ids_of: _Ids) -> Iterator[Documents]:
    """Documents of chunks, or of a column of texts."""
    for batch in batches:
        if batch.num_columns == 1:
            found = [ids_of.of(tokens_of(text)) for text in batch.column(0).to_pylist()]
            if found:
                yield Documents(np.concatenate(found), np.array([len(x) for x in found]))
            continue
        for sizes, places, words in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            yield Documents(ids_of.of(_words(words)).take(_unpacked(places)), _unpacked(sizes))


def _parts(targets: np.ndarray) -> Iterator[int]:
    """Each document's number of targets, in parts of ``BATCH``."""
    for n in targets.tolist():
        while n > BATCH:
            yield BATCH
            n -= BATCH
        if n:
            yield n


def _trainer(model, words, tree, round_no: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, seen = model.value.copy(), 0
        squares = np.full(len(flat), 1e-4, dtype=np.float32)
        ids_of, beyond = _Ids(words.value), ids_in(flat)
        scratch = np.empty(len(OFFSETS) * (beyond + 1), dtype=np.int64)
        around, targets, held = [], [], 0
        for docs in _documents(batches, ids_of):
            doc = docs.of_words()
            position = np.arange(len(doc)) - np.repeat(np.cumsum(docs.sizes) - docs.sizes, docs.sizes)
            at = np.flatnonzero(position % ROUNDS == round_no)
            apart, place = docs.apart(doc, beyond)
            near, wanted = contexts(apart, place[at], beyond), docs.ids[at]
            start = end = 0
            for n in _parts(np.bincount(doc[at], minlength=len(docs.sizes))):
                end, held = end + n, held + n
                if held >= BATCH:
                    around.append(near[start:end])
                    targets.append(wanted[start:end])
                    step(flat, squares, np.concatenate(around), np.concatenate(targets), tree.value, scratch)
                    seen, start, around, targets, held = seen + held, end, [], [], 0
            around.append(near[start:end])
            targets.append(wanted[start:end])
        if held:
            step(flat, squares, np.concatenate(around), np.concatenate(targets), tree.value, scratch)
            seen += held
        if seen:
            blocks = [flat[i:i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([seen] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())],
                names=["block", "windows", "part"])

    return train


def _mean_block(rows: pa.Table) -> pa.Table:
    windows = rows["windows"].to_numpy()
    mean = sum(n * np.frombuffer(part.as_py(), dtype=np.float32).astype(np.float64) for n, part in zip(windows, rows["part"], strict=True)) / windows.sum()
    return pa.table({"block": rows["block"][:1], "part": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


class WindowModel:
    """Vocabulary, tree and weights, shared with the executors; the table of word
    counts and their sums per hashed id."""

    def __init__(self, words, tree, weights, counts: DataFrame, held):
        self.words, self.tree, self.weights, self.counts, self.held = words, tree, weights, counts, held


def fit(docs: DataFrame, text_col: str = "text") -> WindowModel:
    return _fitted(encoded(docs, F.lit(None).cast("int"), text_col))


def _fitted(chunks: DataFrame) -> WindowModel:
    """Count all words, then train over the whole corpus by weight averaging.
    The driver receives the vocabulary's words, counts per hashed id and one
    averaged model a round."""
    sc = chunks.sparkSession.sparkContext
    counts = cut(map_arrow(chunks.select("words", "counts"), _counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    tokens = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranked = [F.desc("n"), "word"]
    frequent = counts.filter(F.col("n") >= math.sqrt(tokens) / SPREAD).orderBy(*ranked).collect()
    if len(frequent) < VOCABULARY - OTHER:
        frequent = counts.orderBy(*ranked).limit(VOCABULARY - OTHER).collect()
    first = first_hashed(len(frequent))
    held = np.zeros(first + OTHER)
    for r in counts.groupBy((F.crc32(F.col("word").cast("binary")) % OTHER).cast("int").alias("id")).agg(F.sum("n").alias("n")).collect():
        held[first + r["id"]] = r["n"]
    for rank, r in enumerate(frequent):
        held[rank] = r["n"]
        held[first + zlib.crc32(r["word"].encode()) % OTHER] -= r["n"]
    built = tree_of(held)
    words, tree, weights = sc.broadcast([r["word"] for r in frequent]), sc.broadcast(built), initial(built)
    for round_no in range(ROUNDS):
        trained = map_arrow(chunks.select("sizes", "places", "words"), _trainer(sc.broadcast(weights), words, tree, round_no), "block int, windows long, part binary")
        weights = weights.copy()
        for r in trained.groupBy("block").applyInArrow(_mean_block, "block int, part binary").collect():
            part = np.frombuffer(r["part"], dtype=np.float32)
            weights[r["block"] * BLOCK:r["block"] * BLOCK + len(part)] = part
    return WindowModel(words, tree, sc.broadcast(weights), counts, sc.broadcast(held))


def _hashed(words):
    """A row per distinct word of every chunk that is not in the vocabulary."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(words.value)
        for batch in batches:
            for chunk, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rare = [(place, word) for place, word in enumerate(_words(found)) if word not in known]
                columns = [pa.array(np.full(len(rare), chunk)), pa.array([x for x, _ in rare], pa.int32()), pa.array([x for _, x in rare], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "place", "word"])

    return rows


def _scorer(words, tree, weights, held):
    """Per chunk the scores of its documents, without the hashed words' own counts,
    and its hashed words as places among the chunk's words."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = views(weights.value)
        ids_of, beyond = _Ids(words.value), ids_in(weights.value)
        shares = np.log(np.maximum(held.value, 1))
        shares[:ids_of.first] = 0
        for batch in batches:
            for row, docs in enumerate(_documents(iter([batch.select(["c2", "c3", "c4"])]), ids_of)):
                doc, logs = docs.of_words(), np.empty(len(docs.ids))
                apart, place = docs.apart(doc, beyond)
                for part in (slice(i, i + 128 * BATCH) for i in range(0, len(doc), 128 * BATCH)):
                    logs[part] = log_probabilities(p, tree.value, contexts(apart, place[part], beyond), docs.ids[part])
                logs -= shares.take(docs.ids)
                sums = np.bincount(doc, logs, len(docs.sizes)).astype(float)  # without words: whole numbers
                at = docs.ids >= ids_of.first
                ids = pa.ipc.open_stream(batch.column(1)[row].as_py()).read_next_batch().column(0)
                scores = pa.RecordBatch.from_arrays([ids, pa.array(docs.sizes), pa.array(sums)], names=["doc_id", "n_tokens", "log_likelihood"])
                places, sizes = _unpacked(batch.column(3)[row].as_py())[at], np.bincount(doc[at], minlength=len(docs.sizes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), *(pa.array([x], pa.binary()) for x in (_sent(scores), _packed(sizes), _packed(places)))],
                    names=["chunk", "scores", "sizes", "places"])

    return score


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the counts of the hashed words to the scores of their chunk; rows come in
    the order of chunks, the chunk's scores first, then the words counted twice or more."""
    def done():
        shares = np.zeros(int(places.max(initial=-1)) + 1)
        for place, n in counted:
            inside = place < len(shares)
            shares[place[inside]] = np.log(n[inside])
        doc = np.repeat(np.arange(len(sizes)), sizes)
        sums = scores.column(2).to_numpy() + np.bincount(doc, shares.take(places), len(sizes))
        return pa.RecordBatch.from_arrays([*scores.columns[:2], pa.array(sums)], names=scores.schema.names)

    open_chunk, scores, counted = None, None, []
    for batch in batches:
        chunks, place, n = (batch.column(i).fill_null(-1).to_numpy() for i in range(3))
        edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)] if len(chunks) else [0]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if chunks[start] != open_chunk:
                if scores is not None:
                    yield done()
                scores = pa.ipc.open_stream(batch.column(3)[start].as_py()).read_next_batch()
                sizes, places = (_unpacked(batch.column(i)[start].as_py()) for i in (4, 5))
                open_chunk, counted, start = chunks[start], [], start + 1
            counted.append((place[start:end], n[start:end]))
    if scores is not None:
        yield done()


def pseudo_likelihood(docs: DataFrame, model: WindowModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_prob`` of every whole text."""
    return _chunk_scores(encoded(docs, id_col, text_col), model, docs.schema[id_col].dataType.simpleString())


def _chunk_scores(chunks: DataFrame, model: WindowModel, id_type: str) -> DataFrame:
    scored_chunks = map_arrow(
        chunks.drop("counts"), _scorer(model.words, model.tree, model.weights, model.held),
        "chunk long, scores binary, sizes binary, places binary")
    hashed = map_arrow(chunks.select("chunk", "words"), _hashed(model.words), "chunk long, place int, word string")
    counted = hashed.join(model.counts.filter("n > 1"), "word").select("chunk", "place", "n")
    rows = scored_chunks.withColumn("place", F.lit(-1)).unionByName(counted, allowMissingColumns=True)
    ordered = rows.select("chunk", "place", "n", "scores", "sizes", "places").repartition("chunk").sortWithinPartitions("chunk", "place")
    return map_arrow(ordered, _summer, f"doc_id {id_type}, n_tokens long, log_likelihood double").withColumn(
        "mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    chunks = encoded(docs, id_col, text_col)
    return _chunk_scores(chunks, _fitted(chunks), docs.schema[id_col].dataType.simpleString())
