"""Periodic runs of words: stretches in which a passage repeats end to end.

A **run** is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends, ``min_length`` words and ``min_exponent`` periods long
at least. Documents are searched in their Arrow batches, all documents of a batch
in one set of arrays (no suffix of one is ever compared with one of another):

1. **Suffix array** by prefix doubling over the words' numbers. A round sorts
   only what is still undecided; the ranks of every round are kept.
2. **LCP** of neighbouring suffixes from those ranks, by binary descent.
3. **LCP intervals** ``[lb, rb)`` of depth ``d`` from one pass with a stack. No
   tree is built: an interval is its borders, its children lie between the
   places where the LCP is ``d`` again.
4. **Branching tandem test**: a square ``ww`` with ``|w| = d`` that the next word
   breaks starts at ``i`` if and only if the suffixes ``i`` and ``i + d`` are in
   different children of such an interval. All children but the largest ask for
   each of their suffixes ``i`` whether ``ISA[i + d]`` or ``ISA[i - d]`` is in the
   interval and outside the child: O(n log n) look-ups in all.
5. **Rotation**: a run holds one such square per period, at its right end. It is
   rotated to the left word by word (in growing strides) while the words agree,
   which gives the run's start; of squares with one right end, the multiples of a
   period whose run covers them are the same run and merge into it.

Only intervals of ``min_exponent`` suffixes or more are tested: a run's passage
begins at least that often. Nothing is shuffled, a document is one row, and a
task holds one Arrow batch, and the arrays of ``WORDS`` of its words (or of one
document, if longer): a rank per word and doubling round, and some twenty numbers.

Defined cases: a null text has no words, like an empty one; white space is
[\\x20\\x09-\\x0D], whatever else there is belongs to words and is compared as it
is; a document without runs has null run columns, the digest of the empty string
for its runs and all its words kept; repeated rows and null ids are rows like any
other (a null id is never rewritten); other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import map_arrow, narrow, text_bytes, to_arrow

MIN_LENGTH = 6
MIN_EXPONENT = 4
STRIDE = 4096
WORDS = 400_000

Rewrite = Callable[[list[bytes], object], list[bytes]]


def echo_tail(words: list[bytes], doc_id) -> list[bytes]:
    """For one id in ten (by its CRC) the words from a place on repeat the first
    ``p`` of them to the end; place and ``p`` follow from the CRC too."""
    crc = zlib.crc32(str(doc_id).encode())
    g, n = crc // 10, len(words)
    if doc_id is None or crc % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def suffix_order(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of all documents, each by itself, and the ranks after every
    doubling round (a suffix's rank is the place of the first with its prefix)."""
    n = len(codes)
    order = np.lexsort((codes, starts))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (codes[order[1:]] != codes[order[:-1]]) | (starts[order[1:]] != starts[order[:-1]])
    heads = np.flatnonzero(fresh)
    ranks = np.full(n + 1, -1, dtype=np.int64)
    ranks[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels, sa = [ranks], order.copy()
    open_ = sa[np.repeat(np.diff(np.append(heads, n)) > 1, np.diff(np.append(heads, n)))]
    h = 1
    while len(open_):
        old = ranks[open_]
        after = open_ + h
        key = old * (n + 1) + np.where(after < ends[open_], ranks[np.minimum(after, n)], -1) + 1
        by = np.argsort(key, kind="stable")
        open_, key, old = open_[by], key[by], old[by]
        place = np.arange(len(open_))
        split = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
        sub = np.flatnonzero(split)
        sizes = np.diff(np.append(sub, len(open_)))
        ranks = ranks.copy()
        ranks[open_] = np.repeat(old[sub] + sub - group[sub], sizes)
        sa[old + place - group] = open_
        levels.append(ranks)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        h *= 2
    return sa, levels


def shared_prefixes(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """``lcp[t]``: words that the suffixes ``sa[t - 1]`` and ``sa[t]`` share."""
    lcp = np.zeros(len(sa), dtype=np.int64)
    pairs, nested = np.arange(1, len(sa)), []
    for ranks in levels:
        pairs = pairs[ranks[sa[pairs - 1]] == ranks[sa[pairs]]]
        nested.append(pairs)
    for k in reversed(range(len(levels))):
        pairs = nested[k]
        x, y = sa[pairs - 1] + lcp[pairs], sa[pairs] + lcp[pairs]
        more = levels[k][np.minimum(x, len(sa))] == levels[k][np.minimum(y, len(sa))]
        lcp[pairs[more]] += 1 << k
    return lcp


def interval_borders(lcp: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``places`` (ascending, whole groups of suffixes that share
    their first word, each group's first place with LCP 0): the last place before
    it with a smaller LCP, the next with a smaller one, the next not greater."""
    n = len(lcp)
    before, below = np.full(n + 1, -1, dtype=np.int64), np.full(n + 1, n, dtype=np.int64)
    stack: list[int] = []
    depth: list[int] = []
    left: list[int] = []
    ended: list[int] = []
    ended_at: list[int] = []
    for t, d in zip(places.tolist(), lcp[places].tolist(), strict=True):
        while depth and depth[-1] >= d:
            depth.pop()
            ended.append(stack.pop())
            ended_at.append(t)
        left.append(stack[-1] if stack else -1)
        stack.append(t)
        depth.append(d)
    before[places] = left
    below[ended] = ended_at
    smaller = below.copy()
    depths = np.append(lcp, -1)
    equal = places[depths[smaller[places]] == depths[places]]
    while len(equal):
        smaller[equal] = smaller[smaller[equal]]
        equal = equal[depths[smaller[equal]] == depths[equal]]
    return before[places], smaller[places], below[places]


def branching_squares(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, period)`` of every square that the word after it breaks, of those
    whose passage begins ``least`` times at least."""
    n, none = len(codes), np.zeros(0, dtype=np.int64)
    sa, levels = suffix_order(codes, starts, ends)
    isa = np.empty(n, dtype=np.int64)
    isa[sa] = np.arange(n)
    lcp = shared_prefixes(sa, levels)
    heads = np.flatnonzero(lcp == 0)
    sizes = np.diff(np.append(heads, n))
    listed = np.append(np.repeat(sizes >= least, sizes), False)
    listed[1:] |= listed[:-1]  # and where a group ends
    places = np.flatnonzero(listed[:n])
    if not len(places):
        return none, none
    lb, rb, child_end = interval_borders(lcp, places)
    tested = (lcp[places] > 0) & (rb - lb >= least)
    at, lb, rb, child_end = places[tested], lb[tested], rb[tested], child_end[tested]
    if not len(at):
        return none, none
    by = np.lexsort((at, rb, lb))
    at, lb, rb, child_end = at[by], lb[by], rb[by], child_end[by]
    first = np.flatnonzero(np.append(True, (lb[1:] != lb[:-1]) | (rb[1:] != rb[:-1])))
    # children of an interval: from each place with its LCP to the next, and the one before the first
    own = np.concatenate([np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at)))), np.arange(len(first))])
    begin, end = np.concatenate([at, lb[first]]), np.concatenate([child_end, at[first]])
    by = np.lexsort((begin - end, own))  # the largest child of each interval first
    own, begin, end = own[by], begin[by], end[by]
    largest = np.append(True, own[1:] != own[:-1])
    own, begin, end = own[~largest], begin[~largest], end[~largest]
    size = end - begin
    child = np.repeat(np.arange(len(size)), size)
    i = sa[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[child]]
    depth = lcp[at[first]][own[child]]
    lo, hi, mine, rest = lb[first][own[child]], rb[first][own[child]], begin[child], end[child]
    found = []
    for j, inside, square in ((i + depth, i + depth < ends[i], i), (i - depth, i - depth >= starts[i], i - depth)):
        r = isa[np.clip(j, 0, n - 1)]
        hit = inside & (r >= lo) & (r < hi) & ((r < mine) | (r >= rest))
        found.append(np.stack([square[hit], depth[hit]]))
    both = np.unique(np.concatenate(found, axis=1), axis=1)
    return both[0], both[1]


def rotated(codes: np.ndarray, starts: np.ndarray, square: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How many words each square can be rotated to the left."""
    far = np.zeros(len(square), dtype=np.int64)
    on, stride = np.arange(len(square)), 16
    while len(on):
        x = (square[on] - 1 - far[on])[:, None] - np.arange(stride)
        same = (x >= starts[square[on]][:, None]) & (codes[np.maximum(x, 0)] == codes[np.maximum(x, 0) + period[on][:, None]])
        gone = np.where(same.all(axis=1), stride, np.argmin(same, axis=1))
        far[on] += gone
        on = on[gone == stride]
        stride = max(16, min(stride * 2, STRIDE, (1 << 22) // max(1, len(on))))
    return far


def find_runs(codes: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of the runs of all documents, by start and
    period; ``codes`` number the words, document ``k`` is ``bounds[k]:bounds[k+1]``."""
    sizes = np.diff(bounds)
    starts, ends = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    square, period = branching_squares(codes, starts, ends, max(2, min_exponent))
    by = np.lexsort((period, square + 2 * period))
    square, period = square[by], period[by]
    runs: list[np.ndarray] = []
    while len(square):
        end = square + 2 * period
        first = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
        begin = square[first] - rotated(codes, starts, square[first], period[first])
        runs.append(np.stack([begin, end[first] - begin, period[first]]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(square))))
        left = (period % period[first][group] != 0) | (square < begin[group])
        square, period = square[left], period[left]
    start, length, period = np.concatenate(runs, axis=1) if runs else np.zeros((3, 0), dtype=np.int64)
    kept = length >= np.maximum(min_length, min_exponent * period)
    by = np.lexsort((period[kept], start[kept]))
    return start[kept][by], length[kept][by], period[kept][by]


def _document_runs(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple]]:
    """Per document its runs ``[(start, length, period)]``."""
    bounds = np.cumsum([0, *map(len, texts)])
    runs: list[list[tuple]] = [[] for _ in texts]
    if bounds[-1]:
        flat = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
        codes = flat.indices.to_numpy().astype(np.int64)
        start, length, period = find_runs(codes, bounds, min_length, min_exponent)
        doc = np.searchsorted(bounds, start, side="right") - 1
        for d, *run in zip(doc.tolist(), (start - bounds[doc]).tolist(), length.tolist(), period.tolist(), strict=True):
            runs[d].append(tuple(run))
    return runs


def _batch_runs(batch: pa.RecordBatch, rewrite: Rewrite | None, min_length: int, min_exponent: int):
    """Per document its words and its runs, ``WORDS`` words or one document at a time."""
    texts = [t.split() for t in batch.column(1).to_pylist()]
    if rewrite is not None:
        texts = [rewrite(words, i) for words, i in zip(texts, batch.column(0).to_pylist(), strict=True)]
    runs: list[list[tuple]] = []
    first = size = 0
    for d, words in enumerate(texts):
        if size and size + len(words) > WORDS:
            runs += _document_runs(texts[first:d], min_length, min_exponent)
            first, size = d, 0
        size += len(words)
    return texts, runs + _document_runs(texts[first:], min_length, min_exponent)


def collapsed(words: list[bytes], runs: list[tuple]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(depth)[:-1].tolist(), strict=True) if not d]


def _finder(schema: pa.Schema, rewrite, min_length: int, min_exponent: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, runs = _batch_runs(batch, rewrite, min_length, min_exponent)
            rows = pa.array([d for d, own in enumerate(runs) for _ in own], pa.int64())
            spans = [pa.array([r[k] for own in runs for r in own], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), *spans], schema=schema)

    return find


def _digester(schema: pa.Schema, rewrite, min_length: int, min_exponent: int):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = _batch_runs(batch, rewrite, min_length, min_exponent)
            rows = []
            for words, runs in zip(texts, found, strict=True):
                top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                rows.append((len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                             hashlib.sha256(listed.encode()).hexdigest(),
                             hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)

    return digest


def _mapped(docs: DataFrame, id_col: str, text_col: str, columns: str, fn, *settings) -> DataFrame:
    texts = narrow(docs, doc=id_col, text=text_bytes(text_col))
    named = texts.select(F.col("doc").alias(id_col), *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")])
    plain = to_arrow(named.toDF(*[f"r{i}" for i in range(len(named.columns))]).schema)
    plain = pa.schema([pa.field(f.name, f.type) for f in plain])
    return map_arrow(texts, fn(plain, *settings), named.schema)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None,
                  min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``(id, start, length, period)`` of every run, in words from 0."""
    return _mapped(docs, id_col, text_col, "start long, length long, period long", _finder, rewrite, min_length, min_exponent)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None,
                min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row of ``docs``: the number of its runs, the run with the greatest
    exponent, and digests of all runs and of the text without their repeats."""
    columns = ("n_runs long, start long, length long, period long, exponent_milli long, "
               "runs_sha256 string, collapsed_sha256 string")
    return _mapped(docs, id_col, text_col, columns, _digester, rewrite, min_length, min_exponent)
