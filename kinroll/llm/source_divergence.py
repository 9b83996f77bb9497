"""How far the sources of a language differ in the terms they use.

A term is a run of letters or non-ASCII characters, A-Z lower-cased. Texts are
audited by **chunk factorization**:

1. The scan cuts each document at white space (lower-cased, separators at a
   chunk's ends taken off) and counts its chunks. A task adds its documents up:
   occurrences per (language, source, chunk), and the documents behind them, as
   far as the vocabulary rule needs to know them: fewer than ``min_docs`` are
   named by their marks, from ``min_docs`` on the number is settled.
2. All rows of a chunk meet in one partition. The first of them tokenizes the
   chunk, once in the whole corpus, and its terms are joined back to the others
   (an equi-join on the chunk, written as a window, so the input is read once).
3. Terms add up the occurrences of their chunks and count distinct documents:
   a document that holds a term in several chunks is one mark, counted once.
   A language keeps the terms of at least ``min_docs`` of its documents.
4. The kept counts are dealt into blocks of terms; every block also gets the
   language's list of sources. A block compares its terms between all sources
   as integer arrays, so the sums of ``f`` leave it as one row per pair of
   sources (the report's own rows), never as rows per term and pair, and the
   largest terms of a source leave it as ``top`` rows.

With ``p = 1 + floor(10^9 (count + 1) / (N + V))`` a term differs between two
distributions by ``f = floor((p - q)^2 / q)``. All arithmetic is on integers.

Scale: a hot chunk ("the") is one row per task and (language, source), a hot
language or source is spread over chunks and terms. A task holds ``ENTRIES``
counted chunks, and later one block of ``CELLS`` counts and ``CELLS`` numbers of
its matrix (or the square of a language's sources, the size of its report).

Defined cases: null text, language and source are empty strings; a document is
a row, so a repeated row or id counts as often as it is there, and ids and other
columns are never read; a group without terms has counts of 0; a language
without kept terms reports its pairs with 0; an empty table reports nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinroll.llm.common import map_arrow, narrow, quoted, written

# What a term is, and the other ASCII characters as bytes.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SCALE_STEPS = (1000, 1000, 1000)  # 10^9, in steps whose products fit 64 bits
MIN_DOCS = 3
TOP_TERMS = 200
ENTRIES = 500_000
CELLS = 500_000

COUNTS = "lang string, source string, chunk string, n long, first long, last long"
REPORT = "lang string, source string, part string, item string, value long"


def _chunk_counter(min_docs: int):
    def rows(held: dict[tuple, dict[bytes, list]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), chunks in held.items():
            marks = [(e[1], e[2]) if e[3] < min_docs else (None, None) for e in chunks.values()]
            yield pa.RecordBatch.from_arrays([
                pa.repeat(lang, len(chunks)), pa.repeat(source, len(chunks)),
                pa.array(list(chunks), pa.binary()).cast(pa.string()),
                pa.array([e[0] for e in chunks.values()], pa.int64()),
                pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
            ], names=[f"r{i}" for i in range(6)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, list]] = {}
        size = 0
        for batch in batches:
            for mark, lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunks = held.setdefault((lang, source), {})
                size -= len(chunks)
                own: dict[bytes, int] = {}
                for raw, n in Counter(text.lower().split()).items():
                    chunk = raw.strip(SEPARATORS)
                    own[chunk] = own.get(chunk, 0) + n
                own.pop(b"", None)
                for chunk, n in own.items():
                    entry = chunks.get(chunk)
                    if entry is None:
                        chunks[chunk] = [n, mark, None, 1]
                    else:
                        entry[0] += n
                        entry[2] = mark
                        entry[3] += 1
                size += len(chunks)
                if size >= ENTRIES:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return count


def chunk_counts(docs: DataFrame, min_docs: int = MIN_DOCS, lang_col: str = "lang", source_col: str = "source",
                 text_col: str = "text") -> DataFrame:
    """``(lang, source, chunk, n, first, last)`` of every task's documents: the
    occurrences ``n`` and the marks of the first and the last document (the last
    null if there is one only, both null from ``min_docs`` documents on)."""
    texts = narrow(docs, mark=F.monotonically_increasing_id(), lang=_filled(lang_col), source=_filled(source_col),
                   text=_filled(text_col).cast("binary"))
    return map_arrow(texts, _chunk_counter(min_docs), COUNTS)


def _filled(column: str) -> Column:
    return F.coalesce(F.col(quoted(column)), F.lit(""))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, **columns) -> DataFrame:
    """``(lang, source, term, n, lang_n, new)``: occurrences of every kept term
    in every group that holds it, and in its language; ``new`` marks one row of
    each (language, term)."""
    if not 1 <= min_docs <= 3:
        raise ValueError("min_docs must be 1, 2 or 3: a chunk's row holds the marks of two documents")
    n_docs = F.when(F.col("first").isNull(), min_docs).when(F.col("last").isNull(), 1).otherwise(2)
    chunks = chunk_counts(docs, min_docs, **columns).repartition("chunk").groupBy("chunk", "lang", "source").agg(
        F.sum("n").alias("n"), F.sum(n_docs).alias("docs"),
        F.min("first").alias("first"), F.max(F.coalesce("last", "first")).alias("last"))

    of_chunk = Window.partitionBy("chunk").orderBy("lang", "source")
    terms = F.when(F.row_number().over(of_chunk) == 1, F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0)))
    shared = chunks.withColumn("terms", terms).select(
        "*", F.sum("docs").over(Window.partitionBy("chunk", "lang")).alias("lang_docs"),
        F.first("terms").over(of_chunk.rowsBetween(Window.unboundedPreceding, 0)).alias("all_terms"))
    settled = F.col("lang_docs") >= min_docs
    marks = F.when(settled, F.array(F.lit(None).cast("long"))).otherwise(F.array_distinct(F.array("first", "last")))
    held = (
        shared.select("lang", "source", "n", settled.alias("settled"), marks.alias("marks"), F.explode("all_terms").alias("term"))
        .select("lang", "source", "term", "n", "settled", F.posexplode("marks").alias("place", "mark"))
    )
    once = F.when(F.col("place") == 0, F.col("n")).otherwise(0)  # a second mark repeats the chunk's row
    groups = held.groupBy("lang", "source", "term").agg(
        F.sum(once).alias("n"), F.max("settled").alias("settled"), F.count_distinct("mark").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    return groups.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"),
        (F.row_number().over(of_term.orderBy("source")) == 1).alias("new"),
        (F.max("settled").over(of_term) | (F.sum("docs").over(of_term) >= min_docs)).alias("kept"),
    ).filter("kept").drop("kept")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / total)``, exact, as long division in three
    steps (in Python's integers where a step would not fit 64 bits)."""
    rest, total = counts + 1, np.broadcast_to(totals, counts.shape)
    if total.size and total.max() >= (1 << 63) // max(SCALE_STEPS):
        rest, total = rest.astype(object), total.astype(object)
    out = np.zeros_like(rest)
    for step in SCALE_STEPS:
        rest = rest * step
        out = out * step + rest // total
        rest = rest % total
    return (out + 1).astype(np.int64)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // q


def _compare(top: int):
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        lang, block = key[0].as_py(), key[1].as_py()
        is_head = pc.is_null(table["term"])
        head, cells = table.filter(is_head).sort_by("source"), table.filter(pc.invert(is_head)).sort_by("term")
        sources = head["source"].to_pylist()
        v, lang_total = (head["v"][0].as_py(), head["lang_n"][0].as_py()) if sources else (0, 0)
        totals = head["n"].to_numpy() + v
        words = cells["term"].combine_chunks()
        if isinstance(words, pa.ChunkedArray):
            words = pa.concat_arrays(words.chunks) if words.num_chunks else pa.array([], pa.string())
        words = words.dictionary_encode()
        row = words.indices.to_numpy(zero_copy_only=False)  # ascending: the cells are sorted by term
        words = words.dictionary
        place = {s: i for i, s in enumerate(sources)}
        column = np.array([place[s] for s in cells["source"].to_pylist()], dtype=np.int64)
        n, lang_n = cells["n"].to_numpy(), cells["lang_n"].to_numpy()

        sums = np.zeros((len(sources), len(sources)), dtype=np.int64)
        values = np.zeros(len(row), dtype=np.int64)
        above = np.zeros(len(row), dtype=bool)
        step = max(1, CELLS // max(1, len(sources)))
        for start in range(0, len(words), step):
            lo, hi = np.searchsorted(row, [start, start + step])
            counts = np.zeros((min(step, len(words) - start), len(sources)), dtype=np.int64)
            counts[row[lo:hi] - start, column[lo:hi]] = n[lo:hi]
            p = shares(counts, totals)
            q = shares(lang_n[lo:hi], np.int64(lang_total + v))
            own = p[row[lo:hi] - start, column[lo:hi]]
            values[lo:hi], above[lo:hi] = apart(own, q), own > q
            for s in range(len(sources)):
                sums[s] += apart(p[:, s:s + 1], p).sum(axis=0)

        found = np.flatnonzero(above)
        found = found[np.lexsort((row[found], -values[found], column[found]))]  # terms are numbered in UTF-8 order
        first = np.searchsorted(column[found], column[found])
        found = found[np.arange(len(found)) - first < top]
        one, other = np.nonzero(~np.eye(len(sources), dtype=bool))
        if len(words) == 0 and block > 0:
            one = other = one[:0]  # block 0 alone names the pairs of a language without terms
        names = pa.array(sources, pa.string())
        return pa.table({
            "lang": pa.repeat(lang, len(found) + len(one)),
            "source": pa.concat_arrays([names.take(pa.array(column[found])), names.take(pa.array(one))]),
            "part": pa.concat_arrays([pa.repeat("term", len(found)), pa.repeat("pair", len(one))]),
            "item": pa.concat_arrays([words.take(pa.array(row[found])), names.take(pa.array(other))]),
            "value": pa.array(np.concatenate([values[found], sums[one, other]]), pa.int64()),
        })

    return compare


def divergence(docs: DataFrame, top: int = TOP_TERMS, min_docs: int = MIN_DOCS, lang_col: str = "lang",
               source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``. Part ``pair``: every other
    source of the language, by how far its term shares are from this source's.
    Part ``term``: the ``top`` terms that the source uses more than its language."""
    columns = {"lang_col": lang_col, "source_col": source_col, "text_col": text_col}
    kept = written(kept_counts(docs, min_docs, **columns))
    blocks = max(1, -(-kept.count() // CELLS))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("new").alias("v"))
    groups = docs.select(_filled(lang_col).alias("lang"), _filled(source_col).alias("source")).distinct()
    head = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "source", F.lit(None).cast("string").alias("term"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "lang_n", "v")])
    cells = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"), "source", "term",
                        "n", "lang_n", F.lit(0).cast("long").alias("v"))
    found = head.unionByName(cells).groupBy("lang", "block").applyInArrow(_compare(top), REPORT)
    report = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = report.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top)).select(
        "lang", "source", "part", "item", "value", "rank")
