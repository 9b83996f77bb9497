"""Document quality by a factorisation machine.

Features: the distinct words (hashed, weighted by one over the square root of
their number), statistics of the text's structure cut into bins, and the
document's ``n_chars``, binned as well. The score is
``sigmoid(b + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))``,
i.e. all pairwise interactions at a cost linear in the features.

Fit on the driver with numpy (Adagrad), on at most ``SAMPLE`` labelled documents
outside the held-out fold; every whole text is scored. Labels, language, source
and id are no inputs.

Defined cases: null and empty texts have no words and zero statistics, and get a
score like any other; a null or missing ``n_chars`` has a bin of its own; without
labels every score is 1 (nothing is rejected); rows that repeat are scored each;
an empty table gives an empty result; input columns named like a result column
are replaced by it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import append, extended, map_arrow, quoted, without
from kinroll.llm.labelled import held_out, training_sample

SAMPLE = 6000
BUCKETS = 1 << 13
BINS = 16
FACTORS = 8
THRESHOLD = 0.3
STATS = 12
_MEMO = 100_000


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = zlib.crc32(word.encode()) % BUCKETS
        return value


_buckets = _Buckets()


def describe(text: str | None, n_chars) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word buckets, structure statistics) of one whole text."""
    text = text or ""
    data = text.encode()
    n = max(1, len(data))
    held = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    distinct = set(words)
    ascii_symbols = held[33:48].sum() + held[58:65].sum() + held[91:97].sum() + held[123:127].sum()
    stats = np.array([
        np.log1p(len(words)), -1.0 if n_chars is None else np.log1p(max(0, n_chars)), held[65:91].sum() / n,
        held[48:58].sum() / n, ascii_symbols / n, held[128:].sum() / n, held[10] / n, held[46] / n,
        len(distinct) / max(1, len(words)), sum(map(len, words)) / max(1, len(words)),
        1 - len(set(lines)) / max(1, len(lines)), (held[33:127].max() if len(data) else 0) / n,
    ])
    buckets = np.fromiter({_buckets[w] for w in distinct}, dtype=np.int64)
    return np.sort(buckets), stats


def _describer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [describe(t, c) for t, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
             pa.array([f[1] for f in found], pa.list_(pa.float64())), batch.column(2)], names=["buckets", "stats", "label"])


@dataclass
class FactorisationMachine:
    """Word buckets first, then ``BINS + 1`` bins for each statistic."""

    edges: np.ndarray    # (STATS, BINS) upper ends of the bins
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def features(self, buckets: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins = (self.edges < stats[:, None]).sum(axis=1)
        where = BUCKETS + np.arange(STATS) * (BINS + 1) + bins
        weight = 1 / np.sqrt(max(1, len(buckets)))
        return np.concatenate([buckets, where]), np.concatenate([np.full(len(buckets), weight), np.ones(STATS)])

    def logit(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at] * x[:, None]
        total = v.sum(axis=0)
        return float(self.bias + self.linear[at] @ x + 0.5 * (total @ total - (v * v).sum()))

    def score(self, text: str | None, n_chars) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(*self.features(*describe(text, n_chars))), -40, 40))))


def train(buckets: list[np.ndarray], stats: np.ndarray, labels: np.ndarray, epochs: int = 12, batch: int = 64,
          rate: float = 0.1, ridge: float = 1e-4, seed: int = 7) -> FactorisationMachine:
    """Adagrad on the logistic loss, mini-batches of documents."""
    size = BUCKETS + STATS * (BINS + 1)
    rng = np.random.default_rng(seed)
    edges = np.quantile(stats, np.arange(1, BINS + 1) / (BINS + 1), axis=0).T.copy()
    rate_of = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    fm = FactorisationMachine(edges, float(np.log(rate_of / (1 - rate_of))), np.zeros(size),
                              rng.normal(0, 0.05, (size, FACTORS)))
    inputs = [fm.features(b, s) for b, s in zip(buckets, stats, strict=True)]
    sum_linear, sum_factors, sum_bias = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), batch):
            docs = order[start:start + batch]
            at = np.concatenate([inputs[d][0] for d in docs])
            x = np.concatenate([inputs[d][1] for d in docs])
            lengths = [len(inputs[d][0]) for d in docs]
            row, ends = np.repeat(np.arange(len(docs)), lengths), np.concatenate([[0], np.cumsum(lengths)[:-1]])
            v = fm.factors[at] * x[:, None]
            total = np.add.reduceat(v, ends)
            logit = (fm.bias + np.add.reduceat(fm.linear[at] * x, ends)
                     + 0.5 * ((total ** 2).sum(1) - np.add.reduceat((v * v).sum(1), ends)))
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[docs]) / len(docs)
            touched, place = np.unique(at, return_inverse=True)
            g_linear = np.bincount(place, weights=error[row] * x) + ridge * fm.linear[touched]
            pull = (error[row] * x)[:, None] * (total[row] - v)
            g_factors = np.stack([np.bincount(place, weights=pull[:, f]) for f in range(FACTORS)], axis=1) + ridge * fm.factors[touched]
            sum_linear[touched] += g_linear ** 2
            sum_factors[touched] += g_factors ** 2
            sum_bias += error.sum() ** 2
            fm.linear[touched] -= rate * g_linear / np.sqrt(sum_linear[touched])
            fm.factors[touched] -= rate * 0.5 * g_factors / np.sqrt(sum_factors[touched])
            fm.bias -= rate * error.sum() / np.sqrt(sum_bias)
    return fm


def _n_chars(docs: DataFrame):
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE) -> FactorisationMachine | None:
    """Null where there is no labelled document to learn from."""
    inputs = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"), _n_chars(docs).alias("n_chars"))
    known = labels.select(F.col(quoted(id_col)).alias("doc_id"), F.col("quality"))
    sample = training_sample(inputs, known, "quality", rows)
    found = map_arrow(sample.select("text", "n_chars", "_label"), _describer, "buckets array<int>, stats array<double>, label int").toArrow()
    if not found.num_rows:
        return None
    order = np.lexsort((found.column("label").to_numpy(), *np.array(found.column("stats").to_pylist()).T))
    found = found.take(pa.array(order))
    buckets = [np.array(b, dtype=np.int64) for b in found.column("buckets").to_pylist()]
    return train(buckets, np.array(found.column("stats").to_pylist()), found.column("label").to_numpy().astype(float))


def _scorer(model, text_at: int, chars_at: int | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = model.value
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            chars = batch.column(chars_at).to_pylist() if chars_at is not None else [None] * len(texts)
            yield append(batch, score=pa.array([1.0 if fm is None else fm.score(t, c) for t, c in zip(texts, chars, strict=True)], pa.float64()))

    return score


def quality(docs: DataFrame, model: FactorisationMachine | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better). The model has a fixed
    size (under 1 MB) and is broadcast."""
    docs = without(docs, "score")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs, _scorer(shared, docs.columns.index(text_col), chars_at), extended(docs, "score double"))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` (1 from a score of 0.3 on)."""
    inputs = docs.select(F.col(quoted(id_col)), F.col(quoted(text_col)), _n_chars(docs).alias("n_chars"))
    return quality(inputs, fit(docs, labels, id_col, text_col), text_col).select(
        F.col(quoted(id_col)), held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_poor(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that score 0.3 or more, with the columns of ``docs``."""
    columns = [f"_{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*columns).withColumn("n_chars", _n_chars(docs) if "n_chars" not in docs.columns
                                             else F.col(f"_{docs.columns.index('n_chars')}").cast("long"))
    kept = quality(renamed, fit(docs, labels, id_col, text_col), f"_{docs.columns.index(text_col)}").filter(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col(c).alias(name) for c, name in zip(columns, docs.columns, strict=True)])
