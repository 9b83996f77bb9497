"""Toxicity severity by cumulative-link ordinal regression.

One weight vector over sparse text features is shared by all ordered thresholds:
``P(grade <= j) = sigmoid(threshold_j - w . x)``. The output is the expected
severity, the sum over ``j`` of ``P(grade > j)``, between 0 and ``GRADES``.

Features: which words, and which beginnings of words (4 and 5 letters), occur in
the text, hashed. Presence, not frequency, so length does not dilute a hit. Only
features that are clearly commoner in toxic documents are kept, so a long clean
text gathers no weight.

Grades: ``labels.toxic`` is 0 or 1, so clean documents are grade 0 and toxic ones
are graded 1 to ``GRADES`` by terciles of their hits per square root of words.
The grades above 0 thus rest on the features that are fitted, not on a judgement
of their own: severity orders toxic documents by density of toxic features, and
only "above 0" has labels to be held against.

Fit on the driver with numpy, on at most ``SAMPLE`` labelled documents outside
the held-out fold; every whole text is scored.

Defined cases: null and empty texts have no features (the base rate) and are
never rejected, whatever the labels; a null id is scored like any other; without
labels of both kinds, or without a kept feature, nothing is rejected (severity 0,
or the base rate); where all hits are equally dense there is one grade above 0; rows that repeat are scored each; an empty table gives an empty
result; input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import append, extended, map_arrow, narrow, quoted, without
from kinroll.llm.labelled import held_out, training_sample

SAMPLE = 12_000
SPACE = 1 << 22
GRADES = 3
MIN_TOXIC = 4         # toxic sample documents that a kept feature occurs in,
MIN_SHARE = 0.005     # and their share of the toxic ones
MIN_RATIO = 20.0      # times commoner in toxic documents
REJECT = 0.1          # a document is rejected from this probability of a grade above 0,
LIFT = 3.0            # if its features make the odds that many times the base rate's
RESULT = "severity double, grade int, p_toxic double"
_WORD = re.compile(r"\w+")
_MEMO = 150_000


def spellings(word: str) -> list[int]:
    """Hashed features of one lower-case word."""
    forms = [word]
    if len(word) > 4:
        forms += [f"4 {word[:4]}", f"5 {word[:5]}"]
    return [zlib.crc32(f.encode()) % SPACE for f in forms]


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, words = [], []
        for text in batch.column(0).to_pylist():
            seen = _words(text or "")
            found.append(sorted({f for w in seen for f in spellings(w)}))
            words.append(len((text or "").split()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.list_(pa.int32())), pa.array(words, pa.int32()), batch.column(1)],
            names=["features", "words", "label"])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    """``weights`` by feature, and increasing ``thresholds``."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade > j)``, one column per threshold."""
        return sigmoid(np.asarray(scores)[:, None] - self.thresholds[None, :])


def fit_ordinal(columns: np.ndarray, rows: np.ndarray, grades: np.ndarray, n_features: int,
                steps: int = 400, rate: float = 0.1, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for sparse binary features (``columns[i]`` is
    present in ``rows[i]``), by Adam on the mean cumulative-link loss. The
    thresholds are a first one and positive gaps, so they stay ordered."""
    levels, n = int(grades.max()), len(grades)
    params = np.zeros(n_features + levels)
    base = np.array([np.mean(grades > j) for j in range(levels)]).clip(1e-4, 1 - 1e-4)
    start = -np.log(base / (1 - base))
    params[n_features] = start[0]
    params[n_features + 1:] = np.log(np.maximum(np.diff(start), 0.05))
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        weights, gaps = params[:n_features], np.exp(params[n_features + 1:])
        cuts = params[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(rows, weights=weights[columns], minlength=n)
        upper = np.where(grades < levels, sigmoid(np.append(cuts, 0)[grades] - score), 1.0)
        lower = np.where(grades > 0, sigmoid(np.append(0, cuts)[grades] - score), 0.0)
        mass = np.maximum(upper - lower, 1e-12)
        d_upper = np.where(grades < levels, upper * (1 - upper), 0) / mass
        d_lower = np.where(grades > 0, lower * (1 - lower), 0) / mass
        d_score = (d_upper - d_lower) / n
        d_cuts = (np.bincount(grades, weights=-d_upper, minlength=levels + 1)[:levels]
                  + np.bincount(grades, weights=d_lower, minlength=levels + 1)[1:]) / n
        grad = np.concatenate([
            np.bincount(columns, weights=d_score[rows], minlength=n_features) + ridge * weights,
            [d_cuts.sum()], np.cumsum(d_cuts[::-1])[::-1][1:] * gaps])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        params -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return params[:n_features], params[n_features] + np.concatenate([[0], np.cumsum(np.exp(params[n_features + 1:]))])


def grade_toxic(hits: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for clean documents, 1 to ``GRADES`` by how dense the hits are."""
    density = hits / np.sqrt(np.maximum(words, 1))
    edges = np.quantile(density[toxic == 1], np.arange(1, GRADES) / GRADES)
    return np.where(toxic == 1, 1 + np.searchsorted(edges, density, side="left"), 0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE) -> OrdinalModel:
    sample = training_sample(narrow(docs, doc_id=id_col, text=text_col), narrow(labels, doc_id=id_col, toxic="toxic"), "toxic", rows)
    found = map_arrow(sample.select("text", "_label"), _features, "features array<int>, words int, label int").toArrow()
    toxic = found.column("label").to_numpy()
    if not (toxic == 1).any() or not (toxic == 0).any():
        return OrdinalModel({}, np.full(GRADES, np.inf))
    lists = found.column("features").combine_chunks()
    columns = lists.flatten().to_numpy()
    at = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    in_toxic = np.bincount(columns[toxic[at] == 1], minlength=SPACE)
    in_clean = np.bincount(columns, minlength=SPACE) - in_toxic
    ratio = ((in_toxic + 0.5) / (toxic.sum() + 1)) / ((in_clean + 0.5) / ((toxic == 0).sum() + 1))
    kept = np.flatnonzero((in_toxic >= max(MIN_TOXIC, MIN_SHARE * toxic.sum())) & (ratio >= MIN_RATIO))
    place = np.full(SPACE, -1)
    place[kept] = np.arange(len(kept))
    use = place[columns] >= 0
    columns, at = place[columns[use]], at[use]
    hits = np.bincount(at, minlength=len(lists))
    grades = grade_toxic(hits, found.column("words").to_numpy(), toxic)
    weights, cuts = fit_ordinal(columns, at, grades, len(kept))
    return OrdinalModel(dict(zip(kept.tolist(), weights.tolist(), strict=True)), cuts)


class _Hits(dict):
    """Memo: a word's weighted features, nothing for almost all words."""

    def __init__(self, model: OrdinalModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = tuple(f for f in spellings(word) if f in self.model.weights)
        return value


def _scorer(model: OrdinalModel, at: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _Hits(model)
        for batch in batches:
            sums = [sum(model.weights[f] for f in sorted({f for w in _words(text) for f in hits[w]})) if text else 0.0
                    for text in batch.column(at).to_pylist()]
            above = model.above(np.array(sums, dtype=np.float64))
            yield append(batch, severity=above.sum(axis=1), grade=(above >= 0.5).sum(axis=1).astype(np.int32),
                         p_toxic=np.ascontiguousarray(above[:, 0]))

    return score


def severity(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``grade`` (the highest one
    reached with probability 1/2) and ``p_toxic`` (any grade above 0)."""
    docs = without(docs, "severity", "grade", "p_toxic")
    return map_arrow(docs, _scorer(model, docs.columns.index(text_col)), extended(docs, RESULT))


def rejected(model: OrdinalModel) -> Column:
    """Clean documents have no weighted feature and sit at the base rate, about
    the share of toxic documents without one; a single strong feature lifts the
    probability over ``REJECT``. Only features reject a document: where toxic
    labels are common the base rate itself may be over ``REJECT``, and the odds
    must then be ``LIFT`` times those of a text without features."""
    base = float(model.above(np.zeros(1))[0, 0])
    lifted = LIFT * base / (1 - base + LIFT * base)
    return F.col("p_toxic") >= max(REJECT, lifted)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    model = fit(docs, labels, id_col, text_col)
    return severity(docs.select(quoted(id_col), quoted(text_col)), model, text_col).select(
        F.col(quoted(id_col)), held_out(id_col).alias("held_out"), "severity", "grade", "p_toxic", rejected(model).alias("toxic"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with the columns of ``docs``."""
    columns = [f"_{i}" for i in range(len(docs.columns))]
    model = fit(docs, labels, id_col, text_col)
    kept = severity(docs.toDF(*columns), model, f"_{docs.columns.index(text_col)}").filter(~rejected(model))
    return kept.select(*[F.col(c).alias(name) for c, name in zip(columns, docs.columns, strict=True)])
