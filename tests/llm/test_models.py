"""Toxicity, quality and language-model scores: held-out accuracy, identities."""

import heapq
import math
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinroll.llm import lm_scoring, quality_fm, toxicity
from kinroll.llm.labelled import held_out, training_sample
from kinroll.llm.queries import QUERIES
from kinroll.sources import read_table

from .helpers import TEXTS, messy, plain

SF1 = "/root/testdata/sf0.1"


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    pos = labels == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def labelled(spark, found, label):
    rows = found.join(read_table(spark, SF1, "labels"), "doc_id").filter("held_out").toPandas()
    return rows, rows[label].to_numpy()


def test_toxicity_held_out(spark):
    found = QUERIES["op1_toxicity"](spark, SF1)
    assert found.count() == 10_000
    rows, toxic = labelled(spark, found.withColumnRenamed("toxic", "rejected"), "toxic")
    caught, wrong = rows["rejected"][toxic == 1].mean(), rows["rejected"][toxic == 0].mean()
    assert caught > 0.75 and wrong < 0.01 and auc(rows["severity"].to_numpy(), toxic) > 0.9  # 300 toxic examples


def test_ordinal_thresholds_share_weights():
    rng = np.random.default_rng(0)
    strength = rng.integers(0, 4, 900)
    rows = np.concatenate([np.flatnonzero(strength > f) for f in range(3)])
    columns = np.concatenate([np.full((strength > f).sum(), f) for f in range(3)])
    weights, cuts = toxicity.fit_ordinal(columns, rows, strength, 3)
    assert (np.diff(cuts) > 0).all() and (weights > 0).all()
    model = toxicity.OrdinalModel({}, cuts)
    scores = np.bincount(rows, weights=weights[columns], minlength=900)
    expected = model.above(scores).sum(axis=1)
    means = [expected[strength == g].mean() for g in range(4)]
    assert means == sorted(means) and abs(means[3] - 3) < 0.5 and means[0] < 0.5


@pytest.mark.parametrize("share", [0.02, 0.2, 0.5])
def test_clean_documents_stay_at_any_share_of_toxic_labels(spark, share):
    """And severity is what weights and thresholds say, written out."""
    n = 600
    toxic = [i < share * n for i in range(n)]
    texts = [f"alpha beta w{i % 40} w{i % 7}" + (" slurrish grumble" if t else "") for i, t in enumerate(toxic)]
    more = [(9000, None), (9001, ""), (9002, "alpha beta"), (9003, "Grumble, slurrish!"), (9004, "alpha " * 30_000)]
    docs = spark.createDataFrame([*enumerate(texts), *more], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == {i for i in range(n) if not toxic[i]} | {9000, 9001, 9002, 9004}
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}
    for i, text in [*list(enumerate(texts))[::50], *more]:
        words = set(re.findall(r"\w+", (text or "").lower()))
        forms = {f for w in words for f in [w, *([f"4 {w[:4]}", f"5 {w[:5]}"] if len(w) > 4 else [])]}
        score = sum(model.weights.get(h, 0.0) for h in {zlib.crc32(f.encode()) % toxicity.SPACE for f in forms})
        above = [1 / (1 + math.exp(c - score)) for c in model.thresholds]
        assert found[i]["severity"] == pytest.approx(sum(above)) and found[i]["p_toxic"] == pytest.approx(above[0])
        assert found[i]["grade"] == sum(a >= 0.5 for a in above)


def test_nothing_goes_without_a_feature(spark):
    labels = spark.createDataFrame([(i, i % 3 > 0) for i in range(1, 18)], "doc_id long, t boolean").selectExpr("doc_id", "int(t) as toxic")
    df = messy(spark)  # no feature is common among so few
    assert toxicity.without_toxic(df, labels).count() == df.count()


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 18)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    df = messy(spark)
    assert toxicity.scored(df, labels).count() == len(TEXTS)
    assert toxicity.scored(messy(spark, []), labels).count() == 0
    kept = toxicity.without_toxic(df, labels.filter("toxic = 0"))  # nothing to learn from: nothing goes
    assert kept.columns == df.columns and kept.count() == len(TEXTS)


def test_quality_held_out(spark):
    found = QUERIES["op7_quality"](spark, SF1)
    assert found.count() == 10_000 and found.filter("score < 0 or score > 1 or score is null").count() == 0
    rows, good = labelled(spark, found, "quality")
    assert auc(rows["score"].to_numpy(), good) > 0.97
    assert rows["predicted"][good == 1].mean() > 0.98 and rows["predicted"][good == 0].mean() < 0.15


def test_interactions_equal_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    fm = quality_fm.FactorisationMachine(np.zeros((quality_fm.STATS, quality_fm.BINS)), 0.3, rng.normal(size=40), rng.normal(size=(40, 8)))
    at, x = np.array([3, 7, 11, 29]), rng.normal(size=4)
    pairs = sum(fm.factors[at[i]] @ fm.factors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert fm.logit(at, x) == pytest.approx(0.3 + fm.linear[at] @ x + pairs)


def test_quality_ignores_language_source_and_id(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").limit(50)
    labels = read_table(spark, "/root/testdata/sf0.001", "labels")
    model = quality_fm.fit(read_table(spark, "/root/testdata/sf0.001", "documents"), labels)
    score = lambda df: {r["text"]: r["score"] for r in quality_fm.quality(df, model).collect()}
    assert score(docs) == score(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")).withColumn("doc_id", F.lit(1)))


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 18)] + [(1, None, None)], "doc_id long, quality int, toxic int")
    df = messy(spark)
    assert quality_fm.scored(df, labels).filter("score between 0 and 1").count() == len(TEXTS)
    assert quality_fm.scored(df.drop("n_chars"), labels).count() == len(TEXTS)
    assert quality_fm.scored(messy(spark, []), labels).count() == 0
    kept = quality_fm.without_poor(df, labels.limit(0))
    assert kept.columns == df.columns and kept.count() == len(TEXTS)


def test_fold(spark):
    import zlib
    rows = spark.range(200).select(F.col("id").alias("doc_id")).withColumn("h", held_out()).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_training_sample_has_a_document_once(spark):
    ids = [r["id"] for r in spark.range(40).withColumn("h", held_out("id")).filter("not h").collect()]
    docs = plain(spark, [(i, f"text {i}") for i in ids] + [(ids[0], f"text {ids[0]}")] * 50 + [(ids[0], None)]).repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[1], ids[1] % 2)] * 50, "doc_id long, toxic int")
    rows = training_sample(docs, labels, "toxic", 100).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(str((i, f"text {i}", i % 2)) for i in ids)
    assert training_sample(docs, labels, "toxic", 5).count() == 5


# ---- language model ----

def probabilities(p, tree, around):
    """All conditional probabilities of one position, written out: down the tree from its root."""
    n = len(tree.depth)
    h = np.tanh(sum(p["embed"][i * (n + 1) + t] for i, t in enumerate(around)) + p["hidden"])
    found = np.ones(2 * n - 1)
    for node in range(2 * n - 3, -1, -1):
        up = tree.parent[node]
        turn = 1 / (1 + np.exp(-(h @ p["turn"][up - n] + p["turn_bias"][up - n])))
        found[node] = found[up] * (turn if tree.right[node] else 1 - turn)
    return found[:n]


def test_lm_tree_follows_the_counts():
    counts = np.array([0, 0, 1, 3, 3, 40, 7])
    tree = lm_scoring.tree_of(counts)
    heap, cost = [c + 1 for c in counts.tolist()], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert ((counts + 1) * tree.depth).sum() == cost
    p = lm_scoring.views(lm_scoring.initial(tree))
    p["turn"][:] = 0
    every = probabilities(p, tree, [7, 7, 7, 7])
    assert every == pytest.approx((counts + 1) / (counts + 1).sum(), abs=1e-6)


def test_lm_is_a_distribution_and_sums():
    tree = lm_scoring.tree_of(np.arange(lm_scoring.VOCABULARY))
    p = lm_scoring.views(lm_scoring.initial(tree))
    ids = np.array([5, 900, 33, 33, 1023])
    around = lm_scoring.contexts(ids)
    assert around[0].tolist() == [1024, 1024, 900, 33] and around[4].tolist() == [33, 33, 1024, 1024]
    logs = lm_scoring.log_probabilities(p, tree, around, ids)
    for i, t in enumerate(ids):
        every = probabilities(p, tree, around[i])
        assert every.sum() == pytest.approx(1, abs=1e-4) and logs[i] == pytest.approx(np.log(every[t]), abs=1e-4)


def test_lm_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    tree = lm_scoring.tree_of(np.ones(lm_scoring.VOCABULARY))
    flat, squares = lm_scoring.initial(tree), np.full(lm_scoring.SIZE, 1e-4, dtype=np.float32)
    ids = rng.integers(0, 50, 3000)
    ids[1::2] = (ids[::2] + 1) % 50  # the right neighbour follows from the left one
    around = lm_scoring.contexts(ids)
    loss = lambda: -lm_scoring.log_probabilities(lm_scoring.views(flat), tree, around, ids).mean()
    before, scratch = loss(), np.empty(4 * (lm_scoring.VOCABULARY + 1), dtype=np.int64)
    for _ in range(60):
        lm_scoring.step(flat, squares, around, ids, tree, scratch)
    assert loss() < before - 2


def test_lm_step_follows_the_gradient():
    """The first Adagrad step from large sums of squares is the gradient itself, up to
    a factor; differences of the written-out loss give it independently."""
    rng = np.random.default_rng(2)
    tree = lm_scoring.tree_of(rng.integers(0, 30, 40))
    ids = rng.integers(0, 40, 25)
    around = lm_scoring.contexts(ids, beyond=40)
    start = lm_scoring.initial(tree)
    assert lm_scoring.ids_in(start) == 40
    moved = start.copy()
    lm_scoring.step(moved, np.full(len(start), 1e4, dtype=np.float32), around, ids, tree, np.empty(4 * 41, dtype=np.int64))
    found = (start - moved).astype(float) * 100 / lm_scoring.RATE

    def loss(flat):
        p = lm_scoring.views(flat)
        return -np.mean([np.log(probabilities(p, tree, a)[t]) for a, t in zip(around, ids, strict=True)])

    for at in rng.choice(len(start), 60, replace=False).tolist() + list(range(len(start) - 10, len(start))):
        up, down = start.astype(float), start.astype(float)
        up[at], down[at] = up[at] + 1e-4, down[at] - 1e-4
        assert found[at] == pytest.approx((loss(up) - loss(down)) / 2e-4, abs=2e-3)


def test_lm_trains_every_position_once(monkeypatch):
    seen = []
    monkeypatch.setattr(lm_scoring, "step", lambda flat, squares, around, targets, *_: seen.extend(targets.tolist()))
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[:n]) for n in (0, 1, 2, 5, 8, 9, 16, 17, 40)]
    held = SimpleNamespace(value=words)
    tree = SimpleNamespace(value=lm_scoring.tree_of(np.ones(lm_scoring.VOCABULARY)))
    model = SimpleNamespace(value=lm_scoring.initial(tree.value))
    for round_no in range(lm_scoring.ROUNDS):
        list(lm_scoring._trainer(model, held, tree, round_no)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
    expected = [i for t in texts for i in range(len(t.split()))]
    assert sorted(seen) == sorted(expected)


def test_lm_scores_prefer_the_corpus_order(spark):
    docs = [r["text"] for r in read_table(spark, "/root/testdata/sf0.01", "documents").filter("lang = 'en'").limit(200).collect()]
    rng = np.random.default_rng(3)
    model = lm_scoring.fit(read_table(spark, "/root/testdata/sf0.01", "documents"))
    rows = [(i, t) for i, t in enumerate(docs)] + [(1000 + i, " ".join(rng.permutation(t.split()))) for i, t in enumerate(docs)]
    found = {r["doc_id"]: r for r in lm_scoring.pseudo_likelihood(plain(spark, rows), model).collect()}
    assert all(found[i]["n_tokens"] == len(t.lower().split()) for i, t in enumerate(docs))
    assert np.mean([found[i]["mean_log_prob"] >= found[1000 + i]["mean_log_prob"] for i in range(len(docs))]) > 0.5
    foreign = lm_scoring.pseudo_likelihood(plain(spark, [(1, "zzq xkcd " * 50), (2, None), (3, " ")]), model).collect()
    by_id = {r["doc_id"]: r for r in foreign}
    assert by_id[2]["log_likelihood"] == 0 and by_id[3]["mean_log_prob"] is None
    assert by_id[1]["mean_log_prob"] < np.mean([found[i]["mean_log_prob"] for i in range(len(docs))])


def test_lm_vocabulary_grows_and_counts_weigh_hashed_words(spark):
    common, rare = [f"c{i}" for i in range(1500)], {f"r{i}": 1 + i % 4 for i in range(600)}
    texts = [" ".join(common)] * 12 + [" ".join(w for w, n in rare.items() if n > k) for k in range(4)]
    model = lm_scoring.fit(plain(spark, list(enumerate(texts))))  # own ids from sqrt(19,500) / 20, about 7 occurrences
    assert set(model.words.value) == set(common)
    size = lm_scoring.ids_in(model.weights.value)
    assert size == 1500 + lm_scoring.OTHER
    words = sorted({*common, *rare, "never"})
    ids = dict(zip(words, lm_scoring._Ids(model.words.value).of(words).tolist(), strict=True))
    asked = [*rare, "never"]
    rows = [(i, f"{w} {w}" if i % 2 else w) for i, w in enumerate(asked)] + [(len(asked), " ".join([*rare, *common[:50]])), (None, None)]
    found = {r["doc_id"]: r for r in lm_scoring.pseudo_likelihood(plain(spark, rows).repartition(3), model).collect()}
    held = {}
    for w, n in rare.items():
        held[ids[w]] = held.get(ids[w], 0) + n
    assert len(held) < len(rare)  # some share an id

    def expected(text):
        t = np.array([ids[w] for w in text.split()])
        logs = lm_scoring.log_probabilities(lm_scoring.views(model.weights.value), model.tree.value, lm_scoring.contexts(t, beyond=size), t)
        return logs.sum() + sum(np.log(rare.get(w, 1) / max(held.get(ids[w], 1), 1)) for w in text.split() if w not in common)

    assert len(found) == len(rows) and found[None]["log_likelihood"] == 0
    for i, text in rows[:-1]:
        assert found[i]["n_tokens"] == len(text.split()) and found[i]["log_likelihood"] == pytest.approx(expected(text), abs=1e-3)


def test_lm_odd_rows(spark):
    rows = lm_scoring.scored(messy(spark)).collect()
    assert len(rows) == len(TEXTS)
    sizes = {}
    for r in rows:
        assert (r["mean_log_prob"] is None) == (r["n_tokens"] == 0)
        assert r["log_likelihood"] < 0 if r["n_tokens"] else r["log_likelihood"] == 0
        sizes.setdefault(r["doc_id"], []).append(r["n_tokens"])
    assert sorted(n for of_id in sizes.values() for n in of_id) == sorted(len((t or "").lower().split()) for _, t in TEXTS)
    assert lm_scoring.scored(messy(spark, [])).count() == 0


def test_lm_reads_every_text_once(spark):
    """Counting, both rounds of training and scoring share one pass over the texts."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    texts = [*[f"one two w{i} three" for i in range(60)], None, "", " one  two "]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = plain(spark, rows)
    found = {r["doc_id"]: r["n_tokens"] for r in lm_scoring.scored(docs.mapInArrow(counted, docs.schema)).collect()}
    assert found == {i: len((t or "").split()) for i, t in rows}
    assert read.value == len(rows)
