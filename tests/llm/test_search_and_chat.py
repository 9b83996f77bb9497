"""Top-k search, preference formatting, oracles and the pipeline."""

import hashlib
import math
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from kinroll.llm import chat_format, topk_search
from kinroll.llm.queries import ORACLE_SQL, QUERIES
from kinroll.sources import read_table
from tests.conftest import SF01

from .helpers import TEXTS, messy, near_classes, normal

SF001 = "/root/testdata/sf0.001"


def rows_of(con, sql, columns):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(columns)
    order = [names.index(c) for c in columns]
    return sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF01):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF01}/{f}'")
    df = QUERIES[name](spark, SF01)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == rows_of(con, ORACLE_SQL[name], df.columns)


def brute_top(rows, queries, k):
    good = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in sorted({i: min(v for j, v in good if j == i) for i, _ in good if i in queries}.items()):
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in good if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("dims,n", [(8, 700), (1, 300), (64, 500)])
def test_top_k_blocks(spark, monkeypatch, dims, n):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 150)
    monkeypatch.setattr(topk_search, "GROUP_QUERIES", 2)
    monkeypatch.setattr(topk_search, "FEW", 12)
    rng = np.random.default_rng(dims)
    vectors = rng.normal(size=(n, dims)).round(1)
    vectors[::3] = vectors[0]  # a third of the rows share one vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.top_k(df, F.col("vec_id") % 100 == 0, 10)
    got = [tuple(r) for r in found.collect()]
    assert set(got) == brute_top(rows, set(range(0, n, 100)), 10) and len(got) == len(set(got))


def test_top_k_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, nan]), (3, [None, 1.0]), (4, []), (5, [1.0]), (6, [3.0, 1.0, 1.0]), (None, [1.0, 1.0]),
            (100, [0.0, 0.0]), (7, [float("inf"), 0.0]), (0, [5.0, 5.0]), (8, [-1.0, -2.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, block int")
    found = topk_search.top_k(df, F.col("vec_id") % 100 == 0, 10)
    assert {tuple(r) for r in found.collect()} == brute_top(rows, {0, 100}, 10)
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_beyond_doubles(spark):
    rows = [(i, [1e5 + i, 3e5 - i]) for i in range(20)]
    top = lambda rows: {tuple(r) for r in topk_search.top_k(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 3).collect()}
    assert top(rows) == brute_top(rows, {0}, 3)
    assert top([(i, [1e9 * (1 + i)]) for i in range(5)]) == {(0, n, n, 2 ** 63 - 1) for n in (1, 2, 3)}


# ---- preference formatting ----

def test_longest_common_prefix(spark):
    schema = "pair long, turn long, role string, text string, side string"
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "good"),
              (2, 0, "user", "same"), (3, 0, "user", "only here"), (4, 0, None, None), (4, 0, "z", "z"), (None, 0, "user", "x"), (5, None, "u", "u")]
    rejected = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "other"), (1, 3, "assistant", "bad"), (1, 4, "user", "bye"),
                (2, 0, "user", "same"), (4, 0, None, None)]
    make = lambda rows: spark.createDataFrame([(*r, "s") for r in rows], schema)
    segments = chat_format.preference_segments(chat_format.aligned(make(chosen), make(rejected)))
    records = {r["pair"]: r for r in chat_format.records(segments).collect()}
    assert set(records) == {1, 2, 3, 4}
    one = records[1]
    assert one["prompt"] == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n"
    assert one["chosen"] == "<|user|>\nmore<|end|>\n<|assistant|>\ngood<|end|>\n"
    assert one["rejected"] == "<|user|>\nother<|end|>\n<|assistant|>\nbad<|end|>\n<|user|>\nbye<|end|>\n"
    assert [one["chosen"][s["start"]:s["end"]] for s in one["chosen_spans"]] == ["good<|end|>"]
    assert [one["rejected"][s["start"]:s["end"]] for s in one["rejected_spans"]] == ["bad<|end|>"]
    assert (records[2]["prompt"], records[2]["chosen"], records[2]["rejected"]) == ("<|user|>\nsame<|end|>\n", "", "")
    assert (records[3]["prompt"], records[3]["chosen"]) == ("", "<|user|>\nonly here<|end|>\n")
    assert records[4]["prompt"] == "<|unknown|>\n<|end|>\n"
    assert chat_format.preference_segments(chat_format.aligned(make([]), make([]))).count() == 0


def other_side(i, turns):
    """The rejected side of a conversation, written out."""
    digit, replies = int(hashlib.md5(str(i).encode()).hexdigest()[0], 16), [t for t in turns if t[1] == "assistant"]
    if digit == 15:
        return []
    if not replies:
        return turns
    first, last = replies[0], replies[-1]
    if digit < 6:
        stale = first[2] if first[0] < last[0] else turns[0][2]
        return [(*t[:2], stale) if t == last else t for t in turns]
    if digit < 9:
        return [(*t[:2], turns[0][2]) if t == first else t for t in turns]
    if digit < 12:
        return [t for t in turns if t[0] < last[0]]
    return [*turns, (turns[-1][0] + 1, "assistant", last[2])]


def check_records(talks, by_conv):
    records = {r["pair"]: r for r in chat_format.records(chat_format.derived_segments(talks)).collect()}
    assert set(records) == set(by_conv)
    show = lambda turns: "".join(f"<|{role}|>\n{text}<|end|>\n" for _, role, text in turns)
    shapes = set()
    for i, turns in by_conv.items():
        turns.sort()
        other, r = other_side(i, turns), records[i]
        common = 0
        while common < min(len(turns), len(other)) and turns[common] == other[common]:
            common += 1
        if common < max(len(turns), len(other)):
            assert (r["prompt"], r["chosen"], r["rejected"]) == (show(turns[:common]), show(turns[common:]), show(other[common:]))
            shapes.add((common > 0, len(turns) - len(other), bool(other)))
        else:
            assert (r["prompt"], r["chosen"], r["rejected"]) == (show(turns), "", "")
    return shapes


def test_every_conversation_once(spark):
    talks = read_table(spark, SF01, "conversations")
    by_conv = {}
    for r in talks.collect():
        by_conv.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    shapes = check_records(talks, by_conv)
    assert {(True, 0, True), (True, -1, True)} <= shapes and any(n > 0 and other for _, n, other in shapes) and any(not o for *_, o in shapes)


def test_odd_conversations(spark):
    """Very long ones, gaps, no replies, a reply that opens, clashing columns."""
    by_conv = {i: [(0, "user", f"q{i}"), (3, "assistant", "a"), (4, "user", "x " * (20_000 if i < 3 else 2)), (9, "assistant", "b"), (10, "user", "bye")]
               for i in range(48)}
    by_conv |= {i: [(1, "assistant", "only")] for i in range(48, 80)} | {i: [(0, "user", "u"), (1, "system", "s")] for i in range(80, 110)}
    by_conv |= {200: [(k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(3000)]}
    names = ("side", "pair", "said", "chosen", "rejected", "first", "common", "digit", "last", "reply", "end", "loss", "content", "odd.name")
    rows = [(i, k, role, text, *["z"] * len(names)) for i, turns in by_conv.items() for k, role, text in turns]
    fields = [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.IntegerType())]
    schema = T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in ("role", "text", *names)]])
    repeated = spark.createDataFrame([*rows, *rows[:40], (None, 1, "user", "x", *["z"] * len(names)), (5, None, "user", "x", *["z"] * len(names))], schema)
    check_records(repeated, by_conv)
    assert chat_format.derived_segments(repeated.limit(0)).count() == 0


# ---- pipeline ----

def test_pipeline(spark):
    docs = read_table(spark, SF01, "documents")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r for r in read_table(spark, SF01, "labels").collect()}
    kept = [rows]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF01)
        if name != "packing":
            assert docs.columns == columns
            docs = docs.checkpoint()
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
            assert docs.count() == len(kept[-1])
    start, clean, good, unique, distinct = kept
    held = [i for i in labels if i in start]
    assert np.mean([i not in clean for i in held if labels[i]["toxic"]]) > 0.5  # 30 examples to learn from
    assert np.mean([i in clean for i in held if not labels[i]["toxic"]]) > 0.99
    assert np.mean([i in good for i in held if labels[i]["quality"] and i in clean]) > 0.95
    assert np.mean([i not in good for i in held if not labels[i]["quality"] and i in clean]) > 0.8
    best = {}
    for i, t in good.items():
        best[normal(t)] = min(best.get(normal(t), (0, 10 ** 9)), (-len(t), i))
    assert unique.keys() == {i for _, i in best.values()}
    assert distinct.keys() == {i for i, (_, c) in near_classes(list(unique.items())).items() if i == c}
    pieces = docs.collect()
    assert {r["doc_id"] for r in pieces} == distinct.keys()
    assert {tuple(r)[:5] for r in corpus_pipeline.run(spark, SF01).collect()} == {tuple(r)[:5] for r in pieces}
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_odd_rows(spark, empty):
    """Null texts, ids and labels, repeated and very long rows, clashing columns,
    and no rows at all, through the five stages."""
    docs = messy(spark, [] if empty else TEXTS)
    columns, held = docs.columns, Counter(r["doc_id"] for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF01)
        if name != "packing":
            assert docs.columns == columns
            docs = docs.checkpoint()
            kept = Counter(r["doc_id"] for r in docs.collect())
            assert kept <= held
            if name == "toxicity":
                assert kept == held  # none of them holds a toxic word
            held = kept
    pieces = docs.collect()
    assert {r["doc_id"] for r in pieces} == set(held) and (bool(pieces) or empty)
