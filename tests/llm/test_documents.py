"""Exact and near dedup, sharding, packing, byte-level BPE against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinroll.llm import byte_bpe, exact_dedup, near_dedup, packing, sharding
from kinroll.llm.queries import QUERIES, RANKS, TOKENIZER
from kinroll.sources import read_table
from tests.conftest import SF01

from .helpers import TEXTS, as_set, messy, near, near_classes, normal, plain, sha

PATTERN = public_tokenizers.PATTERN
SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in read_table(spark, SF01, "documents").collect()]


# ---- exact dedup ----

def brute_groups(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[normal(t)].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for i, t in texts:
        g = groups[normal(t)]
        out[(i, min(g)[3], len(g), i == min(g)[3], sha(normal(t)))] += 1
    return out


def test_exact_groups(spark):
    found = exact_dedup.duplicate_groups(messy(spark), page_bytes=1000)
    rows = Counter(tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert rows == brute_groups(TEXTS)


def test_exact_dedup_keeps_one_row_each(spark):
    df = messy(spark)
    kept = exact_dedup.dedup(df, page_bytes=1000)
    assert kept.columns == df.columns
    assert Counter(normal(r["text"]) for r in kept.collect()) == Counter({normal(t): 1 for _, t in TEXTS})


def test_exact_chain_compares_bytes(spark, monkeypatch):
    """With a key that collides for every text, chains still tell them apart."""
    chain = exact_dedup._Chain()
    for text, i in ((b"x", 1), (b"y", 2), (b"x", 0)):
        chain.add(text, 1, exact_dedup._rank(1, i), i)
    assert [(m[0], m[1], m[3]) for m in chain.members] == [(b"x", 2, 0), (b"y", 1, 2)]


def test_directory_splits_and_doubles():
    weights = np.zeros(1 << 16, dtype=np.int64)
    weights[:4] = 100           # one dense corner, splittable
    weights[40_000] = 5000      # one heavy prefix, not splittable
    directory = exact_dedup.Directory.build(weights, 150)
    assert directory.depth == 16
    keys = (np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
    held = np.bincount(directory.bucket_of(keys), weights=weights, minlength=directory.buckets)
    assert (held <= 150).sum() == directory.buckets - 1 and held.max() == 5000
    assert (np.diff(directory.bucket_of(keys)) >= 0).all()  # key ranges
    assert exact_dedup.Directory.build(weights, 10 ** 6).buckets == 1


def test_exact_empty(spark):
    assert exact_dedup.duplicate_groups(messy(spark, [])).count() == 0


# ---- near dedup ----

def test_near_classes(spark):
    texts = [(i, t) for i, t in TEXTS if i not in (None, 20)] + [(100 + e, near(e)) for e in range(5, 110, 7)] + [(20, "the same")]
    found = {r[0]: (r[1], r[2]) for r in near_dedup.near_duplicates(messy(spark, texts)).collect()}
    assert found == near_classes(texts)


def test_near_odd_rows(spark):
    found = near_dedup.near_duplicates(messy(spark)).collect()
    assert len(found) == len(TEXTS)
    assert {tuple(r)[1:] for r in found if r["doc_id"] is None} == {(1, None, True), (0, None, True)}
    assert [tuple(r) for r in found if r["doc_id"] == 20] == [(20, 1, 20, True)] * 2
    assert near_dedup.near_duplicates(messy(spark, [])).count() == 0
    df = messy(spark)
    assert near_dedup.dedup(df).columns == df.columns


@pytest.mark.parametrize("edits", [3, 9])
def test_near_family_without_a_common_hub(spark, monkeypatch, edits):
    """Copies edited so much that most do not match their hub: block pairs find
    every link, also with many small blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 2000)
    rng = random.Random(edits)
    base = [f"v{i}" for i in range(400)]
    texts = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(400), rng.randrange(edits, 4 * edits)):
            words[at] = f"new{i}x{at}"
        texts.append((i, " ".join(words)))
    found = {r[0]: (r[1], r[2]) for r in near_dedup.near_duplicates(plain(spark, texts)).collect()}
    assert found == near_classes(texts)


@pytest.mark.parametrize("block", [500, 4000, 100_000])
def test_near_sieve_lets_only_possible_partners_pass(spark, monkeypatch, block):
    """Members that share a passage but resemble nobody ship no set; those that
    may be linked do, with the right parts, and every link comes out."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(-2 ** 62, 2 ** 62, n)
    passage = draw(60)
    sets = {i: np.unique(np.concatenate([passage, draw(200)])) for i in range(1, 120)}
    sets[200], sets[201] = np.append(sets[5], 2 ** 62), sets[7][:-3]  # near copies of 5 and 7
    sets[300], sets[301] = np.arange(20), np.arange(16)  # smaller than a sketch
    held = spark.createDataFrame([(i, s.tolist()) for i, s in sets.items()], "rep long, hashes array<long>")
    members = spark.createDataFrame([(0, i, False) for i in sets], "hub long, rep long, linked boolean")
    passed = near_dedup.possible_members(members, held).collect()
    assert {r["rep"] for r in passed} == {5, 200, 7, 201, 300, 301}
    pairs = defaultdict(set)
    for r in passed:
        pairs[r["lo"], r["hi"]].add((r["rep"], r["side"]))
    assert len(passed) == len({(r["rep"], r["lo"], r["hi"]) for r in passed}) and all(len(p) > 1 for p in pairs.values())
    links = {(min(r), max(r)) for r in near_dedup._block_pairs(members, held).collect()}
    assert links == {(5, 200), (7, 201), (300, 301)}


def test_near_whole_table(spark, documents):
    found = {r[0]: (r[1], r[2]) for r in QUERIES["op3_near_dedup"](spark, SF01).collect()}
    assert found == near_classes(documents)


# ---- sharding ----

def test_shards_hold_every_row_once(spark, documents):
    rows = QUERIES["op4_sharding"](spark, SF01).collect()
    sizes = {i: len((t or "").encode()) + 1 for i, t in documents}
    crcs = {i: zlib.crc32((t or "").encode()) for i, t in documents}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (sizes[i], crcs[i]) for i in sizes} and len(rows) == len(sizes)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
    assert sorted(by_shard) == list(range(8))
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    moved = sum(r["grown_shard"] == 8 for r in rows)
    assert 0.5 < moved / (len(rows) / 9) < 1.6
    order = [i for _, i in sorted((r["slot"], r["doc_id"]) for r in rows if r["shard"] == 0)]
    assert order != sorted(order)


def test_shards_odd_rows_many_buckets(spark):
    df = messy(spark)
    found = sharding.shuffled_shards(df, 3, 5, bucket_bytes=5000)
    assert set(found.columns) == set(df.columns) | {"shard", "slot", "bucket"}
    rows = found.select("doc_id", "text", "shard", "slot").collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(TEXTS)
    for s in range(3):
        slots = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(slots) == list(range(len(slots)))
    again = sharding.shuffled_shards(messy(spark).repartition(7), 3, 5, bucket_bytes=5000)
    assert as_set(again, "doc_id", "text", "shard", "slot") == {tuple(r) for r in rows}  # whatever the partitioning
    assert sharding.shuffled_shards(messy(spark, []), 3).count() == 0


@pytest.mark.parametrize("tasks", [3, 20_000])
def test_shards_spread_a_repeated_row(spark, monkeypatch, tasks):
    """A row repeated until it fills many buckets is split, by the rows alone;
    a task may hold several buckets."""
    monkeypatch.setattr(sharding, "TASKS", tasks)
    texts = [(7, "again and again")] * 3000 + [(i, f"text {i}") for i in range(400)]
    rows = [(i, t, n % 2 if i == 9 else 0) for n, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other int")
    found = sharding.shuffled_shards(df.repartition(5), 3, 1, bucket_bytes=2000)
    assert found.rdd.getNumPartitions() <= tasks
    out = found.collect()
    assert Counter((r["doc_id"], r["text"], r["other"]) for r in out) == Counter(rows)
    held = Counter(r["bucket"] for r in out)
    assert max(held.values()) * 16 < 2 * 2000  # no bucket of more than twice the size planned
    for s in range(3):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    again = sharding.shuffled_shards(df.repartition(2), 3, 1, bucket_bytes=2000).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_shards_with_a_map_column(spark):
    df = spark.range(40).selectExpr("id AS doc_id", "'t' AS text", "map('k', id) AS extra")
    rows = sharding.shuffled_shards(df, 2, bucket_bytes=50).collect()
    assert sorted((r["doc_id"], r["extra"]["k"]) for r in rows) == [(i, i) for i in range(40)]


def test_shard_growth(spark):
    keys = spark.range(4000)
    for n in (1, 2, 7):
        rows = keys.select(sharding.shard_of(F.col("id"), n, 1).alias("a"), sharding.shard_of(F.col("id"), n + 1, 1).alias("b")).collect()
        assert all(r["b"] in (r["a"], n) and 0 <= r["a"] < n for r in rows)
        assert abs(sum(r["b"] == n for r in rows) - 4000 / (n + 1)) < 250


def test_written_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.shuffled_shards(plain(spark, [(i, f"t{i}") for i in range(50)]), 4), path)
    assert spark.read.parquet(path).count() == 50


def test_slot_order_without_broadcast(spark, tmp_path, monkeypatch):
    docs = plain(spark, [(i, f"t{i}" * 20) for i in range(3000)]).repartition(5)
    expected = as_set(sharding.shuffled_shards(docs, 3, bucket_bytes=4000), "doc_id", "bucket", "slot")
    monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shards = sharding.shuffled_shards(docs, 3, bucket_bytes=4000)
        last = shards._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
        assert last.startswith("Sort [shard#") and last.index("bucket#") < last.index("slot#") and last.rstrip().endswith("false")
        parts = [[(r["shard"], r["bucket"], r["slot"]) for r in p] for p in shards.rdd.glom().collect()]
        assert all(p == sorted(p) for p in parts) and sum(map(len, parts)) == 3000
        assert as_set(shards, "doc_id", "bucket", "slot") == expected
        sharding.write_shards(shards, str(tmp_path / "shards"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    files = list((tmp_path / "shards").rglob("*.parquet"))
    for slots in (pq.read_table(f, partitioning=None)["slot"].to_pylist() for f in files):
        assert slots == sorted(slots)


# ---- packing ----

def check_packing(rows, texts, capacity=2048):
    tok = Tokenizer.from_file(TOKENIZER)
    tok.encode_special_tokens = True
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] <= capacity
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, x in ids.items():
        got = sorted(pieces[i])
        assert [p[0] for p in got] == list(range(len(got))) and sum(p[2] for p in got) == len(x)
        assert all(p[2] == capacity for p in got[1:])
        assert len(x) > capacity or len(got) == 1
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(map(len, ids.values())) // capacity)


def test_packing_whole_table(spark, documents):
    used, least = check_packing(QUERIES["op5_packing"](spark, SF01).collect(), documents)
    assert used <= least + max(2, least // 200)


def test_packing_odd_rows(spark):
    texts = [(i, t) for i, t in TEXTS if i not in (None, 20)] + [(20, "the same")]
    check_packing(packing.pack(messy(spark, texts), TOKENIZER, PATTERN).collect(), texts)
    both = packing.pack(messy(spark), TOKENIZER, PATTERN).collect()
    assert sum(r["doc_id"] == 20 for r in both) == 2 and sum(r["doc_id"] is None for r in both) == 2
    assert len({(r["sequence_id"], r["offset"]) for r in both}) == len(both)
    assert packing.pack(messy(spark, []), TOKENIZER, PATTERN).count() == 0


def test_added_tokens_have_the_library_ids(spark):
    tok = Tokenizer.from_file(TOKENIZER)  # unmodified
    ids_of = packing.TextIds(open(TOKENIZER, encoding="utf-8").read(), PATTERN)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "日本 <|endoftext|><|endoftext|>é", "a <|endoftext| > b", "plain é"]
    expected = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[0] == [64, 220, 50256, 275]
    assert [ids_of(t).tolist() for t in texts] == expected
    rows = {r["doc_id"]: r for r in packing.pack(plain(spark, list(enumerate(texts))), TOKENIZER, PATTERN).collect()}
    for i, ids in enumerate(expected):
        assert (rows[i]["length"], rows[i]["ids_crc32"]) == (len(ids) + 1, zlib.crc32(np.array([*ids, 0], dtype="<u4").tobytes()))


def test_plan_uses_every_piece():
    rng = np.random.default_rng(3)
    for capacity in (1, 7, 50, 2048):
        counts = np.zeros(capacity + 1, dtype=np.int64)
        counts[1:] = rng.integers(0, 40, capacity)
        plan = packing.packing_plan(counts)
        used = np.zeros_like(counts)
        for pattern, times in plan:
            assert times > 0 and sum(n * k for n, k in pattern) <= capacity
            for n, k in pattern:
                used[n] += k * times
        assert (used == counts).all()


@pytest.mark.parametrize("sums", [(5,), (2, 3), (1, 2, 2), (1, 1, 3)])
def test_exact_complements(sums):
    counts = np.zeros(11, dtype=np.int64)
    for n in sums:
        counts[n] += 1
    assert sorted(packing._Lengths(counts).exact(5)) == sorted(sums)
    assert packing._Lengths(counts).exact(9) == ()


def test_latin_1_ids_agree_with_the_library():
    ids_of = packing.TextIds(open(TOKENIZER, encoding="utf-8").read(), PATTERN)
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice([*map(chr, range(256)), "<|endoftext|>", "ing", "  "]) for _ in range(rng.randrange(60)))
        assert ids_of.fast.encode_ordinary(text) == ids_of.exact.encode(text, add_special_tokens=False).ids


# ---- byte-level BPE ----

@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(open(RANKS, "rb").read())
    return ranks, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_whole_table(spark, documents, library):
    rows = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op2_byte_bpe"](spark, SF01).collect()}
    for i, t in documents:
        ids = library[1].encode_ordinary(t or "")
        assert rows[i] == (len(ids), sha(" ".join(map(str, ids))), sha((t or "").encode()))


def test_bpe_odd_rows(spark, library):
    df = messy(spark)
    found = byte_bpe.decode(byte_bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    rows = found.select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert list(r["ids"]) == library[1].encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert byte_bpe.encode(messy(spark, []), RANKS, PATTERN).count() == 0


def test_bpe_against_the_library(library):
    coder = byte_bpe.ByteBpe(library[0], PATTERN)
    rng = random.Random(4)
    parts = ["a", "e", "the", " ", "\n", "\t", "é", "日本", "😀", "-", "1", "23", "==", "x", "ing", "\x1c", "\x85", "　", "'s", "."]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        assert coder.encode(text) == library[1].encode_ordinary(text)
    for text in ("-" * 20_000, " " * 10_001 + "a", "ab" * 9000, "é" * 6000, "ungungung" * 1000):
        assert coder.encode(text) == library[1].encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()


def test_ascii_pattern_splits_alike():
    coder = byte_bpe.ByteBpe({bytes([b]): b for b in range(256)}, PATTERN)
    pool = [chr(c) for c in range(128)] + list("  \n\t'stredlvm ab12..") * 4
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choices(pool, k=rng.randint(1, 14)))
        assert coder.split_ascii.findall(text) == coder.split.findall(text), text
    assert byte_bpe.ascii_pattern(r"\w+|.") is None and byte_bpe.ascii_pattern(r"[\S]") is None


def test_bpe_memo_generations(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_WORDS", 5)
    ranks, own = library
    coder = byte_bpe.ByteBpe(ranks, PATTERN)
    rng = random.Random(4)
    for _ in range(300):
        text = " ".join(f"oddword{rng.randint(0, 12)}é" for _ in range(6))
        assert coder.encode(text) == own.encode_ordinary(text)
        assert len(coder.packed) <= 5 and len(coder.packed.older) <= 5


def test_bpe_small_vocabularies():
    """Against plain merging, with merges learnt from random words of few letters."""
    rng = random.Random(5)
    for letters in ("ab", "abc", "abcd") * 6:
        corpus = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 14))) for _ in range(60)]
        ranks = {bytes([b]): b for b in range(256)}
        for rank in range(256, 256 + 40):
            seen = Counter()
            for word in corpus:
                parts = byte_bpe.merged(word.encode(), ranks, rank)
                seen.update(a + b for a, b in zip(parts, parts[1:], strict=False))
            new = [t for t, _ in seen.most_common(3) if t not in ranks]
            if new:
                ranks[rng.choice(new)] = len(ranks)
        coder = byte_bpe.ByteBpe(ranks, f"[{letters}]+")
        for _ in range(300):
            word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 40)))
            assert list(coder.encode_match(word)) == [ranks[p] for p in byte_bpe.merged(word.encode(), ranks, len(ranks))]
