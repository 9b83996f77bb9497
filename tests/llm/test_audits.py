"""Source divergence, benchmark decontamination and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinroll.llm import decontaminate, periodic_runs, source_divergence

from .helpers import CLASH, messy

CLASHES = (*CLASH, "chunk", "mark", "term", "lang_n", "digest", "m", "print", "place", "near", "prints", "codes", "copies",
           "start", "length", "period", "n_runs", "n_words", "part", "item", "value", "rank", "block", "r0", "c0", "_placed", "known")


def rows(spark, texts, columns, extra=CLASHES):
    """Rows of ``columns`` with further columns whose names the operators use."""
    kinds = {"doc_id": T.LongType(), "item_id": T.LongType()}
    names = [c for c in extra if c not in columns]
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in (*columns, *names)])
    return spark.createDataFrame([(*t, *["x"] * len(names)) for t in texts], schema).repartition(3)


# ---- source divergence ----

def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def brute_divergence(docs, top=200, least=3):
    docs = [(lang or "", source or "", terms_of(text)) for lang, source, text in docs]
    held, count, groups = defaultdict(int), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        groups[lang].add(source)
        count[lang, source].update(terms)
        for t in set(terms):
            held[lang, t] += 1
    out = set()
    for lang, sources in groups.items():
        kept = [t for (x, t), n in held.items() if x == lang and n >= least]
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}

        def share(n, total, kept=kept):
            return 1 + 10 ** 9 * (n + 1) // (total + len(kept))

        def ranked(part, found, s, lang=lang):
            for rank, (v, item) in enumerate(sorted((-v, i.encode()) for i, v in found), 1):
                if part == "pair" or rank <= top:
                    out.add((lang, s, part, item.decode(), -v, rank))

        for s in sources:
            p = {t: share(count[lang, s][t], total[s]) for t in kept}
            others = []
            for o in sources - {s}:
                q = {t: share(count[lang, o][t], total[o]) for t in kept}
                others.append((o, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)))
            ranked("pair", others, s)
            all_q = {t: share(sum(count[lang, x][t] for x in sources), sum(total.values())) for t in kept}
            ranked("term", [(t, (p[t] - all_q[t]) ** 2 // all_q[t]) for t in kept if count[lang, s][t] and p[t] > all_q[t]], s)
    return out


AUDIT = [
    ("en", "a", "the cat, the Cat's hat"), ("en", "b", "the dog and the hat-rack"), ("en", "a", "cat. cat! (cat)"), ("en", "c", None),
    ("en", "b", "rack hat the"), (None, None, "the the"), ("de", "a", "Äpfel äpfel die"), ("de", "b", "die Äpfel"), ("de", "c", "die äpfel-die"),
    ("fr", "a", ""), ("fr", "b", "seul"), ("en", "hot", "lone-x lone-y"), ("en", "hot", "lone-z"), ("en", "hot", "x1lone y"),
    ("en", "d", "twice-a twice-b twice-c"), ("en", "d", "twice"), ("es", "z", " dos  dos dos\x1f"), ("es", "z", "dos"), ("es", "y", "dos"),
    ("en", "a", "the cat, the Cat's hat"),
]


def report(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("entries,cells", [(500_000, 500_000), (1, 3)])
def test_divergence(spark, monkeypatch, entries, cells):
    monkeypatch.setattr(source_divergence, "ENTRIES", entries)
    monkeypatch.setattr(source_divergence, "CELLS", cells)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["a-b", "b.a", "é", "É", "X", "x"]
    docs = AUDIT + [("en" if rng.random() < 0.7 else "de", f"s{int(4 * rng.random() ** 2)}",
                     " ".join(rng.choices(words, k=rng.randrange(30)))) for _ in range(80)]
    df = rows(spark, docs, ("lang", "source", "text"))
    assert report(source_divergence.divergence(df)) == brute_divergence(docs)
    assert report(source_divergence.divergence(df, top=2)) == brute_divergence(docs, top=2)


def test_divergence_counts_a_document_once(spark):
    """A term in three chunks of two documents is in two documents."""
    docs = [("en", "a", "x-a x-b"), ("en", "a", "x-c"), ("en", "b", "y"), ("en", "b", "y"), ("en", "b", "y")]
    kept = source_divergence.kept_counts(rows(spark, docs, ("lang", "source", "text")))
    assert {(r["term"], r["n"]) for r in kept.collect()} == {("y", 3)}
    docs.append(("en", "c", "x"))
    kept = source_divergence.kept_counts(rows(spark, docs, ("lang", "source", "text")))
    assert {(r["source"], r["term"], r["n"], r["lang_n"]) for r in kept.collect()} == {
        ("b", "y", 3, 3), ("a", "x", 3, 4), ("c", "x", 1, 4)}


def test_divergence_edges(spark):
    empty = rows(spark, [], ("lang", "source", "text"))
    assert report(source_divergence.divergence(empty)) == set()
    long = [("en", s, " ".join(f"w{i % (900 + k)}" for i in range(30_000))) for k, s in enumerate("abcb")]
    assert report(source_divergence.divergence(rows(spark, long, ("lang", "source", "text")))) == brute_divergence(long)
    with pytest.raises(ValueError):
        source_divergence.divergence(empty, min_docs=4)
    big = np.array([10 ** 17, 0, 5], dtype=np.int64)
    assert source_divergence.shares(big, np.int64(3 * 10 ** 17)).tolist() == [1 + 10 ** 9 * (int(x) + 1) // (3 * 10 ** 17) for x in big]


# ---- decontamination ----

def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute_contamination(docs, items, window=10):
    windows = defaultdict(set)
    for i, text in items:
        w = bench_words(text)
        m = min(len(w), window)
        for s in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[s:s + m])].add(i)
    out = Counter()
    for i, text in docs:
        w, hit, found = bench_words(text), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if tuple(w[s:s + m]) in windows:
                    hit.update(range(s, s + m))
                    found |= windows[tuple(w[s:s + m])]
        ids = sorted(str(x) for x in found if x is not None)
        out[i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)] += 1
    return out


def verdicts(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())


PASSAGE = [f"p{i}" for i in range(30)]
ITEMS = [(1, " ".join(PASSAGE)), (2, " ".join(PASSAGE[5:17])), (10, "Same, same same same same same same same same same same same"),
         (3, " ".join(PASSAGE[:10])), (None, "no id but ten words are here in this one item"), (4, None), (5, " ?! "), (2, "z " * 12)]
NOISE = " ".join(f"n{i}" for i in range(25))
TEXTS = [(1, " ".join(PASSAGE)), (2, NOISE + " " + " ".join(PASSAGE[3:14]) + " tail"), (3, " ".join(PASSAGE[3:12])), (4, None), (5, ""),
         (6, "same " * 40), (7, NOISE), (7, NOISE), (None, " ".join(PASSAGE[:11])), (None, None), (8, "z Z; z! " * 9),
         (9, " ".join(PASSAGE[20:] + PASSAGE[:20])), (11, "no id but ten words are here in this one item"),
         (12, " ".join(f"word{i % 977}" for i in range(20_000)) + " " + " ".join(PASSAGE).upper())]


@pytest.mark.parametrize("broadcast", [10 ** 6, 0])
def test_contamination(spark, broadcast):
    docs, items = rows(spark, TEXTS, ("doc_id", "text")), rows(spark, ITEMS, ("item_id", "text"))
    found = decontaminate.contamination(docs, items, broadcast_prints=broadcast)
    assert verdicts(found) == brute_contamination(TEXTS, ITEMS)


@pytest.mark.parametrize("window,seed", [(10, 1), (10, 2), (7, 3), (1, 4), (16, 5)])
def test_contamination_short_items_and_repeats(spark, window, seed):
    """Few distinct words, so hashes repeat in every window, and items of all lengths."""
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choices("abcX", k=n))
    items = [(i, text(rng.choice([1, 3, 6, 9, 10, 11, 25]) + seed)) for i in range(6)]
    docs = [(i, text(rng.randrange(120))) for i in range(40)]
    found = decontaminate.contamination(rows(spark, docs, ("doc_id", "text")), rows(spark, items, ("item_id", "text")), window)
    assert verdicts(found) == brute_contamination(docs, items, window)


def test_contamination_edges(spark):
    docs, none = rows(spark, TEXTS, ("doc_id", "text")), rows(spark, [], ("item_id", "text"))
    assert verdicts(decontaminate.contamination(docs, none)) == brute_contamination(TEXTS, [])
    assert decontaminate.contamination(docs.limit(0), rows(spark, ITEMS, ("item_id", "text"))).count() == 0
    with pytest.raises(ValueError):
        decontaminate.contamination(docs, none, window=17)


def test_contamination_is_native(spark):
    rows_ = decontaminate.fingerprints(rows(spark, TEXTS, ("doc_id", "text")), [10])
    plan = rows_._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- periodic runs ----

def brute_runs(words, min_length=6, min_exponent=4):
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_exponent * q):
                out.setdefault((i, j + q), q)
            i = j
    return sorted((b, e - b, q) for (b, e), q in out.items())


@pytest.mark.parametrize("seed", range(4))
def test_find_runs(seed):
    rng = random.Random(seed)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 6)):
            d = [rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randint(0, 40))]
            if rng.random() < 0.5:
                d = (d[:5] + d[:rng.randint(1, 4)] * 30)[:len(d)]
            docs.append(d)
        least = rng.choice([(6, 4), (1, 2), (3, 3), (2, 2)])
        bounds = np.cumsum([0, *map(len, docs)])
        found = periodic_runs.find_runs(np.array([w for d in docs for w in d], dtype=np.int64), bounds, *least)
        brute = [(s + b, n, q) for d, b in zip(docs, bounds, strict=False) for s, n, q in brute_runs(d, *least)]
        assert list(zip(*(x.tolist() for x in found), strict=True)) == sorted(brute, key=lambda r: (r[0], r[2]))


def test_find_runs_in_one_long_text():
    words = np.tile(np.arange(7), 30_000)
    assert [x.tolist() for x in periodic_runs.find_runs(words, np.array([0, len(words)]))] == [[0], [len(words)], [7]]


def brute_digest(i, text, rewrite):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(i).encode())
    if rewrite and i is not None and h % 10 == 0 and words:
        n, g, own = len(words), h // 10, list(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [own[k] if k < a else own[a + (k - a) % p] for k in range(n)]
    runs = brute_runs(words)
    top = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[0] if runs else (None,) * 3
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (i, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


@pytest.mark.parametrize("rewrite", [None, periodic_runs.echo_tail])
def test_run_digests(spark, monkeypatch, rewrite):
    monkeypatch.setattr(periodic_runs, "WORDS", 200)
    rng = random.Random(9)
    texts = [(i, " ".join(rng.choices(["a", "b", "A", "é ", "long"], k=rng.randrange(70)))) for i in range(60)]
    texts += [(61, None), (62, ""), (63, " \t\n"), (None, "x " * 9), (None, None), (64, "x y " * 200), (64, "x y " * 200), (65, "a\x1fb " * 6)]
    df = rows(spark, texts, ("doc_id", "text"))
    found = periodic_runs.run_digests(df, rewrite=rewrite)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == Counter(brute_digest(i, t, rewrite) for i, t in texts)
    if rewrite is None:
        spans = periodic_runs.periodic_runs(df)
        brute = Counter((i, *r) for i, t in texts for r in brute_runs(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
        assert Counter(tuple(r) for r in spans.collect()) == brute


def test_runs_edges(spark):
    assert periodic_runs.run_digests(messy(spark, [])).count() == 0
    long = [(i, "r s t " * 3000 + " ".join(f"w{k}" for k in range(4000))) for i in range(12)]
    found = periodic_runs.run_digests(rows(spark, long, ("doc_id", "text")), rewrite=periodic_runs.echo_tail)
    echoed = {i: b" ".join(periodic_runs.echo_tail(t.encode().split(), i)).decode() for i, t in long}
    assert any(echoed[i] != " ".join(t.split()) for i, t in long)
    top = {r["doc_id"]: (r["start"], r["period"]) for r in found.filter(F.col("n_runs") > 0).collect()}
    assert len(top) == len(long)
