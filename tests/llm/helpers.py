"""Messy inputs and brute-force results, independent of the operators' code."""

import hashlib
import re

from pyspark.sql import types as T

WHITE = re.compile(r"[\x20\x09-\x0D]")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
BASE = [f"w{i}" for i in range(120)]


def near(edit: int) -> str:
    """The base text with one word changed; five of its 116 shingles differ."""
    words = list(BASE)
    words[edit] = f"edit{edit}"
    return " ".join(words)


TEXTS = [
    (1, "a b c d e f g"), (2, "a  b c\nd e f g"), (3, "A B C D E F G"), (4, None), (5, ""), (6, " \t\n"), (7, LONG), (8, LONG + " "),
    (9, near(10)), (10, near(60)), (11, near(110)), (12, " ".join(BASE)), (13, "日本語 😀 é"), (14, "one two"), (15, "one  TWO"),
    (16, "a" * 9000), (17, "a b c d e f g"), (20, "the same"), (20, "the same"), (None, "no id"), (None, None),
]

# Columns that results or their intermediate steps also use.
CLASH = ("score", "shard", "slot", "bucket", "place", "ids", "decoded", "keep_id", "group_size", "text_sha256", "_key", "_n",
         "component_id", "kept", "severity", "grade", "label", "n", "piece", "length", "_label", "odd.name",
         "_dropped", "dropped", "_0", "_1", "words_key", "rep", "hub", "node", "p_toxic", "_kept", "_row", "_labelled", "hash", "place_")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASH],
])


def messy(spark, texts=TEXTS):
    rows = [(i, t, None if n % 3 else "en", None if n % 2 else "s", None if t is None else len(t), *["x"] * len(CLASH))
            for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string")


def normal(text):
    return WHITE.sub("", text or "")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def near_classes(texts):
    """{id: (set size, smallest id of its class)} by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in texts}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= 75 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}
