"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every ``window`` consecutive words of a benchmark item are a **window** (an item
of fewer words is one window by itself); a document word inside an occurrence of
a window is hit.

1. A window of ``m`` words is cut into k-grams of ``k = ceil(m / 2)`` words, each
   hashed to 64 bits. Winnowing keeps the smallest hash of every ``m - k + 1``
   consecutive k-grams, which is one window: whatever shares a whole window with
   an item shares that window's fingerprint, so no occurrence can be missed.
2. Documents are winnowed in the scan, in array expressions, and their
   fingerprints joined to the **distinct** fingerprints of the items: a semi-join,
   so a k-gram that many items hold still finds a document position once.
3. A found position is extended: the windows around it are compared with the
   distinct windows of the items, by the hashes of their first and last ``k``
   words, which cover them (128 bits stand for the words of a window).
4. Occurrences of a document are swept by their start for the words they cover,
   and joined to the items that hold the window.

Lengths: nearly all windows have ``window`` words. Shorter items add their own
lengths, at most ``window - 1`` of them, and documents are winnowed once for
each length that occurs.

Scale: documents never leave the scan; about two fingerprints in ``m - k + 2``
positions are compared there with the items' if these number ``BROADCAST_PRINTS``
at most (counted first), and otherwise shuffled by their hash to an equi-join.
What passes, a row per document and the few found positions, is written to the
shared folder. Copies of a row (same id and text) are combined map-side. A
benchmark window that many items hold, or many documents, is one row of the
distinct windows; keys are compared null-safely, so that AQE may split the rows
of a hot document.

Defined cases: a null text has no words, like an empty one; a row with no words
or hits has 0, 0 and the digest of the empty string; repeated rows are returned
as often as they are there; null ids are a document id like any other; an item
without an id marks words but is not counted or listed, and an item id that
repeats is one item with all its texts; an empty benchmark hits nothing; other
columns, of whatever name, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinroll.llm.common import ascii_lower, cut, narrow, quoted

# Fixed value: what stands between words, before A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
BROADCAST_PRINTS = 2_000_000


def words(text: str) -> Column:
    """The words of a text, not yet lower-cased (``word_hashes`` does that, word
    by word: few words need more than the engine's own ``lower``)."""
    return F.array_remove(F.split(F.coalesce(F.col(quoted(text)), F.lit("")), SEPARATORS), "")


def word_hashes(found: str | Column) -> Column:
    return F.transform(found, lambda x: F.xxhash64(ascii_lower(x)))


def gram_words(m: int) -> int:
    return (m + 1) // 2


def gram_hashes(hashes: str, m: int) -> Column:
    """Hashes of the k-grams of a window length, from the words' hashes; only
    where a text has at least one window."""
    k = gram_words(m)
    size = F.size(hashes)
    gram = lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, k)])
    grams = F.slice(F.transform(hashes, gram), F.lit(1), F.greatest(size - (k - 1), F.lit(0)))
    return F.when(size >= m, grams).otherwise(F.array().cast("array<long>"))


def placed(grams: str) -> Column:
    """The hashes with their low four bits replaced by their place modulo 16 (a
    window has nine k-grams at most): the place can be told from the value, and
    it only decides between equal hashes, which are one fingerprint."""
    return F.transform(grams, lambda x, i: x.bitwiseAND(F.lit(~15)).bitwiseOR(F.pmod(i, F.lit(16))))


def window_least(values: str, m: int) -> Column:
    """The least of the placed hashes of every window."""
    span = m - gram_words(m) + 1
    least = lambda x, i: F.least(x, *[F.get(values, i + j) for j in range(1, span)]) if span > 1 else x
    return F.slice(F.transform(values, least), F.lit(1), F.greatest(F.size(values) - (span - 1), F.lit(0)))


def chosen(least: str) -> Column:
    """Places of the k-grams that windows keep; neighbours mostly keep the same."""
    place = lambda x, i: i + F.pmod(x.bitwiseAND(F.lit(15)) - i, F.lit(16)).cast("int")
    return F.array_distinct(F.transform(least, place))


def lengths_of(items: DataFrame, window: int, text_col: str) -> list[int]:
    """The window lengths that occur: at most ``window`` numbers."""
    sizes = items.select(F.least(F.size(words(text_col)), F.lit(window)).alias("m")).filter("m > 0").distinct()
    return sorted(r["m"] for r in sizes.collect())


def item_windows(items: DataFrame, lengths: list[int], window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(m, head, tail, print, item)``: every window of every item, as the
    hashes of its first and last k words, and its fingerprint."""
    texts = narrow(items, item=item_col, word=word_hashes(words(text_col))).filter(F.size("word") > 0)
    texts = texts.withColumn("m", F.least(F.size("word"), F.lit(window)))
    parts = [texts.sparkSession.createDataFrame([], "m int, head long, tail long, print long").crossJoin(texts.limit(0).select("item"))]
    for m in lengths:
        k = gram_words(m)
        grams = texts.filter(F.col("m") == m).withColumn("gram", gram_hashes("word", m)).select(
            "item", "gram", F.posexplode_outer(F.slice("gram", F.lit(1), F.size("gram") - (m - k))).alias("start", "head"))
        parts.append(grams.select(
            F.lit(m).alias("m"), "head", F.get("gram", F.col("start") + (m - k)).alias("tail"),
            F.array_min(F.slice("gram", F.col("start") + 1, F.lit(m - k + 1))).bitwiseAND(F.lit(~15)).alias("print"), "item"))
    return reduce(DataFrame.unionByName, parts).distinct()


def fingerprints(docs: DataFrame, lengths: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, digest, n_words, m, print, place)``: a row per document (``m``
    null) and one per winnowed k-gram, ``place`` its first word; and the
    document's k-gram hashes, ``_gram<m>``, which cost nothing up to a shuffle."""
    texts = narrow(docs, doc=id_col, digest=F.unhex(F.sha2(F.coalesce(F.col(quoted(text_col)), F.lit("")), 256)),
                   found=words(text_col))
    texts = texts.select("doc", "digest", F.size("found").cast("long").alias("n_words"), word_hashes("found").alias("word"))
    prints, codes = [F.array(F.lit(None).cast("long"))], [F.array(F.lit(0))]
    for m in lengths:
        gram, places = f"_gram{m}", f"_places{m}"
        texts = texts.withColumn(gram, gram_hashes("word", m)).withColumn("_placed", placed(gram))
        texts = texts.withColumn("_least", window_least("_placed", m)).withColumn(places, chosen("_least"))
        prints.append(F.transform(places, _print_at(gram)))
        codes.append(F.transform(places, _code_of(m)))
    grams = [f"_gram{m}" for m in lengths]
    texts = texts.select("doc", "digest", "n_words", *grams, F.concat(*prints).alias("prints"), F.concat(*codes).alias("codes"))
    # outer: else the planner infers a filter on the list's size, and computes the list a second time for it
    rows = texts.select("doc", "digest", "n_words", *grams, "codes", F.posexplode_outer("prints").alias("at", "print"))
    code = F.get("codes", F.col("at"))
    return rows.select("doc", "digest", "n_words", *grams, F.when(F.col("at") > 0, code % 32).alias("m"), "print",
                       F.floor(code / 32).cast("int").alias("place"))


def _print_at(gram: str):
    return lambda p: F.get(gram, p).bitwiseAND(F.lit(~15))


def _code_of(m: int):
    return lambda p: p * 32 + F.lit(m)


def with_near(prints: DataFrame, lengths: list[int]) -> DataFrame:
    """``near``: the hashes of the k-grams that begin or end a window around the
    fingerprint; the k-gram hashes of the whole document stay behind."""
    near = F.lit(None).cast("array<long>")
    for m in lengths:
        around = m - gram_words(m)
        part = F.slice(f"_gram{m}", F.greatest(F.col("place") - around, F.lit(0)) + 1, F.least("place", F.lit(around)) + around + 1)
        near = F.when(F.col("m") == m, part).otherwise(near)
    return prints.withColumn("near", near).drop(*[f"_gram{m}" for m in lengths])


def found_windows(found: DataFrame, windows: DataFrame) -> DataFrame:
    """The windows of ``windows(m, head, tail)`` around the found fingerprints:
    ``(doc, digest, start, m, head, tail)``, each occurrence once."""
    around = F.col("m") - F.ceil(F.col("m") / 2).cast("int")
    first = F.greatest(F.col("place") - around, F.lit(0))
    starts = found.select("doc", "digest", "m", "near", first.alias("first"), around.alias("around"),
                          F.explode(F.sequence(first, F.col("place"))).alias("start"))
    spans = starts.select(
        "doc", "digest", "start", "m", F.get("near", F.col("start") - F.col("first")).alias("head"),
        F.get("near", F.col("start") - F.col("first") + F.col("around")).alias("tail")).filter("tail IS NOT NULL").distinct()
    return spans.join(windows, ["m", "head", "tail"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", broadcast_prints: int = BROADCAST_PRINTS) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for every
    row of ``docs``, the id under its own name."""
    if not 1 <= window <= 16:
        raise ValueError("window must be from 1 to 16 words")
    lengths = lengths_of(items, window, item_text_col)
    held = cut(item_windows(items, lengths, window, item_col, item_text_col))
    prints = held.select("m", "print").distinct().withColumn("known", F.lit(True))
    rows, known = fingerprints(docs, lengths, id_col, text_col), F.col("m").isNull() | F.col("known")
    if prints.count() <= broadcast_prints:
        rows = with_near(rows.join(F.broadcast(prints), ["m", "print"], "left").filter(known), lengths)
    else:
        rows = with_near(rows, lengths).join(prints, ["m", "print"], "left").filter(known)
    kept = cut(rows.select("doc", "digest", "n_words", "m", "place", "near"))

    copies = kept.filter("m IS NULL").groupBy("doc", "digest", "n_words").agg(F.count(F.lit(1)).alias("copies"))
    hits = cut(found_windows(kept.filter("m IS NOT NULL"), held.select("m", "head", "tail").distinct()))

    by_start = Window.partitionBy("doc", "digest").orderBy("start", "end")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    covered = hits.select("doc", "digest", "start", (F.col("start") + F.col("m")).alias("end")).withColumn("reached", reached).select(
        "doc", "digest", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("reached", F.lit(0)))).alias("new"))
    covered = covered.groupBy("doc", "digest").agg(F.sum("new").alias("n_hit"))

    listed = hits.select("doc", "digest", "m", "head", "tail").distinct().join(held.select("m", "head", "tail", "item"), ["m", "head", "tail"])
    listed = listed.select("doc", "digest", "item").distinct().groupBy("doc", "digest").agg(
        F.count("item").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(F.col("item").cast("string")))), 256).alias("items_sha256"))

    a, h, i = copies.alias("a"), covered.alias("h"), listed.alias("i")
    same = lambda x, y: F.expr(f"{x}.doc <=> {y}.doc AND {x}.digest <=> {y}.digest")
    out = a.join(h, same("a", "h"), "left").join(i, same("a", "i"), "left").select(
        F.col("a.doc").alias(id_col), F.col("a.n_words").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.expr("explode(array_repeat(1, int(copies)))"))
    return out.drop("col")
