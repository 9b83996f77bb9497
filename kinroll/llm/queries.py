"""The registered queries of this package: one for each operator, over the whole
intended table, with production parameters; and DuckDB SQL where it can say the
same. Results that SQL cannot state are tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinroll.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    lm_scoring,
    near_dedup,
    packing,
    periodic_runs,
    quality_fm,
    sharding,
    source_divergence,
    topk_search,
    toxicity,
)
from kinroll.sources import read_table

SHARDS = 8
SHARD_SEED = 2024
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def toxicity_severity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.scored(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def bpe_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return byte_bpe.digests(read_table(spark, d, "documents"), RANKS, public_tokenizers.PATTERN)


def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, d, "documents"))


def sharded(spark: SparkSession, d: str) -> DataFrame:
    """Law ``key``: the shard follows from doc_id and the shard count."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return sharding.shuffled_shards(docs, SHARDS, SHARD_SEED).select(
        "doc_id", sharding.record_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot",
        sharding.shard_of(F.col("doc_id"), SHARDS + 1, SHARD_SEED).alias("grown_shard"))


def packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_table(spark, d, "documents"), TOKENIZER, public_tokenizers.PATTERN)


def lm_scores(spark: SparkSession, d: str) -> DataFrame:
    return lm_scoring.scored(read_table(spark, d, "documents"))


def quality_scores(spark: SparkSession, d: str) -> DataFrame:
    return quality_fm.scored(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def nearest_vectors(spark: SparkSession, d: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


def preference_pairs(spark: SparkSession, d: str) -> DataFrame:
    return chat_format.derived_segments(read_table(spark, d, "conversations")).withColumnRenamed("pair", "conv_id")


def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read_table(spark, d, "documents"))


def source_audit(spark: SparkSession, d: str) -> DataFrame:
    return source_divergence.divergence(read_table(spark, d, "documents"))


def contaminated_documents(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


def word_runs(spark: SparkSession, d: str) -> DataFrame:
    return periodic_runs.run_digests(read_table(spark, d, "documents"), rewrite=periodic_runs.echo_tail)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity_severity,
    "op2_byte_bpe": bpe_round_trip,
    "op3_near_dedup": near_duplicates,
    "op4_sharding": sharded,
    "op5_packing": packed,
    "op6_lm_scoring": lm_scores,
    "op7_quality": quality_scores,
    "op8_topk_search": nearest_vectors,
    "op9_chat_format": preference_pairs,
    "op10_exact_dedup": exact_duplicates,
    "op11_source_divergence": source_audit,
    "op12_decontaminate": contaminated_documents,
    "op13_periodic_runs": word_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op8_topk_search": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op9_chat_format": r"""
WITH turns AS (
    SELECT conv_id, turn, min({'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}) AS s
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL
), t AS (SELECT conv_id, turn, s.role AS role, s.text AS text FROM turns),
ends AS (
    SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last, min(turn) FILTER (role = 'assistant') AS first_reply,
           arg_min(text, turn) FILTER (role = 'assistant') AS reply, arg_max(text, turn) FILTER (role = 'assistant') AS last_reply,
           arg_min(text, turn) AS opening, max(turn) AS final, strpos('0123456789abcdef', md5(CAST(conv_id AS VARCHAR))[1]) - 1 AS digit
    FROM t GROUP BY conv_id
), rejected AS (
    SELECT t.conv_id, turn, role, CASE
        WHEN digit < 6 AND turn = last THEN CASE WHEN first_reply < last THEN reply ELSE opening END
        WHEN digit BETWEEN 6 AND 8 AND turn = first_reply THEN opening ELSE text END AS text
    FROM t JOIN ends USING (conv_id)
    WHERE digit < 15 AND NOT (digit BETWEEN 9 AND 11 AND last IS NOT NULL AND turn >= last)
    UNION ALL SELECT conv_id, final + 1, 'assistant', last_reply FROM ends WHERE digit BETWEEN 12 AND 14 AND last IS NOT NULL
), both_sides AS (
    SELECT conv_id, turn, t.role AS role, t.text AS text, r.role AS other_role, r.text AS other,
           coalesce(t.role = r.role AND t.text = r.text, FALSE) AS same
    FROM t FULL JOIN rejected r USING (conv_id, turn)
), split AS (
    SELECT *, min(CASE WHEN NOT same THEN turn END) OVER (PARTITION BY conv_id) AS first FROM both_sides
), sides AS (
    SELECT conv_id, 'prompt' AS side, turn, role, text FROM split WHERE first IS NULL OR turn < first
    UNION ALL SELECT conv_id, 'chosen', turn, role, text FROM split WHERE turn >= first AND role IS NOT NULL
    UNION ALL SELECT conv_id, 'rejected', turn, other_role, other FROM split WHERE turn >= first AND other_role IS NOT NULL
), shown AS (
    SELECT *, side <> 'prompt' AND role = 'assistant' AS loss,
           '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS content
    FROM sides
)
SELECT conv_id, side, turn, role, content, loss,
       CASE WHEN loss THEN length(role) + 5 ELSE 0 END AS mask_start,
       CASE WHEN loss THEN length(content) - 1 ELSE 0 END AS mask_end
FROM shown""",
    "op10_exact_dedup": r"""
WITH n AS (
    SELECT doc_id, coalesce(length(text), 0) AS chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM n
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g""",
    "op11_source_divergence": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), t AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
n AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
    SELECT lang, n.source, term, coalesce(c, 0) AS c, 1 + (1000000000 * (coalesce(c, 0) + 1)) // (n + v) AS p
    FROM n JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), l AS (
    SELECT lang, term, 1 + (1000000000 * (sum(c) + 1)) // (any_value(total) + any_value(v)) AS q
    FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(c) AS total FROM c GROUP BY lang) USING (lang) GROUP BY lang, term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p JOIN l USING (lang, term) WHERE c > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200""",
    "op12_decontaminate": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), i AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS win
    FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
), dw AS (
    SELECT r, s, m, array_to_string(w[s:s + m - 1], ' ') AS win
    FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)
), hits AS (SELECT r, s, m, item_id FROM dw JOIN iw USING (m, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS p FROM hits) GROUP BY r),
items AS (
    SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op13_periodic_runs": r"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), h AS (
    SELECT *, len(w) AS n, xor(4294967295, list_reduce(flatten([[4294967295]] || list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
               lambda c, x: CASE WHEN x < 0 THEN xor(c >> 1, 3988292384 * (c & 1)) ELSE xor(c, x) END)) AS h FROM t
), e AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a, 3 + (h // 10) % 8 AS parts FROM h),
d AS (
    SELECT r, doc_id, n, CASE WHEN a < n
        THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END)
        ELSE w END AS w
    FROM e
), words AS (SELECT r, n, unnest(range(0, n)) AS i, unnest(w) AS word FROM d),
same AS (
    SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM same),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1
), listed AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM runs GROUP BY r
), gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)""",
}
