"""The operators as registered queries over the driver's tables, and SQL to check them with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalweave.llm import (bloom_lm, bpe, exact_dedup, hard_negatives, kdtree, minhash, mixing,
                             prefix_trie, shards, substring_dedup, token_counts, toxicity, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bloom_lm.lm_scores(docs, bloom_lm.held_out(F.col("doc_id")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_digests(_table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.byte_shards(_table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return kdtree.top_inner_products(vectors, F.col("vec_id") % 100 == 0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(_table(spark, sf_dir, "documents"),
                           public_tokenizers.path("word_bpe_49k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, label = F.col("vec_id"), F.col("label")
    moved = F.when(ids % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), ids % 50 == 0, moved)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    return prefix_trie.conversation_trie(
        _table(spark, sf_dir, "conversations"), base=conv - conv % 20,
        taken=(F.crc32(conv.cast("string").cast("binary")) % 4).cast("int"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_source_mixing, op3_lm_scores, op4_substring_dedup, op5_minhash,
        op6_exact_dedup, op7_sharding, op8_top_k, op9_token_counts, op10_bpe,
        op11_hard_negatives, op12_prefix_trie, op13_warc)}


_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")

_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

SQL = {
    "op4_substring_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w
                   FROM documents),
        p AS (SELECT r, w[i] AS word, i, CASE WHEN i + 34 <= len(w)
                  THEN md5(array_to_string(w[i:i + 34], ' ')) END AS run
              FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
        again AS (SELECT run FROM p WHERE run IS NOT NULL GROUP BY run HAVING count(*) > 1),
        m AS (SELECT p.*, max(CASE WHEN again.run IS NULL THEN 0 ELSE 1 END) OVER (
                  PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
              FROM p LEFT JOIN again ON again.run = p.run),
        k AS (SELECT r, sum(gone) AS n, string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i)
                  AS kept FROM m GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (r)""",
    "op5_minhash": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS x
              FROM (SELECT doc_id, w, unnest(range(1, greatest(least(len(w), 1), len(w) - 2) + 1))
                        AS i FROM d)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
                  FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                  WHERE 100 * c >= 85 * (x.n + y.n - c)),
        ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d
                  UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
        LEFT JOIN n USING (doc_id)""",
    "op7_sharding": """
        WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(
                       list_prepend(n, range(8)), lambda u, i: CASE WHEN u % 2 = 1
                           THEN xor(u >> 1, 3988292384) ELSE u >> 1 END)) AS t),
        d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
                     list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                    lambda h: CAST('0x' || h AS BIGINT)) AS bytes
              FROM documents),
        c AS (SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
                  lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INTEGER) + 1]))) AS crc
              FROM d, t),
        p AS (SELECT *, sum(size) OVER (ORDER BY doc_id, size, crc ROWS UNBOUNDED PRECEDING) AS upto,
                     sum(size) OVER () AS total FROM c),
        q AS (SELECT *, least(7, CAST((2 * upto - size) * 8 // (2 * total) AS INTEGER)) AS shard FROM p)
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32,
               'bytes' AS law, shard, row_number() OVER (
                   PARTITION BY shard ORDER BY doc_id, size, crc) - 1 AS slot,
               CAST(NULL AS INTEGER) AS grown_shard
        FROM q""",
    "op6_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM n""",
    "op8_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding,
                       lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))
                        AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 100 = 0),
        r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
                       ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding,
                       lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))
                        AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
            WHERE a.vec_id % 50 = 0),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (
                   PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
                   AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
            AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
    "op12_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, coalesce(text, '') AS text,
                   length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS x,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                      coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        k AS (
            SELECT c, c - c % 20 AS base, xor(list_reduce(list_prepend(4294967295,
                       list_transform(string_split(CAST(c AS VARCHAR), ''),
                                      lambda d: CAST(ascii(d) AS BIGINT))),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])),
                       lambda u, i: CASE WHEN u % 2 = 1 THEN xor(u >> 1, 3988292384)
                                         ELSE u >> 1 END)), 4294967295) % 4 AS h
            FROM (SELECT DISTINCT c FROM t)),
        r AS (
            SELECT k.c, t.pos AS o, t.x, t.text FROM k JOIN t ON t.c = k.base AND t.pos <= k.h
            UNION ALL
            SELECT k.c, 10 + t.pos, t.x, t.text FROM k JOIN t ON t.c = k.c AND t.pos > k.h),
        q AS (
            SELECT c, CAST(0 AS BIGINT) AS d, CAST([] AS VARCHAR[]) AS p, 0 AS w FROM k
            UNION ALL
            SELECT c, row_number() OVER (PARTITION BY c ORDER BY o),
                   list(x) OVER (PARTITION BY c ORDER BY o),
                   len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
            FROM r),
        n AS (SELECT p, d, min(c) AS conv_id, count(*) AS n, any_value(w) AS w FROM q GROUP BY p, d),
        kids AS (SELECT p[:d - 1] AS p, d - 1 AS d, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1, 2),
        m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN kids USING (p, d)),
        sub AS (
            SELECT p[:j] AS p, j AS d, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves,
                   sum((n - 1) * w) AS saved
            FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM m) GROUP BY 1, 2),
        e AS (
            SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends
            FROM (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY c ORDER BY d DESC) = 1)
            GROUP BY p)
        SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n AS n_convs,
               m.kids AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
               CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
        FROM m JOIN sub ON sub.p = m.p AND sub.d = m.d
        LEFT JOIN m AS up ON up.d = m.d - 1 AND up.p = m.p[:m.d - 1]
        LEFT JOIN e ON e.p = m.p""",
    "op13_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages),
        d AS (
            SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr(
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(sha1(html),
                       1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31
                       AS INTEGER), 1)), '') AS digest
            FROM p)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END
                   AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM d""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
