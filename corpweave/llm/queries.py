"""The operators as queries over whole tables, with SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm import (
    decontaminate, embedding_neighbours, link_trust, masked_lm, near_duplicates, packing, quality, repeats,
    spelling, stable_projections, token_counts, warc, whitening,
)

#: What the blocking policy of the pages table says.
RULES = [
    link_trust.Rule("allow", "com", "/"),
    link_trust.Rule("block", "example.com", "/en/"),
    link_trust.Rule("allow", "www.example.com", "/en/"),
    link_trust.Rule("block", "net", "/es/"),
    link_trust.Rule("block", "net", "/fr/"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return masked_lm.score(docs, *masked_lm.fit(docs))


def op2_quality_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, folder, "labels")))


def op3_fm_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    # The operator also lists the spans; a digest of rows holds plain columns only.
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("spans")


def op4_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return warc.derivatives(warc.responses(pages), with_bytes=False)


def op5_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    judged = link_trust.judge(table(spark, folder, "pages"), RULES)
    # Sums arrive in any order, so the last digits of the ranks are not repeatable.
    return judged.withColumns({c: F.round(c, 9) for c in ("trust", "distrust")})


def op6_bwt_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.report(table(spark, folder, "documents"))


def op7_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.linked(table(spark, folder, "documents"))


def op8_tournament_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op9_prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def op10_product_quantisation(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_neighbours.linked(table(spark, folder, "embeddings"))


def op11_bit_sliced_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    # The operator's deviations may have 38 digits; what a long cannot hold is null.
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_stable_projections(spark: SparkSession, folder: str) -> DataFrame:
    return stable_projections.search(table(spark, folder, "embeddings"))


def op13_reduced_alphabet_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_masked_lm, op2_quality_cnn, op3_fm_decontamination, op4_warc_derivatives, op5_link_trust,
        op6_bwt_repeats, op7_hyperminhash, op8_tournament_packing, op9_prefix_token_counts,
        op10_product_quantisation, op11_bit_sliced_whitening,
        op12_stable_projections, op13_reduced_alphabet_variants)
}

SQL: dict[str, str] = {}

# Every run of words that is as long as some phrase, looked up among the phrases.
SQL["op3_fm_decontamination"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), runs AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM phrases) WHERE len(w) >= k)
), hits AS (
  SELECT r, i, k, item_id FROM runs JOIN phrases USING (k, p)
), covered AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS place FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

# All windows of all texts, counted by a 128-bit fingerprint; runs of covered bytes as islands.
SQL["op6_bwt_repeats"] = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
  SELECT r, i, md5_number(b[i:i + 399]) AS h
  FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS i FROM docs WHERE octet_length(b) >= 400)
), starts AS (
  SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -400) + 400 AS fresh
  FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), spans AS (
  SELECT r, min(i) AS start, max(i) + 400 AS stop
  FROM (SELECT r, i, count_if(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM starts) GROUP BY r, k
), gaps AS (
  SELECT r, coalesce(lag(stop) OVER (PARTITION BY r ORDER BY start), 1) AS start, start AS stop FROM spans
  UNION ALL
  SELECT r, coalesce(max(s.stop), 1), max(octet_length(b)) + 1 FROM docs LEFT JOIN spans s USING (r) GROUP BY r
), kept AS (
  SELECT r, unhex(string_agg(CASE WHEN stop > start THEN hex(b[start:stop - 1]) ELSE '' END, '' ORDER BY start)) AS b
  FROM gaps g JOIN docs USING (r) GROUP BY r
), counted AS (
  SELECT r, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, octet_length(d.b) AS n_bytes, octet_length(d.b) - octet_length(k.b) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(k.b) AS kept_sha256
FROM docs d JOIN kept k USING (r) LEFT JOIN counted USING (r)
"""

# Intersections of full shingle sets by a join on shingles; components by spreading ids.
SQL["op7_hyperminhash"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS src, b.doc_id AS dst, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT src, dst FROM shared s JOIN sizes a ON a.doc_id = src JOIN sizes b ON b.doc_id = dst
  WHERE 100 * s.n >= 75 * (a.n + b.n - s.n)
), reach AS (
  SELECT doc_id AS node, doc_id AS least FROM docs
  UNION
  SELECT l.dst, r.least FROM reach r JOIN links l ON l.src = r.node
), named AS (
  SELECT node, min(least) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM docs d LEFT JOIN sizes USING (doc_id) JOIN named ON node = d.doc_id
"""

# All pairs in SQL: links by the dot product of vectors at length one, components by spreading ids.
SQL["op10_product_quantisation"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS src, b.vec_id AS dst FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS node, vec_id AS least FROM v
  UNION
  SELECT l.dst, r.least FROM reach r JOIN links l ON l.src = r.node
), least AS (
  SELECT node, min(least) AS component_id FROM reach GROUP BY node
), n AS (
  SELECT src, count(*) AS n_links FROM links GROUP BY src
)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, least.component_id, v.vec_id = least.component_id AS kept
FROM v LEFT JOIN n ON n.src = v.vec_id LEFT JOIN least ON least.node = v.vec_id
"""

# All inner products in SQL. The stopping test loses nothing here: no cell of these tables is ruled out.
SQL["op12_stable_projections"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

# crc32 byte by byte from a table that its polynomial gives; near words by the letter they lack.
SQL["op13_reduced_alphabet_variants"] = r"""
WITH RECURSIVE steps AS (
  SELECT b, 0 AS k, b AS c FROM range(256) t(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), each AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS item, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(
    [CAST('0x' || substr(hex(encode(item)), 2 * i + 1, 2) AS BIGINT) FOR i IN range(octet_length(encode(item)))],
    lambda h, b: xor(h >> 8, t[xor(h & 255, b) + 1]), 4294967295), 4294967295) AS h
  FROM each, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, struct_pack(r := -near_n, w := encode(near))) AS near, max(near_n) AS near_n
  FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
    CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), reach AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT r.word, f.form FROM reach r JOIN forms f ON f.word = r.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN reach r ON r.word = f.word JOIN forms l ON l.word = r.at AND l.form IS NULL
"""
