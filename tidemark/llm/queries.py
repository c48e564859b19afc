"""The registered ``opN_*`` queries: every operator over its whole table, and the DuckDB
twin where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann, bpe, filters, html, langid, lm, maxscore, mixing, prefixes, quality, repair, secrets, simhash)
from tidemark.llm.common import doc_bucket, table


def held_out(n: int, of: int):
    """Whether crc32 of the id's text leaves the remainder that is never learned from."""
    return F.coalesce(doc_bucket(F.col("doc_id"), of) == n, F.lit(False))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer file, by default the one that the BPE query uses."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"),
                        F.sha2(joined(F.filter("spans", lambda s: s.kind != "novel")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op3_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held_out(1, 3)))
    return quality.score(docs, field).select("doc_id", held_out(1, 3).alias("held_out"), "score",
                                             (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled good and not toxic; background: all documents.

    The labels grow with the documents, so both sides are shuffled at every size
    and never broadcast."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return lm.score(docs, lm.fit(docs.join(good.hint("merge"), "doc_id", "left_semi"), docs))


def op8_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, k=5)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~held_out(2, 4)))
    return langid.predict(docs, model).select("doc_id", held_out(2, 4).alias("held_out"), "lang_pred", "score")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(filters.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_dedup, op2_secret_scan, op3_bpe_roundtrip, op4_html_text, op5_ann_search,
                            op6_line_quality, op7_lm_score, op8_maxscore_topk, op9_mixing, op10_langid, op11_conversation_repair,
                            op12_token_counts, op13_filter_audit)}

ORACLE_SQL: dict[str, str] = {
    "op8_maxscore_topk": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS z
  FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.z, v.z) AS BIGINT) AS score
  FROM v AS q JOIN v ON len(q.z) = len(v.z) AND q.r <> v.r WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY s.r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_conversation_repair": """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM range(256) AS r(i)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM placed
), rows_of AS (
  SELECT *, role[1] AS initial, body = '' AS blank, body <> '' AND seen > 1 AS duplicate,
         body <> '' AND seen = 1 AND body[-1] NOT IN ('.', '!', '?') AS truncated,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM marked
), totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
         count_if(i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM rows_of GROUP BY conv_id
), walk AS (  -- per state the cheapest way to the end: cost, audit, repaired text behind a mark
  SELECT conv_id, n AS i, {'c': 0, 'a': '', 't': ''} AS v0, {'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS v1,
         {'c': 3, 'a': 'I', 't': chr(10) || 'assistant:'} AS v2, {'c': 0, 'a': '', 't': ''} AS v3 FROM totals
  UNION ALL
  SELECT conv_id, i, least(b0, {'c': 3 + b2.c, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t},
                       {'c': 6 + b3.c, 'a': 'II' || b3.a, 't': chr(10) || 'user:' || chr(10) || 'assistant:' || b3.t}),
         least(b1, {'c': 3 + b2.c, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t},
               {'c': 6 + b3.c, 'a': 'II' || b3.a, 't': chr(10) || 'user:' || chr(10) || 'assistant:' || b3.t}),
         least(b2, {'c': 3 + b3.c, 'a': 'I' || b3.a, 't': chr(10) || 'assistant:' || b3.t}),
         least(b3, {'c': 3 + b2.c, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t})
  FROM (
    SELECT conv_id, i - 1 AS i,
      list_min(list_filter([d0, ru, CASE WHEN gone THEN NULL WHEN initial = 's' THEN {'c': m + v1.c, 'a': 'K' || v1.a, 't': line || v1.t}
                            WHEN initial = 'u' THEN {'c': m + v2.c, 'a': 'K' || v2.a, 't': line || v2.t} END], lambda x: x IS NOT NULL)) AS b0,
      list_min(list_filter([d1, ru, ku], lambda x: x IS NOT NULL)) AS b1,
      list_min(list_filter([d2, ra, CASE WHEN NOT gone AND initial = 'a' THEN {'c': m + v3.c, 'a': 'K' || v3.a, 't': line || v3.t} END],
                           lambda x: x IS NOT NULL)) AS b2,
      list_min(list_filter([d3, ru, ku], lambda x: x IS NOT NULL)) AS b3
    FROM (
      SELECT w.conv_id, w.i, v1, v2, v3, r.initial, r.blank OR r.duplicate AS gone, m, line,
        {'c': 4 + v0.c, 'a': 'D' || v0.a, 't': v0.t} AS d0, {'c': 4 + v1.c, 'a': 'D' || v1.a, 't': v1.t} AS d1,
        {'c': 4 + v2.c, 'a': 'D' || v2.a, 't': v2.t} AS d2, {'c': 4 + v3.c, 'a': 'D' || v3.a, 't': v3.t} AS d3,
        CASE WHEN NOT (r.blank OR r.duplicate) THEN {'c': 3 + m + v2.c, 'a': 'R' || v2.a, 't': chr(10) || 'user:' || r.text || v2.t} END AS ru,
        CASE WHEN NOT (r.blank OR r.duplicate) THEN {'c': 3 + m + v3.c, 'a': 'R' || v3.a, 't': chr(10) || 'assistant:' || r.text || v3.t} END AS ra,
        CASE WHEN NOT (r.blank OR r.duplicate) AND r.initial = 'u' THEN {'c': m + v2.c, 'a': 'K' || v2.a, 't': line || v2.t} END AS ku
      FROM walk AS w, LATERAL (SELECT *, CASE WHEN truncated THEN 3 ELSE 0 END AS m, chr(10) || role || ':' || text AS line
                               FROM rows_of AS x WHERE x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.i = w.i) AS r
    )
  )
), done AS (SELECT conv_id, v0 FROM walk WHERE i = 0)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(v0.c, 0) AS BIGINT) AS cost,
       coalesce(v0.a, '') AS audit, sha256(coalesce(v0.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN totals AS t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done AS d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
""",
    "op13_filter_audit": """
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY part, mask
), letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(x, bit)
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, coalesce(list_sum(bits[:step - 1]), 0)::INTEGER AS gone
  FROM orders, range(1, 6) AS r(step)
), found AS (
  SELECT p.part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (gone | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & gone = 0 AND mask & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & gone <> 0 AND mask & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & gone = 0 AND mask & bit <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & gone = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM steps, (SELECT DISTINCT part FROM cells) AS p LEFT JOIN cells AS c ON c.part = p.part
  GROUP BY p.part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM found
""",
}
