"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkrec.llm import exact, html_text, language, merkle, mixing, packing, pii, quality, simhash, tokens, topk, toxicity, variants
from sparkrec.llm.common import table
from sparkrec.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

#: Table `crc32_step(b, v)`: what each low byte adds to a CRC-32, after eight shifts.
CRC32_STEP = """
crc32_shift(k, b, v) AS (
  SELECT 0, range, range FROM range(256) UNION ALL
  SELECT k + 1, b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc32_shift WHERE k < 8),
crc32_step AS MATERIALIZED (SELECT b, v FROM crc32_shift WHERE k = 8)"""

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op9_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id)""")
def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.label(table(spark, sf, "documents"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.label(table(spark, sf, "documents"), words=3, bits=3)


@query("op2_entropy_mixing")
def op2_entropy_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.label(table(spark, sf, "documents"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf, "documents"))


@query("op4_genetic_packing")
def op4_genetic_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query("op6_bit_sliced_top_k", """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op6_bit_sliced_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op7_tag_path_text")
def op7_tag_path_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


@query("op3_byte_convnet_language")
def op3_byte_convnet_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.label(table(spark, sf, "documents"))


@query("op5_compression_quality")
def op5_compression_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.label(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op1_noisy_channel_toxicity")
def op1_noisy_channel_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.label(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op11_octopus_manifest", f"""
WITH RECURSIVE {CRC32_STEP},
d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, CAST(doc_id AS VARCHAR) AS id_text,
    [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS fields, text FROM documents),
crc(rid, s, i, c) AS (
  SELECT rid, coalesce(id_text, ''), 1, 4294967295::BIGINT FROM d UNION ALL
  SELECT rid, s, i + 1, xor(c >> 8, v) FROM crc JOIN crc32_step ON b = xor(c, ascii(substr(s, i, 1))) & 255
  WHERE i <= length(s)),
hashed AS (
  SELECT rid, doc_id, source,
    sha256(array_to_string([coalesce(strlen(f) || ':' || f, '-') FOR f IN fields], '')) AS leaf,
    CASE WHEN xor(c, 4294967295) % 5 = 0 THEN sha256(array_to_string([coalesce(strlen(f) || ':' || f, '-')
      FOR f IN list_append(fields[1:4], translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))], ''))
    END AS changed
  FROM d JOIN crc USING (rid) WHERE i = length(s) + 1),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS n FROM hashed),
low(level, source, place, n, h) AS (
  SELECT 0, source, place, n, leaf FROM leaves UNION ALL
  SELECT level + 1, source, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place))
  FROM low WHERE n > 1 GROUP BY level, source, place // 16, n),
subroots AS MATERIALIZED (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, place, n, h) AS (
  SELECT 0, place, n, h FROM subroots UNION ALL
  SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM high WHERE n > 1
  GROUP BY level, place // 16, n),
low_steps AS (
  SELECT a.source, a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
  FROM low a JOIN low b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.place // 16 = b.place // 16
  WHERE a.n > 1 GROUP BY a.source, a.level, a.place),
high_steps AS (
  SELECT a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
  FROM high a JOIN high b ON a.level = b.level AND a.place // 16 = b.place // 16 WHERE a.n > 1 GROUP BY a.level, a.place),
low_heights AS (SELECT source, max(level) AS top FROM low GROUP BY source),
steps AS MATERIALIZED (
  SELECT rid, s.level, l, r FROM leaves a JOIN low_steps s
    ON a.source IS NOT DISTINCT FROM s.source AND s.place = a.place // CAST(pow(16, s.level) AS BIGINT)
  UNION ALL
  SELECT rid, top + s.level, l, r FROM leaves a JOIN subroots u ON a.source IS NOT DISTINCT FROM u.source
    JOIN low_heights t ON a.source IS NOT DISTINCT FROM t.source
    JOIN high_steps s ON s.place = u.place // CAST(pow(16, s.level) AS BIGINT)),
proofs AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, count(*) AS n FROM steps GROUP BY rid),
fold(rid, level, h) AS (
  SELECT rid, 0, coalesce(changed, leaf) FROM leaves UNION ALL
  SELECT rid, level + 1, sha256(l || h || r) FROM fold JOIN steps USING (rid, level)),
folded AS (SELECT rid, max_by(h, level) AS folded_root FROM fold GROUP BY rid),
root AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, u.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves a JOIN subroots u ON a.source IS NOT DISTINCT FROM u.source JOIN folded USING (rid) LEFT JOIN proofs USING (rid)
CROSS JOIN root""")
def op11_octopus_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.label(table(spark, sf, "documents"))


@query("op12_spelling_variants", f"""
WITH RECURSIVE {CRC32_STEP},
runs AS MATERIALIZED (
  SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS bytes FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL),
crc(bytes, i, c) AS (
  SELECT DISTINCT bytes, 1, 4294967295::BIGINT FROM runs UNION ALL
  SELECT bytes, i + 2, xor(c >> 8, v) FROM crc JOIN crc32_step
    ON b = xor(c, CAST('0x' || substr(bytes, i, 2) AS BIGINT)) & 255 WHERE i < length(bytes)),
hashed AS (SELECT run, times, xor(c, 4294967295) AS h FROM runs JOIN crc USING (bytes) WHERE i = length(bytes) + 1),
written AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
    ELSE run END AS word, times FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
short AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM short a JOIN short b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM short a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM short a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT word, CASE WHEN other_n >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk(word, seen, steps) AS (
  SELECT word, word, 0 FROM words UNION ALL
  SELECT walk.word, f.form, steps + 1 FROM walk JOIN formed f ON f.word = walk.seen WHERE f.form IS NOT NULL),
ends AS (SELECT word, max_by(seen, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)""")
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.group(table(spark, sf, "documents"))


@query("op13_weak_supervision_pii")
def op13_weak_supervision_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find(table(spark, sf, "documents"))
