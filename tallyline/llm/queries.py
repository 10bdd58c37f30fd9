"""One query per operator of this package over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.bpe import bpe_decode, bpe_encode
from tallyline.llm.divergence import divergence
from tallyline.llm.embedding_dedup import near_vectors
from tallyline.llm.line_dedup import dedup_lines
from tallyline.llm.merkle import manifest
from tallyline.llm.minhash_dedup import near_duplicates
from tallyline.llm.packing import pack
from tallyline.llm.quality import held_out as quality_held_out
from tallyline.llm.quality import quality
from tallyline.llm.token_counts import token_counts
from tallyline.llm.token_files import read_token_files, write_token_files
from tallyline.llm.topk_search import top_k
from tallyline.llm.toxicity import held_out, toxicity
from tallyline.llm.url_filter import judge_urls
from tallyline.session import staging_root


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(_table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select("doc_id", F.length(text).cast("long").alias("n_chars_left"), F.sha2(text, 256).alias("text_sha256"))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe_decode(bpe_encode(_table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "evidence")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
                                   ("org", "/fr/", "allow")], "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


# The longest rule that fits, written as a case of rules from long to short.
OP7_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
ruled AS (
  SELECT *, '.' || host AS h, CASE
    WHEN '.' || host LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN '.' || host LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN '.' || host LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staging_root(spark)}/token-files-{uuid.uuid4().hex[:12]}"
    write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


OP10_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality_held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 0
    return manifest(_table(spark, sf_dir, "documents"), tampered)


# Levels from all leaves at once by window, crc32 from its table; proofs from the nodes beside each path.
OP12_SQL = """
WITH RECURSIVE bits AS (
  SELECT range AS byte, CAST(range AS BIGINT) AS v, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE k = 8),
given AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
         xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda a, c: xor(t[(xor(a, c) & 255) + 1], a >> 8))) % 7 = 0 AS tampered
  FROM documents, crc),
hashed AS (
  SELECT r, doc_id, lang, coalesce(tampered, false) AS tampered,
         sha256(head || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') || tail) AS altered
  FROM given),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM hashed),
tree AS (
  SELECT g, 0 AS k, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT g, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY g, k, n, i // 2),
subroots AS (SELECT g, h, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS k, g AS i, n, h FROM subroots
  UNION ALL
  SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY k, n, i // 2),
climb AS (
  SELECT r, g, false AS up, 0 AS k, i, n, '' AS proof, CASE WHEN tampered THEN altered ELSE leaf END AS f FROM leaves
  UNION ALL
  SELECT c.r, c.g, c.up OR c.n = 1, CASE WHEN c.n = 1 THEN 0 ELSE c.k + 1 END, CASE WHEN c.n = 1 THEN c.g ELSE c.i // 2 END,
         CASE WHEN c.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (c.n + 1) // 2 END,
         CASE WHEN c.n = 1 THEN c.proof ELSE c.proof || coalesce(s.h, '') END,
         CASE WHEN c.n = 1 THEN c.f WHEN c.i % 2 = 1 THEN sha256(coalesce(s.h, '') || c.f) ELSE sha256(c.f || coalesce(s.h, '')) END
  FROM climb c LEFT JOIN (SELECT false AS up, g, k, i, h FROM tree UNION ALL SELECT true, -1, k, i, h FROM top) s
    ON s.up = c.up AND s.g = CASE WHEN c.up THEN -1 ELSE c.g END AND s.k = c.k AND s.i = xor(c.i, 1) AND c.n > 1
  WHERE c.n > 1 OR NOT c.up),
folded AS (SELECT r, proof, f FROM climb WHERE up AND n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.f AS folded_root, f.f = t.h AS verified
FROM leaves l JOIN folded f ON f.r = l.r JOIN subroots s ON s.g = l.g CROSS JOIN (SELECT h FROM top WHERE n = 1) t
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH given AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
words AS (SELECT r, lang, source, unnest(found) AS term FROM given),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM given),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.n, 0) + 5 * s.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (s.n + 5 * s.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_bpe_codec": op2_bpe_codec,
        "op3_embedding_dedup": op3_embedding_dedup,
        "op4_toxicity": op4_toxicity,
        "op5_minhash_dedup": op5_minhash_dedup,
        "op6_token_counts": op6_token_counts,
        "op7_url_filter": op7_url_filter,
        "op8_packing": op8_packing,
        "op9_token_files": op9_token_files,
        "op10_topk_search": op10_topk_search,
        "op11_quality": op11_quality,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_source_divergence": op13_source_divergence,
        "pipeline": corpus_pipeline.run,
    }


# Units by their text instead of hashes: one or two lines of many words, or three lines, with a break between them.
OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents),
kept AS (
  SELECT doc_id, n, trim(line, E' \\t\\r\\v\\f') AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY n) AS place
  FROM lines WHERE trim(line, E' \\t\\r\\v\\f') <> ''),
units AS (
  SELECT doc_id, place, 3 AS lines, n AS a, lead(n, 2) OVER w AS b,
         line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS unit
  FROM kept WINDOW w AS (PARTITION BY doc_id ORDER BY n)
  UNION ALL
  SELECT doc_id, place, 1, n, n, line FROM kept WHERE len(regexp_extract_all(line, '[^ \\t\\r\\v\\f]+')) >= 50
  UNION ALL
  SELECT doc_id, place, 2, n, b, unit FROM (
    SELECT doc_id, place, n, lead(n) OVER w AS b, line || chr(10) || lead(line) OVER w AS unit
    FROM kept WINDOW w AS (PARTITION BY doc_id ORDER BY n))
  WHERE len(regexp_extract_all(unit, '[^ \\n\\t\\r\\v\\f]+')) >= 50),
placed AS (
  SELECT *, first_value(doc_id) OVER f AS d1, first_value(place) OVER f AS p1
  FROM units WHERE unit IS NOT NULL WINDOW f AS (PARTITION BY unit, lines ORDER BY doc_id, place)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS n FROM placed
  WHERE doc_id > d1 OR (doc_id = d1 AND place >= p1 + lines)),
rest AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.n) AS text
  FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n GROUP BY l.doc_id)
SELECT d.doc_id, length(coalesce(r.text, '')) AS n_chars_left, sha256(coalesce(r.text, '')) AS text_sha256
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op7_url_filter": OP7_SQL, "op10_topk_search": OP10_SQL,
            "op12_merkle_manifest": OP12_SQL, "op13_source_divergence": OP13_SQL}
