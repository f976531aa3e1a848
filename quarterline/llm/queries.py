"""Registered plans of the training-data operators and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.llm.common import table, written


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.exact_dedup import exact_duplicates
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.secrets import secret_scan, span_column
    found = secret_scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(span_column(F.col("base")), 256).alias("base_sha256"),
                        span_column(F.concat("base", "added")).alias("spans"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.mixing import mix, taken_words
    return taken_words(*mix(table(spark, sf_dir, "documents")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.warc import read_warc, whole_archives, write_warc
    records = whole_archives(read_warc(write_warc(table(spark, sf_dir, "pages")), with_payload=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from quarterline.llm.byte_bpe import round_trip
    coded = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.pivot_index import embedding_links
    return embedding_links(table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.line_dedup import apply_bitmaps, keep_bitmaps
    docs = table(spark, sf_dir, "documents")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.bagminhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from quarterline.llm.token_files import read_token_files, write_token_files
    from quarterline.llm.word_ids import word_encoder
    path = public_tokenizers.path("word_bpe_49k.json")
    files = write_token_files(table(spark, sf_dir, "documents"), lambda: word_encoder(path))
    return read_token_files(files)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from quarterline.llm.packing import document_pieces, pack_lengths
    from quarterline.llm.word_ids import word_encoder
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = document_pieces(table(spark, sf_dir, "documents"), lambda: word_encoder(path))
    # the digest is taken where the ids lie: only it goes through the join
    digests = written(pieces.select("uid", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pack-digests")
    return digests.join(pack_lengths(pieces.select("uid", "length")), "uid").drop("uid")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm.lexical import build_index, search
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_exact_dedup, op3_secret_scan, op4_mix_sources, op5_warc,
                                  op6_byte_bpe, op7_pivot_index, op8_line_dedup, op9_bagminhash, op10_token_files,
                                  op11_packing, op12_whitening, op13_lexical_search)}

# white space of the contracts, and what a SQL string needs to name it
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op2_exact_dedup": f"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(translate(coalesce(text, ''), {_WS}, '')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST)""",
    "op5_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
d AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(x, CAST((k // 4) * 5 + 1 AS BIGINT), 5) AS INT)
                  >> CAST(15 - 5 * (k % 4) AS INT)) & 31) + 1 AS BIGINT), 1) FOR k IN range(32)], '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)""",
    "op8_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1)) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.top AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
c AS (SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_all, CAST(sum(len(terms)) AS BIGINT) AS l_all FROM d),
i AS (
  SELECT row_number() OVER () AS i, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS qtf FROM (SELECT i, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
m AS (SELECT r, doc_id, 25 + (75 * len(terms) * n_all) // greatest(l_all, 1) AS m FROM d, c),
s AS (
  SELECT i, item_id, r, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10""",
}
