"""The registered queries of this package, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fleetmart.llm.graphsearch import nearest
from fleetmart.llm.hamming import sign_codes, top_k
from fleetmart.llm.inputs import BYTE_BPE, PIECES, table
from fleetmart.llm.jaccardjoin import near_duplicates
from fleetmart.llm.langid import identify_held_out
from fleetmart.llm.maintext import extract
from fleetmart.llm.packing import pack_sequences
from fleetmart.llm.periodic import find_runs, run_digests, with_planted_periods
from fleetmart.llm.pieces import encode
from fleetmart.llm.ranked import ranked_search
from fleetmart.llm.secretscan import scan_corpus
from fleetmart.llm.sharding import shard_by_bytes
from fleetmart.llm.tensorjoin import near_duplicates as tensored_duplicates
from fleetmart.llm.toxicity import flag_toxic


def piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Ids, their number, and the check sum and length of the text that they decode to."""
    return encode(table(spark, folder, "documents"), PIECES).select(
        "doc_id", "ids", "n_tokens", F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        F.length("decoded").cast("long").alias("decoded_chars"))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_held_out(table(spark, folder, "documents"))


def hamming_search(spark: SparkSession, folder: str) -> DataFrame:
    codes = sign_codes(table(spark, folder, "embeddings"))
    return top_k(codes, codes.where("vec_id % 50 = 0"))


def main_texts(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents"))


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_sequences(table(spark, folder, "documents"), BYTE_BPE)


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_corpus(table(spark, folder, "documents"))


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def graph_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return flag_toxic(table(spark, folder, "documents"), table(spark, folder, "labels"))


def minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return tensored_duplicates(table(spark, folder, "documents"))


def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(find_runs(with_planted_periods(table(spark, folder, "documents"))))


QUERIES = {
    "op1_hamming_search": hamming_search,
    "op2_piece_encoding": piece_encoding,
    "op3_language_id": language_id,
    "op4_main_text": main_texts,
    "op5_sharding": sharding,
    "op6_packing": packing,
    "op7_secret_scan": secret_scan,
    "op8_jaccard_join": jaccard_join,
    "op9_graph_search": graph_search,
    "op10_toxicity": toxicity,
    "op11_minhash_dedup": minhash_dedup,
    "op12_ranked_search": lexical_search,
    "op13_periodic_runs": periodic_runs,
    "pipeline": corpus_pipeline.run,
}

STATEMENTS: dict[str, str] = {
    "op1_hamming_search": """
        WITH codes AS (
            SELECT vec_id, array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding], '') AS code
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = 64
              AND len([1 FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64
              AND len([1 FOR x IN embedding IF x <> 0]) > 0
        ), pairs AS (
            SELECT DISTINCT q.vec_id AS query_id, c.vec_id, hamming(q.code, c.code) AS distance
            FROM codes q JOIN codes c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS place FROM pairs
        )
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
        FROM ranked WHERE place <= 10
    """,
    "op8_jaccard_join": r"""
        WITH RECURSIVE texts AS (
            SELECT text, min(doc_id) AS id, count(*) AS copies, any_value(words) AS words
            FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+') AS words FROM documents)
            WHERE len(words) > 0 GROUP BY text
        ), shingles AS (
            SELECT DISTINCT id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
            FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM texts)
        ), sizes AS (
            SELECT id, count(*) AS size FROM shingles GROUP BY id
        ), common AS (
            SELECT a.id AS x, b.id AS y, count(*) AS both_have
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.id <> b.id GROUP BY ALL
        ), linked AS (
            SELECT x, y FROM common JOIN sizes p ON p.id = x JOIN sizes q ON q.id = y
            WHERE both_have >= 0.8 * (p.size + q.size - both_have)
        ), reached AS (
            SELECT id, id AS other FROM texts
            UNION
            SELECT id, y FROM reached JOIN linked ON other = x
        ), classes AS (
            SELECT id, min(other) AS class_id FROM reached GROUP BY id
        ), counts AS (
            SELECT x AS id, count(*) AS links FROM linked GROUP BY x
        )
        SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, CAST(coalesce(links, 0) AS BIGINT) AS links,
               CAST(coalesce(copies, 1) AS BIGINT) AS copies
        FROM documents d LEFT JOIN texts t ON d.text = t.text
        LEFT JOIN classes c ON c.id = t.id LEFT JOIN counts n ON n.id = t.id
    """,
    "op11_minhash_dedup": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM texts WHERE len(words) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), linked AS (
            SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * both_have >= 85 * (p.size + q.size - both_have)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT doc_id, y FROM reached JOIN linked ON other = x
        ), least AS (
            SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT doc_id, CAST(coalesce(size, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
    """,
    "op12_ranked_search": r"""
        WITH terms AS (
            SELECT 'document' AS kind, doc_id AS id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
            FROM documents
            UNION ALL
            SELECT 'item', item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'))
            FROM benchmark
        ), sizes AS (
            SELECT id AS doc_id, count(*) AS n FROM terms WHERE kind = 'document' GROUP BY id
        ), whole AS (
            SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM sizes
        ), asked AS (
            SELECT DISTINCT id AS item_id, term FROM terms WHERE kind = 'item'
        ), counted AS (
            SELECT id AS doc_id, term, count(*) AS tf FROM terms
            WHERE kind = 'document' AND term IN (SELECT term FROM asked) GROUP BY ALL
        ), weighed AS (
            SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counted, whole GROUP BY term, nn
        ), impacts AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS impact
            FROM counted JOIN weighed USING (term) JOIN sizes USING (doc_id), whole
        ), scored AS (
            SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score
            FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id HAVING sum(impact) > 0
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    "op13_periodic_runs": r"""
        WITH crc_table AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                                    lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t
            FROM (SELECT unnest(range(0, 256)) AS i)
        ), hashed AS (
            SELECT doc_id, xor(list_reduce(list_prepend(4294967295, [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
                                           lambda x, c: xor(x >> 8, t[CAST(xor(x, c) & 255 AS BIGINT) + 1])), 4294967295) AS h,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents, crc_table
        ), placed AS (
            SELECT doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a,
                   1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p
            FROM hashed
        ), numbered AS (
            SELECT doc_id, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
            FROM (SELECT *, unnest(range(0, n)) AS i FROM placed)
        ), equal AS (
            SELECT x.doc_id, x.i, y.i - x.i AS q
            FROM numbered x JOIN numbered y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
        ), islands AS (
            SELECT doc_id, q, min(i) AS start, count(*) + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
            GROUP BY doc_id, q, island
            HAVING count(*) + q >= greatest(24, 3 * q)
        ), runs AS (
            SELECT doc_id, start, length, min(q) AS period FROM islands GROUP BY ALL
        ), listed AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
            FROM runs GROUP BY doc_id
        ), best AS (
            SELECT * FROM runs
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1
        ), collapsed AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words
            FROM numbered m
            WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = m.doc_id AND m.i >= r.start + r.period AND m.i < r.start + r.length)
            GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
               CAST(period AS BIGINT) AS period, CAST((1000 * length) // period AS BIGINT) AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
    """,
}
