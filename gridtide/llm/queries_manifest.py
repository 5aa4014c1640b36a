"""Registered queries: token alignment, packing along a curve, Merkle manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridtide.llm.alignment import align_documents
from gridtide.llm.curve_packing import pack_along_curve
from gridtide.llm.merkle import documents_manifest
from gridtide.llm.queries_packing import tokenizer_path


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align_documents(docs, tokenizer_path(), piece_model_path()).withColumnRenamed("doc", "doc_id")


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_along_curve(docs, tokenizer_path()).withColumnRenamed("doc", "doc_id")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# CRC-32 of a decimal number, bit by bit: 3988292384 is the reflected polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)),
    4294967295::UBIGINT)"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    return f"sha256({' || '.join(_field(f) for f in fields)})"


OP13_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
           CASE WHEN {_CRC.format(id='doc_id')} % 7 = 0 THEN {_leaf('n_chars + 1')}
                ELSE {_leaf('n_chars')} END AS offered,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx
    FROM documents
), nodes AS (
    SELECT 0 AS level, lang, idx, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM leaves
    UNION ALL
    SELECT level + 1, lang, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY level, lang, idx // 2
), subroots AS MATERIALIZED (
    SELECT lang, digest, level AS height,
           row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), crown AS (
    SELECT 0 AS level, idx, digest, n FROM subroots
    UNION ALL
    SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
    FROM crown WHERE n > 1 GROUP BY level, idx // 2
), steps AS MATERIALIZED (
    SELECT l.doc_id, n.level AS place, n.digest, n.idx < (l.idx >> n.level) AS before
    FROM leaves l JOIN nodes n ON n.lang IS NOT DISTINCT FROM l.lang
         AND n.idx = xor(l.idx >> n.level, 1)
    UNION ALL
    SELECT l.doc_id, s.height + c.level, c.digest, c.idx < (s.idx >> c.level)
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
         JOIN crown c ON c.idx = xor(s.idx >> c.level, 1)
), tops AS (
    SELECT max(level) AS height, (SELECT digest FROM crown WHERE n = 1) AS root FROM crown
), folds AS (
    SELECT l.doc_id, 0 AS place, l.offered AS digest, s.height + t.height AS height
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang, tops t
    UNION ALL
    SELECT f.doc_id, f.place + 1,
           sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN s.before THEN s.digest || f.digest
                       ELSE f.digest || s.digest END), f.height
    FROM folds f LEFT JOIN steps s ON s.doc_id = f.doc_id AND s.place = f.place
    WHERE f.place < f.height
), proofs AS (
    SELECT doc_id, sha256(string_agg(digest, '' ORDER BY place)) AS proof FROM steps GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, t.root, coalesce(p.proof, sha256('')) AS proof_sha256,
       f.digest AS folded_root, f.digest = t.root AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
     LEFT JOIN proofs p ON p.doc_id = l.doc_id
     JOIN folds f ON f.doc_id = l.doc_id AND f.place = f.height, tops t
"""
