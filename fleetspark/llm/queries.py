"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, dac, decontam, gru_lm, iblt, langid, licenses, packing, pii, runs, secrets, simhash, vector_codes
from .common import crc_split, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read_table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.digest(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_split("doc_id", 3, 1)
    model = langid.train(docs.filter(~held_out))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score(read_table(spark, sf_dir, "documents"), crc_split("doc_id", 5, 1))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_pii": op2_pii,
    "op3_token_codes": op3_token_codes,
    "op4_word_bpe": op4_word_bpe,
    "op5_secrets": op5_secrets,
    "op6_licenses": op6_licenses,
    "op7_decontamination": op7_decontamination,
    "op8_language_id": op8_language_id,
    "op9_simhash": op9_simhash,
    "op10_language_model": op10_language_model,
    "op11_packing": op11_packing,
    "op12_vector_codes": op12_vector_codes,
    "op13_periodic_runs": op13_periodic_runs,
}

WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op7_decontamination": rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, s, s + 9) AS x, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, p, n, list_slice(w, p, p + n - 1) AS x
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, lens)),
hit AS (SELECT doc_id, p, item_id, win.n FROM pos JOIN win USING (x)),
n_hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(item_ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
