"""Queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import byte_bpe, decontaminate, fim, html, langid, ngram_join, packing, pii, prefix_trie, secrets, spans, tiff, token_files, url_filter
from larkspur.llm.common import new_path, table

TOKENIZER, RANKS = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.with_crc32(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """With the path of an earlier ``ledger`` only blobs that it lacks are scanned; without, all."""
    found = secrets.scan(table(spark, sf_dir, "documents"), ledger or new_path(spark, "ledger"))
    return found.select("doc_id", *spans.digests(F.col("spans"), secrets.BASE_KINDS))


#: Fixed values of the contract.
URL_RULES = (url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"), url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow"))


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def held_out(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(langid.training_rows(docs.where(~held_out("doc_id"))))
    return langid.predict(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.payload_digests(tiff.encode_texts(table(spark, sf_dir, "documents")), key="doc_id")


def op7_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans_of(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *spans.digests(F.col("spans"), pii.BASE_KINDS))


def op8_benchmark_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_files.write_token_files(table(spark, sf_dir, "documents"), new_path(spark, "tokens"), public_tokenizers.path(TOKENIZER))
    return token_files.document_digests(spark, store)


def op10_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


#: Fixed values of the contract: whose first turns a conversation takes over, and below how many.
SHARED_EVERY, SHARED_MOST = 5, 9


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), every=SHARED_EVERY, most=SHARED_MOST)


def op12_fim_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return byte_bpe.digests(byte_bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_secret_ledger": op3_secret_ledger,
    "op4_url_templates": op4_url_templates,
    "op5_language_crf": op5_language_crf,
    "op6_tiff": op6_tiff,
    "op7_pii_anchors": op7_pii_anchors,
    "op8_benchmark_cgk": op8_benchmark_cgk,
    "op9_token_files": op9_token_files,
    "op10_tag_paths": op10_tag_paths,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fim_scatter": op12_fim_scatter,
    "op13_byte_bpe": op13_byte_bpe,
}

#: DuckDB SQL; a query that SQL cannot express is tested in tests/llm instead.
ORACLE_SQL: dict[str, str] = {
    "op4_url_templates": url_filter.judge_sql(URL_RULES),
    "op11_prefix_trie": prefix_trie.prefix_trie_sql(SHARED_EVERY, SHARED_MOST),
    "op12_fim_scatter": fim.transform_sql(),
}
