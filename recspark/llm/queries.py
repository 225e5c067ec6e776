"""The registered queries of this package: thin wrappers that apply each operator, with its
production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers

from recspark.llm import (exact_dedup, hamming, langid, lexical_search, license_scan, line_dedup, mixing, near_dedup, packing, secret_scan, token_files,
                          warc, whitening)
from recspark.llm.common import documents

QUERIES = {}
SQL = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@_query("op10_exact_dedup", exact_dedup.SQL)
def op10(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


@_query("op8_packing")
def op8(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@_query("op6_token_file")
def op6(spark, sf_dir):
    return token_files.token_file_round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), "dropped")


@_query("op9_secret_scan")
def op9(spark, sf_dir):
    return secret_scan.scan_secrets(documents(spark, sf_dir), rule="any")


@_query("op4_line_dedup", line_dedup.SQL)
def op4(spark, sf_dir):
    return line_dedup.repeated_units(documents(spark, sf_dir))


@_query("op2_warc_segments", warc.SQL)
def op2(spark, sf_dir):
    return warc.archive_round_trip(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


@_query("op7_language_id")
def op7(spark, sf_dir):
    return langid.split_fit_predict(documents(spark, sf_dir))


@_query("op3_minhash_bayes", near_dedup.SQL)
def op3(spark, sf_dir):
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@_query("op1_hamming_topk", hamming.SQL)
def op1(spark, sf_dir):
    return hamming.nearest_embeddings(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@_query("op5_temperature_mixing", mixing.SQL)
def op5(spark, sf_dir):
    return mixing.mix_sources(documents(spark, sf_dir))


@_query("op11_qdwh_whitening")
def op11(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@_query("op12_reversed_search", lexical_search.SQL)
def op12(spark, sf_dir):
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


@_query("op13_license_templates", license_scan.SQL)
def op13(spark, sf_dir):
    return license_scan.scan_licenses(documents(spark, sf_dir)).drop("spans")
