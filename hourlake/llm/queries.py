"""One query per operator, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm import (
    collocations,
    decontaminate,
    fingerprints,
    licenses,
    quality,
    repeats,
    secrets,
    sentencepiece_codec,
    simhash,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
)
from hourlake.llm.common import table

#: The piece model of the query; any other SentencePiece file without normalisation will do.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

#: The vocabulary file of the query that counts tokens; any other plain byte-level BPE will do.
TOKEN_VOCABULARY = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = sentencepiece_codec.load_model(PIECE_MODEL)
    encoded = sentencepiece_codec.encode(table(spark, folder, "documents"), model)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "restored")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination_digest(documents, table(spark, folder, "benchmark"))


def op3_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_digest(table(spark, folder, "documents").select("doc_id", "text"))


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digest(table(spark, folder, "documents").select("doc_id", "text"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicate_digest(table(spark, folder, "documents").select("doc_id", "text"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.toxicity_digest(documents, table(spark, folder, "labels"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return quality.quality_digest(documents, table(spark, folder, "labels"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).drop("url")


def op10_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_digest(table(spark, folder, "documents").select("doc_id", "text"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocation_digest(table(spark, folder, "documents").select("lang", "text"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.code_digest(table(spark, folder, "embeddings"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = token_counts.load_vocabulary(tokenizer_file(TOKEN_VOCABULARY))
    return token_counts.token_digest(table(spark, folder, "documents"), vocabulary)


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_decontamination": op2_decontamination,
    "op3_repeats": op3_repeats,
    "op4_secret_scans": op4_secret_scans,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_fingerprints": op8_fingerprints,
    "op9_url_filters": op9_url_filters,
    "op10_license_scans": op10_license_scans,
    "op11_collocations": op11_collocations,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_counts": op13_token_counts,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_decontamination": decontaminate.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
