"""From raw documents to piece ids: five stages, each over all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next one's documents. All but the last return the columns of ``documents``.

Defined cases are those of the operators: nulls, empty and repeated rows pass through the filters like
other rows, an empty table gives an empty result, further columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm import decontaminate, secrets, sentencepiece_codec, simhash, toxicity
from hourlake.llm.common import free_name, stored, table
from hourlake.llm.queries import PIECE_MODEL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored, spans = free_name(docs, "toxicity"), free_name(docs, "toxic_spans")
    found = toxicity.score(docs, model, scored=scored, spans=spans)
    return found.where(F.col(scored) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), "documents")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its piece ids, their number, and whether decoding them restores the text."""
    encoded = sentencepiece_codec.encode(docs, sentencepiece_codec.load_model(PIECE_MODEL))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "restored")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]

#: The trained stages cannot be written in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
