"""Bounded samples of labelled texts, for operators that fit a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled documents are fitted on, of at most so many characters each.
SAMPLE_ROWS, SAMPLE_CHARS = 4_000, 20_000


def fold(key: str, folds: int) -> Column:
    """CRC32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, wanted: Column, key: str = "doc_id", text: str = "text",
    rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
) -> list[tuple[str, int]]:
    """Distinct texts with their label, of at most ``rows`` labelled ids, the least by a hash.

    ``wanted`` says which ids may be learned from. An id with several labels takes the largest.
    Whole texts are taken, or none: documents of more than ``chars`` characters are not learned from.
    """
    ids = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & wanted)
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(F.col(label)).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = (
        docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .where(F.char_length("text") <= chars)
        .join(F.broadcast(ids), "id")
        .groupBy("text")
        .agg(F.max("label").alias("label"), F.min("id").alias("id"))
        .orderBy(F.xxhash64("id"), "id")
    )
    # a repeated id could bring more documents than ids
    return [(r["text"], r["label"]) for r in texts.limit(rows).collect()]
