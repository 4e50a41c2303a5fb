"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def docs_frame(spark, texts, first=0):
    """Documents with clashing further columns; ``texts`` are texts or (id, text)."""
    rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    data = [(i, t, "en", "src", len(t or ""), 1, "x", 0.5) for i, t in rows]
    return spark.createDataFrame(
        data,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "row int, words string, score double",
    )


def plain_docs(spark, texts):
    return docs_frame(spark, texts).select("doc_id", "text")


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = "the er an ing on re ea st nd ha és ür ción wh".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))
