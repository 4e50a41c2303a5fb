"""Token counts: equal to the library's, for every text."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from hourlake.llm import token_counts as T
from tests.llm.texts import SF, docs_frame, prose

PATH = "/opt/tokenizers/byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def vocabulary():
    return T.load_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def odd_texts() -> list[str | None]:
    rng = random.Random(9)
    mixed = "aZ é1٣²  \t\n'sß漢字🙂Ᲊ꟱\U000323b0́.,;!<|>\x00\x1c\x85"
    return [
        None,
        "",
        " ",
        "\n\n  \t x ",
        "don't we'll 'sOK ''re I'M",
        f"{SPECIAL}{SPECIAL} a {SPECIAL}b<|endoftext|",
        "a" * 70_000,
        "ab1" * 30_000,
        "é" * 5_000 + " " * 3_000 + "x",
        "".join(chr(c) for c in range(0x250)),
        "".join(chr(c) for c in range(0x1C80, 0x1CA0)),
        *("".join(rng.choices(mixed, k=rng.randint(1, 60))) for _ in range(400)),
        prose(5, 3_000),
    ]


def test_counts_equal_the_library(spark, vocabulary, library):
    texts = odd_texts()
    docs = docs_frame(spark, [*enumerate(texts), (3, texts[3]), (None, "same id")]).withColumnRenamed("row", "n_tokens")
    got = T.count_tokens(docs, vocabulary)
    assert got.columns == [*docs.columns, "n_bytes", "_n_tokens", "n_merged", "over_limit"]
    rows = got.collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        wanted = library(r.text)
        assert (r["_n_tokens"], r.n_bytes) == (wanted, len((r.text or "").encode())), r.text
        assert r.over_limit == (wanted > 1024)


def test_every_disputed_character(vocabulary, library):
    count = T.counter(vocabulary)
    for code in vocabulary.odd:
        text = f"ab{chr(code)}c 1{chr(code)}2 !{chr(code)}"
        assert count(text)[0] == library(text), hex(code)


def test_given_documents(spark, vocabulary, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = T.token_digest(docs, vocabulary).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: library(t) for i, t in texts.items()}
    assert T.token_digest(docs.where("false"), vocabulary).count() == 0


def test_whole_strings_are_proved(vocabulary, library):
    assert all(library(s) == 1 for s in vocabulary.whole)
    # a vocabulary string that its own bytes are not merged to
    assert len(vocabulary.whole) < 50_256
    count = T.counter(vocabulary)
    assert count(" the")[1] == 0 and count("zqxjkvw")[1] == 1


def test_heap_and_list_merge_alike(vocabulary):
    rng = random.Random(1)
    for _ in range(300):
        octets = bytes(rng.choices(b"etaoin shrdlu\xc3\xa9", k=rng.randint(1, T.HEAP_BYTES)))
        ids = [vocabulary.bytes_[b] for b in octets]
        assert T._merged_by_heap(ids, vocabulary.merges) == T.merged(octets, vocabulary)
