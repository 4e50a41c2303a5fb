"""Piece ids against the library, and decoding."""

from __future__ import annotations

import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from hourlake.llm import sentencepiece_codec as S
from tests.llm.texts import PIECES, SF, docs_frame, prose

ODD = [
    None,
    "",
    " ",
    "  a  b\n\n c\t▁z 123 <s> <0x0A> ",
    "日本語テキスト\x00q 🙂🙂",
    "a" * 200 + "日本語 🙂x" * 30,
    "x" * 500 + "!!" + "don't, (see) THE. end... $x$",
    prose(1, 20_000),
    "same words",
    "same words",
]


@pytest.fixture(scope="module")
def model():
    return S.load_model(PIECES)


def library(kind=None):
    if kind is None:
        return sentencepiece.SentencePieceProcessor(model_file=PIECES)
    from sentencepiece import sentencepiece_model_pb2 as format_

    proto = format_.ModelProto()
    with open(PIECES, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = kind
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


@pytest.mark.parametrize("head", [S.HEAD, 100, 0])
def test_ids_are_those_of_the_library(spark, model, head):
    docs = docs_frame(spark, [*enumerate(ODD), (None, "no id")])
    docs = docs.select("doc_id", "text").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 100, "text").toDF("doc_id", "text").limit(80)
    )
    texts = {r.doc_id: r.text for r in docs.collect()}
    lib = library()
    rows = S.encode(docs, model, head=head).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == lib.encode(texts[r.doc_id] or "") and r.restored


def test_round_trip_keeps_columns(spark, model):
    encoded = S.encode(docs_frame(spark, ODD), model).withColumn("more", F.lit(1))
    decoded = S.decode(encoded, model)
    assert decoded.columns == ["doc_id", "ids", "restored", "more", "text"]
    for r in decoded.collect():
        assert r.text == (ODD[r.doc_id] or "").replace("▁", " ")
    with pytest.raises(ValueError):
        S.decode(decoded, model)


def test_no_documents(spark, model):
    empty = docs_frame(spark, ODD).where("false")
    assert S.encode(empty, model).count() == 0


def words_of(model, texts):
    find = re.compile(model.pattern).findall
    return sorted({w for t in texts for w in find(model.marked(t or "")) if len(w) <= S.SHORT})


@pytest.mark.parametrize("kind", [S.BPE, S.UNIGRAM])
def test_folds_agree(spark, kind):
    """The fold of Spark's aggregate, the fold of columns, and the one for long words."""
    model = S.load_model(PIECES, kind)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(8).collect()]
    words = words_of(model, [*texts, *ODD[:7]])[:1500]
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    folded = {r.word: r.ids for r in S.encode_words(frame, model).collect()}
    pieces = S.Pieces(model)
    columns = dict(zip(words, pieces.encode(words), strict=True))
    for word in words:
        ids = np.frombuffer(columns[word], "<i4").tolist()
        assert folded[word] == ids == S.fold_long(word, pieces.known, model)


def test_viterbi_finds_the_best_score():
    """Scores are compared, not ids: the library adds up in single precision."""
    model = S.load_model(PIECES, S.UNIGRAM)
    pieces = S.Pieces(model)
    score = {i: s for _, i, s in model.pieces}
    lib = library(S.UNIGRAM)
    for word in prose(5, 60).split():
        (raw,) = pieces.encode([" " + word])
        ours = sum(score.get(i, model.unknown_score) for i in np.frombuffer(raw, "<i4").tolist())
        theirs = sum(score.get(i, model.unknown_score) for i in lib.encode(word))
        assert ours >= theirs - 1e-6


def test_no_piece_crosses_words(model):
    find = re.compile(model.pattern).findall
    lib = library()
    for text in ["the,end. (a)b don't 12ab! x-y_z", "THE!! thnt### a$$$ | é, ß."]:
        whole = lib.encode(text)
        parts = [i for w in find(model.marked(text)) for i in np.frombuffer(S.Pieces(model).encode([w])[0], "<i4").tolist()]
        assert parts == whole and "".join(find(model.marked(text))) == model.marked(text)


def test_rare_words_are_forgotten_in_time(model, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(S, "REMEMBERED", 3)
    empty = pa.table({"word": pa.array([], pa.string()), "ids": pa.array([], pa.list_(pa.int32()))})
    table = S.Table(empty, model)
    for words in ({"a", "b"}, {"c", "d"}, {"e" * 70, "a"}):
        table.meet(words)
        assert words <= table.known.keys() and len(table.met) <= 3
