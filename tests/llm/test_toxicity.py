"""The conditional random field: exact inference on small chains, held-out documents, odd cases."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from hourlake.llm import toxicity as T
from hourlake.llm.labels import fold, labelled_texts
from tests.llm.texts import docs_frame, prose

SF = "/root/testdata/sf0.01"


def brute_marginals(emissions, moves):
    """P(tag 1) by place, over all taggings."""
    total, by_place = 0.0, np.zeros(len(emissions))
    for tags in itertools.product((0, 1), repeat=len(emissions)):
        score = sum(e for e, t in zip(emissions, tags, strict=True) if t)
        score += sum(moves[a, b] for a, b in zip(tags, tags[1:]))
        total += np.exp(score)
        by_place += np.exp(score) * np.array(tags)
    return by_place / total


def test_marginals_equal_brute_force():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 7, 1, 5, 0])
    emissions, moves = rng.normal(size=lengths.sum()) * 2, rng.normal(size=(2, 2))
    got = T.marginals(emissions, lengths, moves)
    at = 0
    for n in lengths:
        assert np.allclose(got[at : at + n], brute_marginals(emissions[at : at + n], moves))
        at += n


def test_expected_pairs_add_up():
    rng = np.random.default_rng(2)
    lengths = np.array([4, 1, 6])
    p, pairs = T._pairs(rng.normal(size=11), lengths, rng.normal(size=(2, 2)))
    assert np.isclose(pairs.sum(), (lengths - 1).sum())
    first = np.array([0, 1, 2, 5, 6, 7, 8, 9])  # all places but the last of each chain
    assert np.isclose(pairs[1].sum(), p[first].sum())


def test_lexicon_takes_no_words_of_mere_copies():
    bad = ["slur", "curse", "insult"]
    texts = [prose(i, 30).split() + [bad[i % 3], bad[(i + 1) % 3]] for i in range(30)]
    copy = prose(500, 30).split()
    texts += [copy + ["slur", "curse"] for _ in range(20)] + [prose(900 + i, 40).split() for i in range(200)]
    found = T.lexicon(texts, [1] * 50 + [0] * 200)
    stems = {s.rstrip("*") for s in found}
    assert all(any(w.startswith(s) for s in stems) for w in bad)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_documents(spark, tables):
    docs, labels = tables
    scored = T.toxicity_digest(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in scored if r.held_out]
    right = sum(r.predicted == r.toxic for r in held)
    assert right >= 0.95 * len(held)
    toxic = [r for r in scored if r.toxic == 1]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    for r in scored:
        assert 0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.5)


def test_spans_are_places_in_the_text(spark, tables):
    docs, labels = tables
    model = T.learn(docs, labels)
    text = "É " + prose(3, 20) + " you WORTHLESS idiot, trash " + prose(4, 20)
    frame = docs_frame(spark, [text, None, "", "??", prose(8, 25_000)]).drop("score")
    rows = {r.doc_id: r for r in T.score(frame, model).collect()}
    marked = " ".join(text[s.start : s.end] for s in rows[0].spans)
    assert "idiot" in marked and "trash" in marked and rows[0].score >= 0.5
    assert rows[1].score == rows[2].score == rows[3].score < 0.5 and rows[1].spans == []
    assert rows[4].score < 0.5
    with pytest.raises(ValueError):
        T.score(docs_frame(spark, [text]), model)


def test_parts_of_a_batch_give_the_same(spark, tables, monkeypatch):
    docs, labels = tables
    model, few = T.learn(docs, labels), docs.limit(60)
    whole = {r.doc_id: r.score for r in T.score(few, model).collect()}
    assert list(T._parts([5, 0, 7, 1])) == [(0, 4)]
    monkeypatch.setattr(T, "BYTES_AT_ONCE", 6)
    assert list(T._parts([5, 0, 7, 1])) == [(0, 3), (3, 1)] and list(T._parts([])) == []
    assert whole == pytest.approx({r.doc_id: r.score for r in T.score(few, model).collect()})


def test_without_labels_of_both_kinds(spark):
    docs = docs_frame(spark, [prose(i, 9) for i in range(8)] + [None])
    for rows in ([], [(i, 0) for i in range(9)], [(1, None), (None, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        got = T.toxicity_digest(docs.drop("score"), labels).collect()
        assert [r.predicted for r in got] == [0] * 9
    empty = docs.drop("score").where("false")
    assert T.toxicity_digest(empty, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_samples_are_whole_distinct_and_bounded(spark):
    docs = docs_frame(spark, [*enumerate(["a", "b", "b", None, "c" * 50]), (1, "again")])
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (2, 1), (3, 0), (4, 1), (9, 1)], "doc_id long, toxic int")
    got = labelled_texts(docs, labels, "toxic", fold("doc_id", 5) >= 0, chars=20)
    assert sorted(got) == [("", 0), ("a", 1), ("again", 0), ("b", 1)]
    assert len(labelled_texts(docs, labels, "toxic", fold("doc_id", 5) >= 0, rows=2)) <= 2
