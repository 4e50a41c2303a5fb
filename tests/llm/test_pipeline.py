"""The pipeline against its stages done by hand, and on odd tables."""

from __future__ import annotations

import pytest
import sentencepiece

import corpus_pipeline
from hourlake.llm import secrets, toxicity
from hourlake.llm.labels import fold, labelled_texts
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_simhash import brute_fingerprint, groups
from tests.llm.texts import PIECES, SF, prose


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece"
    ]


def test_run_equals_the_stages_done_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.fit(labelled_texts(docs, labels, "toxic", fold("doc_id", 5) != 0))
    left = sorted((r.doc_id, r.text or "") for r in docs.collect())
    scores, _ = toxicity.score_batch([t for _, t in left], model, toxicity.Emissions(model))
    left = [d for d, s in zip(left, scores, strict=True) if s < 0.5]
    prints = {i: brute_fingerprint(t) for i, t in left}
    root, seen = groups(prints.values()), set()
    left = [(i, t) for i, t in left if not (root[prints[i]] in seen or seen.add(root[prints[i]]))]
    bad = {r[0] for r in contaminated(left, items) if r[-1]}
    left = [d for d in left if d[0] not in bad]
    clean = secrets.redact(spark.createDataFrame(left, "doc_id long, text string"))
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    wanted = sorted((r.doc_id, lib.encode(r.text)) for r in clean.collect())
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == wanted
    assert all(r.restored and r.n_pieces == len(r.ids) for r in got)
    assert 0 < len(got) < docs.count()


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    passage = prose(50, 30)
    rows = [(0, None), (1, ""), (2, prose(1, 300)), (3, prose(1, 300)), (3, prose(1, 300)), (None, prose(2, 90)),
            (4, "x " + passage), (5, "password = hunter2hunter2 " + prose(3, 50)), (6, prose(4, 20_000))]
    docs = spark.createDataFrame(
        [(i, t, None, "s", None, 1, "w", 0.5, "m") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, row int, toxicity string, code double, mark string",
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1)], "doc_id long, toxic int").where("false").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_odd_rows_and_clashing_columns(spark, odd_folder):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, odd_folder)
        assert docs.columns == names
    kept = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    # null and empty share a fingerprint, 2 and 3 are copies, 4 has the passage
    assert [i for i, _ in kept] == [0, 2, 5, 6, None]
    assert dict(kept)[5].startswith("[secret] ")
    assert {r.doc_id for r in corpus_pipeline.run(spark, odd_folder).collect()} == {0, 2, 5, 6, None}


def test_an_empty_table(spark, odd_folder):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, odd_folder)
    assert docs.count() == 0
