"""The additive model: held-out documents, tables that learn what is there, odd cases."""

from __future__ import annotations

import numpy as np
import pytest

from hourlake.llm import quality as Q
from tests.llm.texts import docs_frame, prose

SF = "/root/testdata/sf0.01"


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.quality_digest(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)
    for r in rows:
        assert 0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.7)


def test_tables_learn_steps_and_pairs():
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(Q.FEATURES)))
    step = (x[:, 2] > 0.4).astype(float)
    model = Q.fit_table(x, step)
    assert ((model.score(x) >= 0.5) == (step == 1)).mean() >= 0.97
    both = ((x[:, 0] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = Q.fit_table(x, both)
    assert (0, 5) in [(i, j) for i, j, _ in model.pairs]
    assert ((model.score(x) >= 0.5) == (both == 1)).mean() >= 0.85


def test_a_score_is_the_sum_of_its_entries():
    rng = np.random.default_rng(5)
    x = rng.random((400, len(Q.FEATURES)))
    model = Q.fit_table(x, (x[:, 1] + x[:, 3] > 1).astype(float))
    for row, score in zip(x[:20], model.score(x[:20]), strict=True):
        total = model.base
        for k, table in enumerate(model.tables):
            total += table[sum(e <= row[k] for e in model.edges[k])]
        for i, j, table in model.pairs:
            total += table[sum(e <= row[i] for e in model.coarse[i]), sum(e <= row[j] for e in model.coarse[j])]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_features_of_odd_texts():
    assert Q.describe("") == [0.0] * len(Q.FEATURES) == Q.describe(" \n\t")
    named = dict(zip(Q.FEATURES, Q.describe("AA aa AA\nAA aa AA"), strict=True))
    assert named["words"] == 6 and named["distinct_words"] == 1 / 3 and named["lines"] == 2
    assert named["distinct_lines"] == 0.5 and named["repeated_in_a_row"] == pytest.approx(1 / 6)


@pytest.mark.parametrize("rows", [[], [(0, 1), (1, 1), (2, None)]])
def test_without_labels_of_both_kinds(spark, rows):
    docs = docs_frame(spark, [None, "", prose(1, 5), prose(2, 30_000)]).drop("score")
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = Q.quality_digest(docs, labels).collect()
    assert [r.score for r in got] == [1.0] * 4
    assert Q.quality_digest(docs.where("false"), labels).count() == 0


def test_other_columns_pass_through(spark):
    model = Q.fit([(prose(i, 20), 1) for i in range(40)] + [("x " * 50, 0) for _ in range(40)])
    docs = docs_frame(spark, [prose(99, 20), "x " * 50, None])
    got = Q.score(docs, model, scored="quality").collect()
    assert got[0].quality > 0.7 > got[1].quality and got[0].words == "x" and got[0].row == 1
    with pytest.raises(ValueError):
        Q.score(docs, model)
