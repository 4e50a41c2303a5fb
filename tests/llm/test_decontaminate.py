"""Benchmark decontamination against a brute-force search."""

from __future__ import annotations

import hashlib

import pytest

from hourlake.llm import decontaminate as D
from tests.llm.texts import docs_frame, plain_docs, prose, words

PASSAGE = prose(1, 25)
ITEMS = [(1, PASSAGE), (2, "Alpha, BETA gamma"), (3, None), (4, "..."), (10, "solo"), (1, PASSAGE), (None, prose(5, 12))]
TEXTS = [
    None,
    "",
    "... !!",
    "x " + PASSAGE + " y",
    PASSAGE.upper().replace(" ", " -- "),
    " ".join(PASSAGE.split()[3:12]),
    " ".join(PASSAGE.split()[3:13]),
    "alpha beta gamma delta alpha; beta; gamma",
    "alpha beta",
    "a solo b solo",
    prose(5, 12),
    PASSAGE + " " + PASSAGE,
    prose(9, 30_000),
    "Ünï " + prose(3, 40),
]


def brute(texts, items, n=10):
    windows = {}
    for item, text in items:
        found = words(text)
        size = min(n, len(found))
        for i in range(len(found) - size + 1 if found else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in texts:
        found, hit, ids = words(text), set(), set()
        for size in sizes:
            for i in range(len(found) - size + 1):
                if (w := tuple(found[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    ids |= windows[w]
        ids = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc, len(found), len(hit), len(ids), digest, len(hit) > 0))
    return sorted(out, key=repr)


def items_frame(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def test_digest_equals_brute_force(spark):
    texts = [*enumerate(TEXTS), (3, TEXTS[3]), (None, PASSAGE)]
    docs = docs_frame(spark, texts)
    got = sorted((tuple(r) for r in D.contamination_digest(docs, items_frame(spark)).collect()), key=repr)
    assert got == brute(texts, ITEMS)


def test_joined_windows_give_the_same(spark):
    docs = docs_frame(spark, TEXTS)
    listed = D.scan(docs, items_frame(spark), ["doc_id"]).collect()
    joined = D.scan(docs, items_frame(spark), ["doc_id"], set_bytes=0).collect()

    def key(r):
        return repr((r.doc_id, r.n_words, r.n_hit, r.spans, sorted(map(str, r["items"]))))

    assert sorted(map(key, listed)) == sorted(map(key, joined))


@pytest.mark.parametrize("items", [[], [(1, None)]])
def test_nothing_to_find(spark, items):
    got = D.contamination_digest(plain_docs(spark, TEXTS), items_frame(spark, items)).collect()
    assert len(got) == len(TEXTS) and not any(r.contaminated for r in got)


def test_no_documents(spark):
    empty = docs_frame(spark, TEXTS).where("false")
    assert D.contamination_digest(empty, items_frame(spark)).count() == 0
    assert D.decontaminate(empty, items_frame(spark)).count() == 0


def test_documents_or_spans_are_removed(spark):
    docs = docs_frame(spark, [*enumerate(TEXTS), (3, "clean one"), (3, TEXTS[3])])
    kept = D.decontaminate(docs, items_frame(spark), "documents")
    assert kept.columns == docs.columns
    bad = {r[0] for r in brute(list(enumerate(TEXTS)), ITEMS) if r[-1]}
    assert sorted(r.doc_id for r in kept.collect()) == sorted((set(range(len(TEXTS))) - bad) | {3})
    cut = D.decontaminate(docs, items_frame(spark), "spans")
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert any(i == 3 and t.split() == ["x", "y"] for i, t in texts if t)
    assert any(i == 9 and t.split() == ["a", "b"] for i, t in texts if t)
    assert (8, "alpha beta") in texts and (0, None) in texts


def test_a_passage_that_very_many_items_share(spark):
    """Items are unfolded once for each set of them, not at each place."""
    passage, other = prose(31, 60), prose(32, 40)
    rows = [(f"i{i}", passage) for i in range(3_000)] + [("other", other), ("both", f"{passage} {other}")]
    items = spark.createDataFrame(rows, "item_id string, text string")
    docs = docs_frame(spark, [f"{prose(33, 30)} {passage} {passage} x", f"{passage[:200]} {other}", "clean words only"])
    got = {r.doc_id: r for r in D.scan(docs, items, ["doc_id"]).collect()}
    assert sorted(got[0]["items"]) == sorted([*(f"i{i}" for i in range(3_000)), "both"])
    assert set(got[1]["items"]) == {"other", "both", *(f"i{i}" for i in range(3_000))} and not got[2]["items"]
    assert got[0].n_hit == 120


def test_more_windows_than_bits(spark, monkeypatch):
    """Full bitmaps let every place pass; the result is the same."""
    docs, items = docs_frame(spark, [prose(s, 80) for s in range(40, 60)]), spark.createDataFrame(
        [(f"i{s}", " ".join(prose(s, 80).split()[20:45])) for s in range(45, 52)] + [("short", "a the")], "item_id string, text string"
    )
    wanted = sorted(map(repr, D.contamination_digest(docs, items).collect()))
    monkeypatch.setattr(D, "BITS", 64)
    assert sorted(map(repr, D.contamination_digest(docs, items).collect())) == wanted


def test_one_document_with_very_many_separate_hits(spark):
    hit = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([("i", hit)], "item_id string, text string")
    docs = docs_frame(spark, [" x ".join([hit] * 20_000)])
    r = D.contamination_digest(docs, items).first()
    assert (r.n_hit, r.n_items) == (200_000, 1)
