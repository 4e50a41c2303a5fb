"""License scan: phrase places against brute force, labels of whole notices."""

from __future__ import annotations

import math

import pytest

from hourlake.llm import licenses as L
from tests.llm.texts import SF, docs_frame, prose, words

TEXTS = [
    None,
    "",
    "Licensed under the Apache License, Version 2.0.",
    "x This work is licensed under the GNU General Public License, version 3. y",
    "gnu general public license gnu general public license",
    "MIT License mit license MIT-License",
    "Released under the MIT License. Licensed under CC BY-NC 4.0.",
    "by cc by the way",
    "the license of the public",
    "apache licenses; apache. License",
    "É mit\nlicense ünder",
    "mit licensed",
    prose(1, 200) + " Licensed under the Apache License, Version 2.0. " + prose(2, 20_000),
    "apache license apache license " * 40,
]


def brute(doc, text):
    found = words(text)
    places = {p: [i for i in range(len(found)) if found[i : i + len(p.split())] == p.split()] for p in L.PHRASES}
    starts = [i for p in places.values() for i in p]
    labels = sorted({L.PHRASES[p] for p, i in places.items() if i})
    return (doc, len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(labels))


def base(rows):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)


def test_base_equals_brute_force(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, TEXTS[5])]
    got = L.license_digest(docs_frame(spark, rows)).collect()
    assert base(got) == sorted((brute(*r) for r in rows), key=repr)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} for r in got)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wanted = sorted((brute(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert base(L.license_digest(docs).collect()) == wanted


def test_templates_need_their_words_in_place_and_key_phrases(spark):
    texts = TEXTS[2:4] + [TEXTS[6], "license apache the under licensed version 0 2", "Licensed under the Apache License",
                          "This work is licensed under the GNU General Public License, version 2."]
    got = {r.doc_id: r for r in L.license_digest(docs_frame(spark, texts)).collect()}
    assert got[0].labels == "apache,apache-2.0" and got[0].score == pytest.approx(1)
    assert got[1].labels == "gpl,gpl-3.0" and got[2].labels == "cc-by,cc-by-nc,mit"
    assert got[3].labels == "" and got[3].score == 0
    assert got[4].labels == "apache" and got[5].labels == "gpl,gpl-2.0"


def test_every_template_finds_its_own_notice(spark):
    texts = [text for _, text, _ in L.TEMPLATES]
    got = {r.doc_id: r for r in L.license_digest(docs_frame(spark, texts)).collect()}
    for i, (label, _, _) in enumerate(L.TEMPLATES):
        assert label in got[i].labels.split(",")


def test_no_documents(spark):
    assert L.license_digest(docs_frame(spark, TEXTS).where("false")).count() == 0


def brute_templates(texts):
    """Labels and score of each text, every template tried at every place with all words."""
    known = L.index_words(L.TEMPLATES, L.PHRASES)
    found = [words(t) for t in texts]
    hits = [
        {i: w for i, w in enumerate(ws) if w in known and (w not in L.ONLY_AFTER or i and ws[i - 1] == L.ONLY_AFTER[w])}
        for ws in found
    ]
    idf = {w: math.log((len(texts) + 1) / (sum(w in h.values() for h in hits) + 1)) + 1 for w in known}
    for ws, hit in zip(found, hits, strict=True):
        labels, score = set(), 0.0
        for label, text, phrases in L.TEMPLATES:
            template = text.split()
            entries = [(n, w) for n, w in enumerate(template) if w not in L.FUNCTION_WORDS]
            for start in range(-len(template), len(ws) + 1):
                share = sum(idf[w] for n, w in entries if hit.get(start + n) == w) / sum(idf[w] for _, w in entries)
                at = [(start + L._place_of(p.split(), template), p.split()) for p in phrases]
                if share >= L.SHARE and all(a >= 0 and ws[a : a + len(p)] == p for a, p in at):
                    labels.add(label)
                    score = max(score, min(share, 1.0))
        yield labels, score


def test_labels_and_score_of_documents_with_more_than_twelve_index_words(spark):
    notices = [text for _, text, _ in L.TEMPLATES]
    texts = [t for t in TEXTS if t] + notices + [
        "; ".join(notices),
        " ".join(reversed(notices)) + " " + prose(5, 500),
        " ".join(t.split(" ", 1)[1] for t in notices),
        " ".join(w for t in notices for w in t.split() if w != "version"),
    ]
    got = {r.doc_id: r for r in L.scan_licenses(docs_frame(spark, texts)).collect()}
    for i, (labels, score) in enumerate(brute_templates(texts)):
        assert set(got[i].found) == labels and got[i].score == pytest.approx(score)
    assert len(got[len(texts) - 4].found) == len(L.TEMPLATES)
