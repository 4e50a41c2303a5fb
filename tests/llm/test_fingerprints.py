"""Prefix hashes and document fingerprints against plain strings."""

from __future__ import annotations

import hashlib
import os.path
import random

from hourlake.llm import fingerprints as P
from tests.llm.texts import SF, docs_frame, prose


def test_spans_and_extensions():
    rng = random.Random(1)
    a = "".join(rng.choices("abé🙂", k=300))
    b = a[40:120] + "".join(rng.choices("abé🙂", k=100)) + a[:50]
    x, y = P.Prefixes(a), P.Prefixes(b)
    for _ in range(400):
        i, j, n = rng.randrange(300), rng.randrange(len(b)), rng.randrange(1, 60)
        inside = i + n <= len(a) and j + n <= len(b)
        assert P.equal_spans(x, i, y, j, n) == (inside and a[i : i + n] == b[j : j + n])
        wanted = len(os.path.commonprefix([a[i:], b[j:]]))
        assert P.common_extension(x, i, y, j) == wanted
    assert P.common_extension(x, 40, y, 0) >= 80 and P.common_extension(x, 300, y, 0) == 0


def test_sketches_of_parts_are_those_of_the_whole():
    rng = random.Random(2)
    for n in (0, 1, 2, 11, 12, 13, 23, 24, 25, 300, 5000):
        own, after = (P.Document("".join(rng.choices("abcdé ", k=k))) for k in (n, rng.choice([0, 3, 500])))
        text, found = P.edited(own, after)
        assert found == P.Document(text).fingerprint
    repeated = P.Document("ab" * 4000)
    assert repeated.fingerprint == P.sketch([repeated.hashes])


def test_likeness():
    base = P.Document(prose(1, 600))
    near = P.Document(prose(1, 600).replace("ha", "ho", 3))
    other = P.Document(prose(2, 600))
    assert P.likeness(base.fingerprint, P.Document(prose(1, 600)).fingerprint) == 1
    assert P.likeness(base.fingerprint, near.fingerprint) > 0.7
    assert P.likeness(base.fingerprint, other.fingerprint) < 0.2
    nothing = P.Document("").fingerprint
    assert P.likeness(nothing, nothing) == 1 and P.likeness(nothing, base.fingerprint) == 0


def brute(rows):
    """(id, n_chars, sha, fingerprints, likenesses) by the order of ids, nulls first."""
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        prints = [P.Document(t).fingerprint for t in (text, changed, after)]
        out.append(
            (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1],
             P.likeness(prints[0], prints[1]), P.likeness(prints[0], prints[2]),
             len(os.path.commonprefix([text, after])))
        )
    return sorted(out, key=repr)


def test_documents_equal_brute_force(spark):
    texts = [None, "", "a", "ab", "é🙂" * 30, prose(1, 400), prose(1, 400), prose(2, 20_000), prose(3, 3)]
    rows = [(7 * i - 20, t) for i, t in enumerate(texts)] + [(None, prose(9, 30))]
    docs = docs_frame(spark, rows)
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted((tuple(r) for r in P.fingerprint_documents(docs).collect()), key=repr)
    assert got == brute(ordered)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ordered = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    got = sorted((tuple(r) for r in P.fingerprint_documents(docs).collect()), key=repr)
    assert got == brute(ordered)


def test_one_document_no_document_and_repeated_rows(spark):
    docs = docs_frame(spark, [prose(1, 50)])
    (one,) = P.fingerprint_documents(docs).collect()
    assert one.near_next == 1 and one.shared_start == one.n_chars
    assert P.fingerprint_documents(docs.where("false")).count() == 0
    same = docs_frame(spark, [(1, "x " * 40)] * 5 + [(1, "y " * 40)])
    got = P.fingerprint_documents(same).collect()
    assert len(got) == 6 and len({r.fingerprint for r in got}) == 2
    assert sorted(r.near_next for r in got)[:2] == [0.0, 0.0] and sum(r.near_next for r in got) == 4
