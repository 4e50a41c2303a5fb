"""Vector codes against brute force over all entries, with integers of any size."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from hourlake.llm import vector_codes as V
from hourlake.llm.slice_index import SliceIndex
from tests.llm.texts import SF

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], SCHEMA)


def brute(rows, parts=V.PARTS, entries=V.ENTRIES, rounds=V.ROUNDS):
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts

    def cut(v):
        return [v[p * width : (p + 1) * width] for p in range(parts)]

    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        members = [[[] for _ in book] for book in books]
        for _, v, _ in kept:
            for p, x in enumerate(cut(v)):
                members[p][nearest(x, books[p])[1]].append(x)
        books = [
            [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e for e, m in zip(book, ms, strict=True)]
            for book, ms in zip(books, members, strict=True)
        ]
    out, totals = [], {}
    for i, v, label in kept:
        found = [nearest(x, books[p]) for p, x in enumerate(cut(v))]
        error = sum(d for d, _ in found)
        totals[label] = totals.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, code, min(e, V.LONGEST), min(totals[label], V.LONGEST), digest) for i, code, e, label in out]


def vectors(seed, n, width, scale=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, scale) for _ in range(width)], rng.choice([0, 1, None])) for i in range(n)]


def hostile():
    rows = vectors(1, 150, 32)
    bad = [None, [], [None] * 32, [1.0] * 31 + [None], [math.nan] * 32, [0.0] * 31 + [math.inf], [0.0] * 31 + [-math.inf]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(bad) if v != []]
    rows += [(500, rows[3][1], 0)] * 40 + [(3, rows[3][1], None), (None, rows[4][1], 1)]
    return rows


CASES = {
    "usual": hostile(),
    "fewer vectors than entries": vectors(2, 9, 16),
    "ties": [(i, [float(i % 3 - 1)] * 48, i % 2) for i in range(200)],
    "wide parts": vectors(3, 120, 16 * 20),
    "large": [(i, [x * 10.0 ** (i % 14) for x in v], label) for i, v, label in vectors(4, 100, 32)],
}


@pytest.mark.parametrize("name", CASES)
def test_codes_equal_brute_force(spark, name):
    rows = CASES[name]
    got = V.code_digest(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)


def test_given_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, V.code_digest(table).collect())) == sorted(brute(rows))


def test_empty_tables_other_lengths_and_clashing_columns(spark):
    none = frame(spark, [(1, None, 1), (2, [math.nan] * 16, 0)])
    assert V.code_digest(none).count() == 0 and V.code_digest(none.limit(0)).count() == 0
    mixed = frame(spark, [*vectors(6, 30, 17), (31, [1.0] * 5, 0), (32, [], 0)])
    coded, books = V.encode_vectors(mixed)
    assert coded.columns == [*mixed.columns, "_code", "_error", "label_error"]
    # seventeen components and fifteen zeros in sixteen parts
    assert {r.vec_id for r in coded.collect()} == set(range(30)) and len(books[0][0]) == 2


def test_decoding_gives_the_entries(spark):
    rows = vectors(7, 40, 32)
    coded, books = V.encode_vectors(frame(spark, rows), rounds=0)
    for r in V.decode_vectors(coded, books, "_code").collect():
        # every vector is an entry of each codebook
        assert r.decoded == [math.floor(256 * x) / 256 for x in rows[r.vec_id][1]]
        assert r["_error"] == 0


def test_many_labels_are_joined_in_places(spark, monkeypatch):
    rows = vectors(8, 90, 16)
    wanted = V.code_digest(frame(spark, rows)).collect()
    monkeypatch.setattr(V, "BROADCAST_LABELS", 1)
    assert sorted(map(tuple, V.code_digest(frame(spark, rows)).collect())) == sorted(map(tuple, wanted))


def test_the_index_skips_entries_and_finds_the_nearest():
    rng = np.random.default_rng(3)
    for count in (1, 2, 63, 64, 65, 200):
        entries = rng.integers(-40, 40, (count, 4))
        points = rng.integers(-400, 400, (500, 4))
        index = SliceIndex(entries)
        best, error = index.nearest(points)
        squares = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (best == squares.argmin(axis=1)).all() and (error == squares.min(axis=1)).all()
    masks = index.candidates(entries, np.full(len(entries), index.radius))
    assert sum(int(m).bit_count() for m in masks.ravel()) < len(entries) ** 2 / 2
