"""Collocations against brute force, and the automata of counts against dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from hourlake.llm import collocations as C
from hourlake.llm.count_automata import build, compose, summed, union, unpacked
from tests.llm.texts import SF, lowered


def brute(rows, longest=C.LONGEST, least=C.LEAST, cover=C.COVER, first=C.FIRST):
    counts: dict[str, Counter] = {}
    for text, lang in rows:
        found = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", lowered(text)):
            words = re.findall(r"[^ \t]+", piece)
            for size in range(1, longest + 1):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for w, c in f.items() if len(w) == 1)
        candidates = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        larger = Counter()
        for w, a in candidates.items():
            for i in range(len(w)):
                for j in range(i + 1, len(w) + 1):
                    if j - i < len(w):
                        larger[w[i:j]] = max(larger[w[i:j]], a)
        scored = []
        for w, a in candidates.items():
            if larger[w] and 100 * larger[w] >= cover * a:
                continue
            cuts = [(1_000_000 * a * a // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        scored.sort()
        out += [
            (lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(scored[:first])
        ]
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "é", "b\x01", "b", "c'd", "\x7f", "𝄞", "uno", " "]
    ends = [" ", "  ", "\t", " ", " ", ". ", ",", "\n", "!\r\n", "\x0b", " "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choices(words, [8, 6, 4, 3, 3, 2, 1, 1, 1, 1])[0] + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "en", "en", "de", "", None, "und"])))
    return rows


def hostile():
    rows = texts(1, 150) + [(None, "en"), ("", None), ("...", "xx"), (" \t ", "yy")]
    rows += [("the common line of all. ", "en")] * 200 + [("x y " * 4_000, "de"), ("z" * 9_000, "de")]
    return rows


def frame(spark, rows):
    data = [(i, t, lang, "x", 1.0) for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(data, "range int, text string, lang string, phrase string, score double")


def small_parts(monkeypatch):
    for name, value in {
        "SHARD_WORDS": 300, "CHUNK_BYTES": 64, "UNION_PATHS": 500, "LEAST_RANGE_WORDS": 200, "RANGES_AT_ONCE": 2,
    }.items():
        monkeypatch.setattr(C, name, value)


def borders_of(spark, docs):
    texts_ = docs.selectExpr("coalesce(lang, 'und') as lang", "cast(coalesce(text, '') as binary) as octets")
    return C._borders(texts_, C.LONGEST)


@pytest.mark.parametrize("parts", ["large", "small"])
def test_phrases_equal_brute_force(spark, monkeypatch, parts):
    rows = hostile()
    docs = frame(spark, rows).repartition(6)
    wanted = brute(rows)
    if parts == "large":
        assert sorted(map(tuple, C.collocation_digest(docs).collect())) == wanted
        return
    # the tasks import the module anew, so they get the sizes by argument of a patched function
    monkeypatch.setattr(C, "LEAST_RANGE_WORDS", 100)
    monkeypatch.setattr(C, "RANGES_AT_ONCE", 2)
    assert len(borders_of(spark, docs)) >= 2
    assert sorted(map(tuple, C.collocation_digest(docs).collect())) == wanted


def test_windows_reach_over_the_cuts_of_a_long_text(monkeypatch):
    small_parts(monkeypatch)
    rows = [(t, "en") for t, _ in texts(5, 40)] + [("p q r s " * 700, "en")]
    found = Counter()
    shard = C.Shard(3)
    for text, _ in rows:
        for words, matrix, counts in [*shard.add((text + "\n").encode())]:
            add(found, words, *C.all_prefixes(matrix, counts))
    for words, matrix, counts in shard.windows():
        add(found, words, *C.all_prefixes(matrix, counts))
    wanted = Counter()
    for text, _ in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", lowered(text)):
            words = [w.encode() for w in re.findall(r"[^ \t]+", piece)]
            for size in (1, 2, 3):
                wanted.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    assert found == wanted


def add(found, words, matrix, counts):
    for row, n in zip(matrix.tolist(), counts.tolist(), strict=True):
        found[tuple(words[i - 1] for i in row if i)] += n


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert sorted(map(tuple, C.collocation_digest(docs).collect())) == brute(rows)
    assert C.collocation_digest(docs.where("false")).count() == 0


def test_other_lengths_and_limits(spark):
    rows = texts(8, 120)
    scored, words = C.score_phrases(frame(spark, rows), longest=5, least=3, cover=70)
    got = sorted(map(tuple, C.first_phrases(scored, words, first=25).collect()))
    assert got == brute(rows, 5, 3, 70, 25)


def test_scores_are_exact():
    rng = random.Random(2)
    big = [(rng.randint(10, 1 << 40), 0, 0) for _ in range(2_000)]
    cases = [(a, a * rng.randint(1, 50), a + rng.randint(0, 9)) for a, _, _ in big]
    cases += [(a, a, a) for a, _, _ in big[:50]] + [(10, 10 * k, 10) for k in range(1, 400)]
    a, l, r = (np.array(c, dtype=np.int64) for c in zip(*cases, strict=True))
    assert C.scores(a, l, r).tolist() == [10**6 * x * x // (y * z) for x, y, z in cases]


def random_automaton(rng, size, depth=3):
    words = sorted({bytes(rng.choices(b"ab\x01\xff", k=rng.randint(1, 3))) for _ in range(12)})
    wanted = {}
    for _ in range(size):
        path = tuple(rng.choices(words, k=rng.randint(1, depth)))
        wanted[path] = wanted.get(path, 0) + rng.randint(1, 3)
    number = {w: i + 1 for i, w in enumerate(words)}
    matrix = np.array([[*(number[w] for w in p), *[0] * (depth - len(p))] for p in wanted], dtype=np.int32)
    return wanted, build(words, *summed(matrix, np.array([*wanted.values()]), len(words)))


def content(automaton):
    matrix, weights = automaton.paths()
    rows = [tuple(automaton.symbols[i - 1] for i in row if i) for row in matrix.tolist()]
    assert rows == sorted(rows) and len(set(rows)) == len(rows)
    return dict(zip(rows, weights.tolist(), strict=True))


def test_automata_keep_add_and_look_up():
    rng = random.Random(4)
    for size in (1, 2, 5, 40, 400):
        (one, first), (two, second) = random_automaton(rng, size), random_automaton(rng, size)
        assert content(first) == one
        assert content(unpacked(first.packed())) == one
        assert content(union([first, second])) == {k: one.get(k, 0) + two.get(k, 0) for k in {*one, *two}}
        assert content(union([first, second], np.maximum)) == {k: max(one.get(k, 0), two.get(k, 0)) for k in {*one, *two}}
        assert compose(first, second).tolist() == [two.get(k, 0) for k in content(first)]


def test_equal_states_are_shared():
    words = [b"x%03d" % i for i in range(100)]
    matrix = np.array([[i, j, k] for i in range(1, 60) for j in (1, 2) for k in (3, 4, 5)], dtype=np.int32)
    automaton = build(words, matrix, np.ones(len(matrix), dtype=np.int64))
    # one state of three arcs, one of two, and the root
    assert len(automaton.label) == 3 + 2 + 59 and len(content(automaton)) == len(matrix)
