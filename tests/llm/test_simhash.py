"""SimHash groups against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from hourlake.llm import simhash as S
from tests.llm.texts import docs_frame, lowered, prose


def brute_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes, distance=2):
    codes = sorted(set(codes))
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {c: find(c) for c in codes}


def near(rng, code, most):
    for _ in range(rng.randint(0, most)):
        code ^= 1 << rng.randrange(64)
    return code


def signed(code):
    return code - (1 << 64) if code >> 63 else code


@pytest.mark.parametrize("visitors", [64, 65_536])
def test_components_equal_brute_force(spark, monkeypatch, visitors):
    monkeypatch.setattr(S, "VISITORS", visitors)
    rng = random.Random(visitors)
    codes = [near(rng, c, 3) for c in (rng.getrandbits(64) for _ in range(5)) for _ in range(90)]
    codes += [rng.getrandbits(64) for _ in range(300)] + [0, 1, 3, 7, (1 << 64) - 1, 1 << 63]
    frame = spark.createDataFrame([(signed(c),) for c in set(codes)], "code long")
    found = S.components(S.links(frame, 2, page=32)).collect()
    got = {c: c for c in codes} | {r.code % (1 << 64): r.root % (1 << 64) for r in found}
    by_root, wanted = {}, {}
    for c, r in got.items():
        by_root.setdefault(r, set()).add(c)
    for c, r in groups(codes).items():
        wanted.setdefault(r, set()).add(c)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, wanted.values()))


def test_nodes_find_every_near_code():
    rng = random.Random(3)
    members = np.array([near(rng, 0x0F0F << 20, 9) for _ in range(500)], dtype=np.uint64)
    members = np.unique(members)[S.gray_rank(np.unique(members)).argsort()]
    queries = np.array([near(rng, int(m), 4) for m in members[:80]], dtype=np.uint64)
    q, n = S.Nodes(members, members).search(queries, 2)
    pairs = {(i, j) for i in range(len(queries)) for j in range(len(members)) if int(queries[i] ^ members[j]).bit_count() <= 2}
    assert set(zip(q.tolist(), n.tolist(), strict=True)) == pairs


TEXTS = [None, "", "  \t\n", "One", "one", "one two", "One  TWO\nthree four", "É é", prose(1, 400), prose(1, 400),
         prose(1, 400) + " more", prose(2, 400), "\x00 \x85 odd", prose(4, 70_000)]


def test_digest_equals_brute_force(spark):
    rows = [*enumerate(TEXTS), (3, "One"), (None, prose(2, 400))]
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    root = groups([c for _, c in prints])
    least = {}
    for i, c in prints:
        if i is not None:
            least[root[c]] = min(least.get(root[c], i), i)
    wanted = sorted(((i, f"{c:016x}", least.get(root[c])) for i, c in prints), key=repr)
    got = S.near_duplicate_digest(docs_frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == wanted


def test_one_document_of_each_group_stays(spark):
    docs = docs_frame(spark, [*enumerate(TEXTS), (3, "One"), (8, prose(1, 400)), (None, prose(77, 50))])
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    root = groups([brute_fingerprint(t) for t in TEXTS])
    first = {}
    for i, t in enumerate(TEXTS):
        first.setdefault(root[brute_fingerprint(t)], i)
    assert sorted(ids, key=repr) == sorted([*first.values(), None], key=repr)


def test_no_documents(spark):
    empty = docs_frame(spark, TEXTS).where("false")
    assert S.near_duplicate_digest(empty).count() == 0
    assert S.drop_near_duplicates(empty).count() == 0


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = prose(6, 500)
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "SHINGLES_AT_ONCE", 7)
    assert S.fingerprint(text) == whole == brute_fingerprint(text)
