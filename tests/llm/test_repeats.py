"""Removal of long repeats against a count of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from hourlake.llm import repeats as R
from hourlake.llm import run_index as X
from tests.llm.texts import SF, docs_frame, prose


def brute(docs, size=200):
    counts: dict[bytes, int] = {}
    for _, text in docs:
        body = (text or "").encode()
        for i in range(len(body) - size + 1):
            window = body[i : i + size]
            counts[window] = counts.get(window, 0) + 1
    out = []
    for key, text in docs:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - size + 1):
            if counts[body[i : i + size]] > 1:
                gone[i : i + size] = b"\x01" * size
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((key, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def odd_texts():
    rng = random.Random(4)

    def text(n):
        return "".join(rng.choice("abcdefgé ") for _ in range(n))

    passage, short = text(400), text(150)
    out = [None, "", "a" * 199, "a" * 200, "a" * 201, "b" * 1000, "xy" * 300, text(120) * 5]
    out += [text(300) + passage[:220] + text(100), text(50) + passage[10:] + text(20), passage, passage]
    out += [passage[:205] + text(300), text(100) + passage[100:301] + text(40)]
    out += [text(90) + short + text(90) for _ in range(40)]
    out += [text(30) + short + passage[:150] for _ in range(5)]
    for _ in range(30):
        edited = list(short + passage[:300])
        for _ in range(2):
            edited[rng.randrange(len(edited))] = rng.choice("pqrs")
        out.append("".join(edited))
    return out


@pytest.mark.parametrize("contents", [2048, 6])
def test_digest_equals_brute_force(spark, contents, monkeypatch):
    monkeypatch.setattr(R.repeated_intervals, "__defaults__", (contents,))
    monkeypatch.setattr(R, "BUCKET_BYTES", 5_000)
    rows = [*enumerate(odd_texts()), (5, "b" * 1000), (None, prose(1, 300)), (77, prose(2, 30_000))]
    got = sorted((tuple(r) for r in R.repeat_digest(docs_frame(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted((tuple(r) for r in R.repeat_digest(docs).collect()), key=repr)
    assert got == brute(rows) and sum(r[2] for r in got) > 0


def test_no_documents(spark):
    assert R.repeat_digest(docs_frame(spark, ["a"]).where("false")).count() == 0


def test_a_clash_of_document_hashes_marks_no_other_text():
    body = prose(3, 200).encode()
    first, count, own, _, content = R.stretches(body)
    where = int(first[0]) << 16 | int(own[0] - first[0]) << 8 | (int(count[0]) - 1)
    import pyarrow as pa

    kind = pa.list_(pa.struct([("where", pa.int64()), ("content", pa.int64()), ("begin", pa.int32()), ("past", pa.int32())]))

    def spans(own):
        found = [{"where": where, "content": own, "begin": 0, "past": 1}]
        return R.removed_spans(body, pa.array([found], kind)[0])

    right = int(content[:1].view(np.int64)[0])
    assert spans(right) == [(int(first[0]), int(first[0]) + R.LENGTH)] and spans(right ^ 1) == []


def test_matching_statistics_equal_brute_force():
    rng = random.Random(2)
    for t in range(60):
        alphabet = b"ab" if t % 2 else bytes(range(97, 105))
        strings = [bytes(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(rng.randint(1, 5))]
        strings += [strings[0]] * (t % 3 == 0) + [b"a" * rng.randint(1, 200)] * (t % 5 == 0)
        text = X.joined(strings)
        symbols = text.tolist()
        assert list(X.suffix_order(text)) == sorted(range(len(text)), key=lambda i: symbols[i:])

        def match(a, b, s=symbols):
            n = 0
            while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            return n

        wanted = [max((match(i, j) for j in range(len(text)) if j != i), default=0) for i in range(len(text))]
        assert X.RunIndex(text).matching_statistics(10**9).tolist() == wanted
        assert X.RunIndex(text).matching_statistics(3).tolist() == [min(3, w) for w in wanted]


def test_runs_are_few_for_repetitive_strings():
    text = prose(1, 100).encode()
    copies = X.RunIndex(X.joined([text[i:] for i in range(0, 40)]))
    assert copies.runs < 0.1 * len(copies.text)


def test_a_minimizer_with_very_many_contents_is_split(spark, monkeypatch):
    """One passage among ever other texts: groups are split down to a single reach, and nothing is lost."""
    monkeypatch.setattr(R, "BUCKET_BYTES", 50_000)
    rng = random.Random(6)

    def text(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    middle = text(130)
    texts = [text(rng.randint(30, 90)) + middle + text(rng.randint(30, 90)) for _ in range(120)]
    texts += [t[:-5] + text(5) for t in texts[:20]] + [text(8) + t[8:] for t in texts[20:40]]
    line = text(215)
    texts += [text(100) + line + text(100) for _ in range(60)]
    rows = [*enumerate(texts)]
    wanted = brute(rows)
    split = []
    original = R._split
    monkeypatch.setattr(R, "_split", lambda strings, width: split.append(width) or original(strings, width))
    for contents, widths in ((2_048, []), (40, [80, 20, 5, 1])):
        split.clear()
        monkeypatch.setattr(R.repeated_intervals, "__defaults__", (contents,))
        got = sorted((tuple(r) for r in R.repeat_digest(docs_frame(spark, rows)).collect()), key=repr)
        assert got == wanted and split == widths
