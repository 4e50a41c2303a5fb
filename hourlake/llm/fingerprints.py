"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, modulo a prime, the sum of its code points times the powers of a
base. From two entries follows the hash of any span, so spans are compared in constant time, longest
common extensions are found by binary search, and the hashes of all spans of one length come from one
subtraction of arrays. Two primes below 2**31 give about 62 bits. A text's fingerprint keeps, for each
of 64 classes of its spans' hashes, a digest of the least; the likeness of two fingerprints is the share
of classes that agree. The edited text shares its parts' spans, so only the spans over the seam are new.

Each document needs the next one's text. Ids are dealt out by ranges; the first document of each range
is also sent to the end of the range before (the very first one to the last range). Tasks then go through
their sorted range with two documents in memory. Texts are compressed while they are moved.

Defined cases: a null text is empty; a null id sorts first; equal ids are ordered by a hash of their
texts; the only document of a table is its own next one; an empty text has a fingerprint of its own kind,
like another empty one (1.0) and unlike all others (0.0); a text shorter than a span is one span.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import in_batches
from hourlake.session import shuffle_partitions

SPAN, CLASSES = 12, 64
PRIMES, BASES = (2_147_483_647, 2_147_483_629), (911_382_323, 972_663_749)
#: Digest of a class without spans, in hex.
EMPTY = "0000"
ROWS_AT_ONCE = 500

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of the bases and of their inverses, grown as texts require."""

    def __init__(self):
        self.up = [np.ones(1, dtype=np.uint64) for _ in PRIMES]
        self.down = [np.ones(1, dtype=np.uint64) for _ in PRIMES]

    def reach(self, n: int) -> None:
        while len(self.up[0]) <= n:
            size = len(self.up[0])
            for k, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
                p, inverse = np.uint64(prime), pow(base, -1, prime)
                up, down = np.uint64(pow(base, size, prime)), np.uint64(pow(inverse, size, prime))
                self.up[k] = np.concatenate([self.up[k], self.up[k] * up % p])
                self.down[k] = np.concatenate([self.down[k], self.down[k] * down % p])


_POWERS = Powers()


class Prefixes:
    """Prefix hashes of one text, by code point."""

    def __init__(self, text: str):
        self.points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        n = len(self.points)
        _POWERS.reach(n + 1)
        self.sums = []
        for k, prime in enumerate(PRIMES):
            p = np.uint64(prime)
            sums = np.zeros(n + 1, dtype=np.uint64)
            # below 2**31 each, so that 2**33 of them can be added
            np.cumsum(self.points * _POWERS.up[k][:n] % p, out=sums[1:])
            self.sums.append(sums % p)

    def __len__(self) -> int:
        return len(self.points)

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """The hash of the span, the same wherever it stands."""
        return tuple(
            (int(s[end]) - int(s[start])) % prime * int(_POWERS.down[k][start]) % prime
            for k, (s, prime) in enumerate(zip(self.sums, PRIMES, strict=True))
        )

    def spans(self, size: int) -> np.ndarray:
        """Mixed hashes of all spans of ``size`` code points, or of the whole if it is shorter."""
        n = len(self)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        size = min(size, n)
        both = []
        for k, prime in enumerate(PRIMES):
            p, sums = np.uint64(prime), self.sums[k]
            both.append((sums[size:] + p - sums[:-size]) % p * _POWERS.down[k][: n - size + 1] % p)
        mixed = (both[0] << np.uint64(31) | both[1]) * _MIX
        return (mixed ^ mixed >> np.uint64(29)) * _MIX


def equal_spans(a: Prefixes, i: int, b: Prefixes, j: int, size: int) -> bool:
    """Whether ``size`` code points of a from i are those of b from j."""
    return i + size <= len(a) and j + size <= len(b) and a.span(i, i + size) == b.span(j, j + size)


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """How many code points of a from i and of b from j agree, by binary search."""
    low, high = 0, min(len(a) - i, len(b) - j)
    while low < high:
        half = (low + high + 1) // 2
        if equal_spans(a, i, b, j, half):
            low = half
        else:
            high = half - 1
    return low


def sketch(parts: list[np.ndarray]) -> str:
    """Four hex digits for each class: of the least hash among the parts' hashes in the class."""
    total = sum(map(len, parts))
    if not total:
        return EMPTY * CLASSES
    # the least of each class is nearly always among so many of the smallest
    limit = min(1.0, 8 * CLASSES / total)
    while True:
        if limit >= 1:
            few = np.concatenate(parts)
        else:
            bound = np.uint64(int(limit * 2**64))
            few = np.concatenate([h[h < bound] for h in parts])
        few = np.sort(few)
        classes, first = np.unique(few & np.uint64(CLASSES - 1), return_index=True)
        if len(classes) == CLASSES or limit >= 1:
            break
        limit = min(1.0, limit * 8)
    out = np.zeros(CLASSES, dtype=np.uint64)
    least = few[first] * _MIX
    out[classes.astype(np.int64)] = (least >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)
    return "".join(f"{v:04x}" for v in out.tolist())


def likeness(a: str, b: str) -> float:
    """Share of agreeing classes among those in which either text has spans."""
    pairs = [(a[i : i + 4], b[i : i + 4]) for i in range(0, len(a), 4)]
    used = [(x, y) for x, y in pairs if x != EMPTY or y != EMPTY]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


class Document:
    def __init__(self, text: str):
        self.text = text
        self.prefixes = Prefixes(text)
        self.hashes = self.prefixes.spans(SPAN)
        self.fingerprint = sketch([self.hashes])

    def part(self, size: int) -> np.ndarray:
        """Hashes of the spans that lie within the first ``size`` code points."""
        return self.hashes[: max(0, size - SPAN + 1)] if len(self.text) >= SPAN else self.hashes[:0]


def edited(own: Document, after: Document) -> tuple[str, str]:
    """The edited text and its fingerprint."""
    n = len(own.text)
    half = n // 2
    head, tail = own.text[: n - half], after.text[:half]
    text = head + tail
    if len(text) < SPAN:
        return text, sketch([Prefixes(text).spans(SPAN)])
    parts = [own.part(len(head)), after.part(len(tail))]
    seam = head[-(SPAN - 1) :] + tail[: SPAN - 1]
    if head and tail and len(seam) >= SPAN:
        parts.append(Prefixes(seam).spans(SPAN))
    return text, sketch(parts)


def compare(own: Document, after: Document) -> tuple:
    text, print_ = edited(own, after)
    return (
        len(own.text),
        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        own.fingerprint,
        print_,
        likeness(own.fingerprint, print_),
        likeness(own.fingerprint, after.fingerprint),
        common_extension(own.prefixes, 0, after.prefixes, 0),
    )


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, shared_start long"
)


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, its fingerprint and what it shares with its edit and the next."""
    keyed = docs.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    dealt, ranges = _dealt_by_range(keyed)
    # range i goes to task i: hashed numbers would give some tasks several, and some none
    ordered = dealt.repartitionById(max(1, ranges), "part").sortWithinPartitions(
        "part", "after", F.col("key").asc_nulls_first(), "tie"
    )
    found = in_batches(ordered, _walk, f"key long, {RESULT}")
    return found.withColumnRenamed("key", key)


def _dealt_by_range(keyed: DataFrame) -> tuple[DataFrame, int]:
    """(part, after, key, tie, packed): documents by range of (key, tie), each range closed by ``after``; and
    the number of ranges."""
    spark = keyed.sparkSession
    first = (
        keyed.select("key", "tie")
        .repartitionByRange(shuffle_partitions(spark), F.col("key").asc_nulls_first(), "tie")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min(F.struct(F.col("key").isNotNull().cast("int").alias("known"), "key", "tie")).alias("first"))
        .select("first.*")
        .collect()  # one row per range
    )
    begins = sorted((r["known"], r["key"] or 0, r["tie"]) for r in first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            rows = {n: [] for n in ("part", "after", "key", "tie", "packed")}
            for key, text, tie in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                place = (int(key is not None), key or 0, tie)
                part = bisect_right(begins, place) - 1
                packed = pack(text.encode("utf-8", "surrogatepass"))
                targets = [(part, False)]
                if place == begins[part]:
                    targets.append(((part - 1) % len(begins), True))
                for to, after in targets:
                    for n, v in zip(rows, (to, after, key, tie, packed), strict=True):
                        rows[n].append(v)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["part"], pa.int32()),
                    pa.array(rows["after"], pa.bool_()),
                    pa.array(rows["key"], pa.int64()),
                    pa.array(rows["tie"], pa.int64()),
                    pa.array(rows["packed"], pa.binary()),
                ],
                list(rows),
            )

    dealt = in_batches(
        keyed.select("key", "text", "tie"),
        run,
        "part int, after boolean, key long, tie long, packed binary",
    )
    return dealt, len(begins)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each document with the one that follows in its part."""
    unpack = zstandard.ZstdDecompressor().decompress
    names = ["key", *(c.split()[0] for c in RESULT.split(", "))]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    own: Document | None = None
    own_part = own_key = None
    out: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        parts, afters, keys = (batch.column(i).to_pylist() for i in range(3))
        for part, after, key, octets in zip(parts, afters, keys, batch.column(4), strict=True):
            if after and own is None:
                continue  # copies of the closing document
            document = Document(unpack(octets.as_py()).decode("utf-8", "surrogatepass"))
            if own is not None and own_part == part:
                out.append((own_key, *compare(own, document)))
            own, own_part, own_key = (None, None, None) if after else (document, part, key)
            if len(out) >= ROWS_AT_ONCE:
                yield packed()
                out.clear()
    yield packed()

