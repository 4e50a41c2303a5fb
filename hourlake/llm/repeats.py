"""Removal of long repeats: every byte that a string of ``LENGTH`` bytes covers which starts twice.

Windows of ``LENGTH`` bytes are far too many to compare. Each has one minimizer: of its substrings of
``ANCHOR`` bytes the first with the least hash. Equal windows have equal minimizers, so only stretches
around equal minimizers are compared:

1. A stretch is the longest run of windows with the same minimizer in the same place. One pass counts
   stretches by minimizer, and the least and the greatest hash of their contents; all of it is combined
   before the shuffle. Minimizers that occur once are done.
2. A second pass joins the stretches to these minimizers. Where all contents are equal, all windows are
   repeated: copies end here, however many there are.
3. The others are reduced to their distinct contents. What is there more than once is repeated as a whole;
   contents that are there once are fetched, with what they are to be compared to, and dealt out by
   minimizer. Each task builds a run-length index of its strings and streams their matching statistics
   (see ``run_index``); matches of LENGTH bytes mark windows. (A stretch has no window twice, so a match
   is with another one.)
4. A minimizer with more than ``CONTENTS`` distinct contents is split. A window reaches so many bytes to the left
   of its minimizer; windows that reach from ``low`` to ``low + width`` bytes share ``low`` bytes there and the rest,
   less the width, to the right. So stretches are cut for a few such ranges, dealt out by the bytes that their
   windows must share, and indexed as before; what is still too much is split into narrower ranges. Where only
   one reach is left, all members of a group have the same window, and it is repeated.
5. Marked windows are brought to their texts by a join, merged, and cut out.

Intervals carry the hash of the content they were found in, so that a clash of the 64-bit document hash,
by which they are joined, cannot mark another text.

Defined cases: a null text is empty; a text shorter than LENGTH has no windows; equal rows are repeats of
each other; spans may begin and end within a character, so what is kept is bytes; an empty table gives no
rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import in_batches, ship, stored
from hourlake.llm.run_index import repeated_windows

LENGTH, ANCHOR = 200, 41
#: Anchors in a window; a stretch has at most so many windows.
PLACES = LENGTH - ANCHOR + 1
#: Distinct contents that are indexed as one group, and bytes of a task's strings.
CONTENTS, BUCKET_BYTES = 2_048, 1 << 21
#: Widths of the ranges of reaches that larger groups are split into, one after the other.
WIDTHS = (80, 20, 5, 1)

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2**64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        out.append(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, dtype=np.uint64))]))
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Hashed:
    """Prefix sums of a text's bytes, which give the hash of any span."""

    def __init__(self, text: bytes, base: int = _BASES[0]):
        octets = np.frombuffer(text, dtype=np.uint8)
        size = 1 << max(16, len(octets).bit_length())
        self.up, self.down = _powers(base, size)
        self.sums = np.zeros(len(octets) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[octets] * self.up[: len(octets)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:-size]) * self.down[:n])


def stretches(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, place of the minimizer, its hash, hash of the content."""
    if len(text) < LENGTH:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashed = Hashed(text)
    anchors = hashed.all(ANCHOR)
    # hash and place in one number: the least is the first of the least
    least = (anchors & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(anchors), dtype=np.uint64)
    width = 1
    while width < PLACES:
        step = min(width, PLACES - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    count = np.diff(np.append(first, len(place)))
    own = place[first]
    return first, count, own, anchors[own], hashed.spans(first, first + count - 1 + LENGTH)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _count_minimizers(source: DataFrame) -> DataFrame:
    """(minimizer, mixed): those that occur more than once; mixed if their contents differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [stretches(t.as_py().encode("utf-8", "surrogatepass"))[3:] for t in batch.column(0)]
            if found:
                columns = [_signed(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["minimizer", "content"])

    rows = in_batches(source.select("text"), run, "minimizer long, content long")
    counted = rows.groupBy("minimizer").agg(
        F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most")
    )
    return counted.where("n > 1").select("minimizer", (F.col("least") != F.col("most")).alias("mixed"))


def _all_stretches(source: DataFrame) -> DataFrame:
    """(doc, where, minimizer, content); for ``where`` see ``_place``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                first, count, own, minimizer, content = stretches(text.as_py().encode("utf-8", "surrogatepass"))
                where = first << 16 | (own - first) << 8 | (count - 1)
                for column, values in zip(
                    out, (np.full(len(first), doc), where, minimizer, content), strict=True
                ):
                    column.append(values)
            if out[0]:
                columns = [_signed(np.concatenate(c)) for c in out]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "where", "minimizer", "content"])

    return in_batches(source.select("doc", "text"), run, "doc long, where long, minimizer long, content long")


def _packed(source: DataFrame, names: list[str]) -> DataFrame:
    """``names`` of ``source`` with the compressed bytes of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            octets = [pack(t.as_py().encode("utf-8", "surrogatepass")) for t in texts]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(octets, pa.binary())], [*names, "packed"])

    frame = source.select(*names, "text")
    schema = source.select(*names).withColumn("packed", F.lit(b"")).schema
    return in_batches(frame, run, schema)


def _place(where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches begin and end. ``where`` has the first window, then in eight bits each the
    minimizer's place from there and the number of windows less one."""
    first = where >> 16
    return first, first + (where & 255) + LENGTH


def _minimizer_at(where: int) -> int:
    return where >> 8 & 255


def _same_content(hashed: Hashed, where: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Whether the text has these contents there."""
    first, end = _place(where)
    inside = end < len(hashed.sums)
    same = np.zeros(len(where), dtype=bool)
    same[inside] = hashed.spans(first[inside], end[inside]).view(np.int64) == content[inside]
    return same


STRING = "minimizer long, content long, doc long, where long, lone boolean, at int, string binary"


def _fetched(source: DataFrame, contents: DataFrame) -> DataFrame:
    """The strings of ``contents`` (minimizer, content, doc, where, lone), cut out of their documents."""
    wanted = contents.groupBy("doc").agg(
        F.collect_list(F.struct("minimizer", "content", "where", "lone")).alias("wanted")
    )
    joined = _packed(source, ["doc"]).join(wanted, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = [c.split()[0] for c in STRING.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.bool_(), pa.int32(), pa.binary()]
        for batch in batches:
            rows = []
            for doc, octets, listed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text = unpack(octets)
                wheres, own = (np.array([w[n] for w in listed], dtype=np.int64) for n in ("where", "content"))
                begins, ends = _place(wheres)
                for i in np.flatnonzero(_same_content(Hashed(text), wheres, own)):
                    w, string = listed[i], text[begins[i] : ends[i]]
                    at = _minimizer_at(w["where"])
                    rows.append((w["minimizer"], w["content"], doc, w["where"], w["lone"], at, string))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    # two documents of one hash may both have been asked for the same content
    return in_batches(joined.select("doc", "packed", "wanted"), run, STRING).dropDuplicates(["minimizer", "content"])


def comparable(strings: list[bytes], groups: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Indices of the strings that can have a window with another of their group.

    A window reaches half of the bytes around its minimizer to the left or to the right of it; so it
    lies in strings that agree there.
    """
    half = (LENGTH - ANCHOR + 1) // 2
    keys: dict[tuple, list[int]] = {}
    for i, (string, group, at) in enumerate(zip(strings, groups.tolist(), places.tolist(), strict=True)):
        if at >= half:
            keys.setdefault((group, 0, string[at - half : at + ANCHOR]), []).append(i)
        if at + ANCHOR + half <= len(string):
            keys.setdefault((group, 1, string[at : at + ANCHOR + half]), []).append(i)
    return np.array(sorted({i for found in keys.values() if len(found) > 1 for i in found}), dtype=np.int64)


FOUND = "doc long, where long, content long, begin int, past int"


def _found_rows(docs, wheres, contents, skips, windows) -> pa.Table:
    """Runs of repeated windows of each string: from ``begin`` up to ``past``, counted in its stretch."""
    rows = []
    for doc, where, content, skip, found in zip(docs, wheres, contents, skips, windows, strict=True):
        if len(found):
            cuts = np.flatnonzero(np.diff(found) != 1) + 1
            for part in np.split(found, cuts):
                rows.append((doc, where, content, skip + int(part[0]), skip + int(part[-1]) + 1))
    kinds = [pa.int64()] * 3 + [pa.int32()] * 2
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    names = [c.split()[0] for c in FOUND.split(", ")]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def _by_index(strings: DataFrame, buckets: int) -> DataFrame:
    """Repeated windows of lone strings, by a run-length index in each bucket of groups."""

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by([("group", "ascending"), ("content", "ascending"), ("doc", "ascending")])
        texts = table.column("string").to_pylist()
        groups, places = (table.column(n).to_numpy() for n in ("group", "at"))
        kept = comparable(texts, groups, places)
        lone = table.column("lone").to_numpy(zero_copy_only=False)[kept].astype(bool)
        windows = repeated_windows([texts[i] for i in kept], lone, LENGTH)
        wanted = kept[lone]
        columns = [table.column(n).to_numpy()[wanted].tolist() for n in ("doc", "where", "content", "skip")]
        return _found_rows(*columns, windows)

    ship(strings.sparkSession.sparkContext)
    dealt = strings.withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(search, FOUND)


PART = "group long, content long, doc long, where long, lone boolean, at int, skip int, low int, wide int, string binary"


def _split(strings: DataFrame, width: int) -> DataFrame:
    """Stretches cut for the windows of each range of reaches; grouped by the bytes that these must share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PART.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.bool_()] + [pa.int32()] * 4 + [pa.binary()]
        for batch in batches:
            rows = []
            for group, content, doc, where, lone, at, skip, low, wide, string in zip(
                *(batch.column(n).to_pylist() for n in names), strict=True
            ):
                for first in range(low, low + wide, width):
                    most = min(first + width - 1, at, low + wide - 1)
                    least = max(first, at + LENGTH - len(string))
                    if least > most:
                        continue  # no window reaches that far
                    shared = string[at - first : at + ANCHOR + PLACES - first - width]
                    key = hashlib.blake2b(shared, digest_size=8, key=f"{group} {first}".encode()).digest()
                    start = at - most
                    part = (int.from_bytes(key, "little", signed=True), content, doc, where, lone, most, skip + start)
                    rows.append((*part, first, width, string[start : at - least + LENGTH]))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return in_batches(strings.select(*[c.split()[0] for c in PART.split(", ")]), run, PART)


def _sizes(strings: DataFrame, group: str) -> DataFrame:
    """Groups of several strings, and how many."""
    return strings.groupBy(F.col(group).alias("group")).agg(F.count("*").alias("members")).where("members > 1")


def repeated_intervals(source: DataFrame, contents_at_once: int = CONTENTS) -> DataFrame:
    """(doc, where, content, begin, past): windows that start elsewhere, too. ``source``: doc, text."""
    minimizers = stored(_count_minimizers(source), "minimizers")
    rows = stored(_all_stretches(source).join(minimizers, "minimizer"), "stretches")
    count = (F.col("where").bitwiseAND(F.lit(255)) + 1).cast("int")
    whole = [F.lit(0).alias("begin"), count.alias("past")]
    equal = rows.where("not mixed").select("doc", "where", "content", *whole)
    mixed = rows.where("mixed")
    contents = stored(
        mixed.groupBy("minimizer", "content")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc", "where")).alias("one"))
        .select("minimizer", "content", "one.doc", "one.where", (F.col("n") == 1).alias("lone")),
        "contents",
    )
    copied = mixed.join(contents.where("not lone").select("minimizer", "content"), ["minimizer", "content"])
    # stored on its own: a content that is everywhere is then dealt out anew by adaptive execution
    copied = stored(copied.select("doc", "where", "content", *whole), "copied")
    found = equal.unionByName(copied)
    strings = _fetched(source, contents).withColumnRenamed("minimizer", "group")
    reaches = {"skip": F.lit(0), "low": F.lit(0), "wide": F.lit(PLACES)}
    # sizes from the contents, so that the strings are cut out once
    strings = stored(strings.withColumns(reaches).join(_sizes(contents, "minimizer"), "group"), "strings")
    for width in (*WIDTHS, None):
        indexed = strings.where(F.col("members") <= contents_at_once)
        size = indexed.agg(F.sum(F.octet_length("string"))).first()[0] or 0
        if size:
            found = found.unionByName(_by_index(indexed, max(1, -(-size // BUCKET_BYTES))))
        rest = strings.where(F.col("members") > contents_at_once)
        if rest.isEmpty():
            break
        if width is None:
            # one reach: the members have one and the same window
            same = rest.where("lone").select("doc", "where", "content", F.col("skip").alias("begin"))
            found = found.unionByName(same.withColumn("past", F.col("begin") + 1))
        else:
            parts = stored(_split(rest, width), "parts")
            strings = stored(parts.join(_sizes(parts, "group"), "group"), "strings")
    return found


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its key, n_bytes, ``spans`` that are removed (byte offsets), ``kept`` bytes."""
    source = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit(""))).alias("doc"),
    )
    found = repeated_intervals(source.select("doc", "text"))
    by_doc = found.groupBy("doc").agg(
        F.collect_list(F.struct("where", "content", "begin", "past")).alias("found")
    )
    joined = _packed(source, ["key", "doc"]).join(by_doc, "doc", "left").select("key", "packed", "found")
    spans = "array<struct<start:bigint,end:bigint>>"
    shape = {"n_bytes": F.lit(0).cast("long"), "spans": F.array().cast(spans), "kept": F.lit(b"")}
    schema = source.select("key").withColumns(shape).schema
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, all_spans, kept = [], [], []
            for octets, listed in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                body = unpack(octets)
                merged = removed_spans(body, listed) if listed.is_valid else []
                sizes.append(len(body))
                all_spans.append([{"start": a, "end": b} for a, b in merged])
                kept.append(_without(body, merged))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(all_spans, kind), pa.array(kept, pa.binary())],
                ["key", "n_bytes", "spans", "kept"],
            )

    return in_batches(joined, run, schema).withColumnRenamed("key", key)


def removed_spans(body: bytes, listed) -> list[tuple[int, int]]:
    """Maximal spans that the windows of the intervals found in this very text cover."""
    where, content, begin, past = (listed.values.field(i).to_numpy() for i in range(4))
    own = _same_content(Hashed(body), where, content)
    first = where[own] >> 16
    start, stop = first + begin[own], first + past[own] - 1 + LENGTH
    if not len(start):
        return []
    order = start.argsort(kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    heads = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
    return list(zip(start[heads].tolist(), stop[np.append(heads[1:] - 1, len(stop) - 1)].tolist(), strict=True))


def _without(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(body)]
    return b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def repeat_digest(docs: DataFrame) -> DataFrame:
    found = find_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
