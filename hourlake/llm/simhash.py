"""SimHash near-duplicates with a hierarchical index in Gray order.

1. Fingerprints are made where the texts are (Arrow batches), from XXH64 of word shingles.
2. Distinct fingerprints are sorted by Gray rank over the cluster and cut into pages. Neighbours in
   Gray order share many bits, so a page is described by the bits that all its members share.
   Upper nodes describe runs of pages in the same way; each node keeps only the bits that its parent
   does not have, and differences add up on the way down. There are at most ``MOST_PAGES`` pages, so
   the upper nodes have a fixed size bound; pages grow instead.
3. Each fingerprint goes down the upper nodes and is sent to the pages that stay within the distance;
   whole groups are pruned. Pages with many visitors are dealt out over several tasks.
4. In a page, the same search goes on below the upper nodes. A task returns, in place of all pairs,
   a spanning star for each set of fingerprints that it has linked: no link is lost, and the result
   is no larger than what went in.
5. The stars are joined to components by alternating large-star and small-star steps, each written
   to the shared folder.

Defined cases: a null text, and one without words, has fingerprint zero, linked like any other;
fewer words than a shingle has make one shingle; equal fingerprints are one index entry, whatever
the number of their documents; a null id is never the smallest one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import free_name, in_batches, row_mark, ship, stored

SHINGLE, SEED, DISTANCE = 3, 42, 2

PAGE, MOST_PAGES, FAN_OUT = 1024, 65_536, 16
#: Fingerprints that visit a page, in one task; and how many go down the nodes at a time.
VISITORS, STEP = 65_536, 4_096
#: Shingles whose bits are counted at a time.
SHINGLES_AT_ONCE = 65_536

_LOWERED = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each the majority of that bit over all shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWERED).split()
    if not words:
        return 0
    joined = b" ".join(words)
    past = list(accumulate(len(w) + 1 for w in words))  # where the next word starts
    starts = [0, *past]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, SHINGLES_AT_ONCE):
        upto = min(n, i + SHINGLES_AT_ONCE)
        ends = past[i + shingle - 1 : upto + shingle - 1] if len(words) >= shingle else past[-1:]
        hashes = [digest(joined[a : b - 1], seed) for a, b in zip(starts[i:upto], ends, strict=True)]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(counts * 2 > n).tolist()))


def fingerprints(docs: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (few columns) with the text replaced by ``code``, the fingerprint as a long."""
    kept = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            codes = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes.view(np.int64))], [*names, "code"])

    schema = docs.drop(text).schema.add("code", "long")
    return in_batches(docs, run, schema)


def gray_order(code: Column) -> Column:
    """Sorts as the unsigned rank of ``code`` in Gray order does: its bits' prefix sums."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def gray_pages(codes: DataFrame, size: int) -> DataFrame:
    """(page, code): runs of ``size`` codes in Gray order; page numbers rise with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            n = batch.num_rows
            pages = first + (seen + np.arange(n, dtype=np.int64)) // size
            seen += n
            yield pa.RecordBatch.from_arrays([pa.array(pages), batch.column(0)], ["page", "code"])

    ordered = codes.select("code", gray_order(F.col("code")).alias("rank"))
    ordered = ordered.repartitionByRange("rank").sortWithinPartitions("rank").select("code")
    return in_batches(ordered, run, "page long, code long")


class Nodes:
    """Levels of nodes over codes in Gray order, top first: pattern, own bits, first child."""

    def __init__(self, ones: np.ndarray, zeros: np.ndarray, fan_out: int = FAN_OUT):
        """``ones``: bits set in all members of a lowest node; ``zeros``: bits set in any."""
        levels = [(ones.astype(np.uint64), zeros.astype(np.uint64))]
        while len(levels[-1][0]) > fan_out:
            cuts = np.arange(0, len(levels[-1][0]), fan_out)
            levels.append(
                (np.bitwise_and.reduceat(levels[-1][0], cuts), np.bitwise_or.reduceat(levels[-1][1], cuts))
            )
        self.fan_out, self.levels, above = fan_out, [], None
        for ones_, any_ in reversed(levels):
            shared = ~(ones_ ^ any_)
            own = shared if above is None else shared & ~np.repeat(above, fan_out)[: len(shared)]
            self.levels.append((ones_, own))
            above = shared

    def search(self, codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices (query, lowest node) whose differences in shared bits stay within ``distance``."""
        top = len(self.levels[0][0])
        query = np.repeat(np.arange(len(codes)), top)
        node = np.tile(np.arange(top), len(codes))
        apart = np.zeros(len(query), dtype=np.uint8)
        for depth, (pattern, own) in enumerate(self.levels):
            if depth:
                size = len(pattern)
                query, apart = np.repeat(query, self.fan_out), np.repeat(apart, self.fan_out)
                node = (node[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
                if (inside := node < size).sum() < len(node):
                    query, apart, node = query[inside], apart[inside], node[inside]
            apart = apart + np.bitwise_count((codes[query] ^ pattern[node]) & own[node])
            near = apart <= distance
            query, node, apart = query[near], node[near], apart[near]
        return query, node


def _unsigned(values) -> np.ndarray:
    return np.asarray(values, dtype=np.int64).view(np.uint64)


def routed(pages: DataFrame, distance: int) -> DataFrame:
    """(page, code): each code with its own page and later ones that it may have a link to."""
    upper = (
        pages.groupBy("page")
        .agg(F.bit_and("code").alias("ones"), F.bit_or("code").alias("any"))
        .orderBy("page")
        .collect()  # at most MOST_PAGES and one per partition
    )
    spark = pages.sparkSession
    index = spark.sparkContext.broadcast(
        (
            np.array([r["page"] for r in upper], dtype=np.int64),
            Nodes(_unsigned([r["ones"] for r in upper]), _unsigned([r["any"] for r in upper])) if upper else None,
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, nodes = index.value
        for batch in batches:
            own, codes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in range(0, len(codes), STEP):
                query, node = nodes.search(_unsigned(codes[i : i + STEP]), distance)
                to = numbers[node]
                later = to >= own[i : i + STEP][query]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[later]), pa.array(codes[i : i + STEP][query[later]])], ["page", "code"]
                )

    return in_batches(pages.select("page", "code"), run, "page long, code long")


def stars(codes: np.ndarray, a: np.ndarray, b: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """``roots`` (index of each code's set) after joining the sets of a[i] and b[i]."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return roots
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while (roots[roots] != roots).any():
            roots = roots[roots]


def linked_in_page(visitors: np.ndarray, members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, root): a star over each set of visitors and members that links join."""
    codes = np.unique(np.concatenate([visitors, members]))
    order = gray_rank(members).argsort()
    members = members[order]
    nodes = Nodes(members, members)
    roots = np.arange(len(codes))
    at_member = np.searchsorted(codes, members)
    for i in range(0, len(visitors), STEP):
        part = visitors[i : i + STEP]
        query, node = nodes.search(part, distance)
        a, b = np.searchsorted(codes, part)[query], at_member[node]
        own = a != b
        roots = stars(codes, a[own], b[own], roots)
    moved = np.flatnonzero(roots != np.arange(len(codes)))
    return codes[moved], codes[roots[moved]]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def links(codes: DataFrame, distance: int = DISTANCE, page: int = PAGE) -> DataFrame:
    """Edges (a, b), a > b, that join the distinct codes as links of ``distance`` bits do."""
    codes = codes.select("code")
    size = max(page, -(-codes.count() // MOST_PAGES))
    pages = stored(gray_pages(codes, size), "gray-pages")
    visits = stored(routed(pages, distance), "visits")
    shares = visits.groupBy("page").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("shares"))
    # at most MOST_PAGES rows and one per partition
    few = F.broadcast(shares)
    visitors = visits.join(few, "page").select(
        "page", F.pmod(F.xxhash64("code"), F.col("shares")).cast("int").alias("share"), "code"
    )
    members = pages.join(few, "page").select(
        "page", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "code"
    )

    def search(own: pa.Table, other: pa.Table) -> pa.Table:
        a, b = linked_in_page(
            _unsigned(own.column("code").to_numpy()), _unsigned(other.column("code").to_numpy()), distance
        )
        # signed, so that a > b holds as Spark compares
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    ship(codes.sparkSession.sparkContext)
    found = (
        visitors.groupBy("page", "share")
        .cogroup(members.groupBy("page", "share"))
        .applyInArrow(search, "a long, b long")
    )
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(code, root): the least code of each component, for the codes that have an edge.

    Alternates between steps that hang larger neighbours and smaller neighbours of each node on the
    node's least neighbour, until nothing changes; then all edges lead to the roots.
    """
    edges = stored(edges, "links")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("a").alias("code"), F.col("b").alias("root"))
        before = state


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row per document: its key, ``code`` and ``component_id``, the component's least key."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return grouped(stored(fingerprints(source, "text", shingle), "fingerprints"), distance).select(
        F.col("key").alias(key), "code", "component_id"
    )


def grouped(rows: DataFrame, distance: int) -> DataFrame:
    """``rows`` (key, code and others) with ``component_id``."""
    codes = stored(rows.groupBy("code").agg(F.min("key").alias("least")), "codes")
    roots = components(links(codes, distance))
    rooted = codes.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(ids, "root").select("code", "component_id"), "code")


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``docs`` with one document of each group: the one of the least id, then of the least text hash.

    Nulls come last. Of rows that are equal in id and text, one stays.
    """
    mark = free_name(docs, "mark")
    marked = docs.withColumn(mark, row_mark(key, text))
    source = marked.select(F.col(key).alias("key"), F.col(mark).alias("mark"), F.col(text).alias("text"))
    rows = stored(fingerprints(source, "text", shingle), "fingerprints")
    groups = grouped_by_root(rows, distance)
    first = groups.groupBy("root").agg(
        F.min(F.struct(F.col("key").isNull().alias("last"), "key", "mark")).alias("first")
    )
    kept = marked.join(first.select(F.col("first.mark").alias(mark)), mark, "left_semi")
    if rows.groupBy("mark").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates([mark])
    return kept.select(*docs.columns)


def grouped_by_root(rows: DataFrame, distance: int) -> DataFrame:
    """``rows`` with ``root``, which is the same for all rows of a group."""
    roots = components(links(rows.select("code").distinct(), distance))
    return rows.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
