"""Vector code compression: vectors as one codebook index a part, found by slices and bitmasks.

Components become integers, vectors are cut into equal parts, and each part position has a codebook. A round
assigns every part to its nearest entry (see ``slice_index``) and replaces entries by the floored means of
their parts. Tasks add up their parts by entry before anything is shuffled, so a round moves one row per
task, part and entry, whatever vectors repeat; a codebook (parts x entries x dimensions of integers) is all
that is ever on the driver. All arithmetic is on integers: no order of rows changes a code.

Defined cases: a vector that is null, or has a null or non-finite component, gives no row. The width is that
of the first kept vector (least id, then least components), filled up with zeros to equal parts; vectors of
another length give no row. Integers are held to 2^62 in size, sums of errors to the range of a long. A null
id comes after all others. With fewer kept vectors than entries, there are as many entries as vectors. Repeated
rows and ids count each; null labels are one label; an empty table gives an empty result; further columns are
kept by ``encode_vectors``, and result columns avoid their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.common import free_name, in_batches, stored
from hourlake.llm.slice_index import EXACT, EXACT_WIDTH, SliceIndex, nearest_of_large
from hourlake.session import shuffle_partitions

#: Parts of a vector, entries of a codebook, rounds, and the factor that makes components integers.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integers are held to this size.
LARGEST = 1 << 62
LONGEST = (1 << 63) - 1
#: Totals by label are broadcast up to so many labels of so many bytes together.
BROADCAST_LABELS, BROADCAST_BYTES = 100_000, 8 << 20

Codebooks = list[list[list[int]]]


def as_integers(vector: Column) -> Column:
    """``floor(SCALE * x)`` of each component."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))))
    # a floor beyond the range of a long is held at its end
    return F.transform(scaled, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x)))


def kept_vectors(frame: DataFrame, vector: str, key: str, name: str) -> tuple[DataFrame, list[list[int]]]:
    """Rows whose vector counts, with it as integers ``name``; and the first vectors, of equal length."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)),
    )
    whole = frame.where(F.coalesce(finite, F.lit(False))).withColumn(name, as_integers(F.col(vector)))
    order = [F.col(key).asc_nulls_last(), F.col(name)]
    first = whole.select(key, name).orderBy(*order).limit(1).collect()
    if not first:
        return whole, []
    length = len(first[0][name])
    whole = whole.where(F.size(name) == length)
    if length % PARTS:
        zeros = F.array_repeat(F.lit(0).cast("long"), PARTS - length % PARTS)
        whole = whole.withColumn(name, F.concat(name, zeros))
    return whole, [list(r[name]) for r in whole.select(key, name).orderBy(*order).limit(ENTRIES).collect()]


def first_codebooks(vectors: list[list[int]], parts: int = PARTS) -> Codebooks:
    """The parts of some vectors."""
    width = len(vectors[0]) // parts
    return [[v[p * width : (p + 1) * width] for v in vectors] for p in range(parts)]


def _rows_of(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(rows, -1)


class Assigner:
    """Nearest entries of all parts of a batch of vectors."""

    def __init__(self, codebooks: Codebooks):
        self.codebooks = codebooks
        self.width = len(codebooks[0][0])
        sizes = [abs(x) for book in codebooks for entry in book for x in entry]
        self.small = self.width <= EXACT_WIDTH and max(sizes, default=0) <= EXACT
        if self.small:
            self.indexes = [SliceIndex(np.array(book, dtype=np.int64)) for book in codebooks]

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Codes (rows x parts), and the squared distances of each part."""
        codes = np.zeros((len(vectors), len(self.codebooks)), dtype=np.int64)
        errors = []
        small = np.full(len(vectors), self.small)
        if self.small and vectors.size:
            small &= (vectors <= EXACT).all(axis=1) & (vectors >= -EXACT).all(axis=1)
        for p, book in enumerate(self.codebooks):
            points = vectors[:, p * self.width : (p + 1) * self.width]
            error = np.zeros(len(vectors), dtype=object)
            if small.any():
                codes[small, p], error[small] = self.indexes[p].nearest(points[small])
            if not small.all():
                codes[~small, p], error[~small] = nearest_of_large(points[~small].tolist(), book)
            errors.append(error if not small.all() else error.astype(np.int64))
        return codes, errors


def _totals(sums: np.ndarray, at: np.ndarray, points: np.ndarray, largest: int) -> None:
    """Adds points to the sums of their entries; ``sums`` has Python integers."""
    entries, places = np.unique(at, return_inverse=True)
    if largest < 1 << 31:  # so many rows cannot leave 64 bits
        part = np.zeros((len(entries), points.shape[1]), dtype=np.int64)
        np.add.at(part, places, points)
        sums[entries] += part.astype(object)
    else:
        np.add.at(sums, at, points.astype(object))


def learn_round(whole: DataFrame, name: str, codebooks: Codebooks) -> Codebooks:
    """Each entry replaced by the floored mean of the parts that it is nearest to."""
    width = len(codebooks[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assigner(codebooks)
        shape = (len(codebooks), len(codebooks[0]))
        sums, counts = np.zeros((*shape, width), dtype=object), np.zeros(shape, dtype=np.int64)
        for batch in batches:
            vectors = _rows_of(batch.column(0), batch.num_rows)
            codes, _ = assign(vectors)
            largest = int(np.abs(vectors).max()) if vectors.size else 0
            for p in range(shape[0]):
                _totals(sums[p], codes[:, p], vectors[:, p * width : (p + 1) * width], largest)
                counts[p] += np.bincount(codes[:, p], minlength=shape[1])
        parts, entries = np.nonzero(counts)
        flat = [int(x) for x in sums[parts, entries].ravel()]
        places = pa.array(np.arange(len(parts) + 1) * width, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(parts, pa.int32()),
                pa.array(entries, pa.int32()),
                pa.array(counts[parts, entries], pa.int64()),
                pa.ListArray.from_arrays(places, pa.array(flat, pa.decimal128(38, 0))),
            ],
            ["part", "entry", "n", "sums"],
        )

    found = in_batches(whole.select(name), run, "part int, entry int, n long, sums array<decimal(38,0)>")
    columns = [F.sum(F.get("sums", F.lit(d))).alias(f"sum_{d}") for d in range(width)]
    rows = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *columns).collect()
    new = [[list(entry) for entry in book] for book in codebooks]
    for r in rows:
        new[r["part"]][r["entry"]] = [int(r[f"sum_{d}"]) // r["n"] for d in range(width)]
    return new


def learn_codebooks(whole: DataFrame, name: str, first: list[list[int]], rounds: int = ROUNDS) -> Codebooks:
    codebooks = first_codebooks(first)
    for _ in range(rounds):
        codebooks = learn_round(whole, name, codebooks)
    return codebooks


def assign_codes(whole: DataFrame, name: str, codebooks: Codebooks, code: str, error: str) -> DataFrame:
    """``whole`` without ``name``, with the code as hexadecimal text and the squared distance of all parts."""
    kept = [f for f in whole.schema.fields if f.name != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assigner(codebooks)
        for batch in batches:
            codes, errors = assign(_rows_of(batch.column(name), batch.num_rows))
            digits = codes.astype(np.uint8).tobytes().hex()
            size = 2 * codes.shape[1]
            texts = [digits[i : i + size] for i in range(0, len(digits), size)]
            totals = [min(LONGEST, sum(int(e) for e in row)) for row in zip(*errors, strict=True)]
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(texts, pa.string()), pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), code, error])

    added = [T.StructField(code, T.StringType()), T.StructField(error, T.LongType())]
    return in_batches(whole, run, T.StructType([*kept, *added]))


def codebooks_digest(codebooks: Codebooks) -> str:
    numbers = (str(x) for book in codebooks for entry in book for x in entry)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def with_label_totals(coded: DataFrame, label: str, error: str, total: str) -> DataFrame:
    """Adds each row's sum of errors over equal labels; ``coded`` should be stored.

    The totals, one row a label, are broadcast if they are small. If not, the rows of a label are dealt to as
    many places as there are shuffle partitions, by a hash of the row, and its total to all of them.
    """
    limited = F.least(F.sum(F.col(error).cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)"))
    totals = stored(coded.groupBy(F.col(label).alias("_of")).agg(limited.cast("long").alias(total)), "labels")
    size = totals.agg(F.count("*"), F.sum(F.coalesce(F.octet_length(F.col("_of").cast("string")), F.lit(0)))).first()
    columns = [*coded.columns, total]
    if size[0] <= BROADCAST_LABELS and (size[1] or 0) <= BROADCAST_BYTES:
        return coded.join(F.broadcast(totals), F.col(label).eqNullSafe(F.col("_of"))).select(*columns)
    places = shuffle_partitions(coded.sparkSession)
    spread = coded.withColumn("_at", F.pmod(F.xxhash64(*coded.columns), F.lit(places)).cast("int"))
    copies = totals.withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(places - 1))))
    same = F.col(label).eqNullSafe(F.col("_of")) & (F.col("_at") == F.col("_place"))
    return spread.join(copies, same).select(*columns)


def encode_vectors(
    frame: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str | None = "label",
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Rows whose vector counts, with ``code``, ``error`` and ``label_error``; and the codebooks."""
    names = {n: free_name(frame, n) for n in ("integers", "code", "error", "label_error")}
    whole, first = kept_vectors(frame, vector, key, names["integers"])
    if not first:
        empty = whole.drop(names["integers"]).limit(0)
        nothing = [F.lit(None).cast("string").alias(names["code"])]
        nothing += [F.lit(None).cast("long").alias(names[n]) for n in ("error", "label_error") if label or n == "error"]
        return empty.select("*", *nothing), []
    codebooks = learn_codebooks(whole, names["integers"], first, rounds)
    coded = assign_codes(whole, names["integers"], codebooks, names["code"], names["error"])
    if label is None:
        return coded, codebooks
    return with_label_totals(stored(coded, "codes"), label, names["error"], names["label_error"]), codebooks


def decode_vectors(coded: DataFrame, codebooks: Codebooks, code: str = "code") -> DataFrame:
    """``coded`` with ``decoded``: the entries that the codes name, as components."""
    name = free_name(coded, "decoded")
    books = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in book]) for book in codebooks])
    index = F.expr(f"transform(sequence(0, {len(codebooks) - 1}), p -> cast(conv(substr(`{code}`, 2 * p + 1, 2), 16, 10) as int))")
    parts = F.transform(index, lambda i, p: F.get(F.get(books, p), i))
    return coded.withColumn(name, F.transform(F.flatten(parts), lambda x: x / F.lit(float(SCALE))))


def code_digest(frame: DataFrame) -> DataFrame:
    coded, codebooks = encode_vectors(frame.select("vec_id", "embedding", "label"))
    return coded.select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
    )


def _round_sql(step: int) -> str:
    """SQL of one assignment to the codebooks ``book{step}``."""
    return f"""near{step} as (
  select p.part, p.row, p.x, arg_min(b.entry, struct_pack(d := d2(p.x, b.x), e := b.entry)) as entry, min(d2(p.x, b.x)) as error
  from pieces p join book{step} b using (part) group by all)"""


def _book_sql(step: int) -> str:
    return f"""mean{step} as (
  select part, entry, list(cast((s - ((s % n) + n) % n) // n as bigint) order by d) as x from (
    select part, entry, d, sum(v) as s, count(*) as n from (
      select part, entry, unnest(x) as v, unnest(range(len(x))) as d from near{step - 1}) group by part, entry, d)
  group by part, entry),
book{step} as (select b.part, b.entry, coalesce(m.x, b.x) as x from book{step - 1} b left join mean{step} m using (part, entry))"""


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the digest, for vectors of one length that the parts divide."""
    distance = "list_sum(list_transform(list_zip(a, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for step in range(1, rounds + 1):
        steps += [_round_sql(step - 1), _book_sql(step)]
    chosen = ",\n".join([*steps, _round_sql(rounds)]).replace("d2(p.x, b.x)", distance.replace("(a, b)", "(p.x, b.x)"))
    return f"""with kept as (
  select row_number() over (order by vec_id nulls last, embedding) - 1 as row, vec_id, label,
    [cast(floor({SCALE} * cast(v as double)) as bigint) for v in embedding] as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
pieces as (
  select row, part, x[part * len(x) // {parts} + 1 : (part + 1) * len(x) // {parts}] as x
  from kept, (select unnest(range({parts})) as part)),
book0 as (select part, row as entry, x from pieces where row < {entries}),
{chosen},
books as (
  select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) as codebooks_sha256 from book{rounds}),
coded as (
  select row, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' order by part) as code,
    cast(sum(error) as bigint) as error from near{rounds} group by row)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from kept join coded using (row), books"""


ORACLE = oracle()
