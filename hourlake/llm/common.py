"""What several operators of this subpackage share: words, stored steps, free names."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.session import fresh_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Everything but ASCII control characters, blanks, punctuation and capitals.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before capitals are lowered.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lowered, other letters as they are. ``lower`` does that for pure ASCII, and faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Lowered words of a text; a null has none."""
    found = F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


#: Places in a text or a list of words: from ``start`` up to ``past``.
SPAN = "array<struct<start:int,past:int>>"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def scan_before(array: str, start: str, fold: Callable[[str, str], str]) -> str:
    """What the elements before each one fold to, from ``start``.

    A list grows by copying, so it is grown in blocks of about the square root of the array's size.
    """

    def along(values: str, at: str) -> str:
        nothing = f"named_struct('at', {at}, 'done', cast(array() as array<int>))"
        step = f"named_struct('at', {fold('a.at', 'x')}, 'done', concat(a.done, array(a.at)))"
        return f"aggregate({values}, {nothing}, (a, x) -> {step}, a -> a.done)"

    folded = f"transform(b, t -> aggregate(t, {start}, (a, x) -> {fold('a', 'x')}))"
    body = f"flatten(transform(b, (t, i) -> {along('t', 'o[i]')}))"
    body = let("o", along(folded, start), body)
    body = let("b", "transform(sequence(1, size(s), k), i -> slice(s, i, k))", body)
    body = let("k", "cast(ceil(sqrt(size(s))) as int)", body)
    return let("s", array, f"case when size(s) = 0 then cast(array() as array<int>) else {body} end")


def segments(spans: str, touching: bool) -> str:
    """Union of spans that are sorted by start: (start, past) of its parts; ``touching`` spans are one part."""
    apart = ">" if touching else ">="
    reach = scan_before(f"transform({spans}, x -> x.past)", "-1", lambda a, x: f"greatest({a}, {x})")
    heads = f"filter(sequence(0, size({spans}) - 1), i -> {spans}[i].start {apart} reach[i])"
    # up to the next head, spans reach no farther than that head sees
    rest = f"array_max(transform(slice({spans}, h + 1, size({spans})), x -> x.past))"
    past = f"case when i + 1 = size(heads) then {rest} else reach[heads[i + 1]] end"
    parts = f"transform(heads, (h, i) -> named_struct('start', {spans}[h].start, 'past', {past}))"
    body = let("reach", reach, let("heads", heads, parts))
    return f"case when size({spans}) = 0 then cast(array() as {SPAN}) else {body} end"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the cluster's shared folder and read again.

    Later steps then neither compute it twice nor depend on the executors that made it.
    """
    spark = frame.sparkSession
    path = fresh_folder(spark, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, wish: str) -> str:
    """``wish``, or with underscores in front until no column of ``frame`` is called so."""
    taken = {name.lower() for name in frame.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def row_mark(key: str, text: str) -> Column:
    """128 bits that tell rows apart by id and text; equal rows share them."""
    content = F.coalesce(F.col(text), F.lit(""))
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.md5(F.concat_ws("|", name, F.col(text).isNull().cast("string"), content))


def ship(context: SparkContext) -> None:
    """Sends this package to the executors, once, so that their Python workers can import it."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(context, "_hourlake_shipped", False) or not os.path.isdir(package):
        return
    # the driver serves the file to executors as long as it runs
    archive = os.path.join(tempfile.mkdtemp(prefix="hourlake-"), "hourlake_package.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._hourlake_shipped = True


def in_batches(frame: DataFrame, run: Callable, schema) -> DataFrame:
    """``frame.mapInArrow``, where the function may come from this package."""
    ship(frame.sparkSession.sparkContext)
    return frame.mapInArrow(run, schema)
