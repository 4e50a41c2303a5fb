"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

The items' windows of ``n`` words are hashed word by word. Documents are scanned once, in the row: a place
stays if the codes of its first word, its last word and its window are in bitmaps of the items' codes, which
have a fixed size and are part of the plan. What stays is joined to the set of window codes, which is
broadcast (eight bytes a window), and verified word by word; so a candidate's words are put together only if
its code is in the set. A set of more than ``SET_BYTES`` is joined by hash instead; nothing else changes.

A window is one class with one set of items, however many items share it, and equal sets of items are one
set. A place has at most one class, and a document's items are unfolded once for each of its sets. The places
that a document's verified windows cover are merged.

Defined cases: null or empty texts have no words; an item of fewer than ``n`` words is one window;
an item without an id contaminates, but is not listed; repeated rows are told apart; without items
nothing is hit; extra columns of ``documents`` pass through ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import CASED_WORD, SPAN, free_name, row_mark, segments, stored, words_of

WINDOW = 10
#: Bits of each bitmap. With many windows more places pass, and the join sorts them out.
BITS = 1 << 20
#: Bytes up to which the set of codes, and the windows' words, are broadcast.
SET_BYTES = 64 << 20
#: Bytes of a code in a broadcast set, with what its table adds.
CODE_BYTES = 32

HIT = "array<struct<place:int,size:int,code:bigint>>"


def _hash(size: int, at: str = "i") -> str:
    """Hash of ``size`` words from ``at`` on, out of the words' own hashes."""
    return "xxhash64(" + ", ".join(f"codes[{at} + {k}]" for k in range(size)) + ")"


def _gram(size: int, at: str = "i") -> str:
    return "concat_ws(' ', " + ", ".join(f"words[{at} + {k}]" for k in range(size)) + ")"


def _coded(frame: DataFrame, text: str) -> DataFrame:
    return frame.withColumn("words", words_of(F.col(text))).withColumn(
        "codes", F.expr("transform(words, w -> xxhash64(w))")
    )


def item_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct (item, size, gram, codes of the window and of its first and last word)."""
    coded = _coded(items.select("item_id", "text"), "text").where(F.size("words") > 0)
    sized = coded.withColumn("size", F.least(F.size("words"), F.lit(n)))
    starts = F.expr("sequence(0, size(words) - size)")
    spread = sized.withColumn("i", F.explode(starts))
    gram, code = F.lit(None).cast("string"), F.lit(None).cast("long")
    for size in range(1, n + 1):
        here = F.col("size") == size
        gram = F.when(here, F.expr(f"case when size = {size} then {_gram(size)} end")).otherwise(gram)
        code = F.when(here, F.expr(f"case when size = {size} then {_hash(size)} end")).otherwise(code)
    return spread.select(
        "item_id",
        "size",
        gram.alias("gram"),
        code.alias("code"),
        F.expr("codes[i]").alias("first"),
        F.expr("codes[i + size - 1]").alias("last"),
    ).distinct()


def _bitmaps(windows: DataFrame) -> dict[str, list[int]]:
    """For the codes of first words, last words and windows, which residues occur; at most ``BITS`` / 64 rows."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("first", "last", "code")])
    values = windows.select("size", F.explode(kinds).alias("v")).select("v.kind", F.expr(_residue("v.value", "size")).alias("bit"))
    words = values.groupBy("kind", F.expr("bit div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
    maps = {kind: [0] * (BITS // 64) for kind in ("first", "last", "code")}
    for r in words.collect():
        maps[r["kind"]][r["word"]] = r["bits"]
    return maps


def _residue(code: str, size: int | str) -> str:
    """A code's bit, apart for each size of windows."""
    return f"pmod({code} + {size} * 40503L, {BITS}L)"


def _candidates(sizes: list[int]) -> str:
    """Places of a row that the bitmaps let pass; ``codes`` is a column."""
    found = []
    for size in sizes:

        def passes(kind: str, code: str, size: int = size) -> str:
            bit = _residue(code, size)
            return f"shiftright({kind}_bits[cast(shiftright({bit}, 6) as int)], cast({bit} % 64 as int)) & 1 = 1"

        tests = [passes("first", "codes[i]")]
        if size > 1:
            tests.append(passes("last", f"codes[i + {size - 1}]"))
        tests.append(passes("code", _hash(size)))
        found.append(
            f"case when size(codes) >= {size} then transform(filter("
            f"sequence(0, size(codes) - {size}), i -> {' and '.join(tests)}), "
            f"i -> struct(i as place, {size} as size, {_hash(size)} as code)) else array() end"
        )
    return "concat(" + ", ".join(f"cast({x} as {HIT})" for x in found) + ")"


def _grams(sizes: list[int]) -> str:
    """The words of a hit, which is a column."""
    cases = " ".join(f"when {size} then {_gram(size, 'hit.place')}" for size in sizes)
    return f"case hit.size {cases} end"


def _broadcast(frame: DataFrame, size: int, most: int) -> DataFrame:
    return F.broadcast(frame) if size <= most else frame


def scan(
    docs: DataFrame, items: DataFrame, key: list[str], text: str = "text", n: int = WINDOW,
    set_bytes: int = SET_BYTES,
) -> DataFrame:
    """Per row of ``docs``: the columns ``key``, n_words, spans of hit words, n_hit, items."""
    windows = stored(item_windows(items, n), "benchmark-windows")
    # one row a window, with its set of items
    classes = stored(
        windows.groupBy("size", "gram", "code").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .withColumn("set", F.md5(F.to_json(F.struct("items")))),
        "benchmark-classes",
    )
    codes = classes.select("size", "code").distinct()
    measured = classes.agg(F.count("*").alias("n"), F.sum(F.octet_length("gram") + 64).alias("bytes")).first()
    sizes = sorted(r["size"] for r in classes.select("size").distinct().collect())
    source = docs.select(F.struct(*key).alias("key"), F.col(text).alias("text"))
    coded = _coded(source, "text")
    if sizes:
        maps = _bitmaps(windows)
        bits = {f"{k}_bits": F.expr("array(" + ", ".join(f"{b}L" for b in _signed(m)) + ")") for k, m in maps.items()}
        hits = F.expr(_candidates(sizes))
        coded = coded.withColumns(bits)
    else:
        hits = F.array().cast(HIT)
    # the words of candidates are kept with them: few rows have any
    coded = coded.withColumn("hits", hits)
    hit_words = F.when(F.size("hits") > 0, F.col("words"))
    rows = stored(
        coded.select(
            F.monotonically_increasing_id().alias("row"), "key", F.size("words").cast("long").alias("n_words"),
            "hits", hit_words.alias("words"),
        ),
        "scanned",
    )
    found = rows.where(F.size("hits") > 0).select("row", "words", F.explode("hits").alias("hit"))
    gram = F.expr(_grams(sizes)) if sizes else F.lit(None).cast("string")
    in_set = _broadcast(codes, measured["n"] * CODE_BYTES, set_bytes)
    found = found.select("row", "hit.place", "hit.size", "hit.code", "words", "hit")
    found = found.join(in_set, ["size", "code"], "left_semi").select("row", "place", "size", gram.alias("gram"))
    known = _broadcast(classes.select("size", "gram", "set"), measured["bytes"] or 0, set_bytes)
    verified = stored(found.join(known, ["size", "gram"]).select("row", "place", "size", "set"), "verified")
    span = F.struct(F.col("place").alias("start"), (F.col("place") + F.col("size")).cast("int").alias("past"))
    covered = verified.groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("windows"))
    covered = covered.select("row", F.expr(segments("windows", True)).alias("parts"))
    sets = classes.select("set", "items").dropDuplicates(["set"]).select("set", F.explode("items").alias("item"))
    listed = verified.select("row", "set").distinct().join(sets, "set")
    listed = listed.groupBy("row").agg(F.collect_set("item").alias("items"))
    return (
        rows.drop("hits", "words")
        .join(covered, "row", "left")
        .join(listed, "row", "left")
        .withColumn("spans", F.expr(f"transform(coalesce(parts, cast(array() as {SPAN})), s -> struct(s.start as first, s.past as past))"))
        .select(
            "key.*",
            "n_words",
            "spans",
            F.coalesce(F.expr("aggregate(spans, 0L, (a, s) -> a + s.past - s.first)"), F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array()).alias("items"),
        )
    )


def _signed(words: list[int]) -> list[str]:
    # the least long cannot be written as a number with a sign
    return [str(w) if w != -(1 << 63) else "-9223372036854775807L - 1" for w in words]


def decontaminate(
    docs: DataFrame, items: DataFrame, action: str = "documents", text: str = "text",
    n: int = WINDOW, key: str = "doc_id",
) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit words cut out of their texts.

    Documents are matched to their findings by id and a hash of the text, so rows with equal ids
    and other texts are told apart.
    """
    if action not in ("documents", "spans"):
        raise ValueError("action is documents or spans")
    mark, spans = free_name(docs, "content"), free_name(docs, "hit_spans")
    marked = docs.withColumn(mark, row_mark(key, text))
    found = scan(marked, items, [mark], text, n).where("n_hit > 0")
    if action == "documents":
        return marked.join(found.select(mark).distinct(), mark, "left_anti").select(*docs.columns)
    cuts = found.groupBy(mark).agg(F.first("spans").alias(spans))
    joined = marked.join(cuts, mark, "left")
    words = F.regexp_extract_all(F.col(text), F.lit(CASED_WORD), F.lit(0))
    between = F.split(F.col(text), CASED_WORD, -1)
    w, b = free_name(docs, "cased"), free_name(docs, "between")
    kept = F.expr(
        f"array_join(transform(`{w}`, (x, i) -> case when exists(`{spans}`, s -> i >= s.first "
        f"and i < s.past) then '' else concat(`{b}`[i], x) end), '') || element_at(`{b}`, -1)"
    )
    cut = F.when(F.col(spans).isNull(), F.col(text)).otherwise(kept)
    return (
        joined.withColumns({w: words, b: between})
        .withColumn(text, cut)
        .select(*docs.columns)
    )


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = scan(docs, items, ["doc_id"])
    ids = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The same rows in DuckDB's SQL, word by word.
ORACLE = """
with d as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
b as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark),
bw as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as g
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hit as (select r, dw.n, i, item_id from dw join bw on dw.g = bw.g and dw.n = bw.n),
covered as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
found as (
  select r, count(distinct item_id) as n_items,
    string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
  from hit group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (r) left join found using (r)
"""
