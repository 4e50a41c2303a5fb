"""Phrase collocations from weighted acyclic automata of counts.

1. A task reads its texts as windows: each word with those that follow it in its piece, up to the longest
   phrase. Sorted, they give the counts of all phrases that begin windows, and an automaton is built of each
   shard of about ``SHARD_WORDS`` words. It is cut at borders, which are the same for all tasks.
2. Each range between two borders is one task: the union of its automata sums the counts. What is counted
   often enough is kept, and asks for the counts of its parts: one automaton of questions for each range that
   has some of them, with each part once, however many phrases share it.
3. The range that holds parts composes the questions with its counts and sends them back, answered. A question
   also carries the count of the largest phrase that asks, so a range learns what covers its phrases.
4. The asking range scores its phrases. Ranks are taken in groups of ranges first, and then by language.

Borders come from windows of about ``SAMPLE_DOCUMENTS`` documents. They are whole phrases, so that the phrases
of a very common word, or pair, are dealt to many ranges; they change how work is dealt, and no result. Counts
and statistics cover all documents; nothing is left out but phrases below the least count, as their parts are.

Defined cases: a null text is empty; a null language is ``und``; very long texts are read in parts, and windows
reach over the cuts; repeated rows count each; ties are ranked by the bytes of the phrase; an empty table gives
no rows; columns other than the text and the language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.common import in_batches, stored
from hourlake.llm.count_automata import (
    Automaton,
    build,
    compose,
    cut,
    order_keys,
    spelled,
    summed,
    union,
    unpacked,
    widened,
)
from hourlake.session import shuffle_partitions

#: Words of the longest phrase, least count, per cent of a phrase that make a longer one cover it, ranks.
LONGEST, LEAST, COVER, FIRST = 3, 10, 50, 2_000
SCORE = 1_000_000
NO_LANGUAGE = "und"

#: Words of a shard's automaton, and bytes of text that are cut into words at a time.
SHARD_WORDS, CHUNK_BYTES = 1 << 20, 1 << 22
#: Paths that are united at a time, besides what has been united.
UNION_PATHS = 1 << 22
#: Expected documents of the sample for borders, and borders' candidates: one in so many windows, at most so many.
SAMPLE_DOCUMENTS, MARK_EVERY, MARKS, ALL_MARKS = 2_000, 16, 4_096, 100_000
#: Words of a range: at most about so many, and at least so many before more ranges than partitions help.
RANGE_WORDS, LEAST_RANGE_WORDS = 1 << 22, 1 << 15
#: Ranges whose ranks are taken together first.
RANGES_AT_ONCE = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = 0

Border = tuple[str, tuple[bytes, ...]]


def _table() -> bytes:
    """Capitals to small letters, ends of pieces to line feeds, tabs to blanks."""
    table = bytearray(range(256))
    table[ord("A") : ord("Z") + 1] = b"abcdefghijklmnopqrstuvwxyz"
    for end in _ENDS:
        table[end] = ord("\n")
    table[ord("\t")] = ord(" ")
    return bytes(table)


class Numbers(dict):
    """A number for each word, from 1; nothing between blanks has none, and a line feed ends a piece."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": _BREAK})
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = number = len(self.words)
        return number


class Shard:
    """Windows of one language's texts, up to a number of words at a time."""

    def __init__(self, longest: int):
        self.longest, self.table = longest, _table()
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.parts, self.size = Numbers(), [], 0

    def _add(self, lowered: bytes) -> None:
        words = lowered.replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.parts.append(found[found >= 0])
        self.size += len(self.parts[-1])

    def add(self, text: bytes) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        """Takes texts that end with a line feed; gives windows whenever there are enough words."""
        lowered = text.translate(self.table)
        at = 0
        while at < len(lowered):
            end = at + CHUNK_BYTES
            if end < len(lowered):
                # not within a word
                stops = [p for p in (lowered.find(b" ", end), lowered.find(b"\n", end)) if p >= 0]
                end = min(stops) + 1 if stops else len(lowered)
            self._add(lowered[at:end])
            at = end
            if self.size >= SHARD_WORDS:
                yield from self.windows(whole=at >= len(lowered))

    def windows(self, whole: bool = True) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        """(words in order, sorted paths, counts) of what was added; the shard is empty afterwards.

        Unless the text is ``whole``, its last words are kept for the windows that begin with them.
        """
        numbers, words = np.concatenate([np.zeros(0, dtype=np.int32), *self.parts]), self.numbers.words
        self._clear()
        counted = len(numbers) if whole else max(0, len(numbers) - self.longest + 1)
        rest = numbers[counted:]
        if len(rest):
            self._add(b" ".join(b"\n" if i == _BREAK else words[i - 1] for i in rest.tolist()))
        order = sorted(range(len(words)), key=words.__getitem__)
        rank = np.zeros(len(words) + 1, dtype=np.int32)
        rank[np.array(order, dtype=np.int64) + 1] = np.arange(1, len(words) + 1)
        ranks = np.append(rank[numbers], np.zeros(self.longest, dtype=np.int32))
        # a window ends with its piece
        columns = [ranks[:counted]]
        for d in range(1, self.longest):
            columns.append(np.where(columns[-1] > 0, ranks[d : d + counted], 0))
        matrix = np.stack(columns, axis=1)[columns[0] > 0]
        if len(matrix):
            yield [words[i] for i in order], *summed(matrix, np.ones(len(matrix), dtype=np.int64), len(words))


def all_prefixes(matrix: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted windows to all sorted phrases that begin one, with their counts."""
    rows, depth = matrix.shape
    changed = np.zeros(rows, dtype=bool)
    changed[:1] = True
    before = np.concatenate([[0], np.cumsum(weights)])
    found = []
    for d in range(depth):
        changed[1:] |= matrix[1:, d] != matrix[:-1, d]
        present = matrix[:, d] > 0
        heads = np.flatnonzero(changed & present)
        # a phrase's windows are neighbours; they end before the next change
        changes = np.append(np.flatnonzero(changed), rows)
        ends = changes[np.searchsorted(changes, heads, side="right")]
        found.append((heads, d, before[ends] - before[heads]))
    heads = np.concatenate([h for h, _, _ in found])
    depths = np.concatenate([np.full(len(h), d) for h, d, _ in found])
    counts = np.concatenate([c for _, _, c in found])
    order = np.lexsort((depths, heads))
    phrases = matrix[heads[order]]
    phrases[np.arange(depth)[None, :] > depths[order][:, None]] = 0
    return phrases, counts[order]


def _by_language(batches: Iterator[pa.RecordBatch], longest: int):
    """(language, words, sorted windows, counts) of a task's texts, given as (language, octets)."""
    shards: dict[str, Shard] = {}
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts.setdefault(language, []).append(text)
        for language, found in texts.items():
            shard = shards.setdefault(language, Shard(longest))
            for windows in shard.add(b"\n".join([*found, b""])):
                yield language, *windows
        # many languages share the room of one
        if sum(s.size for s in shards.values()) >= 2 * SHARD_WORDS:
            for language, shard in shards.items():
                for windows in shard.windows():
                    yield language, *windows
            shards.clear()
    for language, shard in shards.items():
        for windows in shard.windows():
            yield language, *windows


def _borders(texts: DataFrame, longest: int) -> list[Border]:
    """Phrases, with their language, that cut all phrases into ranges of about equal size."""
    partitions = shuffle_partitions(texts.sparkSession)
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, texts.count()))
    sample = texts if share == 1.0 else texts.sample(share, 7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for language, words, matrix, counts in _by_language(batches, longest):
            step = max(MARK_EVERY, -(-len(matrix) // MARKS))
            marks = [b"\t".join(spelled(words, m)) for m in matrix[step // 2 :: step].tolist()]
            rows += [(language, mark, 0) for mark in marks] + [(language, None, int(counts.sum()))]
        yield _batch(rows, {"lang": pa.string(), "mark": pa.binary(), "words": pa.int64()})

    found = in_batches(sample, run, "lang string, mark binary, words long")
    found = stored(found, "marks")
    words = (found.agg(F.sum("words")).first()[0] or 0) / share
    marks = found.where("mark is not null").distinct().orderBy(F.xxhash64("lang", "mark")).limit(ALL_MARKS).collect()
    ranges = max(-(-words // RANGE_WORDS), min(partitions, -(-words // LEAST_RANGE_WORDS)))
    ordered = sorted((r["lang"], tuple(bytes(r["mark"]).split(b"\t"))) for r in marks)
    places = {round(i * len(ordered) / ranges) for i in range(1, int(ranges))}
    return [ordered[p] for p in sorted(places) if 0 < p < len(ordered)]


def _batch(rows: list[tuple], columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    values = list(zip(*rows, strict=True)) or [[] for _ in columns]
    arrays = [pa.array(v, t) for v, t in zip(values, columns.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _dealt(
    borders: list[Border], language: str, symbols: list[bytes], matrix: np.ndarray, weights: np.ndarray
) -> Iterator[tuple[int, Automaton]]:
    """The ranges that have some of the sorted paths, and the automata of their parts."""
    before = sum(b[0] < language for b in borders)
    own = [b[1] for b in borders if b[0] == language]
    ends = [*cut(symbols, matrix, own), len(matrix)]
    start = 0
    for i, end in enumerate(ends):
        if end > start:
            yield before + i, build(symbols, matrix[start:end], weights[start:end])
        start = end


_MESSAGE = {
    "step": pa.string(), "owner": pa.int32(), "holder": pa.int32(), "lang": pa.string(),
    "words": pa.int64(), "automaton": pa.binary(),
}
_MESSAGE_SCHEMA = "step string, owner int, holder int, lang string, words long, automaton binary"
COUNTS, QUESTION, ANSWER, COVERS = "counts", "question", "answer", "covers"


def _groups(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[tuple[int, str], Iterator[tuple]]]:
    """Rows of equal range (column ``at``) and language, which follow each other."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    language = list(_MESSAGE).index("lang")
    yield from groupby(rows, key=lambda row: (row[at], row[language]))


def sub_phrases(matrix: np.ndarray, weights: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """All proper parts of phrases, each once, with the count of the most frequent phrase that has it."""
    depth = matrix.shape[1]
    sizes = (matrix > 0).sum(axis=1)
    parts, counts = [np.zeros((0, depth), dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
    for size in range(2, depth + 1):
        rows, of = matrix[sizes == size], weights[sizes == size]
        for length in range(1, size):
            for start in range(size - length + 1):
                parts.append(widened(rows[:, start : start + length], depth))
                counts.append(of)
    return summed(np.concatenate(parts), np.concatenate(counts), symbols, np.maximum)


def scores(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``floor(SCORE * a * a / (left * right))``, exactly: floats where they decide, else integers of any size."""
    near = SCORE * (a / left) * (a / right)  # off by far less than a millionth
    low, high = np.floor(near - 1e-6), np.floor(near + 1e-6)
    found = low.astype(np.int64)
    for i in np.flatnonzero(low != high).tolist():
        found[i] = SCORE * int(a[i]) ** 2 // (int(left[i]) * int(right[i]))
    return found


def _score(
    counts: Automaton, answers: Automaton, covers: Automaton | None, cover: int
) -> Iterator[tuple[bytes, int, int, int, int]]:
    """(phrase, a, l, r, score) of a range's phrases that no longer one covers."""
    matrix, a = counts.paths()
    depth = matrix.shape[1]
    sizes = (matrix > 0).sum(axis=1)
    larger = np.zeros(len(a), dtype=np.int64) if covers is None else compose(counts, covers)
    kept = (sizes >= 2) & (100 * larger < cover * a)
    matrix, a, sizes = matrix[kept], a[kept], sizes[kept]
    if not len(a):
        return
    known, part_counts = answers.paths()
    number = {s: i + 1 for i, s in enumerate(counts.symbols)}
    new = np.array([0, *(number[s] for s in answers.symbols)], dtype=np.int32)
    known = widened(new[known], depth)

    def look_up(parts: np.ndarray) -> np.ndarray:
        key = order_keys(np.concatenate([known, widened(parts, depth)]), len(counts.symbols))
        theirs, mine = key[: len(known)], key[len(known) :]
        return part_counts[np.searchsorted(theirs, mine)]

    best = np.full(len(a), np.iinfo(np.int64).max)
    left, right = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
    for k in range(1, depth):
        rows = np.flatnonzero(sizes > k)
        if not len(rows):
            continue
        l, r = look_up(matrix[rows, :k]), look_up(matrix[rows, k:])
        score = scores(a[rows], l, r)
        lower = score < best[rows]  # ties: the first cut stays
        best[rows[lower]], left[rows[lower]], right[rows[lower]] = score[lower], l[lower], r[lower]
    for row, *numbers in zip(matrix.tolist(), a.tolist(), left.tolist(), right.tolist(), best.tolist(), strict=True):
        yield b" ".join(spelled(counts.symbols, row)), *numbers


def score_phrases(
    docs: DataFrame, text: str = "text", language: str = "lang", longest: int = LONGEST, least: int = LEAST,
    cover: int = COVER,
) -> tuple[DataFrame, DataFrame]:
    """(lang, range, phrase, a, l, r, score) of all phrases of 2 to ``longest`` words that are counted ``least``
    times and not covered; and (lang, n), the number of words."""
    octets = F.coalesce(F.col(text), F.lit("")).cast("binary")
    texts = docs.select(F.coalesce(F.col(language).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), octets.alias("octets"))
    borders = _borders(texts, longest)
    ranges = len(borders) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, matrix, counts in _by_language(batches, longest):
            phrases = all_prefixes(matrix, counts)
            rows = [
                (COUNTS, at, at, lang, 0, automaton.packed())
                for at, automaton in _dealt(borders, lang, words, *phrases)
            ]
            yield _batch(rows, _MESSAGE)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (own, lang), rows in _groups(batches, 1):
            pending, paths = [], 0
            for row in rows:
                pending.append(unpacked(row[-1]))
                paths += len(pending[-1].label)
                if paths > UNION_PATHS:
                    pending, paths = [union(pending)], 0
            matrix, weights = union(pending).paths()
            symbols = sorted(set().union(*(p.symbols for p in pending)))
            single = matrix[:, 1:].max(axis=1, initial=0) == 0
            frequent = weights >= least
            kept = build(symbols, matrix[frequent], weights[frequent])
            found = [(COUNTS, own, own, lang, int(weights[single].sum()), kept.packed())]
            asked = sub_phrases(*kept.paths(), len(kept.symbols))
            found += [
                (QUESTION, own, holder, lang, 0, questions.packed())
                for holder, questions in _dealt(borders, lang, kept.symbols, *asked)
            ]
            yield _batch(found, _MESSAGE)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (own, lang), rows in _groups(batches, 2):
            rows = list(rows)
            counts = next((unpacked(r[-1]) for r in rows if r[0] == COUNTS), None)
            covers: list[Automaton] = []
            for row in rows:
                if row[0] != QUESTION:
                    continue
                questions = unpacked(row[-1])
                matrix, asking = questions.paths()
                found = build(questions.symbols, matrix, compose(questions, counts))
                yield _batch([(ANSWER, row[1], own, lang, 0, found.packed())], _MESSAGE)
                phrases = (matrix > 0).sum(axis=1) >= 2
                covers.append(build(questions.symbols, matrix[phrases], asking[phrases]))
                if len(covers) >= 64:
                    covers = [union(covers, np.maximum)]
            if covers:
                yield _batch([(COVERS, own, own, lang, 0, union(covers, np.maximum).packed())], _MESSAGE)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = {"lang": pa.string(), "range": pa.int32(), "phrase": pa.binary()}
        columns |= {n: pa.int64() for n in ("a", "l", "r", "score")}
        for (own, lang), rows in _groups(batches, 1):
            parts: dict[str, list[Automaton]] = {}
            for row in rows:
                parts.setdefault(row[0], []).append(unpacked(row[-1]))
            if COUNTS not in parts or ANSWER not in parts:
                continue  # no phrase of several words
            covers = parts[COVERS][0] if COVERS in parts else None
            found = [(lang, own, *p) for p in _score(parts[COUNTS][0], union(parts[ANSWER]), covers, cover)]
            yield _batch(found, columns)

    def ranged(frame: DataFrame, by: str) -> DataFrame:
        return frame.repartitionById(ranges, by).sortWithinPartitions(by, "lang")

    counted = in_batches(texts, count, _MESSAGE_SCHEMA)
    united = stored(in_batches(ranged(counted, "owner"), unite, _MESSAGE_SCHEMA), "counts")
    answered = in_batches(ranged(united, "holder"), answer, _MESSAGE_SCHEMA)
    known = united.where(F.col("step") == COUNTS).unionByName(answered)
    schema = "lang string, range int, phrase binary, a long, l long, r long, score long"
    scored = in_batches(ranged(known, "owner"), score, schema)
    words = united.where(F.col("step") == COUNTS).groupBy("lang").agg(F.sum("words").alias("n"))
    return scored.withColumn("phrase", F.col("phrase").cast("string")), words


def first_phrases(scored: DataFrame, words: DataFrame, first: int = FIRST) -> DataFrame:
    """Each language's ``first`` phrases by score, count and bytes, with rank and the number of words."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]

    def ranked(frame: DataFrame, *by) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return frame.withColumn("rank", place.cast("long")).where(F.col("rank") <= first)

    group = F.floor(F.col("range") / RANGES_AT_ONCE)
    best = ranked(ranked(scored.withColumn("group", group), "lang", "group").drop("rank"), "lang")
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocation_digest(docs: DataFrame) -> DataFrame:
    return first_phrases(*score_phrases(docs))


ORACLE = f"""with words as (
  select doc_id, coalesce(lang, '{NO_LANGUAGE}') as lang, piece, unnest(w) as word, unnest(range(len(w))) as place
  from (
    select doc_id, row, lang, row * 1000000 + unnest(range(len(p))) as piece,
      regexp_extract_all(unnest(p), '[^\\x20\\x09]+') as w
    from (
      select doc_id, lang, row_number() over () as row,
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') as p
      from documents))),
runs as (
  select lang, word as w1, lead(word) over o as w2, lead(word, 2) over o as w3
  from words window o as (partition by piece order by place)),
f1 as (select lang, w1, count(*) as f from runs group by all),
f2 as (select lang, w1, w2, count(*) as f from runs where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, count(*) as f from runs where w3 is not null group by all having count(*) >= {LEAST}),
larger as (
  select lang, w1, w2, max(f) as f from (
    select lang, w1, w2, f from f3 union all select lang, w2, w3, f from f3) group by all),
cuts as (
  select c.lang, concat_ws(' ', c.w1, c.w2) as phrase, c.f as a, 1 as k, x.f as l, y.f as r
  from f2 c join f1 x on x.lang = c.lang and x.w1 = c.w1 join f1 y on y.lang = c.lang and y.w1 = c.w2
    left join larger g on g.lang = c.lang and g.w1 = c.w1 and g.w2 = c.w2
  where c.f >= {LEAST} and coalesce(100 * g.f < {COVER} * c.f, true)
  union all
  select c.lang, concat_ws(' ', c.w1, c.w2, c.w3), c.f, 1, x.f, y.f
  from f3 c join f1 x on x.lang = c.lang and x.w1 = c.w1
    join f2 y on y.lang = c.lang and y.w1 = c.w2 and y.w2 = c.w3
  union all
  select c.lang, concat_ws(' ', c.w1, c.w2, c.w3), c.f, 2, x.f, y.f
  from f3 c join f2 x on x.lang = c.lang and x.w1 = c.w1 and x.w2 = c.w2
    join f1 y on y.lang = c.lang and y.w1 = c.w3),
scored as (
  select *, cast(({SCORE}::hugeint * a * a) // (l::hugeint * r) as bigint) as score from cuts),
best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best),
totals as (select lang, count(*) as n from words group by lang)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= {FIRST}"""
