"""SentencePiece encoding and decoding over a relational lattice.

1. Words are what no piece can cross: runs of blanks with what follows, up to a mark that follows a
   letter in no piece; characters that occur in no longer piece stand alone. The documents' distinct words are counted, and
   the most frequent ones, ``HEAD`` at most, make the word table.
2. Each of its words is exploded into its substrings of at most a piece's length; these are equi-joined
   to the piece table, whose size is the model's; the edges are grouped by word. A character without a
   piece gets an edge of its bytes' pieces.
3. A higher-order ``aggregate`` folds a word's edges into its pieces, by the rule of the model's type:
   a unigram model's best path by Viterbi, a BPE model's merges in the order of their scores. (Viterbi
   over the scores of a BPE model, which are merge ranks, gives other pieces than the model's own.)
   Cut points of a word are the bits of a long.
4. The word table is broadcast and documents are encoded where they are. For words that are not in the
   table, the same steps are done on the columns of a batch: substrings, equi-join to the sorted piece
   table, edges by word, fold. (Sending these words through a shuffle and back was tried: see the README.)
   Words of more than SHORT characters have no lattice: ``fold_long`` merges each, or finds its best path,
   on its own. With a model whose pieces cross blanks, a whole text is such a word.

Decoding concatenates the pieces' bytes. Defined cases: a null or empty text has no pieces; "▁" in a text
is decoded as a blank, as the model does; repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm.common import in_batches, stored

#: The models' mark of a blank. Here a blank stands for it: most words are ASCII then, and small.
MARK, BLANK = "▁", " "
UNIGRAM, BPE = 1, 2
#: Of pieces: an ordinary one, one for a byte.
NORMAL, BYTE = 1, 6
#: By how much an unknown character's score is below the lowest piece.
UNKNOWN_PENALTY = 10.0

#: Words of at most so many characters have their cut points in one long.
SHORT = 62
#: So many words are broadcast at most, none longer than SHORT.
HEAD = 1 << 18
#: A worker remembers so many words outside the table.
REMEMBERED = 150_000
#: Documents are encoded together until they have so many characters.
CHARS_AT_ONCE = 1 << 21


@dataclass(frozen=True)
class Model:
    kind: int
    pieces: tuple[tuple[str, int, float], ...]  # text, id, score of ordinary pieces
    bytes: tuple[int, ...]  # ids of the 256 byte pieces, or none
    unknown: int
    size: int
    dummy_prefix: bool
    pattern: str  # of words, after blanks are marked

    @functools.cached_property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    @functools.cached_property
    def unknown_score(self) -> float:
        return min((s for _, _, s in self.pieces), default=0.0) - UNKNOWN_PENALTY

    def marked(self, text: str) -> str:
        text = text.replace(MARK, BLANK)
        return BLANK + text if text and self.dummy_prefix else text


def load_model(path: str, kind: int | None = None) -> Model:
    """The model of a ``.model`` file; ``kind`` overrides its type."""
    from sentencepiece import sentencepiece_model_pb2 as format_

    proto = format_.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models without text normalisation are supported")
    pieces = [
        (p.piece.replace(MARK, BLANK), i, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL
    ]
    octets = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == BYTE}
    by_byte = tuple(octets[f"<0x{b:02X}>"] for b in range(256)) if octets else ()
    return Model(
        kind or proto.trainer_spec.model_type,
        tuple(pieces),
        by_byte,
        proto.trainer_spec.unk_id,
        len(proto.pieces),
        proto.normalizer_spec.add_dummy_prefix,
        word_pattern([p for p, _, _ in pieces]),
    )


#: A letter, for Python and for Java.
LETTER, JAVA_LETTER = r"[^\W\d_]", r"\p{L}"


def word_pattern(pieces: list[str]) -> str:
    """Matches words, which no piece crosses; one match is the whole text if pieces cross blanks.

    ASCII characters of no longer piece are words of their own, and a word ends between a letter and
    a mark that follows a letter in no piece.
    """
    if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
        return r"(?s).+"
    joined = {c for p in pieces if len(p) > 1 for c in p}
    joined.add(BLANK)
    alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
    after_letter = {b for p in pieces for a, b in zip(p, p[1:]) if re.match(LETTER, a)}
    marks = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c in joined - after_letter]
    if not marks:
        return f"[{alone}]|{BLANK}+[^{BLANK}{alone}]*|[^{BLANK}{alone}]+"
    ending = "".join(map(re.escape, marks))
    more = f"(?:[^{BLANK}{alone}{ending}]+|(?<!{LETTER})[{ending}])*"
    return f"[{alone}]|(?:{BLANK}+|[^{BLANK}{alone}]){more}"


# 1. words


def count_words(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """(word, n) of all documents. What a letter is may differ a little from what ``encode`` takes for
    one: a word that is counted here and not met there costs a row of the table and nothing else."""
    marked = F.replace(F.col(text), F.lit(MARK), F.lit(BLANK))
    if model.dummy_prefix:
        marked = F.concat(F.lit(BLANK), marked)
    pattern = model.pattern.replace(LETTER, JAVA_LETTER)
    words = docs.where(F.length(text) > 0).select(
        F.explode(F.regexp_extract_all(marked, F.lit(pattern), F.lit(0))).alias("word")
    )
    return words.groupBy("word").agg(F.count("*").alias("n"))


# 2. edges


def _piece_table(spark: SparkSession, model: Model) -> DataFrame:
    rows = pa.table(
        {
            "piece": [p for p, _, _ in model.pieces],
            "id": pa.array([i for _, i, _ in model.pieces], pa.int32()),
            "score": [s for _, _, s in model.pieces],
        }
    )
    return spark.createDataFrame(rows)


def _fallback(model: Model) -> Column:
    """The pieces of a character that has none."""
    if not model.bytes:
        return F.array(F.lit(model.unknown))
    ids = ", ".join(map(str, model.bytes))
    return F.expr(
        f"""transform(sequence(1, octet_length(piece)), k -> array({ids})[
              cast(conv(hex(substr(encode(piece, 'UTF-8'), k, 1)), 16, 10) as int)])"""
    )


def word_edges(words: DataFrame, model: Model) -> DataFrame:
    """(word, n, edges): pieces within the word as (neg, start, end, ids), neg the score's negative."""
    starts = words.select("word", "n", F.explode(F.expr("sequence(0, length(word) - 1)")).alias("start"))
    lengths = F.expr(f"sequence(1, least({model.longest}, length(word) - start))")
    spans = starts.select("word", "n", "start", F.explode(lengths).alias("size")).withColumn(
        "piece", F.expr("substr(word, start + 1, size)")
    )
    # as many rows as the model has pieces
    table = F.broadcast(_piece_table(words.sparkSession, model))
    found = spans.join(table, "piece", "left").where(F.col("id").isNotNull() | (F.col("size") == 1))
    edges = found.select(
        "word",
        "n",
        F.struct(
            (-F.coalesce("score", F.lit(model.unknown_score))).alias("neg"),
            "start",
            (F.col("start") + F.col("size")).alias("end"),
            F.when(F.col("id").isNotNull(), F.array("id")).otherwise(_fallback(model)).alias("ids"),
        ).alias("edge"),
    )
    # grouped as the words were: no further exchange
    return edges.groupBy("word").agg(F.max("n").alias("n"), F.collect_list("edge").alias("edges"))


# 3. folds


def _fold_merges() -> list[tuple[str, str]]:
    """Cut points start as one bit each; the best edge over exactly two parts is merged, and again."""
    bits = """transform(array_sort(edges), e -> struct(e.neg as neg, e.start as start, e.ids as ids,
        shiftleft(1L, e.start) | shiftleft(1L, e.end) as ends,
        shiftleft(1L, e.end) - shiftleft(2L, e.start) as inner))"""
    done = "shiftleft(1L, 63)"
    cuts = f"""aggregate(sequence(1, length(word)), shiftleft(1L, length(word) + 1) - 1L, (m, i) ->
        case when m < 0 then m else coalesce(
          m & ~get(filter(bits, e -> (m & e.ends) = e.ends and bit_count(m & e.inner) = 1), 0).inner,
          m | {done}) end, m -> m & ~{done})"""
    ids = """flatten(transform(array_sort(transform(
        filter(bits, e -> (cuts & e.ends) = e.ends and (cuts & e.inner) = 0L),
        e -> struct(e.start as start, e.ids as ids))), e -> e.ids))"""
    return [("bits", bits), ("cuts", cuts), ("ids", ids)]


def _fold_viterbi() -> list[tuple[str, str]]:
    """Best score and last edge of each place, from left to right; then back along the last edges."""
    best = """aggregate(sequence(1, length(word)),
        cast(array(named_struct('neg', 0D, 'start', -1, 'ids', cast(array() as array<int>)))
          as array<struct<neg:double,start:int,ids:array<int>>>),
        (a, p) -> concat(a, array(array_min(transform(filter(edges, e -> e.end = p),
          e -> named_struct('neg', a[e.start].neg + e.neg, 'start', e.start, 'ids', e.ids))))))"""
    ids = """aggregate(sequence(1, length(word)),
        named_struct('at', length(word), 'ids', cast(array() as array<int>)),
        (a, i) -> case when a.at = 0 then a else named_struct('at', best[a.at].start,
          'ids', concat(best[a.at].ids, a.ids)) end, a -> a.ids)"""
    return [("best", best), ("ids", ids)]


def encode_words(words: DataFrame, model: Model) -> DataFrame:
    """(word, n, ids) from (word, n): each word once, none longer than SHORT."""
    folded = word_edges(words, model)
    for name, fold in _fold_viterbi() if model.kind == UNIGRAM else _fold_merges():
        folded = folded.withColumn(name, F.expr(fold))
    return folded.select("word", "n", "ids")


class Pieces:
    """The piece table as sorted columns, one set for each length, to join substrings to."""

    def __init__(self, model: Model):
        self.model = model
        self.known = {p: (i, s) for p, i, s in model.pieces}
        by_score = sorted(model.pieces, key=lambda p: (-p[2], p[1]))
        rank = {p: r for r, (p, _, _) in enumerate(by_score)}
        self.ids = np.array([i for _, i, _ in by_score], dtype=np.int32)
        self.neg = np.array([-s for _, _, s in by_score])
        # by length: hashes of the pieces and of the beginnings of longer ones, with their rank or -1
        self.by_length = []
        for size in range(1, model.longest + 1):
            begin = {p[:size]: -1 for p in rank if len(p) > size}
            begin.update((p, r) for p, r in rank.items() if len(p) == size)
            points = _points("".join(begin)).reshape(-1, size)
            codes = np.zeros(len(begin), dtype=np.uint64)
            for k in range(size):
                codes = _longer(codes, points[:, k])
            order = codes.argsort()
            ranks = np.fromiter(begin.values(), dtype=np.int64, count=len(begin))[order]
            self.by_length.append((codes[order], points[order], ranks))

    def edges(self, words: list[str]):
        """Columns start, end, rank of all pieces within the words, which stand one after the other."""
        points = _points("".join(words))
        sizes = np.array([len(w) for w in words])
        past = np.repeat(np.cumsum(sizes), sizes)
        start, code = np.arange(len(points)), np.zeros(len(points), dtype=np.uint64)
        out = []
        for size, (codes, pieces, ranks) in enumerate(self.by_length, 1):
            # substrings that go on in their word
            inside = start + size <= past[start]
            start, code = start[inside], code[inside]
            if not len(start):
                break
            code = _longer(code, points[start + size - 1])
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            # those that are a piece or begin one
            known = codes[at] == code
            start, code, at = start[known], code[known], at[known]
            whole = ranks[at] >= 0
            begin, entry = start[whole], at[whole]
            same = np.ones(len(begin), dtype=bool)
            for k in range(size):
                same &= points[begin + k] == pieces[entry, k]
            begin, entry = begin[same], entry[same]
            out.append((begin, begin + size, ranks[entry]))
        start, end, rank = (np.concatenate(c) for c in zip(*out, strict=True)) if out else [np.zeros(0, int)] * 3
        return points, np.cumsum(sizes) - sizes, start, end, rank

    def encode(self, words: list[str]) -> list[bytes]:
        """The pieces of each word, as the bytes of 32-bit numbers."""
        if not words:
            return []
        points, begins, start, end, rank = self.edges(words)
        if self.model.kind == UNIGRAM:
            cut = self._viterbi(len(points), begins, start, end, rank)
        else:
            cut = _merged(len(points), begins, start, end, rank)
        first = np.flatnonzero(cut[:-1])
        last = np.append(first[1:], len(points))
        # the edge of each part, if there is one
        key = start * (self.model.longest + 1) + (end - start)
        order = key.argsort()
        wanted = first * (self.model.longest + 1) + (last - first)
        at = np.minimum(np.searchsorted(key[order], wanted), max(0, len(order) - 1))
        found = key[order][at] == wanted if len(order) else np.zeros(len(wanted), bool)
        ids = np.full(len(wanted), -1, dtype=np.int32)
        ids[found] = self.ids[rank[order][at[found]]]
        counts = np.ones(len(wanted), dtype=np.int64)
        odd = np.flatnonzero(~found)
        if len(odd):
            replaced = [self._unknown(chr(int(points[first[i]]))) for i in odd]
            counts[odd] = [len(r) for r in replaced]
            wide = np.repeat(ids, counts)
            wide[wide < 0] = [i for r in replaced for i in r]
            ids = wide
        upto = np.concatenate([[0], np.cumsum(counts)])
        bounds = upto[np.searchsorted(first, np.append(begins, len(points)))] * 4
        raw, bounds = ids.astype("<i4").tobytes(), bounds.tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _unknown(self, char: str) -> list[int]:
        if not self.model.bytes:
            return [self.model.unknown]
        return [self.model.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def _viterbi(self, n: int, begins, start, end, rank) -> np.ndarray:
        """Cut points of the best paths; the k-th place of all words is done at once."""
        single = np.ones(n, dtype=bool)
        single[start[end - start == 1]] = False
        lone = np.flatnonzero(single)
        start, end = np.concatenate([start, lone]), np.concatenate([end, lone + 1])
        neg = np.concatenate([self.neg[rank], np.full(len(lone), -self.model.unknown_score)])
        word = np.searchsorted(begins, start, side="right") - 1
        place = end - begins[word]
        order = np.lexsort((start, end, place))
        start, end, neg, place = start[order], end[order], neg[order], place[order]
        # places are by end; the begin of a word is the end of the one before, and costs nothing
        best, back = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        is_begin = np.zeros(n + 1, dtype=bool)
        is_begin[begins] = True
        for lo, hi in _runs(place):
            cost = neg[lo:hi] + np.where(is_begin[start[lo:hi]], 0.0, best[start[lo:hi]])
            heads = np.flatnonzero(np.diff(end[lo:hi], prepend=-1))
            least = np.minimum.reduceat(cost, heads)
            best[end[lo:hi][heads]] = least
            size = np.diff(np.append(heads, hi - lo))
            chosen = np.flatnonzero(cost == np.repeat(least, size))[::-1]
            back[end[lo:hi][chosen]] = start[lo:hi][chosen]
        cut = np.zeros(n + 1, dtype=bool)
        at = np.append(begins[1:], n)
        while len(at):
            cut[at] = True
            at = back[at]
            at = at[~is_begin[at]]
        cut[begins] = True
        return cut


def _runs(sorted_values: np.ndarray):
    bounds = np.flatnonzero(np.diff(sorted_values, prepend=-1)).tolist() + [len(sorted_values)]
    return list(zip(bounds, bounds[1:]))


def _merged(n: int, begins, start, end, rank) -> np.ndarray:
    """Cut points after all merges: in each round, the best edge over two parts of every word.

    There are fewer than 2**20 pieces, and words here are no longer than SHORT.
    """
    cut = np.ones(n + 1, dtype=bool)
    longer = end - start > 1
    start, end, rank = start[longer], end[longer], rank[longer]
    word = np.searchsorted(begins, start, side="right") - 1
    # by word, then rank, then place, in one key: ranks and places are small
    order = ((word << 40) + (rank << 20) + (start - begins[word])).argsort()
    start, end, word = start[order], end[order], word[order]
    while len(start):
        before = np.concatenate([[0], np.cumsum(cut)])
        inside = before[end] - before[start + 1]
        live = cut[start] & cut[end] & (inside > 0)
        start, end, word, inside = start[live], end[live], word[live], inside[live]
        ready = np.flatnonzero(inside == 1)
        if not len(ready):
            break
        first = ready[np.flatnonzero(np.diff(word[ready], prepend=-1))]
        # the one cut between start and end
        cuts = np.flatnonzero(cut)
        cut[cuts[before[start[first] + 1]]] = False
        # a word without a merge has none in later rounds
        merging = np.zeros(len(begins), dtype=bool)
        merging[word[first]] = True
        keep = merging[word]
        start, end, word = start[keep], end[keep], word[keep]
    return cut


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _longer(code: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The 64-bit hash of a string that is one character longer; what it finds is compared in full."""
    code = (code + point) * np.uint64(0x9E3779B97F4A7C15)
    return code ^ (code >> np.uint64(32))


def fold_long(word: str, known: dict[str, tuple[int, float]], model: Model) -> list[int]:
    """Pieces of a word of any length, by the same rules."""
    parts = _viterbi(word, known, model) if model.kind == UNIGRAM else _merges(word, known)
    ids: list[int] = []
    for part in parts:
        if part in known:
            ids.append(known[part][0])
        elif model.bytes:
            ids += [model.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
        else:
            ids.append(model.unknown)
    return ids


def _merges(word: str, known) -> list[str]:
    n = len(word)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    end = list(range(1, n + 1))
    alive = [True] * n

    def entry(a: int):
        b = after[a]
        piece = word[a : end[b]] if b >= 0 else ""
        return (-known[piece][1], a, end[b]) if piece in known else None

    heap = [e for a in range(n) if (e := entry(a))]
    heapify(heap)
    while heap:
        _, a, past = heappop(heap)
        b = after[a]
        if not alive[a] or b < 0 or end[b] != past:
            continue
        alive[b], end[a], after[a] = False, past, after[b]
        if after[a] >= 0:
            before[after[a]] = a
            if e := entry(a):
                heappush(heap, e)
        if before[a] >= 0 and (e := entry(before[a])):
            heappush(heap, e)
    return [word[a : end[a]] for a in range(n) if alive[a]]


def _viterbi(word: str, known, model: Model) -> list[str]:
    longest, unknown = model.longest, model.unknown_score
    best = [0.0] + [-float("inf")] * len(word)
    start = [0] * (len(word) + 1)
    for a in range(len(word)):
        for b in range(a + 1, min(len(word), a + longest) + 1):
            piece = word[a:b]
            if piece in known or b == a + 1:
                score = best[a] + (known[piece][1] if piece in known else unknown)
                if score > best[b]:
                    best[b], start[b] = score, a
    parts, at = [], len(word)
    while at:
        parts.append(word[start[at] : at])
        at = start[at]
    return parts[::-1]


# 4. documents


def _frequent(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words: whole classes of frequency, ``most`` rows at most."""
    short = words.where((F.length("word") <= SHORT) & (F.length("word") > 0))
    classes = short.withColumn("class", F.floor(8 * F.log2("n")))
    sizes = classes.groupBy("class").count().orderBy(F.desc("class")).collect()  # at most 8 * 64
    least, total = float("inf"), 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row["class"]
    return classes.where(F.col("class") >= least).select("word", "n")


def _packed_ids(lists) -> list[bytes]:
    """Each list of ids as the bytes of its 32-bit numbers."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    ends = (lists.offsets.to_numpy() * 4).tolist()
    raw = lists.values.to_numpy(zero_copy_only=False).astype("<i4").tobytes()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class Table:
    """Pieces by word: the broadcast words, and up to REMEMBERED of those met lately."""

    def __init__(self, table: pa.Table, model: Model):
        self.pieces = Pieces(model)
        words = table.column("word").to_pylist()
        self.known = dict(zip(words, _packed_ids(table.column("ids")), strict=True))
        self.met: list[str] = []

    def meet(self, words: set[str]) -> None:
        """Makes all of ``words`` known."""
        known = self.known
        new = [w for w in words if w not in known]
        if len(self.met) + len(new) > REMEMBERED:
            for word in self.met:
                del known[word]
            self.met.clear()
            new = [w for w in words if w not in known]
        short = [w for w in new if len(w) <= SHORT]
        known.update(zip(short, self.pieces.encode(short), strict=True))
        for word in new:
            if len(word) > SHORT:
                ids = fold_long(word, self.pieces.known, self.pieces.model)
                known[word] = np.array(ids, dtype="<i4").tobytes()
        self.met += new


@functools.lru_cache(maxsize=1)
def _table(stream: bytes, model: Model) -> Table:
    """The word table, kept by a worker from task to task."""
    return Table(pa.ipc.open_stream(stream).read_all(), model)


def encode(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """Per document its key, ``ids``, and ``restored``: whether decoding gives the text again."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    words = stored(count_words(source, model, "text"), "words")
    table = encode_words(_frequent(words, head), model).select("word", "ids").toArrow()
    # no more words than HEAD, none longer than SHORT
    shared = docs.sparkSession.sparkContext.broadcast((_stream(table), model))
    shape = {"ids": F.array().cast("array<int>"), "restored": F.lit(True)}
    schema = source.select("key").withColumns(shape).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, own_model = shared.value
        words, octets = _table(stream, own_model), PieceBytes(own_model)
        marked, find = own_model.marked, re.compile(own_model.pattern).findall
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _parts(texts):
                found = [find(marked(t)) for t in texts[a:b]]
                words.meet(set().union(*found))
                raw = [b"".join(map(words.known.__getitem__, f)) for f in found]
                sizes = np.array([len(r) // 4 for r in raw])
                ids = np.frombuffer(b"".join(raw), dtype="<i4")
                restored = [
                    octets.text(own) == t.replace(MARK, BLANK)
                    for own, t in zip(np.split(ids, np.cumsum(sizes)[:-1]), texts[a:b], strict=True)
                ]
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                        pa.array(restored, pa.bool_()),
                    ],
                    ["key", "ids", "restored"],
                )

    return in_batches(source, run, schema).withColumnRenamed("key", key)


def _parts(texts: list[str]):
    """Ranges of texts of about CHARS_AT_ONCE characters."""
    a = size = 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= CHARS_AT_ONCE or i == len(texts):
            yield a, i
            a, size = i, 0


# decoding


class PieceBytes:
    """What ids stand for: blanks for their mark, bytes for byte pieces, nothing for control pieces."""

    def __init__(self, model: Model):
        octets = [b""] * model.size
        for piece, i, _ in model.pieces:
            octets[i] = piece.encode()
        for byte, i in enumerate(model.bytes):
            octets[i] = bytes([byte])
        if not model.bytes:
            octets[model.unknown] = " ⁇ ".encode()
        self.octets, self.dummy_prefix = octets, model.dummy_prefix

    def text(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.octets.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


def decode(encoded: DataFrame, model: Model, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; all other columns pass through. Null ids are no text."""
    if text in encoded.columns:
        raise ValueError("the name of the text must be free")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        octets = PieceBytes(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            texts = [octets.text(v.values.to_numpy(zero_copy_only=False)) if v.is_valid else None for v in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text]
            )

    return in_batches(encoded, run, encoded.withColumn(text, F.lit("")).schema)
