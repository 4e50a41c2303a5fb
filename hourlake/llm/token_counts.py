"""Token counts of a byte-level BPE: pre-tokens that are one token are counted, only the rest is merged.

A vocabulary string need not be what its own bytes are merged to. Before any document is read, each string
is put through the merges alone; those that come out as one token are *whole*. A text is cut at special
strings, then into pre-tokens; a pre-token that is whole costs one look-up, and merges are run for the others,
which are remembered within a bound. Texts are counted in batches where they are read: no shuffle, and a task
holds one batch.

Which code points are letters or digits depends on a library's Unicode version. Where two public tables (of
``regex`` and of Python) disagree, the tokenizer's own pre-tokenizer is asked, once, on the driver.

Defined cases: a null or empty text has no bytes and no tokens; very long pre-tokens are merged with a heap,
in n log n steps; repeated rows and ids are counted each; an empty table gives an empty result; columns stay
as they are, and result columns avoid their names.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from hourlake.llm.common import free_name, in_batches

#: Fixed value: the pre-tokens of byte-level BPE vocabularies of this kind.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens that are remembered with their cost, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 200_000, 48
#: Longer pre-tokens are merged with a heap; longer texts are cut into pre-tokens one by one.
HEAP_BYTES, LONG_TEXT = 48, 1 << 20
#: What a pre-token that had to be merged adds to a sum, besides its tokens.
MERGED = 1 << 40
#: More than any id of a vocabulary, and more than any merge's number.
IDS, NO_MERGE = 1 << 24, 1 << 60
#: A document of more tokens is over the limit.
LIMIT = 1024

# one character of each class, for code points that ``regex`` puts in another class
_STAND_IN = {"L": "a", "N": "1", "O": "!", "S": " "}


@dataclass
class Vocabulary:
    """What the tasks need: ids of single bytes, merges, whole strings, special strings, odd characters."""

    bytes_: list[int]
    #: rank times ``IDS`` plus the new id, by pair of ids
    merges: dict[tuple[int, int], int]
    whole: set[str]
    special: list[str]
    odd: dict[int, str] = field(default_factory=dict)
    #: what the tasks of one Python worker remember
    costs: Costs | None = None


def byte_letters() -> list[str]:
    """The character that stands for each byte in a vocabulary file: itself where it is visible."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a vocabulary file and proves which of its strings are whole."""
    with open(path, encoding="utf-8") as source:
        content = json.load(source)
    model, pre = content["model"], content["pre_tokenizer"] or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    options = ["dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"]
    special = content["added_tokens"]
    if (
        model["type"] != "BPE"
        or content["normalizer"] is not None
        or any(pre.get(k) != v for k, v in plain.items())
        or any(model.get(k) for k in options)
        or any(s["single_word"] or s["lstrip"] or s["rstrip"] for s in special)
    ):
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    letters, ids = byte_letters(), model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = {(ids[a], ids[b]): rank * IDS + ids[a + b] for rank, (a, b) in enumerate(pairs)}
    found = Vocabulary([ids[c] for c in letters], merges, set(), [s["content"] for s in special])
    number = {c: b for b, c in enumerate(letters)}
    for string in ids:
        octets = bytes(number[c] for c in string) if all(c in number for c in string) else b""
        if octets and len(merged(octets, found)) == 1:
            try:
                found.whole.add(octets.decode())
            except UnicodeDecodeError:
                continue  # part of a character: no pre-token
    found.odd = _odd_characters(Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str)
    return found


def _odd_characters(cut: Callable[[str], list]) -> dict[int, str]:
    """Stand-ins for the code points that ``regex`` and the tokenizer put in different classes."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    classes = {k: set(regex.findall(p, every)) for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
    odd = {}
    for char in every:
        ours = next((k for k, members in classes.items() if char in members), "O")
        first = unicodedata.category(char)[0]
        theirs = first if first in "LN" else "S" if ours == "S" else "O"
        if ours != theirs:
            asked = next((k for k in "LNO" if len(cut(_STAND_IN[k] + char)) == 1), "S")
            if asked != ours:
                odd[ord(char)] = _STAND_IN[asked]
    return odd


def merged(octets: bytes, vocabulary: Vocabulary) -> list[int]:
    """Token ids of one pre-token: the pair of least rank, and the first of equals, is merged again and again."""
    ids = [vocabulary.bytes_[b] for b in octets]
    if len(ids) > HEAP_BYTES:
        return _merged_by_heap(ids, vocabulary.merges)
    get = vocabulary.merges.get
    ranks = [get(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
    while ranks:
        least = min(ranks)
        if least == NO_MERGE:
            break
        at = ranks.index(least)
        ids[at : at + 2] = [least % IDS]
        del ranks[at]
        if at < len(ranks):
            ranks[at] = get((ids[at], ids[at + 1]), NO_MERGE)
        if at:
            ranks[at - 1] = get((ids[at - 1], ids[at]), NO_MERGE)
    return ids


def _merged_by_heap(ids: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] >= 0 and (merge := merges.get((ids[at], ids[after[at]]))) is not None:
            heapq.heappush(heap, (merge, at, ids[at], ids[after[at]]))

    for i in range(len(ids) - 1):
        offer(i)
    while heap:
        merge, at, left, right = heapq.heappop(heap)
        follow = after[at]
        if ids[at] != left or follow < 0 or ids[follow] != right:
            continue  # one of the two has been merged since
        ids[at], ids[follow] = merge % IDS, -1
        after[at] = after[follow]
        if after[at] >= 0:
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [i for i in ids if i >= 0]


class Costs(dict):
    """Cost of a pre-token: 1 if it is whole; else its number of tokens, and ``MERGED`` as a mark."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(dict.fromkeys(vocabulary.whole, 1))
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        cost = MERGED + len(merged(word.encode("utf-8", "surrogatepass"), self.vocabulary))
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= len(self.vocabulary.whole) + REMEMBERED:
                self.clear()
                self.update(dict.fromkeys(self.vocabulary.whole, 1))
            self[word] = cost
        return cost


def counter(vocabulary: Vocabulary) -> Callable[[str], tuple[int, int]]:
    """A function from a text to its number of tokens, and of pre-tokens that had to be merged."""
    if vocabulary.costs is None:
        vocabulary.costs = Costs(vocabulary)
    cost, words = vocabulary.costs.__getitem__, regex.compile(PRE_TOKEN)
    longest_first = sorted(vocabulary.special, key=len, reverse=True)
    cuts = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
    odd = frozenset(map(chr, vocabulary.odd))
    # most texts have no character as high as the odd ones
    high = re.compile(f"[{min(odd, default=chr(0x10FFFF))}-\U0010ffff]")

    def summed(part: str) -> int:
        if not part.isascii() and high.search(part) and not odd.isdisjoint(part):
            spans = words.finditer(part.translate(vocabulary.odd))
            return sum(cost(part[m.start() : m.end()]) for m in spans)
        if len(part) > LONG_TEXT:
            return sum(cost(m[0]) for m in words.finditer(part))
        return sum(map(cost, words.findall(part)))

    def count(text: str) -> tuple[int, int]:
        if cuts is None or not cuts.search(text):
            total = summed(text)
        else:
            parts = cuts.split(text)
            total = len(parts) - 1 + sum(map(summed, parts))
        return total % MERGED, total // MERGED

    return count


def count_tokens(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", limit: int = LIMIT, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens``, ``n_merged`` (pre-tokens that are not whole), ``over_limit``.

    Without ``keep_text`` the texts are not carried back from the batches.
    """
    names = {n: free_name(docs, n) for n in ("n_bytes", "n_tokens", "n_merged", "over_limit")}
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    sized = docs.withColumn(names["n_bytes"], F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    kept = [f for f in sized.schema.fields if keep_text or f.name != text]
    added = [T.StructField(names[n], T.LongType()) for n in ("n_tokens", "n_merged")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value)
        for batch in batches:
            found = [count(t or "") for t in batch.column(text).to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array([f[i] for f in found], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), *(f.name for f in added)])

    counted = in_batches(sized, run, T.StructType([*kept, *added]))
    return counted.withColumn(names["over_limit"], F.col(names["n_tokens"]) > limit)


def token_digest(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document its bytes, tokens, merged pre-tokens, and whether it is over the limit."""
    return count_tokens(docs.select("doc_id", "text"), vocabulary, keep_text=False)
