"""Toxicity: a linear-chain conditional random field that tags toxic spans.

Labels say which documents are toxic, not which words. The words of toxic documents are labelled by
a small lexicon that is learned first: greedily, the word or beginning of words that occurs in most
toxic documents which no entry explains yet, as long as it is rare in others. Words that merely stand
in copies of one toxic document explain nothing new and are not taken. A chain of two tags is then
fitted to the labelled tokens by stochastic gradients of its log-likelihood; its features are the word,
its beginnings, its end and its length. Scoring is done where the texts are: forward-backward over all chains of an Arrow batch at
once gives each token's marginal, tokens above one half make spans, and a logistic function of the
marginals' sum, share and maximum and of the number of spans gives the document's score.

Defined cases: a null text is empty; an empty text has no tokens and gets the score of zero sums;
without labels of both kinds every score is the share of toxic labels (0 without labels); repeated
rows get equal scores; all columns of the input pass through, the result's names are free ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import CASED_WORD, in_batches
from hourlake.llm.labels import fold, labelled_texts

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5

FEATURE_BITS = 18
EPOCHS, DOCUMENTS_AT_ONCE, RATE, DECAY = 4, 64, 0.3, 1e-6
#: Beginnings of words of so many characters are features, too.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: A lexicon entry explains so many more toxic documents, and so large a part of its documents is toxic.
LEAST_GAIN, PRECISION, LEXICON = 3, 0.85, 200
#: A toxic document is explained when it has so many entries.
ENTRIES = 3
#: A worker remembers the emissions of so many words.
REMEMBERED = 150_000
#: Chains of texts of about so many bytes are scored together.
BYTES_AT_ONCE = 6 << 20

_WORD = re.compile(CASED_WORD)


def tokens(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def stems(word: str) -> list[str]:
    """The word, and its beginnings, which are marked as such."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n < len(word))]


def lexicon(texts: list[list[str]], toxic: list[int]) -> set[str]:
    """Words and beginnings that explain toxic documents, each some that those before it do not."""

    def inside(text: list[str]) -> set[str]:
        return {s for w in set(text) for s in stems(w)}

    total: Counter[str] = Counter()
    for text, y in zip(texts, toxic, strict=True):
        if y:
            total.update(inside(text))
    likely = {s for s, n in total.items() if n >= LEAST_GAIN}
    total = Counter({s: total[s] for s in likely})
    clean: Counter[str] = Counter()
    for text, y in zip(texts, toxic, strict=True):
        if not y:
            clean.update(inside(text) & likely)
    open_ = [(inside(t) & likely, ENTRIES) for t, y in zip(texts, toxic, strict=True) if y]
    # frequency per document of a kind, so that the balance of the sample has no influence
    n_clean, n_toxic = max(1, toxic.count(0)), max(1, toxic.count(1))

    def precise(word: str) -> bool:
        share, other = total[word] / n_toxic, clean[word] / n_clean
        return share >= PRECISION * (share + other)

    found: set[str] = set()
    while open_ and len(found) < LEXICON:
        counts = Counter(w for words, _ in open_ for w in words)
        # of equally frequent stems the longest: it says most exactly what was seen
        ranked = sorted(
            ((n, total[w], len(w.rstrip("*")), w) for w, n in counts.items() if n >= LEAST_GAIN),
            reverse=True,
        )
        best = next((w for *_, w in ranked if precise(w)), None)
        if best is None:
            break
        found.add(best)
        # an entry explains a document once: what contains it, or is its beginning, is the same find
        open_ = [
            ({w for w in words if not _akin(w, best)}, left - 1) if best in words else (words, left)
            for words, left in open_
        ]
        open_ = [(words, left) for words, left in open_ if left > 0]
    return found


def _akin(a: str, b: str) -> bool:
    a, b = a.rstrip("*"), b.rstrip("*")
    return a.startswith(b) or b.startswith(a)


def features(word: str) -> list[int]:
    size = min(len(word), 12)
    names = [f"w={word}", f"s={word[-3:]}", f"n={size}", *(f"p={word[:n]}" for n in BEGINNINGS)]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) & ((1 << FEATURE_BITS) - 1) for n in names]


@dataclass
class Crf:
    """weights: of tag 1 against tag 0; moves: log potentials of tag pairs; outcome: of the document."""

    weights: np.ndarray
    moves: np.ndarray
    outcome: np.ndarray
    share: float = 0.0

    def emission(self, word: str) -> float:
        return float(self.weights[features(word)].sum())


class Emissions(dict):
    """Emissions by word, computed when first met, forgotten when there are too many."""

    def __init__(self, model: Crf):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = self.model.emission(word)
        return value


def marginals(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(tag 1) of each token of all chains, which stand one after the other in ``emissions``.

    Works on the odds of the two tags, one place of all chains at a time, longest chains first.
    """
    return _odds(emissions, lengths, moves)[0]


def _odds(emissions, lengths, moves):
    """Marginals, forward odds and backward odds."""
    d = np.exp(np.clip(emissions, -30, 30))
    t = np.exp(moves)
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    ahead, back = np.ones(len(d)), np.ones(len(d))
    longest = int(sizes[0]) if len(sizes) else 0
    # number of chains that reach place k
    reach = np.searchsorted(-sizes, -np.arange(longest), side="left")
    odds = np.ones(0)
    for k in range(longest):
        at = starts[: reach[k]] + k
        if k == 0:
            odds = d[at]
        else:
            odds = odds[: reach[k]]
            odds = d[at] * (t[0, 1] + odds * t[1, 1]) / (t[0, 0] + odds * t[1, 0])
        ahead[at] = odds
    for k in range(longest - 2, -1, -1):
        n = reach[k + 1]
        after = starts[:n] + k + 1
        both = d[after] * back[after]
        back[after - 1] = (t[1, 0] + both * t[1, 1]) / (t[0, 0] + both * t[0, 1])
    joint = ahead * back
    return joint / (1 + joint), ahead, back


def _pairs(emissions, lengths, moves):
    """Expected number of each tag pair, over all neighbouring tokens; and marginals."""
    p, ahead, back = _odds(emissions, lengths, moves)
    inner = np.ones(len(p), dtype=bool)
    inner[np.cumsum(lengths) - 1] = False
    left = np.flatnonzero(inner)
    both = np.exp(np.clip(emissions, -30, 30)[left + 1]) * back[left + 1]
    t = np.exp(moves)
    joint = np.stack([np.full(len(left), t[0, 0]), t[0, 1] * both, ahead[left] * t[1, 0], ahead[left] * both * t[1, 1]])
    joint /= joint.sum(axis=0)
    return p, joint.sum(axis=1).reshape(2, 2)


def fit_chain(
    chains: list[tuple[np.ndarray, np.ndarray]], by_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves from chains of (word by token, tag by token), by AdaGrad.

    ``by_word`` has the features of each word.
    """
    weights, moves = np.zeros(1 << FEATURE_BITS), np.zeros((2, 2))
    squares, move_squares = np.full(len(weights), 1e-8), np.full((2, 2), 1e-8)
    shuffled = np.random.default_rng(7)
    for _ in range(EPOCHS):
        order = shuffled.permutation(len(chains))
        for i in range(0, len(order), DOCUMENTS_AT_ONCE):
            part = [chains[j] for j in order[i : i + DOCUMENTS_AT_ONCE]]
            ids = by_word[np.concatenate([w for w, _ in part])]
            tags = np.concatenate([y for _, y in part]).astype(np.int64)
            lengths = np.array([len(y) for _, y in part])
            p, expected = _pairs(weights[ids].sum(axis=1), lengths, moves)
            inner = np.ones(len(tags), dtype=bool)
            inner[np.cumsum(lengths) - 1] = False
            left = np.flatnonzero(inner)
            observed = np.bincount(tags[left] * 2 + tags[left + 1], minlength=4).reshape(2, 2)
            flat = ids.ravel()
            slope = np.bincount(flat, np.repeat((p - tags) / len(part), ids.shape[1]), len(weights))
            used = np.unique(flat)
            g = slope[used] + DECAY * weights[used]
            squares[used] += g**2
            weights[used] -= RATE * g / np.sqrt(squares[used])
            m = (expected - observed) / len(part)
            move_squares += m**2
            moves -= RATE * m / np.sqrt(move_squares)
    return weights, moves


def summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """By chain: 1, logs of the marginals' sum, of the spans, of the sum by token; the maximum."""
    out = np.zeros((len(lengths), 5))
    out[:, 0] = 1
    some = np.flatnonzero(lengths)
    if len(some):
        starts = (np.cumsum(lengths) - lengths)[some]
        total = np.add.reduceat(p, starts)
        out[some, 1] = np.log1p(total)
        out[some, 4] = np.log1p(1000 * total / lengths[some])
        out[some, 2] = np.maximum.reduceat(p, starts)
        tagged = p >= 0.5
        begins = tagged & ~np.concatenate([[False], tagged[:-1]])
        begins[starts] = tagged[starts]
        out[some, 3] = np.log1p(np.add.reduceat(begins.astype(float), starts))
    return out


def fit_outcome(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
    return w


def fit(samples: list[tuple[str, int]]) -> Crf:
    toxic = [int(y) for _, y in samples]
    empty = Crf(np.zeros(1 << FEATURE_BITS), np.zeros((2, 2)), np.zeros(5), float(np.mean(toxic)) if toxic else 0.0)
    if len(set(toxic)) < 2:
        return empty
    known: dict[str, int] = {}
    shared: dict[str, str] = {}
    texts = [[shared.setdefault(w, w) for w in tokens(t)] for t, _ in samples]
    words = lexicon(texts, toxic)
    chains = []
    for text, y in zip(texts, toxic, strict=True):
        if text:
            ids = np.array([known.setdefault(w, len(known)) for w in text], dtype=np.int32)
            tags = [int(bool(y) and not words.isdisjoint(stems(w))) for w in text]
            chains.append((ids, np.array(tags, dtype=np.int8)))
    if not words or not chains:
        return empty
    by_word = np.array([features(w) for w in known], dtype=np.int32)
    weights, moves = fit_chain(chains, by_word)
    model = Crf(weights, moves, np.zeros(5), empty.share)
    lengths = np.array([len(t) for t in texts])
    emitted = Emissions(model)
    p = marginals(np.array([emitted[w] for t in texts for w in t]), lengths, moves)
    model.outcome = fit_outcome(summary(p, lengths), np.array(toxic, dtype=float))
    model.weights = weights.astype(np.float32)
    return model


def score_batch(texts: list[str], model: Crf, emitted: Emissions) -> tuple[np.ndarray, list]:
    """Scores, and by text the spans (start, end, highest marginal) in code points."""
    emissions, lengths = [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = tokens(text)
        lengths[i] = len(words)
        emissions.append(np.fromiter(map(emitted.__getitem__, words), dtype=np.float64, count=len(words)))
    flat = np.concatenate(emissions) if emissions else np.zeros(0)
    p = marginals(flat, lengths, model.moves)
    if model.outcome.any():
        scores = 1 / (1 + np.exp(-np.clip(summary(p, lengths) @ model.outcome, -30, 30)))
    else:
        scores = np.full(len(texts), model.share)
    starts = np.cumsum(lengths) - lengths
    tagged = p >= 0.5
    spans = []
    for i, text in enumerate(texts):
        own = tagged[starts[i] : starts[i] + lengths[i]]
        spans.append(_spans(text, own, p[starts[i] : starts[i] + lengths[i]]) if own.any() else [])
    return scores, spans


def _spans(text: str, tagged: np.ndarray, p: np.ndarray) -> list[dict]:
    places = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tagged.view(np.int8), [0]])))
    return [
        {"start": places[a][0], "end": places[b - 1][1], "marginal": float(p[a:b].max())}
        for a, b in zip(edges[::2], edges[1::2], strict=True)
    ]


SPANS = "array<struct<start:int,end:int,marginal:double>>"


def score(docs: DataFrame, model: Crf, text: str = "text", scored: str = "score", spans: str = "spans") -> DataFrame:
    """``docs`` with a score and toxic spans; all other columns pass through."""
    if {scored, spans} & set(docs.columns):
        raise ValueError("the names of score and spans must be free")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wide = F.array().cast(SPANS)
    schema = docs.withColumns({scored: F.lit(0.0), spans: wide}).schema
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted = Emissions(shared.value)
        for whole in batches:
            sizes = whole.column(whole.schema.get_field_index(text))
            for begin, count in _parts([len(s.as_buffer() or b"") if s.is_valid else 0 for s in sizes]):
                batch = whole.slice(begin, count)
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                scores, found = score_batch(texts, shared.value, emitted)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(scores), pa.array(found, type=arrow)],
                    [*batch.schema.names, scored, spans],
                )

    return in_batches(docs, run, schema)


def _parts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(begin, count) of rows with about BYTES_AT_ONCE bytes of text together."""
    begin = total = 0
    for i, size in enumerate(sizes, 1):
        total += size
        if total >= BYTES_AT_ONCE or i == len(sizes):
            yield begin, i - begin
            begin, total = i, 0


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Crf:
    """The model of a bounded sample of labelled rows outside the held-out fold."""
    return fit(labelled_texts(docs, labels, "toxic", fold(key, FOLDS) != HELD_OUT, key, text))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, learn(docs, labels))
    return scored.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )
