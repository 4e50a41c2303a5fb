"""Quality classifier: a generalised additive model with pairwise interactions.

Numbers that describe a text are cut into bins by quantiles. Boosting goes round the features: in
each turn a small tree over one feature's bins is fitted to the gradient and added, damped, to that
feature's lookup table. Then the pairs of features that explain most of what is left get tables over
two features, learned in the same way. A document's score is the logistic function of the sum of its
table entries, so scoring a batch is one gather per table.

Defined cases: a null text is empty; an empty text has zeros for all features; without labels of both
kinds every score is the share of positive labels (1 without labels, so that nothing is thrown away
unlearned); repeated rows get equal scores; all other columns pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import in_batches
from hourlake.llm.labels import fold, labelled_texts

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, LEAVES, RATE = 150, 100, 3, 0.1
#: Weight of a leaf that counts against its gradient.
SHRINK, LEAST_ROWS = 5.0, 5

FEATURES = [
    "words",
    "word_length",
    "distinct_words",
    "commonest_word",
    "repeated_in_a_row",
    "capitals",
    "digits",
    "marks",
    "bars",
    "exclamations",
    "not_ascii",
    "lines",
    "distinct_lines",
    "words_by_line",
    "ends_of_sentences",
    "longest_word",
]

_KINDS = np.zeros((7, 256))
_KINDS[0, 65:91] = 1
_KINDS[1, 48:58] = 1
for _c in b"#$%&*@^~=+<>{}[]\\/_":
    _KINDS[2, _c] = 1
_KINDS[3, ord("|")] = 1
_KINDS[4, ord("!")] = 1
_KINDS[5, 128:] = 1
_KINDS[6, ord(".")] = 1


def describe(text: str) -> list[float]:
    """The features of one text, in their order."""
    octets = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    capitals, digits, marks, bars, exclamations, foreign, ends = (
        _KINDS @ np.bincount(octets, minlength=256) / len(octets)
    )
    counts = Counter(words)
    lines = text.split("\n")
    sizes = list(map(len, words))
    twice = sum(map(str.__eq__, words, words[1:]))
    return [
        float(n),
        sum(sizes) / n,
        len(counts) / n,
        max(counts.values()) / n,
        twice / n,
        capitals,
        digits,
        marks,
        bars,
        exclamations,
        foreign,
        float(len(lines)),
        len(set(lines)) / len(lines),
        n / len(lines),
        ends * len(octets) / n,
        float(max(sizes)),
    ]


def described(texts: list[str]) -> np.ndarray:
    return np.array([describe(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class Additive:
    """edges: by feature; tables: by feature; pairs: (i, j, table); share: if nothing was learned."""

    share: float
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.tables:
            return np.full(len(x), self.share)
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], side="right")]
        for i, j, table in self.pairs:
            a = np.searchsorted(self.coarse[i], x[:, i], side="right")
            b = np.searchsorted(self.coarse[j], x[:, j], side="right")
            total += table[a, b]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g**2 / (h + SHRINK)


def tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values by bin of a tree of few leaves: the best split again and again, by Newton gain."""
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        best = (1e-9, 0, 0)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            left_g, left_h, left_n = (np.cumsum(v[a : b - 1]) for v in (g, h, n))
            all_g, all_h, all_n = g[a:b].sum(), h[a:b].sum(), n[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            gains[(left_n < LEAST_ROWS) | (all_n - left_n < LEAST_ROWS)] = 0
            at = int(gains.argmax())
            best = max(best, (float(gains[at]), k, a + at + 1))
        if not best[2]:
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SHRINK)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut in both directions: gain and values of its four quarters, by cell."""
    cg, ch, cn = (v.cumsum(0).cumsum(1) for v in (g, h, n))
    best, out = 0.0, np.zeros_like(g)
    whole = _gain(cg[-1, -1], ch[-1, -1])
    quarters = []
    for c in (cg, ch, cn):
        nw = c[:-1, :-1]
        ne, sw = c[:-1, -1:] - nw, c[-1:, :-1] - nw
        quarters.append((nw, ne, sw, c[-1, -1] - nw - ne - sw))
    if not quarters[0][0].size:
        return best, out
    gains = sum(_gain(a, b) for a, b in zip(quarters[0], quarters[1], strict=True)) - whole
    at = np.unravel_index(int(gains.argmax()), gains.shape)
    if gains[at] > 0:
        best = float(gains[at])
        v = [a[at] / (b[at] + SHRINK) for a, b in zip(quarters[0], quarters[1], strict=True)]
        i, j = at[0] + 1, at[1] + 1
        out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = v
    return best, out


def fit(samples: list[tuple[str, int]]) -> Additive:
    y = np.array([float(bool(v)) for _, v in samples])
    if len(set(y.tolist())) < 2:
        return Additive(share=float(y.mean()) if len(y) else 1.0)
    return fit_table(described([t for t, _ in samples]), y)


def fit_table(x: np.ndarray, y: np.ndarray) -> Additive:
    share = float(y.mean())
    model = Additive(share, base=float(np.log(share / (1 - share))))
    count = x.shape[1]
    model.edges = [_edges(x[:, k], BINS) for k in range(count)]
    model.coarse = [_edges(x[:, k], PAIR_BINS) for k in range(count)]
    fine = [np.searchsorted(model.edges[k], x[:, k], side="right") for k in range(count)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(fine, model.tables, strict=True)]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * tree(
                np.bincount(fine[k], g, len(table)), np.bincount(fine[k], h, len(table)), sizes[k]
            )
            table += step
            total += step[fine[k]]
    cells = {}
    for i in range(count):
        for j in range(i + 1, count):
            shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
            a = np.searchsorted(model.coarse[i], x[:, i], side="right")
            b = np.searchsorted(model.coarse[j], x[:, j], side="right")
            cells[i, j] = (a * shape[1] + b, shape)

    def sums(cell, shape, values):
        return np.bincount(cell, values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ones = np.ones(len(y))
    gains = {
        pair: pair_tree(sums(c, s, g), sums(c, s, h), sums(c, s, ones))[0] for pair, (c, s) in cells.items()
    }
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pairs = [(i, j, np.zeros(cells[i, j][1])) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            cell, shape = cells[i, j]
            g, h = slopes()
            step = RATE * pair_tree(sums(cell, shape, g), sums(cell, shape, h), sums(cell, shape, ones))[1]
            table += step
            total += step.ravel()[cell]
    return model


def score(docs: DataFrame, model: Additive, text: str = "text", scored: str = "score") -> DataFrame:
    """``docs`` with a score; all other columns pass through."""
    if scored in docs.columns:
        raise ValueError("the name of the score must be free")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            scores = shared.value.score(described([t or "" for t in texts]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, scored])

    return in_batches(docs, run, docs.withColumn(scored, F.lit(0.0)).schema)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Additive:
    """The model of a bounded sample of labelled rows outside the held-out fold."""
    return fit(labelled_texts(docs, labels, "quality", fold(key, FOLDS) != HELD_OUT, key, text))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, learn(docs, labels))
    return scored.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
