"""Secret scan: three fixed patterns, and random strings told from identifiers by Markov models.

The fixed patterns are matched over whole texts; Spark gives the matches and, by ``split``, what
stands between them, so their places are sums of lengths inside the row. The method looks at runs
of at least ``LENGTH`` characters of ``ALPHABET``: two first-order Markov models of characters, one
of random strings and one of ordinary identifiers, are counted from labelled samples, and a run is
a finding if its log-likelihood ratio is high in total and by character. All of it stays in the
row; only the counts of character pairs are aggregated.

A text may be one run, or have very many findings. Characters are looked at once, and sums and maxima over
the matches of a text are taken in blocks (``common.scan_before``), so no step goes through a text, or copies a list of
findings, once for each finding.

Identifiers that are long enough to be findings teach the second model only if a first one, which has seen
short ones alone, does not call them random: random strings that no pattern names are not taught as ordinary.

Defined cases: a null text is empty; without labelled samples a model is uniform; a run that fixed
findings cover wholly is not reported twice, one that reaches past them is reported with its whole
span; repeated rows give repeated results, and repeated texts are learned from once; ``redact`` keeps all
columns and replaces the texts' findings.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import SPAN, free_name, let, scan_before, segments, stored

#: Kinds in the order in which equal starts are listed: pattern, group and length that count.
KINDS = {
    "assign": (
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    # a run of 32 or more is the same match as a longer run of any length
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
RANDOM = "random"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
LENGTH = 16
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}=*"
#: Ordinary identifiers to learn from: words and numbers, with underscores and hyphens.
IDENTIFIER = r"[A-Za-z0-9][A-Za-z0-9_-]{5,}"

#: Expected number of documents whose labelled strings are counted (of equal texts one), and their length at most.
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 5_000, 200_000
#: Characters of a block of a text that is cut at its findings.
BLOCK_CHARS = 4_096
#: A finding's log-likelihood ratio in nats: in total, and per character.
TOTAL, PER_PAIR = 12.0, 0.6

def _empty() -> Column:
    return F.array().cast("array<string>")


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _may_match(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match of the kind passes."""
    if kind == "assign":
        return text.contains(":") | text.contains("=")
    if kind == "access":
        return text.contains("AKIA")
    return F.lit(True)


def _places(matches: str, between: str) -> Column:
    """Start and end of each match: lengths of all that stands before, added up."""
    sizes = f"transform({matches}, (m, i) -> length({between}[i]) + length(m))"
    spans = f"""transform(before, (p, i) -> named_struct(
        'start', p + length({between}[i]), 'past', p + length({between}[i]) + length({matches}[i])))"""
    return F.expr(let("before", scan_before(sizes, "0", lambda a, x: f"{a} + {x}"), spans))


def _found(frame: DataFrame, name: str, text: str, pattern: str, group: int, may: Column) -> DataFrame:
    """Adds ``name`` (spans of all matches) and ``name_value`` (the group that counts)."""
    frame = frame.withColumn("m", F.when(may, _matches(F.col(text), pattern)).otherwise(_empty()))
    some = F.size("m") > 0
    value = F.col("m") if group == 0 else F.when(some, _matches(F.col(text), pattern, group)).otherwise(_empty())
    frame = frame.withColumns(
        {"between": F.when(some, F.split(F.col(text), pattern, -1)), f"{name}_value": value}
    )
    spans = F.when(some, _places("m", "between")).otherwise(F.array().cast(SPAN))
    return frame.withColumn(name, spans).drop("m", "between")


def base_findings(frame: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``assign``, ``access`` and ``hex``: spans with the value that makes them count."""
    for kind, (pattern, group, least) in KINDS.items():
        frame = _found(frame, kind, text, pattern, group, _may_match(kind, F.col(text)))
        kept = F.expr(
            f"filter(transform({kind}, (x, i) -> struct(x as span, {kind}_value[i] as value)), "
            f"x -> length(x.value) >= {least})"
        )
        frame = frame.withColumn(kind, kept).drop(f"{kind}_value")
    return frame


def pair_counts(labelled: DataFrame) -> dict[tuple[int, str], int]:
    """Counts of (label, pair of characters) in strings with a label; at most a few thousand."""
    pairs = "transform(slice(c, 1, size(c) - 1), (x, i) -> concat(x, c[i + 1]))"
    pairs = labelled.where(F.length("string") >= 2).select(
        "label", F.explode(F.expr(let("c", "split(string, '')", pairs))).alias("pair")
    )
    counts = pairs.groupBy("label", "pair").agg(F.count("*").alias("n"))
    inside = F.col("pair").rlike(r"\A[A-Za-z0-9+/_=-]{2}\z")
    return {(r["label"], r["pair"]): r["n"] for r in counts.where(inside).collect()}


def ratios(counts: dict[tuple[int, str], int]) -> list[float]:
    """log P(b|a, random) / P(b|a, identifier) for each pair, in the alphabet's order.

    Each model starts from one pseudo-count per pair. The random one starts from a uniform row
    that weighs as much as its samples, since few samples cannot show all pairs.
    """
    size = len(ALPHABET)
    seen = sum(n for (label, _), n in counts.items() if label == 1)
    weight = {1: max(1.0, seen / size**2), 0: 0.1}
    table = []
    for a in ALPHABET:
        rows = {}
        for label in (0, 1):
            row = [counts.get((label, a + b), 0) + weight[label] for b in ALPHABET]
            rows[label] = [x / sum(row) for x in row]
        table += [math.log(p / q) for p, q in zip(rows[1], rows[0], strict=True)]
    return table


def labelled_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Samples: values of the fixed findings (1) and other identifiers (0) of sampled documents."""
    total = max(1, docs.count())
    share = min(1.0, SAMPLE_DOCUMENTS / total)
    sampled = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).where(
        (F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))
        & (F.octet_length("text") <= SAMPLE_BYTES)
    )
    frame = base_findings(sampled.distinct())
    values = F.flatten(F.array(*[F.transform(k, lambda x: x["value"]) for k in KINDS]))
    frame = frame.withColumn("values", values).withColumn(
        "others", F.array_except(_matches(F.col("text"), IDENTIFIER), F.col("values"))
    )
    # parts of a value, or of a run with a value in it, are no ordinary identifiers either
    runs = F.when(F.size("values") > 0, _matches(F.col("text"), RUN)).otherwise(_empty())
    frame = frame.withColumn("runs", runs).withColumn(
        "secret", F.expr("concat(values, filter(runs, r -> exists(values, v -> contains(r, v))))")
    )
    others = F.expr("filter(others, x -> not exists(secret, s -> contains(s, x)))")
    both = F.concat(
        F.transform("values", lambda x: F.struct(F.lit(1).alias("label"), x.alias("string"))),
        F.transform(others, lambda x: F.struct(F.lit(0).alias("label"), x.alias("string"))),
    )
    return frame.select(F.explode(both).alias("s")).select("s.*")


def _ratio(run: str, model: list[float]) -> str:
    """Log-likelihood ratio of a run: its characters become numbers once, and pairs of them places in a table."""
    codes = [0] * 128
    for i, character in enumerate(ALPHABET):
        codes[ord(character)] = i
    numbers = f"transform(split({run}, ''), x -> array({', '.join(map(str, codes))})[ascii(x)])"
    table = "array(" + ", ".join(f"{x:.6f}D" for x in model) + ")"
    step = f"named_struct('sum', a.sum + {table}[a.last * {len(ALPHABET)} + x], 'last', x)"
    total = f"aggregate(slice(c, 2, size(c)), named_struct('sum', 0D, 'last', c[0]), (a, x) -> {step}, a -> a.sum)"
    return let("c", numbers, total)


def _is_random(score: str, run: str) -> str:
    return f"({score} >= {TOTAL} and {score} >= {PER_PAIR} * (length({run}) - 1))"


def learn(docs: DataFrame, text: str = "text") -> list[float]:
    """The two models, as ratios, from the documents' own labelled strings."""
    labelled = stored(labelled_strings(docs, text), "strings")
    long_ = (F.col("label") == 0) & (F.length("string") >= LENGTH)
    counts = pair_counts(labelled.where(~long_))
    scored = labelled.where(long_).withColumn("score", F.expr(_ratio("string", ratios(counts))))
    ordinary = scored.where(f"not {_is_random('score', 'string')}")
    for pair, n in pair_counts(ordinary).items():
        counts[pair] = counts.get(pair, 0) + n
    return ratios(counts)


def scan_secrets(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``findings``: kind, start, end (code points) and value, by start and kind."""
    result = free_name(docs, "findings")
    frame = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    frame = base_findings(frame)
    fixed = F.expr(
        "concat("
        + ", ".join(
            f"transform({kind}, x -> struct(x.span.start as start, {i} as order, "
            f"x.span.past as past, '{kind}' as kind, x.value as value))"
            for i, kind in enumerate(KINDS)
        )
        + ")"
    )
    frame = _found(frame.withColumn("fixed", F.array_sort(fixed)), "runs", "text", RUN, 0, F.lit(True))
    scored = F.expr(f"transform(runs_value, v -> {_ratio('v', model)})")
    found = f"""filter(arrays_zip(runs, runs_value, scores),
        x -> {_is_random('x.scores', 'x.runs_value')})"""
    frame = frame.withColumn("scores", scored).withColumn("high", F.expr(found))
    # the parts of what fixed findings cover; only few texts have both these and high scores
    both = (F.size("high") > 0) & (F.size("fixed") > 0)
    parts = F.when(both, F.expr(segments("fixed", True))).otherwise(F.array().cast(SPAN))
    frame = frame.withColumn("parts", parts)
    # the first part that ends after the run's start, by halving
    first = """aggregate(sequence(1, 31), named_struct('low', 0, 'past', size(parts)), (a, i) ->
        case when a.low >= a.past then a
             when parts[(a.low + a.past) div 2].past > x.runs.start
               then named_struct('low', a.low, 'past', cast((a.low + a.past) div 2 as int))
             else named_struct('low', cast((a.low + a.past) div 2 as int) + 1, 'past', a.past) end, a -> a.low)"""
    part = let("p", f"get(parts, {first})", "coalesce(p.start <= x.runs.start and p.past >= x.runs.past, false)")
    random = F.expr(
        f"""transform(filter(high, x -> size(parts) = 0 or not {part}),
            x -> struct(x.runs.start as start, {len(KINDS)} as order, x.runs.past as past,
                        '{RANDOM}' as kind, x.runs_value as value))"""
    )
    return (
        frame.withColumn("found", F.array_sort(F.concat("fixed", random)))
        .select("doc.*", F.col("found").alias(result))
    )


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Learn the two models from the documents' own labelled strings and scan all documents."""
    return scan_secrets(docs, learn(docs, text), text)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with each finding replaced; where findings overlap, their union is."""
    name = free_name(docs, "findings")
    found = find_secrets(docs, text)
    # pieces between the parts of the union, out of blocks of the text: a block is gone through, not the text
    piece = f"""array_join(transform(sequence(low div {BLOCK_CHARS}, (past - 1) div {BLOCK_CHARS}), k -> {let(
        "l", f"cast(greatest(low - k * {BLOCK_CHARS}, 0) as int)",
        f"substr(blocks[cast(k as int)], l + 1, cast(least(past - k * {BLOCK_CHARS}, {BLOCK_CHARS}) as int) - l)",
    )}), '')"""
    piece = let("past", "coalesce(parts[i].start, size)", f"case when low >= past then '' else {piece} end")
    piece = let("low", "case when i = 0 then 0 else parts[i - 1].past end", piece)
    joined = f"array_join(transform(sequence(0, size(parts)), i -> {piece.replace('parts[i]', 'get(parts, i)')}), '{mark}')"
    cut = let("size", f"length(`{text}`)", joined)
    cut = let("blocks", f"regexp_extract_all(`{text}`, '(?s).{{1,{BLOCK_CHARS}}}', 0)", cut)
    cut = F.expr(let("parts", segments(f"`{name}`", False), cut))
    return found.withColumn(
        text, F.when(F.size(name) > 0, cut).otherwise(F.col(text))
    ).select(*docs.columns)


def _joined(found: Column) -> Column:
    lines = F.transform(
        found,
        lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["past"].cast("string")),
    )
    return F.array_join(lines, ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    found = find_secrets(docs)
    base = F.filter("findings", lambda f: f["kind"] != RANDOM)
    counts = [
        F.expr(f"cast(size(filter(findings, f -> f.kind = '{k}')) as bigint)").alias(f"n_{k}")
        for k in KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("findings")).alias("spans"),
    )
