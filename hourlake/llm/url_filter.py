"""URL filter: host rules first, boosted trees on lexical features for the rest.

A rule fits a host, its subdomains, and paths that start with its path. What no rule decides is judged by
gradient-boosted trees (``pyspark.ml``) fitted on labelled URLs; the features are lengths, depths,
ratios, entropy, parameter counts, and statistics of the host's last label and of its first
label's tokens.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule, and is judged
by the method; repeated rows give repeated results; without labelled URLs of both kinds the method
allows; columns of the input other than the URL pass through unless the result has their name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import LOWER, UPPER

BLOCK, ALLOW = "block", "allow"

#: Rules of the query: verdict and host/path.
RULES = [
    (BLOCK, "net/"),
    (ALLOW, "example.net/en/"),
    (BLOCK, "example.com/de/"),
    (ALLOW, "org/fr/"),
]

#: Words by which a blocklist's host names are labelled for training.
LISTED_TERMS = ["adult", "ads", "bets", "casino", "pills", "spam"]

#: At most so many distinct labelled URLs are fitted on.
TRAINING_ROWS = 20_000
TREES, DEPTH, BINS = 20, 3, 32

FEATURES = [
    "host_length",
    "path_length",
    "url_length",
    "host_labels",
    "path_depth",
    "digit_ratio",
    "host_digit_ratio",
    "hyphens",
    "parameters",
    "host_entropy",
    "name_length",
    "name_vowel_ratio",
    "longest_name_token",
    "suffix_length",
    "suffix_share",
]


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def parsed(pages: DataFrame, url: str) -> DataFrame:
    return pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})


def decide_by_rule(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict``; ``pages`` has host and path.

    A rule fits if its host is the URL's host or one of its parents and the path starts with its
    path; of those that fit, the one with the longest text wins. The rules are part of the plan.
    """
    if not rules:
        nothing = F.lit(None).cast("string")
        return pages.withColumns({"rule": nothing, "rule_verdict": nothing})
    labels = F.split(F.col("host"), r"\.")
    parents = F.expr(
        "transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))"
    )
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, text in rules:
        host, path = text.split("/", 1)
        by_host.setdefault(host, []).append(("/" + path, text, verdict))
    fits = F.array(
        *[
            F.when(
                F.array_contains("parents", host) & F.startswith("path", F.lit(path)),
                F.struct(
                    F.length(F.lit(text)).alias("size"),
                    F.lit(text).alias("rule"),
                    F.lit(verdict).alias("rule_verdict"),
                ),
            )
            for host, listed in by_host.items()
            for path, text, verdict in listed
        ]
    )
    return (
        pages.withColumn("labels", labels)
        .withColumn("parents", parents)
        .withColumn("best", F.array_max(fits))
        .withColumns({"rule": F.col("best.rule"), "rule_verdict": F.col("best.rule_verdict")})
        .drop("labels", "parents", "best")
    )


def entropy(text: Column) -> Column:
    """Bits per character, from the counts of the characters that occur."""
    symbols = F.array_distinct(F.split(text, ""))
    n = F.greatest(F.length(text), F.lit(1))

    def part(symbol: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, symbol, F.lit("")))) / n
        return F.when(share > 0, -share * F.log2(share)).otherwise(F.lit(0.0))

    return F.aggregate(F.transform(symbols, part), F.lit(0.0), lambda a, x: a + x)


def _ratio(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def lexical(pages: DataFrame, url: str) -> DataFrame:
    """Adds the features that need nothing but the URL, and its suffix and name."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = F.col("host"), F.col("path")
    labels = F.split(host, r"\.")
    # the label with a hyphen, else the first one that is no service name
    name = F.coalesce(
        F.get(F.filter(labels, lambda x: x.contains("-")), F.lit(0)),
        F.get(F.filter(labels, lambda x: ~x.isin("www", "m", "blog")), F.lit(0)),
        F.lit(""),
    )
    frame = pages.withColumns({"suffix": F.element_at(labels, -1), "name": name})
    name = F.col("name")
    numbers = {
        "host_length": F.length(host),
        "path_length": F.length(path),
        "url_length": F.length(text),
        "host_labels": F.size(labels),
        "path_depth": F.regexp_count(path, F.lit("/")),
        "digit_ratio": _ratio(text, "[0-9]"),
        "host_digit_ratio": _ratio(host, "[0-9]"),
        "hyphens": F.regexp_count(host, F.lit("-")),
        "parameters": F.regexp_count(text, F.lit("[?&][^=&#]*=")),
        "host_entropy": entropy(host),
        "name_length": F.length(name),
        "name_vowel_ratio": _ratio(name, "[aeiou]"),
        "longest_name_token": F.array_max(F.transform(F.split(name, "-"), F.length)),
        "suffix_length": F.length("suffix"),
    }
    return frame.withColumns({k: v.cast("double") for k, v in numbers.items()})


@dataclass
class UrlModel:
    trees: GBTClassificationModel | None = None
    suffixes: DataFrame | None = None
    prior: float = 0.0


def listed(host: Column, terms: list[str]) -> Column:
    """1 where a token of the host's labels is on the list, else 0."""
    tokens = F.split(host, r"[.-]")
    return F.arrays_overlap(tokens, F.array(*[F.lit(t) for t in terms])).cast("int")


def fit(labelled: DataFrame, url: str, label: str, rows: int = TRAINING_ROWS) -> UrlModel:
    """Trees from at most ``rows`` distinct labelled URLs, the smallest by a hash of the URL."""
    sample = parsed(
        labelled.where(F.col(url).isNotNull() & F.col(label).isNotNull())
        .select(F.col(url).alias("url"), F.col(label).cast("double").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("url"))
        .limit(rows),
        "url",
    )
    sample = lexical(sample, "url").persist()
    try:
        kinds = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if set(kinds) != {0.0, 1.0}:
            return UrlModel()
        # smoothed share of positives among the labelled URLs of a suffix
        prior = kinds[1.0] / (kinds[0.0] + kinds[1.0])
        suffixes = sample.groupBy("suffix").agg(
            ((F.sum("label") + 20 * prior) / (F.count("*") + 20)).alias("suffix_share")
        )
        weighted = _assembled(_with_suffix(sample, suffixes, prior)).withColumn(
            "weight", F.when(F.col("label") == 1, 1 / (2 * kinds[1.0])).otherwise(1 / (2 * kinds[0.0]))
        )
        trees = GBTClassifier(
            featuresCol="features", labelCol="label", weightCol="weight",
            maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, stepSize=0.3, seed=7,
            minWeightFractionPerNode=0.001,
        )
        # the shares are few and fixed from here on
        known = suffixes.sparkSession.createDataFrame(
            suffixes.collect() or [], "suffix string, suffix_share double"
        )
        return UrlModel(trees.fit(weighted), known, prior)
    finally:
        sample.unpersist()


def _with_suffix(frame: DataFrame, suffixes: DataFrame, prior: float) -> DataFrame:
    # no more suffixes than rows were fitted on; one suffix may end a third of all URLs
    joined = frame.join(F.broadcast(suffixes), "suffix", "left")
    return joined.withColumn("suffix_share", F.coalesce("suffix_share", F.lit(prior)))


def _assembled(frame: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame)


def judge(pages: DataFrame, model: UrlModel, rules=RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and the method's score (0 to 1, higher: block)."""
    result = ["host", "path", "rule", "verdict", "score"]
    kept = [F.col(f"page.`{c}`").alias(c) for c in pages.columns if c.lower() not in result]
    frame = pages.select(F.struct("*").alias("page"), F.col(url).alias("url"))
    frame = decide_by_rule(parsed(frame, "url"), rules)
    if model.trees is None:
        scored = frame.withColumn("score", F.lit(0.0))
    else:
        featured = _assembled(_with_suffix(lexical(frame, "url"), model.suffixes, model.prior))
        scored = model.trees.transform(featured).withColumn(
            "score", vector_to_array("probability")[1]
        )
    by_method = F.when(F.col("score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.withColumn("verdict", F.coalesce("rule_verdict", by_method)).select(*kept, *result)


def filter_urls(pages: DataFrame, rules=RULES, terms=LISTED_TERMS, url: str = "url") -> DataFrame:
    """Fit on the URLs that no rule decides, labelled by a list of host words, and judge all."""
    named = decide_by_rule(parsed(pages.select(F.col(url).alias("url")), "url"), rules)
    labelled = named.where(F.col("rule").isNull() & (F.col("host") != "")).select(
        "url", listed(F.col("host"), terms).alias("label")
    )
    return judge(pages, fit(labelled, "url", "label"), rules, url)
