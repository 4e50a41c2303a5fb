"""License scan: a positional index of rare license words.

Templates are indexed by word and position. One pass over the documents keeps, of each text, its
word count and the places of words that the index knows; all else works on these short lists.
The document frequency of the index words is counted over all documents. The words of highest IDF
of each template nominate (template, place in the document minus place in the template); so many of
them do that the others do not reach the share without them. At each nominated place all words
that stand as in the template agree. A template is found where the agreeing words hold enough of
its IDF and its key phrases stand at that very place.

Defined cases: a null or empty text has no words and no labels; a template is counted once per
place; documents with equal ids are told apart; no documents give no rows; columns of the input
other than the id and the text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import stored, words_of

#: Phrases whose places are counted word by word, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, usual notice, key phrases that must stand in it.
TEMPLATES = [
    (
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ["gnu general public license", "version 3"],
    ),
    (
        "gpl-2.0",
        "this work is licensed under the gnu general public license version 2",
        ["gnu general public license", "version 2"],
    ),
    (
        "lgpl",
        "licensed under the gnu lesser general public license",
        ["gnu lesser general public license"],
    ),
    (
        "agpl",
        "licensed under the gnu affero general public license",
        ["gnu affero general public license"],
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0",
        ["apache license", "version 2 0"],
    ),
    ("mit", "released under the mit license", ["mit license"]),
    ("bsd", "redistributed under the bsd license", ["bsd license"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ["cc0"]),
]

#: Too frequent everywhere to tell a license; not indexed.
FUNCTION_WORDS = ["this", "is", "the", "to", "of", "under"]

#: Only after the word given: they are frequent outside licenses.
ONLY_AFTER = {"by": "cc"}

#: The share of a template's IDF that agreeing words must hold.
SHARE = 0.6


def postings(templates=TEMPLATES) -> list[tuple[str, str, int]]:
    return [
        (word, label, place)
        for label, text, _ in templates
        for place, word in enumerate(text.split())
        if word not in FUNCTION_WORDS
    ]


def index_words(templates, phrases) -> list[str]:
    words = {w for w, _, _ in postings(templates)} | {w for p in phrases for w in p.split()}
    return sorted(words)


def scanned(docs: DataFrame, text: str, known: list[str]) -> DataFrame:
    """``n_words`` and ``hits``, the places and words that the index knows."""
    free = [w for w in known if w not in ONLY_AFTER]
    listed = ", ".join(f"'{w}'" for w in free)
    after = " or ".join(
        f"(words[i] = '{w}' and i > 0 and words[i - 1] = '{before}')"
        for w, before in ONLY_AFTER.items()
        if w in known
    )
    test = f"words[i] in ({listed})" + (f" or {after}" if after else "")
    places = F.expr(
        "case when size(words) = 0 then array() else "
        f"filter(sequence(0, size(words) - 1), i -> {test}) end"
    )
    return (
        docs.withColumn("words", words_of(F.col(text)))
        .withColumn("places", places.cast("array<int>"))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("hits", F.expr("transform(places, i -> struct(i as place, words[i] as word))"))
        .drop("words", "places")
    )


def phrase_places(phrase: str, hits: str = "hits") -> Column:
    """Where the words of ``phrase`` stand one after the other, from the listed hits."""
    words = phrase.split()
    follow = " and ".join(
        [f"h.word = '{words[0]}'"]
        + [
            f"get({hits}, k + {n}).word = '{w}' and get({hits}, k + {n}).place = h.place + {n}"
            for n, w in enumerate(words[1:], 1)
        ]
    )
    return F.expr(f"transform(filter({hits}, (h, k) -> {follow}), h -> h.place)")


def nominators(entries: list[tuple[str, int, float]]) -> list[tuple[str, int, float]]:
    """Of one template's words: those of highest IDF, until the others hold less than the share."""
    ordered = sorted(entries, key=lambda e: (-e[2], e[1]))
    # a little less, so that rounding of sums loses no place
    least = (SHARE - 1e-9) * sum(e[2] for e in entries)
    taken = 0
    while sum(e[2] for e in ordered[taken:]) >= least:
        taken += 1
    return ordered[:taken]


def template_scores(hits: DataFrame, templates, total: int) -> DataFrame:
    """Per document: ``labels`` and ``score`` of the templates found. ``hits`` has row and hits."""
    spark = hits.sparkSession
    # one row per index word: at most as many as the templates have
    frequency = {
        r["word"]: r["n"]
        for r in hits.select(F.explode(F.array_distinct("hits.word")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    by_label: dict[str, list[tuple[str, int, float]]] = {}
    for word, label, place in postings(templates):
        idf = math.log((total + 1) / (frequency.get(word, 0) + 1)) + 1
        by_label.setdefault(label, []).append((word, place, idf))
    nominating = [
        (word, label, place, sum(e[2] for e in entries), entries)
        for label, entries in by_label.items()
        for word, place, _ in nominators(entries)
    ]
    index = spark.createDataFrame(
        nominating,
        "word string, label string, at int, whole double, "
        "template array<struct<word:string,at:int,idf:double>>",
    )
    # no place has two words, so all of a template around a hit is among as many hits to each side
    longest = max(len(text.split()) for _, text, _ in templates)
    listed = ", ".join(f"'{w}'" for w in sorted({e[0] for e in nominating}))
    around = f"slice(hits, greatest(k + 2 - {longest}, 1), least(k, {longest - 1}) + {longest})"
    nominated = (
        hits.select(
            "row",
            F.explode(
                F.expr(
                    f"filter(transform(hits, (h, k) -> case when h.word in ({listed}) then "
                    f"struct(h.word as word, h.place as place, {around} as near) end), x -> x is not null)"
                )
            ).alias("h"),
        )
        .select("row", "h.*")
        .join(F.broadcast(index), "word")
        .withColumn("start", F.col("place") - F.col("at"))
    )
    agreed = F.expr(
        "aggregate(template, 0D, (a, t) -> a + case when exists(near, "
        "n -> n.place = start + t.at and n.word = t.word) then t.idf else 0D end)"
    )
    likely = nominated.withColumn("share", agreed / F.col("whole")).where(F.col("share") >= SHARE)
    # every key phrase of the template must stand at its place
    keys = [
        (label, phrase, _place_of(phrase.split(), text.split()))
        for label, text, phrases in templates
        for phrase in phrases
    ]
    verified = F.lit(True)
    for label, phrase, place in keys:
        standing = F.array_contains(phrase_places(phrase, "near"), F.col("start") + place)
        verified = verified & ((F.col("label") != label) | standing)
    return (
        likely.where(verified)
        .groupBy("row")
        .agg(F.collect_set("label").alias("found"), F.max("share").alias("score"))
        .withColumn("score", F.least("score", F.lit(1.0)))
    )


def _place_of(phrase: list[str], text: list[str]) -> int:
    return next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)


def scan_licenses(
    docs: DataFrame, text: str = "text", key: str = "doc_id", templates=TEMPLATES, phrases=PHRASES
) -> DataFrame:
    """Per document: its key, n_words, places of each phrase, labels and score."""
    known = index_words(templates, phrases)
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = stored(
        scanned(source, "text", known).select(
            F.monotonically_increasing_id().alias("row"), "key", "n_words", "hits"
        ),
        "license-hits",
    )
    found = template_scores(rows.where(F.size("hits") > 0), templates, rows.count())
    places = F.array(
        *[
            F.struct(F.lit(label).alias("label"), phrase_places(p).alias("places"))
            for p, label in phrases.items()
        ]
    )
    return (
        rows.join(found, "row", "left")
        .withColumn("phrases", F.filter(places, lambda x: F.size(x["places"]) > 0))
        .select(
            F.col("key").alias(key),
            "n_words",
            "phrases",
            F.coalesce("found", F.array().cast("array<string>")).alias("found"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )


def license_digest(docs: DataFrame) -> DataFrame:
    scan = scan_licenses(docs)
    starts = F.flatten("phrases.places")
    base = F.sort_array(F.array_distinct("phrases.label"))
    return scan.withColumn("starts", starts).select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat("phrases.label", "found"))), ",").alias("labels"),
        "score",
    )
