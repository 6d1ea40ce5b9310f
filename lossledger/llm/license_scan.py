"""License scans as an exact set-similarity join between text blocks and license templates.

Token sets are ordered by global frequency, rarest first. A text block that holds at least `threshold` of a
template's tokens must hold one of the template's first |T| - need + 1 tokens (prefix filter), at least `need`
known tokens (length filter), and enough known tokens at or after the shared one in the global order (positional
filter). Blocks that pass are verified on their full sets. A phrase is a template whose tokens all have to be
there, next to each other: its prefix is its rarest token, and the exact check compares the words in place.

The template list is a parameter of fixed size; it is the broadcast side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.llm.common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices whose wording may vary; labels of the method's own.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under the apache license version 2 0": "apache-2-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4-notice",
    "licensed under a creative commons attribution share alike 4 0 international license": "cc-by-sa-4-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-notice",
    "this source code form is subject to the terms of the mozilla public license": "mpl-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
}
THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrase: bool

    @property
    def tokens(self) -> frozenset[str]:
        return frozenset(self.words)

    def need(self, threshold: float) -> int:
        """The smallest number of shared tokens that reaches the threshold."""
        n = len(self.tokens)
        return n if self.phrase else next(k for k in range(n + 1) if k >= threshold * n - 1e-9)


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[Template]:
    made = [Template(label, tuple(text.split()), True) for text, label in phrases.items()]
    return made + [Template(label, tuple(text.split()), False) for text, label in notices.items()]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def token_order(docs: DataFrame, known: list[str]) -> list[str]:
    """`known` tokens by how many words of all documents they are, rarest first, ties by token."""
    words = docs.select(F.explode(words_of(F.col("text"))).alias("token")).filter(F.col("token").isin(known))
    counts = {r["token"]: r["count"] for r in words.groupBy("token").count().collect()}  # at most one row per known token
    return sorted(known, key=lambda t: (counts.get(t, 0), t))



def prefix_index(order: list[str], made: list[Template], threshold: float) -> list[dict]:
    """One entry per template and prefix token: token, rank in the global order, offset in a phrase."""
    rank = {t: i for i, t in enumerate(order)}
    index = []
    for t in made:
        need, ordered = t.need(threshold), sorted(t.tokens, key=rank.get)
        for position, token in enumerate(ordered[: len(ordered) - need + 1]):
            index.append({
                "token": token, "rank": rank[token], "position": position, "offset": t.words.index(token),
                "label": t.label, "phrase": t.phrase, "need": need, "words": list(t.words), "tokens": ordered,
            })
    return index


INDEX_SCHEMA = (
    "token string, rank int, position int, offset int, label string, phrase boolean, need int, "
    "words array<string>, tokens array<string>"
)


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A place is a start position of a phrase; positions count words from 0. `labels` adds the notices found in any
    block of words; `score` is the largest share of a template's tokens found (1 for a phrase), 0 if nothing was
    found. A block is `2 * longest template` words, one at every multiple of half that, so each run of as many
    words as the longest template lies in one. Null and empty texts have no words and no places; repeated rows
    and doc_ids are rows of their own.
    """
    spark = docs.sparkSession
    made = templates(phrases, notices)
    known = sorted(set().union(*[t.tokens for t in made]))
    order = token_order(docs, known)
    index = prefix_index(order, made, threshold)
    prefix_tokens = sorted({e["token"] for e in index})
    half = max(len(t.words) for t in made)
    ranks = F.create_map(*[x for i, t in enumerate(order) for x in (F.lit(t), F.lit(i))])

    words = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words")
    )
    n = F.size("words")

    def sighting(i: Column) -> Column:
        """A prefix token with the words of its two blocks: enough to check every template there."""
        first = F.greatest(F.floor(i / half).cast("int") - 1, F.lit(0)) * half
        return F.struct(
            i.alias("at"), first.alias("first"), F.get("words", i).alias("token"),
            F.slice("words", first + 1, F.lit(3 * half)).alias("near"),
        )

    hits = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", i).isin(prefix_tokens))
    seen = words.select(
        "doc_id", "row", n.cast("bigint").alias("n_words"),
        F.explode_outer(F.when(n > 0, F.transform(hits, sighting))).alias("s"),
    ).select("doc_id", "row", "n_words", "s.*")

    table = F.broadcast(spark.createDataFrame(index, INDEX_SCHEMA))
    candidates = seen.join(table, "token", "left")
    # Phrases: the words in place. `near` begins at word `first`.
    start = F.col("at") - F.col("offset")
    inside = start - F.col("first")
    in_place = (inside >= 0) & (
        F.slice("near", F.greatest(inside, F.lit(0)) + 1, F.size("template_words")) == F.col("template_words")
    )
    # Notices: both blocks with the sighting in them.
    blocks = F.array(*[F.slice("near", 1 + k * half, F.lit(2 * half)) for k in (0, 1)])

    def shared(block: Column) -> Column:
        has = F.array_distinct(F.filter(block, lambda w: w.isin(known)))
        later = F.size(F.filter(has, lambda w: F.element_at(ranks, w) >= F.col("rank")))
        possible = (
            F.array_contains(block, F.col("token"))
            & (F.size(has) >= F.col("need"))
            & (F.col("position") + later >= F.col("need"))
        )
        return F.when(possible, F.size(F.array_intersect("tokens", has))).otherwise(0)

    best = F.array_max(F.transform(blocks, shared))
    checked = candidates.withColumnRenamed("words", "template_words").select(
        "doc_id", "row", "n_words", "label", "phrase",
        F.when(F.col("phrase") & in_place, start).cast("bigint").alias("place"),
        F.when(~F.col("phrase"), F.when(best >= F.col("need"), best / F.size("tokens"))).alias("share"),
    )
    found = F.col("place").isNotNull() | F.col("share").isNotNull()
    places = checked.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"),
        F.count("place").alias("n_base"),
        F.min("place").alias("first_word"),
        F.max("place").alias("last_word"),
        _joined(F.collect_set(F.when(F.col("place").isNotNull(), F.col("label")))).alias("base_labels"),
        _joined(F.collect_set(F.when(found, F.col("label")))).alias("labels"),
        F.coalesce(
            F.max(F.when(F.col("place").isNotNull(), F.lit(1.0)).otherwise(F.col("share"))), F.lit(0.0)
        ).alias("score"),
    )
    return places.drop("row")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(labels), ",")
