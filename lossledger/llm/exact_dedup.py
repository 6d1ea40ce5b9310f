"""Exact duplicates by deterministic block naming.

Texts are cut into fixed-size blocks. Sorting the distinct blocks gives each an integer name; then adjacent
names are paired, the distinct pairs sorted and named, and so on until a document has one name. Two documents
have the same (level, name) if and only if their texts are equal: names are ranks of compared contents, not
hashes.

The long block strings cross the network once. For that, a block is first represented by a 64-bit value, and the
distinct blocks are compared to prove that no two of them share one; if two did, another seed is taken. Sorting
and naming then moves only integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.llm.common import sorted_names, stored, with_keys

BLOCK_CHARS = 8192
MAX_SEEDS = 8


def blocks_of(text: Column, block_chars: int) -> Column:
    """array<string> of consecutive blocks; the empty text has one empty block."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.char_length(text) <= block_chars, F.array(text)).otherwise(found)


def block_values(blocks: Column, seed: int) -> Column:
    return F.transform(blocks, lambda b: F.xxhash64(F.lit(seed), b))


def colliding(docs: DataFrame, text: Column, seed: int, block_chars: int) -> int:
    """How many values stand for more than one distinct block."""
    blocks = docs.select(F.explode(blocks_of(text, block_chars)).alias("block")).distinct()
    values = blocks.select(F.xxhash64(F.lit(seed), "block").alias("value"))
    return values.groupBy("value").count().filter("count > 1").count()


def document_names(docs: DataFrame, block_chars: int = BLOCK_CHARS, first_seed: int = 42) -> DataFrame:
    """row, doc_id, level, name, text_sha256 for every row of `docs`; null text counts as empty.

    Rows are told apart by a number of their own, so repeated doc_ids are rows like any other.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    for seed in range(first_seed, first_seed + MAX_SEEDS):
        if not colliding(docs, text, seed, block_chars):
            break
    else:
        raise RuntimeError(f"no collision-free block values in {MAX_SEEDS} seeds")
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2(text, 256).alias("text_sha256"),
            block_values(blocks_of(text, block_chars), seed).alias("values"),
        )
    )
    blocks = rows.select("row", F.size("values").alias("n"), F.posexplode("values").alias("at", "value"))
    names = sorted_names(blocks, ["value"])
    level = stored(blocks.join(names.hint("merge"), "value").select("row", "n", "at", "name"))

    longest = level.agg(F.max("n")).first()[0] or 1
    named = [level.filter("n = 1").select("row", F.lit(0).alias("level"), "name")]
    step, width = 0, longest
    level = level.filter("n > 1")
    while width > 1:
        step += 1
        # An odd last name stays alone in its pair. Names are not negative, so -1 is free.
        pairs = stored(
            level.groupBy("row", F.expr("at div 2").cast("int").alias("at")).agg(
                F.max("n").alias("n"),
                F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        names = sorted_names(pairs, ["left", "right"])
        halved = F.expr("cast((n + 1) div 2 as int)").alias("n")
        level = stored(pairs.join(names.hint("merge"), ["left", "right"]).select("row", halved, "at", "name"))
        named.append(level.filter("n = 1").select("row", F.lit(step).alias("level"), "name"))
        level = level.filter("n > 1")
        width = (width + 1) // 2

    identities = named[0]
    for more in named[1:]:
        identities = identities.unionByName(more)
    return rows.select("row", "doc_id", "text_sha256").join(identities, "row")


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id (largest doc_id of its group), group_size, kept, text_sha256.

    Texts are equal when identical; a null text equals the empty one. If the largest doc_id of a group occurs in
    several rows, the first of them is kept. A null doc_id is kept only if all of its group are null.
    Extra columns are ignored; an empty table gives an empty result.
    """
    identity = ["level", "name"]
    named = stored(document_names(docs, block_chars))
    best = stored(
        named.groupBy(*identity).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    # The group table is stored, so both sides of the join are plain shuffles and a hot group can be split.
    joined = stored(named.join(best.hint("merge"), identity))
    at_top = joined.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = at_top.groupBy(*identity).agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    return joined.join(first, "row", "left").select(
        "row", "doc_id", "keep_id", "group_size", F.coalesce("first", F.lit(False)).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs` that stay, with the columns of `docs`, which may have any name.

    A row is found again by its doc_id and its text, so a doc_id may have several texts; of rows that agree in both, one
    stays.
    """
    kept = exact_groups(docs, block_chars).filter("kept").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("doc_id").isNull().alias("no_id"),
        F.unhex("text_sha256").alias("digest"),
    )
    key = ["id", "no_id", "digest"]
    return with_keys(docs).join(kept.distinct(), key, "left_semi").dropDuplicates(key).select("row.*")
