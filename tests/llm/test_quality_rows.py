"""The quality classifier on repeated and null ids, and on many and small languages."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lossledger.llm import kneser_ney as kn

DOCS = "doc_id long, text string, lang string"


def prose(draw, letters, words=60):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 7))) for _ in range(words))


def corpus():
    """Eleven languages with letters of their own, from 40 trusted documents down to 4; labels for all of them."""
    draw = random.Random(2)
    docs = []
    for k in range(11):
        letters = "abcdefghijklmnopqrstuvwxyz"[2 * k : 2 * k + 4]
        docs += [(1000 * k + i, prose(draw, letters), f"l{k}") for i in range(44 - 4 * k)]
    return docs, [(i, 1, 0) for i, _, _ in docs]


def test_every_row_is_scored_by_itself_and_every_language_has_limits(spark):
    draw = random.Random(6)
    docs, labels = corpus()
    junk = "".join(draw.choice("qzxjkv!?#%") for _ in range(400))
    odd = [(7, "ab ac", "l0"), (7, junk, "l0"), (None, junk, "l0"), (None, "abc abd", None), (8_888, junk, "new")]
    frame = spark.createDataFrame(docs, DOCS)
    model = kn.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = model.score(spark.createDataFrame(odd + docs, DOCS)).collect()
    assert len(rows) == len(odd) + len(docs)
    by_text = {}
    for r in rows:
        assert r["symbols"] == len(r["text"])  # not a sum over rows of one id, nor nothing for a null one
        by_text.setdefault((r["text"], r["lang"]), set()).add((round(r["loss"], 9), r["rejected"]))
    assert all(len(v) == 1 for v in by_text.values())
    assert {r["rejected"] for r in rows if r["text"] == junk} == {True}
    # Each language has limits of its own, that of ten others before it too; one without trusted text has the pooled.
    limits = {r["lang"]: (r["low"], r["high"]) for r in rows}
    assert len({limits[f"l{k}"] for k in range(11)}) == 11
    assert limits["new"] == limits[None] == pytest.approx(tuple(math.exp(x) for x in model.pooled[1:]))
    kept = model.keep(spark.createDataFrame(odd, DOCS))
    assert sorted(r["text"] for r in kept.collect() if r["text"] != junk) == sorted(t for _, t, _ in odd if t != junk)
    assert kept.filter("doc_id is null").count() == 1


def test_share_grows_smoothly(spark):
    shares = [r["s"] for r in spark.range(0, 1000).select(kn.own_share(F.col("id")).alias("s")).orderBy("id").collect()]
    assert shares[0] == 0 and shares[kn.EVEN_TRUSTED] == 0.5
    assert all(0 < b - a < 0.02 for a, b in zip(shares, shares[1:]))


def test_every_character_is_a_symbol(spark):
    """Capitals, digits and letters that shared a class (A and B, а and м) are told apart, beyond the BMP too."""
    assert kn.symbol_of(ord("7")) == kn.symbol_of(ord("٣")) == kn.symbol_of(ord("0"))
    codes = [0, 10, 32, *map(ord, "ABab1éßамжя漢字€😀"), 0x10FFFF]
    assert len({kn.symbol_of(c) for c in codes} | {kn.START}) == len(codes) + 1
    docs = spark.createDataFrame([(1, "x", "AB12 амж😀 " * 40, True), (2, "x", "BA21 маж😁 " * 40, False)], "doc_id long, lang string, text string, trusted boolean")
    passed = kn.counted(docs.withColumn("model", F.lit("m")), ["doc_id"])
    grams = kn.batch_grams(passed).select("head", "tail").collect()
    spelled = {tuple((r[c] >> s) & (1 << kn.BITS) - 1 for c in kn.GRAM for s in (kn.BITS, 0)) for r in grams}
    expected = set()
    for text in ("AB12 амж😀 " * 40, "BA21 маж😁 " * 40):
        symbols = [kn.START] * 3 + [ord("0" if c in "12" else c) + 1 for c in text]
        expected |= {tuple(symbols[i : i + 4]) for i in range(len(text))}
    assert spelled == expected and len(grams) == len(expected)
    counts = kn.gram_counts(passed)
    table = kn.probabilities(counts.unionByName(counts.withColumn("model", F.lit(kn.POOLED))))
    loss = {r["row"]["doc_id"]: r["loss"] for r in kn.score_by_join(passed, table).collect()}
    assert loss[2] > 4 * loss[1]  # the same text to a model of classes


def test_many_texts_share_one_list_of_grams(spark):
    text = "seven words that make up this line " * 26_000
    docs = spark.range(12).coalesce(1).select(
        F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("=en").alias("model"), F.lit(False).alias("trusted")
    )
    passed = kn.counted(docs, ["doc_id"])
    assert passed.filter("heads is not null").count() == 1 and passed.filter("heads is null").count() == 12
    assert all(name.endswith(".zstd.parquet") for name in passed.inputFiles())


def test_packed_numbers_are_small_and_come_back():
    draw = random.Random(4)
    values = kn.np.array([min(int(draw.expovariate(0.7)) + 1, 300) for _ in range(2000)])
    for some in (values, values * 1000, values[:0], values[:1]):
        assert (kn.unpacked(kn.packed(some)) == some).all()
    assert len(kn.packed(values)) < 700


def test_a_text_on_the_limits_is_not_rejected(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text, "en"), (2, text, "en"), (3, None, "en"), (4, "", "en")], DOCS)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert kn.keep_good(docs, labels).count() == 4
