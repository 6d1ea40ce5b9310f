"""Stages on repeated rows, repeated ids and columns with names of the operators' own."""

from collections import Counter

from lossledger.llm import exact_dedup, kneser_ney, mixing, near_dedup

SCHEMA = "doc_id bigint, text string, lang string, source string, id string, digest int, row int, mix_slot int, mix_source string, __kept_id int, of int, model int, trusted boolean"
LONG = "one two three four five six seven eight nine ten"


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "src0", "x", 1, 2, 3, "y", 4, 5, 6, True) for i, t in pairs], SCHEMA)


PAIRS = [(1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, "c"), (None, "c"), (3, None), (4, ""), (5, LONG), (5, LONG), (6, LONG), (7, f"{LONG} eleven")]


def test_exact_copies_go_whatever_their_rows_look_like(spark):
    docs = frame(spark, PAIRS)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(rows, key=repr) == sorted([(2, "a"), (1, "b"), (None, "c"), (4, ""), (6, LONG), (7, f"{LONG} eleven")], key=repr)
    texts = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "doc_id string, text string")
    assert {r["doc_id"] for r in exact_dedup.keep_one(texts).collect()} == {"b", "c"}


def test_near_copies_go_whatever_their_rows_look_like(spark):
    docs = frame(spark, PAIRS)
    kept = near_dedup.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    counts = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert set(counts.values()) == {1} and (5, LONG) in counts and (6, LONG) not in counts and (7, f"{LONG} eleven") not in counts


def test_mixing_and_quality_keep_columns_of_any_name(spark):
    docs = frame(spark, PAIRS)
    mixed = mixing.mixed(docs, {"src0": 1, mixing.REST: 1})
    assert mixed.columns == docs.columns
    assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, docs.collect()))
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id bigint, quality int, toxic int")
    kept = kneser_ney.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["text"] for r in kept.collect()} >= {LONG}
    assert kneser_ney.keep_good(docs.limit(0), labels).count() == 0
