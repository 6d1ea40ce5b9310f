"""The schedule in the pipeline's result, after the rows went through files."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
from lossledger.llm import mixing
from lossledger.llm.common import stored

WEIGHTS = {"a": 3, "b": 2, mixing.REST: 1}


def test_result_carries_the_schedule(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "TARGET_WEIGHTS", WEIGHTS)
    draw = random.Random(4)
    docs = [(i, "word " * draw.randrange(1, 9000), "en", draw.choice(["a", "b", "c", None])) for i in range(400)]
    docs += [(1000, "", "en", "a"), (1001, None, "de", "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(7)
    mixed = stored(corpus_pipeline.mix(spark, frame, ""))
    result = stored(corpus_pipeline.tokens(spark, mixed, ""))
    rows = [r.asDict() for r in result.drop("token_ids").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in docs) and all(r["round_trip"] for r in rows)
    texts = {i: t or "" for i, t, _, _ in docs}
    # The places are those of the running total of each source.
    total = Counter()
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        assert r["mix_source"] == (r["source"] if r["source"] in WEIGHTS else mixing.REST)
        assert divmod(total[r["mix_source"]], mixing.BLOCK_CHARS) == (r["mix_block"], r["mix_at"])
        total[r["mix_source"]] += len(texts[r["doc_id"]])
    # In each prefix of slots every source has less than a block more or less than its share.
    slots = defaultdict(set)
    for r in rows:
        slots[r["mix_slot"]].add((r["mix_source"], r["mix_block"]))
    assert all(len(blocks) == 1 for blocks in slots.values())
    in_full, done = min(total[s] // mixing.BLOCK_CHARS * 6 // w for s, w in WEIGHTS.items()), Counter()
    assert in_full > 20
    for slot in range(in_full):
        done[next(iter(slots[slot]))[0]] += 1
        assert all(abs(Fraction(w * (slot + 1), 6) - done[s]) < 1 for s, w in WEIGHTS.items())
    # Each file holds a range of slots, in order.
    for path in result.inputFiles():
        inside = [(r["mix_slot"], r["mix_at"]) for r in spark.read.parquet(path).select("mix_slot", "mix_at").collect()]
        assert inside == sorted(inside)
