"""The pipeline's near-copy stage against brute force with five words and 80 %."""

import random

import corpus_pipeline
from lossledger.llm import near_dedup
from tests.llm.test_duplicates import near_expected


def kept_expected(texts, size, percent):
    """(doc_id, text) -> kept ids, by comparing all pairs."""
    sets = {}
    for i, text in texts:
        w = text.lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def texts_between_the_rules():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    texts = ["", "one two three four", "one two three", "one two three four"]
    for edits in range(12):
        for _ in range(4):
            base = [word() for _ in range(150)]
            copy = list(base)
            for at in draw.sample(range(0, 150, 12), edits):
                copy[at] = word()
            # A copy with its tail cut off loses as many shingles of either size.
            texts += [" ".join(base), " ".join(copy), " ".join(base[: 150 - 3 * edits])]
    return list(enumerate(texts))


def test_stage_equals_brute_force(spark):
    texts = texts_between_the_rules()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    stage = kept_expected(texts, 5, 80)
    query = kept_expected(texts, 3, 85)
    # The rules differ both ways on these texts.
    assert stage - query and query - stage
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == stage
    assert {r["doc_id"] for r in near_dedup.keep_one(docs).collect()} == query
    assert query == {i for i, (_, _, kept) in near_expected(texts).items() if kept}


def test_as_many_keys_as_the_limit_needs():
    assert near_dedup.halves_for(near_dedup.LINK_PERCENT) == near_dedup.HALVES
    for percent in (50, 80, 85, 95):
        s, halves = percent / 100, near_dedup.halves_for(percent)
        assert 1 - (1 - (1 - s**near_dedup.HALF_SIZE) ** halves) ** 2 < near_dedup.MISS


def test_links_of_a_large_group_stay_in_proportion_to_its_members(spark, monkeypatch):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    base, texts = [word() for _ in range(120)], []
    for _ in range(150):
        copy = list(base)
        for at in draw.sample(range(120), 2):
            copy[at] = word()
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    walked, components = [], near_dedup.components

    def counted(edges):
        walked.append(edges.count())
        return components(edges)

    monkeypatch.setattr(near_dedup, "components", counted)
    kept = {r["doc_id"] for r in near_dedup.near_duplicates(docs, 5, 80).filter("kept").collect()}
    assert kept == kept_expected(list(enumerate(texts)), 5, 80)
    assert max(walked) <= len(texts)
