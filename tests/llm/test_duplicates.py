"""Exact and near duplicates, fingerprints and license scans against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lossledger.llm import exact_dedup, fingerprints, license_scan, near_dedup, shingles

DOCS = "doc_id long, text string, row string, level int, name string, class long, __part int"


def frame(spark, texts):
    """texts: (doc_id, text); the other columns clash with names that the operators use."""
    return spark.createDataFrame([(i, t, "r", 0, "n", 1, 2) for i, t in texts], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(zip(words, words[1:], words[2:])) if len(words) > 2 else frozenset([tuple(words)] if words else [])


def near_expected(texts):
    sets = {i: shingle_set(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def near_texts():
    """Groups of edited copies with few and many edits, chains, copies that differ in case, short and empty texts."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    texts = [None, "", " \t\n", "one", "One", "one two", "two one", "ß é ß é", "x" * 3000]
    for copies, edits in ((120, 40), (30, 4), (10, 1)):
        base = [word() for _ in range(150)]
        for _ in range(copies):
            copy = list(base)
            for _ in range(draw.randrange(edits)):
                copy[draw.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    chain = [word() for _ in range(200)]
    for k in range(12):  # each is linked with its neighbours only
        texts.append(" ".join(chain[: 100 + 6 * k][6 * k :]) if k % 2 else " ".join(chain[6 * k : 100 + 6 * k]).upper())
    texts += texts[9:12]
    return [(7 * i + 3, t) for i, t in enumerate(texts)]


def test_near_duplicates_equal_brute_force(spark):
    texts = near_texts()
    got = {
        r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
        for r in near_dedup.near_duplicates(frame(spark, texts)).collect()
    }
    assert got == near_expected(texts)
    assert sum(1 for n, c, kept in got.values() if not kept) > 60


def test_near_duplicates_of_repeated_and_no_rows(spark):
    twice = [(1, "a b c d"), (1, "a b c d"), (1, "other words are here"), (2, "A b c d"), (None, "a b c d")]
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in near_dedup.near_duplicates(frame(spark, twice)).collect())
    assert got == [(0, 1), (1, 1), (1, 1), (1, 1), (2, 1)]
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    assert near_dedup.keep_one(frame(spark, [(5, "a"), (4, "a"), (6, "b")])).count() == 2


def test_shingle_sets_across_stripes(monkeypatch):
    monkeypatch.setattr(shingles, "STRIPE_BYTES", 16)
    shingles._powers.cache_clear()
    texts = ["a bb ccc dddd eeeee ffffff " * 3, "", "Z", "q" * 40 + " r s"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    cut = shingles.shingle_sets(data, np.cumsum([0] + [len(t) for t in texts]))
    monkeypatch.undo()
    shingles._powers.cache_clear()
    whole = shingles.shingle_sets(data, np.cumsum([0] + [len(t) for t in texts]))
    assert [list(a) for a in cut] == [list(b) for b in whole]
    assert [len(s) for s in whole] == [len(shingle_set(t)) for t in texts]


def test_half_keys_meet_the_stated_probability():
    draw = np.random.default_rng(3)
    hits = 0
    for _ in range(60):  # similarity 0.86
        common, a, b = (draw.integers(0, 2**63, n, dtype=np.uint64) for n in (860, 70, 70))
        one, two = near_dedup.half_keys([np.concatenate([common, a]), np.concatenate([common, b])])
        hits += bool((one == two)[: near_dedup.HALVES].any() and (one == two)[near_dedup.HALVES :].any())
    assert hits == 60


@pytest.mark.parametrize("block_chars", [3, 8192])
def test_exact_groups_equal_brute_force(spark, block_chars):
    draw = random.Random(1)
    texts = [(i, "".join(draw.choice("ab") for _ in range(draw.randrange(9)))) for i in range(300)]
    texts += [(1000, None), (1001, ""), (1002, "é😀\n" * 50), (1003, "é😀\n" * 50), (1004, "é😀\n" * 49 + "é😀 "), (5, "dup")]
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    got = Counter(
        (r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
        for r in exact_dedup.exact_groups(frame(spark, texts), block_chars).collect()
    )
    assert got == Counter(
        (i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    )


def test_exact_groups_keep_one_of_repeated_rows_and_survive_no_rows(spark):
    rows = exact_dedup.exact_groups(frame(spark, [(1, "a"), (1, "a"), (None, "a"), (None, None)])).collect()
    assert sorted((r["keep_id"] or 0, r["kept"]) for r in rows) == [(0, True), (1, False), (1, False), (1, True)]
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_colliding_block_values_take_another_seed(spark, monkeypatch):
    calls = []
    real = exact_dedup.colliding
    monkeypatch.setattr(exact_dedup, "colliding", lambda d, t, seed, b: calls.append(seed) or seed == 42 or real(d, t, seed, b))
    assert exact_dedup.exact_groups(frame(spark, [(1, "a"), (2, "a"), (3, "b")])).filter("kept").count() == 2
    assert calls == [42, 43]


def long_hash(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), seed)


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def marks_expected(text, k=fingerprints.K, window=fingerprints.WINDOW):
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^ \t-\r]+", text)]
    parts = [hashes[i : i + k] for i in range(len(hashes) - k + 1)] or ([hashes] if hashes else [])
    grams = []
    for part in parts:
        seed = 42
        for h in part:
            seed = long_hash(h, seed)
        grams.append(signed(seed))
    chosen = {}
    for s in range(max(1, len(grams) - window + 1) if grams else 0):
        here = range(s, min(s + window, len(grams)))
        at = min(here, key=lambda i: (grams[i], -i))
        chosen[at] = grams[at]
    return sorted((p, h) for p, h in chosen.items())


def test_winnowing_equals_brute_force(spark):
    draw = random.Random(2)
    texts = ["", "a", "a b", "a b c", "a " * 40, "Ü\tx\nÜ x Ü x"] + [
        " ".join(draw.choice("pqrst") for _ in range(draw.randrange(60))) for _ in range(80)
    ]
    marked = fingerprints.with_marks(frame(spark, list(enumerate(texts))), "text", "marks").collect()
    for row in marked:
        assert sorted((m["position"], m["hash"]) for m in row["marks"]) == marks_expected(row["text"])
    # The guarantee: window + k - 1 words in common share a mark.
    shared = " ".join(f"w{i}" for i in range(fingerprints.K + fingerprints.WINDOW - 1))
    one, two = marks_expected("x y " + shared), marks_expected(shared + " z z")
    assert {h for _, h in one} & {h for _, h in two}


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_next_document(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        texts = [(i * i % 1009, f"text {i}") for i in range(100)]
        got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(frame(spark, texts), ["text"]).collect()}
        order = sorted(texts, reverse=True)
        assert got == {i: order[(k + 1) % len(order)][1] for k, (i, _) in enumerate(order)}
        alone = fingerprints.with_next(frame(spark, [(4, "only")]), ["text"]).collect()
        assert [r["next_text"] for r in alone] == ["only"]
        odd = [(4, "b"), (4, "a"), (None, "n"), (9, "z")]
        led = fingerprints.with_next(frame(spark, odd), ["text"]).collect()
        assert {r["text"]: r["next_text"] for r in led} == {"z": "a", "a": "b", "b": "n", "n": "z"}
        assert fingerprints.with_next(frame(spark, []), ["text"]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprint_query_edits(spark):
    from lossledger.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect())[::-1]
    got = {r["doc_id"]: r for r in QUERIES["op5_document_fingerprints"](spark, folder).collect()}
    prints = defaultdict(set)
    for k, (i, text) in enumerate(texts):
        half, after = len(text) // 2, texts[(k + 1) % len(texts)][1]
        edited = text[: len(text) - half] + after[:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = ({h for _, h in marks_expected(t)} for t in (text, edited))
        assert got[i]["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        prints[text].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def licenses_expected(text):
    words = re.findall(license_scan.WORD, lower(text))
    places = [
        (s, label) for phrase, label in license_scan.PHRASES.items() for s in range(len(words))
        if words[s : s + len(phrase.split())] == phrase.split()
    ]
    half = max(len(t.words) for t in license_scan.templates())
    score, labels = (1.0 if places else 0.0), {label for _, label in places}
    for low in range(0, max(1, len(words)), half):
        block = set(words[low : low + 2 * half])
        for template in license_scan.templates():
            share = len(block & template.tokens) / len(template.tokens)
            if not template.phrase and share >= license_scan.THRESHOLD:
                labels.add(template.label)
                score = max(score, share)
    starts = [s for s, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})), ",".join(sorted(labels)), round(score, 9),
    )


def test_license_scan_equals_brute_force(spark):
    draw = random.Random(4)
    vocabulary = sorted(set().union(*[t.tokens for t in license_scan.templates()])) + ["wörter", "x", "y", "z"]
    texts = [None, "", "CC-BY cc by CC/BY", "apache\nLICENSE", "the MIT license. MIT", "ccc by, cc  bye", "Gnu General\tPublic License"]
    texts += [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(120))) for _ in range(60)]
    for template in license_scan.templates():
        words = list(template.words)
        for cut in range(4):
            filler = ["filler"] * draw.randrange(40)
            texts.append(" ".join(filler + words[: len(words) - cut] + filler))
    made = frame(spark, list(enumerate(texts)))
    for row in license_scan.scan_licenses(made).collect():
        got = tuple(row[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels"))
        assert got + (round(row["score"], 9),) == licenses_expected(texts[row["doc_id"]]), texts[row["doc_id"]]
    assert license_scan.scan_licenses(made.limit(0)).count() == 0
    assert license_scan.scan_licenses(made.union(made)).count() == 2 * len(texts)


def test_a_join_back_keeps_hot_groups_whole(spark):
    hot = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same words in here").otherwise(F.concat(F.lit("w "), F.col("id").cast("string"), F.lit(" x y"))).alias("text")
    )
    assert near_dedup.near_duplicates(hot).filter("kept").count() == 2001
    assert exact_dedup.exact_groups(hot).filter("kept").count() == 2001
