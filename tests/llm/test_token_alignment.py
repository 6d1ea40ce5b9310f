"""Alignment against a byte-by-byte version, lockstep lanes of any size, and unusual rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossledger.llm import queries, token_alignment as ta
from lossledger.llm.sentencepiece_wfst import model_file

FILES = model_file("byte_bpe_50k.json"), model_file("piece_bpe_32k.model")
NONE = (0, 0, 0, 0, 0, 0, "")


def spans(ids, table):
    end, made = 0, []
    for i in ids:
        made.append((int(i), end, end + int(table.sizes[i])))
        end += int(table.sizes[i])
    return made


def brute(rows):
    """Rows of (doc_id, text): every A token against every B token."""
    tokenizers, docs = ta.tokenizers_of(*FILES), []
    for doc_id, text in rows:
        if not text:
            docs.append((doc_id, [], [], [], []))
            continue
        (a,), (b,) = tokenizers.encode([text])
        names_a = b"".join(tokenizers.table_a.spell(np.array([i])).tobytes() for i in a)
        names_b = b"".join(tokenizers.table_b.spell(np.array([i])).tobytes() for i in b)
        if {names_a, names_b} != {b" " + text.encode()}:
            docs.append((doc_id, [], [], [], []))
            continue
        a, b = spans(a, tokenizers.table_a), spans(b, tokenizers.table_b)
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        docs.append((doc_id, a, b, links, cuts))
    held = Counter(p for *_, links, _ in docs for p in set(links))
    highest = {}
    for (i, _), n in held.items():
        highest[i] = max(n, highest.get(i, 0))
    result = []
    for doc_id, a, b, links, cuts in docs:
        groups = [
            ",".join(str(i) for i, _, e in a if s < e <= t) + "|" + ",".join(str(i) for i, _, e in b if s < e <= t)
            for s, t in zip([0, *cuts], cuts)
        ]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(held[p] == highest[p[0]] for p in links)
        result.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(held[p] for p in links), digest))
    return result


def ran(spark, rows, kind="bigint"):
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
    found = ta.scored_alignment(docs, *FILES)
    assert found.columns == ["doc_id", *ta.RESULT, "groups_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


TEXTS = [
    "The quick brown fox, the lazy dog and 12345 numbers.", "the the the lazy dog", None, "", " ", "  two  spaces ", "a\n\n\tb\r\n",
    "Größe für straße über 日本語 текст 🙂🙂", "<|endoftext|> and <s> and </s> <unk> <0x41>", "▁low line", "x" * 700, "é́\u0000z",
    "The quick brown fox, the lazy dog and 12345 numbers.", "don't we'll I'm " * 40,
]


def test_equals_brute_force(spark):
    rows = list(enumerate(TEXTS))
    found = ran(spark, rows)
    assert found == sorted(brute(rows), key=repr)
    by_id = {r[0]: r[1:] for r in found}
    assert by_id[2] == by_id[3] == by_id[9] == NONE and by_id[0] == by_id[12] and by_id[8][0] > 0


def test_ids_equal_the_library():
    tokenizers = ta.tokenizers_of(*FILES)
    assert tokenizers.ranked is not None
    rng = np.random.default_rng(11)
    parts = ["the", " of", "ing", "'s", "'ll", "  ", "\n", "\t", "\u00a0", "é", "ß", "Ж", "ñ", "12", "7", "!", "...", "$", "<|endoftext|>", "日", "🙂", "\u0085", "´", "x" * 300]
    texts = ["".join(rng.choice(parts, rng.integers(1, 30))) for _ in range(3000)]
    rows = [t for t in TEXTS if t] + texts
    library = [e.ids for e in tokenizers.a.encode_batch([" " + t for t in rows], add_special_tokens=False)]
    assert tokenizers.encode_a([" " + t for t in rows]) == library


def test_repeated_rows_text_ids_and_no_rows(spark):
    rows = [("a", "one two"), ("a", "one two"), (None, "one three"), (None, None)]
    assert ran(spark, rows, "string") == sorted(brute(rows), key=repr)
    assert ran(spark, []) == []
    clashing = spark.createDataFrame([(1, "x y", 5, 6)], "doc_id bigint, text string, batch int, pairs int")
    assert ta.scored_alignment(clashing, *FILES).count() == 1


def test_lanes_do_not_show(spark, monkeypatch):
    """Many short lanes, one lane per document, and batches of one text give the same links and cuts."""
    rng = np.random.default_rng(3)
    sizes_a, sizes_b, counts, total = [], [], [], []
    for _ in range(30):
        length = int(rng.integers(1, 400))
        for sizes in (sizes_a, sizes_b):
            left, before = length, len(sizes)
            while left:
                sizes.append(min(left, int(rng.integers(1, 7))))
                left -= sizes[-1]
            if sizes is sizes_a:
                counts.append(len(sizes) - before)
    ends_a, ends_b, counts = np.cumsum(sizes_a), np.cumsum(sizes_b), np.array(counts)
    whole = ta.lockstep(ends_a, ends_b, *ta.lanes(counts, 10_000))
    starts_a, starts_b = ends_a - sizes_a, ends_b - sizes_b
    assert set(zip(whole.a.tolist(), whole.b.tolist())) == {
        (i, j) for i in range(len(ends_a)) for j in range(len(ends_b)) if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]
    }
    assert len(whole.a) == len(set(zip(whole.a.tolist(), whole.b.tolist())))
    for size in (1, 2, 7):
        cut = ta.lockstep(ends_a, ends_b, *ta.lanes(counts, size))
        assert sorted(zip(cut.a, cut.b)) == sorted(zip(whole.a, whole.b))
        assert np.array_equal(cut.cut_a, whole.cut_a) and np.array_equal(cut.cut_b, whole.cut_b)


def test_very_long_text_equals_its_parts(spark):
    text = "The lazy dog sleeps under 12 old trees. " * 20_000
    tokenizers = ta.tokenizers_of(*FILES)
    one = ta.align_texts([text], tokenizers)
    (a,), (b,) = tokenizers.encode([text])
    assert (one.n_a[0], one.n_b[0]) == (len(a), len(b)) and one.times.sum() == one.n_links[0] >= max(len(a), len(b))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_over_its_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, folder)
    assert found.count() == docs.count()
    short = [(r["doc_id"], r["text"]) for r in docs.filter(F.length("text") < 400).collect()]
    assert len(short) > 5
    sizes = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in found.collect()}
    for r in brute(short):
        assert sizes[r[0]] == (*r[1:5], r[7])
