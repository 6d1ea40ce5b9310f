"""Language model, tokens, mixing and secrets against brute force, the library, and held-out labels."""

import itertools
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lossledger.llm import kneser_ney as kn
from lossledger.llm import mixing, secret_scan
from lossledger.llm import sentencepiece_wfst as wfst

MIDDLE = "/root/testdata/sf0.01"


# ---- Kneser-Ney -------------------------------------------------------------------------------------------------

def plain_model(texts):
    """p(gram) for any ORDER-gram, straight from the definition."""
    counts = {kn.ORDER: Counter(g for t in texts for g in grams_of(t))}
    for size in range(kn.ORDER - 1, 0, -1):
        counts[size] = Counter(g[1:] for g in counts[size + 1])
    discounts = {}
    for size, table in counts.items():
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.0
        discounts[size] = [0.0] + [
            min(max(k - (k + 1) * y * (n[k + 1] / n[k] if n[k] else 0.0), 0.0), float(k)) for k in (1, 2, 3)
        ]
    followers = {size: defaultdict(list) for size in counts}
    for size, table in counts.items():
        for g, c in table.items():
            followers[size][g[:-1]].append(c)

    def p(gram):
        if not gram:
            return 1.0 / kn.SYMBOLS
        size = len(gram)
        after = followers[size].get(gram[:-1])
        if not after:
            return p(gram[1:])
        d, c = discounts[size], counts[size][gram]
        weight = sum(d[min(x, 3)] for x in after) / sum(after)
        return max(c - d[min(c, 3)], 0.0) / sum(after) + weight * p(gram[1:])

    return p


def grams_of(text):
    symbols = (kn.START,) * (kn.ORDER - 1) + tuple(kn.symbol_of(ord(c)) for c in text)
    return [symbols[i : i + kn.ORDER] for i in range(len(text))]


def test_probabilities_and_scores_equal_the_definition(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("abc .") for _ in range(draw.randrange(1, 60))) for _ in range(40)] + ["Über 12!", ""]
    others = [t[::-1] for t in texts[:20]] + ["zz €"]
    trained = spark.createDataFrame([("m", t) for t in texts] + [("*", t) for t in others], "model string, text string")
    counted = kn.counted(trained.withColumns({"trusted": F.lit(True), "lang": F.lit("x")}), ["lang"])
    table = kn.probabilities(kn.gram_counts(counted))
    unseen = texts[:6] + ["zzz €", "", None, "a\nb", "ABC abc"]
    docs = spark.createDataFrame([(i, "m", t, 5) for i, t in enumerate(unseen)], "doc_id long, model string, text string, lost int")
    p, pooled = plain_model(texts), plain_model(others)
    expected = {i: -sum(math.log((p(g) + pooled(g)) / 2) for g in grams_of(t or "")) for i, t in enumerate(unseen)}
    passed = kn.counted(docs.withColumn("trusted", F.lit(False)), ["doc_id", "lost"])
    rows = kn.score_by_join(passed, table).select("row.*", "symbols", "loss").collect()
    assert {r["doc_id"]: r["symbols"] for r in rows} == {i: len(t or "") for i, t in enumerate(unseen)}
    for r in rows:
        assert r["loss"] == pytest.approx(expected[r["doc_id"]], rel=1e-9), r
    # Probabilities after any context sum to one.
    for context in [(kn.START,) * 3, (6, 7, 8), (40, 40, 40)]:
        assert sum(p(context + (s,)) for s in range(kn.SYMBOLS)) == pytest.approx(1.0)


def test_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = kn.fit(docs, labels.filter(~held))
    kept = model.keep(docs)
    assert kept.columns == docs.columns
    told = docs.join(labels.filter(held), "doc_id").join(kept.select("doc_id", F.lit(True).alias("kept")), "doc_id", "left")
    share = {r["quality"]: r["kept"] for r in told.groupBy("quality").agg(F.avg(F.coalesce("kept", F.lit(False)).cast("int")).alias("kept")).collect()}
    assert share[1] > 0.99 and share[0] < 0.12


def test_nothing_trusted_rejects_nothing(spark):
    docs = spark.createDataFrame([(1, "a", None, 1.0), (2, None, "en", 2.0)], "doc_id long, text string, lang string, loss double")
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert kn.fit(docs, labels).keep(docs).count() == 2
    assert kn.fit(docs.limit(0), labels).keep(docs.limit(0)).count() == 0


# ---- SentencePiece ----------------------------------------------------------------------------------------------

TEXTS = [
    "", "Hello  world\nA <s> <0x0A> é😀  ", "   ", "日本語のテキスト한국어 العربية", "def f(x):\n    return x**2\t\n\n", "ﬁ ½ Ⅷ ​",
    "A" * 50 + " " + "ab" * 40, " a", "a ", "\r\n", "x" * 5000,
]


@pytest.fixture(scope="module")
def transducer():
    return wfst.Transducer(wfst.read_model(wfst.model_file()))


def test_ids_equal_the_library(spark, transducer):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=wfst.model_file())
    texts = TEXTS + [r["text"] or "" for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").limit(300).collect()]
    assert [list(transducer.encode(t)) for t in texts] == library.encode(texts)
    assert all(transducer.decode(transducer.encode(t)) == t for t in texts)


def test_encoded_frame(spark):
    docs = spark.createDataFrame([(i, t, [1]) for i, t in enumerate([*TEXTS, None, "a▁b"])], "doc_id long, text string, token_ids array<int>")
    rows = sorted(wfst.encode_texts(docs, wfst.model_file()).collect())
    assert [r["round_trip"] for r in rows] == [True] * (len(TEXTS) + 1) + [False]
    assert all(len(r["token_ids"]) == r["n_tokens"] for r in rows) and rows[0]["n_tokens"] == rows[-2]["n_tokens"] == 0
    assert wfst.encode_texts(docs.limit(0), wfst.model_file()).count() == 0


def test_unigram_path_is_the_cheapest():
    scores = {"▁": -2.0, "▁a": -1.5, "a": -2.2, "b": -2.4, "ab": -3.1, "ba": -2.9, "bab": -5.0, "▁ab": -4.5}
    pieces = [wfst.Piece("<unk>", 0.0, "unknown")] + [wfst.Piece(t, s, "normal") for t, s in scores.items()]
    made = wfst.Transducer(wfst.Model(pieces, bpe=False))
    for word in itertools.product("ab", repeat=6):
        text = "▁" + "".join(word)

        def best(rest):
            return 0.0 if not rest else min(-s + best(rest[len(t):]) for t, s in scores.items() if rest.startswith(t))

        ids = list(made.encode(text[1:]))
        assert sum(-pieces[i].score for i in ids) == pytest.approx(best(text))
        assert "".join(pieces[i].text for i in ids) == text
    assert list(made.encode("c")) == [1, 0]


# ---- Mixing -----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 500, **{f"s{i}": 10 for i in range(50)}}, {"a": 7, "b": 5, "c": 3, "*": 2}])
def test_no_source_deviates_by_a_block(weights):
    period, done = sum(weights.values()), Counter()
    for slot, (source, block, at) in enumerate(mixing.period_schedule(weights)):
        assert at == slot and block == done[source]
        assert Fraction(block * period, weights[source]).__floor__() <= slot < -((-(block + 1) * period) // weights[source])
        done[source] += 1
        assert all(abs(Fraction(w * (slot + 1), period) - done[s]) < 1 for s, w in weights.items())
    assert done == Counter(weights)


def test_scheduled_documents_equal_brute_force(spark):
    draw = random.Random(9)
    docs = [(i, draw.choice(["a", "a", "b", "other", None]), None if i % 9 == 0 else "x" * draw.randrange(50), "p") for i in range(400)]
    docs += [(None, "a", "last", "p"), (3, "a", "again", "p")]
    weights = {"a": 3, "b": 2, mixing.REST: 1}
    table = {(s, j): at for s, j, at in mixing.period_schedule(weights)}
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string, part string")
    expected, total = [], Counter()
    for i, source, text, _ in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[2] is not None, d[2] or "")):
        source = source if source in ("a", "b") else mixing.REST
        j = total[source] // 100
        expected.append((i, source, j, j // weights[source] * 6 + table[source, j % weights[source]], total[source] % 100))
        total[source] += len(text or "")
    got = mixing.scheduled(frame, weights, 100)
    columns = ["doc_id", "mix_source", "mix_block", "mix_slot", "mix_at"]
    assert Counter(tuple(r) for r in got.select(columns).collect()) == Counter(expected)
    assert got.filter("mix_slot < mix_release").count() == 0
    laid = mixing.mixed(frame, weights, 100)
    assert laid.columns == frame.columns and laid.count() == len(docs)
    assert mixing.scheduled(frame.limit(0), weights).count() == 0
    with pytest.raises(Exception, match="without a weight"):
        mixing.scheduled(frame, {"a": 1, "b": 1}).collect()


# ---- Secrets ----------------------------------------------------------------------------------------------------

def test_secrets_among_numbers_and_words(spark):
    draw = random.Random(11)
    words = ["water", "stone", "river", "house", "garden", "winter", "market", "people"]
    hexes = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    docs, secret = [], set()
    for i in range(600):
        text = [draw.choice(words) for _ in range(30)]
        kind = i % 6
        value = {
            0: "AKIA" + "".join(draw.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16)), 1: hexes(39) + "a7",
            2: hexes(18) + "b1", 3: str(draw.randrange(10**15, 10**16)), 4: "river2garden-winter-market", 5: "",
        }[kind]
        shown = {1: f'token = "{value}"', 2: f"password={value}"}.get(kind, value)
        text.insert(draw.randrange(30), shown)
        docs.append((i, f"src{i % 3}", " ".join(text), 0.5))
        if kind < 3:
            secret.add((i, value))
    docs += [(1000, None, None, 0.5), (1001, "src0", "", 0.5), (1002, None, "word " * 5000, 0.5)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string, probability double")
    got = {(r["doc_id"], r["candidate"]): r["is_secret"] for r in secret_scan.scan_secrets(frame).collect()}
    assert secret <= set(got)
    assert {k for k, yes in got.items() if yes} == secret
    assert len(got) == len(secret) + 200
    assert secret_scan.scan_secrets(frame.limit(0)).count() == 0
    twice = secret_scan.candidates(frame.filter("doc_id < 6").union(frame.filter("doc_id < 6")))
    assert twice.count() == 2 * 5
