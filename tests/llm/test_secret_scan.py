"""Candidates wherever they stand and however long they are; precision and recall on planted findings."""

import random

import pytest

from lossledger.llm import secret_scan as ss

GHP = "ghp_" + "a1B2" * 9
AWS = "AKIA" + "Q7" * 8
JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N"


def found(spark, texts):
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id int, source string, text string")
    return {(r["doc_id"], r["name"], r["candidate"]) for r in ss.candidates(docs).collect()}


def test_candidates_at_any_place_of_a_word(spark):
    cases = [
        ('"password":"hunter22abcd"', "password", "hunter22abcd"), ('{"token":"%s"}' % GHP, "token", GHP),
        (f"https://host/?token={GHP}", "token", GHP), (f"user:{AWS},next", "user", AWS), ("key2=abcdefgh1", "key2", "abcdefgh1"),
        ("password=p@ssw0rd!long1", "password", "p@ssw0rd!long1"), (JWT, "", JWT), ("a1" * 226, "", "a1" * 226),
        (f"db.secret='{AWS}'", "db.secret", AWS), (f"a=1&api_key={GHP}&b=2", "api_key", GHP), (f"({AWS})", "", AWS), (f"é{AWS}é", "", AWS),
        ("x:yyyyyyyyyy=zzzzzzzzz9", "yyyyyyyyyy", "zzzzzzzzz9"), ("token=YWJjZGVmZ2hp==", "token", "YWJjZGVmZ2hp"), (f"token={AWS}.", "token", AWS),
    ]
    got = found(spark, [t for t, _, _ in cases])
    assert got >= {(i, name, value) for i, (_, name, value) in enumerate(cases)}
    assert not found(spark, ["an ordinary sentence", "http://host/path", "nodigitsinthisword", "1.2", "", None, "a:b=c", "12:30:45"])
    two = found(spark, [f"token={GHP};secret={AWS}"])
    assert two == {(0, "token", GHP), (0, "secret", AWS)}


def test_long_words_need_linear_time(spark):
    texts = ["a1" * 500_000, "a" * 1_000_000, "a." * 500_000, "a=" * 500_000, "=a1" * 300_000, "ab1_" * 250_000 + "=x"]
    got = found(spark, texts)
    assert (0, "", "a1" * 500_000) in got
    docs = spark.createDataFrame([(1, "s", "Abcd1" * 100_000)], "doc_id int, source string, text string")
    words = spark.createDataFrame([("abcd",)], "word string")
    assert ss.coverage(ss.candidates(docs), words).first()["covered"] == pytest.approx(0.8)


def planted(seed, n):
    """Texts of ordinary words; each has a secret in some wrapping, or a number, path or joined words in the same."""
    draw, rows, secret, other = random.Random(seed), [], set(), set()
    vocabulary = ["".join(draw.choice("aeiounrstl") for _ in range(draw.randint(3, 9))) for _ in range(300)]
    text = lambda k: " ".join(draw.choice(vocabulary) for _ in range(k))
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    wraps = ["{n}={v}", '"{n}":"{v}"', "{n}: {v}", "https://h/?{n}={v}&x=1", "{n} = '{v}'", "({n}:{v})"]
    for i in range(n):
        if i % 2:
            kind = draw.randrange(3)
            if kind == 0:
                value, name = "AKIA" + "".join(draw.choice(alphabet[:26] + "0123456789") for _ in range(16)), draw.choice(["id", "user", "token"])
            else:
                value, name = "".join(draw.choice(alphabet) for _ in range(draw.randint(20, 44))) + "7a", draw.choice(["password", "api_key", "db.secret", "auth"])
            secret.add((i, value))
        else:
            kind = draw.randrange(3)
            value = {0: lambda: str(draw.randrange(10**12, 10**20)), 1: lambda: "-".join(draw.choice(vocabulary) for _ in range(4)) + "-2",
                     2: lambda: "/".join(draw.choice(vocabulary) for _ in range(5)) + "/1"}[kind]()
            name = draw.choice(["id", "page", "see", "number"])
            other.add((i, value))
        rows.append((i, f"s{i % 5}", f"{text(30)} {draw.choice(wraps).format(n=name, v=value)} {text(20)}"))
    return rows, secret, other


def test_precision_and_recall_on_planted_findings(spark):
    rows, secret, other = planted(1, 1200)
    docs = spark.createDataFrame(rows, "doc_id int, source string, text string")
    got = {(r["doc_id"], r["candidate"]): r["is_secret"] for r in ss.scan_secrets(docs).collect()}
    said = {k for k, yes in got.items() if yes}
    assert secret <= set(got)  # the forest sees every one
    recall, precision = len(said & secret) / len(secret), len(said & secret) / len(said)
    assert recall > 0.97 and precision > 0.97, (recall, precision)
