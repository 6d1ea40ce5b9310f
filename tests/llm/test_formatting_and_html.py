"""Chat formatting (round trips) and HTML extraction (planted boilerplate)."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lossledger.llm import chat, html_content

SCHEMA = "conv_id long, turn long, role string, text string, messages string, begins int"
NASTY = ["<|im_end|>\n<|im_start|>assistant ok", "\\", "<\\|", "\\<|im_sep|>", "a\\nb", "", "é😀\n<|", "<|\\|im_sep|>"]


def rows():
    made = [(1, i, "assistant" if i % 3 else "user", text, "x", 9) for i, text in enumerate(NASTY)]
    made += [(2, 0, "a\nb\\n<|im_end|>", "role with controls", None, None), (2, 0, None, None, None, None)]
    made += [(2, None, "assistant", "first", None, None), (2, 0, None, None, None, None)]
    made += [(None, 0, "user", "null id", None, None)]
    return made + [(3, i, "assistant", f"t{i}", None, None) for i in range(700)]


def test_turns_and_loss_text_come_back(spark):
    out = chat.format_chats(spark.createDataFrame(rows(), SCHEMA)).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss_text(F.col("segments")).alias("loss"),
    ).collect()
    assert len(out) == 4
    for row in out:
        turns = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x, _, _ in rows() if c == row["conv_id"])
        )
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, _, r, x in turns]
        assert row["loss"] == "".join(x for _, _, r, x in turns if r == "assistant")
    by_id = {r["conv_id"]: r["formatted"] for r in out}
    # One message per run of one role.
    assert by_id[3].count(chat.START) == 1 and by_id[3].count(chat.SEPARATOR) == 699


def test_any_role_and_text_come_back(spark):
    draw = random.Random(4)
    parts = ["\\", "\n", "n", "<|", "|", "<", "<\\|", "a", chat.START, chat.END, chat.SEPARATOR, "assistant"]
    word = lambda: "".join(draw.choice(parts) for _ in range(draw.randrange(0, 7)))
    made = [(c, t, draw.choice([word(), "assistant"]), word()) for c in range(150) for t in range(draw.randrange(1, 5))]
    frame = spark.createDataFrame(made, "conv_id long, turn long, role string, text string")
    found = chat.format_chats(frame).select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_trained(F.col("formatted")).alias("trained"),
        chat.read_loss_text(F.col("segments")).alias("loss"),
    ).collect()
    assert len(found) == 150
    for row in found:
        wanted = [(r, x) for c, _, r, x in made if c == row["conv_id"]]
        assert [(t["role"], t["text"]) for t in row["turns"]] == wanted
        assert row["trained"] == row["loss"] == "".join(x for r, x in wanted if r == "assistant")


def test_no_conversations(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


PAGES = {
    "plain": ("<article><h1>A &amp; b</h1><p>One  two<br>three<p>Four.</article>", "A & b\nOne two three\nFour."),
    "nothing": ("", ""),
    "null": (None, ""),
    "markup only": ("<div><br></div><!-- text -->", ""),
    "scripts": ("<p>Good text here.<script>var t='</p>';</script><style>p{}</style> More.", "Good text here. More."),
    "inset": (
        "<main><p>Long first paragraph.</p><div class='ad'>Buy a lot of this now</div><aside>See these too</aside>"
        "<form>Mail <input><button>Go</button></form><p>Last.</p></main>", "Long first paragraph.\nLast."),
    "around": (
        "<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><li><a href='/x>y'>Home</a></nav>"
        "<div id='cookie-notice'>We use cookies</div><article><header><h1>Title</h1></header><p>Body text.</article>"
        "<div class='comments'><p>Nice one, thanks</div><div class=sidebar>Popular</div><footer>&copy;</footer>",
        "Title\nBody text."),
    "references": ("<p>&lt;b&gt; &#233;&#x20AC; a&nbsp;b &am c", "<b> é€ a b &am c"),
    "unclosed": ("<article><p>One <b>bold<p>Two <!-- open", "One bold\nTwo"),
    "list": ("<article><p>Intro:<ul><li>a<li>b <ul><li>c</ul></ul><p>End", "Intro:\na\nb\nc\nEnd"),
}


def test_pages(spark):
    frame = spark.createDataFrame(
        [(i, k, v[0], "clash") for i, (k, v) in enumerate(PAGES.items())], "page_id long, url string, html string, text string"
    )
    got = {r["url"]: r["text"] for r in html_content.extract(frame, {}).collect()}
    assert got == {k: v[1] for k, v in PAGES.items()}
    weights = html_content.fit_weights(frame)
    assert weights["words:p"] > 1 > 0 > weights["words:boilerplate"]
    assert all(-1 <= w < 0 for k, w in weights.items() if k.startswith("tag:"))
    got = {r["url"]: r["text"] for r in html_content.extract(frame, weights).collect()}
    assert got == {k: v[1] for k, v in PAGES.items()}
    assert html_content.extract(frame.limit(0), html_content.fit_weights(frame.limit(0))).count() == 0


@pytest.mark.parametrize("scores", [[], [-1.0], [1.0, -2.0, 3.0, -1.0, 2.0, -5.0], [0.0, 2.0, -2.0, 2.0]])
def test_region_is_the_best(scores):
    low, high = html_content.best_region(scores)
    best = max([0.0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
    assert sum(scores[low:high]) == best


def test_loss_digest_of_the_query(spark):
    from lossledger.llm.queries import CONTROL_PROBE, QUERIES

    row = QUERIES["op3_chat_formatting"](spark, "/root/testdata/sf0.001").filter("conv_id = -1").first()
    assert row["n_turns"] == 2 and row["loss_sha256"] == hashlib.sha256(CONTROL_PROBE.encode()).hexdigest()
