"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what they miss.

Units of the field are the number-like tokens of a text (runs of word characters and `.@_%+()-` that hold a digit or an
at sign); every other token is fixed to "none" and enters as a feature of its neighbours only. Tokens that stand next to
each other share a transition potential; tokens of one document that repeat or resemble each other (the same word, the
same local part of an address, the same last seven digits), at any distance, share a skip potential. Each occurrence is
joined to the next one only, so a token that repeats n times has n - 1 skip edges.

Tokens in spans of the fixed patterns are observed. Marginals of the others come from loopy message passing over all
documents of a step at once; a span is added where a label other than "none" has the largest marginal.

Weights maximise the regularised pseudo-likelihood of a bounded sample of the corpus's own documents, labelled by the
patterns, and of written examples that hold the same entities in forms that the patterns do not match.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm.common import map_arrow

#: Kinds in the order of the result.
KINDS = ("email", "ip", "card", "phone")

#: Documents of the sample that weights are fitted on, number-like tokens taken of each at most, written examples.
TRAIN_DOCUMENTS, TRAIN_TOKENS, WRITTEN = 1000, 60, 600
EPOCHS, RATE, PENALTY = 250, 0.1, 2e-3
#: Message passing: rounds at most, part of the old message that stays, change at which it ends.
ROUNDS, DAMPING, SETTLED = 30, 0.3, 1e-4
#: Number-like tokens whose messages are passed together.
STEP_TOKENS = 50_000
CONTEXT = 64
NEVER = -30.0

Span = tuple[str, int, int]


# --- the fixed patterns -----------------------------------------------------------------------------------------

# Possessive forms of the patterns: they match the same spans, since no match can begin inside a run that a match
# could have begun at, and need time in proportion to the text.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            found.append((start, end))
            at = text.find("@", end)
        else:
            # An at sign ends every run of the characters before it, so no later address reaches back over this one.
            end, at = at + 1, text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind, then start; code points, end exclusive."""
    found: list[Span] = [("email", s, e) for s, e in emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if is_ip(m.group())]
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _NOT_DIGIT.sub("", match.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", match.start(), match.end()))
    for match in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", match.group())) <= 15:
            found.append(("phone", match.start(), match.end()))
    return found


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# --- tokens of the field ----------------------------------------------------------------------------------------

LABELS = ("none", "email", "ip", "card", "card more", "phone", "phone more")
NONE = 0
KIND_OF = np.array([0, 1, 2, 3, 3, 4, 4])
FIRST = {"email": 1, "ip": 2, "card": 3, "phone": 5}
MORE = {"email": 1, "ip": 2, "card": 4, "phone": 6}
IS_MORE = np.array([0, 0, 0, 0, 1, 0, 1], bool)

_RUN = re.compile(r"[0-9@][A-Za-z0-9._%+()@-]*")
_RUN_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+()@-")
_WORD_BEFORE, _WORD_AFTER = re.compile(r"(\w{1,20})\W{0,3}$"), re.compile(r"\W{0,3}(\w{1,20})")
_GAP = frozenset(" -,;:/")


@dataclass
class Tokens:
    """Number-like tokens of some documents."""

    words: list[str] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    doc: list[int] = field(default_factory=list)
    joined: list[bool] = field(default_factory=list)  # to the token before it
    context: list[tuple[int, int]] = field(default_factory=list)

    def add(self, doc: int, text: str, most: int | None = None) -> None:
        before, count = -1, 0
        for match in _RUN.finditer(text):
            start, end = match.span()
            while start > max(before, 0) and text[start - 1] in _RUN_CHARACTERS:
                start -= 1
            while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
                end -= 1
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            if start == end:
                continue
            if most is not None and count == most:
                return
            gap = text[before:start] if 0 <= before and start - before <= 2 else "x"
            self.joined.append(count > 0 and all(c in _GAP for c in gap))
            self.words.append(text[start:end])
            self.start.append(start)
            self.end.append(end)
            self.doc.append(doc)
            left, right = _WORD_BEFORE.search(text[max(0, start - 24) : start]), _WORD_AFTER.match(text[end : end + 24])
            self.context.append(tuple(zlib.crc32(m.group(1).lower().encode()) % CONTEXT if m else CONTEXT for m in (left, right)))
            before, count = end, count + 1


_LENGTHS = (0, 1, 2, 3, 4, 5, 7, 8, 10, 13, 20)  # digits from which a class of lengths begins
_SHAPES = {
    "digits": re.compile(r"[0-9]+$"), "bracketed": re.compile(r"\([0-9]+\)$"), "plus": re.compile(r"\+[0-9]"),
    "hyphened": re.compile(r"[0-9]+(-[0-9]+)+$"), "short pair": re.compile(r"[0-9]{3}-[0-9]{4}$"),
    "three groups": re.compile(r"\(?[0-9]{3}\)?[-. ]?[0-9]{3}[-.][0-9]{4}$"), "four groups": re.compile(r"[0-9]{1,3}(-[0-9]{1,3}){3}$"),
    "dotted": re.compile(r"[0-9]+(\.[0-9]+)+$"), "letters": re.compile(r".*[A-Za-z]"), "hex": re.compile(r"[0-9a-f]{12,}$"),
    "at": re.compile(r".+@."), "address": re.compile(r".+@[^@]+\.[^@]+$"), "handle": re.compile(r"[A-Za-z]+[._-][0-9]+$"),
    "underscore": re.compile(r".*_"),
}
_NAMES = ["always", *(f"from {n} digits" for n in _LENGTHS), "check digit", "no check digit", "valid ip", "joined", "joined on", *_SHAPES]
_PLACE = {n: i for i, n in enumerate(_NAMES)}
WIDTH = len(_NAMES) + 2 * (CONTEXT + 1)


def features(tokens: Tokens) -> np.ndarray:
    x = np.zeros((len(tokens.words), WIDTH), np.float32)
    x[:, 0] = 1
    for i, word in enumerate(tokens.words):
        short = word[:80]
        digits = _NOT_DIGIT.sub("", word)
        n = len(digits)
        on = [f"from {max(k for k in _LENGTHS if k <= n)} digits"]
        if 13 <= n <= 19:
            on.append("check digit" if luhn(digits) else "no check digit")
        on += [name for name, shape in _SHAPES.items() if shape.match(short)]
        if "dotted" in on and is_ip(word):
            on.append("valid ip")
        if tokens.joined[i]:
            on.append("joined")
        if i + 1 < len(tokens.words) and tokens.joined[i + 1]:
            on.append("joined on")
        x[i, [_PLACE[name] for name in on]] = 1
        left, right = tokens.context[i]
        x[i, len(_NAMES) + left] = x[i, len(_NAMES) + CONTEXT + 1 + right] = 1
    return x


def skip_edges(tokens: Tokens) -> np.ndarray:
    """Pairs (earlier, later) of tokens of a document that repeat or resemble each other, each with the next one."""
    last: dict[tuple[int, str, str], int] = {}
    edges = set()
    for i, word in enumerate(tokens.words):
        name = word.lower().split("@")[0]
        digits = _NOT_DIGIT.sub("", word)
        keys = [(tokens.doc[i], "word", name)] if len(name) >= 4 else []
        if len(digits) >= 7:
            keys.append((tokens.doc[i], "digits", digits[-7:]))
        for key in keys:
            if key in last:
                edges.add((last[key], i))
            last[key] = i
    return np.array(sorted(edges), np.int64).reshape(-1, 2)


def observed(tokens: Tokens, spans: list[list[Span]]) -> np.ndarray:
    """Label of each token that a span of its document overlaps (the first kind in order), else -1."""
    labels = np.full(len(tokens.words), -1)
    by_doc: dict[int, list[int]] = {}
    for i, d in enumerate(tokens.doc):
        by_doc.setdefault(d, []).append(i)
    for d, members in by_doc.items():
        starts = [tokens.start[i] for i in members]
        for kind, start, end in spans[d]:
            k = int(np.searchsorted(starts, start, side="right")) - 1
            k = max(k, 0)
            inside = False
            while k < len(members) and tokens.start[members[k]] < end:
                i = members[k]
                if tokens.end[i] > start and labels[i] < 0:
                    labels[i] = MORE[kind] if inside and tokens.joined[i] else FIRST[kind]
                    inside = True
                k += 1
    return labels


# --- the field --------------------------------------------------------------------------------------------------

@dataclass
class Field:
    """Weights of features (by label), transitions (label, label) and skips (kind, kind)."""

    weights: np.ndarray
    transitions: np.ndarray
    skips: np.ndarray


def _allowed(joined: np.ndarray) -> np.ndarray:
    """A label that goes on needs a token before it."""
    return np.where(IS_MORE[None, :] & ~joined[:, None], NEVER, 0.0)


def _transition_limits() -> np.ndarray:
    fits = (KIND_OF[:, None] == KIND_OF[None, :]) & (KIND_OF[None, :] > 0)
    return np.where(IS_MORE[None, :] & ~fits, NEVER, 0.0)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def marginals(node: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> np.ndarray:
    """Label marginals by loopy message passing. `node`: log potentials (token, label); `edges`: pairs of token numbers
    with the log potential (label of the first, label of the second) that they share. Exact where edges form no loop
    and no path is longer than `rounds`."""
    n, labels = node.shape
    edges = [(pairs, pot) for pairs, pot in edges if len(pairs)]
    to_second = [np.zeros((len(p), labels)) for p, _ in edges]
    to_first = [np.zeros((len(p), labels)) for p, _ in edges]

    def belief() -> np.ndarray:
        total = node.copy()
        for (pairs, _), second, first in zip(edges, to_second, to_first):
            for label in range(labels):
                total[:, label] += np.bincount(pairs[:, 1], second[:, label], n) + np.bincount(pairs[:, 0], first[:, label], n)
        return total

    def message(out: np.ndarray, potential: np.ndarray, old: np.ndarray) -> np.ndarray:
        new = np.stack([_log_sum(out + potential[:, k]) for k in range(labels)], axis=1)
        new -= _log_sum(new)[:, None]
        return DAMPING * old + (1 - DAMPING) * new

    for _ in range(rounds if edges else 0):
        total, change = belief(), 0.0
        for k, (pairs, potential) in enumerate(edges):
            second = message(total[pairs[:, 0]] - to_first[k], potential, to_second[k])
            first = message(total[pairs[:, 1]] - to_second[k], potential.T, to_first[k])
            change = max(change, np.abs(second - to_second[k]).max(), np.abs(first - to_first[k]).max())
            to_second[k], to_first[k] = second, first
        if change < SETTLED:
            break
    total = belief()
    return np.exp(total - _log_sum(total)[:, None])


def chain_edges(joined: np.ndarray) -> np.ndarray:
    later = np.flatnonzero(joined)
    return np.stack([later - 1, later], axis=1)


def predicted(model: Field, tokens: Tokens, known: np.ndarray) -> np.ndarray:
    """Label of each token; `known` ones (not negative) stay."""
    if not len(tokens.words):
        return known
    joined = np.array(tokens.joined)
    node = features(tokens).astype(np.float64) @ model.weights + _allowed(joined)
    fixed = known >= 0
    node[fixed] = NEVER
    node[np.flatnonzero(fixed), known[fixed]] = 0
    skip = model.skips[KIND_OF][:, KIND_OF]
    edges = [(chain_edges(joined), model.transitions + _transition_limits()), (skip_edges(tokens), skip)]
    return np.where(fixed, known, marginals(node, edges).argmax(axis=1))


def fit_field(tokens: Tokens, labels: np.ndarray) -> Field:
    """Pseudo-likelihood: each token's label given its features and its neighbours' labels; Adam over all of them."""
    x, joined = features(tokens), np.array(tokens.joined)
    n, size = len(x), len(LABELS)
    truth = np.eye(size, dtype=np.float32)[labels]
    left, right, near = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32), np.zeros((n, 5), np.float32)
    pairs = chain_edges(joined)
    left[pairs[:, 1]], right[pairs[:, 0]] = truth[pairs[:, 0]], truth[pairs[:, 1]]
    kinds = np.eye(5, dtype=np.float32)[KIND_OF]
    for a, b in skip_edges(tokens):
        near[a] += truth[b] @ kinds
        near[b] += truth[a] @ kinds
    limits, allowed = _transition_limits().astype(np.float32), _allowed(joined).astype(np.float32)
    values = [np.zeros((WIDTH, size), np.float32), np.zeros((size, size), np.float32), np.zeros((5, 5), np.float32)]
    mean, spread = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, EPOCHS + 1):
        w, t, s = values
        score = x @ w + left @ (t + limits) + right @ (t + limits).T + near @ s @ kinds.T + allowed
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=1, keepdims=True)
        wrong = (p - truth) / n
        by_kind = wrong @ kinds
        slopes = [x.T @ wrong, left.T @ wrong + wrong.T @ right, (near.T @ by_kind + by_kind.T @ near) / 2]
        for k, slope in enumerate(slopes):
            slope = slope + PENALTY * values[k] / 10
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            spread[k] = 0.999 * spread[k] + 0.001 * slope**2
            values[k] = values[k] - RATE * mean[k] / (1 - 0.9**step) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
    return Field(*(v.astype(np.float64) for v in values))


# --- what weights are fitted on ---------------------------------------------------------------------------------

def own_labels(tokens: Tokens, known: np.ndarray) -> np.ndarray:
    """Known labels; a token that a pattern matches when it stands alone has that label too; others none."""
    labels = known.copy()
    for i in np.flatnonzero(known < 0):
        alone = [k for k, s, e in base_spans(tokens.words[i]) if (s, e) == (0, len(tokens.words[i]))]
        labels[i] = FIRST[alone[0]] if alone else NONE
    return labels


def _card(r: random.Random) -> str:
    body = "".join(r.choice("0123456789") for _ in range(15))
    return body + next(c for c in "0123456789" if luhn(body + c))


def _forms(kind: str, r: random.Random) -> tuple[str, list[str]]:
    """An entity as the patterns know it, and other forms of it that they miss."""
    if kind == "email":
        name = "".join(r.choice("abdeghilmnorstu") for _ in range(r.randint(3, 8))) + f".{r.randint(0, 99):02}"
        host = f"mail{r.randint(0, 9)}.example.com"
        return f"{name}@{host}", [name, f"{name}@{host.split('.')[0]}"]
    if kind == "ip":
        parts = [str(r.randint(1, 255)) for _ in range(4)]
        return ".".join(parts), ["-".join(parts)]
    if kind == "card":
        card = _card(r)
        return card, [f"{card} {card}", f"{card} {card} {card}"]
    a, b, c = r.randint(100, 999), r.randint(100, 999), f"{r.randint(0, 9999):04}"
    return f"+{r.randint(1, 99)} ({a}) {b}-{c}", [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{b}-{c}"]


def _other(r: random.Random) -> str:
    """Numbers that are nobody's."""
    n, digit = r.randint, lambda k: "".join(r.choice("0123456789") for _ in range(k))
    wrong = _card(r)
    wrong = wrong[:-1] + str((int(wrong[-1]) + n(1, 9)) % 10)
    return r.choice([
        str(n(1, 99)), str(n(1900, 2030)), f"{n(0, 9)}.{n(0, 99)}", f"{n(1, 9)}.{n(0, 99)}.{n(0, 99)}", f"{n(1, 999)},{digit(3)}",
        wrong, digit(n(5, 12)), digit(n(20, 30)), f"{n(1990, 2030)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(0, 23)}:{n(10, 59)}",
        f"{n(10, 99)}-{digit(4)}", f"{n(256, 999)}.{n(0, 999)}.{n(0, 999)}.{n(0, 999)}", f"({n(1, 20)})", f"v{n(1, 20)}.{n(0, 9)}",
        "".join(r.choice("0123456789abcdef") for _ in range(n(16, 40))), f"part.{n(10, 99)}", f"{n(1, 99)}%", f"{n(1, 9)}-{n(1, 9)}",
    ])


def written_example(r: random.Random) -> tuple[str, list[Span], list[Span]]:
    """A text, the spans that the patterns are to find in it, and the others that name the same entities.

    An address's name alone counts as personal only where the address stands in the same text, and so do the last
    digits of a phone number.
    """
    pieces: list[tuple[str, str | None, bool]] = []

    def words() -> None:
        pieces.append((" ".join("".join(r.choice("aeinorst") for _ in range(r.randint(2, 8))) for _ in range(r.randint(1, 6))), None, False))

    for kind in r.sample(KINDS, r.randint(0, 2)):
        plain, others = _forms(kind, r)
        mentions = [(plain, kind, True)] if r.random() < 0.7 else []
        alone = others if mentions else [o for o in others if kind == "card" or (kind == "phone" and len(o) > 8)]
        mentions += [(r.choice(alone), kind, False)] if alone and r.random() < 0.8 else []
        for m in mentions:
            words()
            pieces.append(m)
    for _ in range(r.randint(0, 4)):
        words()
        pieces.insert(r.randint(0, len(pieces)), (_other(r), None, False))
    words()
    text, base, more = "", [], []
    for value, kind, plain in pieces:
        text += (" " if text.endswith("\n") or not text else r.choice([", ", " and ", " or "])) if kind is None or text[-1:].isdigit() else " "
        at = len(text)
        text += value
        if kind == "card" and not plain:
            for m in re.finditer("[0-9]+", value):
                more.append((kind, at + m.start(), at + m.end()))
        elif kind:
            (base if plain else more).append((kind, at, at + len(value)))
    return text, base, more


def _examples(seed: int, count: int) -> tuple[Tokens, np.ndarray]:
    r, tokens, spans = random.Random(seed), Tokens(), []
    for k in range(count):
        text, base, more = written_example(r)
        tokens.add(k, text)
        spans.append(base + more)
    labels = observed(tokens, spans)
    return tokens, np.where(labels < 0, NONE, labels)


def sampled(docs: DataFrame, most: int = TRAIN_DOCUMENTS) -> list[str]:
    """At most `most` texts by the hash of their id, of those with a digit or an at sign, cut to windows around them.

    Ids' hashes come first, so only about as many texts as are wanted leave the scan.
    """
    total = docs.count()
    hashed = docs.select(F.xxhash64("doc_id").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    if total > 20 * most:
        hashed = hashed.filter(F.pmod("h", F.lit(total // (20 * most) + 1)) == 0)
    windows = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"([^\n]{0,60}[0-9@][^\n]{0,80})"), 1), 1, TRAIN_TOKENS), "\n")
    rows = hashed.filter(F.col("text").rlike("[0-9@]")).select("h", windows.alias("text"))
    return [r["text"] for r in rows.orderBy("h", "text").limit(most).collect()]


def fit(docs: DataFrame) -> Field:
    """Weights from a sample of `docs` (doc_id, text) and written examples."""
    tokens, labels = _examples(1, WRITTEN)
    texts = sampled(docs)
    own = Tokens()
    for k, text in enumerate(texts):
        own.add(k, text, TRAIN_TOKENS)
    own_known = own_labels(own, observed(own, [base_spans(t) for t in texts]))
    for name in ("words", "start", "end", "joined", "context"):
        getattr(tokens, name).extend(getattr(own, name))
    shift = WRITTEN
    tokens.doc.extend(d + shift for d in own.doc)
    return fit_field(tokens, np.concatenate([labels, own_known]))


# --- all documents ----------------------------------------------------------------------------------------------

def added_spans(tokens: Tokens, known: np.ndarray, labels: np.ndarray) -> list[tuple[int, Span]]:
    """(document, span) of each run of tokens with a label that no pattern gave."""
    found: list[tuple[int, str, int, int]] = []
    for i in np.flatnonzero((known < 0) & (labels > 0)):
        kind = KINDS[KIND_OF[labels[i]] - 1]
        if IS_MORE[labels[i]] and found and found[-1][0] == tokens.doc[i] and found[-1][1] == kind and tokens.joined[i] and found[-1][3] == tokens.end[i - 1]:
            found[-1] = (*found[-1][:3], tokens.end[i])
        else:
            found.append((tokens.doc[i], kind, tokens.start[i], tokens.end[i]))
    return [(d, (kind, s, e)) for d, kind, s, e in found]


_HAS = re.compile("[0-9@]")


def find_spans(texts: list[str], model: Field) -> list[tuple[list[Span], list[Span]]]:
    """Spans of the patterns, and all spans, of each text."""
    base = [base_spans(t) if _HAS.search(t) else [] for t in texts]
    result = [(b, b) for b in base]
    more: dict[int, list[Span]] = {}
    tokens = Tokens()

    def settle() -> None:
        known = observed(tokens, base)
        for d, span in added_spans(tokens, known, predicted(model, tokens, known)):
            more.setdefault(d, []).append(span)

    for k, text in enumerate(texts):
        if _HAS.search(text):
            tokens.add(k, text)
        if len(tokens.words) >= STEP_TOKENS:
            settle()
            tokens = Tokens()
    settle()
    for d, spans in more.items():
        result[d] = base[d], sorted(base[d] + spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return result


def _pass(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find_spans([t or "" for t in batch.column("text").to_pylist()], model)
            counts = [pa.array([sum(k == kind for k, _, _ in b) for b, _ in found], pa.int64()) for kind in KINDS]
            spans = [pa.array([spelled(x[i]) for x in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, *spans], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"]
            )

    return run


def personal_data(docs: DataFrame, model: Field) -> DataFrame:
    """Per row of `docs` (doc_id of any type, text): counts and spans of the patterns, and all spans with those added.

    Spans are `kind:start:end`, by kind, then start. A null or empty text has none. Repeated rows each have a row;
    other columns are not read; an empty table has an empty result. A very long text is read whole, in time and memory
    in proportion to its length.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
        T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType()),
    ])
    return map_arrow(docs.select("doc_id", "text"), _pass(model), schema)
