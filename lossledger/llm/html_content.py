"""Main text of web pages: the maximum-scoring subsequence of a page's tags and words.

A page is a sequence of tags and text runs. Words score positive where content stands and negative inside
boilerplate, tags negative; the weights are log-odds counted on labelled pages (pages that mark their content with
<article> or <main>). One linear scan finds the contiguous region with the largest sum. The text of the region, less
what boilerplate elements inside it hold, is joined block by block.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.llm.common import map_arrow

#: At most about so many labelled pages, chosen by a hash of page_id, fit the weights.
FIT_PAGES = 20_000

#: Boilerplate inside an element that marks content is cut out, and should not divide the content.
INSET_WEIGHT = -0.001
#: Elsewhere a run of boilerplate costs no more than this, so that it does not part long texts around it.
RUN_FLOOR = -8.0
#: On a page without marked content, a block of so many words under a form or a listed class or id is judged as its
#: tag says; a shorter one counts as boilerplate, but stays in the text if the region around it wins.
SHORT_BLOCK = 12

# A quote opens a value only right behind the equals sign; elsewhere it is a character like others. Possessive, so that
# every character is read once.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<attributes>(?:[\s/]*+[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))?+)*+)"
    r"(?P<tail>[\s/]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s/"'])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))""")
_NAME_PART = re.compile(r"[a-z]+")
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object"}
_FOREIGN = {"svg", "math"}  # only these may close themselves with a slash
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_HOLDERS = set("ul ol dl table tbody thead tfoot tr article main section div body".split())
_CONTENT = {"article", "main"}
_BOILERPLATE = set("nav footer aside form button select dialog head menu".split())
_BOILERPLATE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer comment comments disqus respond replies cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription social share sharing related recommended "
    "recommendations widget widgets login signup search skip toolbar".split()
)
# Headers are boilerplate of the page, not of the article.
# Marks, the stronger ones last: forms and names are evidence only, as they also stand around whole pages; tags and
# roles exclude; and not even an article inside the last ends them.
NONE, EVIDENCE, EXCLUDED, SHUT = range(4)
_SHUT, _SHUT_ROLES = {"nav", "footer"}, {"navigation", "contentinfo"}
_SHUT_NAMES = {"comment", "comments", "disqus", "respond", "replies"}
_COMMENTS = re.compile("|".join(sorted(_SHUT_NAMES)), re.I)
# A class that tells how many or whether there are comments is no class of a comment.
_TOLD_NAMES = set("open closed count counts link links off on enabled disabled allowed no has with without number".split())
_PAGE_ONLY, _PAGE_ONLY_NAMES = {"header"}, {"header", "banner", "masthead"}
_BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu".split())


@dataclass(frozen=True)
class Part:
    """A tag (text empty) or a run of text; `kind` is its feature."""

    kind: str
    text: str
    breaks: bool
    boilerplate: bool
    labelled: bool
    evidence: bool = False  # boilerplate only if the page marks its content, or by its length


def _mark(name: str, attributes: str, in_content: bool, shut: int) -> int:
    if name in _CONTENT or name in ("html", "body"):
        return NONE
    if name in _SHUT:
        return SHUT
    found = NONE
    if name in _BOILERPLATE or name in _PAGE_ONLY and not in_content:
        found = EVIDENCE if name == "form" else EXCLUDED
    if "=" not in attributes:
        return found
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "role" and value in _BOILERPLATE_ROLES:
            form = value in ("form", "search")
            found = max(found, SHUT if value in _SHUT_ROLES else EVIDENCE if form else EXCLUDED)
        if key in ("class", "id"):
            parts = set(_NAME_PART.findall(value))
            if parts & _SHUT_NAMES and any(w & _SHUT_NAMES and not w & _TOLD_NAMES for w in (set(_NAME_PART.findall(v)) for v in value.split())):
                found = max(found, shut)
            elif parts - _SHUT_NAMES & _BOILERPLATE_NAMES or not in_content and parts & _PAGE_ONLY_NAMES:
                found = max(found, EVIDENCE)
    return found


def _inside(name: str, attributes: str, mark: int, in_content: bool, shut: int) -> int:
    """The mark of an element within one with `mark`. An article ends evidence, and what excludes around the content."""
    if name in _CONTENT and (mark == EVIDENCE or mark == EXCLUDED and not in_content):
        return NONE
    return max(mark, _mark(name, attributes, in_content, shut))


def _place(boilerplate: bool, content: bool) -> str:
    return "" if not boilerplate else "inset" if content else "boilerplate"


@dataclass(frozen=True)
class _Open:
    name: str
    mark: int
    content: bool
    block: str  # the nearest block or link, itself included


class _Stack:
    """Open elements, and for each name the places where it is open, so that nothing is searched."""

    def __init__(self):
        self.open: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.top = _Open("", NONE, False, "none")

    def push(self, name: str, mark: int, content: bool) -> None:
        block = name if name in _BLOCK or name == "a" else self.top.block
        self.top = _Open(name, mark, content, block)
        self.places.setdefault(name, []).append(len(self.open))
        self.open.append(self.top)

    def _last(self, names: set[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def close(self, names: set[str], holders: set[str] = frozenset()) -> None:
        """End the innermost element of these names, with all inside it, unless a holder stands in between."""
        at = self._last(names)
        if at < 0 or at < self._last(holders - names):
            return
        for element in reversed(self.open[at:]):
            self.places[element.name].pop()
        del self.open[at:]
        self.top = self.open[-1] if self.open else _Open("", NONE, False, "none")


def parse(page: str, shut: int = SHUT) -> Iterator[Part]:
    """Parts of a page in order. Elements left open end where an element around them ends.

    `shut` is the mark of elements whose class names comments. The time is in proportion to the page's length.
    """
    stack = _Stack()

    def text_part(text: str) -> Iterator[Part]:
        if text:
            mark, content = stack.top.mark, stack.top.content
            boilerplate = mark > NONE
            kind = f"words:{_place(boilerplate, content) or stack.top.block}"
            yield Part(kind, text, False, boilerplate, content and not boilerplate, mark == EVIDENCE and not content)

    at = 0
    while m := _TOKEN.search(page, at):
        yield from text_part(page[at : m.start()])
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        mark, content = stack.top.mark, stack.top.content
        if m["end"]:
            if name not in _VOID:
                stack.close({name})
        else:
            if name in _RAW:
                if name not in _FOREIGN or "/" not in m["tail"]:
                    stop = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
                    at = page.find(">", stop.start()) + 1 or len(page) if stop else len(page)
                continue
            if name in _BLOCK:
                stack.close({"p"}, _HOLDERS)
            if name in _CLOSES:
                stack.close(_CLOSES[name], _HOLDERS)
            mark, content = stack.top.mark, stack.top.content
        if not m["end"] and name not in _VOID:
            mark = _inside(name, m["attributes"], mark, content, shut)
            content = content or name in _CONTENT
            stack.push(name, mark, content)
        boilerplate = mark > NONE
        known = name if name in _BLOCK or name in ("a", "b", "i", "em", "strong", "span", "br", "img") else "other"
        kind = f"tag:{_place(boilerplate, content) or known}"
        space = "\n" if name in _BLOCK else " " if name == "br" else ""
        evidence = mark == EVIDENCE and not content
        yield Part(kind, space, bool(space.strip(" ")), boilerplate, content and not boilerplate, evidence)
    yield from text_part(page[at:])


def is_tag(part: Part) -> bool:
    return part.kind.startswith("tag:")


def count_labels(page: str) -> Counter:
    """(kind, inside the labelled content) -> words or tags; nothing for a page without a label."""
    counts: Counter = Counter()
    for part in parse(page):
        counts[part.kind, part.labelled] += 1 if is_tag(part) else len(part.text.split())
    return counts if any(inside for _, inside in counts) else Counter()


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds of content for each kind: words within [-4, 4], tags within [-1, -0.02]. The prior takes words outside
    boilerplate for content, so kinds that no labelled page shows count as such."""
    weights = {}
    for kind in {k for k, _ in counts if not k.endswith(":inset")}:
        inside, outside = counts.get((kind, True), 0), counts.get((kind, False), 0)
        if kind.startswith("tag:"):
            weights[kind] = min(-0.02, max(-1.0, math.log((inside + 1) / (outside + 1))))
        else:
            prior = 1 if kind == "words:boilerplate" else 20
            weights[kind] = min(4.0, max(-4.0, math.log((inside + prior) / (outside + 1))))
    return weights


def weight(weights: dict[str, float], kind: str) -> float:
    if kind.endswith(":inset"):
        return INSET_WEIGHT
    if kind in weights:
        return weights[kind]
    if kind.endswith(":boilerplate"):
        return -2.0
    return -0.1 if kind.startswith("tag:") else 1.0


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum, the first of equal ones; empty if none is positive."""
    best, low, high, total, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, low, high = total, start, i + 1
    return low, high


def _weighed(parts: list[Part]) -> list[Part]:
    """Without marked content, parts under evidence are judged: long blocks as plain words, short ones as boilerplate
    that is not cut out."""
    if any(p.labelled for p in parts) or not any(p.evidence for p in parts):
        return parts
    made, start = list(parts), 0
    ends = [i for i, p in enumerate(parts) if p.breaks] + [len(parts)]
    for end in ends:
        words = sum(len(p.text.split()) for p in parts[start:end])
        for i in range(start, min(end + 1, len(parts))):
            p = parts[i]
            if p.evidence:
                long = words >= SHORT_BLOCK
                kind = p.kind.replace(":boilerplate", ":p") if long or is_tag(p) else p.kind
                made[i] = Part(kind, p.text, p.breaks, False, False, True)
        start = end + 1
    return made


def main_text(page: str, weights: dict[str, float]) -> str:
    """The text of the best region. Where all that a page has lies under classes that name comments, these are evidence
    only: the page is not a comment as a whole."""
    text = _region_text(page, weights, SHUT)
    return text if text or not _COMMENTS.search(page) else _region_text(page, weights, EVIDENCE)


def _region_text(page: str, weights: dict[str, float], shut: int) -> str:
    parts = _weighed(list(parse(page, shut)))
    # Text runs become readable before they are counted and joined.
    texts = [p.text if is_tag(p) else html.unescape(p.text) for p in parts]
    scores, run = [], 0.0
    for part, text in zip(parts, texts):
        score = weight(weights, part.kind) * (1 if is_tag(part) else len(text.split()))
        if part.boilerplate:
            score = max(score, RUN_FLOOR - run)
        run = run + score if part.boilerplate else 0.0
        scores.append(score)
    low, high = best_region(scores)
    blocks, block = [], []
    for part, text in zip(parts[low:high], texts[low:high]):
        if part.breaks:
            blocks.append("".join(block))
            block = []
        elif not part.boilerplate:
            block.append(text)
    blocks.append("".join(block))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def fit_weights(pages: DataFrame, fit_pages: int = FIT_PAGES) -> dict[str, float]:
    """Weights from labelled pages. The driver gets two numbers for each of the fixed kinds."""
    marked = pages.filter(F.lower("html").rlike(r"<(article|main)[\s>]")).select("page_id", "html")
    found = marked.count()
    if found > fit_pages:
        share = F.pmod(F.xxhash64("page_id"), F.lit(1_000_000))
        marked = marked.filter(share < int(1_000_000 * fit_pages / found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column("html"):
                counts.update(count_labels(page.as_py()))
        keys = sorted(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
             pa.array([counts[k] for k in keys], pa.int64())],
            names=["kind", "inside", "count"],
        )

    counted = map_arrow(marked.select("html"), run, "kind string, inside boolean, count bigint")
    rows = counted.groupBy("kind", "inside").agg(F.sum("count").alias("count")).collect()
    return weights_from({(r["kind"], r["inside"]): r["count"] for r in rows})


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text for every row of `pages`; a null or empty page, or one without content, has the empty text.

    Pages are worked on one by one where they are read. Repeated rows give repeated rows; other columns are ignored. A
    very long page is read whole, in time and memory in proportion to its length.
    """
    rest = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                piece = batch.slice(low, 500)
                texts = [main_text(page.as_py() or "", weights) for page in piece.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in rest.schema.fields}
    return map_arrow(rest, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
