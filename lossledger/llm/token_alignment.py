"""Alignment of two tokenizers' tokens over the bytes of each text, and how often their tokens meet in a corpus.

Tokens of A and B are half-open byte ranges. Where ranges overlap, two tokens are linked; where tokens of both end at
one byte, the sequences are cut into groups. One NumPy state vector holds a pointer into A and one into B for every
lane; a step emits a link per lane, a cut where both ends agree, and moves the pointer (or both) whose token ends
first. Lanes are the documents of a batch, those of more than `LANE` tokens in pieces, so a very long text does not
leave the other lanes idle; a piece finds its first B token by its byte. Finished lanes leave the vector.

How many documents hold a pair of ids is counted over batches: a batch of documents names each of its pairs once, with
the number of its documents that hold it. Batches ask for their own pairs and get counts back, so what is shuffled are
pairs of batches instead of pairs of documents. A frequent pair has a row per batch; sums are partial before they move.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm.common import map_arrow, share_package, stored

#: A tokens of a lane; bytes of text that are tokenized at once, and that share one list of pairs.
LANE, STEP_BYTES, BATCH_BYTES = 256, 1_000_000, 4_000_000
#: Ids of B are below this; a pair is id of A times this plus id of B.
B_IDS = 1 << 20
SPACE = "▁"
BATCH_BITS = 24


# --- vocabularies -----------------------------------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The published byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class TokenTable:
    """Bytes of every token of a vocabulary, in one array with offsets."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.bytes, self.starts[ids], self.sizes[ids])


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[s : s + n] for all (s, n), joined."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    return values[at]


class Tokenizers:
    """A: byte-level BPE of a `tokenizers` file; B: a SentencePiece model that puts a space before a text."""

    def __init__(self, file_a: str, file_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        letters = _byte_letters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.table_a = TokenTable([bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.table_b = TokenTable([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ])
        if self.b.get_piece_size() > B_IDS:
            raise ValueError("too many pieces")
        self.ranked = _ranked(file_a, letters)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of A. Texts in alphabets whose character classes are the same in all Unicode versions go through the
        ranks of the file, where it has such; others through the library that the file is made for."""
        ids: list[list[int]] = [[]] * len(texts)
        rest = []
        for k, text in enumerate(texts):
            if self.ranked is not None and not _UNSETTLED.search(text):
                ids[k] = self.ranked.encode_ordinary(text)
            else:
                rest.append(k)
        for k, found in zip(rest, self.a.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            ids[k] = found.ids
        return ids

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [np.array(ids, np.int64) for ids in self.encode_a([" " + t for t in texts])]
        b = [np.array(ids, np.int64) for ids in self.b.encode(texts, num_threads=1)]
        return a, b


#: Fixed value: the published pattern by which byte-level BPE splits a text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Latin, Greek and Cyrillic characters of the first Unicode versions, and what surrounds them.
_UNSETTLED = re.compile("[^\x00-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u045f]")


def _ranked(file_a: str, letters: dict[str, int]):
    """The vocabulary of a byte-level BPE file as ranks, if a merge's place in the list is that of its id; else None."""
    import tiktoken

    with open(file_a, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and not spec.get("normalizer") and not model.get("ignore_merges") and not model.get("dropout")
        and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    )
    if not plain:
        return None
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    vocabulary = model["vocab"]
    if any(vocabulary.get(m) != 256 + k for k, m in enumerate(merges)):
        return None
    own = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=own, special_tokens={})


@lru_cache(maxsize=2)
def tokenizers_of(file_a: str, file_b: str) -> Tokenizers:
    return Tokenizers(file_a, file_b)


# --- lockstep ---------------------------------------------------------------------------------------------------

@dataclass
class Links:
    """Positions of linked tokens, and of the last A and B token of each group, ascending."""

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def lanes(counts: np.ndarray, size: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """First token of each lane and the one after its last, for documents of so many A tokens."""
    pieces = -(-counts // size)
    first = np.repeat(np.cumsum(counts) - counts, pieces)
    within = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = first + within * size
    return starts, np.minimum(starts + size, np.repeat(np.cumsum(counts), pieces))


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Links:
    """All links and cuts. `ends_*` are the byte ends of the tokens of all documents, laid one after another."""
    at_a = starts.copy()
    begin = np.where(at_a > 0, ends_a[at_a - 1], 0) if len(at_a) else at_a
    at_b = np.searchsorted(ends_b, begin, side="right")
    none = np.empty(0, np.int64)
    link_a, link_b, cut_a, cut_b = [none], [none], [none], [none]
    while len(at_a):
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        link_a.append(at_a)
        link_b.append(at_b)
        both = end_a == end_b
        cut_a.append(at_a[both])
        cut_b.append(at_b[both])
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
        going = at_a < stops
        if not going.all():
            at_a, at_b, stops = at_a[going], at_b[going], stops[going]
    return Links(
        np.concatenate(link_a), np.concatenate(link_b), np.sort(np.concatenate(cut_a)), np.sort(np.concatenate(cut_b))
    )


# --- one step: some texts ---------------------------------------------------------------------------------------

_WIDTH = 8
COMMA, BAR, SEMICOLON = map(ord, ",|;")


@lru_cache(maxsize=4)
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal names of 0 .. size - 1, each with room for a sign behind it, and their lengths."""
    names = np.char.encode(np.arange(size).astype(str), "ascii")
    table = np.zeros((size, _WIDTH), np.uint8)
    raw = names.view(np.uint8).reshape(size, -1)
    table[:, : raw.shape[1]] = raw
    return table.reshape(-1), np.char.str_len(names).astype(np.int64)


def group_text(a: np.ndarray, b: np.ndarray, links: Links, ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The groups of all documents as `a1,a2|b1;...;` in one array, the place behind each A and behind each B token."""
    table, lengths = _digits(ids)
    in_group_a = np.zeros(len(a) + 1, np.int64)
    in_group_a[links.cut_a + 1] = 1
    in_group_b = np.zeros(len(b) + 1, np.int64)
    in_group_b[links.cut_b + 1] = 1
    before_b = np.concatenate([[0], links.cut_b + 1])
    slot_a = np.arange(len(a)) + before_b[np.cumsum(in_group_a)[:-1]]
    slot_b = np.arange(len(b)) + (links.cut_a + 1)[np.cumsum(in_group_b)[:-1]]
    order = np.empty(len(a) + len(b), np.int64)
    order[slot_a], order[slot_b] = a, b
    signs = np.full(len(order), COMMA, np.uint8)
    signs[slot_a[links.cut_a]] = BAR
    signs[slot_b[links.cut_b]] = SEMICOLON
    sizes = lengths[order] + 1
    ends = np.cumsum(sizes)
    text = gather(table, order * _WIDTH, sizes)
    text[ends - 1] = signs
    return text, ends[slot_a], ends[slot_b]


@dataclass
class Aligned:
    """Results of some texts: a number or digest per text; text number, pair and times for each pair of a text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def ends_of(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts, dtype=np.int64)


def pieces_of(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(values, ends_of(counts)[:-1])


def align_texts(texts: list[str], tokenizers: Tokenizers) -> Aligned:
    n = len(texts)
    result = Aligned(*(np.zeros(n, np.int64) for _ in range(4)), [""] * n, *(np.empty(0, np.int64) for _ in range(3)))
    present = [k for k, t in enumerate(texts) if t]
    if not present:
        return result
    tokens_a, tokens_b = tokenizers.encode([texts[k] for k in present])
    kept = []
    for k, a, b in zip(present, tokens_a, tokens_b):
        wanted = np.frombuffer(b" " + texts[k].encode(), np.uint8)
        if np.array_equal(tokenizers.table_a.spell(a), wanted) and np.array_equal(tokenizers.table_b.spell(b), wanted):
            kept.append((k, a, b))
    if not kept:
        return result
    docs = np.array([k for k, _, _ in kept])
    count_a, count_b = np.array([len(a) for _, a, _ in kept]), np.array([len(b) for _, _, b in kept])
    a, b = np.concatenate([a for _, a, _ in kept]), np.concatenate([b for _, _, b in kept])
    links = lockstep(ends_of(tokenizers.table_a.sizes[a]), ends_of(tokenizers.table_b.sizes[b]), *lanes(count_a))
    doc_of_a = np.repeat(np.arange(len(kept)), count_a)
    result.n_a[docs], result.n_b[docs] = count_a, count_b
    result.n_links[docs] = np.bincount(doc_of_a[links.a], minlength=len(kept))
    result.n_groups[docs] = np.bincount(doc_of_a[links.cut_a], minlength=len(kept))

    text, _, behind_b = group_text(a, b, links, max(len(tokenizers.table_a.sizes), len(tokenizers.table_b.sizes)))
    raw, start = text.tobytes(), 0
    for k, end in zip(docs, behind_b[ends_of(count_b) - 1]):
        result.digests[k] = hashlib.sha256(raw[start : end - 1]).hexdigest()  # without the last semicolon
        start = end

    pairs = a[links.a] * B_IDS + b[links.b]
    names, code = np.unique(pairs, return_inverse=True)
    keys, result.times = np.unique(doc_of_a[links.a] * len(names) + code, return_counts=True)
    result.doc, result.pair = docs[keys // len(names)], names[keys % len(names)]
    return result


# --- the pass over documents ------------------------------------------------------------------------------------

def _fields(key: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("batch", T.LongType()),
        T.StructField("doc_id", key),
        *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("places", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.IntegerType())),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("holders", T.ArrayType(T.IntegerType())),
    ])


def _list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType, missing: int = 0, first: bool = False) -> pa.Array:
    """Lists of so many values each; `missing` nulls before or after them."""
    offsets = np.concatenate([[0], ends_of(counts)]).astype(np.int32)
    made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))
    nulls = pa.nulls(missing, made.type)
    return pa.concat_arrays([nulls, made] if first else [made, nulls])


def _batch_rows(batch: int, keys: pa.Array, parts: list[Aligned]) -> pa.RecordBatch:
    """A row per document with places in the list of pairs, and one row with that list."""
    sizes = [len(p.digests) for p in parts]
    shifts = np.cumsum(sizes) - sizes
    doc = np.concatenate([p.doc + s for p, s in zip(parts, shifts)])
    names, place, holders = np.unique(np.concatenate([p.pair for p in parts]), return_inverse=True, return_counts=True)
    n = len(keys)
    per_doc = np.bincount(doc, minlength=n)

    def column(name: str) -> pa.Array:
        return pa.concat_arrays([pa.array(np.concatenate([getattr(p, name) for p in parts])), pa.nulls(1, pa.int64())])

    digests = [d for p in parts for d in p.digests]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n + 1, batch)),
            pa.concat_arrays([keys, pa.nulls(1, keys.type)]),
            *(column(c) for c in ("n_a", "n_b", "n_groups", "n_links")),
            pa.array([*digests, None], pa.string()),
            _list_array(place, per_doc, pa.int32(), 1),
            _list_array(np.concatenate([p.times for p in parts]), per_doc, pa.int32(), 1),
            _list_array(names, np.array([len(names)]), pa.int64(), n, first=True),
            _list_array(holders, np.array([len(names)]), pa.int32(), n, first=True),
        ],
        names=["batch", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "pairs", "holders"],
    )


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str], int]]:
    """Consecutive rows with about `STEP_BYTES` of text."""
    if not len(batch):
        return
    text = batch.column("text").cast(pa.large_string())
    sizes = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1])
    start = 0
    while start < len(text):
        total, stop = 0, start
        while stop < len(text) and (stop == start or total + sizes[stop] <= STEP_BYTES):
            total += int(sizes[stop])
            stop += 1
        yield batch.column("doc_id").slice(start, stop - start), [t or "" for t in text.slice(start, stop - start).to_pylist()], total
        start = stop


def _pass(file_a: str, file_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizers = tokenizers_of(file_a, file_b)
        number = TaskContext.get().partitionId() << BATCH_BITS
        keys, parts, size = [], [], 0
        for batch in batches:
            for key, texts, total in _steps(batch):
                if parts and size + total > BATCH_BYTES:
                    yield _batch_rows(number, pa.concat_arrays(keys), parts)
                    keys, parts, size, number = [], [], 0, number + 1
                keys.append(key)
                parts.append(align_texts(texts, tokenizers))
                size += total
        if parts:
            yield _batch_rows(number, pa.concat_arrays(keys), parts)

    return run


def aligned(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """The stored pass over `docs` (doc_id of any type, text): rows of documents, and a row of pairs for each batch."""
    schema = _fields(docs.schema["doc_id"].dataType)
    return stored(map_arrow(docs.select("doc_id", "text"), _pass(file_a, file_b), schema))


def batch_pairs(passed: DataFrame) -> DataFrame:
    """(batch, place, pair, holders): each pair of a batch once."""
    lists = passed.filter("pairs is not null").select("batch", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "p"))
    return lists.select("batch", "place", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, documents, best): documents that hold the pair; whether no pair with that A id has more.

    The highest counts have a row per id of A, so their size is bounded by its vocabulary.
    """
    counts = pairs.groupBy("pair").agg(F.sum("holders").alias("documents"))
    counts = counts.withColumn("a_id", F.floor(F.col("pair") / B_IDS))
    highest = counts.groupBy("a_id").agg(F.max("documents").alias("highest"))
    return counts.join(F.broadcast(highest), "a_id").select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))


RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _with_counts(docs: pa.Table, found: pa.Table) -> pa.Table:
    count, best = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    place = found.column("place").to_numpy()
    count[place] = found.column("documents").to_numpy()
    best[place] = found.column("best").to_numpy()
    places, times = (docs.column(c).combine_chunks() for c in ("places", "times"))
    sizes = places.value_lengths().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(docs)), sizes)
    at, n = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)

    def summed(values: np.ndarray) -> pa.Array:
        sums = np.concatenate([[0], np.cumsum(values[at] * n)])
        stops = ends_of(sizes)
        return pa.array(sums[stops] - sums[stops - sizes] if len(doc) else np.zeros(len(docs), np.int64))

    same = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(same | {"n_best": summed(best), "count_sum": summed(count), "groups_sha256": docs.column("groups_sha256")})


def scored_alignment(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """Per row of `docs`: tokens, groups and links of its alignment, the links whose id pair is the most frequent of
    its A id in the corpus, and the summed counts of its links.

    Every row is a document of its own, also where rows repeat. A null or empty text, and one that the tokens do not
    spell, has zeros and an empty digest. A very long text is tokenized whole (memory grows with it) and aligned in
    lanes. Columns other than doc_id and text are not read; an empty table has an empty result.
    """
    share_package(docs.sparkSession)
    passed = aligned(docs, file_a, file_b)
    pairs = batch_pairs(passed)
    found = pairs.select(F.col("batch").alias("asking"), "place", "pair").join(pair_counts(pairs), "pair").drop("pair")
    rows = passed.filter("pairs is null").drop("pairs", "holders")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        *(T.StructField(c, T.LongType()) for c in RESULT),
        T.StructField("groups_sha256", T.StringType()),
    ])
    return rows.groupBy("batch").cogroup(found.groupBy("asking")).applyInArrow(_with_counts, schema)
