"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model is compiled into three parts: the normaliser (dummy prefix, white space to U+2581), a lexicon with an arc for
each piece, and byte-fallback arcs for characters outside the vocabulary. Encoding composes them with a text and takes
the shortest path in the tropical semiring (weights add along a path, the smallest sum wins).

Unigram models weigh an arc by minus its piece's score. In BPE models a piece may follow another exactly if merging the
two pieces' characters by rank gives these two pieces again: such an arc weighs 0, any other infinity, with the last
piece as the state. Exactly one path has a finite weight, and it is the result of the merges.

No piece of a supported model holds U+2581 behind another character, so a text falls into chunks at these places, and
paths of chunks join without loss. Chunks repeat; each task keeps paths of up to MEMO short ones.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lossledger.llm.common import map_arrow
from lossledger.llm.shingles import text_pieces

SPACE = "▁"
# Bounds of what a worker remembers: paths of chunks and weights of arcs, about 400 MB together when full.
MEMO, MEMO_CHARS, ARCS = 1_000_000, 48, 1_000_000
FALLBACK_PENALTY = 10.0

SCHEMA = "n_tokens bigint, token_ids array<int>, decoded_sha256 string, round_trip boolean"


@dataclass(frozen=True)
class Piece:
    text: str
    score: float
    kind: str  # normal, control, unknown, byte


@dataclass(frozen=True)
class Model:
    pieces: list[Piece]
    bpe: bool
    dummy_prefix: bool = True
    collapse_spaces: bool = False


def read_model(path: str) -> Model:
    """A model file; only the identity normaliser with escaped white space is supported."""
    from sentencepiece import sentencepiece_model_pb2 as format

    proto = format.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    normaliser, trainer = proto.normalizer_spec, proto.trainer_spec
    kinds = {1: "normal", 2: "unknown", 3: "control", 4: "normal", 6: "byte"}
    if normaliser.precompiled_charsmap or not normaliser.escape_whitespaces or trainer.treat_whitespace_as_suffix:
        raise ValueError("only identity normalisation with escaped white space in front of words is supported")
    if trainer.model_type not in (1, 2) or any(p.type not in kinds for p in proto.pieces):
        raise ValueError("only unigram and BPE models without unused pieces are supported")
    pieces = [Piece(p.piece, p.score, kinds[p.type]) for p in proto.pieces]
    return Model(pieces, trainer.model_type == 2, normaliser.add_dummy_prefix, normaliser.remove_extra_whitespaces)


class _Memo(dict):
    """Chunk -> ids; computes what is missing and keeps short chunks."""

    def __init__(self, path):
        self.path = path

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = self.path(chunk)
        if len(chunk) <= MEMO_CHARS and len(self) < MEMO:
            self[chunk] = ids
        return ids


@dataclass
class Transducer:
    model: Model
    lexicon: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        pieces = self.model.pieces
        self.lexicon = {p.text: i for i, p in enumerate(pieces) if p.kind == "normal"}
        self.byte_ids = {int(p.text[3:5], 16): i for i, p in enumerate(pieces) if p.kind == "byte"}
        self.unknown = next((i for i, p in enumerate(pieces) if p.kind == "unknown"), 0)
        if any(SPACE in t.lstrip(SPACE) for t in self.lexicon):
            raise ValueError("a piece holds white space behind another character")
        self.longest = max(map(len, self.lexicon), default=1)
        scores = [p.score for p in pieces if p.kind == "normal"]
        self.fallback_weight = FALLBACK_PENALTY - min(scores, default=0.0)
        # Characters of no longer piece are chunks of their own.
        joined = set(chain.from_iterable(t for t in self.lexicon if len(t) > 1))
        alone = "".join(c for c in "\n\r\t" if c not in joined)
        cut = re.escape(SPACE + alone)
        self.chunks = re.compile(f"{SPACE}+[^{cut}]*|[^{cut}]+" + (f"|[{re.escape(alone)}]" if alone else "")).findall
        made = {"control": lambda p: b"", "unknown": lambda p: " ⁇ ".encode(), "normal": lambda p: p.text.encode(),
                "byte": lambda p: bytes([int(p.text[3:5], 16)])}
        self.output = [made[p.kind](p) for p in pieces]
        self.allowed: dict[tuple[int, int], bool] = {}
        self.memo = _Memo(self.shortest_path)

    def __getstate__(self):
        return {"model": self.model}

    def __setstate__(self, state):
        self.__init__(state["model"])

    def normalise(self, text: str) -> str:
        if self.model.collapse_spaces:
            text = re.sub(" +", " ", text.replace(SPACE, " ").strip(" "))
        text = text.replace(" ", SPACE)
        return SPACE + text if text and self.model.dummy_prefix else text

    def merged(self, text: str) -> list[str]:
        """Merges by rank: always the pair whose piece scores best, the leftmost of equal ones."""
        parts = list(text)
        while True:
            ranked = [(-self.model.pieces[i].score, k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                      if (i := self.lexicon.get(a + b)) is not None]
            if not ranked:
                return parts
            k = min(ranked)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def weight(self, before: int, piece: int) -> float:
        """Of the arc of `piece` in the state `before` (-1: start of the chunk or after a fallback)."""
        pieces = self.model.pieces
        if not self.model.bpe:
            return -pieces[piece].score
        arc = before, piece
        if arc not in self.allowed:
            if len(self.allowed) >= ARCS:
                self.allowed.clear()
            texts = [pieces[p].text for p in arc if p >= 0]
            self.allowed[arc] = self.merged("".join(texts)) == texts
        return 0.0 if self.allowed[arc] else inf

    def shortest_path(self, chunk: str) -> tuple[int, ...]:
        n, lexicon = len(chunk), self.lexicon
        weights, froms, lasts = [0.0] + [inf] * n, [0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                piece = lexicon.get(chunk[i:j])
                if piece is None or weights[i] == inf:
                    continue
                w = weights[i] + self.weight(lasts[i], piece)
                if w < weights[j]:
                    weights[j], froms[j], lasts[j] = w, i, piece
                    if self.model.bpe:
                        break  # the only finite path
            if weights[j] == inf and chunk[j - 1] not in lexicon:
                weights[j], froms[j], lasts[j] = weights[j - 1] + (not self.model.bpe) * self.fallback_weight, j - 1, -1
        path: list[int] = []
        j = n
        while j:
            if lasts[j] >= 0:
                path.append(lasts[j])
            else:
                fallback = [self.byte_ids.get(b, self.unknown) for b in chunk[j - 1].encode()]
                path.extend(reversed(fallback if self.byte_ids else [self.unknown]))
            j = froms[j]
        return tuple(reversed(path))

    def encode(self, text: str) -> Iterable[int]:
        return chain.from_iterable(map(self.memo.__getitem__, self.chunks(self.normalise(text))))

    def decode(self, ids: Iterable[int]) -> str:
        """The inverse: bytes of the pieces, white space restored, the dummy prefix removed."""
        text = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """`docs` with n_tokens, token_ids, decoded_sha256 (of the text decoded from the ids) and round_trip.

    A null text counts as empty, and the empty text has no ids. A text that holds U+2581 decodes with spaces in
    its place, so its round_trip is false; all others come back whole. Columns of `docs` with these names are
    replaced. The model (bounded by its vocabulary) is read by the driver; tasks get it compiled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Transducer(read_model(model_path)))
    made = ["n_tokens", "token_ids", "decoded_sha256", "round_trip"]
    rest = docs.select(*[c for c in docs.columns if c not in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = shared.value
        for batch in batches:
            for row, to, _, _ in text_pieces(batch, "text"):
                ids, ends, digests, same = array("i"), [0], [], []
                piece = batch.slice(row, to - row)
                for text in piece.column("text").to_pylist():
                    ids.extend(transducer.encode(text or ""))
                    decoded = transducer.decode(ids[ends[-1] :])
                    ends.append(len(ids))
                    digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                    same.append(decoded == (text or ""))
                flat = pa.array(np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(np.diff(ends), pa.int64()), lists, pa.array(digests), pa.array(same)],
                    names=[*piece.schema.names, *made],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return map_arrow(rest, run, f"{schema}, {SCHEMA}")


def model_file(name: str = "piece_bpe_32k.model", folder: str = "/opt/tokenizers") -> str:
    return f"{folder}/{name}"
