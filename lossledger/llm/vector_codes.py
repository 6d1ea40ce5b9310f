"""Codes of vectors by product quantization, with nearest entries found by equal-average search.

A vector's components become integers and are cut into equal parts; a part position has a codebook of its own. In each
round every part goes to the nearest entry, and an entry becomes the floor of its parts' mean.

Equal-average search: entries are sorted by the sum of their components. For a part of sum s and dimension d, an entry
of sum t is at least (s - t)^2 / d away (squared), so the search walks outward from s, the nearer side first, and ends
when (s - t)^2 > best * d. "Greater", not "greater or equal": an entry that ties with the best one must still be seen,
as the lowest index wins. All parts of a batch walk together in NumPy; parts that are done leave.

A task sends one sum per entry and component, so what is shuffled and what the driver gets is as large as the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm.common import map_arrow

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components beyond this are no vectors' components; squares of their differences would leave 64 bits.
LARGEST = 2.0**13
#: Rows that walk together.
STEP_ROWS = 8192

#: Codebook of a part position: integers, entries x components.
Codebooks = list[np.ndarray]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of `book` for each row of `parts`, the lowest of equally near ones, and its squared
    distance."""
    n, dim = parts.shape
    entries = len(book)
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sorted_sums, sorted_book = sums[order], book[order]
    # Beyond either end lies a sum that no gap is smaller than.
    far = np.int64(1) << 62
    padded = np.concatenate([[-far], sorted_sums, [far]])

    best = np.full(n, np.iinfo(np.int64).max)
    index = np.full(n, entries)
    row = np.arange(n)
    own = parts.sum(axis=1)
    high = np.searchsorted(sorted_sums, own, side="left")
    low = high - 1
    while len(row):
        gap_low, gap_high = own - padded[low + 1], padded[high + 1] - own
        down = gap_low < gap_high
        gap = np.where(down, gap_low, gap_high)
        known = best[row]
        # gap^2 > best * dim, without a product that could leave 64 bits before anything is known
        going = (gap < far >> 1) & ((known == np.iinfo(np.int64).max) | (gap.astype(np.float64) ** 2 <= known.astype(np.float64) * dim * (1 + 1e-12)))
        if not going.all():
            row, own, low, high, down = row[going], own[going], low[going], high[going], down[going]
            if not len(row):
                break
        at = np.where(down, low, high)
        apart = parts[row] - sorted_book[at]
        distance = np.einsum("ij,ij->i", apart, apart)
        entry = order[at]
        better = (distance < best[row]) | ((distance == best[row]) & (entry < index[row]))
        best[row[better]], index[row[better]] = distance[better], entry[better]
        low = low - down
        high = high + ~down
    return index, best


def whole_numbers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(SCALE * x) of lists that all have `dim` components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dim)


def usable(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """Rows whose vector has finite components only, and `dim` of them where that is given."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))  # NaN counts as larger than any number
    fits = F.size(x) == dim if dim is not None else (F.size(x) > 0) & (F.size(x) % PARTS == 0)
    return vectors.filter(x.isNotNull() & finite & fits)


def first_codebooks(vectors: DataFrame) -> Codebooks:
    """Parts of the vectors with the smallest ids; among equal ids, the smaller vector first. The vector with the
    smallest id decides the dimension."""
    kept = usable(vectors).select("vec_id", "embedding").orderBy("vec_id", "embedding")
    first = kept.first()
    if first is None:
        return []
    dim = len(first["embedding"])
    rows = usable(vectors, dim).select("vec_id", "embedding").orderBy("vec_id", "embedding").limit(ENTRIES).collect()
    start = np.floor(np.array([r["embedding"] for r in rows], np.float64) * SCALE).astype(np.int64)
    return np.split(start, PARTS, axis=1)


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(batch), STEP_ROWS):
        yield batch.slice(start, STEP_ROWS)


def _sums_of(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        sums = np.zeros((PARTS, len(books[0]), width), np.int64)
        counts = np.zeros((PARTS, len(books[0])), np.int64)
        for batch in batches:
            for step in _steps(batch):
                numbers = whole_numbers(step.column("embedding"), PARTS * width)
                for p, book in enumerate(books):
                    part = numbers[:, p * width : (p + 1) * width]
                    index, _ = nearest(part, book)
                    order = np.argsort(index, kind="stable")
                    found, first, size = np.unique(index[order], return_index=True, return_counts=True)
                    counts[p][found] += size
                    sums[p][found] += np.add.reduceat(part[order], first, axis=0)
        used = counts > 0
        part, entry = np.nonzero(used)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, width)), pa.array(np.repeat(entry, width)),
                pa.array(np.tile(np.arange(width), len(part))), pa.array(sums[used].reshape(-1)), pa.array(np.repeat(counts[used], width)),
            ],
            names=["part", "entry", "component", "total", "n"],
        )

    return run


def improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry as the floored mean of the parts that are nearest to it; entries without parts as they were."""
    schema = "part bigint, entry bigint, component bigint, total bigint, n bigint"
    sent = map_arrow(vectors.select("embedding"), _sums_of(books), schema)
    means = sent.groupBy("part", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    result = [b.copy() for b in books]
    for r in means:
        result[r["part"]][r["entry"], r["component"]] = r["total"] // r["n"]
    return result


def fit(vectors: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after `rounds` rounds over all usable vectors; none if there is no vector."""
    books = first_codebooks(vectors)
    if books:
        kept = usable(vectors, PARTS * books[0].shape[1])
        for _ in range(rounds):
            books = improved(kept, books)
    return books


def codebooks_digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.reshape(-1)).encode()).hexdigest()


def decoded(code: str, books: Codebooks) -> list[int]:
    """The integer vector that a code stands for."""
    return [int(x) for p, book in enumerate(books) for x in book[int(code[2 * p : 2 * p + 2], 16)]]


def _codes_of(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        for batch in batches:
            for step in _steps(batch):
                numbers = whole_numbers(step.column("embedding"), PARTS * width)
                found = [nearest(numbers[:, p * width : (p + 1) * width], book) for p, book in enumerate(books)]
                code = np.stack([index for index, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [
                        step.column("vec_id"), step.column("label"),
                        pa.array([code[i : i + 2 * PARTS] for i in range(0, len(code), 2 * PARTS)], pa.string()),
                        pa.array(sum(distance for _, distance in found)),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits per part) and error (squared distance, summed over parts)."""
    schema = T.StructType([
        vectors.schema["vec_id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])
    if not books:
        return vectors.sparkSession.createDataFrame([], schema)
    kept = usable(vectors, PARTS * books[0].shape[1])
    return map_arrow(kept.select("vec_id", "label", "embedding"), _codes_of(books), schema)


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Code and error of every usable row of `vectors` (vec_id, embedding, label), the error of its label, and a
    digest of the final codebooks.

    Rows whose vector is null or has null, NaN, infinite or (beyond any embedding) |x| > `LARGEST` components are
    dropped, as are those of another length than the vector with the smallest id, and of lengths that `PARTS` does not
    divide. With fewer than `ENTRIES` vectors the codebooks are smaller. Repeated rows and ids each count and have a row.
    Labels that are null have one common label error. An empty table has an empty result. Other columns are not read.
    Labels' sums are a table of their own: rows of one label never meet in one task for it.
    """
    books = fit(vectors, rounds)
    codes = encode(vectors, books)
    labels = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    rows = codes.join(labels, F.col("label").eqNullSafe(F.col("of_label")))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
