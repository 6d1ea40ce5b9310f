"""Quality classifier: interpolated modified Kneser-Ney model of trusted text.

The model is over characters, each of Unicode a symbol of its own but decimal digits, which are one; order 4, one model
per language with trusted text and one over all languages (`*`); a text's probabilities are weighted means of both, up to half of its language's: the less trusted
text a language has, the more of them, of its mean and of its limits are the pooled ones. It is estimated with joins of sharded count tables: counts and continuation
counts by n-gram, context totals with counts of counts by context, and each order joined with the one below it by
suffix and with its contexts by prefix. A document's perplexity is pulled towards the mean of its language with the
weight of PRIOR symbols, so that a few unusual words in a short text do not decide. Documents outside two quantiles
of the trusted ones of their language are rejected: above, text that does not look like trusted text; below, text that
is too predictable.

Documents are scored by one path at every size. One pass counts: rows fall into batches, a batch lists its distinct
n-grams once, and its rows hold places in that list. The lists are joined with the sharded tables, and what comes back to
a batch gives the sums of its rows (`score_by_join`). Neither texts nor an n-gram per document are shuffled.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.llm.common import map_arrow, share_package, stored, stored_in_buckets

ORDER = 4
POOLED = "*"
#: With so many trusted documents a language's own mean and limits count as much as the pooled ones.
EVEN_TRUSTED = 50
PRIOR = 200
LOW_QUANTILE, HIGH_QUANTILE = 0.0005, 0.998
#: The quantiles' distances from the mean are widened by this: training text is easier for the model than other text.
MARGIN = 1.25
LAST_BITS = 1e-12
#: Characters that are counted at once, and whose rows share one list of n-grams.
STEP_SYMBOLS, BATCH_SYMBOLS = 1_000_000, 16_000_000
BROADCAST_IDS = 5_000_000

START = 0
#: Every code point and START. A symbol has BITS bits, so a gram of four is two columns of two symbols each.
SYMBOLS, BITS = 0x110001, 21
GRAM = ["head", "tail"]
_DENSE = 1 << 22


def symbol_of(code: int) -> int:
    """Each code point for itself, decimal digits of any script as 0: figures of prices, keys and numbers are drawn
    evenly and say nothing about a language. START is no code point."""
    return (ord("0") if unicodedata.category(chr(code)) == "Nd" else code) + 1


@lru_cache(1)
def symbol_table() -> np.ndarray:
    return np.array([symbol_of(c) for c in range(0x110000)], np.int64)


def last_symbols(size: int) -> list[Column]:
    """head and tail of the last `size` symbols of a gram."""
    head, tail, one = F.col("head"), F.col("tail"), F.lit((1 << BITS) - 1)
    zero = F.lit(0).cast("bigint")
    return [
        (head if size >= 4 else head.bitwiseAND(one) if size == 3 else zero).alias("head"),
        (tail if size >= 2 else tail.bitwiseAND(one) if size == 1 else zero).alias("tail"),
    ]


def context_symbols(gram: list[Column] | None = None) -> list[Column]:
    """head and tail of a gram (else of the columns) without its last symbol."""
    head, tail = gram or (F.col("head"), F.col("tail"))
    moved = F.shiftleft(head.bitwiseAND(F.lit((1 << BITS) - 1)), BITS)
    return [F.shiftright(head, BITS).alias("head"), F.shiftright(tail, BITS).bitwiseOR(moved).alias("tail")]


def _ranks(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of numbers below `size`, ascending, and the place of each number among them."""
    if size > _DENSE:
        return np.unique(values, return_inverse=True)
    found = np.flatnonzero(np.bincount(values, minlength=size))
    place = np.zeros(size, np.int64)
    place[found] = np.arange(len(found))
    return found, place[values]


def distinct_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct grams of each text, in order of text and gram: number of the text, head and tail as places among the
    pairs of symbols, how often, and these pairs. A gram ends at each character; before each text stand START symbols."""
    sizes = np.array([len(t) for t in texts], np.int64)
    pad = "\0" * (ORDER - 1)
    joined = pad + pad.join(texts)
    symbols = symbol_table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    starts = np.cumsum(sizes + ORDER - 1) - sizes
    for k in range(1, ORDER):
        symbols[starts - k] = START
    kinds, symbols = _ranks(symbols, SYMBOLS)
    n = len(kinds)
    pairs, at = _ranks(symbols[:-1] * n + symbols[1:], n * n)
    pairs = (kinds[pairs // n] << BITS) | kinds[pairs % n]
    doc = np.repeat(np.arange(len(texts)), sizes)
    first = np.arange(len(doc)) + (ORDER - 1) * doc
    n = len(pairs)
    keys, times = np.unique((doc * n + at[first]) * n + at[first + 2], return_counts=True)
    doc, keys = np.divmod(keys, n * n)
    head, tail = np.divmod(keys, n)
    return doc.astype(np.int32), head.astype(np.int32), tail.astype(np.int32), times.astype(np.int32), pairs


def packed(values: np.ndarray) -> bytes:
    """Small numbers in few bytes."""
    wide = values.astype("<u2" if not len(values) or values.max() < 1 << 16 else "<u4")
    planes = np.ascontiguousarray(wide.view(np.uint8).reshape(-1, wide.itemsize).T)
    # Such numbers seldom repeat in runs, so short matches only cost bits.
    packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS, 9, zlib.Z_FILTERED)
    return bytes([wide.itemsize]) + packer.compress(planes.tobytes()) + packer.flush()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:], -zlib.MAX_WBITS), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").reshape(-1).astype(np.int64)


class _Batch:
    """Distinct n-grams of the rows of a batch, gathered step by step."""

    def __init__(self):
        self.steps: list[tuple] = []
        self.models: dict[str, int] = {}
        self.count = self.characters = 0

    def add(self, rows: pa.Array, models: list[str], texts: list[str], trusted: np.ndarray) -> None:
        local = np.array([self.models.setdefault(m, len(self.models)) for m in models], np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.steps.append((rows, local, sizes, trusted, *distinct_grams(texts)))
        self.count += len(texts)
        self.characters += int(sizes.sum())

    def made(self, number: int) -> pa.RecordBatch:
        """A row per document: places in the batch's list of n-grams, ascending, as steps, and how often each occurs.
        One more row has the list, with the counts over trusted documents. Only one step's places are held at a time."""
        pairs = np.unique(np.concatenate([step[-1] for step in self.steps]))
        n = len(pairs)

        def codes_of(local, doc, head, tail, own) -> np.ndarray:
            at = np.searchsorted(pairs, own)
            return (local[doc] * n + at[head]) * n + at[tail]

        codes = np.zeros(0, np.int64)
        for _, local, _, _, doc, head, tail, _, own in self.steps:
            codes = np.union1d(codes, codes_of(local, doc, head, tail, own))
        trained = np.zeros(len(codes), np.int64)
        rows, sizes, steps, often = [], [], [], []
        for row, local, size, trusted, doc, head, tail, times, own in self.steps:
            place = np.searchsorted(codes, codes_of(local, doc, head, tail, own)).astype(np.int32)
            good = trusted[doc]
            trained += np.bincount(place[good], times[good], len(codes)).astype(np.int64)
            # A document has one model, and its n-grams come in order, so its places rise.
            rise = np.diff(place, prepend=np.int32(0))
            first = np.flatnonzero(np.diff(doc, prepend=np.int32(-1)))
            rise[first] = place[first]
            ends = np.cumsum(np.bincount(doc, minlength=len(size)))
            for start, end in zip([0, *ends[:-1]], ends):
                steps.append(packed(rise[start:end]))
                often.append(packed(times[start:end]))
            rows.append(row)
            sizes.append(size)
        self.steps = []
        model, gram = np.divmod(codes, n * n)
        names, count = list(self.models), self.count

        def one(values, kind: pa.DataType) -> pa.Array:
            return pa.concat_arrays([pa.nulls(count, pa.list_(kind)), pa.array([values], pa.list_(kind))])

        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(count + 1, number)),
                pa.concat_arrays([*rows, pa.nulls(1, rows[0].type)]),
                pa.concat_arrays([pa.array(np.concatenate(sizes)), pa.nulls(1, pa.int64())]),
                pa.array([*steps, None], pa.binary()), pa.array([*often, None], pa.binary()),
                one([names[k] for k in model], pa.string()), one(pairs[gram // n], pa.int64()),
                one(pairs[gram % n], pa.int64()), one(trained, pa.int64()),
            ],
            names=["batch", "row", "symbols", "steps", "times", "models", "heads", "tails", "trained"],
        )


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, held = TaskContext.get().partitionId() << 24, _Batch()
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        models = batch.column("model").to_pylist()
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= STEP_SYMBOLS):
                size += len(texts[stop])
                stop += 1
            if held.count and held.characters + size > BATCH_SYMBOLS:
                yield held.made(number)
                number, held = number + 1, _Batch()
            held.add(batch.column("row").slice(start, stop - start), models[start:stop], texts[start:stop], trusted[start:stop])
            start = stop
    if held.count:
        yield held.made(number)


def counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """One pass over `docs` (text, model, trusted and `columns`), stored: per row its n-grams as places in its batch's
    list, and per batch that list. No text is stored; `columns` travel as a struct, so they may have any name. Rows lie
    in buckets of their batch, so that what comes back to a batch finds them without moving them."""
    rows = docs.select(F.struct(*columns).alias("row"), "text", "model", "trusted")
    schema = T.StructType([
        T.StructField("batch", T.LongType()), rows.schema["row"], T.StructField("symbols", T.LongType()),
        T.StructField("steps", T.BinaryType()), T.StructField("times", T.BinaryType()),
        T.StructField("models", T.ArrayType(T.StringType())), T.StructField("heads", T.ArrayType(T.LongType())),
        T.StructField("tails", T.ArrayType(T.LongType())), T.StructField("trained", T.ArrayType(T.LongType())),
    ])
    schema["row"].nullable = True
    return stored_in_buckets(map_arrow(rows, _pass, schema), "batch")


def batch_grams(passed: DataFrame) -> DataFrame:
    """(batch, place, model, head, tail, trained): each n-gram of a batch once for each model."""
    lists = F.posexplode(F.arrays_zip("models", "heads", "tails", "trained")).alias("place", "g")
    names = {"models": "model", "heads": "head", "tails": "tail", "trained": "trained"}
    return passed.filter("heads is not null").select("batch", lists).select(
        "batch", "place", *[F.col(f"g.{many}").alias(one) for many, one in names.items()]
    )


def gram_counts(passed: DataFrame) -> DataFrame:
    """(model, head, tail, count) over trusted rows; batches have summed theirs before the shuffle."""
    return batch_grams(passed).filter("trained > 0").groupBy("model", *GRAM).agg(F.sum("trained").alias("count"))


def _discounts(counts: DataFrame) -> DataFrame:
    """model, d1, d2, d3: modified Kneser-Ney discounts from counts of counts, within [0, count]."""
    n = {k: F.sum(F.when(F.col("count") == k, 1).otherwise(0)) for k in (1, 2, 3, 4)}
    found = counts.groupBy("model").agg(*[n[k].cast("double").alias(f"n{k}") for k in n])
    y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.0)

    def d(k: int) -> Column:
        ratio = F.when(F.col(f"n{k}") > 0, F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(0.0)
        return F.least(F.greatest(k - (k + 1) * y * ratio, F.lit(0.0)), F.lit(float(k))).alias(f"d{k}")

    return found.select("model", d(1), d(2), d(3))


def probabilities(counts: DataFrame) -> DataFrame:
    """model, size, head, tail, p, backoff: for every seen n-gram of every order its interpolated probability, and as a
    context of the next order the weight of what lies below it (null if it never is one)."""
    levels = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):
        # Continuation counts: how many different symbols stand before it.
        levels[size] = levels[size + 1].select("model", *last_symbols(size)).groupBy("model", *GRAM).agg(
            F.count(F.lit(1)).alias("count")
        )
    lower = counts.select("model").distinct().select(
        "model", *[F.lit(0).cast("bigint").alias(c) for c in GRAM], F.lit(1.0 / SYMBOLS).alias("p")
    )
    done = []
    for size in range(1, ORDER + 1):
        level = levels[size].select("*", F.struct(*context_symbols()).alias("context"))
        kinds = {k: F.sum(F.when(F.col("count") == k, 1).otherwise(0)) for k in (1, 2)}
        contexts = (
            level.groupBy("model", "context")
            .agg(F.sum("count").alias("total"), kinds[1].alias("k1"), kinds[2].alias("k2"),
                 F.sum(F.when(F.col("count") >= 3, 1).otherwise(0)).alias("k3"))
            .join(F.broadcast(_discounts(level)), "model")  # a row per model
            .withColumn(
                "backoff",
                (F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total"),
            )
            .select("model", "context", "total", "backoff", "d1", "d2", "d3")
        )
        contexts = stored(contexts)
        below = lower.select("model", F.struct(*GRAM).alias("suffix"), F.col("p").alias("p_below"))
        discount = F.when(F.col("count") == 1, F.col("d1")).when(F.col("count") == 2, F.col("d2")).otherwise(F.col("d3"))
        p = F.greatest(F.col("count") - discount, F.lit(0.0)) / F.col("total") + F.col("backoff") * F.col("p_below")
        lower = stored(
            level.withColumn("suffix", F.struct(*last_symbols(size - 1)))
            .join(contexts, ["model", "context"]).join(below, ["model", "suffix"])
            .select("model", *GRAM, p.alias("p"))
        )
        done.append((lower, contexts))
    rows = None
    for size, (level, _) in enumerate(done, 1):
        table = level.select("model", F.lit(size).alias("size"), *GRAM, "p")
        if size < ORDER:
            weights = done[size][1].select("model", "context.*", "backoff")
            table = table.join(weights, ["model", *GRAM], "left")
            # START never follows anything, so as a context it has no probability of its own.
            extra = weights.join(level.select("model", *GRAM), ["model", *GRAM], "left_anti").select(
                "model", F.lit(size).alias("size"), *GRAM, F.lit(None).cast("double").alias("p"), "backoff"
            )
            table = table.select("model", "size", *GRAM, "p", "backoff").unionByName(extra)
        else:
            table = table.withColumn("backoff", F.lit(None).cast("double"))
        table = table.select("model", "size", *GRAM, "p", "backoff")
        rows = table if rows is None else rows.unionByName(table)
    uniform = done[0][1].select(
        "model", F.lit(0).alias("size"), *[F.lit(0).cast("bigint").alias(c) for c in GRAM],
        F.lit(1.0 / SYMBOLS).alias("p"), "backoff",
    )
    return stored(rows.unionByName(uniform))


def losses_of_grams(wanted: DataFrame, table: DataFrame, shares: DataFrame | None) -> DataFrame:
    """(model, head, tail, nll) for the distinct (model, head, tail) of `wanted`, by joins with the sharded table, order by order."""
    own = stored(wanted.select("model", *GRAM).distinct())
    rows = own.union(own.select(F.lit(POOLED).alias("model"), *GRAM)).distinct().withColumn("found", F.lit(None).cast("double")).withColumn("weight", F.lit(1.0))
    for size in range(ORDER, -1, -1):
        rows = rows.withColumn("part", F.struct(*last_symbols(size)))
        here = table.filter(F.col("size") == size).select(
            "model", F.struct(*GRAM).alias("part"), F.col("p").alias("p_here")
        )
        rows = rows.join(here, ["model", "part"], "left").withColumn(
            "found", F.coalesce("found", F.col("weight") * F.col("p_here"))
        ).drop("p_here")
        if size:
            below = table.filter(F.col("size") == size - 1).select(
                "model", F.struct(*GRAM).alias("context"), F.col("backoff").alias("b")
            )
            rows = (
                rows.withColumn("context", F.struct(*context_symbols(last_symbols(size)))).join(below, ["model", "context"], "left")
                .withColumn("weight", F.when(F.col("found").isNull(), F.col("weight") * F.coalesce("b", F.lit(1.0))).otherwise(F.col("weight")))
                .drop("b", "context")
            )
    rows = stored(rows.select("model", *GRAM, "found"))
    pooled = rows.filter(F.col("model") == POOLED).select(*GRAM, F.col("found").alias("pooled"))
    if shares is None:
        rows = rows.withColumn("share", F.lit(0.5))
    else:
        rows = rows.join(shares, "model", "left")
    share = F.when(F.col("found").isNull(), 0.0).otherwise(F.coalesce("share", F.lit(0.0)))
    p = share * F.coalesce("found", F.lit(0.0)) + (1 - share) * F.col("pooled")
    return rows.join(pooled, GRAM).select("model", *GRAM, (-F.log(p)).alias("nll"))


def _sum_batch(docs: pa.Table, found: pa.Table) -> pa.Table:
    nll = np.zeros(len(found))
    nll[found.column("place").to_numpy()] = found.column("nll").to_numpy()
    sums = [
        float((nll[np.cumsum(unpacked(steps))] * unpacked(times)).sum())
        for steps, times in zip(docs.column("steps").to_pylist(), docs.column("times").to_pylist())
    ]
    return pa.table({"row": docs.column("row"), "symbols": docs.column("symbols"), "loss": pa.array(sums, pa.float64())})


def score_by_join(passed: DataFrame, table: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """row, symbols and loss (sum of -log p) for each row of `counted`.

    Batches ask for their own n-grams and get log probabilities back, so that a frequent n-gram is asked for once by a
    batch and not by every document. A seen n-gram takes its p; otherwise its context's weight times the next lower
    order, down to the uniform one. `shares` (model, share) says how much of p is the row's own model's, the rest being
    the pooled one's; without it half. A model that the table does not have leaves all to the pooled one.
    """
    share_package(passed.sparkSession)
    grams = batch_grams(passed).select(F.col("batch").alias("asking"), "place", "model", *GRAM)
    found = grams.join(losses_of_grams(grams, table, shares), ["model", *GRAM]).select("asking", "place", "nll")
    rows = passed.filter("heads is null").select("batch", "row", "symbols", "steps", "times")
    schema = T.StructType([passed.schema["row"], T.StructField("symbols", T.LongType()), T.StructField("loss", T.DoubleType())])
    return rows.groupBy("batch").cogroup(found.groupBy("asking")).applyInArrow(_sum_batch, schema)


class QualityModel:
    """A fitted model: probability table, shares of the languages' models, their means and limits, the pooled ones."""

    def __init__(self, table: DataFrame, shares: DataFrame, limits: DataFrame | None = None,
                 pooled: tuple[float, float, float] | None = None):
        self.table, self.shares, self.limits, self.pooled = table, shares, limits, pooled

    def score(self, docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """`columns` of `docs` (all of them, if not named) with model, loss, symbols, perplexity, low, high, rejected."""
        columns = columns or docs.columns
        passed = counted(docs.withColumns({"model": model_of(F.col("lang")), "trusted": F.lit(False)}), [*columns, "lang"] if "lang" not in columns else columns)
        return self.with_decision(score_by_join(passed, self.table, self.shares)).select(
            *(F.col("row")[c].alias(c) for c in columns), *(c for c in DECIDED if c not in columns)
        )

    def with_decision(self, scored: DataFrame) -> DataFrame:
        """Logarithms of limits are the languages' and the pooled ones by the smooth share; others take the pooled."""
        scored = scored.withColumn("model", model_of(F.col("row")["lang"]))
        if self.limits is None or self.pooled is None:
            none = F.lit(None).cast("double")
            return scored.withColumns({"perplexity": none, "low": none, "high": none, "rejected": F.lit(False)})
        known = scored.join(self.limits, "model", "left")
        mean, low, high = [F.coalesce(c, F.lit(v)) for c, v in zip(("__mean", "__low", "__high"), self.pooled)]
        made = known.withColumns({"perplexity": F.exp(_pulled(mean)), "low": F.exp(low), "high": F.exp(high)})
        # A text that lies on a limit, as an only trusted one does, is inside whatever the last bits of its sums are.
        outside = (F.col("perplexity") < F.col("low") * (1 - LAST_BITS)) | (F.col("perplexity") > F.col("high") * (1 + LAST_BITS))
        return made.withColumn("rejected", F.coalesce(outside, F.lit(False))).drop("__mean", "__low", "__high")

    def keep(self, docs: DataFrame) -> DataFrame:
        """The rows that are not rejected, with the columns of `docs`. Other columns may have any name."""
        inner = _with_digest(docs)
        scored = self.score(inner.select("lang", "text", "digest"), ["lang", "digest"])
        return _without_rejected(inner, scored)


#: What a decision adds to a row.
DECIDED = ("model", "symbols", "loss", "perplexity", "low", "high", "rejected")


def _with_digest(docs: DataFrame) -> DataFrame:
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.select(F.struct(*docs.columns).alias("row"), "text", "lang", digest.alias("digest"))


def _without_rejected(inner: DataFrame, scored: DataFrame) -> DataFrame:
    """A decision depends on language and text alone, so a digest of these leads back to the rows: what was rejected is
    a table of digests, and rows need no number that would have to survive repeated work."""
    gone = scored.filter("rejected").select(F.coalesce("lang", F.lit("")).alias("of"), "digest").distinct()
    rows = inner.withColumn("of", F.coalesce("lang", F.lit("")))
    return rows.join(gone, ["of", "digest"], "left_anti").select("row.*")


def model_of(lang: Column) -> Column:
    """The name of a language's model, which is never that of the pooled one."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(POOLED))


def own_share(trusted: Column) -> Column:
    """How much a language with so many trusted documents goes by itself: smooth, 0 without any."""
    return trusted / (trusted + EVEN_TRUSTED)


def _pulled(mean: Column) -> Column:
    return (F.col("loss") + PRIOR * mean) / (F.col("symbols") + PRIOR)


def with_trust(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with trusted: whether `labels` names the doc_id as good.

    Up to BROADCAST_IDS whole numbers (counted first: 8 bytes each) go to the texts; otherwise both sides are shuffled,
    with the same result.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("__good")).distinct()
    if isinstance(good.schema["__good"].dataType, T.IntegralType):
        good = stored(good)
        if good.count() <= BROADCAST_IDS:
            good = F.broadcast(good)
    marked = docs.join(good, docs["doc_id"] == F.col("__good"), "left")
    return marked.withColumn("trusted", F.col("__good").isNotNull()).drop("__good")


def _estimated(passed: DataFrame, sizes: DataFrame) -> QualityModel:
    """Probabilities and shares from the trusted rows of a pass; `sizes` has n trusted documents per model."""
    by_model = stored(gram_counts(passed))
    pooled_counts = by_model.groupBy(F.lit(POOLED).alias("model"), *GRAM).agg(F.sum("count").alias("count"))
    table = probabilities(stored(by_model.filter(F.col("model") != POOLED).unionByName(pooled_counts)))
    shares = stored(sizes.filter(F.col("model") != POOLED).select(
        "model", (own_share(F.col("n")) / 2).alias("share"), own_share(F.col("n")).alias("own")
    ))
    return QualityModel(table, shares)


def _limit(model: QualityModel, trusted: DataFrame) -> QualityModel:
    """Means and quantiles over all trusted rows (model, loss, symbols)."""
    mean = F.sum("loss") / F.greatest(F.sum("symbols"), F.lit(1))
    widened = [  # logarithms
        (F.col("mean") + MARGIN * (F.log(F.col("q")[k]) - F.col("mean"))).alias(name) for k, name in enumerate(("low", "high"))
    ]
    quantiles = F.percentile_approx(F.exp(_pulled(F.col("mean"))), [LOW_QUANTILE, HIGH_QUANTILE], 1_000_000)
    # The pooled limits are over all trusted documents, each scored by the models that it would get.
    center = trusted.agg(mean.alias("mean")).first()["mean"]
    if center is None:
        return model
    pooled = (
        trusted.withColumn("mean", F.lit(center)).groupBy("mean").agg(quantiles.alias("q")).select("mean", *widened).first()
    )
    smooth = lambda c, k: F.col("own") * F.col(c) + (1 - F.col("own")) * F.lit(pooled[k])
    means = stored(
        trusted.groupBy("model").agg(mean.alias("mean")).join(model.shares, "model").select("model", "own", smooth("mean", 0).alias("mean"))
    )
    limits = trusted.join(means, "model").groupBy("model", "own", "mean").agg(quantiles.alias("q")).select(
        "model", "own", "mean", *widened
    )
    model.pooled = tuple(pooled)
    model.limits = stored(limits.select(
        "model", F.col("mean").alias("__mean"), smooth("low", 1).alias("__low"), smooth("high", 2).alias("__high")
    ))
    return model


def fit_and_score(docs: DataFrame, labels: DataFrame, columns: list[str]) -> tuple[QualityModel, DataFrame]:
    """The model of `docs` and `labels`, and `columns` of all rows of `docs` with their decision, from one pass over the
    texts: the trusted rows' counts make the model, and all rows are scored once.

    Every language with trusted text has a model, a mean and quantiles of its own. The fewer trusted documents it has,
    the more it goes by the pooled ones (`own_share`); a null language and those without trusted text go by them alone.
    Without trusted documents nothing is rejected. Null and empty texts have no symbols and are never rejected by
    themselves; repeated rows each have a row; a very long text is counted whole, in memory that grows with it.
    """
    needed = list(dict.fromkeys([*columns, "lang"]))
    marked = with_trust(docs, labels).withColumn("model", model_of(F.col("lang")))
    named = marked.withColumn("carried", F.struct(*needed))
    passed = counted(named.select(F.col("carried.*"), "text", "model", "trusted", F.col("trusted").alias(TRUST)), [*needed, TRUST]) if not (
        {"text", "model", "trusted"} & set(needed)
    ) else None
    if passed is None:
        raise ValueError("text, model and trusted are no columns to carry")
    trusted = passed.filter("heads is null").filter(F.col("row")[TRUST])
    sizes = trusted.groupBy(model_of(F.col("row.lang")).alias("model")).agg(F.count(F.lit(1)).alias("n"))
    model = _estimated(passed, sizes)
    scored = stored(score_by_join(passed, model.table, model.shares))
    good = scored.filter(F.col("row")[TRUST]).select(model_of(F.col("row.lang")).alias("model"), "loss", "symbols")
    decided = _limit(model, good).with_decision(scored)
    return model, decided.select(*(F.col("row")[c].alias(c) for c in columns), *(c for c in DECIDED if c not in columns))


#: Name of the mark in the rows of a pass.
TRUST = "__trusted"


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """The model alone, from the trusted rows of `docs`."""
    trusted = with_trust(docs.select("doc_id", "text", "lang"), labels).filter("trusted")
    return fit_and_score(trusted.drop("trusted"), labels, ["doc_id"])[0]


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the model of its own trusted rows does not reject, with the columns of `docs`."""
    inner = _with_digest(docs).withColumn("doc_id", F.col("row")["doc_id"])
    scored = fit_and_score(inner.select("doc_id", "lang", "text", "digest"), labels, ["lang", "digest"])[1]
    return _without_rejected(inner.drop("doc_id"), scored)
