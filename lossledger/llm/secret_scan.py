"""Secret scans: candidates by shape, then a random forest that removes false positives.

A candidate is a maximal run in a word: at least 12 characters of the alphabets of keys with a digit among them or
a published beginning, or a value of at least 8 after a name and `=` or `:`; none is too long. Its features are its length, how character classes change along it, how much of it words of
the corpus cover, the path it came from (how often its source has candidates, where in the document it stands) and
the words beside it. The forest is trained on labelled findings.

DataFrame functions and Spark's own forest only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.llm.common import stored

# How published keys begin.
_PREFIX = "AKIA|ASIA|gh[pousr]_|xox[abprs]-"
_KEY, _NAME = r"[A-Za-z0-9+/_\-]", r"[A-Za-z0-9_.\-]"
_ENDS = r"\s\"'`,;&<>(){}\[\]|\\=:"
#: A value: all up to white space, a quote or a separator, perhaps with padding; at least 8 characters, and not a path.
_VALUE = rf"[^{_ENDS}/][^{_ENDS}]{{7,}}+(?:={{1,2}}(?=[{_ENDS}]|$)(?![=:]))?+(?![=:])"
#: A name and its value, with or without quotes. Names begin where no name is before them, so a run is tried once.
ASSIGNED = rf"(?<!{_NAME})([A-Za-z_]{_NAME}*+)[\"'`]?[=:]{{1,2}}[\"'`]?({_VALUE})"
#: A maximal run of key characters, of any length, with dotted parts that follow it.
BARE = rf"(?<!{_KEY}){_KEY}{{12,}}+(?:\.{_KEY}{{4,}}+)*+"
RUNS = f"{ASSIGNED}|{BARE}"
#: About so many labelled findings of either class, chosen by a hash, fit the forest.
FIT_FINDINGS = 20_000
#: A word of the dictionary occurs so often in the corpus and has so many letters.
DICTIONARY_COUNT, DICTIONARY_LETTERS = 20, (4, 12)
TREES, DEPTH, SEED = 40, 8, 7

# Published key formats, and names that values are assigned to.
KNOWN_FORMATS = [
    r"^AKIA[0-9A-Z]{16}$", r"^ASIA[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36}$", r"^xox[abprs]-[A-Za-z0-9\-]{10,}$",
]
KEY_NAME = r"(?i)(?:^|[^a-z])(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|private[_-]?key)[0-9]*\W*$"

FEATURES = [
    "length", "digit_share", "upper_share", "mark_share", "digit_letter_changes", "case_changes", "distinct_share",
    "hex_only", "vowel_share", "covered", "assigned", "key_name", "quoted", "at_share", "source_rate",
]


def candidates(docs: DataFrame) -> DataFrame:
    """finding, doc_id, source, at (word position), run (number in the word), n_words, name, before, before2, word,
    candidate; stored.

    Words are what white space leaves; a word may hold several candidates, at any place and of any length: values of
    names (across quotes, colons and query strings), and maximal runs of key characters that hold a digit or begin as
    published keys do. Null and empty texts have none. `finding` numbers the rows.
    """
    words = docs.select("doc_id", "source", F.split(F.coalesce("text", F.lit("")), r"\s+").alias("words"))
    word = lambda i: F.get("words", i)
    at = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: (F.length(word(i)) >= 9) & word(i).rlike(f"[0-9=:]|{_PREFIX}") & word(i).rlike(RUNS),
    )
    near = lambda i, k: F.when(i >= k, word(F.greatest(i - k, F.lit(0)))).otherwise("")
    hits = F.transform(
        at,
        lambda i: F.struct(
            i.alias("at"), word(i).alias("word"), near(i, 1).alias("before"), near(i, 2).alias("before2")
        ),
    )
    found = words.select("doc_id", "source", F.size("words").alias("n_words"), F.explode(hits).alias("h")).select(
        "doc_id", "source", "n_words", "h.*"
    )
    runs = found.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(RUNS), 0)).alias("run", "held"))
    name = F.regexp_extract("held", ASSIGNED, 1)
    value = F.when(name != "", F.regexp_extract("held", ASSIGNED, 2)).otherwise(F.col("held"))
    named = runs.select("*", name.alias("name"), F.regexp_replace(value, "[=.!?]+$", "").alias("candidate")).drop("held")
    likely = (F.col("name") != "") | F.col("candidate").rlike(f"[0-9]|^(?:{_PREFIX})")
    return stored(named.filter(likely & (F.length("candidate") >= 8)).select(F.monotonically_increasing_id().alias("finding"), "*"))


def dictionary(docs: DataFrame) -> DataFrame:
    """word: the frequent lower-case words of all documents."""
    low, high = DICTIONARY_LETTERS
    words = F.filter(
        F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w.rlike(rf"^\p{{Ll}}{{{low},{high}}}$")
    )
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= DICTIONARY_COUNT).select("word")


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """finding, covered: the share of a candidate's characters that lie in dictionary words.

    A candidate falls into pieces of letters at other characters and where a capital begins, so it has fewer pieces than
    a quarter of its characters, however long it is. Pieces are joined with the dictionary by sorting, never broadcast.
    """
    low, high = DICTIONARY_LETTERS
    pieces = F.regexp_extract_all("candidate", F.lit(r"\p{Lu}?\p{Ll}{3,}|\p{Lu}{4,}"), 0)
    parts = found.select("finding", F.length("candidate").alias("n"), F.explode(pieces).alias("piece")).select(
        "finding", "n", F.lower("piece").alias("word")
    ).filter(F.length("word").between(low, high))
    # A finding's pieces are counted by word first.
    counted = parts.groupBy("finding", "n", "word").agg(F.count(F.lit(1)).alias("times"))
    hits = counted.join(words.hint("merge"), "word")
    return hits.groupBy("finding", "n").agg((F.sum(F.col("times") * F.length("word"))).alias("letters")).select(
        "finding", (F.col("letters") / F.col("n")).alias("covered")
    )


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add FEATURES. The rate of a source is aggregated over all its candidates before it is joined."""
    c, n = F.col("candidate"), F.length("candidate")
    count = lambda pattern: F.regexp_count(c, F.lit(pattern))
    rate = stored(found.groupBy("source").agg(F.avg(1000.0 / F.col("n_words")).alias("source_rate")))
    named = lambda text: text.rlike(KEY_NAME)
    after_name = named(F.col("before")) | (F.col("before").rlike("^[=:]+$") & named(F.col("before2")))
    made = found.withColumns({
        "length": n,
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "mark_share": count(r"[+/_\-]") / n,
        "digit_letter_changes": (count("(?<=[0-9])[A-Za-z]") + count("(?<=[A-Za-z])[0-9]")) / n,
        "case_changes": (count("(?<=[a-z])[A-Z]") + count("(?<=[A-Z])[a-z]")) / n,
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hex_only": c.rlike("^[0-9a-f]+$").cast("int"),
        "vowel_share": count("[aeiouAEIOU]") / n,
        "assigned": ((F.col("name") != "") | F.col("before").rlike("[=:]$")).cast("int"),
        "key_name": (named(F.col("name")) | after_name).cast("int"),
        "quoted": F.col("word").rlike("[\"'`]").cast("int"),
        "at_share": F.col("at") / F.col("n_words"),
    })
    same_source = made["source"].eqNullSafe(rate["source"])
    joined = made.join(rate, same_source, "left").drop(rate["source"]).join(coverage(found, words), "finding", "left")
    return joined.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in FEATURES})


def labelled_findings(featured: DataFrame) -> DataFrame:
    """Labels that need no reading: published formats and named mixed values are secrets (1); plain numbers and
    values of ordinary words without a name beside them are not (0). Other rows have no label and are left out."""
    c = F.col("candidate")
    known = F.lit(False)
    for pattern in KNOWN_FORMATS:
        known = known | c.rlike(pattern)
    mixed = c.rlike("[A-Za-z]") & c.rlike("[0-9]") & (F.length(c) >= 12)
    label = (
        F.when(known | ((F.col("key_name") == 1) & mixed), 1.0)
        .when((F.col("key_name") == 0) & (c.rlike(r"^[0-9+/_\-]+$") | (F.col("covered") > 0.6)), 0.0)
    )
    return featured.withColumn("label", label).filter(F.col("label").isNotNull())


def fit(labelled: DataFrame, fit_findings: int = FIT_FINDINGS) -> RandomForestClassificationModel | None:
    """A forest on at most about `fit_findings` findings of either class; None if a class is missing."""
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not sizes.get(0.0) or not sizes.get(1.0):
        return None
    share = F.pmod(F.xxhash64("doc_id", "at", "run", "candidate"), F.lit(1_000_000)) / 1_000_000
    bound = F.when(F.col("label") == 1, fit_findings / sizes[1.0]).otherwise(fit_findings / sizes[0.0])
    sample = stored(labelled.filter(share < bound).select("label", *FEATURES))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        minInstancesPerNode=3, featureSubsetStrategy="sqrt",
    )
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample))


def score(featured: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Add probability and is_secret (at least 0.5). Without a model nothing is removed."""
    if model is None:
        return featured.withColumns({"probability": F.lit(1.0), "is_secret": F.lit(True)})
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured)
    scored = model.transform(vectors).withColumn("probability", vector_to_array("probability")[1])
    return scored.withColumn("is_secret", F.col("probability") >= 0.5).drop("features", "rawPrediction", "prediction")


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate in `docs`: doc_id, at, run, candidate, probability, is_secret.

    `labelled` are findings with FEATURES and label (1 secret, 0 not); without it they come from the candidates
    themselves by `labelled_findings`. Every candidate is scored, and every occurrence is a row, also in repeated
    documents. Documents without candidates have no row. Only doc_id, source and text are read. A candidate may be as
    long as its text; the work for it grows with its length.
    """
    inner = docs.select("doc_id", "source", "text")
    featured = stored(with_features(candidates(inner), dictionary(inner)))
    model = fit(labelled_findings(featured) if labelled is None else labelled)
    return score(featured, model).select("doc_id", "at", "run", "candidate", "probability", "is_secret")
