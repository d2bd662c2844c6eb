"""Toxicity scores by gradient-boosted trees over dense features, calibrated by isotonic regression.

Learning uses at most about ``SAMPLE`` labelled documents (chosen by a hash of the
id; held-out rows never).  First a lexicon: word beginnings of 3 to 8 letters and
whole words that are much more frequent among the distinct words of toxic than
of other documents.  Then the features of a document over its whole text: densities
of strong and weak lexicon words, how many stand near a second-person word, rates
of second-person words, capitals, all-capital words, punctuation, exclamation
marks, signs, digits, obfuscated and stretched words, and the length.  Two thirds of
the sample give the lexicon and fit the trees, the rest the isotonic curve from tree
probability to observed rate.  The score is the curve's value with a hundredth of the tree
probability mixed in, which keeps the order within its steps.

Only the lexicon (``LEXICON`` entries at most) and the model reach the driver.
Language, source, id and labels are never features.  Null and empty texts have all
features 0 and get the score those have.  A null id is never held out.  A label
repeated for an id counts once, as 1 if any is 1; null labels do not count.
Without labels of both kinds every score is the share of label 1, or 0.  Repeated
rows give repeated results, empty tables empty results.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_table, kept_table, map_batches, read_input

SAMPLE = 30_000
LEXICON = 4_000
LEAST_COUNT = 5
STRONG, WEAK = 20.0, 5.0  # how many times as frequent among toxic documents
PREFIXES = range(3, 9)
NEAR = 5
THRESHOLD = 0.3
TREES, DEPTH, STEP = 24, 3, 0.2
LEAF_PART = 150  # a leaf holds at least this part of the rows, so that a few odd labels make none
FOLDS = 3
CACHE_WORDS = 200_000
# fixed values: second-person words of English, German, French and Spanish
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer ihr sie ihnen "
    "tu toi te vous votre vos ton ta tes tú ti usted ustedes vosotros vuestro contigo".split()
)
# fixed values: signs often written for letters
LOOKALIKES = str.maketrans("013457@$!|+", "oieastasiit")
FEATURES = (
    "strong weak strong_n near_you you capital_words capitals punctuation exclamations signs digits obfuscated "
    "stretched long_text non_ascii strong_share"
).split()

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_LETTER = re.compile(r"[^\W\d_]")
_JOINER = re.compile(r"[-'’]")
_STRETCHED = re.compile(r"(\w)\1\1")
STRONG_BIT, WEAK_BIT, YOU_BIT, CAPS_BIT, HIDDEN_BIT, LONG_BIT = 1, 2, 4, 8, 16, 32


def plain_word(word: str) -> str:
    """A word without signs around it, in lower case."""
    return unicodedata.normalize("NFC", _EDGE.sub("", word).lower())


def uncovered(core: str) -> str:
    """Signs within a word read as the letters they look like, others dropped."""
    return re.sub(r"[\W\d_]+", "", core.translate(LOOKALIKES))


def is_hidden(core: str) -> bool:
    """Letters with signs or digits between them."""
    return not core.isalpha() and bool(_LETTER.search(core)) and core[:1].isalpha() and core[-1:].isalpha()


def lexicon_entries(core: str) -> list[str]:
    return [core[:k] for k in PREFIXES if len(core) >= k] + ([f"{core}$"] if core else [])


class WordFlags(dict):
    """What each written word is, as bits; remembered per worker and lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def level(self, core: str) -> float:
        return max((self.lexicon.get(e, 0.0) for e in lexicon_entries(core)), default=0.0)

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        core = plain_word(word)
        flags, lift = 0, self.level(core)
        if core and not core.isalpha() and _LETTER.search(core):
            lift = max(lift, self.level(uncovered(core)))
            if is_hidden(core) and not _JOINER.search(core):
                flags |= HIDDEN_BIT
        if lift >= STRONG:
            flags |= STRONG_BIT
        if lift >= WEAK:
            flags |= WEAK_BIT
        if core in SECOND_PERSON:
            flags |= YOU_BIT
        if len(core) > 2 and word.isupper():
            flags |= CAPS_BIT
        if _STRETCHED.search(core):
            flags |= LONG_BIT
        self[word] = flags
        return flags


_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_PUNCTUATION, _SIGNS = b".,;:'\"()-?!", b"#*$%&|<>@^~_=+/\\[]{}"


def _held(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def features_of(text: str | None, flags: WordFlags) -> list[float]:
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n, raw = len(words), text.encode()
    bits = np.fromiter(map(flags.__getitem__, words), np.uint8, n)
    strong = np.flatnonzero(bits & STRONG_BIT)
    you = np.flatnonzero(bits & YOU_BIT)
    near = 0
    if len(strong) and len(you):
        at = np.searchsorted(you, strong)
        after = np.abs(you[np.minimum(at, len(you) - 1)] - strong)
        before = np.abs(you[np.maximum(at - 1, 0)] - strong)
        near = int((np.minimum(after, before) <= NEAR).sum())
    rate = lambda bit: int(np.count_nonzero(bits & bit)) / n
    size = len(raw)
    return [
        len(strong) / n,
        rate(WEAK_BIT),
        float(len(strong)),
        near / n,
        len(you) / n,
        rate(CAPS_BIT),
        _held(raw, _UPPER) / size,
        _held(raw, _PUNCTUATION) / size,
        raw.count(b"!") / size,
        _held(raw, _SIGNS) / size,
        _held(raw, _DIGITS) / size,
        rate(HIDDEN_BIT),
        rate(LONG_BIT),
        math.log1p(n),
        (size - len(text)) / size,
        len({words[i] for i in strong.tolist()}) / max(1, len(strong)),
    ]


def feature_table(docs: DataFrame, lexicon: dict[str, float], *carry: str) -> DataFrame:
    """``carry`` columns and the features of ``text``.  ``docs``: the carried columns, then ``text``."""
    kinds = dict(docs.dtypes)

    def run(batches):
        flags = WordFlags(lexicon)
        for batch in batches:
            rows = np.array([features_of(t, flags) for t in batch.column(len(carry)).to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(carry)], *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], names=[*carry, *FEATURES]
            )

    schema = ", ".join([f"{c} {kinds[c]}" for c in carry] + [f"{f} double" for f in FEATURES])
    return map_batches(docs.select(*carry, "text"), run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """``doc_id, label, text`` of at most about ``bound`` labelled documents that are not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("double")).alias("label"))
        .where(~held_out(F.col("doc_id")))
    )
    total = known.count()
    if total > bound:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * bound / total))
    # at most about ``bound`` rows of two numbers: small enough for every task, so texts stay where they are
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """How many times as frequent each entry is among the distinct words of label 1 as among those of label 0."""

    def run(batches):
        from collections import Counter

        words, n = (Counter(), Counter()), [0, 0]
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {plain_word(w) for w in (text or "").split()}
                words[label > 0].update(own)
                n[label > 0] += len(own)
        found = (Counter(), Counter())
        for have, into in zip(words, found):
            for w, k in have.items():
                for e in lexicon_entries(w):
                    into[e] += k
        keys = [*(found[0].keys() | found[1].keys()), ""]
        count = [[found[y].get(k, 0) for k in keys[:-1]] + [n[y]] for y in (0, 1)]
        for a in range(0, len(keys), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[a : a + 50_000]), pa.array(count[0][a : a + 50_000], pa.int64()), pa.array(count[1][a : a + 50_000], pa.int64())],
                names=["entry", "other", "toxic"],
            )

    counts = (
        map_batches(rows.select("label", "text"), run, "entry string, other long, toxic long")
        .groupBy("entry")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    )
    counts, path = kept_table(counts.where(f"toxic >= {LEAST_COUNT} OR entry = ''"), "lexicon")
    whole = counts.where("entry = ''").agg(F.sum("other"), F.sum("toxic")).first()
    if not whole[0] or not whole[1]:
        return {}
    scale = whole[0] / whole[1]
    expected = (F.col("other") + 0.5) / scale
    lift = F.col("toxic") / expected
    best = (
        counts.where("entry <> ''")
        .select("entry", lift.alias("lift"), "toxic", expected.alias("expected"))
        .where((F.col("lift") >= WEAK) & (F.col("toxic") >= F.col("expected") + 4 * F.sqrt(F.col("expected"))))
        .orderBy(F.desc(F.col("toxic") - F.col("expected")), "entry")
        .limit(size)
    )
    found = {r["entry"]: float(r["lift"]) for r in best.collect()}
    drop_table(rows.sparkSession, path)
    return found


class Model:
    """A lexicon, trees over the features and the isotonic curve, or a constant."""

    def __init__(self, lexicon, trees=None, curve=None, constant=0.0):
        self.lexicon, self.trees, self.curve, self.constant = lexicon, trees, curve, constant

    def score(self, features: DataFrame, *carry: str) -> DataFrame:
        from pyspark.ml.functions import array_to_vector, vector_to_array

        if self.trees is None:
            return features.select(*carry, F.lit(float(self.constant)).alias("score"))
        vectors = features.select(*carry, array_to_vector(F.array(*FEATURES)).alias("features"))
        p = vector_to_array(F.col("probability"))[1]
        raw = self.trees.transform(vectors).select(*carry, p.alias("raw"))
        curved = self.curve.transform(raw)
        score = F.least(F.greatest(0.99 * F.col("calibrated") + 0.01 * F.col("raw"), F.lit(0.0)), F.lit(1.0))
        return curved.select(*carry, score.alias("score"))


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    rows, rows_path = kept_table(training_rows(docs, labels, bound), "toxicity-sample")
    n = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if n[1] in (0, n[0]):
        return Model({}, constant=n[1] / n[0] if n[0] else 0.0)
    # the calibrating fold's labels shape neither lexicon nor trees
    later_fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == 0
    early = rows.where(~later_fold)
    both = early.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    split = both[1] not in (0, both[0])
    lexicon = learn_lexicon(early if split else rows)
    features, features_path = kept_table(feature_table(rows, lexicon, "doc_id", "label"), "toxicity-features")
    data = features.select(
        "label", later_fold.alias("later"), array_to_vector(F.array(*FEATURES)).alias("features")
    ).coalesce(8)
    first = data.where("NOT later") if split else data
    trees = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=TREES,
        maxDepth=DEPTH,
        stepSize=STEP,
        maxBins=64,
        minInstancesPerNode=max(3, int(n[0]) // LEAF_PART),
        seed=7,
    ).fit(first)
    p = vector_to_array(F.col("probability"))[1]
    later = trees.transform(data.where("later")).select("label", p.alias("raw"))
    if later.select("label").distinct().count() < 2:
        later = trees.transform(data).select("label", p.alias("raw"))
    # many rows share a probability: one weighted point for each
    points = later.groupBy("raw").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("n"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="n", predictionCol="calibrated").fit(points)
    for path in (rows_path, features_path):
        drop_table(docs.sparkSession, path)
    return Model(lexicon, trees, curve)


def score_documents(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scored = model.score(feature_table(docs, model.lexicon, "doc_id"), "doc_id")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def reject_toxic(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` without the rows predicted toxic; all columns stay as they are."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    n = len(df.columns)
    names = [f"c{i}" for i in range(n)]
    at = df.columns.index(text_col)
    lexicon = model.lexicon
    kinds = df.schema

    def run(batches):
        flags = WordFlags(lexicon)
        for batch in batches:
            rows = np.array([features_of(t, flags) for t in batch.column(at).to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], names=[*names, *[f"f_{f}" for f in FEATURES]]
            )

    carried = [StructField(a, f.dataType) for a, f in zip(names, kinds)]
    schema = StructType(carried + [StructField(f"f_{f}", DoubleType()) for f in FEATURES])
    wide = map_batches(df.toDF(*names), run, schema).withColumnsRenamed({f"f_{f}": f for f in FEATURES})
    kept = model.score(wide, *names).where(F.col("score") < THRESHOLD)
    return kept.select(*[F.col(a).alias(c) for a, c in zip(names, df.columns)])


def op9_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_input(spark, sf_dir, "documents"), read_input(spark, sf_dir, "labels")
    return score_documents(docs, fit(docs, labels))
