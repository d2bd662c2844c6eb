"""Language by hierarchical discrimination: the family first, then linear support vector machines within it.

A text is described by the counts of its byte trigrams over lower-case letters
(every other ASCII sign is a space), hashed to ``PLACES`` places, square roots taken,
scaled to length 1.  One-versus-one linear support vector machines vote, first
between families, then between the languages of the family that won; ties go to the
larger sum of margins, then to the code that sorts first.  ``score`` is the product over
both levels of the winner's least logistic margin against a rival (1 without rivals).

Learning takes rows with a letter, a language, and an id that is not held out: about ``SAMPLE``
at most (by a hash of the id), evenly over the ``LANGUAGES`` most frequent languages; only these
are known values.  ``FAMILIES`` names the families; a code it does not list is a family of its own.
The driver collects the sample's profiles (8 kB each) and fits the machines, by Newton steps
on the squared hinge loss.  Language, source and id are never features.

A null text and one without a letter are ``und`` with score 0, as is every text when
nothing could be learned.  A null id is never held out.  Texts are read whole, a
piece at a time.  Repeated rows give repeated results, empty tables empty results;
other columns may have any name.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, read_input

# fixed values: families of closely related languages
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "nb", "nn", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "gl", "ro", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa"),
}
UNKNOWN = "und"
PLACES = 1 << 11
SAMPLE = 6_000
LANGUAGES = 64
FOLDS, HELD_OUT = 4, 2
ROUNDS, REGULARISATION = 20, 1e-3
PIECE_BYTES = 1 << 20
LETTER = re.compile(r"[^\W\d_]")
# bytes as features see them: ASCII letters and all bytes of other letters stay, the rest are spaces
_KEPT = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), lang)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def trigram_profile(text: str, places: int = PLACES) -> np.ndarray:
    """Hashed byte trigrams of the whole text; trigrams of spaces only count nothing."""
    total = np.zeros(places, np.float64)
    shift = np.uint32(32 - (places.bit_length() - 1))
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    for k in range(0, len(raw), PIECE_BYTES):
        b = _KEPT[raw[k : k + PIECE_BYTES + 2]]  # two bytes of the next piece: each trigram counts once
        code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
        code = code[(b[1:-1] != 32) | (b[:-2] != 32) & (b[2:] != 32)]
        total += np.bincount((code * np.uint32(2654435761)) >> shift, minlength=places)
    root = np.sqrt(total)
    size = np.sqrt((root * root).sum())
    return (root / size if size else root).astype(np.float32)


def profile_table(rows: DataFrame, places: int = PLACES) -> DataFrame:
    """``lang, features`` of the rows whose text has a letter."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                kept = [(g, trigram_profile(t, places)) for g, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if LETTER.search(t)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for g, _ in kept], pa.string()), pa.array([f.tolist() for _, f in kept], pa.list_(pa.float32()))],
                    names=["lang", "features"],
                )

    return map_batches(rows.select("lang", "text"), run, "lang string, features array<float>")


def training_rows(docs: DataFrame, sample: int, languages: int) -> DataFrame:
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    found = {r["lang"]: r["n"] for r in counts.collect()}
    if not found:
        return known.where("false")
    share = {lang: min(1.0, sample / len(found) / n) for lang, n in found.items()}
    pick = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    bound = F.lit(0)
    for lang, part in share.items():
        bound = F.when(F.col("lang") == lang, F.lit(int((1 << 30) * part))).otherwise(bound)
    return known.where(pick < bound)


class Duels:
    """One-versus-one machines between classes: weights and offsets, a row a pair (first class positive)."""

    def __init__(self, classes: list[str], weights: np.ndarray, offsets: np.ndarray):
        self.classes, self.weights, self.offsets = classes, weights, offsets
        self.pairs = np.array(list(combinations(range(len(classes)), 2)), np.int64).reshape(-1, 2)

    def decide(self, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row: number of the class that won, and its least logistic margin."""
        n, k = len(profiles), len(self.classes)
        if k == 1:
            return np.zeros(n, np.int64), np.ones(n)
        margins = profiles @ self.weights.T + self.offsets
        votes, sums, least = np.zeros((n, k)), np.zeros((n, k)), np.full((n, k), np.inf)
        for j, (x, y) in enumerate(self.pairs):
            m = margins[:, j]
            votes[:, x] += m >= 0
            votes[:, y] += m < 0
            for c, own in ((x, m), (y, -m)):
                sums[:, c] += own
                least[:, c] = np.minimum(least[:, c], own)
        most = votes == votes.max(axis=1, keepdims=True)
        won = np.argmax(np.where(most, sums, -np.inf), axis=1)
        return won, 1 / (1 + np.exp(-np.clip(2 * least[np.arange(n), won], -50, 50)))


class Model:
    def __init__(self, families: Duels, within: list[Duels]):
        self.families, self.within = families, within

    def predict(self, profiles: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, sure = self.families.decide(profiles)
        lang, score = [UNKNOWN] * len(profiles), np.zeros(len(profiles))
        for f in np.unique(family):
            at = np.flatnonzero(family == f)
            won, inner = self.within[f].decide(profiles[at])
            for i, c in zip(at.tolist(), won.tolist()):
                lang[i] = self.within[f].classes[c]
            score[at] = sure[at] * inner
        return lang, score


def fit_machine(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, weight: float = REGULARISATION) -> np.ndarray:
    """Weights, and the offset behind them, of a linear machine for labels 1 and -1: squared hinge
    loss, each class weighing the same, by Newton steps (conjugate gradients) with step halving."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    ridge = np.append(np.full(x.shape[1] - 1, weight), 0.01 * weight).astype(x.dtype)

    def loss(w):
        gap = np.maximum(1 - y * (x @ w), 0)
        return (share * gap * gap).sum() + 0.5 * (ridge * w * w).sum()

    w = np.zeros(x.shape[1], x.dtype)
    now = loss(w)
    for _ in range(rounds):
        gap = 1 - y * (x @ w)
        on = gap > 0
        xo, so = x[on], share[on]
        slope = ridge * w - 2 * xo.T @ (so * y[on] * gap[on])
        step, rest = np.zeros_like(w), -slope
        ahead, size = rest.copy(), float(rest @ rest)
        for _ in range(50):
            bent = ridge * ahead + 2 * xo.T @ (so * (xo @ ahead))
            k = size / float(ahead @ bent)
            step += k * ahead
            rest -= k * bent
            before, size = size, float(rest @ rest)
            if size < 1e-6 * float(slope @ slope):
                break
            ahead = rest + size / before * ahead
        part = 1.0
        while loss(w + part * step) > now and part > 1e-3:
            part /= 2
        then = loss(w + part * step)
        if not then < now * (1 - 1e-6):
            break
        w, now = w + part * step, then
    return w


def _duels(profiles: np.ndarray, names: np.ndarray, classes: list[str]) -> Duels:
    found = []
    for x, y in combinations(classes, 2):
        at = (names == x) | (names == y)
        found.append(fit_machine(profiles[at], np.where(names[at] == x, 1, -1).astype(np.float32)))
    w = np.array(found, np.float32).reshape(-1, profiles.shape[1] + 1)
    return Duels(classes, w[:, :-1], w[:, -1])


def fit(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES, places: int = PLACES) -> Model | None:
    """Machines between the families, and within each between its languages; None if nothing can be learned."""
    table = profile_table(training_rows(docs, sample, languages), places).toArrow()
    if not table.num_rows:
        return None
    langs = np.array(table.column("lang").to_pylist())
    profiles = np.concatenate([c.flatten().to_numpy() for c in table.column("features").chunks]).reshape(-1, places)
    known = sorted(set(langs.tolist()))
    names = sorted({family_of(g) for g in known})
    families = _duels(profiles, np.array([family_of(g) for g in langs.tolist()]), names)
    return Model(families, [_duels(profiles, langs, [g for g in known if family_of(g) == f]) for f in names])


def predict_languages(docs: DataFrame, model: Model | None, places: int = PLACES) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score.  One narrow pass, no shuffle."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = part.column(2).to_pylist()
                at = [i for i, t in enumerate(texts) if model is not None and t and LETTER.search(t)]
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if at:
                    found, sure = model.predict(np.array([trigram_profile(texts[i], places) for i in at]))
                    score[at] = sure
                    for i, g in zip(at, found):
                        lang[i] = g
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify_languages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    languages: int = LANGUAGES,
    places: int = PLACES,
) -> DataFrame:
    docs = df.selectExpr(
        f"cast(`{id_col}` as long) AS doc_id", f"cast(`{text_col}` as string) AS text", f"cast(`{lang_col}` as string) AS lang"
    )
    return predict_languages(docs, fit(docs, sample, languages, places), places)


def op11_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_input(spark, sf_dir, "documents"))
