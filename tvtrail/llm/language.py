"""Language of a text: family first, then the languages inside it pair by pair.

Texts become hashed counts of one to three neighbouring bytes (lower case, other ASCII
than letters as blanks).  Linear support vector machines, one per family against the
rest, choose the family; inside it one machine per pair of languages votes.  All are
trained by dual coordinate descent on a bounded sample of labelled documents.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows a model is trained on: of each language, and of all together.
SAMPLE_PER_LANGUAGE = 300
SAMPLE_ROWS = 4_000
CELLS = 1 << 12
UNKNOWN = "und"

# Families of common languages by ISO 639-1 code; others stand alone.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "indic": ("hi", "mr", "ne", "bn", "as", "gu", "pa", "ur"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "semitic": ("ar", "he", "am", "mt"),
    "uralic": ("fi", "et", "hu"),
    "malayic": ("id", "ms", "jv", "su"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_FOLD = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def family_of(lang: str) -> str:
    return _FAMILY.get(re.split("[-_]", lang)[0].lower(), lang)


def features(text: str) -> np.ndarray:
    """Square roots of hashed counts, of length one."""
    b = np.frombuffer(text.lower().encode().translate(_FOLD), np.uint8).astype(np.uint32)
    pairs = b[:-1] * np.uint32(257) + b[1:]
    triples = pairs[:-1] * np.uint32(65537) + b[2:] * np.uint32(31)
    grams = np.concatenate((b, pairs, triples)) * np.uint32(2654435761)
    counts = np.sqrt(np.bincount(grams >> np.uint32(20), minlength=CELLS)).astype(np.float32)
    return counts / max(float(np.linalg.norm(counts)), 1e-9)


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one is the bias) of a linear SVM with squared hinge loss."""
    x = np.hstack((x, np.ones((len(x), 1), x.dtype))).astype(np.float64)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    norms = (x * x).sum(axis=1) + 0.5 / cost
    order = np.random.default_rng(5)
    for _ in range(rounds):
        most = 0.0
        for n in order.permutation(len(x)):
            slope = y[n] * (w @ x[n]) - 1 + alpha[n] * 0.5 / cost
            new = max(0.0, alpha[n] - slope / norms[n])
            if new != alpha[n]:
                w += (new - alpha[n]) * y[n] * x[n]
                most = max(most, abs(new - alpha[n]))
            alpha[n] = new
        if most < 1e-3:
            break
    return w.astype(np.float32)


@dataclass
class Model:
    families: dict[str, list[str]] = field(default_factory=dict)
    to_family: dict[str, np.ndarray] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and a score from 0 to 1; ``und`` and 0 for a text without letters (category L)."""
        if not self.families or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x = features(text)
        names = list(self.families)
        margins = np.array([x @ self.to_family[f][:-1] + self.to_family[f][-1] for f in names]) if len(names) > 1 else np.zeros(1)
        odds = np.exp(4 * (margins - margins.max()))
        family = names[int(np.argmax(margins))]
        score = float(odds.max() / odds.sum())
        votes = {lang: [0, 0.0] for lang in self.families[family]}
        for (a, b), w in self.pairs.items():
            if a in votes and b in votes:
                margin = float(x @ w[:-1] + w[-1])
                winner = a if margin >= 0 else b
                votes[winner][0] += 1
                votes[a][1] += margin
                votes[b][1] -= margin
        best = max(votes, key=lambda lang: (*votes[lang], lang))
        if len(votes) > 1:
            score /= 1 + float(np.exp(-4 * votes[best][1] / (len(votes) - 1)))
        return best, score


def fit(langs: list[str], x: np.ndarray) -> Model:
    model = Model()
    for lang in sorted(set(langs)):
        model.families.setdefault(family_of(lang), []).append(lang)
    own = np.array([family_of(lang) for lang in langs])
    each = np.array(langs)
    for family, members in model.families.items():
        if len(model.families) > 1:
            model.to_family[family] = train_svm(x, np.where(own == family, 1.0, -1.0))
        for a, b in itertools.combinations(members, 2):
            rows = (each == a) | (each == b)
            model.pairs[a, b] = train_svm(x[rows], np.where(each[rows] == a, 1.0, -1.0))
    return model


def held_out(key: Column) -> Column:
    """True for the third of the ids that is never learnt from; null ids are not in it."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> Model:
    """Fit on documents where ``learn`` holds and text and language are known.

    At most ``SAMPLE_PER_LANGUAGE`` documents of a language, ``SAMPLE_ROWS`` in all, those
    with the smallest hash of the text, each text once; their features come to the driver.
    """
    rows = docs.where(learn & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").rlike(r"\p{L}")).select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    picks = rows.select("lang", "hash").distinct().withColumn("rank", rank).where(F.col("rank") <= SAMPLE_PER_LANGUAGE)
    picked = picks.select("lang", "hash", "rank").orderBy("rank", "lang").limit(SAMPLE_ROWS)

    @F.arrow_udf("binary")
    def vector(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([features(t).astype(np.float16).tobytes() for t in batch.to_pylist()], pa.binary())

    chosen = (
        rows.join(F.broadcast(picked), ["lang", "hash"])  # SAMPLE_ROWS rows at most
        .dropDuplicates(["lang", "hash"]).select("lang", "hash", vector("text").alias("x"))
        .orderBy("lang", "hash").collect())
    if not chosen:
        return Model()
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in chosen]).astype(np.float32)
    return fit([r["lang"] for r in chosen], x)


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct: lang, score.  Null texts and texts without letters are ``und``."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [model.predict(t) for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang", "score"])

    return docs.withColumn(into, run(F.col(f"`{text}`")))
