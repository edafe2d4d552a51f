"""Language identification in two steps: family first, then the language.

Features are hashed character 1- to 4-grams of the lower-cased text, runs of
anything but letters counting as one space; a text is the vector of their
shares.  Families are told apart by one-versus-one linear support vector
machines (squared hinge), and so are the languages within a family; the
margin of each machine becomes a probability by a fitted logistic slope.  The
most probable family is chosen (mean of its pairwise probabilities), then the
most probable language in it; the score is the product.

``FAMILIES`` names the families; a language it does not know is a family of
its own.  Training reads about ``per_language`` texts of each language, of
``max_chars`` characters at most, chosen by a hash of doc_id and text, equal
rows once; prediction reads every whole text.

A null text, or one without letters, is ``und`` with score 0.  Without any
labelled text every prediction is ``und``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import ready, text_of

# fixed values: ISO 639-1 codes by family
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ur"),
    "austronesian": ("id", "ms", "tl"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

BUCKETS = 1 << 13
ORDERS = 4
_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def grams(text: str) -> np.ndarray:
    """Feature numbers of all n-grams of a text (empty without letters)."""
    c = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _LETTER[np.minimum(c, 0xFFFF)]
    rare = np.flatnonzero(c > 0xFFFF)
    if len(rare):
        letter[rare] = [chr(x).isalpha() for x in c[rare]]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    c = np.where(letter, c, 32).astype(np.uint32)
    c = c[letter | np.r_[True, letter[:-1]]]  # one space for a run of them
    out, h = [], np.zeros(len(c), dtype=np.uint32)
    for k in range(ORDERS):
        h = h[: len(c) - k] * np.uint32(31) + c[k:] * _FACTORS[k]
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out.append((mixed >> np.uint32(32 - 13)).astype(np.int64))
    return np.concatenate(out)


def shares(found: np.ndarray) -> np.ndarray:
    return np.bincount(found, minlength=BUCKETS).astype(np.float64) / max(1, len(found))


@dataclass
class Machine:
    """One-versus-one: positive margins speak for ``a``."""

    a: str
    b: str
    weights: np.ndarray
    bias: float
    slope: float

    def probability(self, found: np.ndarray) -> float:
        margin = self.weights[found].sum() / len(found) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin, -30, 30))))


@dataclass
class LanguageModel:
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


def _machine(a: str, b: str, xa: np.ndarray, xb: np.ndarray, rounds: int = 300) -> Machine:
    """Squared-hinge SVM by accelerated gradient on standardised shares, then
    the logistic slope of its margins."""
    x = np.concatenate([xa, xb])
    y = np.repeat([1.0, -1.0], [len(xa), len(xb)])
    cost = np.where(y > 0, 0.5 / len(xa), 0.5 / len(xb))
    centre = x.mean(axis=0)
    scale = 1 / (np.sqrt(x.var(axis=0)) + np.sqrt(x.mean(axis=0) / 1000) + 1e-6)
    z = (x - centre) * scale / np.sqrt(BUCKETS)
    w, v, bias, vb, lam = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, 1e-3
    rate = 1 / (2 * (z**2).sum(axis=1).max() + 2 + lam)
    for k in range(rounds):
        lead = k / (k + 3)
        lw, lb = w + lead * v, bias + lead * vb
        slack = np.maximum(0, 1 - y * (z @ lw + lb)) * cost * y
        nw, nb = lw + rate * (2 * (slack @ z) - lam * lw), lb + rate * 2 * slack.sum()
        v, vb, w, bias = nw - w, nb - bias, nw, nb
    margin = z @ w + bias
    slope = 1.0
    for _ in range(50):  # Newton steps for the slope, damped towards finite ones
        p = 1 / (1 + np.exp(-np.clip(slope * margin, -30, 30)))
        gradient = (cost * (p - (y > 0)) * margin).sum() + 1e-3 * slope
        slope -= gradient / ((cost * p * (1 - p) * margin**2).sum() + 1e-3)
    weights = w * scale / np.sqrt(BUCKETS)
    return Machine(a, b, weights.astype(np.float32), float(bias - centre @ weights), float(max(slope, 0.1)))


def train(
    docs: DataFrame, allowed: Column | None = None, per_language: int = 400, max_chars: int = 20_000
) -> LanguageModel:
    """Fit on the rows of ``docs`` with a language whose doc_id satisfies ``allowed``."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_of().alias("text")
    ).where(F.col("lang").isNotNull() & (F.length("text") > 0) & (F.length("text") <= max_chars))
    known = known if allowed is None else known.where(allowed)
    known = known.withColumn("h", F.xxhash64("doc_id", "text"))
    # distinct rows, about: one number per language
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    place = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    # about 2 * per_language distinct rows of each language; equal rows count once
    some = (
        known.join(F.broadcast(counts), "lang")
        .where(place * F.col("n") < 2 * per_language)
        .groupBy("lang", "h")
        .agg(F.min("text").alias("text"))
    )
    order = Window.partitionBy("lang").orderBy(place, "h")
    rows = (
        some.withColumn("o", F.row_number().over(order))
        .where(F.col("o") <= 2 * per_language)
        .select("lang", "o", "text")
        .collect()  # 2 * per_language rows of each language at most
    )
    rows.sort(key=lambda r: (r["lang"], r["o"]))
    vectors: dict[str, list[np.ndarray]] = {}
    for r in rows:
        own = vectors.setdefault(r["lang"], [])
        if len(own) < per_language and len(found := grams(r["text"])):
            own.append(shares(found).astype(np.float32))
    table = {lang: np.array(v) for lang, v in sorted(vectors.items()) if v}
    families: dict[str, list[str]] = {}
    for lang in table:
        families.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)

    def of(family: str) -> np.ndarray:
        each = max(1, per_language // len(families[family]))
        return np.concatenate([table[lang][:each] for lang in families[family]])

    between = [_machine(a, b, of(a), of(b)) for a, b in itertools.combinations(families, 2)]
    within = {
        f: [_machine(a, b, table[a], table[b]) for a, b in itertools.combinations(langs, 2)]
        for f, langs in families.items()
    }
    return LanguageModel(families, between, within)


def _choose(names: list[str], machines: list[Machine], found: np.ndarray) -> tuple[str, float]:
    if len(names) == 1:
        return names[0], 1.0
    total = dict.fromkeys(names, 0.0)
    for m in machines:
        p = m.probability(found)
        total[m.a] += p
        total[m.b] += 1 - p
    best = max(names, key=lambda n: (total[n], n))
    return best, total[best] / (len(names) - 1)


def identify(model: LanguageModel, text: str | None) -> tuple[str, float]:
    found = grams(text or "")
    if not len(found) or not model.families:
        return "und", 0.0
    family, p = _choose(list(model.families), model.between, found)
    lang, q = _choose(model.families[family], model.within[family], found)
    return lang, p * q


def language(model: LanguageModel, text: Column) -> Column:
    """struct(lang, score) of each text."""
    ready()

    @F.pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [identify(model, t) for t in batch]
            yield pd.DataFrame(found, columns=["lang", "score"])

    return predicted(text.cast("string"))
