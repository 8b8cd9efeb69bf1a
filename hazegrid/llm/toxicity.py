"""Toxicity scores from a classifier that may not care which group a sentence names.

A logistic model over words and word beginnings is fitted on a bounded sample of labelled
documents. Identity terms are swapped for one another in the labelled documents that name
a group, and inserted on their own; the squared change of the score is part of the loss,
so a neutral mention of a group moves no score.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value, extended
from hazegrid.llm.linear import Rows, feature_id, fit_logistic, sigmoid

#: Most labelled documents of either class the fit reads, whole, in order of a hash.
MAX_TOXIC, MAX_OTHER = 4_000, 8_000
#: Strength of the counterfactual penalty per document that names a group, and per term.
SWAP, INSERT = 1.0, 50.0
THRESHOLD = 0.3
RIDGE = 0.03
#: Lengths of word beginnings that count as features.
STEMS = (4, 5, 6)
_CACHED = 1 << 18

#: Terms for groups that are swapped for one another (a parameter).
IDENTITY_TERMS = (
    "women men woman man girls boys black white asian african latino european jewish muslim "
    "christian hindu buddhist atheist gay lesbian straight bisexual transgender immigrant "
    "immigrants refugees foreigners natives disabled deaf blind elderly young old "
    "frauen männer juden muslime christen schwarze weiße ausländer flüchtlinge "
    "femmes hommes juifs musulmans chrétiens noirs blancs étrangers réfugiés "
    "mujeres hombres judíos musulmanes cristianos negros blancos extranjeros refugiados").split()

_LETTERS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """A word and its beginnings, hashed."""
    return [feature_id(word)] + [feature_id(f"{word[:n]}…") for n in STEMS if len(word) >= n]


class _Stems(dict):
    """Feature numbers of word beginnings, remembered up to a bound: few are new."""

    def __missing__(self, stem: str) -> int:
        found = feature_id(f"{stem}…")
        if len(self) < _CACHED:
            self[stem] = found
        return found


class Features(dict):
    """Feature numbers of white-space separated tokens, remembered up to a bound.

    With ``only``, others are left out; most tokens then have none.
    """

    def __init__(self, only=None):
        super().__init__()
        self.only, self.stems = only, _Stems()

    def __missing__(self, token: str) -> tuple[int, ...]:
        only, stems, found = self.only, self.stems, []
        for w in _LETTERS.findall(token):
            ids = [feature_id(w)] + [stems[w[:n]] for n in STEMS if len(w) >= n]
            found += ids if only is None else [i for i in ids if i in only]
        found = tuple(found)
        if len(self) < _CACHED:
            self[token] = found
        return found

    def of(self, text: str | None) -> list[int]:
        if not text:
            return []
        return sorted({i for t in set(text.lower().split()) for i in self[t]})


def in_training() -> Column:
    """Rows whose labels may be learnt; the others are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2


def sampled_rows(docs: DataFrame, labels: DataFrame, label: str, limits: dict[int, int],
                 features, carry: Sequence[str] = ()) -> pa.Table:
    """(doc_id, label, features, more) of at most ``limits[c]`` labelled documents per class.

    Labels first: of several labels of one document the largest counts, labels of documents
    that ``docs`` lacks do not, and documents are taken in order of a hash. The chosen ids are few, so they are broadcast and the texts
    stay where they are. ``features`` makes a function from lists of (text, *carry) to lists
    of features and more features.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = known.join(present, "doc_id", "left_semi")
    chosen = None
    for value, most in limits.items():
        part = known.filter(F.col("label") == value).orderBy(
            F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry).join(
        F.broadcast(chosen), "doc_id")
    def packed():
        function = features()
        return lambda *columns: [[np.asarray(x, np.int32).tobytes() for x in part]
                                 for part in function(*columns)]

    # as bytes: a list of numbers would be Python objects on the driver
    made = extended(rows, ["text", *carry], {"features": "binary", "more": "binary"}, packed)
    # a doc_id with several rows counts once; as Arrow, the bytes are not copied on the driver
    return made.groupBy("doc_id", "label").agg(
        F.min(F.struct("features", "more")).alias("x")).select(
        "doc_id", "label", "x.*").orderBy("doc_id").toArrow()


def swaps(rows: Rows, terms: Sequence[str]) -> list[tuple[list[int], list[int], float]]:
    """Counterfactual pairs (features before, features after, strength).

    A document that names one group is compared with itself naming each other one, which
    changes just the terms' features; equal comparisons of several documents are summed.
    """
    feats = [word_features(t) for t in terms]
    seen = rows.seen()
    out = []
    for k, f in enumerate(feats):
        out.append(([], f, INSERT))
        if n := int(seen[f[0]]):
            out.extend((f, g, SWAP * n / len(feats)) for j, g in enumerate(feats) if j != k)
    return out


def fit(docs: DataFrame, labels: DataFrame, terms: Sequence[str] = tuple(IDENTITY_TERMS)
        ) -> tuple[np.ndarray, float]:
    """Weights and intercept from training rows only (see ``in_training``).

    The odds are those of the sample, which holds relatively more toxic documents than the
    labels do where these exceed ``MAX_OTHER``: a missed one costs more than a dropped one.
    """
    def features():
        known = Features()
        return lambda texts: ([known.of(t) for t in texts], [[]] * len(texts))

    got = sampled_rows(docs, labels.filter(in_training()), "toxic", {1: MAX_TOXIC, 0: MAX_OTHER},
                       features)
    rows, y = Rows.packed(got["features"].combine_chunks()), got["label"].to_numpy().astype(float)
    del got
    pa.default_memory_pool().release_unused()
    return fit_logistic(rows, y, ridge=RIDGE, min_rows=5, pairs=swaps(rows, terms), rounds=40)


def score(docs: DataFrame, labels: DataFrame, carry: Sequence[str] = ("doc_id",),
          terms: Sequence[str] = tuple(IDENTITY_TERMS), threshold: float = THRESHOLD) -> DataFrame:
    """``carry`` columns, score and predicted of every row, from its whole text alone.

    Null, empty and wordless texts get the score of a text without features. Rows without a
    doc_id are scored but teach nothing; repeated rows score alike. Without labels of both
    classes every row gets the observed rate of toxic labels, or nearly 0. An empty table
    gives an empty result. Other columns are not read.
    """
    weights, bias = fit(docs, labels, terms)
    used = np.flatnonzero(np.abs(weights) > 1e-3)
    model = docs.sparkSession.sparkContext.broadcast((used.astype(np.int32),
                                                      weights[used].astype(np.float32), bias))

    def make():
        ids, values, b = model.value
        weight = dict(zip(ids.tolist(), values.tolist(), strict=True))
        known = Features(weight)

        def scores(texts: list) -> tuple:
            z = np.array([sum(weight[i] for i in known.of(t)) for t in texts], float)
            return (sigmoid(z + b),)

        return scores

    rows = docs.select(*carry, F.col("text").alias("__text"))
    return extended(rows, ["__text"], {"score": "double"}, make).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


by_value(__name__)
