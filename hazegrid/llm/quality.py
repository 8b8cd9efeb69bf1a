"""Quality scores by co-training a text-content and a page-metadata classifier.

Both views learn from a bounded sample of labelled documents. Over a few rounds each view
labels those of all unlabelled documents it is surest of, and the other view learns them
too: scores and gradients are sums over tables of features. Each view is put on a scale of its
own (Platt) and the scales are combined on labelled documents that neither learnt from. Features
are made once, from whole texts and metadata, and written; every document is scored from them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from hazegrid.llm.common import by_value, discard, extended, written
from hazegrid.llm.linear import (SPACE, Rows, feature_id, fit_logistic, fit_tables, on_grid, sigmoid,
                                 summed)

#: Most labelled documents of either class that are learnt, whole, in order of a hash.
MAX_GOOD, MAX_BAD = 8_000, 4_000
ROUNDS = 4
#: Share of the unlabelled documents left that each view labels in a round, and the least certainty for it.
SHARE, CERTAIN = 0.08, 0.95
#: One labelled document in so many is kept for calibration.
CALIBRATION = 5
THRESHOLD = 0.5
RIDGE = 1.0
#: Shapes are remembered for so many tokens of at most so many characters.
_CACHED, _LONG = 1 << 17, 64

_RUNS = ((re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\d+"), "0"),
         (re.compile(r"([^\w\s])\1+"), r"\1\1"))
#: Signs: neither letters, digits nor white space.
_SIGNS = re.compile(r"[^\w\s]+|_+")


class Shapes(dict):
    """The shape of a token: letters as one a, digits as one 0, runs of a sign as two."""

    def __missing__(self, token: str) -> str:
        shape = token
        for pattern, to in _RUNS:
            shape = pattern.sub(to, shape)
        if len(token) <= _LONG and len(self) < _CACHED:
            self[token] = shape
        return shape


def _level(x: float, floor: float = 1e-3) -> int:
    """A share or ratio on a coarse logarithmic scale."""
    return round(2 * math.log2(max(x, floor)))


def content_features(text: str, shapes: Shapes) -> list[int]:
    """What the text says and how it is worded: token shapes, repetition, variety."""
    tokens = text.split()
    n = len(tokens)
    names = [f"n{_level(n + 1)}"]
    if n:
        words = Counter(tokens)
        forms = Counter(map(shapes.__getitem__, tokens))
        top = words.most_common(1)[0][1]
        repeated = sum(map(eq, tokens, tokens[1:]))
        threes = Counter(zip(tokens, tokens[1:], tokens[2:]))
        again = max(0, n - 2) - list(threes.values()).count(1)
        length = sum(map(len, tokens)) / n
        odd = n - sum(c for f, c in forms.items() if f.rstrip(".,;:!?") in ("a", "0", "a'a", "a-a"))
        ended = sum(c for f, c in forms.items() if f[-1] in ".!?")
        names += [f"v{_level(len(words) / n)}/{min(9, int(math.log2(n)))}", f"t{_level(top / n)}",
                  f"r{_level(repeated / n)}", f"3{_level(again / n)}", f"l{round(2 * length)}",
                  f"o{_level(odd / n)}", f"e{_level(ended / n)}"]
        names += [f"s{f}" for f in forms] + [f"S{f}/{_level(c / n)}" for f, c in forms.items()]
    return sorted({feature_id(f"c:{x}") for x in names})


def metadata_features(source: str | None, lang: str | None, n_chars: float | None, text: str
                      ) -> list[int]:
    """What is known of the page: source, language, recorded length, layout of lines."""
    lines = [x for x in text.split("\n") if x.strip()]
    n = len(lines)
    width = sum(map(len, lines)) / n if n else 0
    recorded = -1.0 if n_chars is None or n_chars != n_chars else n_chars
    capital = sum(x.lstrip()[0].isupper() for x in lines)
    closed = sum(x.rstrip()[-1] in ".!?" for x in lines)
    count = {k: text.count(k) for k in ("|", "#", "http", "@", "{", "<", "\t")}
    signs = len(text) - len(_SIGNS.sub("", text))
    names = [f"s{source}", f"g{lang}", f"c{_level(recorded + 1)}", f"n{_level(n + 1)}",
             f"w{_level(width + 1)}", f"k{_level(capital / max(n, 1))}",
             f"e{_level(closed / max(n, 1))}", f"d{_level((n - len(set(lines))) / max(n, 1))}",
             f"p{_level(signs / max(1, len(text)))}"]
    names += [f"{k}{_level(c / max(1, len(text)), 1e-5)}" for k, c in count.items()]
    return sorted({feature_id(f"m:{x}") for x in names})


META = ["source", "lang", "n_chars"]


def both_views():
    """A function from lists of text, source, language, length to both views' features."""
    shapes = Shapes()

    def views(texts: list, *meta: list) -> tuple[list, list]:
        texts = [t or "" for t in texts]
        return ([content_features(t, shapes) for t in texts],
                [metadata_features(*m, t) for *m, t in zip(*meta, texts, strict=True)])

    return views


class View:
    """One classifier and what it has learnt from so far."""

    def __init__(self, rows: list, labels: np.ndarray):
        self.rows, self.labels = list(rows), list(labels)
        self.scale = (1.0, 0.0)
        self.fit()

    def fit(self) -> None:
        self.weights, self.bias = fit_logistic(Rows(self.rows), np.array(self.labels),
                                               ridge=RIDGE, min_rows=3, rounds=60)

    def learn(self, rows: list, labels: list) -> None:
        self.rows += rows
        self.labels += labels
        self.fit()

    def logits(self, rows: list) -> np.ndarray:
        return Rows(rows).logits(self.weights) + self.bias

    def calibrated(self, rows: list) -> np.ndarray:
        """Logits on the scale fitted to documents that the view did not learn from."""
        return self.scale[0] * self.logits(rows) + self.scale[1]


def _surest(p: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the surest good and bad documents, in proportion to how common they look."""
    most = max(1, int(len(p) * share))
    order = np.argsort(p, kind="stable")
    bad = [i for i in order[:max(1, int(most * (p < 0.5).mean()))] if p[i] <= 1 - CERTAIN]
    good = [i for i in order[::-1][:max(1, int(most * (p >= 0.5).mean()))] if p[i] >= CERTAIN]
    return np.array(good, int), np.array(bad, int)


def co_train(labelled: tuple[list, list], labels: np.ndarray, pool: tuple[list, list],
             rounds: int = ROUNDS) -> tuple[list[View], np.ndarray]:
    """The two views and the combination (weight of either logit, intercept).

    For a pool in memory; ``co_train_table`` does the same with one of any size.
    """
    views, held = _first_views(labelled, labels)
    left = np.arange(len(pool[0]))
    for _ in range(rounds):
        if not len(left):
            break
        taken: dict[int, None] = {}
        lessons = []
        for k, view in enumerate(views):
            p = sigmoid(view.logits([pool[k][i] for i in left]))
            good, bad = _surest(p, SHARE)
            chosen = [*left[good], *left[bad]]
            lessons.append((chosen, [1.0] * len(good) + [0.0] * len(bad)))
            taken |= dict.fromkeys(int(i) for i in chosen)
        for k, view in enumerate(views):
            chosen, told = lessons[1 - k]
            if chosen:
                view.learn([pool[k][i] for i in chosen], told)
        left = np.array([i for i in left if int(i) not in taken], int)
    return views, _calibrated(views, labelled, labels, held)


def _first_views(labelled: tuple[list, list], labels: np.ndarray) -> tuple[list[View], np.ndarray]:
    """Views that know the labelled documents, and the places of those kept for calibration."""
    aside = np.arange(len(labels)) % CALIBRATION == 0
    train = np.flatnonzero(~aside)
    return [View([rows[i] for i in train], labels[train]) for rows in labelled], \
        np.flatnonzero(aside)


def _calibrated(views: list[View], labelled: tuple[list, list], labels: np.ndarray,
                held: np.ndarray) -> np.ndarray:
    """Sets each view's scale on the documents kept aside; returns the combination of the views."""
    if not len(held):
        return _combination(np.empty((0, 2)), labels[held])
    for view, rows in zip(views, labelled, strict=True):
        view.scale = _platt(view.logits([rows[i] for i in held]), labels[held])
    z = np.stack([v.calibrated([rows[i] for i in held]) for v, rows in
                  zip(views, labelled, strict=True)], axis=1)
    return _combination(z, labels[held])


#: Logits are counted in bins of 1 / _FINE between -_FAR and _FAR.
_FAR, _FINE = 40, 64
_BINS = 2 * _FAR * _FINE
_DRAWS = 1 << 30


def _sure(z: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For good and bad: which rows are sure enough, and their bins, surest first."""
    bins = np.clip(np.floor((z + _FAR) * _FINE), 0, _BINS - 1).astype(np.int64)
    p = sigmoid(z)
    return [(p >= CERTAIN, _BINS - 1 - bins), (p <= 1 - CERTAIN, bins)]


class _Steps:
    """What the views of each round so far said, as sent to the tasks."""

    def __init__(self, steps: list):
        self.steps = []
        for views, cuts in steps:
            dense = []
            for used, values, bias in views:
                w = np.zeros(SPACE)
                w[used] = values
                dense.append((w, bias))
            self.steps.append((dense, cuts))

    def batch(self, batch: pa.RecordBatch):
        """Rows of both views, which rows no round took, the last round's logits, its choice.

        The choice is 1, 0 or -1 (not chosen) by view and row.
        """
        rows = [Rows.packed(batch.column(c)) for c in ("features", "more")]
        draw = batch.column("draw").to_numpy(zero_copy_only=False)
        left = np.ones(len(draw), bool)
        for i, (views, cuts) in enumerate(self.steps):
            logits = [r.logits(w) + b for r, (w, b) in zip(rows, views, strict=True)]
            chosen = np.full((2, len(draw)), -1)
            for k, cut in enumerate(cuts or ()):
                for label, (sure, bins), (last, part) in zip((1, 0), _sure(logits[k]), cut,
                                                             strict=True):
                    taken = sure & ((bins < last) | ((bins == last) & (draw < part)))
                    chosen[k, left & taken] = label
            if i < len(self.steps) - 1:
                left &= (chosen < 0).all(axis=0)
        return rows, left, logits, chosen


def _cut(counts: np.ndarray, want: int) -> tuple[int, int]:
    """(bin, draws): bins before it are taken whole, of it the documents of fewer draws."""
    upto = np.cumsum(counts)
    last = int(np.searchsorted(upto, want))
    if last == len(counts):
        return last, 0
    return last, int(_DRAWS * (want - upto[last] + counts[last]) / counts[last])


def _cuts(free: DataFrame, steps) -> list | None:
    """Where the last views' choices end, from counts of all documents left; None if none is."""

    def make():
        known = _Steps(steps.value)

        def add(total, batch):
            _, left, logits, _ = known.batch(batch)
            for k, z in enumerate(logits):
                at = k * (2 * _BINS + 2)
                for j, (sure, bins) in enumerate(_sure(z)):
                    total[at + j * _BINS:at + (j + 1) * _BINS] += np.bincount(
                        bins[sure & left], minlength=_BINS)
                total[at + 2 * _BINS] += left.sum()
                total[at + 2 * _BINS + 1] += (left & (z >= 0)).sum()

        return add

    cuts = []
    for part in summed(free, 2 * (2 * _BINS + 2), make).reshape(2, -1):
        n, likely = part[2 * _BINS:]
        if not n:
            return None
        most = max(1, int(n * SHARE))
        cuts.append([_cut(part[:_BINS], max(1, int(most * likely / n))),
                     _cut(part[_BINS:2 * _BINS], max(1, int(most * (n - likely) / n)))])
    return cuts


def _lessons(free: DataFrame, steps) -> DataFrame:
    """What the last round's views teach each other: model, label, features."""

    def work(batches):
        known = _Steps(steps.value)
        for batch in batches:
            _, _, _, chosen = known.batch(batch)
            for k, column in ((0, "features"), (1, "more")):
                at = np.flatnonzero(chosen[1 - k] >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, np.int32)),
                     pa.array(chosen[1 - k][at].astype(np.int32)),
                     batch.column(column).take(pa.array(at))], ["model", "label", "features"])

    return free.mapInArrow(work, "model int, label int, features binary")


def co_train_table(labelled: tuple[list, list], labels: np.ndarray, free: DataFrame,
                   rounds: int = ROUNDS) -> tuple[list[View], np.ndarray]:
    """``co_train`` with all rows of ``free``: features and more (bytes), draw (a hash).

    A round counts the scores of all rows left, takes the surest share and writes it as
    lessons of the other view. Among equal scores at the end of the share the draw decides.
    """
    views, held = _first_views(labelled, labels)
    context = free.sparkSession.sparkContext
    steps, lessons = [], []
    for _ in range(rounds):
        now = []
        for v in views:
            used = np.flatnonzero(on_grid(v.weights))
            now.append((used.astype(np.int32), on_grid(v.weights[used]), on_grid(v.bias)))
        told = context.broadcast([*steps, (now, None)])
        cuts = _cuts(free, told)
        told.destroy()
        if cuts is None:
            break
        steps.append((now, cuts))
        told = context.broadcast(steps)
        lessons.append(written(_lessons(free, told), "lessons"))
        told.destroy()
        both = reduce(DataFrame.unionByName, lessons)
        fitted = fit_tables([(Rows(v.rows), np.array(v.labels), v.weights, v.bias) for v in views],
                            both, ridge=RIDGE, min_rows=3)
        for view, (weights, bias) in zip(views, fitted, strict=True):
            view.weights, view.bias = weights, bias
    discard(*lessons)
    return views, _calibrated(views, labelled, labels, held)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) of a logistic regression of the label on one view's logit."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    x = np.stack([np.clip(z, -30, 30), np.ones(len(z))], axis=1)
    w = start = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-1 * np.eye(2),
                               x.T @ (p - y) + 1e-1 * (w - start))
        w = w - step
        w[0] = max(w[0], 0.05)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _combination(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on both views' logits, none counted negatively."""
    if not len(y) or y.min() == y.max():
        return np.array([0.5, 0.5, 0.0])
    w = np.array([0.5, 0.5, 0.0])
    x = np.concatenate([np.clip(z, -12, 12), np.ones((len(z), 1))], axis=1)
    for _ in range(50):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + 1e-1 * (w - [0.5, 0.5, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-1 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w = w - step
        w[:2] = np.maximum(w[:2], 0.05)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Names of the columns that feature tables add to a document's own.
_KEY, _FEATURES, _MORE = "__doc_id", "__features", "__more"


def _described(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """``carry`` columns, the id and both views' features of every row, written once."""
    def packed():
        views = both_views()
        return lambda *columns: [[np.asarray(x, np.int32).tobytes() for x in part]
                                 for part in views(*columns)]

    hidden = {c: f"__{c}" for c in ("text", *META)}
    rows = docs.select(*carry, F.col("doc_id").cast("long").alias(_KEY),
                       *[F.col(c).alias(h) for c, h in hidden.items()])
    return written(extended(rows, [*hidden.values()], {_FEATURES: "binary", _MORE: "binary"}, packed),
                   "described")


def _table(described: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, features, more, label, draw of every document with an id, written.

    Of several labels of one document the largest counts; a doc_id with several rows counts once.
    """
    rows = described.select(F.col(_KEY).alias("doc_id"), F.col(_FEATURES).alias("features"),
                            F.col(_MORE).alias("more")).filter("doc_id is not null")
    once = rows.groupBy("doc_id").agg(F.min(F.struct("features", "more")).alias("x"))
    known = labels.filter("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(_DRAWS)).cast("int")
    return written(once.join(known, "doc_id", "left").select(
        "doc_id", "x.*", "label", draw.alias("draw")), "features")


def fit(described: DataFrame, labels: DataFrame) -> tuple[list[View], np.ndarray]:
    table = _table(described, labels)
    try:
        return _fit(table)
    finally:
        discard(table)


def _fit(table: DataFrame) -> tuple[list[View], np.ndarray]:
    parts = [table.filter(F.col("label") == value).select("doc_id").orderBy(
        F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(most)
        for value, most in ((1, MAX_GOOD), (0, MAX_BAD))]
    got = table.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select(
        "doc_id", "label", "features", "more").orderBy("doc_id").toPandas()
    features, more = ([np.frombuffer(x, np.int32) for x in got[c]] for c in ("features", "more"))
    y = got["label"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        always = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))) if len(y) else 0.0
        views = [View([], np.empty(0)) for _ in range(2)]
        return views, np.array([0.0, 0.0, always])
    views, mix = co_train_table((features, more), y, table.filter("label is null").select(
        "features", "more", "draw"))
    # the classes were sampled at different rates
    counts = {r["label"]: r["n"] for r in table.groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    mix = mix + [0.0, 0.0, np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))]
    return views, mix


def score(docs: DataFrame, labels: DataFrame, carry: Sequence[str] = ("doc_id",),
          threshold: float = THRESHOLD) -> DataFrame:
    """``carry`` columns, content_score, metadata_score, score and kept of every row.

    Scores are between 0 and 1, higher for better documents; ``kept`` is score >= threshold.
    Null texts count as empty, null metadata is a value of its own. Rows without a doc_id
    are scored but teach nothing; repeated rows score alike. With labels of one class or
    none, every row gets the observed rate (one half without labels). An empty table gives
    an empty result. Columns other than carry, text, source, lang and n_chars are not read.
    """
    described = _described(docs, carry)
    views, mix = fit(described, labels)
    used = np.flatnonzero((np.abs(views[0].weights) > 1e-5) | (np.abs(views[1].weights) > 1e-5))
    model = docs.sparkSession.sparkContext.broadcast((
        used.astype(np.int32), [v.weights[used] for v in views], [v.bias for v in views],
        [v.scale for v in views], mix))
    columns = {"content_score": "double", "metadata_score": "double", "score": "double"}
    schema = StructType([described.schema[c] for c in carry] + [
        StructField(c, DoubleType()) for c in columns])

    def work(batches):
        at, values, bias, scales, both = model.value
        weights = [np.zeros(SPACE), np.zeros(SPACE)]
        for w, v in zip(weights, values, strict=True):
            w[at] = v
        for batch in batches:
            z = [a * (Rows.packed(batch.column(c)).logits(w) + b) + shift for c, w, b, (a, shift)
                 in zip((_FEATURES, _MORE), weights, bias, scales, strict=True)]
            mixed = sum(m * np.clip(x, -12, 12) for m, x in zip(both, z)) + both[2]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carry] + [pa.array(sigmoid(x)) for x in (*z, mixed)],
                [*carry, *columns])

    return described.drop(_KEY).mapInArrow(work, schema).withColumn("kept", F.col("score") >= threshold)


by_value(__name__)
