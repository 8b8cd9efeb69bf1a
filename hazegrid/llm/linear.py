"""Logistic models over hashed binary features, fitted on rows in memory and in tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value

#: Hashed feature space: a model is this many numbers, whatever the corpus.
SPACE = 1 << 20


def feature_id(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) & (SPACE - 1)


#: Feature entries handled at once, which bounds what a pass over the sample needs.
_ENTRIES = 1 << 19


class Rows:
    """Documents as lists of distinct feature numbers, in one array of 32-bit numbers."""

    def __init__(self, rows: Sequence[Sequence[int]]):
        sizes = np.array([len(r) for r in rows], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = np.concatenate([np.asarray(r, np.int32) for r in rows]) if len(rows) \
            else np.empty(0, np.int32)

    @classmethod
    def packed(cls, column: pa.Array) -> Rows:
        """Rows of an Arrow column that holds 32-bit numbers as bytes."""
        out, column = cls([]), column.cast(pa.large_binary())
        _, at, data = column.buffers()
        ends = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
        out.starts = (ends - ends[0]) // 4
        if out.starts[-1]:
            out.ids = np.frombuffer(data, np.int32, int(out.starts[-1]), int(ends[0]))
        return out

    def __len__(self) -> int:
        return len(self.starts) - 1

    def seen(self) -> np.ndarray:
        """How many documents have each feature."""
        out = np.zeros(SPACE, np.int64)
        for _, _, ids, _ in self._blocks():
            out += np.bincount(ids, minlength=SPACE)
        return out

    def renumbered(self, place: np.ndarray) -> Rows:
        """The features that have a place, under its number."""
        out = Rows([])
        ids, n, sizes = np.empty(len(self.ids), np.int32), 0, []
        for _, _, part, starts in self._blocks():
            new = place[part]
            ends = np.concatenate([[0], np.cumsum(new >= 0)])
            sizes.append(np.diff(ends[starts]))
            ids[n:n + ends[-1]] = new[new >= 0]
            n += int(ends[-1])
        out.ids = ids[:n]
        out.starts = np.concatenate([[0], np.cumsum(np.concatenate([[], *sizes]))]).astype(np.int64)
        return out

    def _blocks(self):
        """(first row, last row, ids, starts inside them) of runs of whole documents."""
        i, n = 0, len(self)
        while i < n:
            j = int(np.searchsorted(self.starts, self.starts[i] + _ENTRIES, "right")) - 1
            j = min(max(j, i + 1), n)
            yield i, j, self.ids[self.starts[i]:self.starts[j]], \
                self.starts[i:j + 1] - self.starts[i]
            i = j

    def logits(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self))
        for i, j, ids, starts in self._blocks():
            out[i:j] = np.diff(np.concatenate([[0.0], np.cumsum(weights[ids])])[starts])
        return out

    def back(self, per_row: np.ndarray, space: int) -> np.ndarray:
        out = np.zeros(space)
        for i, j, ids, starts in self._blocks():
            out += np.bincount(ids, np.repeat(per_row[i:j], np.diff(starts)), space)
        return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _lbfgs(loss: Callable, x: np.ndarray, rounds: int, memory: int = 8,
           tolerance: float = 1e-7) -> np.ndarray:
    f, g = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        q, alphas = g.copy(), []
        for s, y, r in reversed(steps):
            a = r * (s @ q)
            alphas.append(a)
            q -= a * y
        if steps:
            s, y, _ = steps[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.abs(g).sum())
        for (s, y, r), a in zip(steps, reversed(alphas), strict=True):
            q += (a - r * (y @ q)) * s
        slope, t = -(g @ q), 1.0
        if slope >= 0:
            break
        while True:
            new = x - t * q
            f2, g2 = loss(new)
            if f2 <= f + 1e-4 * t * slope or t < 1e-8:
                break
            t /= 2
        s, y = new - x, g2 - g
        if s @ y > 1e-12:
            steps = [*steps, (s, y, 1 / (s @ y))][-memory:]
        done = abs(f - f2) <= tolerance * max(1.0, abs(f))
        x, f, g = new, f2, g2
        if done:
            break
    return x


def fit_logistic(rows: Rows, labels: np.ndarray, weights: np.ndarray | None = None,
                 ridge: float = 1.0, min_rows: int = 2,
                 pairs: Sequence[tuple[Sequence[int], Sequence[int], float]] = (),
                 rounds: int = 80) -> tuple[np.ndarray, float]:
    """(weights over the feature space, intercept).

    Features in fewer than ``min_rows`` rows get no weight. ``pairs`` are (features before,
    features after, strength): the squared change of the logit from one to the other is
    added to the loss.
    """
    y = np.asarray(labels, float)
    c = np.ones(len(y)) if weights is None else np.asarray(weights, float)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        return np.zeros(SPACE), float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    seen = rows.seen()
    for before, after, _ in pairs:
        for i in {*before} ^ {*after}:
            seen[i] = max(seen[i], min_rows)
    used = np.flatnonzero(seen >= min_rows)
    place = np.full(SPACE, -1)
    place[used] = np.arange(len(used))
    small = rows.renumbered(place)
    moves = [(place[[i for i in {*a} - {*b}]], place[[i for i in {*b} - {*a}]], s)
             for b, a, s in pairs]
    n = len(used)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:n], x[n]
        z = small.logits(w) + b
        p = sigmoid(z)
        f = float((c * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * (w @ w))
        r = c * (p - y)
        g = np.empty(n + 1)
        g[:n] = small.back(r, n) + ridge * w
        g[n] = r.sum()
        for plus, minus, s in moves:
            d = w[plus].sum() - w[minus].sum()
            f += s / 2 * d * d
            g[plus] += s * d
            g[minus] -= s * d
        return f, g

    rate = np.average(y, weights=c)
    start = np.zeros(n + 1)
    start[n] = np.log(rate / (1 - rate))
    x = _lbfgs(loss, start, rounds)
    out = np.zeros(SPACE)
    out[used] = x[:n]
    return out, float(x[n])


#: Weights and every row's part of a sum over a table are multiples of its reciprocal, so that
#: sums are exact and do not depend on the order of rows and tasks.
GRID = float(1 << 28)


def on_grid(x):
    return np.round(x * GRID) / GRID


def summed(df: DataFrame, size: int, make: Callable) -> np.ndarray:
    """Sums over all rows by key (0 to ``size``); ``make()`` adds a batch's to an array."""

    def work(batches):
        total, add = np.zeros(size), make()
        for batch in batches:
            add(total, batch)
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(np.round(total[keys] * GRID).astype(np.int64))], ["key", "n"])

    got = df.mapInArrow(work, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros(size)
    out[got["key"].to_numpy(np.int64)] = got["n"].to_numpy(float) / GRID
    return out


def fit_tables(models: Sequence[tuple[Rows, np.ndarray, np.ndarray, float]], lessons: DataFrame,
               ridge: float = 1.0, min_rows: int = 2, rounds: int = 60
               ) -> list[tuple[np.ndarray, float]]:
    """Several models (rows, labels, first weights, first intercept) that learn a table as well.

    ``lessons`` has model (its number), label (0 or 1) and features (bytes). Each evaluation of
    the loss sums gradients over the table in one job, for all models at once; rows stay where
    they are. The loss is that of ``fit_logistic`` over rows and lessons together.
    """
    k = len(models)
    slots = k * SPACE

    def split(batch):
        which, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("model", "label"))
        rows = Rows.packed(batch.column("features"))
        return rows, which, label.astype(float), np.repeat(which, np.diff(rows.starts)) * SPACE

    def count():
        def add(total, batch):
            rows, which, label, at = split(batch)
            total[:slots] += np.bincount(rows.ids + at, minlength=slots)
            total[slots:slots + k] += np.bincount(which, minlength=k)
            total[slots + k:] += np.bincount(which, label, k)

        return add

    seen = summed(lessons, slots + 2 * k, count)
    own, x, at, scale = [], [], 0, []
    for m, (rows, y, w, b) in enumerate(models):
        good, all_ = seen[slots + k + m] + y.sum(), seen[slots + m] + len(y)
        if not 0 < good < all_:
            continue  # nothing to tell apart: the model stays as it is
        often = rows.seen() + seen[m * SPACE:(m + 1) * SPACE]
        used = np.flatnonzero(often >= min_rows)
        place = np.full(SPACE, -1)
        place[used] = np.arange(len(used))
        own.append((m, used, at, rows.renumbered(place), y))
        x += [w[used], [b]]
        # steps in units of how sharply the loss bends, so that few evaluations are needed
        scale.append(1 / np.sqrt(ridge + np.append(often[used], all_) / 20))
        at += len(used) + 1
    if not own:
        return [(w, b) for _, _, w, b in models]
    context = lessons.sparkSession.sparkContext

    # places of the features and intercepts in x; those without one share the place after the last
    none = at
    starts = np.full(k, none)
    for m, used, i, _, _ in own:
        starts[m] = i + len(used)
    places = context.broadcast((
        starts, np.concatenate([m * SPACE + used for m, used, _, _, _ in own]),
        np.concatenate([i + np.arange(len(used)) for _, used, i, _, _ in own]).astype(np.int32)))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        told = context.broadcast(np.append(on_grid(x), 0.0))

        def gradients():
            starts, keys, at = places.value
            place = np.full(slots, none, np.int32)
            place[keys] = at

            def add(total, batch):
                rows, which, label, shift = split(batch)
                rows.ids, start = place[rows.ids + shift], starts[which]
                z = rows.logits(told.value) + told.value[start]
                r = on_grid((sigmoid(z) - label) * (start < none))
                total[:-1] += rows.back(r, none + 1) + np.bincount(start, r, none + 1)
                total[-1] += on_grid((np.logaddexp(0, z) - label * z) * (start < none)).sum()

            return add

        sums = summed(lessons, none + 2, gradients)
        told.destroy()
        f, g = float(sums[-1]), sums[:none]
        for _, used, i, rows, y in own:
            n = len(used)
            w = x[i:i + n]
            z = rows.logits(w) + x[i + n]
            r = sigmoid(z) - y
            f += float((np.logaddexp(0, z) - y * z).sum() + ridge / 2 * (w @ w))
            g[i:i + n] += rows.back(r, n) + ridge * w
            g[i + n] += r.sum()
        return f, g

    scale = np.concatenate(scale)

    def scaled(u: np.ndarray) -> tuple[float, np.ndarray]:
        f, g = loss(u * scale)
        return f, g * scale

    x = _lbfgs(scaled, np.concatenate(x) / scale, rounds, tolerance=1e-5) * scale
    places.destroy()
    out = [(w, b) for _, _, w, b in models]
    for m, used, i, _, _ in own:
        w = np.zeros(SPACE)
        w[used] = x[i:i + len(used)]
        out[m] = w, float(x[i + len(used)])
    return out


by_value(__name__)
