"""Inner-product search by randomly rotated one-bit codes with error bounds and reranking.

Vectors lie in lists around centroids. A vector x is stored as c + |x - c| o with c its list's
centroid and o a unit vector; o is rotated at random and only its signs are kept, packed, with
two numbers to correct the estimate. A query estimates <q, o> from the bits alone, with a bound
on the error.

A query first searches a few lists near it; its k-th best score there is a floor under its
result. Lists whose best conceivable product, <q, c> + |q| radius, is below the floor are
skipped; in the others only vectors whose upper bound reaches the floor, or the best lower bounds
seen since, are scored. Neighbouring lists make a group, and each vector travels once to its
group's task; a query travels to the groups that hold a list it has to see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value, discard, written

#: Bits of a code; vectors are padded with zeros to this many dimensions before rotation.
BITS = 256
#: Width of the error bound in deviations of the estimate: 3 leaves out 1 vector in 700
#: per side, before the 20 best are compared.
WIDTH = 3.0
SEED = 77
#: Queries that are compared at a time, and vectors of a group, which one task holds.
QUERY_BLOCK, VECTOR_BLOCK = 512, 8_192
#: Most lists, vectors the centroids are fitted on (the first in order of a hash), and rounds.
MOST_LISTS, SAMPLE, ROUNDS = 4_096, 65_536, 8
#: A query's first lists hold this many times the wanted number of vectors.
FIRST_LISTS = 16


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of rows whose vector has finite components only and is not all zero."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()).filter(
        ~bad & F.exists("v", lambda x: x != 0.0))


def rotation(dimensions: int, bits: int) -> np.ndarray:
    """The first ``dimensions`` rows of a random rotation of ``bits`` dimensions."""
    rng = np.random.default_rng(SEED)
    q, r = np.linalg.qr(rng.standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:dimensions]


def centroids(vectors: DataFrame, n: int, d: int) -> np.ndarray:
    """Centres of some sqrt(n) lists, by k-means on at most ``SAMPLE`` vectors.

    Lists are bounded so that all centres together have at most two million numbers. The
    sample decides how well lists are pruned, never which vectors are found.
    """
    lists = int(max(1, min(MOST_LISTS, n ** 0.5, 2 ** 21 // d)))
    sample = vectors.select("id", "v").orderBy(F.xxhash64("id", "v")).limit(min(SAMPLE, 64 * lists))
    x = np.stack([np.array(r["v"]) for r in sample.collect()])
    rng = np.random.default_rng(SEED)
    centres = x[np.sort(rng.choice(len(x), min(lists, len(x)), replace=False))]
    for _ in range(ROUNDS):
        near = nearest_centre(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        held = np.bincount(near, minlength=len(centres))
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i:i + 2048] @ centres.T - half, axis=1)
                           for i in range(0, len(x), 2048)])


def encode(vectors: DataFrame, centres: np.ndarray, bits: int) -> DataFrame:
    """(row, id, v, list, code, norm, fit): packed signs, |x - c| and <signs / sqrt(bits), o>."""

    def codes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(centres.shape[1], bits)
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["v"].to_numpy()).astype(float)
            of = nearest_centre(x, centres)
            rest = x - centres[of]
            norm = np.linalg.norm(rest, axis=1)
            o = (rest / np.where(norm > 0, norm, 1.0)[:, None]) @ turn
            yield pd.DataFrame({
                "row": frame["row"].to_numpy(), "id": frame["id"].to_numpy(), "v": list(x),
                "list": of.astype(np.int32), "code": [r.tobytes() for r in np.packbits(o > 0, axis=1)],
                "norm": norm, "fit": np.abs(o).sum(axis=1) / np.sqrt(bits)})

    return vectors.select(F.monotonically_increasing_id().alias("row"), "id", "v").mapInPandas(
        codes, "row long, id long, v array<double>, list int, code binary, norm double, fit double")


def estimates(queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, codes: np.ndarray,
              norm: np.ndarray, fit: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and their error bounds.

    <q, x> = <q, c> + |x - c| <q, o>, and <q, o> is estimated by <Rq, signs> / sqrt(bits) /
    fit; its deviation is |q| sqrt((1 - fit^2) / fit^2 / (bits - 1)). The bound covers the
    rounding of single precision too, so copies of a centroid are never lost to it.
    """
    bits = turn.shape[1]
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    held = np.maximum(fit, 1e-9)
    raw = (queries @ turn).astype(np.float32) @ signs.T
    scale = (norm / held / np.sqrt(bits)).astype(np.float32)
    est = raw * scale + (queries @ centre).astype(np.float32)[:, None]
    spread = norm * np.sqrt(np.maximum(0.0, 1 - held ** 2) / held ** 2 / (bits - 1))
    bound = np.linalg.norm(queries, axis=1)[:, None] * (
        width * spread + 1e-6 * (norm + np.linalg.norm(centre)))
    return est, bound.astype(np.float32)


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order."""
    return (vectors * query).sum(axis=1)


class Lists:
    """Centroids with the lists' sizes and radii, and the groups that tasks hold.

    Lists in the order of repeated halving along their widest direction fill groups of about
    ``VECTOR_BLOCK`` vectors; a list with more is several groups of its own, by a hash of the row.
    """

    def __init__(self, centres: np.ndarray, sizes: np.ndarray, reach: np.ndarray):
        self.centres, self.sizes, self.reach = centres, sizes, reach
        self.cuts = np.maximum(1, -(-sizes // VECTOR_BLOCK))
        self.group = np.zeros(len(sizes), np.int64)
        self.groups, held = 0, VECTOR_BLOCK
        for i in halved(centres, np.arange(len(centres))):
            if self.cuts[i] > 1 or held + sizes[i] > VECTOR_BLOCK:
                self.group[i], held = self.groups, int(sizes[i])
                self.groups += int(self.cuts[i])
                if self.cuts[i] > 1:
                    held = VECTOR_BLOCK
            else:
                self.group[i] = self.groups - 1
                held += int(sizes[i])

    def first(self, q: np.ndarray, k: int) -> np.ndarray:
        """Lists (queries x lists) of the largest <q, c> that hold ``FIRST_LISTS`` times k vectors."""
        order = np.argsort(-(q @ self.centres.T), axis=1, kind="stable")
        held = self.sizes[order]
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, np.cumsum(held, axis=1) - held < FIRST_LISTS * (k + 1), axis=1)
        return out & (self.sizes > 0)

    def above(self, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Lists (queries x lists) that may hold a product of at least ``floor``."""
        near, length = q @ self.centres.T, np.linalg.norm(q, axis=1)[:, None]
        far = np.linalg.norm(self.centres, axis=1) + self.reach
        best = near + length * (self.reach + 1e-9 * far)
        return (best >= floor[:, None]) & (self.sizes > 0)

    def groups_of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, group) of every group that holds a wanted list."""
        query, of = np.nonzero(wanted)
        n = self.cuts[of]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs = np.unique(np.repeat(query, n) * self.groups + np.repeat(self.group[of], n) + place)
        return pairs // self.groups, pairs % self.groups


def halved(centres: np.ndarray, of: np.ndarray) -> list[int]:
    """Numbers of the centres, ordered by halving along the direction they differ most in."""
    if len(of) <= 2:
        return of.tolist()
    rest = centres[of] - centres[of].mean(axis=0)
    along = rest @ np.linalg.svd(rest, full_matrices=False)[2][0]
    of = of[np.argsort(along, kind="stable")]
    half = len(of) // 2
    return halved(centres, of[:half]) + halved(centres, of[half:])


class _Block:
    """Queries with the best ``k`` vectors found so far; below ``floor`` nothing is wanted."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.best = [(np.empty(0, np.int64), np.empty(0)) for _ in ids]
        self.least = floor.copy()

    def see(self, who, ids, vectors, codes, norm, fit, centre, turn, width) -> None:
        est, bound = estimates(self.vectors[who], centre, turn, codes, norm, fit, width)
        low, high = est - bound, est + bound
        own = ids[None, :] == self.ids[who][:, None]
        low[own] = high[own] = -np.inf
        floor = self.least[who]
        if len(ids) >= self.k:  # k candidates have at least this true product
            at = len(ids) - self.k
            floor = np.maximum(floor, np.partition(low, at, axis=1)[:, at])
        reached = (high >= floor[:, None]) & ~own
        for row in np.flatnonzero(reached.any(axis=1)):
            i, at = who[row], np.flatnonzero(reached[row])
            found = np.concatenate([self.best[i][0], ids[at]])
            score = np.concatenate([self.best[i][1], exact(vectors[at], self.vectors[i])])
            top = np.lexsort((found, -score))[:self.k]
            self.best[i] = found[top], score[top]
            if len(top) == self.k:
                self.least[i] = max(self.least[i], score[top[-1]])

    def rows(self) -> pd.DataFrame:
        n = [len(b[0]) for b in self.best]
        return pd.DataFrame({"query_id": np.repeat(self.ids, n),
                             "vec_id": np.concatenate([b[0] for b in self.best]),
                             "score": np.concatenate([b[1] for b in self.best])})


class _Group:
    """The vectors of a group by list, and a search of its lists for blocks of queries."""

    def __init__(self, frames: list[pd.DataFrame]):
        rows = pd.concat(frames).sort_values(["list", "id"], kind="stable")
        self.v = np.stack(rows["v"].to_numpy())
        self.codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
        self.id, self.norm, self.fit = (rows[c].to_numpy() for c in ("id", "norm", "fit"))
        self.lists, starts = np.unique(rows["list"].to_numpy(int), return_index=True)
        self.spans = list(zip(starts, [*starts[1:], len(rows)]))

    def search(self, part: pd.DataFrame, lists: Lists, turn, width, k, first) -> pd.DataFrame:
        q, floor = np.stack(part["v"].to_numpy()), part["norm"].to_numpy()
        block = _Block(part["id"].to_numpy(), q, floor, k)
        wanted = lists.first(q, k) if first else lists.above(q, floor)
        for of, (a, b) in zip(self.lists, self.spans):
            who = np.flatnonzero(wanted[:, of])
            for i in range(a, b if len(who) else a, 4096):
                at = slice(i, min(b, i + 4096))
                block.see(who, self.id[at], self.v[at], self.codes[at], self.norm[at],
                          self.fit[at], lists.centres[of], turn, width)
        return block.rows()


def searched(index: DataFrame, asked: DataFrame, lists: Lists, bits: int, width: float, k: int,
             first: bool) -> DataFrame:
    """(query_id, vec_id, score): the best ``k`` of every group that a query of (query_id, q, floor) has to see.

    A task holds one group of vectors and streams its queries past it, so a list that holds a
    third of all vectors, or that all queries want, is more tasks or a longer stream, never
    more memory.
    """
    spark, number = index.sparkSession, lists.groups
    # one row per list, MOST_LISTS at most
    of_list = F.broadcast(spark.createDataFrame(
        [(i, int(g), int(c)) for i, (g, c) in enumerate(zip(lists.group, lists.cuts))],
        "list int, first_group long, cuts long"))
    vectors = index.join(of_list, "list").select(
        (F.col("first_group") + F.pmod(F.xxhash64("row"), "cuts")).alias("group"),
        F.lit(0).alias("kind"), "list", "id", "v", "code", "norm", "fit")

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), QUERY_BLOCK):
                part = frame.iloc[i:i + QUERY_BLOCK]
                q, floor = np.stack(part["q"].to_numpy()), part["floor"].to_numpy()
                query, group = lists.groups_of(lists.first(q, k) if first else lists.above(q, floor))
                yield pd.DataFrame({"group": group, "id": part["query_id"].to_numpy()[query],
                                    "v": list(q[query]), "norm": floor[query]})

    # a query's floor travels in the column of a vector's norm
    queries = asked.mapInPandas(choose, "group long, id long, v array<double>, norm double").select(
        "group", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("list"), "id", "v",
        F.lit(None).cast("binary").alias("code"), "norm", F.lit(None).cast("double").alias("fit"))
    dealt = vectors.unionByName(queries).repartition(number, "group").sortWithinPartitions(
        "group", "kind")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, now, parts, held = rotation(lists.centres.shape[1], bits), None, [], None
        for frame in frames:
            for (group, kind), part in frame.groupby(["group", "kind"], sort=True):
                if group != now:
                    now, parts, held = group, [], None
                if kind == 0:
                    parts.append(part)
                    continue
                if parts:
                    held, parts = _Group(parts), []
                for i in range(0, len(part) if held else 0, QUERY_BLOCK):
                    yield held.search(part.iloc[i:i + QUERY_BLOCK], lists, turn, width, k, first)

    return dealt.mapInPandas(search, "query_id long, vec_id long, score double")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """Every query's ``k`` best rows, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id",
            vector: str = "embedding", bits: int = BITS, width: float = WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` largest inner products.

    Queries are the rows of ``vectors`` for which ``is_query`` (an expression on ``id``)
    holds; candidates are all rows but those of the query's own id. Ties go to the smaller
    id; with fewer candidates all are returned. A query id with several rows is asked once,
    with the first vector in array order. Scores are exact; which vectors get one is
    decided by the codes' error bounds. Rows whose id or vector is null, whose vector is
    empty, zero or has null or non-finite components take no part, nor do vectors of
    another length than the most frequent one (the longer on ties). Repeated rows of one id
    are that many candidates for others. No usable vectors give an empty result. Extra columns are not
    read.

    Lists and codes are made once and written. Each search ships every vector once, and a
    query to the groups it has to see; how few they are depends on how the vectors cluster
    (all of them for vectors without any structure).
    """
    all_usable = usable(vectors, key, vector)
    lengths = all_usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = common["d"], common["n"]
    same = all_usable.filter(F.size("v") == d)
    bits = max(bits, -(-d // 8) * 8)
    centres = centroids(same, n, d)
    index = written(encode(same, centres, bits), "codes")
    sizes, reach = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in index.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("reach")).collect():
        sizes[r["list"]], reach[r["list"]] = r["n"], r["reach"]

    lists = Lists(centres, sizes, reach)
    lowest = F.lit(float("-inf"))
    asked = written(index.filter(is_query).groupBy(F.col("id").alias("query_id")).agg(
        F.min("v").alias("q")), "asked")
    near = searched(index, asked.withColumn("floor", lowest), lists, bits, width, k, first=True)
    floors = best_of(near, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    floored = written(asked.join(floors, "query_id", "left").select(
        "query_id", "q", F.coalesce("floor", lowest).alias("floor")), "floors")
    discard(asked)
    found = searched(index, floored, lists, bits, width, k, first=False)
    return best_of(found, k).select("query_id", "rank", "vec_id", "score")


by_value(__name__)
