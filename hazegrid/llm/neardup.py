"""Near-duplicate documents by b-bit MinHash, confirmed on whole shingle sets.

1. Every document becomes its shingle-set hash, the keys of its bands of minima and the
   low bits of its minima, packed. Equal sets collapse to one node.
2. In every bucket of a band, each node is a candidate partner of the smallest node. Pairs
   whose packed bits put them far below the threshold are dropped, the others are confirmed
   on whole sets, and confirmed links are joined into components.
3. Buckets whose nodes are still in several components are searched further, in blocks of
   bounded size that hold whole sets: every pair across components is estimated in the
   first band it shares and, if near, compared; a link joins two components, and pairs
   that have become one component are not looked at again. A block puts out links that
   join components, never its pairs.

No candidate is capped or sampled; a link is missed only if no band agrees (1e-7 at the
threshold) or the estimate is off by MARGIN.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value, components, discard, extended, sieved, written

#: Minima per band and bands. A pair at similarity 0.8 shares no band with probability
#: (1 - 0.8 ** 5) ** 40 = 1e-7.
ROWS, BANDS = 5, 40
MINIMA = ROWS * BANDS
#: Low bits kept of each minimum, and how many fit into one packed word.
BITS = 4
LANES = 64 // BITS
#: The estimate's standard deviation at similarity s is sqrt(s (1 - s) / MINIMA) / (1 - 2 ** -BITS),
#: 0.03 at 0.8; candidates are dropped only this far below the threshold (6 deviations).
MARGIN = 0.18
SEED = 20210401
_CACHED_WORDS, _LONG_WORD = 1 << 19, 64

_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words, remembered up to a bound of words and of their length."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= _LONG_WORD and len(self) < _CACHED_WORDS:
            self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str | None, size: int, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's word shingles.

    A-Z are lower-cased; a text of fewer words than ``size`` is one shingle, one without
    words has none.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out = _mixed(out * _ODD + h[j:j + n])
    return np.unique(out)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)
    return a[:, None], b[:, None]


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of each of the MINIMA hash functions over a non-empty set."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(h), 512):
        np.minimum(low, (a * h[None, i:i + 512] + b).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = _mixed(key * _ODD + row)
    return key.view(np.int64)


def packed_bits(low: np.ndarray) -> np.ndarray:
    """BITS low bits of each (scrambled) minimum, LANES to a 64-bit word."""
    x = _mixed(low.astype(np.uint64) * _ODD) >> np.uint64(17)
    x &= np.uint64((1 << BITS) - 1)
    x = np.pad(x, (0, -len(x) % LANES)).reshape(-1, LANES)
    shift = np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(x << shift, axis=1).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_hi, set_lo, bands, packed) of every document.

    The set columns are a 128-bit hash of the whole set; all but n_shingles are null for
    a document without words.
    """
    def make():
        words, (a, b) = _Words(), _multipliers()

        def sign(texts: list) -> tuple:
            rows = []
            for text in texts:
                s = shingle_hashes(text, size, words)
                if not len(s):
                    rows.append((0, None, None, None, None))
                    continue
                hi, lo = _set_hash(s)
                low = minima(s, a, b)
                rows.append((len(s), hi, lo, band_keys(low), packed_bits(low)))
            return tuple(zip(*rows, strict=True))

        return sign

    return extended(_texts(docs), ["text"], {
        "n_shingles": "long", "set_hi": "long", "set_lo": "long", "bands": "array<long>",
        "packed": "array<long>"}, make)


def _texts(docs: DataFrame, keep=()) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)


def shingle_sets(docs: DataFrame, size: int, keep=()) -> DataFrame:
    """(doc_id, shingles, set_hi, set_lo) of documents that have words, and columns to ``keep``."""
    def make():
        words = _Words()

        def sets(texts: list) -> tuple:
            found = [shingle_hashes(t, size, words) for t in texts]
            hashes = [_set_hash(x) for x in found]
            return [x.view(np.int64) for x in found], *zip(*hashes, strict=True)

        return sets

    return extended(_texts(docs, keep), ["text"], {
        "shingles": "array<long>", "set_hi": "long", "set_lo": "long"}, make).filter(
        F.size("shingles") > 0)


def _set_hash(shingles: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64).tolist())


def estimated_similarity(a: Column, b: Column) -> Column:
    """Similarity from packed signatures: equal lanes, less those equal by chance."""
    ones = sum(1 << (BITS * i) for i in range(LANES))
    mask = F.lit(ones - (1 << 64) if ones >= 1 << 63 else ones)

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        folded = d
        for i in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(d, i))
        return F.bit_count(folded.bitwiseAND(mask))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    return ((1 - differing / F.lit(float(MINIMA))) - chance) / (1 - chance)


#: Pairs of one pivot that one task confirms, about.
PIVOT_PAIRS = 1000


def _roles(pairs: DataFrame) -> DataFrame:
    """(node, pivots, copies): what a node's set is needed for, from pairs (a, b).

    ``pivots`` are the right sides it is compared with, as (b, salt); ``copies`` is how often
    it is needed as a right side itself. A pivot may stand on the right of many pairs: its set is
    copied once per ``PIVOT_PAIRS`` of them, so that no task confirms them all.
    """
    pairs = pairs.select("a", "b").distinct()
    copies = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PIVOT_PAIRS).alias("copies"))
    salt = F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).alias("salt")
    lefts = pairs.join(copies.filter("copies > 1"), "b", "left").groupBy(F.col("a").alias("node")).agg(
        F.collect_list(F.struct("b", salt)).alias("pivots"))
    return lefts.join(copies.withColumnRenamed("b", "node"), "node", "full")


def _confirmed(sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets overlap enough; ``sets`` carry their roles.

    A set is shuffled once for every role it has, and not at all without one.
    """
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s1"), F.inline("pivots"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s2"), F.explode(
        F.when(F.col("copies").isNotNull(), F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
        ).alias("salt"))
    both = F.size(F.array_intersect("s1", "s2"))
    return (left.join(right, ["b", "salt"])
            .select("a", "b", both.alias("both"), (F.size("s1") + F.size("s2")).alias("sizes"))
            .filter(F.lit(100) * F.col("both") >= F.lit(percent) * (F.col("sizes") - F.col("both")))
            .select("a", "b"))


def _sorted_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups out of batches that are sorted by ``keys``; groups must be bounded."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        k = frame[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        ends = [*cuts.tolist(), len(frame)]
        start = 0
        for end in ends:
            piece = frame.iloc[start:end]
            if rest and (rest[-1][keys].iloc[-1].to_numpy() != k[start]).any():
                yield pd.concat(rest)
                rest = []
            rest.append(piece)
            start = end
            if end != len(frame):
                yield pd.concat(rest)
                rest = []
    if rest:
        yield pd.concat(rest)


class _Groups:
    """Components inside one block, joined as links are found."""

    def __init__(self, components: np.ndarray):
        self.of = np.unique(components, return_inverse=True)[1]

    def join(self, x: int, y: int) -> None:
        self.of[self.of == self.of[y]] = self.of[x]


#: Bits of the hashes that blocks compare sets by.
SHORT = 32
#: Equal short hashes of different shingles that a comparison allows for, and how many times
#: the number to be expected.
SLACK, EXPECTED = 2, 8
#: Sets compared in one go.
_AT_ONCE = 128


def _across(group: pd.DataFrame, floor: float, percent: int) -> list[tuple]:
    """Links of one block (or between two blocks of a bucket) that join components.

    Sets are compared by short hashes, so a pair so close to the threshold that chance hits
    could decide it is put out without joining anything here; the caller confirms. Shingles
    of one set with equal short hashes are known by number, so no pair is lost to them.
    """
    node, size = group["node"].to_numpy(), group["n_shingles"].to_numpy()
    side = group["block"].to_numpy()
    bits = np.stack(group["packed"].to_numpy()).view(np.uint64)
    keys = np.stack(group["bands"].to_numpy())
    sets = [np.frombuffer(x, np.uint32) for x in group["short"]]
    merged = size - np.array([len(x) for x in sets])
    band, two = group["band"].iloc[0], group["i"].iloc[0] != group["j"].iloc[0]
    groups = _Groups(group["component"].to_numpy())
    common = np.bincount(groups.of).argmax()
    common_node = np.flatnonzero(groups.of == common)[0]
    ones = np.uint64(sum(1 << (BITS * i) for i in range(LANES)))
    order, out, chance = np.arange(len(node)), [], 2.0 ** -BITS
    for x in np.flatnonzero(groups.of != common):
        if groups.of[x] == groups.of[common_node]:
            # the larger side is compared from the other members' turns
            continue
        ok = (groups.of != groups.of[x]) & (100 * np.minimum(size, size[x])
                                            >= percent * np.maximum(size, size[x]))
        if two:
            ok &= side != side[x]
        at = order[ok]
        d = bits[at] ^ bits[x]
        d |= d >> np.uint64(1)
        d |= d >> np.uint64(2)
        est = (1 - np.bitwise_count(d & ones).sum(axis=1) / MINIMA - chance) / (1 - chance)
        near = est >= floor
        at, est = at[near], est[near]
        first = (keys[at] == keys[x]).argmax(axis=1) == band
        at = at[first][np.argsort(-est[first], kind="stable")]
        while len(at):
            some, at = at[:_AT_ONCE], at[_AT_ONCE:]
            parts = [sets[y] for y in some]
            every = np.concatenate(parts)
            hit = sets[x][np.minimum(np.searchsorted(sets[x], every), len(sets[x]) - 1)] == every
            both = np.add.reduceat(hit, np.cumsum([0] + [len(q) for q in parts[:-1]]), dtype=np.int64)
            sizes = size[some] + size[x]
            most = both + np.minimum(merged[some], merged[x])
            least = both - SLACK - np.ceil(EXPECTED * size[some] * float(size[x]) / 2.0 ** SHORT)
            linked = 100 * most >= percent * (sizes - most)
            sure = 100 * least >= percent * (sizes - least)
            for y in some[linked & ~sure]:
                out.append((node[x], node[y]))
            for y in some[sure]:
                if groups.of[x] != groups.of[y]:
                    out.append((node[x], node[y]))
                    groups.join(x, y)
            at = at[groups.of[at] != groups.of[x]]
    return out


#: Most nodes of a bucket in one block, about.
BLOCK = 1000


def _open_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, comps: DataFrame,
                percent: int) -> DataFrame:
    """Candidate links (a, b) that join components inside buckets that hold several."""
    placed = members.join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    still = placed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("component").alias("lo"),
                                      F.max("component").alias("hi"))
    # in a bucket of two the pair has been tested
    still = still.filter("lo <> hi and c > 2").select(
        "key", F.ceil(F.col("c") / BLOCK).cast("int").alias("nb"))
    dealt = written(placed.join(still, "key"), "open")
    ids = dealt.select("node")
    drop = np.uint64(64 - SHORT)

    def make():
        def short(rows: list) -> tuple:
            return ([np.unique((np.array(x, np.int64).view(np.uint64) >> drop)
                               .astype(np.uint32)).tobytes() for x in rows],)

        return short

    short = extended(sieved(sets.select("node", "shingles"), "node", ids), ["shingles"],
                     {"short": "binary"}, make)
    each = written(sieved(nodes.select("node", "n_shingles", "bands", "packed"), "node", ids).join(
        short, "node"), "sets")
    block = F.pmod(F.xxhash64("node"), "nb").cast("int")
    dealt = (dealt.withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .join(each, "node")
             .select("key", "i", "j", "block", "band", "node", "component", "n_shingles",
                     "packed", "bands", "short")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    floor = percent / 100 - MARGIN

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _sorted_groups(frames, ["key", "i", "j"]):
            found = _across(group, floor, percent)
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return dealt.mapInPandas(search, "a long, b long")


def _held_sets(docs: DataFrame, held: DataFrame, several: DataFrame | None, size: int) -> DataFrame:
    """(node, shingles) of the nodes in ``held``, each once, and what else ``held`` says of them.

    A document's only text knows its node before its set is made, so the set is not shuffled,
    and texts of documents that no bucket holds with another are sieved out before the join.
    Of documents with ``several`` rows the set's hash finds the node.
    """
    out = ["node", *[c for c in held.columns if c not in ("node", "doc_id", "set_hi", "set_lo")]]
    alone = held if several is None else held.join(several, "doc_id", "left_anti")
    texts = sieved(_texts(docs), "doc_id", held.select("doc_id")).join(
        alone.select("doc_id", *out), "doc_id")
    sets = shingle_sets(texts, size, keep=out).select("node", "shingles", *out[1:])
    if several is None:
        return sets
    rest = held.join(several, "doc_id", "left_semi")
    ids = rest.select("doc_id").distinct()
    whole = shingle_sets(sieved(_texts(docs), "doc_id", ids).join(ids, "doc_id", "left_semi"), size)
    more = whole.join(rest, ["doc_id", "set_hi", "set_lo"]).dropDuplicates(["node"])
    return sets.unionByName(more.select("node", "shingles", *out[1:]))


def duplicate_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    ``docs`` is read several times and must give the same rows each time (stored tables do).
    Null, empty and blank texts have no shingles and stand alone. Rows that share a doc_id
    are one document, linked by any of its texts, and all get its component. A row without a
    doc_id joins no component of its own: it gets that of documents with the same set, else
    null, and is kept in the latter case only. An empty table gives an empty result. Other
    columns are not read.
    """
    sig = written(signatures(docs, size).withColumn("row", F.monotonically_increasing_id()),
                  "signatures")
    known = sig.filter("n_shingles > 0 and doc_id is not null")
    # a node is a distinct set; its number is that of its first row
    classes = written(known.groupBy("set_hi", "set_lo").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("first_doc")), "classes")
    nodes = written(known.join(classes, ["set_hi", "set_lo"]).filter("row = node").select(
        "node", "doc_id", "set_hi", "set_lo", "n_shingles", "bands", "packed"), "nodes")
    slots = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = slots.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("c"))
    members = written(slots.join(shared.filter("c > 1"), "key").select(
        "key", "band", "node", "pivot"), "members")

    floor = F.lit(percent / 100 - MARGIN)
    light = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n1"),
                         F.col("packed").alias("p1"))
    other = light.toDF("b", "n2", "p2")
    pairs = (members.filter("node <> pivot").select(F.col("node").alias("a"),
                                                    F.col("pivot").alias("b")).distinct()
             .join(light, "a").join(other, "b")
             .filter(F.lit(100) * F.least("n1", "n2") >= F.lit(percent) * F.greatest("n1", "n2"))
             .filter(estimated_similarity(F.col("p1"), F.col("p2")) >= floor).select("a", "b"))
    pairs = written(pairs, "pairs")

    # documents with several rows: their texts belong together, and a set may come twice
    several = written(sig.filter("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "several")
    any_several = not several.isEmpty()
    # whole sets of the nodes that any bucket holds with another: later steps need them too
    held = written(nodes.select("node", "doc_id", "set_hi", "set_lo").join(
        members.select("node").distinct(), "node", "left_semi").join(_roles(pairs), "node", "left"), "held")
    sets = written(_held_sets(docs, held, several if any_several else None, size), "sets")
    links = _confirmed(sets, percent)
    if any_several:
        texts = known.select("doc_id", "set_hi", "set_lo").join(several, "doc_id").join(
            classes, ["set_hi", "set_lo"]).select("doc_id", F.col("node").alias("a")).distinct()
        own = texts.join(texts.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").filter(
            "a <> b").select("a", "b").distinct()
        links = links.unionByName(own)
    links = written(links, "links")
    comps = components(links)
    found = written(_open_links(members, nodes, sets, comps, percent).distinct(), "pairs")
    roles = written(_roles(found), "roles")
    again = sieved(sets.select("node", "shingles"), "node", roles.select("node")).join(roles, "node")
    more = written(_confirmed(again, percent), "links")
    if not more.isEmpty():
        comps = components(links.unionByName(more))
    discard(sets, members, nodes, links, more, pairs, found, roles, held)

    placed = classes.join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    first = placed.groupBy("component").agg(F.min("first_doc").alias("found"))
    label = placed.join(first, "component").select("set_hi", "set_lo", "found")
    out = sig.select("doc_id", "n_shingles", "set_hi", "set_lo").join(
        label, ["set_hi", "set_lo"], "left")
    if any_several:
        # a row without words goes with the other rows of its document
        whole = out.join(several, "doc_id").groupBy("doc_id").agg(F.min("found").alias("one"))
        out = out.join(whole, "doc_id", "left").withColumn("found", F.coalesce("found", "one"))
    out = out.withColumn("component_id", F.coalesce("found", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the smallest doc_id.

    Of several rows of a kept doc_id one stays. Rows without a doc_id cannot be told apart
    and all stay, as do documents without words.
    """
    found = duplicate_components(docs.select("doc_id", "text"), size, percent)
    found = written(found.filter("doc_id is not null").groupBy(
        F.col("doc_id").alias("__id")).agg(F.max("kept").alias("kept"),
                                           F.count(F.lit(1)).alias("n")), "kept")
    # most rows are told from those of the left-out documents where they lie; a join decides on the others
    out = found.filter("not kept").select("__id")
    kept = sieved(docs, "doc_id", out, inside=False).unionByName(sieved(docs, "doc_id", out).join(
        out, F.col("doc_id").cast("long") == F.col("__id"), "left_anti"))
    if not found.filter("kept and n > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id is null"))


by_value(__name__)
