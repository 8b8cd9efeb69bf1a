"""Byte-balanced shards by histogram sort: probe counts, refined splitters, one exchange.

Rows have a total order (doc_id, then a row number of the stored scan). Each round counts
the exact bytes below a set of candidate boundaries in one aggregation over keys and sizes
alone; candidates close in on every splitter until it is within tolerance. Only then are
the rows exchanged, once.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import numbered, written

#: Shards may differ from the mean by this share of it, or by one row if that is more.
TOLERANCE = 0.001
#: Candidate boundaries per open splitter and round.
PROBES = 15
#: Rows that one task numbers, and the number of such ranges beyond which they grow instead.
CHUNK_ROWS, MOST_CHUNKS = 20_000, 2_000
_TIES = 63


def _whole(n: int) -> Column:
    """A number of up to 38 digits."""
    return F.lit(str(n)).cast("decimal(38,0)")


def _below(key: Column, probes: list[int]) -> Column:
    """How many of the ascending probes are at most ``key``, by binary search."""
    if not probes:
        return F.lit(0)
    at = F.array(*[_whole(p) for p in probes])
    steps = [1 << i for i in reversed(range(len(probes).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda n, s: F.when(
        F.get(at, n + s - 1) <= key, n + s).otherwise(n))


def _histogram(keyed: DataFrame, probes: list[int]) -> dict[int, tuple[int, int]]:
    """Exact (bytes, rows) below each probe."""
    rows = keyed.groupBy(_below(F.col("__key"), probes).alias("b")).agg(
        F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    inside = {r["b"]: (r["bytes"], r["rows"]) for r in rows}
    out, size, n = {}, 0, 0
    for i, p in enumerate(probes):
        size, n = size + inside.get(i, (0, 0))[0], n + inside.get(i, (0, 0))[1]
        out[p] = (size, n)
    return out


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE
              ) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """Boundaries between shards, and every probe counted on the way.

    ``keyed`` has __key (unique, decimal) and __size. Targets are the multiples of the mean;
    a boundary is settled once the bytes below it are within tolerance of its target, or no
    key lies between the two candidates that enclose the target, and is then the closer one.
    """
    ends = keyed.agg(F.min("__key").alias("lo"), F.max("__key").alias("hi"),
                     F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    if not ends["rows"]:
        return [0] * (shards - 1), {}
    total = ends["bytes"]
    known = {int(ends["lo"]): (0, 0), int(ends["hi"]) + 1: (total, ends["rows"])}
    targets = [total * i / shards for i in range(1, shards)]
    while True:
        at = sorted(known)
        sums = [known[p][0] for p in at]
        probes, chosen = set(), []
        for target in targets:
            i = min(max(bisect_left(sums, target), 1), len(at) - 1)
            lo, hi = at[i - 1], at[i]
            closer = lo if target - sums[i - 1] <= sums[i] - target else hi
            chosen.append(closer)
            settled = abs(known[closer][0] - target) <= tolerance * total / shards / 2
            if settled or known[hi][1] - known[lo][1] <= 1 or hi - lo <= 1:
                continue
            # around the place that even sizes would give, and evenly over the gap
            guess = lo + int((hi - lo) * (target - sums[i - 1]) / max(1, sums[i] - sums[i - 1]))
            gap = hi - lo
            for k in range(1, PROBES + 1):
                probes.add(lo + gap * k // (PROBES + 1))
            for k in range(-3, 4):
                probes.add(guess + gap * k // 400)
        probes = sorted(p for p in probes if p not in known and at[0] < p < at[-1])
        if not probes:
            return chosen, known
        known |= _histogram(keyed, probes)


def fences(keyed: DataFrame, cuts: list[int], known: dict[int, tuple[int, int]]) -> list[int]:
    """Counted boundaries, the cuts among them, with about ``CHUNK_ROWS`` rows between two.

    Gaps with more rows are probed evenly until none is left, so that the ranges tasks
    number are bounded whatever the keys look like. Very large tables get ``MOST_CHUNKS``
    ranges.
    """
    rows = max((n for _, n in known.values()), default=0)
    most = max(CHUNK_ROWS, rows // MOST_CHUNKS)
    while True:
        at = sorted(known)
        probes = set()
        for lo, hi in zip(at, at[1:]):
            n = known[hi][1] - known[lo][1]
            if n > most and hi - lo > 1:
                parts = max(16, 2 * n // most)
                probes.update(lo + (hi - lo) * k // parts for k in range(1, parts))
        probes = sorted(p for p in probes if p not in known)
        if not probes:
            break
        known |= _histogram(keyed, probes)
    out, last = [], 0
    for p, after in zip(at, [*at[1:], None]):
        if p in cuts or after is not None and known[after][1] - last > most:
            out.append(p)
            last = known[p][1]
    return out


def shard(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE, text: str = "text"
          ) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``: ranges of doc_id of near equal bytes.

    Size is the text's UTF-8 bytes plus 1; a null text has none. Shards follow the order of
    doc_id (null first); rows of one doc_id may be split between neighbours, so a doc_id that
    holds many rows unbalances nothing. Slots number a shard's rows without a gap from 0, in
    the same order. An empty table gives an empty result. Columns of ``docs`` named like the
    added ones are replaced.
    """
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1
    high = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), _whole(-(1 << 63)))
    # the row number is taken once, in the stored table, so that all rounds see the same order
    stored = written(docs.drop("size", "shard", "slot").withColumn("__size", size)
                     .withColumn("__tie", F.monotonically_increasing_id()), "rows")
    key = high * _whole(1 << _TIES) + F.col("__tie")
    keyed = stored.withColumn("__key", key.cast("decimal(38,0)"))
    cuts, known = splitters(keyed.select("__key", "__size"), shards, tolerance)

    # ranges inside a shard that tasks can number
    ranges = fences(keyed.select("__key", "__size"), cuts, known)
    out = keyed.withColumn("shard", _below(F.col("__key"), cuts))
    out = numbered(out, ["shard"], ["__key"], "slot", _below(F.col("__key"), ranges))
    return out.withColumnRenamed("__size", "size").withColumn(
        "slot", F.col("slot").cast("long")).drop("__key", "__tie")
