"""Length buckets that minimise padding, and token-budget batches inside them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import hash_chunk, numbered, word_count, written

BUCKETS = 16
#: Padded tokens of a batch; a longer document is a batch of its own.
BUDGET = 65_536
#: Histogram bins per doubling of the length. Lengths up to this many have bins of their own.
PER_OCTAVE = 256


def length_bin(length: Column) -> Column:
    """Upper end of a length's bin: exact for short lengths, within 1/256 for others.

    The number of bins is bounded by 256 per doubling, whatever the corpus.
    """
    octave = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double")) + F.lit(1e-12))
    width = F.pow(F.lit(2.0), F.greatest(octave - 8, F.lit(0))).cast("long")
    return F.when(length <= PER_OCTAVE, F.greatest(length, F.lit(0))).otherwise(
        F.ceil(length / width) * width).cast("long")


def optimal_boundaries(tops: np.ndarray, counts: np.ndarray, tokens: np.ndarray,
                       buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding.

    ``tops`` ascend; a bucket pads every document to its longest. Dynamic programming over
    the histogram: cost[k][j] is the least padding of the first j bins in k buckets.
    """
    m = len(tops)
    if not m:
        return []
    n = np.concatenate([[0.0], np.cumsum(counts, dtype=float)])
    t = np.concatenate([[0.0], np.cumsum(tokens, dtype=float)])
    buckets = min(buckets, m)
    cost = np.full(m + 1, np.inf)
    cost[0] = 0.0
    back = np.zeros((buckets + 1, m + 1), np.int64)
    best_k, best = 0, np.inf
    for k in range(1, buckets + 1):
        now = np.full(m + 1, np.inf)
        for j in range(1, m + 1):
            pad = cost[:j] + tops[j - 1] * (n[j] - n[:j]) - (t[j] - t[:j])
            i = int(pad.argmin())
            now[j], back[k, j] = pad[i], i
        cost = now
        if cost[m] < best:
            best_k, best = k, cost[m]
    ends, j = [], m
    for k in range(best_k, 0, -1):
        ends.append(int(tops[j - 1]))
        j = int(back[k, j])
    return ends[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET,
         length: Column | None = None) -> DataFrame:
    """``docs`` with n_tokens, bucket, padded_to, batch, slot: every row in exactly one batch.

    ``length`` is a row's token count, by default its words. Rows of one batch share a
    bucket and are padded to its boundary (the longest length there); a batch has as many
    rows as fit the budget, at least one. Batches are numbered from 0 inside a bucket, slots
    from 0 inside a batch, and only a bucket's last batch may have fewer rows. Null and
    empty texts have length 0 and are packed like others; equal rows take slots of their
    own. An empty table gives an empty result. Columns of ``docs`` named like added ones
    are replaced.

    Lengths are taken once and written with the rows, whose stored order tells equal rows
    apart: no number of equal rows meets in one task. The driver gets the histogram of
    lengths (at most 256 bins per doubling).
    """
    length = word_count(F.col("text")) if length is None else length
    added = ("n_tokens", "bucket", "padded_to", "batch", "slot")
    stored = written(docs.withColumn("__n", length).drop(*added).withColumnRenamed(
        "__n", "n_tokens").withColumn("__tie", F.monotonically_increasing_id()), "lengths")
    histogram = (stored.groupBy(length_bin(F.col("n_tokens")).alias("bin"))
                 .agg(F.max("n_tokens").alias("top"), F.count(F.lit(1)).alias("n"),
                      F.sum("n_tokens").alias("tokens")).orderBy("bin").collect())
    total = sum(r["n"] for r in histogram)
    ends = optimal_boundaries(np.array([r["top"] for r in histogram], float),
                              np.array([r["n"] for r in histogram]),
                              np.array([r["tokens"] for r in histogram]), buckets)
    bucket, padded = F.lit(0), F.lit(0)
    for i, end in reversed(list(enumerate(ends))):
        bucket = F.when(F.col("n_tokens") <= end, i).otherwise(bucket)
        padded = F.when(F.col("n_tokens") <= end, end).otherwise(padded)
    out = stored.withColumn("bucket", bucket).withColumn("padded_to", padded.cast("long"))
    out = out.withColumn("__h", F.xxhash64("doc_id", "__tie"))
    out = numbered(out, ["bucket"], ["__h", "__tie"], "__at", hash_chunk(F.col("__h"), total))
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("padded_to", F.lit(1))))
    return (out.withColumn("batch", F.floor(F.col("__at") / per))
            .withColumn("slot", F.col("__at") % per).drop("__h", "__tie", "__at"))
