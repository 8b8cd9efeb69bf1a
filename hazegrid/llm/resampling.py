"""Importance resampling of documents towards a target collection.

Words and word pairs are hashed into a fixed number of buckets. A bucket's gain says how
much commoner it is in the target than in the corpus; a document's weight is the mean gain
of its features, its score adds Gumbel noise that depends on its doc_id alone. The highest
scores are drawn. The cutoff is found by bisection: exact counts of the written scores
below several probes, first over scores, then over doc_ids at the cutoff score, then over
stored row numbers. Only drawn rows are dealt into ranges, where their ranks are taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value, extended, written

BUCKETS = 10_000
#: Probes that one counting job tries at once.
PROBES = 15
#: Drawn rows in one range of ranks, about.
RANGE_ROWS = 200_000
#: Bytes of a text that are split into words at once.
_PIECE = 1 << 20

#: A word byte maps to itself (A-Z to a-z), any other ASCII byte to a space.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A
                    else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """A text's words, in lists from bounded pieces cut between words."""
    text = text.translate(_WORD_BYTES)
    at, n = 0, len(text)
    while at < n:
        end = n
        if n - at > _PIECE:
            end = text.rfind(b" ", at, at + _PIECE)
            if end <= at:
                end = text.find(b" ", at + _PIECE)
                end = n if end < 0 else end
        words = text[at:end].split()
        if words:
            yield words
        at = end + 1


def features(text: bytes | None, buckets: int = BUCKETS) -> tuple[int, list[np.ndarray]]:
    """(words, buckets of all single words and pairs of neighbours) of a UTF-8 text.

    The checksum of "a b" goes on from the one of "a", so pairs are never put together.
    """
    n, found, last = 0, [], None
    for words in word_pieces(text or b""):
        own = list(map(crc32, words))
        n += len(own)
        found.append(np.array(own, np.int64) % buckets)
        if last is not None:
            words, own = [b"", *words], [last, *own]
        pairs = list(map(crc32, words[1:], map(crc32, repeat(b" "), own)))
        found.append(np.array(pairs, np.int64) % buckets)
        last = own[-1]
    return n, found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket: one row per bucket and task is summed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        held, size = [], 0
        for batch in batches:
            for x in batch.column(0):
                for part in features(x.as_py(), buckets)[1]:
                    held.append(part)
                    size += len(part)
                if size > 100_000:
                    total += np.bincount(np.concatenate(held), minlength=buckets)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("binary").alias("text")).filter("text is not null")
    sums = rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of smoothed shares, per bucket."""
    m = len(corpus)
    all_s, all_t = float(corpus.sum() + m), float(target.sum() + m)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Whole thousandths of a Gumbel variate that a doc_id and the seed fix."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def smallest_reaching(rows: DataFrame, column: str, need: int, probes: int = PROBES) -> int:
    """The smallest value v of a whole-number column with ``need`` or more rows <= v.

    Each job counts the rows at or below several probes exactly.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        step = max(1, (high - low) // (probes + 1))
        tries = sorted({min(low + step * (i + 1) - 1, high - 1) for i in range(probes)})
        counts = rows.agg(*[F.count_if(F.col(column) <= F.lit(p)) for p in tries]).first()
        reached = [p for p, c in zip(tries, counts, strict=True) if c >= need]
        missed = [p for p, c in zip(tries, counts, strict=True) if c < need]
        low = max(missed) + 1 if missed else low
        high = min(reached) if reached else high
    return low


def first_rows(rows: DataFrame, keys: list[str], need: int) -> Column:
    """Whether a row is among the first ``need`` in the order of whole-number keys.

    ``need`` lies between 1 and the number of rows, and all keys together are distinct.
    """
    steps = []
    for key in keys:
        v = smallest_reaching(rows, key, need)
        below, equal = rows.agg(F.count_if(F.col(key) < F.lit(v)),
                                F.count_if(F.col(key) == F.lit(v))).first()
        steps.append((key, v))
        need -= below
        if need == equal:
            break
        rows = rows.filter(F.col(key) == F.lit(v))
    key, v = steps.pop()
    inside = F.col(key) <= F.lit(v)
    for key, v in reversed(steps):
        inside = (F.col(key) < F.lit(v)) | ((F.col(key) == F.lit(v)) & inside)
    return inside


def ranked(rows: DataFrame, keys: list[str], n: int, rank: str) -> DataFrame:
    """Number ``n`` rows from 1 in the order of ``keys``, range by range.

    The counts of earlier ranges are one row per ``RANGE_ROWS`` rows.
    """
    ranges = max(1, -(-n // RANGE_ROWS))
    dealt = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    dealt = written(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("__at", 33)
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    return (dealt.withColumn("__part", part).join(starts, "__part")
            .withColumn(rank, F.col("__ahead") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("__part", "__ahead", "__at"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20,
             seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank) of every row of ``docs``.

    Of the rows with ``least_words`` or more words, ``percent`` of a hundred (rounded down)
    are drawn; ``rank`` counts them from 1 by falling score, then rising doc_id (null last), then
    stored row; it is null for rows not drawn. Null and empty texts have no features and
    weight 0. Repeated rows take part one by one. An empty target leaves all shares to the
    smoothing; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(
        gains(bucket_counts(docs, buckets), bucket_counts(target, buckets)))

    def make():
        def weigh(texts: list) -> tuple:
            counts, words, weights = [], [], []
            for text in texts:
                n, found = features(text, buckets)
                size = sum(map(len, found))
                total = sum(int(gain.value[f].sum()) for f in found)
                counts.append(size)
                words.append(n)
                weights.append(total // size if size else 0)
            return counts, words, weights

        return weigh

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"))
    scored = extended(rows, ["text"], {"n_features": "long", "n_words": "long", "weight": "long"},
                      make)
    scored = written(scored.withColumns({
        "score": F.col("weight") + noise(F.col("doc_id"), seed),
        "row": F.monotonically_increasing_id()}), "scores")
    columns = ["doc_id", "n_features", "n_words", "weight", "score"]
    fit = F.col("n_words") >= least_words
    need = scored.filter(fit).count() * percent // 100
    undrawn = F.lit(None).cast("long").alias("rank")
    if not need:
        return scored.select(*columns, undrawn)
    keys = ["__down", "__id", "row"]
    keyed = scored.withColumns({
        "__down": -F.col("score"),
        "__id": F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))})
    chosen = fit & first_rows(keyed.filter(fit), keys, need)
    drawn = ranked(keyed.filter(chosen), keys, need, "rank")
    return drawn.select(*columns, "rank").unionByName(
        keyed.filter(~chosen).select(*columns, undrawn))


by_value(__name__)


def oracle(buckets: int = BUCKETS, percent: int = 25, least_words: int = 20, seed: int = 7) -> str:
    """The same rows in SQL, with the checksum computed byte by byte."""
    return f"""
    with crc as (select list_transform(range(256), lambda n: list_reduce(
            [n] || range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) as t),
    texts as (select 0 as side, row_number() over () as r, doc_id, coalesce(text, '') as text
              from documents
              union all select 1, row_number() over (), null, coalesce(text, '') from benchmark),
    cut as (select side, r, doc_id, regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from texts),
    runs as (select side, r, unnest(w || list_transform(range(1, len(w)),
                lambda i: w[i] || ' ' || w[i + 1])) as f from cut),
    sums as (select side, r, f, count(*) as n from runs group by all),
    hashed as (select f, xor(list_reduce([4294967295] || list_transform(
                   regexp_extract_all(hex(encode(f)), '..'), lambda x: ('0x' || x)::bigint),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)
               % {buckets} as bucket from (select distinct f from sums), crc),
    shares as (select bucket, sum(n) filter (side = 0) as s, sum(n) filter (side = 1) as t
               from sums join hashed using (f) group by bucket),
    whole as (select coalesce(sum(s), 0) as s, coalesce(sum(t), 0) as t from shares),
    gain as (select bucket, floor(1000 * ln((coalesce(a.t, 0) + 1)::double * (w.s + {buckets})::double
                 / ((coalesce(a.s, 0) + 1)::double * (w.t + {buckets})::double)))::bigint as g
             from shares a, whole w),
    weights as (select r, sum(n)::bigint as n_features, floor(sum(n * g) / sum(n))::bigint as weight
                from sums join hashed using (f) join gain using (bucket) where side = 0 group by r),
    scored as (select c.doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features,
                  coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((
                    ('0x' || substr(sha256('{seed}:' || coalesce(c.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
                    / 4294967296::double)))::bigint as score
               from cut c left join weights using (r) where side = 0),
    placed as (select *, row_number() over (partition by n_words >= {least_words}
                   order by score desc, doc_id) as place,
                   count(*) over (partition by n_words >= {least_words}) as n from scored)
    select doc_id, n_features, weight, score,
           case when n_words >= {least_words} and place <= n * {percent} // 100 then place end as rank
    from placed
    """
