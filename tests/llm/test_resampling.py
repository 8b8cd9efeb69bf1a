"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hazegrid.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, rank string, score int"


def runs(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = WORD.findall(lower)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(docs, target, percent=25, least=20):
    """(doc_id, n_features, weight, score, rank) rows, repeated rows in any order."""
    s = Counter(bucket(f) for _, t in docs for f in runs(t)[1])
    t = Counter(bucket(f) for x in target for f in runs(x)[1])
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    out = []
    for i, text in docs:
        w, fs = runs(text)
        g = [math.floor(1000 * math.log((t[bucket(f)] + 1) * all_s / ((s[bucket(f)] + 1) * all_t)))
             for f in fs]
        weight = sum(g) // len(g) if g else 0
        key = f"7:{'' if i is None else i}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, len(w)])
    able = sorted((r for r in out if r[5] >= least),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in out]


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()]


def order(xs):
    return sorted(xs, key=lambda x: tuple((v is None, v or 0) for v in x))


def test_whole_tables_match_plain_python(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    target = spark.read.parquet(f"{data}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()],
                 [r["text"] for r in target.collect()])
    got = resampling.resample(docs, target)
    assert order(rows(got)) == order(want)
    assert {t for _, t in got.select("doc_id", "rank").dtypes} == {"bigint"}


def test_odd_texts_ties_and_repeated_rows(spark, monkeypatch):
    long = "Éa, b-C 7x_" * 40
    docs = [(i, long) for i in (5, 5, 5, -3, 0)] + [(None, long)] * 6 + [
        (7, None), (8, ""), (9, " .,;"), (10, "one"), (None, None), (11, "ÀB cd " * 5000),
        (12, "x" * 3000 + " y" * 30)]
    target = [(1, "éa b"), (2, None), (3, "")]
    df = spark.createDataFrame([(i, t, "extra", 3) for i, t in docs], DOCS).repartition(3)
    goal = spark.createDataFrame(target, "item_id long, text string")
    monkeypatch.setattr(resampling, "_PIECE", 64)
    monkeypatch.setattr(resampling, "RANGE_ROWS", 3)
    for percent in (25, 50, 100):
        got = rows(resampling.resample(df, goal, percent=percent))
        assert order(got) == order(brute(docs, [t for _, t in target], percent))
        ranks = sorted(r[4] for r in got if r[4])
        assert ranks == list(range(1, len(ranks) + 1))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    one = spark.createDataFrame([(1, "a " * 30, None, None)] * 4, DOCS)
    assert resampling.resample(none, none).count() == 0
    got = rows(resampling.resample(one, none))
    assert order(got) == order(brute([(1, "a " * 30)] * 4, []))
    assert sorted(r[4] or 0 for r in got) == [0, 0, 0, 1]


@pytest.mark.parametrize("need", [1, 2, 7, 40, 99, 100])
def test_cutoff_takes_exactly_the_first_rows(spark, need):
    df = spark.range(100).select((F.col("id") % 3).alias("a"), (-(F.col("id") % 7)).alias("b"),
                                 ((F.col("id") - 50) * (1 << 56)).alias("c"))
    inside = df.filter(resampling.first_rows(df, ["a", "b", "c"], need))
    want = sorted((i % 3, -(i % 7), (i - 50) * (1 << 56)) for i in range(100))[:need]
    assert sorted(map(tuple, inside.collect())) == want
