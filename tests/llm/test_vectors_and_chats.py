"""Vector search and conversation collapse against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazegrid.llm import ann, chat, common

V = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k, step):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in ok:
        if q % step == 0:
            scores = sorted(((-float((a * b).sum()), i) for i, b in ok if i != q))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_search_matches_brute_force(spark, data):
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, got = brute(rows, 20, 20), found(ann.nearest(df, F.col("id") % 20 == 0))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    for q in want:
        assert np.allclose([s for _, s in got[q]], sorted((s for _, s in got[q]), reverse=True))


def test_search_in_several_blocks_and_slices(spark, data, monkeypatch):
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    once = found(ann.nearest(df, F.col("id") % 20 == 0, k=5))
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    monkeypatch.setattr(ann, "VECTOR_BLOCK", 60)
    cut = found(ann.nearest(df, F.col("id") % 20 == 0, k=5))
    same = sum(cut[q] == once[q] for q in once)
    assert cut.keys() == once.keys() and same >= 0.95 * len(once)


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None),
            (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [0.0, 0.0]), (7, []), (8, [None, 1.0]),
            (9, [5.0, 5.0, 5.0]), (None, [9.0, 9.0]), (40, [0.0, 0.0]), (10, [-3.0, 0.5])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], V)
    plain = [(i, v) for i, v in rows if v is None or len(v) == 2]
    assert found(ann.nearest(df, F.col("id") % 20 == 0)) == brute(plain, 20, 20)
    assert ann.nearest(df.filter("false"), F.col("id") % 20 == 0).count() == 0
    assert ann.nearest(df.filter("vec_id = 0"), F.col("id") % 20 == 0).count() == 0


def test_error_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 48)) + 0.3
    q, c = rng.standard_normal((40, 48)), x.mean(axis=0)
    turn = ann.rotation(48, 128)
    assert np.allclose(turn @ turn.T, np.eye(48))
    rest = x - c
    norm = np.linalg.norm(rest, axis=1)
    o = rest / norm[:, None] @ turn
    est, bound = ann.estimates(q, c, turn, np.packbits(o > 0, axis=1), norm,
                               np.abs(o).sum(axis=1) / np.sqrt(128), 3.0)
    off = np.abs(est - q @ x.T)
    assert (off <= bound).mean() > 0.99 and off.mean() > 0.01


def test_lists_are_skipped_and_hot_ones_cut(spark, monkeypatch):
    """Few lists can hold a clustered query's neighbours; a list of copies is several groups."""
    rng = np.random.default_rng(4)
    middle = rng.standard_normal((40, 24)) * 6
    x = np.repeat(middle, 50, axis=0) + rng.standard_normal((2000, 24)) * 0.1
    x = np.vstack([x, np.tile(middle[3], (900, 1))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "VECTOR_BLOCK", 100)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], V.replace("float", "double"))
    got, want = found(ann.nearest(df, F.col("id") % 20 == 0, k=5)), brute(rows, 5, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert np.allclose([s for _, s in got[q]], [-s if s < 0 else s for _, s in want[q]], rtol=1e-9)
    centres = ann.centroids(ann.usable(df, "vec_id", "embedding"), len(x), 24)
    of = ann.nearest_centre(x, centres)
    sizes = np.bincount(of, minlength=len(centres))
    reach = np.array([max([np.linalg.norm(x[i] - centres[c]) for i in np.flatnonzero(of == c)], default=0)
                      for c in range(len(centres))])
    lists = ann.Lists(centres, sizes, reach)
    q = x[:2000:20]
    floor = np.array([np.sort(x @ a)[-6] for a in q])
    wanted = lists.above(q, floor)
    best = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :5]
    assert np.take_along_axis(wanted, of[best], axis=1).all() and wanted.mean() < 0.2
    query, group = lists.groups_of(wanted)
    assert len(query) < 0.4 * len(q) * lists.groups and group.max() < lists.groups
    assert sorted(ann.halved(centres, np.arange(len(centres)))) == list(range(len(centres)))
    assert lists.cuts.max() >= 8


C = "conv_id long, turn long, role string, text string, k string"


def collapse(rows):
    talks = {}
    for c, t, r, x in rows:
        talks.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    whole = {c: [x[2:] for x in sorted(ts)] for c, ts in talks.items()}
    out = {}
    for c, ts in whole.items():
        if any(len(o) > len(ts) and o[:len(ts)] == ts for o in whole.values()):
            continue
        same = sorted((d for d, o in whole.items() if o == ts and d is not None))
        if c == (same[0] if same else None):
            out[c] = (len(ts), sum(o == ts for o in whole.values()), "".join(
                f"<|im_start|>{x[1]}\n{x[3]}<|im_end|>\n" for x in ts))
    return out


def rendered(df):
    out = {}
    for r in df.orderBy("conv_id", "part").collect():
        n, same, text = out.get(r["conv_id"], (0, 0, ""))
        out[r["conv_id"]] = (n + r["turns"], r["n_same"], text + r["rendered"])
    return out


def test_collapse_matches_plain_python(spark, data):
    df = spark.read.parquet(f"{data}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert rendered(chat.collapse_and_render(df)) == collapse(rows)


def test_collapse_of_odd_rows(spark, monkeypatch):
    rows = [(1, 0, "u", "a"), (1, 1, "b", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "b", "b"),
            (3, 2, "u", "c"), (4, 0, "u", None), (5, 0, "u", ""), (6, None, "u", "a"), (6, 5, None, "z"),
            (7, 2, "u", "q"), (7, 2, "u", "q"), (8, 9, "u", "q"), (None, 1, "u", "n"), (9, -4, "u", "m"),
            (10, 0, "u", "a"), (10, 1, "b", "b"), (10, 2, "u", "c")]
    rows += [(11, t, "u", f"t{t % 7}") for t in range(40)] + [(12, t, "u", f"t{t % 7}") for t in range(33)]
    df = spark.createDataFrame([(*r, "x") for r in rows], C)
    want = collapse(rows)
    assert rendered(chat.collapse_and_render(df)) == want
    monkeypatch.setattr(chat, "TURNS", 4)
    cut = chat.collapse_and_render(df)
    assert rendered(cut) == want and cut.agg(F.max("turns")).first()[0] <= 4
    assert chat.collapse_and_render(df.filter("false")).count() == 0


def test_hot_conversation_is_cut(spark, monkeypatch):
    """One conversation without turn numbers, one turn number and one row repeated many times."""
    monkeypatch.setattr(chat, "RANGE_ROWS", 50)
    rows = [(1, None, "u", f"t{i:04d}") for i in range(400)] + [(2, 7, "u", "same")] * 400
    rows += [(3, 7, "u", "same")] * 399 + [(None, None, "b", f"x{i}") for i in range(200)]
    df = spark.createDataFrame([(*r, "x") for r in rows], C)
    assert rendered(chat.collapse_and_render(df)) == collapse(rows)
    largest = chat.in_ranges(df).groupBy("part").count().agg(F.max("count")).first()[0]
    assert largest <= 4 * chat.RANGE_ROWS


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 3), (300, 299)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in common.components(df).collect()}
    assert got == {**dict.fromkeys([*range(61), 200], 0), 100: 100, 101: 100, 299: 299, 300: 299}
    assert common.components(df.filter("false")).count() == 0
    star = spark.range(1, 3000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    assert common.components(star).filter("component <> 0").count() == 0
    assert common.components(star).count() == 3000


def test_numbering_in_chunks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"), "id")
    out = common.numbered(df, ["g"], ["h", "id"], "slot", common.hash_chunk(F.col("h"), 1000, 50)).toPandas()
    for _, rows in out.groupby("g"):
        assert rows.sort_values("h")["slot"].tolist() == list(range(len(rows)))
