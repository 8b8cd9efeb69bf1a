"""Prefix trie against plain Python, with small ranges and short segments."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from hazegrid.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, parent string, n int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def in_order(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    """Rows of the nodes, from whole prefixes."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        gain = (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += children[p] == 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                   leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                  for p, m in members.items())


def found(df):
    return sorted(tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect())


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


def made(seed, convs=60, longest=9, texts=("a", "b c", "", None)):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for k in range(rng.choice([0, 1, 2, 3, longest])):
            rows.append((c, k, rng.choice(["user", None]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("width,range_rows", [(2, 7), (3, 4), (32, 5), (4, 1000)])
def test_matches_plain_python(spark, monkeypatch, width, range_rows):
    monkeypatch.setattr(trie, "RANGE_ROWS", range_rows)
    rows = made(width) + [(c, 0, "user", "a") for c in range(100, 130)] + [
        (c, k, "user", "b c") for c in range(200, 212) for k in range(7)]
    convs = in_order(rows)
    df = table(spark, rows)
    assert found(trie.prefix_trie(df, width=width)) == brute(convs)
    assert found(trie.prefix_trie(df, trie.rebuilt, width)) == brute(rebuild(convs))


def test_whole_table_matches_plain_python(spark, data, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_ROWS", 40)
    df = spark.read.parquet(f"{data}/conversations.parquet")
    convs = in_order([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])
    assert found(trie.prefix_trie(df, trie.rebuilt)) == brute(rebuild(convs))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_ROWS", 6)
    rows = [(None, 0, "user", "lost"), (-21, 1, "u", "x y"), (-20, 1, "u", "p"), (-20, 2, "u", "q"),
            (40, None, "u", "first"), (40, 1, "u", "second"), (40, 1, "u", "second"),
            (41, 0, None, None), (41, 1, "", ""), (47, 0, "u", "long " * 20000), (63, 0, "u", "t")]
    # one conversation holds a third of all rows, its turn numbers repeat
    rows += [(60, i % 3, "u", f"w{i % 2}") for i in range(40)]
    rows += [(c, 0, "u", "same") for c in range(500, 540)]
    convs = in_order(rows)
    for width in (4, 32):
        assert found(trie.prefix_trie(table(spark, rows), width=width)) == brute(convs)
        assert found(trie.prefix_trie(table(spark, rows), trie.rebuilt, width)) == brute(
            rebuild(convs))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert found(trie.prefix_trie(none)) == []
    assert found(trie.prefix_trie(none, trie.rebuilt)) == []


def test_no_range_holds_a_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_ROWS", 50)
    rows = [(1, i % 2, "u", f"t{i}") for i in range(1000)] + [(2, 0, "u", "a")] * 10
    numbered = trie.numbered_turns(table(spark, rows))
    sizes = [r["count"] for r in numbered.groupBy("part").count().collect()]
    assert max(sizes) <= 150 and sum(sizes) == 1010
    segs = trie.segments(*trie.plain(numbered), width=4)
    assert segs.count() == 253 and segs.selectExpr("max(size(words)) as x").first()["x"] == 4
