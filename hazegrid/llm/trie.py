"""Trie of conversation prefixes, with totals of every subtree.

Conversations become rows of turn ids, cut into segments of ``WIDTH`` turns; a segment knows a
fingerprint of all turns ahead of it. Segments are dealt into ranges of (block, fingerprint,
ids, conv_id). In each range numpy pads the ids to a matrix, sorts its rows (lexsort) and
marks where columns change, OR-accumulated from the left: a mark is the first row of a node.
Sums over the rows between marks (reduceat) give every node of every depth.

All totals are sums over member rows: a node is counted at its first row, a leaf at the last row
that ends in it. So ranges need not agree on their borders beforehand: nodes that touch the
first or last row of a range, or the border of two segments, are summed by key afterwards,
with corrections for what two neighbouring ranges both counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value, word_count, written

#: Turns in one segment of a conversation.
WIDTH = 32
#: Rows of one range, about.
RANGE_ROWS = 20_000
#: Conversations that share one beginning, and turns of a beginning, in the rebuilt ones.
FAMILY, HEAD = 20, 4

_LONG = (1 << 63) - 1
_COMPLETE, _EDGE, _FIRST, _LAST, _ENDS = range(5)
_RECORD = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("depth", pa.int64()), ("hi", pa.int64()),
    ("lo", pa.int64()), ("p_hi", pa.int64()), ("p_lo", pa.int64()), ("parent", pa.int64()),
    ("conv_id", pa.int64()), ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()),
    ("saved", pa.int64()), ("sub_words", pa.int64()), ("sub_leaves", pa.int64()),
    ("sub_conv", pa.int64()), ("ends", pa.large_string()), ("ids", pa.list_(pa.int64())),
    ("words", pa.list_(pa.int64())), ("continues", pa.bool_()), ("nx_hi", pa.int64()),
    ("nx_lo", pa.int64())])
_RECORD_DDL = ("kind int, part int, depth long, hi long, lo long, p_hi long, p_lo long, parent long, "
               "conv_id long, n long, children long, leaves long, saved long, sub_words long, "
               "sub_leaves long, sub_conv long, ends string, ids array<long>, words array<long>, "
               "continues boolean, nx_hi long, nx_lo long")
_SUMS = ["n", "children", "leaves", "saved"]


def _ranges(rows: int) -> int:
    return max(1, -(-rows // RANGE_ROWS))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, at, hi, lo, words): turns in order, numbered from 1 in each range.

    The order is (conv_id, turn, role, text), null turns first, so a conversation's rows may lie
    in several ranges and none holds more than its share. ``hi`` and ``lo`` are a turn's id, 126
    bits of (role, text).
    """
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange(_ranges(rows.count()), *order).sortWithinPartitions(*order)
    dealt = dealt.select(
        "conv_id", F.spark_partition_id().alias("part"),
        F.xxhash64("role", "text").bitwiseAND(F.lit(_LONG)).alias("hi"),
        F.xxhash64(F.lit(1), "text", "role").bitwiseAND(F.lit(_LONG)).alias("lo"),
        word_count(F.col("text")).alias("words"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            if not len(conv):
                continue
            at = np.arange(len(conv))
            new = np.r_[last is None or conv[0] != last, conv[1:] != conv[:-1]]
            at = at - np.maximum.accumulate(np.where(new, at, -n)) + 1
            last, n = conv[-1], int(at[-1])
            yield batch.append_column("at", pa.array(at))

    return written(dealt.mapInArrow(
        number, "conv_id long, part int, hi long, lo long, words long, at long"), "turns")


def _parts(numbered: DataFrame) -> DataFrame:
    """(conv_id, part, ahead, n): turns ahead of a range and in the whole conversation."""
    whole = Window.partitionBy("conv_id")
    ahead = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("m")).select(
        "conv_id", "part", F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("ahead"),
        F.sum("m").over(whole).alias("n"))


def plain(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: turns (conv_id, k, hi, lo, words) and (conv_id, n)."""
    parts = _parts(numbered)
    items = numbered.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("ahead") + F.col("at")).alias("k"), "hi", "lo", "words")
    return items, parts.filter("ahead = 0").select("conv_id", "n")


def rebuilt(numbered: DataFrame, family: int = FAMILY, head: int = HEAD
            ) -> tuple[DataFrame, DataFrame]:
    """Conversations whose beginnings come from the first one of their family.

    Conversation c takes the first h turns of conversation c - c % family (as many as there
    are), h being the checksum of its number modulo ``head``, then its own after its first h.
    """
    parts = _parts(numbered)
    c = F.col("conv_id")
    first = numbered.filter((c % family == 0) & (F.col("at") < head)).join(
        parts, ["conv_id", "part"]).withColumn("k", F.col("ahead") + F.col("at"))
    first = first.filter(F.col("k") < head).groupBy(c.alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("k", "hi", "lo", "words"))).alias("turns"))
    h = F.crc32(c.cast("string").cast("binary")) % head
    parts = parts.withColumns({"h": h, "base": c - c % family}).join(first, "base", "left")
    # the family's first conversation may be absent
    parts = written(parts.withColumn("taken", F.when(F.col("turns").isNull(), F.lit(0)).otherwise(
        F.least("h", F.size("turns")))), "beginnings")
    own = numbered.join(parts.drop("turns"), ["conv_id", "part"]).withColumn(
        "k", F.col("ahead") + F.col("at")).filter("k > h")
    own = own.select("conv_id", (F.col("taken") + F.col("k") - F.col("h")).alias("k"),
                     "hi", "lo", "words")
    each = parts.filter("ahead = 0")
    taken = each.filter("taken > 0").select(
        "conv_id", F.explode(F.slice("turns", 1, F.col("taken").cast("int"))).alias("t"))
    items = own.unionByName(taken.select("conv_id", "t.k", "t.hi", "t.lo", "t.words"))
    return items, each.select("conv_id", (F.col("taken") + F.greatest(
        F.col("n") - F.col("h"), F.lit(0))).alias("n"))


def segments(items: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Conversations cut into segments of ``width`` turns, with all that later steps need.

    ``hi`` and ``lo`` fingerprint the turns ahead of a segment, ``nx_hi`` and ``nx_lo`` the
    turns up to its end; ``after`` counts words of later segments. Only conversations of ``width``
    or more turns pass through the window; it sums row by row.
    """
    cut = items.groupBy("conv_id", F.floor((F.col("k") - 1) / width).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("k", "hi", "lo", "words"))).alias("x"))
    cut = cut.select("conv_id", "block",
                     F.flatten(F.transform("x", lambda t: F.array(t["hi"], t["lo"]))).alias("ids"),
                     F.transform("x", lambda t: t["words"]).alias("words"))
    none = F.array().cast("array<long>")
    cut = cut.unionByName(convs.filter("n = 0").select(
        "conv_id", F.lit(0).cast("long").alias("block"), none.alias("ids"), none.alias("words")))
    short = (F.col("block") == 0) & (F.size("words") < width)
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    small = cut.filter(short).select("*", zero.alias("hi"), zero.alias("lo"), null.alias("nx_hi"),
                                     null.alias("nx_lo"), zero.alias("after"),
                                     F.lit(False).alias("continues"))
    conv = Window.partitionBy("conv_id").orderBy("block")
    before = conv.rowsBetween(Window.unboundedPreceding, -1)
    upto = conv.rowsBetween(Window.unboundedPreceding, 0)
    later = conv.rowsBetween(1, Window.unboundedFollowing)
    marks = {"hi": F.xxhash64("block", "ids"), "lo": F.xxhash64(F.lit(1), "ids", "block")}
    total = F.aggregate("words", zero, lambda a, x: a + x)
    long = cut.filter(~short).withColumns({f"d_{k}": v for k, v in marks.items()} | {"w": total})
    long = long.select(
        "conv_id", "block", "ids", "words",
        *[F.coalesce(F.bit_xor(f"d_{k}").over(before), zero).alias(k) for k in marks],
        *[F.bit_xor(f"d_{k}").over(upto).alias(f"nx_{k}") for k in marks],
        F.coalesce(F.sum("w").over(later), zero).alias("after"),
        F.lead("block").over(conv).isNotNull().alias("continues"))
    # a turn id of zeros stands for "goes on", so that an ending sorts ahead of it
    goes_on = F.array(zero, zero)
    out = small.unionByName(long).withColumn("ids", F.when(
        F.col("continues"), F.concat("ids", goes_on)).otherwise(F.col("ids")))
    return written(out, "segments")


def _key(hi: int, lo: int, ids: np.ndarray) -> tuple[int, int]:
    made = hashlib.blake2b(np.r_[np.array([hi, lo], np.int64), ids.astype(np.int64)].tobytes(),
                           digest_size=16).digest()
    return tuple(np.frombuffer(made, np.int64).tolist())


def node_key(width: int, block: int, column: int, here: tuple, following: tuple,
             ids: np.ndarray) -> tuple[int, int, int]:
    """(depth, hi, lo) of the node after ``column`` turns of a segment."""
    depth = block * width + column
    if column == 0:
        return depth, *here
    if column == width:
        return depth, *following
    return depth, *_key(*here, ids[:2 * column])


def _record(**fields) -> dict:
    return {name: None for name in _RECORD.names} | fields


def _matrix(column: pa.ListArray, fill: int, columns: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    out = np.full((len(lengths), columns), fill, np.int64)
    out[np.arange(columns) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def trie_of_range(table: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """Records of all nodes of one range of segments."""
    t = table.combine_chunks()
    part = t["part"][0].as_py()
    col = {c: t[c].chunk(0).to_numpy(zero_copy_only=False) for c in (
        "conv_id", "block", "hi", "lo", "after", "continues", "later_words", "later_leaves")}
    following = {c: t[c].chunk(0).fill_null(0).to_numpy() for c in ("nx_hi", "nx_lo")}
    ids, words = t["ids"].chunk(0), t["words"].chunk(0)
    length = np.diff(words.offsets.to_numpy()).astype(np.int64)
    columns = int(np.diff(ids.offsets.to_numpy()).max()) // 2
    matrix = _matrix(ids, -1, 2 * columns)
    spoken = np.zeros((len(length), columns + 2), np.int64)
    spoken[:, 1:columns + 1] = _matrix(words, 0, columns)

    order = np.lexsort([col["conv_id"], *matrix.T[::-1], col["lo"], col["hi"], col["block"]])
    col = {c: x[order] for c, x in (col | following).items()}
    matrix, spoken, length = matrix[order], spoken[order], length[order]
    conv, n = col["conv_id"], len(order)

    # changed[i, j]: row i is the first of its node at column j
    changed = np.ones((n, columns + 2), bool)
    changed[1:, 0] = np.any([col[c][1:] != col[c][:-1] for c in ("block", "hi", "lo")], axis=0)
    differs = matrix[1:] != matrix[:-1]
    changed[1:, 1:columns + 1] = differs[:, 0::2] | differs[:, 1::2]
    changed[1:, columns + 1] = False
    np.logical_or.accumulate(changed, axis=1, out=changed)
    first = changed & (np.arange(columns + 2) <= length[:, None])
    # words from a column on: of all members, and of nodes at their first rows
    said = np.cumsum(spoken[:, ::-1], axis=1)[:, ::-1]
    once = np.cumsum((spoken * first)[:, ::-1], axis=1)[:, ::-1]
    ended = np.ones(n, bool)
    ended[:-1] = changed[np.arange(1, n), length[:-1]]
    leaf = (ended & ~col["continues"]).astype(np.int64)
    ends = ~col["continues"]

    edges, complete = [], []
    above_starts = above_conv = above_edge = None
    for j in range(columns + 1):
        starts = np.flatnonzero(changed[:, j])
        valid = length[starts] >= j
        stops = np.r_[starts[1:], n]

        def total(x, starts=starts):
            return np.add.reduceat(x, starts)

        least = np.minimum.reduceat(conv, starts)
        stats = {"n": stops - starts, "children": total(first[:, j + 1].astype(np.int64)),
                 "leaves": total(leaf + col["later_leaves"]),
                 "saved": total(said[:, max(j, 1)] + col["after"] - col["later_words"]
                                - once[:, max(j, 1)])}
        n_ends = total((ends & (length == j)).astype(np.int64))
        goes_on = total((col["continues"] & (length == j)).astype(np.int64)) > 0
        edge = (starts == 0) | (stops == n) | goes_on | (j == 0)
        up = np.searchsorted(above_starts, starts, "right") - 1 if j else None
        depth = col["block"][starts] * width + j
        for g in np.flatnonzero(valid & edge).tolist():
            i = int(starts[g])

            def key(column, i=i):
                return node_key(width, int(col["block"][i]), column,
                                (int(col["hi"][i]), int(col["lo"][i])),
                                (int(col["nx_hi"][i]), int(col["nx_lo"][i])), matrix[i])

            at, hi, lo = key(j)
            row = _record(kind=_EDGE, part=part, depth=at, hi=hi, lo=lo,
                          children=int(stats["children"][g]))
            if j == 0 and at > 0:
                # the node itself lies in the segment before
                row |= {"sub_words": int(total(once[:, 1])[g]), "sub_leaves": int(total(leaf)[g]),
                        "sub_conv": int(least[g]), "n": 0, "leaves": 0, "saved": 0}
            else:
                row |= {c: int(stats[c][g]) for c in _SUMS} | {"conv_id": int(least[g])}
                if j and above_edge[up[g]]:
                    row["p_hi"], row["p_lo"] = key(j - 1)[1:]
                elif j:
                    row["parent"] = int(above_conv[up[g]])
                if n_ends[g]:
                    edges.append(_record(kind=_ENDS, part=part, depth=at, hi=hi, lo=lo, ends=",".join(
                        map(str, conv[i:i + int(n_ends[g])].tolist()))))
            edges.append(row)
        inner = np.flatnonzero(valid & ~edge)
        if len(inner):
            parent_edge = above_edge[up[inner]]
            keys = {}
            for g in up[inner][parent_edge].tolist():
                if g not in keys:
                    i = int(above_starts[g])
                    keys[g] = node_key(width, int(col["block"][i]), j - 1,
                                       (int(col["hi"][i]), int(col["lo"][i])),
                                       (int(col["nx_hi"][i]), int(col["nx_lo"][i])), matrix[i])[1:]
            above = [keys.get(g) for g in up[inner].tolist()]
            none = _digest([])
            complete.append({
                "depth": depth[inner], "conv_id": least[inner],
                **{c: stats[c][inner] for c in _SUMS},
                "p_hi": [k and k[0] for k in above], "p_lo": [k and k[1] for k in above],
                "parent": pa.array(above_conv[up[inner]], mask=parent_edge),
                "ends": [_digest(conv[s:s + e]) if e else none for s, e in zip(
                    starts[inner].tolist(), n_ends[inner].tolist(), strict=True)]})
        above_starts, above_conv, above_edge = starts, least, edge

    for kind, i in ((_FIRST, 0), (_LAST, n - 1)):
        edges.append(_record(
            kind=kind, part=part, depth=int(col["block"][i]), hi=int(col["hi"][i]),
            lo=int(col["lo"][i]), ids=matrix[i][matrix[i] >= 0].tolist(),
            words=spoken[i, 1:length[i] + 1].tolist(), continues=bool(col["continues"][i]),
            nx_hi=int(col["nx_hi"][i]), nx_lo=int(col["nx_lo"][i])))
    yield pa.RecordBatch.from_pylist(edges, schema=_RECORD)
    for c in complete:
        size = len(c["depth"])
        c |= {"kind": np.full(size, _COMPLETE), "part": np.full(size, part)}
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[f.name], f.type) if f.name in c and not isinstance(c[f.name], pa.Array)
             else c.get(f.name, pa.nulls(size, f.type)) for f in _RECORD], schema=_RECORD)


def _digest(ids) -> str:
    return hashlib.sha256(",".join(map(str, list(ids))).encode()).hexdigest()


def _records(segs: DataFrame, width: int) -> DataFrame:
    """The records of every range, written."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from trie_of_range(pa.Table.from_batches(held), width)

    dealt = segs.repartitionByRange(_ranges(segs.count()), "block", "hi", "lo", "ids", "conv_id")
    return written(dealt.withColumn("part", F.spark_partition_id()).mapInArrow(work, _RECORD_DDL),
                   "nodes")


def _corrections(records: DataFrame, width: int) -> DataFrame:
    """What neighbouring ranges counted twice, as records of the nodes on their border.

    The last row of each range meets the first row of the next one that has rows; the
    window that counts ranges holds one number per range.
    """
    of = {kind: records.filter(F.col("kind") == kind) for kind in (_FIRST, _LAST)}
    number = of[_FIRST].select("part", F.row_number().over(Window.orderBy("part")).alias("nr"))
    row = F.struct("depth", "hi", "lo", "ids", "words", "continues", "nx_hi", "nx_lo")
    right = of[_FIRST].select("part", row.alias("b")).join(number, "part").drop("part")
    left = of[_LAST].select("part", row.alias("a")).join(number, "part").select(
        "a", (F.col("nr") + 1).alias("nr"))
    pairs = left.join(right, "nr").select("a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [r for p in batch.to_pylist() for r in border(p["a"], p["b"], width)]
            yield pa.RecordBatch.from_pylist(out, schema=_RECORD)

    return pairs.mapInArrow(compare, _RECORD_DDL)


def border(a: dict, b: dict, width: int) -> list[dict]:
    """Corrections for row ``a``, last of its range, and row ``b``, first of the next one."""
    if (a["depth"], a["hi"], a["lo"]) != (b["depth"], b["hi"], b["lo"]):
        return []
    x, y = np.array(a["ids"], np.int64), np.array(b["ids"], np.int64)
    m = min(len(x), len(y)) // 2
    same = (x[:2 * m:2] == y[:2 * m:2]) & (x[1:2 * m:2] == y[1:2 * m:2])
    shared = m if same.all() else int(np.argmin(same))
    nodes = min(shared, len(b["words"]))
    changes = {}

    def at(row, column):
        key = node_key(width, row["depth"], column, (row["hi"], row["lo"]),
                       (row["nx_hi"], row["nx_lo"]), np.array(row["ids"], np.int64))
        return changes.setdefault(key, dict.fromkeys([*_SUMS, "sub_words", "sub_leaves"], 0))

    for j in range(nodes + 1):
        again = sum(b["words"][max(j, 1) - 1:nodes])
        inside = j > 0 or b["depth"] == 0
        at(b, j)["saved" if inside else "sub_words"] += again if inside else -again
        if j < nodes:
            at(b, j)["children"] -= 1
    if not a["continues"] and shared >= len(a["words"]):
        for j in range(len(a["words"]) + 1):
            at(a, j)["leaves" if j > 0 or a["depth"] == 0 else "sub_leaves"] -= 1
    return [_record(kind=_EDGE, depth=d, hi=hi, lo=lo, **c) for (d, hi, lo), c in changes.items()]


def _later_totals(segs: DataFrame, width: int) -> DataFrame:
    """Segments with the words and leaves of the subtries that hang below later segments.

    Each subtrie is given to one conversation that passes through it, which carries it to
    the ranges of its earlier segments.
    """
    zero = F.lit(0).cast("long")
    deep = segs.filter("block > 0")
    if deep.isEmpty():
        return segs.withColumns({"later_words": zero, "later_leaves": zero})
    records = _records(deep.withColumns({"later_words": zero, "later_leaves": zero}), width)
    sums = records.filter(F.col("kind") == _EDGE).unionByName(_corrections(records, width))
    subs = sums.groupBy("depth", "hi", "lo").agg(
        F.min("sub_conv").alias("conv_id"), F.sum("sub_words").alias("w"),
        F.sum("sub_leaves").alias("l")).filter("conv_id is not null")
    subs = subs.groupBy("conv_id", F.floor(F.col("depth") / width).alias("block")).agg(
        F.sum("w").alias("w"), F.sum("l").alias("l"))
    joined = segs.filter("block > 0 or continues").join(subs, ["conv_id", "block"], "left")
    later = Window.partitionBy("conv_id").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    joined = joined.withColumns({
        "later_words": F.coalesce(F.sum("w").over(later), zero),
        "later_leaves": F.coalesce(F.sum("l").over(later), zero)}).drop("w", "l")
    rest = segs.filter("block = 0 and not continues").withColumns(
        {"later_words": zero, "later_leaves": zero})
    return written(joined.unionByName(rest), "segments")


def _hashes(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each node's pieces in order, streamed: a task holds one piece at a time."""
    key = ["depth", "hi", "lo"]
    dealt = pieces.select(*key, "part", "ends").repartition(*key).sortWithinPartitions(*key, "part")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                node = (row["depth"], row["hi"], row["lo"])
                if node != now:
                    done += [(*now, state.hexdigest())] if now else []
                    now, state = node, hashlib.sha256(row["ends"].encode())
                else:
                    state.update(b"," + row["ends"].encode())
            yield _pack(done)
        yield _pack([(*now, state.hexdigest())] if now else [])

    return dealt.mapInArrow(work, "depth long, hi long, lo long, ends_sha256 string")


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    names = ["depth", "hi", "lo", "ends_sha256"]
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def trie_nodes(segs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie of all segments; see ``prefix_trie``."""
    records = _records(_later_totals(segs, width), width)
    key = ["depth", "hi", "lo"]
    edges = records.filter(F.col("kind") == _EDGE)
    sums = edges.unionByName(_corrections(records, width)).groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in _SUMS],
        F.max("p_hi").alias("p_hi"), F.max("p_lo").alias("p_lo"), F.max("parent").alias("parent"))
    sums = written(sums, "borders")
    names = sums.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("p_hi"),
                        F.col("lo").alias("p_lo"), F.col("conv_id").alias("above"))
    by_parent = ["depth", "p_hi", "p_lo"]
    ended = _hashes(records.filter(F.col("kind") == _ENDS))
    empty = F.lit(_digest([]))
    border_nodes = sums.join(names, by_parent, "left").join(ended, key, "left").withColumns({
        "parent": F.coalesce("parent", "above"), "ends_sha256": F.coalesce("ends_sha256", empty)})
    # parents of inner nodes are looked up range by range, so no parent's children meet in one task
    inner = records.filter(F.col("kind") == _COMPLETE).withColumnRenamed("ends", "ends_sha256")
    seen = edges.select("part", (F.col("depth") + 1).alias("depth"), F.col("hi").alias("p_hi"),
                        F.col("lo").alias("p_lo")).distinct().join(names, by_parent)
    hung = inner.filter("p_hi is not null").join(seen, ["part", *by_parent], "left").withColumn(
        "parent", F.col("above"))
    out = ["conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
           F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
           F.col("saved").alias("saved_tokens"), "ends_sha256"]
    return border_nodes.select(*out).unionByName(hung.select(*out)).unionByName(
        inner.filter("p_hi is null").select(*out))


def prefix_trie(turns: DataFrame, conversations=plain, width: int = WIDTH) -> DataFrame:
    """One row per distinct prefix of turns (role, text): the nodes of the prefix trie.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256);
    ``conversations`` makes the conversations from numbered turns (``plain`` or ``rebuilt``).
    Turns are ordered by (turn, role, text), null turns first; repeated rows are turns of
    their own. A null role or text is empty. Rows without a conv_id belong to no conversation
    and take no part. Extra columns are not read; an empty table has no nodes, not even the root.
    """
    return trie_nodes(segments(*conversations(numbered_turns(turns)), width), width)


by_value(__name__)


def oracle(family: int = FAMILY, head: int = HEAD) -> str:
    """The nodes of the rebuilt conversations in SQL, with whole prefixes as keys."""
    return f"""
    with cut as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
                               coalesce(text, '')) as k
        from conversations where conv_id is not null),
    crc as (select list_transform(range(256), lambda n: list_reduce(
            [n] || range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) as t),
    ids as (select conv_id, conv_id - conv_id % {family} as base, xor(list_reduce([4294967295] ||
            list_transform(regexp_extract_all(hex(encode(conv_id::varchar)), '..'),
                           lambda x: ('0x' || x)::bigint),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {head} as h
        from (select distinct conv_id from cut), crc),
    items as (select i.conv_id, 0 as own, k, role, text from ids i join cut on cut.conv_id = base and k <= h
              union all select i.conv_id, 1, k, role, text from ids i join cut using (conv_id) where k > h),
    turns as (select i.conv_id, list(struct_pack(r := role, t := text) order by own, k)
                  filter (role is not null) as ts
              from ids i left join items using (conv_id) group by i.conv_id),
    whole as (select conv_id, coalesce(ts, []) as ts from turns),
    steps as (select conv_id, ts, unnest(range(0, len(ts) + 1)) as d from whole),
    nodes as (select ts[:d] as p, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
                coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(ts) = d), '') as ends
              from steps group by ts[:d], d),
    kids as (select p[:depth - 1] as p, count(*) as n_children from nodes where depth > 0 group by 1),
    full_nodes as (select n.*, coalesce(n_children, 0) as n_children, case when depth = 0 then 0 else
                (n_convs - 1) * len(regexp_extract_all(p[depth].t, '[^\\x20\\x09-\\x0D]+')) end as saved
              from nodes n left join kids using (p)),
    climbs as (select p[:d] as p, saved, n_children from (
                 select *, unnest(range(0, depth + 1)) as d from full_nodes)),
    sums as (select p, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
             from climbs group by p)
    select f.conv_id, f.depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
           s.saved_tokens, sha256(f.ends) as ends_sha256
    from full_nodes f join sums s using (p)
    left join nodes u on f.depth > 0 and u.depth = f.depth - 1 and u.p = f.p[:f.depth - 1]
    """
