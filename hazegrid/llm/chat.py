"""Logged conversations: snapshots that a longer one continues go, the rest are rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import written

#: Turns of a conversation that one rendered part holds.
TURNS = 1024
#: Rows that one task numbers, about.
RANGE_ROWS = 20_000
#: The halves of a prefix's two 64-bit hashes.
PREFIX = ["a_hi", "a_lo", "b_hi", "b_lo"]


def _halves(name: str, term: Column) -> dict[str, Column]:
    """A 64-bit hash as two numbers whose sums cannot overflow."""
    return {f"{name}_hi": F.shiftright(term, 32), f"{name}_lo": term.bitwiseAND(F.lit(0xFFFFFFFF))}


def in_ranges(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, part): rows dealt by range of their order, written.

    The order is (conv_id, turn, role, text), nulls first, and equal rows may be cut anywhere,
    so a range has about ``RANGE_ROWS`` rows however many share a conversation or a turn number.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), *order[1:])
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(
        ranges, *order, "__tie")
    return written(dealt.select(*order, F.spark_partition_id().cast("long").alias("part")), "turns")


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, k, role, text, *PREFIX): turns with the hash of all turns up to them.

    ``k`` numbers a conversation's turns from 1 in order of (turn, role, text), null turn
    numbers first. The prefix hash is a running sum of two 64-bit hashes of (k, role, text), so
    it is carried from one range of rows to the next as one total per range, and a long
    conversation is never in one task, be its turns numbered or not.
    """
    cut = in_ranges(turns)
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    cut = cut.withColumn("row", F.row_number().over(inside))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = cut.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select(F.col("conv_id").alias("c"), F.col("part").alias("p"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows"))
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    cut = cut.join(starts, on).withColumn("k", F.col("rows") + F.col("row")).drop(
        "c", "p", "rows", "row")
    said = [F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    terms = _halves("a", F.xxhash64("k", *said)) | _halves("b", F.xxhash64(F.lit(1), *said, "k"))
    cut = cut.withColumns({f"t_{n}": x for n, x in terms.items()})
    totals = cut.groupBy("conv_id", "part").agg(*[F.sum(f"t_{n}").alias(n) for n in PREFIX])
    totals = totals.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"s_{n}") for n in PREFIX])
    running = Window.partitionBy("conv_id", "part").orderBy("k").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = cut.join(totals, on)
    return out.select("conv_id", "k", "role", "text", *[
        (F.col(f"s_{n}") + F.sum(f"t_{n}").over(running)).alias(n) for n in PREFIX])


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_same) of conversations that are no proper prefix of another one.

    Of equal conversations the smallest conv_id stays; ``n_same`` counts them.
    """
    ends = prefixes.groupBy("conv_id").agg(
        F.max("k").alias("n_turns"), *[F.max_by(n, "k").alias(n) for n in PREFIX])
    # equal conversations are one before anything is joined
    ends = ends.groupBy("n_turns", *PREFIX).agg(F.min("conv_id").alias("conv_id"),
                                             F.count(F.lit(1)).alias("n_same"))
    lengths = prefixes.groupBy("conv_id").agg(F.max("k").alias("n"))
    inner = (prefixes.select("conv_id", "k", *PREFIX)
             .join(lengths.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
             .filter("k < n").select(F.col("k").alias("n_turns"), *PREFIX).distinct())
    return ends.join(inner, ["n_turns", *PREFIX], "left_anti").select(
        "conv_id", "n_turns", "n_same")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"),
                    F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, n_same, turns, rendered) of maximal conversations.

    A conversation's text is its parts in order, from 0; it has one part unless it has more
    than ``TURNS`` turns, so that no row or task grows with the longest conversation; turns are
    numbered by ranges of rows, so neither does repeating one turn number or having none.
    Repeated turn rows count as turns. Null roles and texts render as empty but differ from empty
    ones when conversations are compared. Rows without a conv_id form one conversation with
    a null id. Turns without a number come first. An empty table gives an empty
    result. Extra columns are not read.
    """
    prefixes = written(turn_prefixes(turns), "prefixes")
    kept = maximal_conversations(prefixes).withColumnRenamed("conv_id", "c")
    part = F.floor((F.col("k") - 1) / TURNS).alias("part")
    texts = prefixes.select("conv_id", part, F.struct(
        "k", rendered_turn(F.col("role"), F.col("text")).alias("r")).alias("x"))
    parts = texts.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    parts = parts.select("conv_id", "part", F.size("xs").cast("long").alias("turns"),
                         F.array_join(F.transform("xs", lambda x: x["r"]), "").alias("rendered"))
    return parts.join(kept, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", F.col("part").cast("long").alias("part"), "n_turns", "n_same", "turns", "rendered")


def oracle() -> str:
    """The same rows in SQL, comparing the turns themselves."""
    return f"""
    with cut as (select conv_id, role, text, row_number() over (partition by conv_id
            order by turn nulls first, role nulls first, text nulls first) as k
        from conversations),
    runs as (select *, list(struct_pack(r := role, t := text)) over (partition by conv_id order by k)
             as prefix from cut),
    ends as (select conv_id, max(k) as n_turns, arg_max(prefix, k) as whole from runs group by conv_id),
    once as (select n_turns, whole, min(conv_id) as conv_id, count(*) as n_same
             from ends group by n_turns, whole),
    inner_prefixes as (select distinct r.k as n_turns, r.prefix as whole
             from runs r join ends e on r.conv_id is not distinct from e.conv_id where r.k < e.n_turns),
    kept as (select * from once o where not exists (select 1 from inner_prefixes i
             where i.n_turns = o.n_turns and i.whole = o.whole))
    select c.conv_id, (k - 1) // {TURNS} as part, any_value(n_turns) as n_turns, any_value(n_same) as n_same,
        count(*) as turns,
        string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
                   || '<|im_end|>' || chr(10), '' order by k) as rendered
    from cut c join kept on c.conv_id is not distinct from kept.conv_id
    group by c.conv_id, (k - 1) // {TURNS}
    """
