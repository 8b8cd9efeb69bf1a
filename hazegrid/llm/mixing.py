"""Temperature mixing of sources, realised as block permutations within a token budget.

A source's weight is its share of the tokens raised to an exponent between 0 (all sources
alike) and 1 (as they come). The exponent is bisected on the table of sources; documents
are then taken in whole passes ("epochs", each a permutation of its own) and one partial
pass per source. The place where the partial pass ends is found on a histogram of the
permutation, so documents themselves are neither sorted nor shuffled. The budget is cut
into blocks: a row's place in its source's passes, as a share of the source's target, is its
place in the mixture, so every block holds the sources by their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazegrid.llm.common import discard, word_count, written

#: Digits to which the exponent is bisected and rounded.
DIGITS = 6
#: Halvings evaluated in one pass over the sources.
_AT_ONCE = 5
#: Hexadecimal digits of the permutation that make a histogram bin: 4096 bins a source.
_BIN = 3
#: Tokens of a block of the mixture.
BLOCK = 65_536
#: Hexadecimal digits of the permutation that place a row in its pass.
_PLACE = 12


def permutation(seed: int, epoch: Column, row: Column) -> Column:
    """The order of rows in one pass over their source."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), row).cast("binary"))


def _row_key(docs: DataFrame) -> Column:
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                      F.coalesce("text", F.lit("")))
    return F.md5(key.cast("binary"))


def _at(sources: DataFrame, exponents: list[float], budget: int | None) -> dict[float, tuple]:
    """Entropy share and largest number of passes for each exponent."""
    tried = F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a")
    p = F.pow("share", "a")
    rows = (sources.select("share", "tokens", tried)
            .groupBy("a").agg(F.sum(p).alias("z"), F.sum(p * F.col("a") * F.ln("share")).alias("s"),
                              F.max(p / F.col("tokens")).alias("most"),
                              F.min(p / F.col("tokens")).alias("least"),
                              F.count(F.lit(1)).alias("n")).collect())
    out = {}
    for r in rows:
        entropy = math.log(r["z"]) - r["s"] / r["z"]
        passes = r["most"] / r["least"] if budget is None else budget * r["most"] / r["z"]
        out[r["a"]] = (entropy / math.log(r["n"]) if r["n"] > 1 else 1.0, passes)
    return out


def exponent(sources: DataFrame, budget: int | None, entropy: float | None,
             passes: float | None) -> float:
    """The exponent nearest 1 that reaches the target entropy, raised if need be until no
    source is passed over more than ``passes`` times. With a limit alone it is the smallest
    exponent within the limit, with neither it is 1. Where not even exponent 1 is within the
    limit, as with a budget of more than ``passes`` times the corpus, it is 1.

    ``sources`` has (share, tokens) of sources with tokens. Entropy is a share of the
    largest possible. ``budget`` None stands for the smallest budget that takes every
    document at least once. Both measures are monotone in the exponent, so it is bisected,
    several halvings at a time.
    """
    def bisect(good_low: bool, test) -> float:
        lo, hi = 0, 10 ** DIGITS
        while hi - lo > 1:
            step = max(1, (hi - lo) >> _AT_ONCE)
            grid = list(range(lo + step, hi, step))
            seen = _at(sources, [g / 10 ** DIGITS for g in grid], budget)
            ok = [test(seen[g / 10 ** DIGITS]) for g in grid]
            # the last exponent of the low side and the first of the high side
            cut = next((i for i, x in enumerate(ok) if x != good_low), len(grid))
            lo, hi = (grid[cut - 1] if cut else lo), (grid[cut] if cut < len(grid) else hi)
        return (lo if good_low else hi) / 10 ** DIGITS

    found = 0.0 if entropy is None and passes is not None else 1.0
    ends = _at(sources, [0.0, 1.0], budget)
    if not ends:
        return found
    if entropy is not None and ends[1.0][0] < entropy:
        found = bisect(True, lambda x: x[0] >= entropy)
    if passes is not None:
        now = _at(sources, [found], budget)[found][1]
        if now > passes:
            found = bisect(False, lambda x: x[1] <= passes) if ends[1.0][1] <= passes else 1.0
    return found


def source_plan(tokens: DataFrame, budget: int | float | None, entropy: float | None,
                passes: float | None) -> DataFrame:
    """(source, tokens, share, exponent, weight, target, epochs, rest) per source with tokens.

    ``target`` tokens are ``epochs`` whole passes and ``rest`` tokens of another one. A
    budget is a number of tokens or, as a float, a share of the corpus's; None takes the
    smallest one that passes over every source at least once.
    """
    sums = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0")
    total = sums.agg(F.sum("tokens")).first()[0] or 1
    if isinstance(budget, float):
        budget = math.floor(budget * total)
    sums = written(sums.withColumn("share", F.col("tokens") / F.lit(float(total))), "sources")
    a = exponent(sums, budget, entropy, passes)
    p = F.pow("share", F.lit(a))
    row = sums.agg(F.sum(p).alias("z"), F.max(F.col("tokens") / p).alias("largest")).first()
    z = row["z"] or 1.0
    spend = F.lit(float(budget)) if budget is not None else F.lit((row["largest"] or 0.0) * z)
    weight = p / F.lit(z)
    plan = sums.withColumn("exponent", F.lit(a)).withColumn("weight", weight).withColumn(
        "target", F.floor(weight * spend + F.lit(1e-6)))
    if budget is None:
        plan = plan.withColumn("target", F.greatest("target", "tokens"))
    return plan.withColumn("epochs", F.floor(F.col("target") / F.col("tokens"))).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("tokens"))


def mix(docs: DataFrame, budget: int | float | None = None, entropy: float | None = None,
        passes: float | None = None, seed: int = 1, length: Column | None = None,
        block: int = BLOCK) -> DataFrame:
    """Rows of ``docs`` once per pass that takes them, with ``epoch``, ``block``, ``place``
    and ``n_tokens``.

    Ordering by (block, place) is the order to read them in: blocks of about ``block`` tokens,
    numbered from 0, hold each source's weight of their tokens up to what a random order of its
    documents leaves, and a source's passes follow each other. ``length`` is the token
    count of a row, by default its words. The partial pass of a source takes documents in
    order while fewer than ``rest`` tokens lie ahead of them, so each source ends within one
    document of its target. Documents without tokens cost nothing and are in every whole
    pass, at least one. A null source is a source of its own; equal rows go together. An
    empty table gives an empty result. Rows without tokens are spread over all blocks. Columns
    of ``docs`` named like the four added ones are replaced.
    """
    length = word_count(F.col("text")) if length is None else length
    keyed = written(docs.select("source", length.alias("n_tokens"), _row_key(docs).alias("row")),
                    "lengths")
    plan = written(source_plan(keyed, budget, entropy, passes), "plan")
    same = F.col("source").eqNullSafe(F.col("s"))
    short = plan.select(F.col("source").alias("s"), "epochs", "rest")

    # the bin of the partial pass in which its tokens run out, then the row inside it
    spent = (keyed.join(short.filter("rest > 0"), same)
             .withColumn("u", permutation(seed, F.col("epochs"), F.col("row")))
             .withColumn("bin", F.substring("u", 1, _BIN)))
    ahead = Window.partitionBy("s").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = spent.groupBy("s", "bin").agg(F.sum("n_tokens").alias("inside"), F.first("rest").alias("rest"))
    bins = bins.withColumn("ahead", F.coalesce(F.sum("inside").over(ahead), F.lit(0)))
    last = bins.filter("ahead < rest and ahead + inside >= rest").select(
        F.col("s").alias("s2"), F.col("bin").alias("b2"), "ahead")
    edge = (spent.join(last, F.col("s").eqNullSafe(F.col("s2")) & (F.col("bin") == F.col("b2")))
            .groupBy("s", "u").agg(F.sum("n_tokens").alias("n_tokens"), F.first("ahead").alias("ahead"),
                                   F.first("rest").alias("rest")))
    before = Window.partitionBy("s").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    cut = (edge.withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
           .filter("ahead < rest").groupBy("s").agg(F.max("u").alias("cut")))
    spend = plan.agg(F.sum("target")).first()[0] or 0
    blocks = float(max(1, math.ceil(spend / block)))
    ends = written(plan.select("source", "epochs", "tokens", "target").join(
        cut.withColumnRenamed("s", "cs"), F.col("source").eqNullSafe(F.col("cs")), "left")
        .select(F.col("source").alias("__s"), F.col("epochs").cast("int").alias("__epochs"),
                F.col("tokens").alias("__tokens"), F.col("target").alias("__target"),
                F.col("cut").alias("__cut")), "ends")
    discard(keyed, plan)

    rows = docs.drop("epoch", "block", "place", "n_tokens")
    rows = rows.withColumn("n_tokens", length).withColumn("__row", _row_key(docs))
    rows = rows.join(ends, F.col("source").eqNullSafe(F.col("__s")), "left")
    taken = F.when(F.col("__epochs").isNull(), 1).when(
        F.col("n_tokens") == 0, F.greatest("__epochs", F.lit(1))).otherwise(
        F.col("__epochs") + F.when(
            permutation(seed, F.col("__epochs"), F.col("__row")) <= F.col("__cut"), 1).otherwise(0))
    out = rows.withColumn("__taken", taken).filter("__taken > 0")
    out = out.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("__taken") - 1)))
    out = out.withColumn("place", permutation(seed, F.col("epoch"), F.col("__row")))
    here = F.conv(F.substring("place", 1, _PLACE), 16, 10).cast("double") / F.lit(16.0 ** _PLACE)
    through = F.when((F.col("n_tokens") > 0) & (F.col("__target") > 0), (
        F.col("epoch") + here) * F.col("__tokens") / F.col("__target")).otherwise(here)
    out = out.withColumn("block", F.least(
        F.floor(through * F.lit(blocks)), F.lit(int(blocks) - 1)).cast("long"))
    return out.drop("__row", "__s", "__epochs", "__cut", "__tokens", "__target", "__taken")


#: Share of the corpus's tokens, of the largest possible entropy, and most passes over one
#: source in the registered query.
BUDGET, ENTROPY, PASSES = 1.5, 0.98, 4.0


def oracle(budget: float = BUDGET, entropy: float = ENTROPY, passes: float = PASSES,
           seed: int = 1) -> str:
    """The registered query's rows in SQL."""
    scale = 10 ** DIGITS

    def measured(a: str) -> str:
        return f"""(select struct_pack(
            h := case when count(*) > 1 then (ln(sum(pow(share, {a})))
                 - sum(pow(share, {a}) * {a} * ln(share)) / sum(pow(share, {a}))) / ln(count(*))
                 else 1.0 end,
            m := max(pow(share, {a}) / tokens) * any_value(budget) / sum(pow(share, {a})))
            from shares)"""

    def halving(name: str, keep_low: str, start: str) -> str:
        mid = f"((lo + hi) // 2)::double / {scale}"
        return f"""{name}(lo, hi) as (
          select 0, {scale} union all
          select case when {keep_low} then mid else lo end,
                 case when {keep_low} then hi else mid end
          from (select lo, hi, (lo + hi) // 2 as mid, {measured(mid)} as x from {name}
                where hi - lo > 1))"""

    return f"""
    with recursive keyed as (
      select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))
               as n_tokens,
             md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')) as row
      from documents),
    sums as (select source, sum(n_tokens)::bigint as tokens from keyed group by source
             having sum(n_tokens) > 0),
    shares as (select source, tokens, tokens::double / sum(tokens) over () as share,
                      floor(sum(tokens) over () * {budget}) as budget from sums),
    {halving('by_entropy', f'x.h >= {entropy}', '')},
    {halving('by_passes', f'not x.m <= {passes}', '')},
    found as (select case when {measured('1.0')}.h < {entropy}
        then (select max(lo) from by_entropy)::double / {scale} else 1.0 end as a),
    chosen as (select case when {measured('(select a from found)')}.m > {passes}
        then case when {measured('1.0')}.m <= {passes}
             then (select min(hi) from by_passes)::double / {scale} else 1.0 end
        else (select a from found) end as a),
    plan as (select source, tokens, a as exponent,
        pow(share, a) / sum(pow(share, a)) over () as weight,
        floor(pow(share, a) / sum(pow(share, a)) over () * budget + 1e-6)::bigint as target
        from shares, chosen),
    passed as (select *, target // tokens as epochs, target - target // tokens * tokens as rest
               from plan),
    placed as (select k.*, p.epochs, p.rest, p.tokens, p.target,
        sum(n_tokens) over (partition by k.source
          order by md5('{seed}:' || coalesce(p.epochs, 0) || ':' || k.row)
          range between unbounded preceding and current row)
        - sum(n_tokens) over (partition by k.source, md5('{seed}:' || coalesce(p.epochs, 0) || ':' || k.row))
          as ahead
        from keyed k left join passed p on k.source is not distinct from p.source),
    counted as (select *, case when epochs is null then 1 when n_tokens = 0 then greatest(epochs, 1)
        when ahead < rest then epochs + 1 else epochs end as taken from placed),
    passes as (select *, unnest(generate_series(0, taken - 1)) as epoch from counted where taken > 0),
    ordered as (select *, md5('{seed}:' || epoch || ':' || row) as place from passes),
    located as (select *, ('0x' || substr(place, 1, {_PLACE}))::bigint::double / {16.0 ** _PLACE!r}
                as here from ordered),
    cuts as (select greatest(1, ceil(coalesce(sum(target), 0)::double / {BLOCK})) as blocks from plan)
    select doc_id, source, n_tokens, epoch::integer as epoch, place,
           least(floor(case when n_tokens > 0 and target > 0 then
                 (epoch::double + here) * tokens::double / target::double else here end * blocks),
                 blocks - 1)::bigint as block
    from located, cuts
    """
