"""One row per key, and what was there more than once.

Picking a row is an aggregation, not a window: copies are reduced before the shuffle,
so a key with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazegrid.operators.chunks import KEY

ROW_KEY = [KEY, "ts"]


def _pick(df: DataFrame, keys, arrival, best) -> DataFrame:
    order = [c for c in arrival if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    kept = df.groupBy(*keys).agg(best(F.struct(*order, *rest)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col("kept")[c].alias(c)
                         for c in df.columns])


def keep_last(df: DataFrame, keys=ROW_KEY, arrival=("arrival",)) -> DataFrame:
    """The row of each key that arrived last; equal arrivals resolve by value."""
    return _pick(df, list(keys), list(arrival), F.max)


def keep_first(df: DataFrame, keys=ROW_KEY, arrival=("arrival",)) -> DataFrame:
    """The row of each key that arrived first."""
    return _pick(df, list(keys), list(arrival), F.min)


def duplicate_rows(df: DataFrame, columns=None) -> DataFrame:
    """Every distinct row that occurs more than once, with its number of copies."""
    columns = columns or df.columns
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
            .filter("copies > 1"))


def all_duplicates(df: DataFrame, columns=None) -> DataFrame:
    """All members of groups of equal rows, each copy as a row of its own."""
    found = duplicate_rows(df, columns)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.select("*", copies.alias("copy")).drop("copies")


def union_by_name(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stack ``fresh`` on ``existing``, keeping just the columns ``existing`` has."""
    shared = [c for c in existing.columns if c in fresh.columns]
    return existing.unionByName(fresh.select(*shared), allowMissingColumns=True)


def upsert(existing: DataFrame, fresh: DataFrame, keys=ROW_KEY) -> DataFrame:
    """``existing`` with the rows of ``fresh`` added or put in place of older ones."""
    both = union_by_name(existing.withColumn("arrival", F.lit(0)),
                         fresh.withColumn("arrival", F.lit(1)))
    return keep_last(both, keys).drop("arrival")
