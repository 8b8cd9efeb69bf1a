"""Helpers that several training-data operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from hazegrid.session import discard, new_folder, written

__all__ = ["by_value", "components", "discard", "extended", "hash_chunk", "new_folder",
           "numbered", "read", "sieved", "word_array", "word_count", "word_pattern", "written"]

#: A word is a run of anything but these white-space characters.
word_pattern = r"[^\x20\x09-\x0D]+"
_SPACE = " \t\n\x0b\x0c\r"


def by_value(module: str) -> None:
    """Ship a module's functions with the tasks, so that executors need no copy of it."""
    for name in (module, __name__):
        cloudpickle.register_pickle_by_value(sys.modules[name])


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_array(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[\x20\x09-\x0D]+"))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(word_pattern)).cast("long")


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(),
          "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def extended(df: DataFrame, read: list[str], added: dict[str, str], make: Callable,
             rows: int = 500) -> DataFrame:
    """``df`` without the ``read`` columns but with ``added`` ones (name to type).

    ``make`` is called once per task and returns a function from the read columns' values
    (lists, in order) to the added columns' values. Arrow batches go through it ``rows`` at
    a time; other columns pass untouched.
    """
    kept = [c for c in df.columns if c not in read]
    schema = StructType([df.schema[c] for c in kept] + [
        StructField(c, _type(t)) for c, t in added.items()])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                made = function(*[part.column(c).to_pylist() for c in read])
                arrays = [part.column(c) for c in kept] + [
                    pa.array(x, _ARROW[t]) for x, t in zip(made, added.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *added])

    return df.mapInArrow(work, schema)


def _type(name: str) -> DataType:
    return StructType.fromDDL(f"x {name}")[0].dataType


def numbered(df: DataFrame, group: list[str], order: list[str], slot: str, chunk: Column,
             ) -> DataFrame:
    """Number the rows of each group from 0, group by group in bounded tasks.

    ``chunk`` splits a group into consecutive ranges of its order; the rows ahead of a
    chunk come from one count per chunk, so no task holds more than one chunk. Group
    and chunk must not be null.
    """
    keys = [*group, "__chunk"]
    cut = df.withColumn("__chunk", chunk)
    counts = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (cut.withColumn("__row", inside).join(starts, keys)
            .withColumn(slot, F.col("__ahead") + F.col("__row") - 1)
            .drop("__chunk", "__ahead", "__row"))


def hash_chunk(key: Column, rows: int, per_chunk: int = 50_000) -> Column:
    """Leading bits of a 64-bit hash: ranges of its order with some ``per_chunk`` rows each."""
    bits = max(1, rows // per_chunk).bit_length()
    return F.shiftright(key, 64 - bits)


#: Bits of the map by which rows are sieved: so many per key, and at most 32 MB of them.
_BITS_PER_KEY, _MOST_BITS = 16, 1 << 28
#: Bits of one row of the map: what ``bitmap_construct_agg`` puts into a value.
_ROW_BITS = 32_768


def sieved(df: DataFrame, key: str, keys: DataFrame, *, inside: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys`` (its first column), found without a shuffle.

    All rows with such a key, and one in seventeen of the others (more, where the keys are so
    many that the map's bound is met); a join decides on them. ``inside`` False gives the
    rest: rows whose key is surely not among them. Rows without a key are in neither.
    """
    of = keys.columns[0]
    n = keys.agg(F.approx_count_distinct(of)).first()[0]
    bits = min(_MOST_BITS, -(-max(1, n) * _BITS_PER_KEY // _ROW_BITS) * _ROW_BITS)

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))

    at = keys.filter(F.col(of).isNotNull()).select(place(of).alias("__p"))
    bitmap = at.groupBy(F.floor(F.col("__p") / _ROW_BITS).alias("__r")).agg(
        F.bitmap_construct_agg((F.col("__p") % _ROW_BITS)).alias("__bits"))
    # a bounded number of rows on the right
    found = df.filter(F.col(key).cast("long").isNotNull()).withColumn("__p", place(key)).join(
        F.broadcast(bitmap), F.floor(F.col("__p") / _ROW_BITS) == F.col("__r"), "left")
    byte = F.substring("__bits", (F.floor(F.col("__p") % _ROW_BITS / 8) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (F.col("__p") % 8).cast("int"))
    return found.filter((F.coalesce(bit, F.lit(0)) == 1) == F.lit(inside)).select(*df.columns)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every node that has an edge: (node, component).

    Alternating stars: each step hangs a node's neighbours on its smallest neighbour,
    first the larger ones, then the smaller ones, until nothing moves. Each step is one
    aggregation with partial sums and one join whose large side Spark may split, so a
    node with very many edges is no single task; steps go through the shared folder.
    """
    stars = edges.select(F.greatest(a, b).cast("long").alias("u"),
                         F.least(a, b).cast("long").alias("v")).filter("u <> v").distinct()
    stars = written(stars, "edges")
    mark = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        step = written(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        now = step.agg(F.count(F.lit(1)), F.coalesce(
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        discard(stars)
        stars = step
        if now == mark or now[0] == 0:
            break
        mark = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


by_value(__name__)
