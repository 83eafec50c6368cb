"""Helpers that the operators of this subpackage share: columns, batches, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.plans.materialize import checkpointed, shuffles_released

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` with about ``limit`` bytes in ``column``, one row at least.

    Numpy temporaries then depend on ``limit`` and the longest single value, not on the
    number of rows in an Arrow batch.
    """
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and held + n > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(n)
    if begin < batch.num_rows:
        yield batch.slice(begin)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 64) -> Iterator[None]:
    """Arrow batches of few rows, for eager steps whose rows hold sets or blocks of sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Rows of one key that a join leaves together, and most keys above it.
_HOT, _MOST_HOT = 500, 1_000_000


def spread_join(many: DataFrame, one: DataFrame, key: str, row: str, how: str = "inner") -> DataFrame:
    """``many`` joined with ``one`` on ``key``; the rows of a frequent key are dealt to parts by ``row``.

    The list of frequent keys has ``_MOST_HOT`` rows at most, so it is broadcast.
    """
    counts = checkpointed(many.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _HOT))
    limit = max(_HOT, -(-(counts.agg(F.sum("n")).first()[0] or 0) // _MOST_HOT))
    hot = checkpointed(counts.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).alias("_parts")))
    if hot.isEmpty():
        return many.join(one, key, how)
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    dealt = many.join(F.broadcast(hot), key, "left").withColumn("_part", F.pmod(F.xxhash64(row), parts)).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    return dealt.join(one.join(F.broadcast(hot), key, "left").withColumn("_part", copies).drop("_parts"), [key, "_part"], how).drop("_part")


def stored_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key``, sorted by it and stored; later joins on ``key`` leave its rows where they are.

    An adaptive plan doesn't tell how its result is partitioned, so this step has a fixed one.
    """
    spark, name = df.sparkSession, "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return checkpointed(df.repartition(partitions(spark), key).sortWithinPartitions(key))
    finally:
        spark.conf.set(name, before)


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` of every id in ``links(a, b)`` that isn't the smallest of its component.

    Alternating large-star and small-star steps: each replaces links by links to the
    smallest neighbour, until only stars are left.  A step groups with a map-side
    minimum and joins; one vertex may hold any share of the links.  No links: no rows.
    """
    edges = checkpointed(_ordered(links.select("a", "b")))
    mark = _mark(edges)
    while mark[0]:
        edges = checkpointed(_small_star(_large_star(edges)))
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, the larger id first."""
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    with shuffles_released(edges.sparkSession):
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = _ordered(edges)
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(low, "a")
    return _ordered(
        linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
    )
