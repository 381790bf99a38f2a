"""What several of these operators need: reading, ranks without a global sort, components, batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditlake.settings import ship_package, stage

#: White space of the words, as a pattern for Java, Python and DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers, and have Arrow batches of 2,000 rows where the session has the default of 10,000.

    Ten thousand long texts are too much for each of the several Python workers of a small executor.
    """
    ship_package(spark)
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark's reader touches the path."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_training(doc_id: str | Column) -> Column:
    """Rows that may be learnt from: four of five, by a checksum of the id. A null id is never one."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % 5 != 0, F.lit(False))


def held_out(doc_id: str | Column) -> Column:
    """The other fifth. A null id has no checksum and counts as held out."""
    return ~in_training(doc_id)


def ranked(df: DataFrame, group: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Number the rows of each group from 0 in the given order.

    Rows are range partitioned by group and order, so a group of any size is spread over many tasks. The number
    of a row is its place in its partition, plus the group's rows in the partitions before, which are one small row
    for each group and partition. Rows that are equal in `order` are numbered in any order: add a last column
    that tells rows apart. Null is a group of its own. An empty input gives an empty result.
    """
    spark = df.sparkSession
    keys = [F.col(g).asc_nulls_last() for g in group] + order
    n = max(2, partitions(spark))
    placed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    placed = stage(placed.withColumn("_part", F.shiftright("_row", 33).cast("int")), "ranked")
    parts = placed.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    parts = parts.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.col("_part").alias("_p"), "_first", "_base")
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    number = (F.col("_row") - F.col("_first") + F.col("_base")).cast("long").alias(rank)
    return placed.join(parts, same).select(*df.columns, number)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component) for each node in a link; component is the
    smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), each of which lets every node point
    to the smallest node it knows. All links stay distributed; the driver sees two sums a round. Each round is
    written to the shared folder, so lineage stays short and lost executors cost one round at most.
    """
    pairs = links.where(F.col("a") != F.col("b"))
    pairs = stage(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    print_of = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    state = print_of(pairs)
    while state[0]:
        # Large star: every larger neighbour of a node is tied to the smallest node around it.
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        larger = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = stage(larger.where("a != b").distinct(), "links")
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        least = tied.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        smaller = tied.join(least, F.col("a") == F.col("n"))
        smaller = smaller.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a != b")
        pairs = stage(smaller.distinct(), "links")
        now = print_of(pairs)
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """So many bits as bytes, with those set whose numbers are in the only column of `places`."""
    places = places.select((F.col(places.columns[0]) + 1).alias("at"))
    maps = places.groupBy(F.bitmap_bucket_number("at").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    merged = np.zeros(bits // 8, np.uint8)
    for n, part in maps.collect():
        merged[(n - 1) * 4096 : n * 4096] = np.frombuffer(part, np.uint8)[: len(merged) - (n - 1) * 4096]
    return merged


def id_bits(ids: DataFrame, bits: int = 1 << 26) -> tuple[Broadcast, Callable[[Column], list[Column]]]:
    """A bitmap for the only column of `ids`, and the two places of a value in it; see `may_hold`."""
    spots = lambda c: [F.pmod(F.xxhash64(c, F.lit(s)), F.lit(bits)) for s in (1, 2)]
    places = ids.select(F.explode(F.array(*spots(F.col(ids.columns[0])))).alias("at"))
    return ids.sparkSession.sparkContext.broadcast(bitmap(places, bits)), spots


def both_set(bitmap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (bitmap[a >> 3] >> (a & 7) & bitmap[b >> 3] >> (b & 7) & 1).astype(bool)


def may_hold(ids: DataFrame, bits: int = 1 << 26) -> Callable[[Column], Column]:
    """A test for a column that is true for all values of the only column of `ids`, and for few others.

    A Bloom filter of a fixed size, `bits` in all, whatever the number of ids: with more ids it lets more pass, and loses
    none. Tasks set bits, the driver gets the merged bitmaps (8 MB by default) and broadcasts them. Rows that pass still
    have to be joined with `ids`; those that do not are spared the shuffle.
    """
    shared, spots = id_bits(ids, bits)

    @F.pandas_udf("boolean")
    def held(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(both_set(shared.value, a.to_numpy(), b.to_numpy()))

    return lambda c: held(*spots(c))


def text_runs(texts: list[str], most: int = 1 << 20) -> Iterator[range]:
    """Consecutive runs of texts of about `most` characters, and one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


def small_batches(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most_bytes`, and one row at least, so that long texts do not add up."""
    for b in batches:
        step = max(1, min(b.num_rows, int(b.num_rows * most_bytes / max(b.nbytes, 1)))) if b.num_rows else 1
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)
