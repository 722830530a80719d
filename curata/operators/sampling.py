"""Seeded samples and fixed-size batches by row ordinal."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.operators.storage import fixed

#: Places of a sample that the driver draws and broadcasts; a larger sample is drawn by Spark.
LARGEST_SAMPLE = 100_000


def sample_places(n: int, size: int, seed: int) -> list[int]:
    """Ordinals of a seeded sample without replacement, in order; all if there are no more rows than asked for."""
    if n <= size:
        return list(range(n))
    return sorted(random.Random(seed).sample(range(n), size))


def with_ordinal(df: DataFrame, order: list[str], name: str = "ord") -> DataFrame:
    """df with a dense ordinal by `order`, from range partitions and their sizes: no task sees all rows."""
    place = F.monotonically_increasing_id()  # a partition's number, then 33 bits of the place in it
    placed = fixed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place))
    part, row = F.call_function("shiftright", F.col("_place"), F.lit(33)), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row a partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(before), "_part")
    return joined.select(*df.columns, (F.col("_before") + row).alias(name))


def seeded_sample(df: DataFrame, ordinal: str, n: int, size: int, seed: int) -> DataFrame:
    """`size` rows by drawn ordinals: broadcast up to LARGEST_SAMPLE of them, else those whose seeded hash is smallest."""
    if n <= size:
        return df
    if size > LARGEST_SAMPLE:
        drawn = df.select(F.col(ordinal).alias("_drawn"), F.xxhash64(F.lit(seed), ordinal).alias("_hash"))
        placed = with_ordinal(drawn, ["_hash", "_drawn"], "_place").where(F.col("_place") < size).select("_drawn")
        return df.join(placed, F.col(ordinal) == F.col("_drawn"), "left_semi")
    spark: SparkSession = df.sparkSession
    drawn = spark.createDataFrame([(i,) for i in sample_places(n, size, seed)], "_drawn bigint")
    return df.join(F.broadcast(drawn), F.col(ordinal) == F.col("_drawn"), "left_semi")


def batches(df: DataFrame, ordinal: str, size: int) -> DataFrame:
    """df with batch: consecutive batches of `size` ordinals."""
    return df.withColumn("batch", F.floor(F.col(ordinal) / size).cast("bigint"))
