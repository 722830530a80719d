"""Quality reports: counts by group with a total, histograms, examples, one status over many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def translation_stats(translated: Column, failed: Column, passed: Column) -> list[Column]:
    """Aggregates of one output: valid is all or nothing."""
    n, f = F.count_if(translated), F.count_if(failed)
    return [
        (n + f).alias("source_count"), n.alias("translated_count"), F.when(F.bool_and(passed), n).otherwise(0).alias("valid_count"),
        (f + F.when(F.bool_and(passed), 0).otherwise(n)).alias("invalid_count"), f.alias("failure_count"),
    ]


def with_total(df: DataFrame, group: str, aggregates: list[Column], total: str = "total") -> DataFrame:
    """The aggregates of each group and of all rows, in one pass."""
    rolled = df.rollup(group).agg(F.grouping(group).alias("_all"), *aggregates)
    return rolled.withColumn(group, F.when(F.col("_all") == 1, total).otherwise(F.col(group))).drop("_all")


def missing_histogram(df: DataFrame, columns: list[str]) -> DataFrame:
    """field, n_missing (null or ""), n_rows."""
    sums = df.agg(F.count("*").alias("n_rows"), *(F.count_if(F.coalesce(F.col(c).cast("string") == "", F.lit(True))).alias(c) for c in columns))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("n_missing"), "n_rows") for c in columns))).alias("r")).select("r.*")


def top_examples(df: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """The first k rows of each group, k a few: the first of each part of a group, then of what is left, so a group of any
    size is spread over tasks."""
    spread, names = F.pmod(F.xxhash64(*df.columns), F.lit(256)), df.columns
    first = lambda rows, *keys: rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).drop("_n")
    return first(first(df.withColumn("_part", spread), group, "_part"), group).select(*names)


def field_histogram(df: DataFrame, fields: str) -> DataFrame:
    return df.select(F.explode(fields).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def group_sizes(df: DataFrame, group: Column | str) -> DataFrame:
    """One row: groups, rows, and the least and most rows of a group."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("groups"), F.sum("n").alias("rows"), F.min("n").alias("least"), F.max("n").alias("most"))


def status(flagged: Column) -> Column:
    """needs_review if any row is flagged, else passed."""
    return F.when(F.coalesce(F.bool_or(flagged), F.lit(False)), "needs_review").otherwise("passed")


def union_sorted(parts: list[DataFrame], order: list[str]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.orderBy(*order)


def by_split(df: DataFrame, split: str, order: str) -> DataFrame:
    """Rows in ranges of (split, input order), for a partitioned sink: a split of any size is several tasks'."""
    return df.repartitionByRange(split, order).sortWithinPartitions(split, order)


def markdown(rows: list[dict], columns: list[str]) -> str:
    """A table of a small report."""
    lines = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(str(r.get(c, "")) for c in columns) + " |" for r in rows]) + "\n"
