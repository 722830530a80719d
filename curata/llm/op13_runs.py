"""op13: periodic runs of words in every document, and the documents with their repeats collapsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import periodic_runs
from curata.llm.common import table


def planted(doc_id: Column, text: Column) -> Column:
    """The text as it is, or, for one doc_id in ten, its words with a tail that repeats itself; without a doc_id as it is."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / F.lit(10))
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    # transform over a list of one: the words are split once
    tail = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))), 0)
    return F.when(h % 10 == 0, tail).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("collapsed")), text="collapsed", least_words=24, least_repeats=3)
    none = F.lit(None).cast(periodic_runs.RUN)
    # of equal exponents the first stays: runs are in order of start and period
    best = F.aggregate("runs", none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
#: SQL would compare every word with all words before it.
SQL: dict[str, str] = {}
