"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs
of the next. All but the last return the columns of documents, with the text as it is after the stage. Texts are taken
whole; further columns of the input are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import bpe, decontaminate, jaccard, line_dedup, quality
from curata.llm.common import remove_written, table, tables_written, written
from curata.llm.op9_bpe import default_vocabulary
from curata.operators import sampling

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    out = docs.withColumn("text", F.col(text)).withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("bigint"))
    return out.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go, and documents that are rejected: those of a null or empty text too.

    Rows are judged one by one, repeated ones alike, without or with a doc_id. An empty table stays empty.
    """
    judged = quality.judged(docs.select(*COLUMNS))
    # a list of one text or none: a filter on `kept` would be pushed down and work all rules out again
    left = judged.select("doc_id", "lang", "source", "n_chars", F.explode(F.when(F.col("kept"), F.array("clean_text"))).alias("text"))
    return _with_text(left, "text")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a line found in ten documents or more, the first stays; a document with no word left goes.

    First is the smallest doc_id (null before all), then the text's hash, then the place; documents count by doc_id, of
    which null is one. Rows equal in doc_id and text are treated alike. An empty table stays empty.
    """
    cleaned = line_dedup.drop_lines(docs.select(*COLUMNS), least_docs=10, keep_first=True)
    return _with_text(cleaned.where(quality.has_word(F.col("text"))), "text")


def _least(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with the same keys, the one whose other columns come first."""
    rest = [c for c in COLUMNS if c not in keys]
    return docs.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles, the one with the smallest doc_id stays.

    Of rows equal in doc_id and text one stays, the least by its other columns; a null text equals an empty one there, and
    links with nothing. Rows of one doc_id with different texts are documents of their own; of those that are linked, the
    first by text stays. Rows without a doc_id stay, all of them. An empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    named = docs.where(F.col("doc_id").isNotNull())
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    several = named.groupBy("doc_id").agg(F.min(key).alias("least"), F.max(key).alias("most")).where("least < most")
    if several.isEmpty():
        classes = jaccard.classes(docs.select("doc_id", "text"), percent=80, shingle=5)
        others = classes.where("doc_id <> component_id").select("doc_id").distinct()
        kept = _least(named.join(others, "doc_id", "left_anti"), ["doc_id"])
    else:
        # numbers in order of doc_id and text stand in for doc_id
        texts = _least(named.withColumn("text", F.coalesce("text", F.lit(""))), ["doc_id", "text"])
        numbered = written(sampling.with_ordinal(texts, ["doc_id", "text"], "_row"), "pipeline-rows")
        classes = jaccard.classes(numbered.select("_row", "text"), percent=80, shingle=5, doc_id="_row")
        others = classes.where("doc_id <> component_id").select(F.col("doc_id").alias("_row"))
        kept = numbered.join(others, "_row", "left_anti")
    return kept.select(*COLUMNS).unionByName(docs.where(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's question and answer go, by their text: doc_id may be null or repeat.

    Rows of one text go or stay together; a null text holds nothing. An empty table, of documents or items, changes nothing.
    """
    keyed = docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"))
    leaks = decontaminate.leaks(keyed.select("_text", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"), threshold=0.6, least_overlap=0.8, doc_id="_text")
    return keyed.join(leaks.select(F.col("doc_id").alias("_text")).distinct(), "_text", "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text back.

    A null text has no ids and comes back as the empty one. Rows are encoded one by one, repeated ones alike.
    """
    done = bpe.encode(docs.select("doc_id", "lang", "source", "text"), default_vocabulary(), check=True)
    return done.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "round_trip", "token_ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: SQL can't express the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. The tables of a stage, its operator's included, go once the next one is written; tables that
    the process wrote before stay."""
    before = tables_written()
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{i}")
        remove_written(spark, docs, *before)
    return docs
