"""Sources: JSON of several shapes, JSONL, CSV, parquet with blobs, listings of files and of archive members.

Raw rows are a map<string,string> column `row` (JSON text for values that aren't strings) with `ord`, the place in the
file. Everything is read by Spark, so any store that Spark reads will do; a file that is one JSON document is one row.
"""

from __future__ import annotations

import tomllib
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import json_text
from curata.functions.json_text import ROW
from curata.functions.nested import flatten_conversations
from curata.functions.text import is_image_file
from curata.sources import archives, csv_lines, json_document

#: Keys under which an object holds its list of rows, and file names that come first.
LIST_KEYS = ("data", "records", "rows", "questions", "annotations")
FIRST_FILES = ("metadata.csv", "mmad.json", "MMAD.json", "annotations.json")


def _numbered(lines: DataFrame) -> DataFrame:
    """row with an ordinal that follows file and place in it; dense within a partition only."""
    return lines.withColumn("ord", F.monotonically_increasing_id())


def _object(text: Column) -> Column:
    """A row of JSON text that is an object; null for anything else."""
    return json_text.object_of(json_text.canonical(text))


def read_jsonl(spark: SparkSession, path: str | list[str], mode: str = "objects") -> DataFrame:
    """Rows of a JSONL file; of doubled keys the last value counts. mode: "objects" drops other lines, "any" keeps them as
    text under "value", "strict" fails."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("row", _object(F.col("value")))
    if mode == "strict":
        bad = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 80)))
        lines = lines.withColumn("row", F.coalesce("row", bad.cast(ROW)))
    elif mode == "any":
        lines = lines.withColumn("row", F.coalesce("row", F.create_map(F.lit("value"), F.col("value"))))
    return _numbered(lines.where("row is not null").select("row"))


def count_jsonl(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where(F.trim("value") != "").count()


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON documents: a list's objects; those of the first list under one of LIST_KEYS; an object of objects as
    conversations; any other object as one row; none for a scalar. What is no JSON is an error.

    A document of any size is read by many tasks (sources.json_document); of doubled keys the last value counts, in the
    first one's place. ord follows the places in the file.
    """
    parts = json_document.elements(spark, path)
    object_rows = lambda df: df.where(json_text.starts(F.col("text"), "{")).select(json_text.object_of(F.col("text")).alias("row"), "ord")
    items = object_rows(parts.where("role = 'item'"))
    members = parts.where("role in ('value', 'list')")
    last = members.groupBy("file", "key").agg(F.max("key_ord").alias("key_ord"), F.min("key_ord").alias("place"), F.max_by("role", "key_ord").alias("role"), F.max_by("text", "key_ord").alias("text"))
    rank = F.coalesce(*(F.when(F.col("key") == k, i) for i, k in enumerate(LIST_KEYS)))
    chosen = last.where((F.col("role") == "list") & rank.isNotNull()).groupBy("file").agg(F.min_by("key_ord", rank).alias("key_ord"))
    in_lists = parts.where("role = 'list_item'")
    listed = object_rows(in_lists.join(chosen, ["file", "key_ord"], "left_semi"))
    # objects without such a list
    rest = last.join(chosen.select("file"), "file", "left_anti")
    nested = rest.groupBy("file").agg(F.every((F.col("role") == "value") & json_text.starts(F.col("text"), "{")).alias("all")).where("all").select("file")
    turns = flatten_conversations(rest.join(nested, "file", "left_semi").select(F.struct("file", "place", F.col("key").alias("image_key")).alias("key"), F.col("text").alias("document")), "key", "document")
    # what a row has itself comes before what it gets from its place
    placed = {"query_image": F.col("key.image_key"), "mmad_image_key": F.col("key.image_key"), "conversation_index": F.col("conversation_index").cast("string")}
    extra = F.map_filter(F.create_map(*(x for k, v in placed.items() for x in (F.lit(k), v))), lambda k, v: v.isNotNull() & ~F.map_contains_key(F.col("row"), k))
    # a turn takes some bytes of its document, so the next one's place is beyond all of them
    flat = turns.select(F.map_concat(extra, "row").alias("row"), (F.col("key.place") + F.coalesce("conversation_index", F.lit(0))).alias("ord"))
    # one row: objects with other values, and those whose conversations have no turn at all
    alone = rest.join(turns.select(F.col("key.file").alias("file")).distinct(), "file", "left_anti")
    lists = in_lists.groupBy("file", "key_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), ",").alias("items"))
    whole = alone.join(lists, ["file", "key_ord"], "left").withColumn("text", F.when(F.col("role") == "list", F.concat(F.lit("["), F.coalesce("items", F.lit("")), F.lit("]"))).otherwise(F.col("text")))
    value = F.from_json(F.concat(F.lit('{"v":'), "text", F.lit("}")), ROW)["v"]
    pairs = F.array_sort(F.collect_list(F.struct("place", "key", value.alias("value"))))
    single = whole.groupBy("file").agg(F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["key"], p["value"]))).alias("row"), F.min("place").alias("ord")).select("row", "ord")
    empty = parts.where("role = 'empty'").select(F.create_map().cast(ROW).alias("row"), "ord")
    return items.unionByName(listed).unionByName(flat).unionByName(single).unionByName(empty)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files with a header: every value a string, quoted line breaks kept, a byte-order mark skipped; a file of
    any size is read by many tasks (sources.csv_lines)."""
    return csv_lines.rows(spark, path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """By suffix; a file of another kind has no rows."""
    suffix = path.rsplit(".", 1)[-1].lower()
    readers = {"jsonl": read_jsonl, "json": read_json, "csv": read_csv}
    return readers[suffix](spark, path) if suffix in readers else spark.createDataFrame([], f"row {ROW}, ord bigint")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path (below root), length of every file; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    below = F.regexp_replace(F.regexp_replace("path", r"^[a-z]+:/*", "/"), "^.*?" + _quoted(root.split(":", 1)[-1].strip("/")) + "/", "")
    return df.select(below.alias("path"), "length")


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def images(files: DataFrame) -> DataFrame:
    return files.where(is_image_file(F.col("path")))


def candidate_files(files: DataFrame, registered: tuple[str, ...] | None = None) -> list[str]:
    """Record files of a listing, best first: by the rank of their names, then by path. Without registered names, any
    record file will do if no ranked one is there."""
    names = registered or FIRST_FILES
    name = F.substring_index("path", "/", -1)
    rank = F.coalesce(*(F.when(name == n, i) for i, n in enumerate(names)))
    ranked = [r["path"] for r in files.where(rank.isNotNull()).orderBy(rank, "path").select("path").collect()]
    if ranked or registered:
        return ranked
    return [r["path"] for r in files.where(F.rlike("path", F.lit(r"(?i)\.(?:json|jsonl|csv)$"))).orderBy("path").select("path").collect()]


def load_first(spark: SparkSession, root: str, registered: tuple[str, ...] | None = None) -> tuple[str | None, DataFrame]:
    """The first candidate with a row, and its rows. Without registered names, one that can't be read is passed over."""
    for path in candidate_files(listing(spark, root), registered):
        try:
            df = read_records(spark, f"{root.rstrip('/')}/{path}")
            if not df.isEmpty():
                return path, df
        except Exception:  # noqa: BLE001
            if registered:
                raise
    return None, spark.createDataFrame([], f"row {ROW}, ord bigint")


def read_blob_parquet(spark: SparkSession, root: str) -> DataFrame:
    """Rows of parquet files in folders named by task, with a split before the first dash of the file name: task, split,
    images (array of struct bytes, path) of the columns image_1, image_2, ..., and row_index, the place in the file."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)
    blobs = sorted((c for c in df.columns if c.startswith("image_")), key=lambda c: int(c.removeprefix("image_")))
    path = F.col("_metadata.file_path")
    kept = [c for c in df.columns if c not in blobs]
    return df.select(*kept, F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("task"), F.regexp_extract(path, r"/([^/-]+)[^/]*$", 1).alias("split"), F.array_compact(F.array(*blobs)).alias("images"), F.col("_metadata.row_index").alias("row_index"))


def rename_rows(df: DataFrame, names: dict[str, str], benchmark_id: str) -> DataFrame:
    """Raw rows under new key names, with an id from the ordinal where they have none."""
    renamed = F.map_from_entries(F.transform(F.map_entries("row"), lambda e: F.struct(F.coalesce(F.create_map(*(F.lit(x) for p in names.items() for x in p))[e["key"]], e["key"]).alias("key"), e["value"].alias("value"))))
    filled = F.when(F.coalesce(renamed["id"], F.lit("")) != "", renamed).otherwise(F.map_concat(F.map_filter(renamed, lambda k, v: k != "id"), F.create_map(F.lit("id"), F.format_string(f"{benchmark_id}-%06d", "ord"))))
    return df.withColumn("row", filled)


def archive_groups(files: DataFrame) -> DataFrame:
    """stem, parts (sorted): tar archives, whose parts take the place of a single file of the name."""
    stem, part = F.regexp_extract("path", r"([^/]+)\.tar\.gz(?:\.part_[^/]*)?$", 1), F.rlike("path", F.lit(r"\.part_[^/]*$"))
    rows = files.where(stem != "").select(stem.alias("stem"), part.alias("part"), "path")
    lists = rows.groupBy("stem").agg(F.array_sort(F.collect_list(F.when(F.col("part"), F.col("path")))).alias("p"), F.array_sort(F.collect_list(F.when(~F.col("part"), F.col("path")))).alias("w"))
    return lists.select("stem", F.when(F.size("p") > 0, F.col("p")).otherwise(F.col("w")).alias("parts"))


def archive_members(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """archive, valid, member of each zip or tar file below root; an archive that can't be read has no members."""
    return archives.members(archives.listing(spark, root, pattern)).select("archive", "valid", "member")


def load_config(text: str) -> dict[str, Any]:
    return tomllib.loads(text)
