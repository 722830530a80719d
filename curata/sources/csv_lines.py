"""CSV files with quoted line breaks, read by many tasks.

A line begins in a quoted field or not, which depends on all lines before it. The first pass works out for each block of a
file in which state it ends, for both states that it may start in; a fold over the blocks gives the state at the start
of each; the second pass joins lines to records. Only records that cross an edge of a block move. A record has to fit
into a row; a file needn't fit anywhere.

Fields are read as Python's csv module reads them: quotes count at the start of a field only, doubled ones are one, and
line breaks within quotes stay as they are. The first record names the columns. Empty lines are no records; empty fields and
those that a record lacks are null, fields beyond the header are left out; of columns of one name the last counts. A quoted field that
is never closed ends with the file, without the file's last line break.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.json_text import ROW
from curata.operators.storage import fixed

#: Bits of a place within a block; the block's number stands before them.
PLACE_BITS = 40
#: Blocks of one call: their states, some hundred bytes each, go to every task.
MOST_BLOCKS = 1 << 20
#: Characters of a field at most.
FIELD_LIMIT = (1 << 31) - 1

_CHANGE = "doc bigint, file string, block bigint, ends0 int, ends1 int"
_START = "doc bigint, block bigint, number bigint, quoted int"
_RECORD = "doc bigint, at bigint, began boolean, ended boolean, text string"
_END = "\x00end"


def records_of(text: str) -> list[list[str]]:
    csv.field_size_limit(FIELD_LIMIT)
    return list(csv.reader(io.StringIO(text, newline="")))


def stays_open(line: str, quoted: int) -> int:
    """Whether a line, begun in a quoted field or not, ends within one."""
    if '"' not in line:
        return quoted
    return int(records_of(('"' if quoted else "") + line + "\n" + _END)[-1] != [_END])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(F.xxhash64("_metadata.file_path").alias("doc"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own: tuple | None = None
    ends = [0, 1]

    def out() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*own, *ends), kinds, strict=True)], names=[c.split()[0] for c in _CHANGE.split(", ")])

    for b in batches:
        for key in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if own != key[:3]:
                if own:
                    yield out()
                own, ends = key[:3], [0, 1]
            if '"' in key[3]:
                ends = [stays_open(key[3], e) for e in ends]
    if own:
        yield out()


def _starts(blocks: pd.DataFrame) -> pd.DataFrame:
    """Of one file's blocks: whether each begins in a quoted field."""
    quoted, rows = 0, []
    for number, b in enumerate(blocks.sort_values("block").itertuples()):
        rows.append((b.doc, b.block, number, quoted))
        quoted = b.ends1 if quoted else b.ends0
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _START.split(", ")])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block: whole ones, the rest of one that began before, and the start of one that goes on."""
    own: tuple | None = None
    quoted, seen, at, began = 0, 0, 0, True
    waiting: list[str] = []
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _RECORD.split(", ")])

    for b in batches:
        for doc, block, value, number, starts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if number is None:
                raise ValueError("the blocks of the file are other ones than before: it, or the session's settings, have changed")
            if own != (doc, block):
                if waiting:
                    rows.append((own[0], at, began, False, "".join(waiting)))
                own, quoted, seen, waiting = (doc, block), starts, 0, []
                at, began = number << PLACE_BITS, not starts
            ends = stays_open(value, quoted)
            waiting.append(value + "\n")
            seen += len(value) + 1
            if not ends:
                rows.append((doc, at, began, True, "".join(waiting)))
                waiting, began, at = [], True, (number << PLACE_BITS) + seen
            quoted = ends
        if rows:
            yield out()
            rows = []
    if waiting:
        rows.append((own[0], at, began, False, "".join(waiting)))
        yield out()


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, ord (by place in the file), fields (array of string) of every record, the header and empty lines included. Written to the
    shared folder, as it takes two passes over the same blocks."""
    lines = _lines(spark, path)
    changes = fixed(lines.mapInArrow(_changes, _CHANGE))  # a row a block
    if changes.count() > MOST_BLOCKS:
        raise ValueError(f"over {MOST_BLOCKS} blocks: read the files in several calls")
    starts = changes.groupBy("doc").applyInPandas(_starts, _START)
    # broadcast for its bound, and because a shuffle would lose the order of the lines
    placed = lines.select("doc", "block", "value").join(F.broadcast(starts), ["doc", "block"], "left").select("doc", "block", "value", "number", "quoted")
    found = fixed(placed.mapInArrow(_records, _RECORD))
    whole, edges = found.where("began and ended"), found.where("not began or not ended")
    order = Window.partitionBy("doc").orderBy("at")
    groups = edges.withColumn("_group", F.sum(F.col("began").cast("bigint")).over(order))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"])
    joined = groups.groupBy("doc", "_group").agg(F.min("at").alias("_at"), F.array_join(texts, "").alias("text"), F.max_by("ended", "at").alias("closed"))
    joined = joined.select("doc", F.col("_at").alias("at"), F.when(F.col("closed"), F.col("text")).otherwise(F.regexp_replace("text", "\n\\z", "")).alias("text"))

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def parsed(values: pa.Array) -> pa.Array:
        return pa.array([records_of(v) for v in values.to_pylist()], pa.list_(pa.list_(pa.string())))

    every = whole.select("doc", "at", "text").unionByName(joined).join(F.broadcast(changes.select("doc", "file").distinct()), "doc")
    # a record of a file may hold others that end in a bare carriage return; each takes a character at least
    text = F.when(F.col("at") == 0, F.regexp_replace("text", "^﻿", "")).otherwise(F.col("text"))
    return every.select("file", "at", F.posexplode(parsed(text)).alias("n", "fields")).select("file", (F.col("at") + F.col("n")).alias("ord"), "fields")


def rows(spark: SparkSession, path: str) -> DataFrame:
    """row (map<string,string>) and ord of every record but the first of each file, by the names in the first."""
    every = fixed(records(spark, path))
    headers = every.groupBy("file").agg(F.min_by("fields", "ord").alias("names"), F.min("ord").alias("_first"))
    joined = every.join(headers, "file").where("ord > _first and size(fields) > 0")
    field = lambda i: F.when(F.get("fields", i) != "", F.get("fields", i))
    pairs = F.transform(F.col("names"), lambda n, i: F.struct(n.alias("key"), field(i).alias("value"), i.alias("i")))
    last = F.filter(pairs, lambda p: ~F.exists(pairs, lambda o: (o["key"] == p["key"]) & (o["i"] > p["i"])))
    plain = F.map_from_arrays("names", F.transform(F.col("names"), lambda n, i: field(i)))
    doubled = F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"])))
    row = F.when(F.size(F.array_distinct("names")) == F.size("names"), plain).otherwise(doubled)
    return joined.select(row.cast(ROW).alias("row"), "ord")
