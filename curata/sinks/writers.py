"""Sinks: JSONL and parquet by split, reports, appended outputs."""

from __future__ import annotations

import itertools
import json
import os
import posixpath
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Bytes that a task copies into a file at a time.
RANGE_BYTES = 64 << 20


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as one line of JSON: keys sorted, nulls kept."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str, split: str = "split", mode: str = "errorifexists") -> None:
    """One folder a split; the split stays in the lines too."""
    lines = json_lines(df).select("value", F.get_json_object("value", f"$.{split}").alias("_split"))
    lines.write.mode(mode).partitionBy("_split").text(path)


def write_dataset(df: DataFrame, path: str, schema, split: str = "split", mode: str = "errorifexists") -> None:
    """Parquet of a fixed schema, one folder a split; tasks take ranges of (split, hash), so no split is one task's."""
    typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
    typed.repartitionByRange(F.col(split), F.xxhash64(*typed.columns)).write.mode(mode).partitionBy(split).parquet(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """More committed files beside those that are there; a failed job leaves none."""
    json_lines(df).write.mode("append").text(path)


def report_json(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2) + "\n"


def write_report(spark, value: Any, path: str) -> None:
    """A small document through Spark's own file systems: written aside, then renamed."""
    write_text(spark, report_json(value), path)


def _place(spark, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark, path: str) -> bool:
    fs, target = _place(spark, path)
    return fs.exists(target)


def is_folder(spark, path: str) -> bool:
    fs, target = _place(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def names(spark, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, target = _place(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def clear(spark, path: str, overwrite: bool) -> None:
    """An output folder ready to be written: absent or emptied, if overwriting is allowed."""
    if not is_empty_dir(spark, path):
        if not overwrite:
            raise FileExistsError(path)
        fs, target = _place(spark, path)
        fs.delete(target, True)


def safe_output(spark, path: str, sources: list[str], overwrite: bool = False) -> None:
    """Refuses an output that lies in a source or holds one, or that isn't empty without overwrite."""
    if inside := [s for s in sources if not disjoint(path, s)]:
        raise ValueError(f"{path} and {', '.join(inside)} lie in one another")
    if not overwrite and not is_empty_dir(spark, path):
        raise FileExistsError(path)


def write_text(spark, text: str, path: str) -> None:
    """A small text file, written aside and renamed."""
    fs, target = _place(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(aside, target):
        raise OSError(f"can't write {path}")


def shared_folder(path: str) -> str:
    """The path as executors open it, for files that they write themselves; an error for a store, where they would write
    to their own disks instead."""
    scheme, rest = _parts(path)
    if scheme:
        raise ValueError(f"{path}: executors write these files themselves, so they need a folder that all of them share, not a store")
    return rest


def fill(target: str, ranges: DataFrame) -> DataFrame:
    """bytes written by each task into a file of its full length, from ranges (source, start, size, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            with open(target, "r+b") as out:
                for source, start, size, place in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    out.seek(place)
                    with open(source, "rb") as part:
                        part.seek(start)
                        while size > 0 and (piece := part.read(min(size, 1 << 20))):
                            out.write(piece)
                            size, done = size - len(piece), done + len(piece)
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["bytes"])

    return ranges.select("source", "start", "size", "place").mapInArrow(run, "bytes bigint")


def write_lines(lines: DataFrame, path: str) -> None:
    """One file of lines (value), in the order of the partitions, without its bytes passing the driver or any one task.

    Tasks write parts; sums of the parts' sizes give the place of each in the file. In a shared folder tasks then fill the
    file of its full length at their places, RANGE_BYTES at a time; a task that runs again writes the same bytes to the
    same place. A store that joins files itself does so. Another one is an error."""
    spark = lines.sparkSession
    aside, whole = f"{path}.parts-{uuid.uuid4().hex}", f"{path}.tmp-{uuid.uuid4().hex}"
    lines.select("value").write.text(aside)
    fs, folder = _place(spark, aside)
    parts = sorted((x.getPath().toString(), x.getLen()) for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-") and x.getLen())
    try:
        if _parts(path)[0]:
            _join_in_store(spark, [p for p, _ in parts], whole)
        else:
            _join_in_folder(spark, parts, shared_folder(whole))
        target = _place(spark, path)[1]
        fs.delete(target, False)
        if not fs.rename(_place(spark, whole)[1], target):
            raise OSError(f"can't write {path}")
    finally:
        fs.delete(folder, True)
        fs.delete(_place(spark, whole)[1], False)


def _join_in_folder(spark, parts: list[tuple[str, int]], target: str) -> None:
    sizes = [n for _, n in parts]
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    with open(target, "wb") as out:
        out.truncate(sum(sizes))
    if not parts:
        return
    places = [sum_ - n for sum_, n in zip(itertools.accumulate(sizes), sizes, strict=True)]
    rows = spark.createDataFrame([(shared_folder(p), n, at) for (p, n), at in zip(parts, places, strict=True)], "source string, length bigint, place bigint")  # a row a part
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(RANGE_BYTES).cast("bigint")))
    ranges = rows.select("source", "length", "place", starts.alias("start")).select("source", "start", F.least(F.lit(RANGE_BYTES), F.col("length") - F.col("start")).alias("size"), (F.col("place") + F.col("start")).alias("place"))
    tasks = max(1, min(sum(-(-n // RANGE_BYTES) for n in sizes), 10_000))
    written = fill(target, ranges.repartitionByRange(tasks, "place")).agg(F.sum("bytes")).first()[0]
    if written != sum(sizes):
        raise OSError(f"{written} of {sum(sizes)} bytes were written to {target}")


def _join_in_store(spark, parts: list[str], target: str) -> None:
    """By the store's own joining of files, which moves no bytes."""
    fs, whole = _place(spark, target)
    if not parts:
        fs.create(whole, True).close()
        return
    fs.rename(_place(spark, parts[0])[1], whole)
    if len(parts) > 1:
        more = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
        for i, p in enumerate(parts[1:]):
            more[i] = _place(spark, p)[1]
        try:
            fs.concat(whole, more)
        except Exception as e:
            raise ValueError(f"{target}: this store can't join files; write a folder of parts with write_jsonl") from e


def is_empty_dir(spark, path: str) -> bool:
    """Whether a folder is absent or has nothing in it, for sinks that refuse to mix outputs."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(target) or len(fs.listStatus(target)) == 0


def disjoint(a: str, b: str) -> bool:
    """Whether neither output tree lies in the other."""
    return not within(a, b) and not within(b, a)


def within(path: str, root: str) -> bool:
    """Whether a path is root or lies below it, with `.`, `..` and doubled slashes worked out."""
    (one, a), (two, b) = _parts(path), _parts(root)
    return one == two and (a == b or a.startswith(b.rstrip("/") + "/") or b == ".")


def _parts(path: str) -> tuple[str, str]:
    """The scheme of a path, "" for local files, and the rest in its shortest form."""
    scheme, mark, rest = path.partition("://")
    if not mark:
        scheme, rest = "", path.removeprefix("file:")
    return "" if scheme == "file" else scheme, posixpath.normpath(rest)


def viewer_rows(packages: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows of several packages in one order, as a viewer wants them."""
    from curata.operators.report import union_sorted

    return union_sorted([p.select(*columns) for p in packages], ["benchmark_id", "record_id"])
