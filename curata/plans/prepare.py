"""Sources as they are downloaded, made into the folders that the jobs read: rows as JSONL, media as files, a manifest."""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import plain
from curata.functions.identity import safe_part
from curata.operators import media
from curata.operators.storage import fixed
from curata.sinks import writers
from curata.sources import archives, readers

# Source columns of each prepared key.
MME_KEYS = {
    "task": "Task", "subtask": "Subtask", "category": "Category", "source_dataset": "Dataset", "question_type": "Question Type", "question": "Text",
    "choices": "Answer choices", "answer": "Ground truth",
}


def _counts(df: DataFrame, column: Column) -> dict[str, int]:
    return {r["k"]: r["n"] for r in df.groupBy(column.alias("k")).agg(F.count("*").alias("n")).orderBy("k").collect()}


def _filled(value: Column) -> Column:
    return F.coalesce(F.when(value.cast("string") != "", value.cast("string")), F.lit(""))


def write_blobs(blobs: DataFrame, root: str) -> DataFrame:
    """path, status (written or reused) of payloads (path below root, payload), written aside and renamed by executors."""
    root = writers.shared_folder(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = []
            for path, payload in zip(b.column(0), b.column(1), strict=True):
                target, data = f"{root}/{path.as_py()}", payload.as_py()
                same = os.path.exists(target) and os.path.getsize(target) == len(data)
                if not same:
                    archives.write_aside(target, [data])
                ends.append((path.as_py(), "reused" if same else "written"))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in ends], pa.string()), pa.array([s for _, s in ends], pa.string())], names=["path", "status"])

    return blobs.select("path", "payload").mapInArrow(run, "path string, status string")


def blink(spark: SparkSession, source: str, out: str) -> dict[str, Any]:
    """Rows and images of parquet files in folders named by task; returns the manifest that it writes."""
    out = out.rstrip("/")
    raw = readers.read_blob_parquet(spark, source)
    have = {c.lower(): c for c in raw.columns}
    own = lambda name: F.col(have[name]) if name in have else F.lit(None).cast("string")
    name = F.coalesce(F.when(own("idx").cast("string") != "", own("idx").cast("string")), F.concat_ws("_", "split", "task", F.format_string("%06d", "row_index")))
    rows = fixed(raw.withColumn("_id", name))
    folder = F.concat_ws("/", F.lit("media"), safe_part(F.col("task")), safe_part(F.col("split")), safe_part(F.col("_id")))
    file = lambda x, i: F.concat(folder, F.lit("/image_"), (i + 1).cast("string"), media.image_suffix(F.coalesce(x["path"], F.lit("")), x["bytes"]))
    paths = F.transform(F.filter("images", lambda x: F.octet_length(x["bytes"]) > 0), file)
    first = lambda *names: F.coalesce(*(F.when(own(n).cast("string") != "", own(n).cast("string")) for n in names), F.lit(""))
    choices = F.to_json(own("choices")) if "choices" in have and dict(raw.dtypes)[have["choices"]].startswith("array") else F.lit("[]")
    records = rows.select(
        F.col("_id").alias("id"), F.col("_id").alias("idx"), "split", F.col("split").alias("source_split"), F.col("task").alias("source_hf_config"), "task",
        F.coalesce(F.when(own("sub_task").cast("string") != "", own("sub_task").cast("string")), F.col("task")).alias("subtask"), first("question", "prompt").alias("question"),
        F.from_json(choices, "array<string>").alias("choices"), first("answer").alias("answer"), first("prompt").alias("instruction"), first("explanation").alias("explanation"), paths.alias("image_paths"),
    )
    images = rows.select(F.explode(F.transform(F.filter("images", lambda x: F.octet_length(x["bytes"]) > 0), lambda x, i: F.struct(file(x, i).alias("path"), x["bytes"].alias("payload")))).alias("f")).select("f.*")
    done = fixed(write_blobs(images, out))
    lines = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
    writers.write_lines(lines, f"{out}/samples.jsonl")
    status = {r["status"]: r["n"] for r in done.groupBy("status").agg(F.count("*").alias("n")).collect()}
    manifest = {
        "created_at": plain.stamp(), "benchmark_id": "blink", "source_root": source, "record_file": f"{out}/samples.jsonl", "rows": records.count(), "media_files_referenced": sum(status.values()),
        "media_files_written": status.get("written", 0), "media_files_reused": status.get("reused", 0), "source_splits": _counts(records, F.col("split")), "tasks": _counts(records, F.col("task")), "status": "passed",
    }
    writers.write_report(spark, manifest, f"{out}/source_manifest.json")
    return manifest


def mme(spark: SparkSession, source: str, out: str, extract: bool = False) -> dict[str, Any]:
    """Rows under the prepared keys, and on request the media that they name, from the source's tar archives."""
    source, out = source.rstrip("/"), out.rstrip("/")
    raw = readers.read_json(spark, f"{source}/MME_RealWorld.json")
    if raw.isEmpty():
        raise FileNotFoundError(f"no rows in {source}/MME_RealWorld.json")
    row = F.col("row")
    member = media.safe_member(F.coalesce(row["Image"], F.lit("")))
    rows = fixed(raw.withColumn("member", member))
    if not (unsafe := rows.where("member is null")).isEmpty():
        raise ValueError(f"unsafe member: {unsafe.first()['row'].get('Image')!r}")
    own = F.coalesce(F.when(row["Question_id"] != "", row["Question_id"]), F.format_string("mme_realworld-%06d", "ord"))
    choices = F.coalesce(F.from_json(row["Answer choices"], "array<string>"), F.array().cast("array<string>"))
    records = rows.select(
        "ord", own.alias("id"), own.alias("question_id"), F.lit("test").alias("split"), F.lit("test").alias("source_split"), *(choices.alias(k) if k == "choices" else _filled(row[v]).alias(k) for k, v in MME_KEYS.items()),
        F.concat(F.lit("media/"), "member").alias("image_path"), F.col("member").alias("source_image"), row.alias("source_record"),
    )
    wanted = rows.select(F.substring_index("member", "/", 1).alias("stem"), "member").distinct()
    root = f"{out}/media"
    extraction: dict[str, Any] = {}
    if extract:
        files = archives.listing(spark, source, "*.tar.gz*")
        done = archives.extract_tar(readers.archive_groups(files), wanted, root)
        extraction = {r["stem"]: {"status": r["status"], "needed": r["n_wanted"], "missing": r["n_wanted"] - r["n_there"]} for r in done.orderBy("stem").collect()}
    lines = records.orderBy("ord").drop("ord")
    writers.write_lines(lines.select(F.to_json(F.struct(*lines.columns)).alias("value")), f"{out}/samples.jsonl")
    there = readers.listing(spark, f"{out}/media").select(F.col("path").alias("member")) if writers.exists(spark, f"{out}/media") else spark.createDataFrame([], "member string")
    lost = records.select(F.col("source_image").alias("member")).join(there, "member", "left_anti").count()
    manifest = {
        "created_at": plain.stamp(), "benchmark_id": "mme_realworld", "source_root": source, "record_file": f"{out}/samples.jsonl", "rows": records.count(), "source_image_prefixes": _counts(rows, F.substring_index("member", "/", 1)),
        "tasks": _counts(records, F.coalesce(F.when(F.col("subtask") != "", F.col("subtask")), F.when(F.col("task") != "", F.col("task")), F.lit("unknown"))),
        "media_extraction": extraction, "missing_media_after_prepare": lost, "status": "passed" if not lost else "needs_media",
    }
    writers.write_report(spark, manifest, f"{out}/source_manifest.json")
    return manifest
