"""Checks of translation outputs that other tools have written: a JSONL file of rows, the folder of one benchmark, or a
folder of benchmarks with a summary."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import json_text, nested, text
from curata.functions.fields import present
from curata.operators import audit, validate
from curata.operators.storage import fixed
from curata.sinks import writers
from curata.sources import bundles, readers

#: Documents that a benchmark's folder must hold beside its rows.
REQUIRED = ("translation_smoke.jsonl", "untranslated_fields.json", "inspection_examples.json", "translation_validation.json", "translation_smoke_summary.json")


def _leaves(translated: Column) -> Column:
    """Array of struct(path, text) of a translated object's strings: those of an object below a key under both names,
    those of a list, or of what lies deeper, under the name of the field."""
    texts = lambda v: F.when(json_text.starts(v, "{") | json_text.starts(v, "["), nested.json_leaves(v)).otherwise(F.array(v))
    of = lambda path, v: F.transform(F.filter(texts(v), lambda t: text.trimmed(t) != ""), lambda t: F.struct(path.alias("path"), t.alias("text")))
    below = lambda e: F.flatten(F.transform(F.map_entries(F.from_json(e["value"], json_text.ROW)), lambda x: of(F.concat(e["key"], F.lit("."), x["key"]), x["value"])))
    return F.flatten(F.transform(F.map_entries(translated), lambda e: F.when(json_text.starts(e["value"], "{"), below(e)).otherwise(of(e["key"], e["value"]))))


def _n_options(options: Column) -> Column:
    """Options of a list, of an object, or of a text of several lines that all have a label."""
    return F.coalesce(nested.json_option_count(options), text.option_count(options))


def row_checks(lines: DataFrame) -> DataFrame:
    """file, place, error of rows (file, place, value: canonical JSON text), whatever tool wrote them."""
    # written, step by step: the long expressions of one step would else be copied into each place of the next
    p = bundles.parts(F.col("value"))
    base = fixed(lines.select("file", "place", p["own"].alias("own"), p["source_record"].alias("source_record"), p["source_texts"].alias("source_texts"), p["translated"].alias("texts")))
    own, c = F.col("own"), F.col
    listed = F.when(json_text.starts(own["missing_translation_scope"], "["), own["missing_translation_scope"])
    translated = F.when(json_text.starts(own["translated"], "{"), F.from_json(own["translated"], json_text.ROW))
    found = fixed(base.select("file", "place", "own", translated.alias("translated"), bundles.options_of({n: c(n) for n in ("source_texts", "source_record", "own")}).alias("options"), bundles.options_in(c("texts")).alias("done")))
    none = F.array().cast("array<string>")
    rows = fixed(found.select(
        F.struct("file", "place").alias("key"), "translated", F.coalesce(F.from_json(listed, "array<string>"), none).alias("missing"), own["source"].alias("source"), own["source_id"].alias("source_id"), own["benchmark_id"].alias("benchmark_id"),
        F.coalesce(_leaves(c("translated")), F.array().cast("array<struct<path:string,text:string>>")).alias("leaves"),
        F.when(json_text.starts(own["source"], "{"), _n_options(c("options"))).alias("n_source"), _n_options(c("done")).alias("n_translated"),
    ))
    errors = validate.row_errors(rows, "key", "translated", "missing", "source", "source_id", "benchmark_id", "leaves", "n_source", "n_translated")
    return errors.select("key.file", "key.place", "error")


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, place, value of every row; an error for what is no JSON."""
    text_lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"), "value").where(F.trim("value") != "")
    return text_lines.withColumn("value", bundles.checked(F.col("value")))


def _folder(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Files of rows of a folder of benchmarks, and what is wrong with the folder itself."""
    errors: list[str] = []
    summary = bundles.document(spark, f"{path}/{bundles.SUMMARY}")
    if not summary:
        errors.append(f"no {bundles.SUMMARY}")
    listed = [str(b) for b in summary.get("benchmarks", [])]
    if summary and not listed:
        errors.append("the summary has no benchmarks")
    there = sorted(n for n in writers.names(spark, path) if writers.exists(spark, f"{path}/{n}/{bundles.ROWS}"))
    if listed:
        errors += [f"no output of {b}" for b in sorted(set(listed) - set(there))] + [f"unexpected output: {b}" for b in sorted(set(there) - set(listed))]
    checked = [b for b in listed or there if b in there]
    if checked:
        found = readers.listing(spark, path).select(F.substring_index("path", "/", 1).alias("owner"), F.substring_index("path", "/", -1).alias("part")).where(F.col("owner").isin(checked))
        owners = spark.createDataFrame([(b,) for b in checked], "owner string")
        errors += sorted(f"{r['owner']}: no {r['part']}" for r in audit.required(owners, list(REQUIRED), found, "owner", "part").collect())
    for b in checked:
        said = bundles.document(spark, f"{path}/{b}/translation_smoke_summary.json").get("benchmark_id")
        if said != b:
            errors.append(f"{b}: the summary is of {said!r}")
    if not checked:
        errors.append("no output of any benchmark")
    return [f"{path}/{b}/{bundles.ROWS}" for b in checked], errors


def validate_output(spark: SparkSession, path: str, shown: int = 200) -> dict[str, Any]:
    """status, rows by file, the first `shown` errors and how many there are of a translation output."""
    path = path.rstrip("/")
    errors: list[str] = []
    several = False
    if not writers.is_folder(spark, path):
        files = [path]
    elif writers.exists(spark, f"{path}/{bundles.ROWS}"):
        files = [f"{path}/{bundles.ROWS}"]
    else:
        several = True
        files, errors = _folder(spark, path)
    if not files:
        return {"status": "failed", "rows": {}, "n_errors": len(errors), "errors": errors}
    lines = fixed(_lines(spark, files))
    owner = lambda file: F.regexp_extract(file, r"([^/]+)/[^/]+$", 1) if several else F.regexp_extract(file, r"([^/]+)$", 1)
    counts = {r["o"]: r["n"] for r in lines.groupBy(owner(F.col("file")).alias("o")).agg(F.count("*").alias("n")).collect()}
    names = [f.rsplit("/", 2)[-2] if several else f.rsplit("/", 1)[-1] for f in files]
    errors += [f"{n} has no rows" for n in names if not counts.get(n)]
    found = row_checks(lines)
    if several:
        own = F.get_json_object("value", "$.benchmark_id")
        mixed = lines.where(~own.eqNullSafe(owner(F.col("file")))).select("file", "place", F.concat(F.lit("the row is of "), F.coalesce(present(own), F.lit("no benchmark"))).alias("error"))
        found = found.unionByName(mixed)
    found = fixed(found.select(owner(F.col("file")).alias("owner"), "place", "error"))
    n_errors = len(errors) + found.count()
    errors += [f"{r['owner']} row {r['place']}: {r['error']}" for r in found.orderBy("owner", "place", "error").limit(max(0, shown - len(errors))).collect()]
    return {"status": "failed" if n_errors else "passed", "rows": {n: counts.get(n, 0) for n in names}, "n_errors": n_errors, "errors": errors[:shown]}
