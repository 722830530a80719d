"""Translation bundles as others wrote them: which files hold rows, and rows whose shape varies.

A row is a JSON object with `translated`, `source` and beside them fields of its own; each part may be flat or hold
text_fields, source_record and preserve_fields. Everything becomes the columns that plans.record.export takes.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import fields, json_text, nested
from curata.functions.fields import present
from curata.operators.storage import fixed
from curata.plans import specs
from curata.sinks import writers

# Names of a bundle's files.
SUMMARY, ROWS = "general_vqa_translation_summary.json", "translation_smoke.jsonl"
# Keys of each text field in rows of no known benchmark.
TEXT_KEYS = {"question": specs.QUESTION_KEYS, "options": specs.OPTION_KEYS, "caption": specs.CAPTION_KEYS, "instruction": specs.INSTRUCTION_KEYS}
ANSWERS = (*specs.ANSWER_KEYS, "target", "correct_answer")
_MAP = "map<string,string>"


def document(spark: SparkSession, path: str) -> dict[str, Any]:
    """A small JSON object; an empty one where there is no file."""
    if not writers.exists(spark, path):
        return {}
    found = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    return found if isinstance(found, dict) else {}


def row_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files of rows, in order and once each: a file is itself, a folder has those that its summary lists, or one of its
    own. What is missing is an error."""
    out: list[str] = []
    for path in (p.rstrip("/") for p in paths):
        if not writers.exists(spark, path):
            raise FileNotFoundError(path)
        if not writers.is_folder(spark, path):
            out.append(path)
        elif writers.exists(spark, f"{path}/{SUMMARY}"):
            out += [f"{path}/{b}/{ROWS}" for b in document(spark, f"{path}/{SUMMARY}").get("benchmarks", [])]
        else:
            out.append(f"{path}/{ROWS}")
    if lost := [p for p in out if not writers.exists(spark, p)]:
        raise FileNotFoundError(", ".join(lost))
    return list(dict.fromkeys(out))


def split_rows(spark: SparkSession, package: str, split: str) -> DataFrame:
    """value (JSON), ord of a package's split; without its metadata that is an error."""
    path = f"{package.rstrip('/')}/{split}/metadata.jsonl"
    if not writers.exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.text(path).where(F.trim("value") != "").withColumn("ord", F.monotonically_increasing_id())


def package_rows(spark: SparkSession, package: str) -> DataFrame:
    """split, value of all rows of a package: the splits of its manifest, else every folder with metadata."""
    listed = sorted(document(spark, f"{package}/manifest.json").get("splits", {}))
    splits = listed or [n for n in writers.names(spark, package) if writers.exists(spark, f"{package}/{n}/metadata.jsonl")]
    if not splits:
        raise FileNotFoundError(f"no splits in {package}")
    parts = [split_rows(spark, package, s).select(F.lit(s).alias("split"), "value") for s in splits]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _object(text: Column, *path: str) -> Column:
    """A JSON object below a key as a map of strings and JSON text; null for anything else."""
    found = text if not path else F.get_json_object(text, "$." + ".".join(path))
    return F.when(F.trim(found).startswith("{"), F.from_json(found, _MAP))


def _list(text: Column, key: str) -> Column:
    found = F.get_json_object(text, f"$.{key}")
    return F.coalesce(F.when(F.trim(found).startswith("["), F.from_json(found, "array<string>")), F.array().cast("array<string>"))


def _filled(m: Column) -> Column:
    return F.map_filter(m, lambda k, v: present(v).isNotNull())


def _first(m: Column, keys) -> Column:
    return fields.get_first(m, keys)["value"]


def parts(value: Column) -> dict[str, Column]:
    """translated, source_record, source_texts, preserve and answer of a row's JSON text."""
    empty = F.create_map().cast(_MAP)
    own, source = _object(value), F.coalesce(_object(value, "source"), empty)
    record = F.coalesce(_object(value, "source", "source_record"), source)
    named = F.array(*(F.struct(F.lit(n).alias("key"), _first(record, keys).alias("value")) for n, keys in TEXT_KEYS.items()))
    texts = F.coalesce(_object(value, "source", "text_fields"), F.map_from_entries(F.filter(named, lambda x: present(x["value"]).isNotNull())))
    nonempty = lambda m: F.when(F.size(m) > 0, m)
    kept = fields.copy_present(record, (*ANSWERS, "category", "dataset", "split"))
    preserve = F.coalesce(nonempty(_object(value, "preserve_fields")), nonempty(_object(value, "source", "preserve_fields")), kept)
    answer = F.coalesce(_first(preserve, ANSWERS), _first(record, ANSWERS))
    plain = F.when(F.rlike(answer, F.lit(r"^\s*[\[{]")), F.coalesce(present(nested.joined_text(nested.json_leaves(answer))), answer)).otherwise(answer)
    return {
        "translated": F.coalesce(_object(value, "translated", "text_fields"), _filled(F.coalesce(_object(value, "translated"), empty))), "source_record": record,
        "source_texts": texts, "preserve": preserve, "answer": F.coalesce(plain, F.lit("")), "own": F.coalesce(own, empty), "source": source,
    }


def checked(line: Column) -> Column:
    """A line of JSON as every function reads it; an error for what is none."""
    return F.coalesce(json_text.canonical(line), F.raise_error(F.concat(F.lit("not JSON: "), F.substring(line, 1, 80))).cast("string"))


def failure_id(own: Column, source: Column, ordinal: Column) -> Column:
    """What a failed row is called: its source id, else its source's id, else its place."""
    return F.coalesce(present(own["source_id"]), present(source["id"]), ordinal.cast("string"))


def options_in(m: Column) -> Column:
    """The options of a map, by the keys that they may have."""
    return _first(m, TEXT_KEYS["options"])


def options_of(p: dict[str, Column]) -> Column:
    """The options of a row: of its texts, else of its source record, else its own."""
    return F.coalesce(options_in(p["source_texts"]), options_in(p["source_record"]), options_in(p["own"]))


def adapted(spark: SparkSession, files: list[str], fallback_benchmark: str = "benchmark") -> DataFrame:
    """The rows of the files, in order, as plans.record.export takes them."""
    tables = [spark.read.text(f).where(F.trim("value") != "").select(F.lit(i).alias("file_idx"), F.lit(f).alias("path"), F.monotonically_increasing_id().alias("place"), checked(F.col("value")).alias("value")) for i, f in enumerate(files)]
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    rows = fixed(rows)  # the check of a line would else be copied into each place that reads it
    p = parts(F.col("value"))
    record, own, source = p["source_record"], p["own"], p["source"]
    benchmark = F.coalesce(present(own["benchmark_id"]), present(source["benchmark_id"]), F.lit(fallback_benchmark))
    value = lambda key: F.coalesce(present(own[key]), present(source[key]), present(record[key]))
    media = F.concat(_list(F.col("value"), "media"), _list(F.col("value"), "source.media"), F.array_compact(F.array(*(present(record[k]) for k in (*specs.PATH_KEYS, *specs.MORE_MEDIA_KEYS)))))
    return rows.select(
        "file_idx", "path", F.col("place").alias("ord"), benchmark.alias("benchmark_id"), F.coalesce(present(own["benchmark_name"]), benchmark).alias("benchmark_name"), value("source_id").alias("source_id"),
        value("split").alias("split"), value("task").alias("task"), nested.media_list(media).alias("media"), p["source_texts"].alias("text_fields"), p["preserve"].alias("preserve_fields"),
        F.coalesce(_object(F.col("value"), "skip_fields"), F.create_map().cast(_MAP)).alias("skip_fields"), F.map_keys(p["translated"]).alias("translation_scope"), record.alias("source_record"), p["translated"].alias("translated"),
    )
