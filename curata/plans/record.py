"""The record plans: raw row -> adapted record -> translated row -> export record of a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions import fields, identity, nested, redact, text
from curata.plans import specs

_S, _A = T.StringType(), T.ArrayType(T.StringType())

# Columns of an export record, in order.
EXPORT_COLUMNS = (
    "record_id", "dataset_name", "benchmark_id", "benchmark_name", "source_id", "split", "task", "media", "question_original",
    "options_original_json", "caption_original", "instruction_original", "question_ko", "options_ko_json", "caption_ko",
    "instruction_ko", "answer", "translated_text_fields_json", "preserve_fields_json", "skip_fields_json", "source_record_json",
    "translation_scope", "translation_artifact_path", "translation_run_id", "translation_qc_status", "translation_qc_report",
    "original_hf_dataset", "original_hf_config", "original_hf_revision", "exported_at", "export_schema_version",
)
EXPORT_SCHEMA = T.StructType([T.StructField(c, _A if c in ("media", "translation_scope") else T.LongType() if c == "export_schema_version" else _S) for c in EXPORT_COLUMNS])
# Columns of a public package row, those it must have, and those it must not have.
PACKAGE_COLUMNS = (
    "record_id", "source_record_id", "dataset_name", "benchmark_id", "benchmark_name", "source_id", "split", "source_split", "task",
    "file_name", "media_files", "primary_media_file", "media_original_refs_json", "question_original", "options_original_json",
    "caption_original", "instruction_original", "question_ko", "options_ko_json", "caption_ko", "instruction_ko", "answer",
    "preserve_fields_json", "skip_fields_json", "translation_scope", "translation_qc_status", "export_schema_version",
)
PACKAGE_REQUIRED = (
    "record_id", "source_record_id", "benchmark_id", "source_id", "split", "source_split", "file_name", "media_files",
    "question_original", "question_ko", "translation_qc_status",
)
PROCESS_COLUMNS = (
    "translation_artifact_path", "translation_run_id", "translation_qc_report", "source_record_json", "exported_at",
    "original_hf_dataset", "original_hf_config", "original_hf_revision",
)
QC_STATUS = ("unchecked", "passed", "failed", "needs_review")


def adapt(df: DataFrame, benchmark_id: str, row: str = "row", ordinal: str = "ord") -> DataFrame:
    """benchmark_id, benchmark_name, source_id, split, task, media, text_fields, preserve_fields, skip_fields,
    translation_scope, source_record of raw rows (map<string,string>) with an ordinal."""
    r, spec = F.col(row), specs.SPECS[benchmark_id]
    value = lambda keys: fields.get_first(r, keys)["value"]
    texts = fields.text_fields(r, spec)
    none = F.when(F.size(texts) == 0, F.array(F.lit("text_fields"))).otherwise(F.array().cast("array<string>"))
    media = F.concat(*(F.when(fields.present(r[k]).isNotNull(), F.coalesce(nested.media_objects(r[k]), F.array(r[k]))).otherwise(F.array().cast("array<string>")) for k in spec.keys("media")))
    out = df.select(
        F.col(ordinal), F.lit(benchmark_id).alias("benchmark_id"), F.lit(spec.name).alias("benchmark_name"),
        F.coalesce(value(spec.keys("id")), F.format_string(f"{benchmark_id}-%06d", ordinal)).alias("source_id"),
        value(spec.keys("split")).alias("split"), value(spec.keys("task")).alias("task"), media.alias("media"), texts.alias("text_fields"),
        fields.copy_present(r, spec.keys("preserve")).alias("preserve_fields"), fields.copy_present(r, spec.keys("skip")).alias("skip_fields"),
        F.map_keys(texts).alias("translation_scope"), r.alias("source_record"), none.alias("missing_scope"),
    )
    return out.withColumn("untranslated", untranslated(out))


#: The text fields that rows of no known benchmark offer for translation.
ANY_SCOPE = {"question": specs.QUESTION_KEYS, "options": specs.OPTION_KEYS, "caption": specs.CAPTION_KEYS}


def adapt_any(df: DataFrame, row: str = "row", ordinal: str = "ord") -> DataFrame:
    """The same of raw rows of no known benchmark, those of the nested corpus for one: question, options and caption by
    their usual keys; missing_scope names those that a row lacks, untranslated its other keys that hold text. They have
    no benchmark, and no id but what an export makes of them."""
    r = F.col(row)
    found = {n: fields.get_first(r, keys) for n, keys in ANY_SCOPE.items()}
    pairs = F.filter(F.array(*(F.struct(F.lit(n).alias("key"), f["value"].alias("value")) for n, f in found.items())), lambda x: x["value"].isNotNull())
    taken = F.array_compact(F.array(*(f["key"] for f in found.values())))
    places = F.array_compact(F.array(*(fields.present(r[k]) for k in (*specs.PATH_KEYS, *specs.MORE_MEDIA_KEYS))))
    none = F.lit(None).cast("string")
    out = df.select(
        F.col(ordinal), none.alias("benchmark_id"), none.alias("benchmark_name"), none.alias("source_id"), fields.get_first(r, specs.COMMON_KEYS["split"])["value"].alias("split"),
        F.coalesce(fields.present(r["task"]), fields.present(r["category"])).alias("task"), nested.media_list(places).alias("media"), F.map_from_entries(pairs).alias("text_fields"),
        fields.copy_present(r, (*specs.ANSWER_KEYS, "target", "correct_answer", "category", "dataset", "split")).alias("preserve_fields"), F.create_map().cast("map<string,string>").alias("skip_fields"),
        F.array(*map(F.lit, ANY_SCOPE)).alias("translation_scope"), r.alias("source_record"), F.array_except(F.array_sort(nested.discover_text_fields(r)), taken).alias("untranslated"),
    )
    return out.withColumn("missing_scope", fields.missing_groups(F.col("text_fields"), ANY_SCOPE))


def translate_columns(df: DataFrame, translate=text.mock_translate, column: str = "text_fields") -> DataFrame:
    """df with translated: every text through a Column transform, option labels kept."""
    return df.withColumn("translated", F.transform_values(column, lambda k, v: text.keep_option_label(v, translate(v))))


def untranslated(df: DataFrame) -> Column:
    """Sorted names of what isn't translated: skipped keys, and preserved ones that hold text."""
    kept = F.map_keys(F.map_filter("preserve_fields", lambda k, v: text.trimmed(v) != ""))
    return F.array_sort(F.array_union(F.map_keys("skip_fields"), kept))


def _empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def export(df: DataFrame, dataset_name: str, artifact: str, run_id: str, exported_at: str, qc_status: str = "unchecked", qc_report: str = "", default_split: str = "test", origin: tuple[str, str, str] = ("", "", "")) -> DataFrame:
    """Export records of adapted rows with `translated`; strings are redacted, absent values are ""."""
    if qc_status not in QC_STATUS:
        raise ValueError(f"no status {qc_status!r}")
    source, done = F.col("text_fields"), F.col("translated")
    split = identity.normal_split(F.col("split"), default_split)
    content = identity.stable_hash(F.to_json("source_record"))
    own = identity.source_id(F.col("source_id"), [F.col("source_record")[k] for k in specs.ID_KEYS], F.col("source_record")["conversation_index"], content)
    answer = fields.get_first(F.col("preserve_fields"), (*specs.ANSWER_KEYS, "target"))["value"]
    options = lambda m: F.coalesce(F.when(fields.present(m["options"]).isNotNull(), F.when(F.rlike(m["options"], F.lit(r"^\s*[\[{]")), m["options"]).otherwise(F.to_json(F.array(m["options"])))), F.lit("null"))
    values = {
        "record_id": identity.record_id(F.col("benchmark_id"), split, own), "dataset_name": F.lit(dataset_name), "source_id": own, "split": split, "media": F.array_sort(F.array_distinct("media")),
        **{f"{k}_original": _empty(source[k]) for k in ("question", "caption", "instruction")}, "options_original_json": options(source),
        **{f"{k}_ko": _empty(done[k]) for k in ("question", "caption", "instruction")}, "options_ko_json": options(done), "answer": _empty(answer),
        "translated_text_fields_json": F.to_json(done), "preserve_fields_json": F.to_json("preserve_fields"), "skip_fields_json": F.to_json("skip_fields"), "source_record_json": F.to_json("source_record"),
        "translation_artifact_path": F.lit(artifact), "translation_run_id": F.lit(run_id), "translation_qc_status": F.lit(qc_status), "translation_qc_report": F.lit(qc_report),
        **{f"original_hf_{k}": F.lit(v) for k, v in zip(("dataset", "config", "revision"), origin, strict=True)}, "exported_at": F.lit(exported_at), "export_schema_version": F.lit(1).cast("bigint"),
    }
    plain = {c: values.get(c, F.col(c) if c == "translation_scope" else _empty(F.col(c)) if c in df.columns else F.lit("")) for c in EXPORT_COLUMNS}
    return redact.redact_rows(df.select(*(v.alias(c) for c, v in plain.items())))


def repackage(exported: DataFrame, order: list[str], force_split: str = "") -> DataFrame:
    """Package ids: the split forced or under its common name, the original pair kept, repeated ids renamed."""
    split = F.lit(force_split) if force_split else identity.package_split(F.col("split"))
    df = exported.withColumn("source_split", F.col("split")).withColumn("source_record_id", F.col("record_id")).withColumn("split", split)
    df = df.withColumn("record_id", identity.record_id(F.col("benchmark_id"), F.col("split"), F.col("source_id")))
    content = identity.stable_hash("source_record_id", "source_record_json", length=8)
    return identity.disambiguated(df, "record_id", order, content).withColumn("record_id", F.col("unique_id")).drop("unique_id", "n", "key_rows")


def public(packaged: DataFrame) -> DataFrame:
    """The public columns of package rows that have media_files."""
    first = F.coalesce(F.get("media_files", F.lit(0)), F.lit(""))
    df = packaged.withColumn("file_name", first).withColumn("primary_media_file", first).withColumn("media_original_refs_json", F.to_json("media"))
    return df.select(*PACKAGE_COLUMNS)
