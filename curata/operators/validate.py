"""Rules for translated rows: one row of output for each rule that a row breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions import text as X
from curata.functions.fields import present
from curata.functions.nested import json_option_count


def _when(condition: Column, message: Column | str) -> Column:
    return F.when(condition, F.lit(message) if isinstance(message, str) else message)


def leaf_errors(leaves: Column, benchmark_id: Column, source_id: Column) -> Column:
    """Errors of an array of struct(path, text): no Hangul, ideographs, an assistant's words; numbered over all leaves."""

    def errors(leaf: Column, i: Column) -> Column:
        at = F.concat(F.lit("field "), leaf["path"], F.lit(" item "), i.cast("string"))
        exempt = X.allows_nonlinguistic(benchmark_id, leaf["path"], leaf["text"], source_id)
        return F.array_compact(
            F.array(
                _when(~X.has_korean(leaf["text"]) & ~exempt, F.concat(at, F.lit(" has no Korean text"))),
                _when(X.has_ideograph(leaf["text"]) & ~exempt & ~X.allows_ideographs(benchmark_id, source_id), F.concat(at, F.lit(" has ideographs"))),
                _when(X.has_assistant_word(leaf["text"]), F.concat(at, F.lit(" has assistant text"))),
            )
        )

    return F.when(F.size(leaves) == 0, F.array(F.lit("field is empty"))).otherwise(F.flatten(F.transform(leaves, errors)))


def option_alignment(source_count: Column, translated_count: Column) -> Column:
    """The error of a row whose source options can be counted and whose translated options can't or differ."""
    return (
        F.when(source_count.isNotNull() & translated_count.isNull(), "options missing")
        .when(source_count != translated_count, "options differ")
    )


def row_errors(df: DataFrame, key: str, translated: str, missing_scope: str, source: str, source_id: str, benchmark_id: str, leaves: str, source_options: str, translated_options: str) -> DataFrame:
    """key, error: rows without a translation break one rule only."""
    c = F.col
    none = c(translated).isNull() | ((F.size(translated) == 0) & ~F.array_contains(missing_scope, "text_fields"))
    rest = F.concat(
        F.array_compact(
            F.array(
                *(_when(F.array_contains(missing_scope, g), f"missing {g}") for g in ("question", "options", "text_fields")),
                option_alignment(c(source_options), c(translated_options)),
                _when(c(source).isNull(), "no source"),
                _when(c(benchmark_id).isNotNull() & present(c(source_id)).isNull(), "no source id"),
            )
        ),
        leaf_errors(c(leaves), F.coalesce(benchmark_id, F.lit("")), F.coalesce(source_id, F.lit(""))),
    )
    return df.select(key, F.explode(F.when(none, F.array(F.lit("not translated"))).otherwise(rest)).alias("error"))


def review_reasons(question: Column, primary_media: Column, media_files: Column, missing_media: Column, texts: Column, original_options: Column, translated_options: Column) -> Column:
    """Reasons to look at a packaged row, in order; options are JSON text."""
    original, translated = json_option_count(original_options), json_option_count(translated_options)
    return F.array_compact(
        F.array(
            _when(present(question).isNull() | ~X.has_korean(question), "question_missing_or_not_korean"),
            _when(present(primary_media).isNull(), "primary_media_missing"),
            _when(media_files.isNull() | (F.size(media_files) == 0), "media_files_empty"),
            _when((F.size(media_files) > 0) & missing_media, "media_file_path_missing"),
            _when(F.exists(texts, X.has_assistant_speech), "assistant_artifact_text"),
            _when(original.isNotNull() & translated.isNull(), "options_missing_or_unparseable"),
            _when(original != translated, "options_cardinality_mismatch"),
        )
    )
