"""Nested values: conversations, option lists, JSON leaves and media references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.fields import present
from curata.functions.json_text import ROW, canonical, starts
from curata.functions.text import looks_textual, trimmed

#: Keys of a row that are not text, whatever they hold.
STRUCTURAL_KEYS = (
    "answer", "gt", "label", "id", "dataset", "class", "class_name", "category", "split", "query_image", "template_image",
    "mask", "mask_path", "image", "image_path", "img_path", "path", "filename", "file_name", "mmad_image_key",
    "similar_templates", "random_templates",
)
#: Keys under which an object gives its media path.
MEDIA_OBJECT_KEYS = ("path", "image", "image_path", "url", "video", "video_path")


def flatten_conversations(df: DataFrame, key: str, document: str) -> DataFrame:
    """One row a turn of {key: {conversation: [turn...], ...}} documents (canonical JSON text in `document`).

    Columns: key, conversation_index, row (map<string,string>). A turn's keys override those beside the conversation; a
    turn that is no object is the value of `conversation`. An object without a list is one row of its other values, an
    empty list none; a value that is no object is a row of its own text.
    """
    typed = df.withColumn("_base", F.when(starts(F.col(document), "{"), F.from_json(document, ROW))).withColumn("_list", F.col("_base")["conversation"])
    listed = starts(F.col("_list"), "[")
    turn = F.when(starts(F.col("_text"), "{"), F.from_json("_text", ROW)).otherwise(F.create_map(F.lit("conversation"), "_text"))
    turns = typed.where(listed).select(key, "_base", F.posexplode(F.from_json("_list", "array<string>")).alias("conversation_index", "_text")).withColumn("_turn", turn)
    rest = F.map_filter("_base", lambda k, v: k != "conversation")
    merged = F.map_concat(F.map_filter(rest, lambda k, v: ~F.map_contains_key(F.col("_turn"), k)), F.col("_turn"))
    out = turns.select(key, F.col("conversation_index").cast("bigint").alias("conversation_index"), merged.alias("row"))
    single = typed.where(~listed)
    value = F.coalesce(rest, F.create_map(F.lit("value"), F.col(document)))
    return out.unionByName(single.select(key, F.lit(None).cast("bigint").alias("conversation_index"), value.alias("row")))


def json_option_count(text: Column) -> Column:
    """Items of a JSON array or object; null for anything else."""
    return F.coalesce(F.json_array_length(text), F.size(F.when(F.json_object_keys(text).isNotNull(), F.json_object_keys(text)))).cast("bigint")


def json_payload(text: Column) -> Column:
    """The JSON in an answer: without a code fence, else the outermost braces or brackets; null if none parses."""
    bare = trimmed(F.regexp_replace(trimmed(text), r"^```[A-Za-z]*\s*|\s*```$", ""))
    return F.coalesce(canonical(bare), canonical(F.regexp_extract(text, r"(?s)\{.*\}", 0)), canonical(F.regexp_extract(text, r"(?s)\[.*\]", 0)))


def text_leaves(*values: Column) -> Column:
    """Values with something in them, in order."""
    return F.filter(F.array(*values), lambda x: trimmed(x) != "")


def json_leaves(text: Column) -> Column:
    """String leaves of JSON text in the order in which they stand, at any depth; keys, numbers and booleans are no text."""
    # escapes of one character each, which JSON text can't hold as they are, so a string ends at the next quote
    bare = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    strings = F.filter(F.regexp_extract_all(bare, F.lit(r'"[^"]*"\s*:?'), F.lit(0)), lambda t: ~t.endswith(":"))
    back = lambda t: F.replace(F.replace(t, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    values = F.transform(strings, lambda t: F.from_json(F.concat(F.lit('{"v":'), back(F.trim(t)), F.lit("}")), "v string")["v"])
    leaves = F.filter(values, lambda x: trimmed(x) != "")
    return F.when(F.try_parse_json(text).isNotNull(), leaves).otherwise(F.array().cast("array<string>"))


def joined_text(leaves: Column) -> Column:
    return F.array_join(leaves, "\n")


def discover_text_fields(row: Column) -> Column:
    """Sorted keys that hold text and aren't structural."""
    return F.array_sort(F.map_keys(F.map_filter(row, lambda k, v: ~F.lower(k).isin(*STRUCTURAL_KEYS) & looks_textual(text_leaves(v)))))


def last_user_text(turn: Column, role: Column, text: Column) -> Column:
    """An aggregate: the text of a conversation's last user message that has one; null without any."""
    said = present(text)
    return F.max_by(said, F.when((role == "user") & said.isNotNull(), turn))


def media_list(values: Column) -> Column:
    """Sorted distinct references of an array of strings; one that is a list in text gives its items."""
    unlisted = F.transform(values, lambda v: F.when(F.rlike(v, F.lit(r"^\s*\[.*\]\s*$")), F.coalesce(F.from_json(F.replace(v, F.lit("'"), F.lit('"')), "array<string>"), F.array(v))).otherwise(F.array(v)))
    return F.array_sort(F.array_distinct(F.filter(F.flatten(unlisted), lambda x: present(x).isNotNull())))


def media_objects(text: Column) -> Column:
    """References of a JSON list of strings or objects, by the first key that an object has."""
    items = F.from_json(text, "array<string>")
    own = lambda x: F.coalesce(*(present(F.get_json_object(x, f"$.{k}")) for k in MEDIA_OBJECT_KEYS))
    return F.array_compact(F.transform(items, lambda x: F.when(F.rlike(x, F.lit(r"^\s*\{")), own(x)).otherwise(present(x))))
