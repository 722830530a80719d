"""Names, labels, hashes and record ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.fields import first_present, present
from curata.functions.text import trimmed

#: Names of a validation split.
VALIDATION_SPLITS = ("val", "valid", "dev")


def normal_split(value: Column, default: str = "test") -> Column:
    """Lower case, other characters as single underscores, none at the ends; "test" where nothing is left."""
    raw = F.coalesce(present(trimmed(F.coalesce(present(value), F.lit(default)))), F.lit(default))
    clean = F.lower(F.regexp_replace(F.regexp_replace(raw, "[^A-Za-z0-9_]+", "_"), "^_+|_+$", ""))
    return F.coalesce(present(clean), F.lit("test"))


def package_split(value: Column) -> Column:
    split = normal_split(value)
    return F.when(split.isin(*VALIDATION_SPLITS), "validation").otherwise(split)


def safe_label(value: Column, default: str = "input") -> Column:
    clean = F.lower(F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9_]+", "_"), "^_+|_+$", ""))
    return F.coalesce(present(clean), F.lit(default))


def safe_part(value: Column, default: str = "item") -> Column:
    """Letters and digits of any script, dots, dashes and underscores; none of the three at the ends."""
    clean = F.regexp_replace(F.regexp_replace(value, r"[^\p{IsAlphabetic}\p{N}._-]+", "_"), r"^[._-]+|[._-]+$", "")
    return F.coalesce(present(clean), F.lit(default))


def stable_hash(*columns: Column | str, length: int = 12) -> Column:
    """Hex digits of the SHA-256 of the values' canonical text: each with its length before it, so no two rows meet."""
    cells = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    text = cells[0] if len(cells) == 1 else F.concat(*(x for c in cells for x in (F.length(c).cast("string"), F.lit(":"), c)))
    return F.substring(F.sha2(text, 256), 1, length)


def source_id(own: Column, fallbacks: list[Column], turn: Column | None, content: Column) -> Column:
    """The row's id, else the first other id, each with #turn-N; else row-<hash> of the content."""
    suffix = F.lit("") if turn is None else F.coalesce(F.concat(F.lit("#turn-"), turn.cast("string")), F.lit(""))
    named = first_present(own, *fallbacks)
    return F.coalesce(F.concat(named, suffix), F.concat(F.lit("row-"), content))


def record_id(benchmark: Column, split: Column, source: Column) -> Column:
    return F.concat_ws("/", benchmark, split, source)


def alias_id(value: Column, aliases: dict[str, str]) -> Column:
    """Trimmed, lower case, spaces as underscores, then through the aliases."""
    key = F.replace(F.lower(trimmed(value)), F.lit(" "), F.lit("_"))
    table = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    return F.coalesce(table[key], key)


def parse_ids(text: Column, aliases: dict[str, str]) -> Column:
    """Ids of a list with commas."""
    return F.transform(F.filter(F.split(text, ","), lambda x: trimmed(x) != ""), lambda x: alias_id(x, aliases))


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """df with n (place among rows of the key, from 0) and key_rows (how many there are): ordinals over (key, order) less
    the key's first one, so rows of a frequent key are many tasks'."""
    from curata.operators.sampling import with_ordinal

    placed = with_ordinal(df, [key, *order], "_ordinal")
    keys = placed.groupBy(F.col(key).alias("_key")).agg(F.min("_ordinal").alias("_first"), F.count("*").alias("key_rows"))
    joined = placed.join(keys, F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*df.columns, (F.col("_ordinal") - F.col("_first")).alias("n"), "key_rows")


def disambiguated(df: DataFrame, key: str, order: list[str], content: Column) -> DataFrame:
    """df with unique_id: the key, and from its second row on `<key>__dup_<n>_<hash>`."""
    numbered = first_seen(df, key, order)
    return numbered.withColumn("unique_id", F.when(F.col("n") == 0, F.col(key)).otherwise(F.concat(F.col(key), F.lit("__dup_"), F.col("n").cast("string"), F.lit("_"), content)))
