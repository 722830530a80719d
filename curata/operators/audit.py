"""Coverage and completeness: what is missing, what is too much, what differs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.json_text import canonical


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key isn't done; failed keys count as done where they are part of `done`."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def done_keys(ok: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    return ok.select(key).unionByName(failed.select(key)).distinct()


def coverage(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key, status: missing (expected, not found) or unexpected."""
    a, b = expected.select(key).distinct(), found.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("status", F.lit("missing")).unionByName(b.join(a, key, "left_anti").withColumn("status", F.lit("unexpected")))


def reconcile(left: DataFrame, right: DataFrame, key: str, count: str = "n") -> DataFrame:
    """key, left_n, right_n where two tables of counts differ; a key that one lacks counts 0 there."""
    a, b = left.select(key, F.col(count).alias("left_n")), right.select(key, F.col(count).alias("right_n"))
    zero = F.lit(0).cast("bigint")
    both = a.join(b, key, "full_outer").select(key, F.coalesce("left_n", zero).alias("left_n"), F.coalesce("right_n", zero).alias("right_n"))
    return both.where("left_n <> right_n")


def required(owners: DataFrame, parts: list[str], present: DataFrame, owner: str, part: str) -> DataFrame:
    """(owner, part) pairs that should be there and aren't; parts is a fixed list."""
    wanted = owners.select(owner).distinct().select(owner, F.explode(F.array(*map(F.lit, parts))).alias(part))
    return wanted.join(present.select(owner, part).distinct(), [owner, part], "left_anti")


def unexpected_keys(keys: Column, allowed: list[str]) -> Column:
    """Sorted keys that aren't allowed."""
    return F.array_sort(F.array_except(keys, F.array(*map(F.lit, allowed))))


def missing_columns(columns: list[str], required_columns: list[str]) -> list[str]:
    return sorted(set(required_columns) - set(columns))


def marker_errors(row: Column, markers: list[str]) -> Column:
    """Markers that occur in a row's text."""
    return F.filter(F.array(*map(F.lit, markers)), lambda m: F.contains(row, m))


def forbidden_keys(document: Column, names: list[str]) -> Column:
    """Distinct names of a deny list used as keys in JSON text, at any depth, doubled keys included; null for what is no
    JSON, which nobody can vouch for."""
    text = canonical(document)
    whole = F.coalesce(F.to_json(F.try_parse_json(text)), text)  # one spelling of every key
    bare = F.regexp_replace(whole, r"\\.", "")  # no escapes, so a string ends at the next quote
    keys = F.filter(F.regexp_extract_all(bare, F.lit('"[^"]*":?'), F.lit(0)), lambda t: t.endswith('":'))
    found = F.filter(F.transform(keys, lambda t: F.substring(t, F.lit(2), F.length(t) - 3)), lambda k: F.lower(k).isin(*names))
    return F.array_sort(F.array_distinct(found))


def has_forbidden_key(document: Column, names: list[str]) -> Column:
    """Whether a document must not pass: a forbidden key, or no JSON at all. A null document has none."""
    return F.when(document.isNull(), F.lit(False)).otherwise(F.coalesce(F.size(forbidden_keys(document, names)) > 0, F.lit(True)))


def duplicate_ids(df: DataFrame, key: str, label: str, order: Column | str | None = None) -> DataFrame:
    """key, rows, first_label of ids that occur more than once: the label of the first row by `order` (by label without)."""
    first = F.min(label) if order is None else F.min_by(label, order)
    return df.groupBy(key).agg(F.count("*").alias("n_rows"), first.alias("first_label")).where("n_rows > 1")
