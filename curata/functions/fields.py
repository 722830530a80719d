"""Field resolution: values of rows whose keys vary, by priority lists.

A raw row is a map<string,string> whose values are strings or JSON text. A value that is null or "" is missing; "0",
"false", "[]" and "{}" are present.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(value: Column) -> Column:
    """The value, with "" taken as null."""
    return F.when(value != "", value)


def first_present(*columns: Column | str) -> Column:
    """The first value that isn't missing, of columns of a fixed schema."""
    return F.coalesce(*(present(F.col(c) if isinstance(c, str) else c) for c in columns))


def lower_keys(row: Column) -> Column:
    """The row with lower-case keys; of keys that then collide, the later one counts."""
    entries = F.map_entries(row)
    keyed = F.transform(entries, lambda e, i: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"), i.alias("i")))
    last = F.filter(keyed, lambda e: ~F.exists(keyed, lambda o: (o["key"] == e["key"]) & (o["i"] > e["i"])))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))


def get_first(row: Column, keys: Iterable[str]) -> Column:
    """struct(key, value) of the first key with a value: exact names over all keys first, then whatever their case."""
    keys = list(keys)
    exact = F.filter(F.array(*(F.struct(F.lit(k).alias("key"), row[k].alias("value")) for k in keys)), lambda x: present(x["value"]).isNotNull())
    lowered, entries = lower_keys(row), F.map_entries(row)

    def real(k: str) -> Column:
        named = F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == k.lower()), lambda e: e["key"])
        return F.struct(F.get(named, F.size(named) - 1).alias("key"), lowered[k.lower()].alias("value"))

    any_case = F.filter(F.array(*map(real, keys)), lambda x: present(x["value"]).isNotNull())
    return F.get(F.concat(exact, any_case), F.lit(0))


def copy_present(row: Column, keys: Iterable[str]) -> Column:
    """The part of the row under the listed keys (in any case), without missing values."""
    wanted = F.array(*(F.lit(k.lower()) for k in keys))
    return F.map_filter(row, lambda k, v: F.array_contains(wanted, F.lower(k)) & present(v).isNotNull())


def text_fields(row: Column, spec) -> Column:
    """map of question, options and instruction, each by its own priority list, without those that are missing."""
    named = [(n, spec.keys(n)) for n in ("question", "options", "instruction")]
    found = F.array(*(F.struct(F.lit(n).alias("key"), get_first(row, keys)["value"].alias("value")) for n, keys in named if keys))
    return F.map_from_entries(F.filter(found, lambda x: x["value"].isNotNull()))


def missing_groups(fields: Column, groups: Iterable[str]) -> Column:
    """Names of the groups that have no value, in order."""
    return F.array_compact(F.array(*(F.when(present(fields[g]).isNull(), F.lit(g)) for g in groups)))
