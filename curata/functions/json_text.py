"""JSON text as a strict reader sees it: one value and nothing after it; of doubled keys the last value, in the first's place.

The JVM's own functions differ there: some take quotes of another kind or ignore what follows a value, some take the first
of doubled keys, and the variant parser refuses them. So text that is plain JSON without doubled keys, which a test in the JVM
tells, stays as it is and never leaves the JVM; only the rest goes to Python's reader, in Arrow batches, and comes back
written anew, or as null if it is no JSON. What comes back, every JSON function of Spark reads alike.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "map<string,string>"
#: A number that can be written in no other way and read back the same. A text that holds its digits takes the longer way.
_MARK = "918273645546372819"


def is_plain(text: Column) -> Column:
    """Whether the JVM's functions read the text as a strict reader would: one strict JSON value, no doubled key at any
    depth. False for some JSON, and for null; true for nothing else."""
    # the value as the first of two items: if the mark is the second one, the text doesn't end the list itself
    two = F.concat(F.lit("["), text, F.lit(f",{_MARK}]"))
    alone = ~F.contains(text, F.lit(_MARK)) & F.coalesce(F.get_json_object(two, "$[1]") == _MARK, F.lit(False))
    return alone & F.try_parse_json(two).isNotNull()


def written(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _through(change: Callable[[Any], Any]):
    """A function of JSON text columns: change of the value, written anew; null for what is no JSON."""

    def one(text: str | None) -> bytes | None:
        if text is None:
            return None
        try:
            value = json.loads(text)
        except (ValueError, RecursionError):
            return None
        # a half of a surrogate pair is no character: the JVM writes ? for it
        return written(change(value)).encode("utf-8", "replace")

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([one(t) for t in texts.to_pylist()], pa.binary()).cast(pa.string())

    return run


_rewritten = _through(lambda value: value)


def canonical(text: Column) -> Column:
    """The text if it is plain, the value written anew if it is other JSON, null if it is none."""
    plain = is_plain(text)
    return F.when(plain, text).otherwise(_rewritten(F.when(~plain, text)))


def changed(text: Column, wanted: Column, change: Callable[[Any], Any]) -> Column:
    """change of the JSON value, written anew, where `wanted`; null elsewhere and for what is no JSON. Only wanted texts
    leave the JVM."""
    return _through(change)(F.when(wanted, text))


def starts(text: Column, mark: str) -> Column:
    """Whether JSON text is an object ({) or a list ([); false for null."""
    return F.coalesce(F.rlike(text, F.lit(r"^[ \t\r\n]*\Q" + mark + r"\E")), F.lit(False))


def object_of(canonical_text: Column) -> Column:
    """map<string,string> of canonical JSON text: strings, or the JSON text of other values; null for what is no object."""
    return F.when(starts(canonical_text, "{"), F.from_json(canonical_text, ROW))


def list_of(canonical_text: Column) -> Column:
    """array<string> of canonical JSON text, in the same way; null for what is no list."""
    return F.when(starts(canonical_text, "["), F.from_json(canonical_text, "array<string>"))
