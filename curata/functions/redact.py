"""Redaction of secret-looking values, and where they are."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions import json_text

# Names of fields that hold secrets; so do names that end with _token.
SECRET_NAMES = (
    "access_token", "api_key", "client_secret", "id_token", "jupyter_token", "oauth_token", "password", "passwd", "pwd",
    "refresh_token", "secret", "token",
)
# What a value may look like to stay, and patterns of secrets.
REDACTED = "<redacted>"
_STAYS = r"(?!<redacted>|\$[A-Za-z_][A-Za-z0-9_]*)"
BEARER = rf"(?iU)(Authorization\s*[:=]\s*Bearer\s+){_STAYS}([^\s\"']+)"
API_KEY = r"(?U)\bsk-[A-Za-z0-9_-]{10,}\b"
NAMED = (
    r"(?iU)([\"']?\b(?:(?:[A-Za-z0-9]+_)*token|" + "|".join(n for n in SECRET_NAMES if n != "token") + r")\b[\"']?\s*[=:]\s*[\"']?)"
    rf"{_STAYS}([^\s,;\"'}}]+)"
)


def redact_text(text: Column, extra: Iterable[str] = ()) -> Column:
    """The text without given secrets, bearer values, keys and named values; names and $VARIABLES stay."""
    for secret in extra:
        if secret:
            text = F.replace(text, F.lit(secret), F.lit(REDACTED))
    text = F.regexp_replace(text, BEARER, f"$1{REDACTED}")
    text = F.regexp_replace(text, API_KEY, f"sk-{REDACTED}")
    return F.regexp_replace(text, NAMED, f"$1{REDACTED}")


def is_secret_name(name: Column) -> Column:
    name = F.lower(name)
    return name.isin(*SECRET_NAMES) | name.endswith("_token")


def _secret(name: str) -> bool:
    return name.lower() in SECRET_NAMES or name.lower().endswith("_token")


# ---------------------------------------------------------------- JSON text

#: Every secret name, and whatever the patterns find, holds one of these; escaped letters may hide them.
_HINT = r"(?iU)token|secret|passw|pwd|api_key|bearer|sk-|\\u00"
_PYTHON = [(re.compile(p.replace("(?iU)", "(?i)").replace("(?U)", "")), r) for p, r in ((BEARER, rf"\g<1>{REDACTED}"), (API_KEY, f"sk-{REDACTED}"), (NAMED, rf"\g<1>{REDACTED}"))]


def plain_text(text: str, extra: Iterable[str] = ()) -> str:
    """redact_text of one text."""
    for secret in extra:
        if secret:
            text = text.replace(secret, REDACTED)
    for pattern, to in _PYTHON:
        text = pattern.sub(to, text)
    return text


def plain_value(value: Any, extra: Iterable[str] = (), name: str = "") -> Any:
    """A JSON value without secrets: what stands under a secret name goes whole, lists and objects too, but for "";
    strings go by their text; those that are JSON lists or objects themselves are written anew, without the secrets in them,
    at any depth."""
    if name and _secret(name):
        return value if value == "" else REDACTED
    if isinstance(value, dict):
        return {plain_text(k, extra): plain_value(v, extra, k) for k, v in value.items()}
    if isinstance(value, list):
        return [plain_value(v, extra) for v in value]
    if not isinstance(value, str):
        return value
    if value.lstrip()[:1] in ("{", "["):
        try:
            inside = json.loads(value)
        except (ValueError, RecursionError):
            return plain_text(value, extra)
        return json_text.written(plain_value(inside, extra))
    return plain_text(value, extra)


def redact_json(text: Column, extra: Iterable[str] = ()) -> Column:
    """redact_text of a text; of one that is a JSON list or object, plain_value of it. Only such texts that may hold a
    secret leave the JVM."""
    extra = [x for x in extra if x]
    nested = json_text.starts(text, "{") | json_text.starts(text, "[")
    hinted = F.lit(True) if extra else F.rlike(text, F.lit(_HINT))
    return F.coalesce(json_text.changed(text, nested & hinted, lambda value: plain_value(value, extra)), F.when(nested & ~hinted, text), redact_text(text, extra))


def _holds_json(kind: T.DataType) -> bool:
    inner = kind.valueType if isinstance(kind, T.MapType) else kind.elementType if isinstance(kind, T.ArrayType) else None
    return isinstance(inner, T.StringType)


def redact_value(value: Column, kind: T.DataType, name: str = "", extra: Iterable[str] = ()) -> Column:
    """A value of any type with redacted strings; a string under a secret name is redacted whole."""
    extra = list(extra)
    if isinstance(kind, T.StringType):
        return F.when(value != "", F.lit(REDACTED)).otherwise(value) if _secret(name) else redact_text(value, extra)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: redact_value(x, kind.elementType, "", extra))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        return F.transform_values(value, lambda k, v: F.when(is_secret_name(k) & (v != ""), F.lit(REDACTED)).otherwise(redact_text(v, extra)))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda k, v: redact_value(v, kind.valueType, "", extra))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(redact_value(value[f.name], f.dataType, f.name, extra).alias(f.name) for f in kind)))
    return value


def redact_rows(df: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """df with redacted values. JSON text in columns of strings, and in their lists and maps, goes by its structure."""
    extra = list(extra)

    def clean(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and not _secret(f.name):
            return redact_json(value, extra)
        rule = redact_value(value, f.dataType, f.name, extra)
        if not _holds_json(f.dataType):
            return rule
        whole = F.to_json(value)
        inside = F.rlike(whole, F.lit(r'"[ \\trn]*[\[{]')) & (F.lit(True) if extra else F.rlike(whole, F.lit(_HINT)))  # a string that may be JSON
        return F.coalesce(F.from_json(json_text.changed(whole, inside, lambda v: plain_value(v, extra, "")), f.dataType), rule)

    return df.select(*(clean(f).alias(f.name) for f in df.schema))


def findings(value: Column, kind: T.DataType, path: Column | str = "$", name: str = "", extra: Iterable[str] = ()) -> Column:
    """Array of paths of leaves that look secret. A secret name counts unless its value is null, "" or redacted: so a
    number, a false or an empty list under it is found, though redaction leaves it."""
    path = F.lit(path) if isinstance(path, str) else path
    none = F.array().cast("array<string>")
    extra = list(extra)
    if name and _secret(name):
        text = value.cast("string") if not isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else F.to_json(value)
        return F.when(value.isNull() | text.isin("", REDACTED), none).otherwise(F.array(path))
    if isinstance(kind, T.StringType):
        return F.when(redact_text(value, extra) != value, F.array(path)).otherwise(none)
    if isinstance(kind, T.ArrayType):
        each = F.transform(value, lambda x, i: findings(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), "", extra))
        return F.coalesce(F.flatten(each), none)
    if isinstance(kind, T.StructType):
        parts = [F.coalesce(findings(value[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}")), f.name, extra), none) for f in kind]
        return F.concat(*parts) if parts else none
    if isinstance(kind, T.MapType):
        each = F.transform(
            F.map_entries(value),
            lambda e: F.when(is_secret_name(e["key"]), findings(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"]), "token", extra)).otherwise(
                findings(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"]), "", extra)
            ),
        )
        return F.coalesce(F.flatten(each), none)
    return none
