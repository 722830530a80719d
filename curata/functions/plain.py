"""Rules of single documents and of the driver: redaction of plain values, paths, names, stamps.

Rows go through functions.redact; what is here is for manifests, cards, configurations and reports.
"""

from __future__ import annotations

import os
import posixpath
import re
import shutil
import subprocess
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import Any
from urllib.parse import quote

from curata.functions import redact as R



def redacted_text(text: str) -> str:
    return R.plain_text(text)


def secret_name(name: str) -> bool:
    return name.lower() in R.SECRET_NAMES or name.lower().endswith("_token")


def redacted(value: Any, name: str = "") -> Any:
    """A document without secrets: strings under secret names whole, others by pattern."""
    match value:
        case str():
            return R.REDACTED if value and secret_name(name) else redacted_text(value)
        case dict():
            return {k: redacted(v, str(k)) for k, v in value.items()}
        case list() | tuple():
            return [redacted(v) for v in value]
    return value


def secrets_in(value: Any, path: str = "$", name: str = "") -> Iterator[str]:
    """Paths of what looks secret in a document, at any depth."""
    if name and secret_name(name) and value is not None and value not in ("", R.REDACTED):
        yield path
    elif isinstance(value, str):
        if redacted_text(value) != value:
            yield path
    elif isinstance(value, dict):
        for k, v in value.items():
            yield from secrets_in(v, f"{path}.{k}", str(k))
    elif isinstance(value, (list, tuple)):
        for i, v in enumerate(value):
            yield from secrets_in(v, f"{path}[{i}]")


def as_object(value: Any) -> dict[str, Any]:
    return value if isinstance(value, dict) else {}


def stamp(now: datetime | None = None) -> str:
    """A compact UTC time, as 20240131T235959Z."""
    return (now or datetime.now(UTC)).strftime("%Y%m%dT%H%M%SZ")


def download_url(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{quote(name)}"


def relative_path(path: str, start: str) -> str:
    """The path below start, or the path as it is."""
    a, b = posixpath.normpath(path), posixpath.normpath(start)
    return posixpath.relpath(a, b) if a == b or a.startswith(b.rstrip("/") + "/") else path


def link_name(value: str, default: str = "media") -> str:
    return re.sub(r"[^\w.-]+", "_", value).strip("._-") or default


def config_path(config: dict[str, Any], key: str) -> str:
    """A folder of the configuration: absolute, or below its dataset root."""
    paths = config.get("paths", {})
    return posixpath.join(paths.get("dataset_root", "."), paths[key])


def has_command(name: str) -> bool:
    return shutil.which(name) is not None


def commit_id(folder: str = ".") -> str:
    """The checked-out commit of a folder, or UNKNOWN."""
    try:
        done = subprocess.run(["git", "-C", folder, "rev-parse", "HEAD"], capture_output=True, text=True, check=True, timeout=20)
    except (OSError, subprocess.SubprocessError):
        return "UNKNOWN"
    return done.stdout.strip() or "UNKNOWN"


def make_parent(path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
