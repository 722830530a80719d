"""Driver-side documents of a package: cards, manifests, run records; and the audits of a package's rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions import identity, redact, text
from curata.operators import audit
from curata.plans.record import PACKAGE_COLUMNS, PACKAGE_REQUIRED, PROCESS_COLUMNS


def split_counts(df: DataFrame) -> dict[str, int]:
    return {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count("*").alias("n")).orderBy("split").collect()}


def card(name: str, counts: dict[str, int], qc_status: str, origin: str = "", media: dict[str, int] | None = None) -> str:
    """A package's description in Markdown."""
    lines = [f"# {name}", "", f"Quality status: {qc_status}", *([f"Made from: {origin}"] if origin else []), "", "| split | rows |", "| --- | ---: |"]
    lines += [f"| {k} | {v} |" for k, v in sorted(counts.items())]
    if media:
        lines += ["", f"Media files: {media.get('copied_files', 0)} references, {media.get('missing_media_refs', 0)} missing."]
    return "\n".join(lines) + "\n"


def manifest(name: str, counts: dict[str, int], columns: list[str], **sections: Any) -> dict[str, Any]:
    return {"dataset_name": name, "splits": {k: {"num_rows": v} for k, v in sorted(counts.items())}, "columns": sorted(columns), **sections}


def manifest_errors(value: dict[str, Any], allowed: dict[str, set[str]], forbidden: set[str]) -> list[str]:
    """Keys of a manifest that its section doesn't allow ("" is the top), and forbidden names at any depth."""
    errors = []

    def deep(node: Any, path: str) -> None:
        if isinstance(node, dict):
            for k, v in node.items():
                if str(k).lower() in forbidden:
                    errors.append(f"forbidden key: {path}.{k}")
                deep(v, f"{path}.{k}")
        elif isinstance(node, list):
            for i, v in enumerate(node):
                deep(v, f"{path}[{i}]")

    deep(value, "manifest")
    for section, keys in allowed.items():
        part = value if not section else value.get(section, {})
        if not isinstance(part, dict):
            errors.append(f"not an object: manifest.{section}")
        else:
            errors += [f"unexpected key: manifest{'.' * bool(section)}{section}.{k}" for k in sorted(set(map(str, part)) - keys)]
    return errors


def column_errors(df: DataFrame) -> list[str]:
    """What is wrong with a package's columns."""
    found = set(df.columns)
    return (
        [f"missing column: {c}" for c in audit.missing_columns(df.columns, list(PACKAGE_REQUIRED))]
        + [f"process column: {c}" for c in sorted(found & set(PROCESS_COLUMNS))]
        + [f"unexpected column: {c}" for c in sorted(found - set(PACKAGE_COLUMNS) - set(PROCESS_COLUMNS))]
    )


def row_audit(df: DataFrame, listing: DataFrame, markers: list[str]) -> DataFrame:
    """record_id, error: unsafe splits and paths, files that aren't in the listing (path), secrets, markers, repeated ids."""
    paths = F.array_union("media_files", F.array("file_name"))
    escapes = F.exists(paths, lambda p: p.startswith("/") | F.rlike(p, F.lit(r"(?:^|/)\.\.(?:/|$)")))
    own = F.array_compact(
        F.array(
            F.when(~text.is_safe_split_name(F.col("split")), F.lit("unsafe split")),
            F.when(escapes, F.lit("path leaves the package")),
            F.when(F.size(audit.marker_errors(F.to_json(F.struct(*df.columns)), markers)) > 0, F.lit("process marker")),
        )
    )
    secrets = F.concat(*(redact.findings(F.col(f.name), f.dataType, f"$.{f.name}", f.name) for f in df.schema))
    rows = df.select("record_id", F.explode(F.concat(own, F.transform(secrets, lambda p: F.concat(F.lit("secret at "), p)))).alias("error"))
    wanted = df.select("record_id", F.explode(paths).alias("path")).where("path <> ''").distinct()
    missing = wanted.join(listing.select("path").distinct(), "path", "left_anti").select("record_id", F.concat(F.lit("no file "), "path").alias("error"))
    twice = audit.duplicate_ids(df, "record_id", "split").select("record_id", F.lit("repeated id").alias("error"))
    return rows.unionByName(missing).unionByName(twice)


# Sections and paths of a run record.
RUN_SECTIONS = {"run_id": str, "created_at": str, "dataset": dict, "inference": dict, "outputs": dict, "verification": dict}
RUN_EVIDENCE = ("verification.status", "verification.evidence", "outputs.artifacts")


def run_record(run_id: str, created_at: str, dataset: dict[str, Any], inference: dict[str, Any]) -> dict[str, Any]:
    return {"run_id": run_id, "created_at": created_at, "dataset": dataset, "inference": inference, "outputs": {"artifacts": []}, "verification": {"status": "unchecked", "evidence": []}}


def at_path(document: dict[str, Any], path: str) -> Any:
    for part in path.split("."):
        document = document.get(part) if isinstance(document, dict) else None
    return document


def run_record_errors(record: dict[str, Any]) -> list[str]:
    """Missing or mistyped sections; with status passed, evidence must be there too."""
    errors = [f"missing or not {t.__name__}: {k}" for k, t in RUN_SECTIONS.items() if not isinstance(record.get(k), t)]
    if at_path(record, "verification.status") == "passed":
        errors += [f"empty: {p}" for p in RUN_EVIDENCE if not at_path(record, p)]
    return errors


def root_labels(roots: list[str]) -> list[str]:
    """input-NN-<label> of each input root."""
    import re

    parts = [re.sub(r"[^A-Za-z0-9_]+", "_", r.rstrip("/").rsplit("/", 1)[-1]).strip("_").lower() for r in roots]
    return [f"input-{i:02d}-{p or 'input'}" for i, p in enumerate(parts)]


def label_lookup(files: DataFrame, roots: DataFrame) -> DataFrame:
    """files (path) with the label of the longest root (root, label) that holds them: a join on each path's folders."""
    parts = F.split("path", "/")
    folders = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    held = files.select("path").distinct().select("path", F.explode(folders).alias("root")).join(roots.select("root", "label"), "root")
    best = held.groupBy("path").agg(F.max_by("label", F.length("root")).alias("label"))
    return files.join(best, "path", "left")


__all__ = ["card", "column_errors", "identity", "manifest", "manifest_errors", "row_audit", "run_record", "run_record_errors", "split_counts"]
