"""Self-contained packages on disk: media copied beside the rows, one metadata file a split, card, manifest, validation.

Rows and media are dealt to executors; what the driver handles are the manifest, the card and a list of splits. Folders
must be shared by all of them, as the media files are copied by executors.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions import plain, redact, text
from curata.functions.identity import safe_label
from curata.operators import audit, media
from curata.operators.storage import fixed
from curata.plans import package, record
from curata.sinks import writers
from curata.sources import archives, bundles, readers

# Names and keys of a package.
CARD, MANIFEST, VALIDATION = "README.md", "manifest.json", "self_contained_validation.json"
MARKERS = ("run_records", "/mnt/ddn/", "/home/", "MLXP", "OPENAI_API_KEY", "MLXP_ACCESS_TOKEN", "WANDB_API_KEY", "translation_artifact_path")
FORBIDDEN_KEYS = {
    "api_key", "base_url", "cluster", "codex_home", "commit", "docker_image", "endpoint", "git_sha", "image_digest", "mlxp", "model", "model_id", "namespace",
    "openai_api_key", "pod", "provider", "provider_id", "repo", "repository", "reservation", "reservation_id", "run_id", "secret", "source_record_json", "token",
    "translation_artifact_path", "translation_run_id",
}
MANIFEST_KEYS = {
    "": {"schema_version", "created_at", "dataset_name", "layout", "source", "translation", "media_packaging", "export", "splits", "columns"},
    "source": {"original_hf_dataset", "original_hf_config", "original_hf_revision"},
    "translation": {"qc_status"},
    "media_packaging": {"mode", "copied_files", "missing_media_refs", "allow_missing_media"},
    "export": {"output_dir", "dataset_card", "hub_upload_performed", "load_dataset_command"},
}
SPLIT_KEYS = {"num_rows", "metadata", "images_dir"}
_MAP_TYPE = T.MapType(T.StringType(), T.StringType())


def media_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """root, root_ord, path (below the root) of every file in the media roots."""
    out = None
    for i, root in enumerate(r.rstrip("/") for r in roots):
        part = readers.listing(spark, root).select(F.lit(root).alias("root"), F.lit(i).alias("root_ord"), "path")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "root string, root_ord int, path string")


def resolved(refs: DataFrame, files: DataFrame, members: DataFrame) -> DataFrame:
    """refs (id, pos, ref) with source (the whole path of a file or archive) and member: the first root that has the file,
    an absolute reference below a root included; else the first archive, one named after the ref's first part before
    others. Remote references have none."""
    bare = F.regexp_replace(F.trim("ref"), r"^[./]+", "")
    keyed = refs.withColumn("_key", F.when(~text.is_remote_ref(F.col("ref")), F.when(F.trim("ref").startswith("/"), F.trim("ref")).otherwise(F.regexp_replace(F.trim("ref"), r"^(?:\./)+", ""))))
    whole = F.concat("root", F.lit("/"), "path")
    by_path = files.select(F.col("path").alias("_key"), F.struct("root_ord", whole.alias("source")).alias("f")).unionByName(files.select(whole.alias("_key"), F.struct("root_ord", whole.alias("source")).alias("f")))
    direct = by_path.groupBy("_key").agg(F.min("f").alias("f"))
    named = F.substring_index("archive", "/", -1) == F.concat(F.substring_index("member", "/", 1), F.lit(".zip"))
    packed = members.groupBy(F.col("member").alias("_member")).agg(F.min(F.struct("archive_ord", (~named).alias("other"), "archive")).alias("a"))
    joined = keyed.join(direct, "_key", "left").withColumn("_member", F.when(F.col("f").isNull() & F.col("_key").isNotNull(), bare)).join(packed, "_member", "left")
    return joined.select("id", "pos", "ref", F.coalesce("f.source", "a.archive").alias("source"), F.when(F.col("f").isNull() & F.col("a").isNotNull(), F.col("_member")).alias("member"))


def targets(found: DataFrame, rows: DataFrame) -> DataFrame:
    """found (id, pos, ref, source, member) with target: <split>/images/<benchmark>/<name>, for rows (record_id, split, benchmark_id)."""
    name = F.coalesce("member", "source")
    stem, suffix = F.regexp_extract(name, r"([^/]*?)(?:\.[^./]*)?$", 1), F.regexp_extract(name, r"\.([^./]*)$", 1)
    identity = F.concat_ws("::", "source", "member")
    placed = found.join(rows.select(F.col("record_id").alias("id"), "split", "benchmark_id"), "id")
    path = F.concat_ws("/", "split", F.lit("images"), safe_label(F.col("benchmark_id"), "benchmark"), media.file_name(identity, stem, suffix))
    return placed.withColumn("target", F.when(F.col("source").isNotNull(), path))


def put_file(source: str, target: str) -> None:
    """A hard link where the file system allows one, else a copy; written aside and renamed."""
    if os.path.exists(target):
        return
    os.makedirs(os.path.dirname(target), exist_ok=True)
    aside = f"{target}.{uuid.uuid4().hex}.tmp"
    try:
        os.link(source, aside)
    except OSError:
        shutil.copy2(source, aside)
    os.replace(aside, target)


def copy_media(found: DataFrame, out: str) -> DataFrame:
    """target, done of every different target of found (source, member, target, and the place of a member in its archive).

    Executors link or copy files. Members go by archive and place, so that a task opens an archive once and reads the bytes
    of its own members."""
    out = writers.shared_folder(out)
    wanted = found.where("target is not null").groupBy("target").agg(F.min(F.struct("source", "member", *archives.PLACE)).alias("f")).select("target", "f.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ends = list(zip(*(c.to_pylist() for c in b.columns), strict=True)), []
            todo = []
            for target, source, member, *place in rows:
                path = f"{out}/{target}"
                if member is not None and not os.path.exists(path):
                    todo.append((source, path, *place))
                elif member is None:
                    try:
                        put_file(source, path)
                    except OSError:
                        pass  # shows below
            for _ in archives.unpack_all(todo):
                pass
            ends = [os.path.exists(f"{out}/{r[0]}") for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array(ends, pa.bool_())], names=["target", "done"])

    n = max(1, -(-wanted.count() // archives.TASK_MEMBERS))
    dealt = wanted.repartitionByRange(n, "source", "offset", "target").sortWithinPartitions("source", "offset")
    return dealt.select("target", "source", "member", *archives.PLACE).mapInArrow(run, "target string, done boolean")


def write_package(spark: SparkSession, exported: DataFrame, roots: list[str], out: str, dataset_name: str, created_at: str, qc_status: str, origin: dict[str, str | None] | None = None, allow_missing: bool = False, force_split: str = "", order: tuple[str, ...] = ("benchmark_id", "source_id", "question_original")) -> dict[str, Any]:
    """Writes a package of export records; returns its manifest with the validation. Missing media is an error unless allowed."""
    out = out.rstrip("/")
    writers.safe_output(spark, out, roots)
    writers.shared_folder(out)
    rows = fixed(record.repackage(exported, list(order), force_split))
    if rows.isEmpty():
        raise ValueError("no rows to package")
    refs = rows.select(F.col("record_id").alias("id"), F.posexplode("media").alias("pos", "ref"))
    zips = [p for root in roots for p in archives.listing(spark, root).select("path").collect()]  # a handful of files
    held = spark.createDataFrame([(r["path"], i) for i, r in enumerate(zips)], "path string, archive_ord int")
    listed = fixed(archives.members(held).where("member is not null"))
    members = listed.join(F.broadcast(held), F.col("archive") == F.col("path")).select("member", "archive", "archive_ord")
    placed = fixed(targets(resolved(refs, media_files(spark, roots), members), rows))
    copied = fixed(copy_media(archives.placed(placed.withColumnRenamed("source", "archive"), listed).withColumnRenamed("archive", "source"), out))
    if not (failed := copied.where("not done")).isEmpty():
        raise OSError(f"{failed.count()} media files can't be written, {failed.first()['target']} for one")
    ordered = lambda keep, value: F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("pos", value.alias("v"))))), lambda x: x["v"])
    below = F.expr("substring(target, length(split) + 2)")
    there = F.col("target").isNotNull()
    grouped = placed.groupBy(F.col("id").alias("record_id")).agg(
        ordered(there, F.col("target")).alias("media_files"), ordered(there & text.is_image_file(F.col("target")), below).alias("images"),
        ordered(F.lit(True), media.clean_ref(F.col("ref"))).alias("refs"), F.count_if(~there).alias("n_missing"),
    )
    none = F.array().cast("array<string>")
    joined = rows.join(grouped, "record_id", "left").withColumns({"media_files": F.coalesce("media_files", none), "images": F.coalesce("images", none), "refs": F.coalesce("refs", none), "n_missing": F.coalesce("n_missing", F.lit(0))})
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit(""))
    clean = joined.withColumns({"file_name": first("images"), "primary_media_file": first("media_files"), "media_original_refs_json": F.to_json("refs")})
    public = fixed(clean.select(*record.PACKAGE_COLUMNS, "n_missing"))
    totals = public.agg(F.sum("n_missing").alias("missing"), F.sum(F.size("media_files")).alias("files")).first()
    if totals["missing"] and not allow_missing:
        names = [r["record_id"] for r in public.where("n_missing > 0").orderBy("record_id").limit(5).collect()]
        raise ValueError(f"{totals['missing']} media references are missing, in {', '.join(names)} and others")
    if twice := [r["record_id"] for r in audit.duplicate_ids(public, "record_id", "split").limit(20).collect()]:
        raise ValueError(f"repeated record ids: {', '.join(twice)}")
    counts = package.split_counts(public)
    for split in counts:
        own = public.where(F.col("split") == split).drop("n_missing").orderBy(*order)
        writers.write_lines(writers.json_lines(own), f"{out}/{split}/metadata.jsonl")
    packaging = {"mode": "self_contained_link_or_copy", "copied_files": totals["files"], "missing_media_refs": totals["missing"], "allow_missing_media": allow_missing}
    writers.write_text(spark, package.card(dataset_name, counts, qc_status, media=packaging), f"{out}/{CARD}")
    manifest = {
        "schema_version": 1, "created_at": created_at, "dataset_name": dataset_name, "layout": "huggingface_imagefolder_self_contained",
        "source": {f"original_hf_{k}": (origin or {}).get(k) for k in ("dataset", "config", "revision")}, "translation": {"qc_status": qc_status}, "media_packaging": packaging,
        "export": {"output_dir": ".", "dataset_card": CARD, "hub_upload_performed": False, "load_dataset_command": "load_dataset('imagefolder', data_dir='.')"},
        "splits": {s: {"num_rows": n, "metadata": f"{s}/metadata.jsonl", "images_dir": f"{s}/images"} for s, n in counts.items()}, "columns": sorted(record.PACKAGE_COLUMNS),
    }
    writers.write_report(spark, manifest, f"{out}/{MANIFEST}")
    validation = validate(spark, out)
    writers.write_report(spark, validation, f"{out}/{VALIDATION}")
    if validation["status"] != "passed":
        raise ValueError(f"the package is not valid: {validation['errors'][:5]}")
    return manifest | {"validation": validation}


# ---------------------------------------------------------------- audits


def manifest_problems(manifest: Any) -> list[str]:
    """What is wrong with a package's manifest in itself."""
    if not isinstance(manifest, dict):
        return ["the manifest is no JSON object"]
    errors = package.manifest_errors(manifest, {k: v for k, v in MANIFEST_KEYS.items() if not k or k in manifest}, FORBIDDEN_KEYS)
    columns, splits = manifest.get("columns"), manifest.get("splits")
    if columns is not None and not (isinstance(columns, list) and all(isinstance(c, str) for c in columns)):
        errors.append("the manifest's columns are no list of names")
    else:
        errors += [f"unexpected column in the manifest: {c}" for c in sorted(set(columns or ()) - set(record.PACKAGE_COLUMNS))]
    if not isinstance(splits, dict) or not splits:
        return [*errors, "the manifest has no splits"]
    for name, info in sorted(splits.items()):
        if not safe_split(str(name)):
            errors.append(f"unsafe split: {name}")
        elif not isinstance(info, dict):
            errors.append(f"split {name} is no object")
        else:
            errors += [f"unexpected key: manifest.splits.{name}.{k}" for k in sorted(set(info) - SPLIT_KEYS)]
            n = info.get("num_rows")
            if not isinstance(n, int) or isinstance(n, bool) or n < 0:
                errors.append(f"split {name} has no number of rows")
    errors += [f"secret at manifest{p[1:]}" for p in plain.secrets_in(manifest)]
    said = str(manifest)
    return errors + [f"process marker in the manifest: {m}" for m in MARKERS if m in said]


def safe_split(name: str) -> bool:
    return bool(name) and name not in (".", "..") and name.replace(".", "").replace("-", "").replace("_", "").isalnum() and name.isascii() and not name.startswith((".", "-"))


def row_problems(rows: DataFrame, files: DataFrame) -> DataFrame:
    """error of package rows (split, place, value JSON): columns, secrets, markers, ids and paths, and files that aren't in
    files (path below the package)."""
    found = F.from_json("value", "map<string,string>")
    keys = F.map_keys("row")
    names = lambda values: F.array(*map(F.lit, sorted(values)))
    listed = F.from_json(F.col("row")["media_files"], "array<string>")
    base = rows.withColumn("row", found).withColumn("label", F.concat("split", F.lit("/metadata.jsonl["), F.col("place").cast("string"), F.lit("]"))).withColumn("media", listed).withColumn("file_name", F.coalesce(F.col("row")["file_name"], F.lit("")))

    def each(values: Column, message: str) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(f"{message}: "), F.col("label"), F.lit(" "), v))

    def once(condition: Column, message: str) -> Column:
        return F.when(condition, F.array(F.concat(F.lit(f"{message}: "), "label"))).otherwise(F.array().cast("array<string>"))

    absolute = lambda p: p.startswith("/") | text.is_remote_ref(p)
    climbs = lambda p: F.rlike(p, F.lit(r"(?:^|/)\.\.(?:/|$)"))
    # JSON text of every value, so that secrets under names at any depth are seen
    leaves = F.concat(redact.findings(F.col("row"), _MAP_TYPE, "$"), F.when(redact.redact_text(F.col("value")) != F.col("value"), F.array(F.lit("$"))).otherwise(F.array().cast("array<string>")))
    errors = F.concat(
        each(F.array_sort(F.array_except(keys, names({*record.PACKAGE_COLUMNS, *record.PROCESS_COLUMNS}))), "unexpected column"),
        each(F.array_sort(F.array_intersect(keys, names(record.PROCESS_COLUMNS))), "process column"),
        each(F.array_except(names(record.PACKAGE_REQUIRED), keys), "missing column"),
        each(F.array_distinct(leaves), "secret"), each(audit.marker_errors(F.col("value"), list(MARKERS)), "process marker"),
        once(F.coalesce(F.col("row")["record_id"], F.lit("")) == "", "no record id"), once(F.col("file_name") == "", "no file_name"),
        once((F.col("file_name") != "") & absolute(F.col("file_name")), "file_name is not relative"), once(climbs(F.col("file_name")), "file_name leaves the split"),
        once(F.col("media").isNull(), "media_files is no list"), each(F.filter(F.coalesce("media", F.array().cast("array<string>")), lambda p: absolute(p)), "media file is not relative"),
        each(F.filter(F.coalesce("media", F.array().cast("array<string>")), lambda p: climbs(p)), "media file leaves the package"),
    )
    out = base.select(F.explode(errors).alias("error"))
    main = base.where(F.col("file_name") != "").select("label", F.concat("split", F.lit("/"), "file_name").alias("path"))
    wanted = main.unionByName(base.select("label", F.explode("media").alias("path"))).where(~absolute(F.col("path")) & ~climbs(F.col("path"))).distinct()
    gone = wanted.join(files.select("path").distinct(), "path", "left_anti").select(F.concat(F.lit("no file: "), "label", F.lit(" "), "path").alias("error"))
    ids = base.select(F.col("row")["record_id"].alias("record_id"), "label").where("record_id <> ''")
    twice = audit.duplicate_ids(ids, "record_id", "label").select(F.concat(F.lit("repeated record id: "), "record_id", F.lit(", first in "), "first_label").alias("error"))
    return out.unionByName(gone).unionByName(twice)


def validate(spark: SparkSession, out: str, shown: int = 200) -> dict[str, Any]:
    """A package's audit: status, splits, columns, the first `shown` errors and how many there are in all."""
    out = out.rstrip("/")
    if not writers.exists(spark, f"{out}/{MANIFEST}"):
        return {"status": "failed", "output_dir": ".", "splits": {}, "columns": [], "n_errors": 1, "errors": ["no manifest"]}
    try:
        manifest: Any = bundles.document(spark, f"{out}/{MANIFEST}")
    except ValueError:
        manifest = None
    errors = manifest_problems(manifest)
    splits = {k: v for k, v in plain.as_object(plain.as_object(manifest).get("splits")).items() if safe_split(str(k)) and isinstance(v, dict)}
    errors += [f"unexpected artifact: {n}" for n in writers.names(spark, out) if n not in {CARD, MANIFEST, VALIDATION, *splits}]
    errors += [f"split {s} is no folder" for s in splits if writers.exists(spark, f"{out}/{s}") and not writers.is_folder(spark, f"{out}/{s}")]
    if not writers.exists(spark, f"{out}/{CARD}") or writers.is_folder(spark, f"{out}/{CARD}"):
        errors.append("no dataset card")
    else:
        card = spark.read.text(f"{out}/{CARD}", wholetext=True).first()["value"]
        errors += ["secret in the card"] * bool(list(plain.secrets_in(card))) + [f"process marker in the card: {m}" for m in MARKERS if m in card]
    counts: dict[str, int] = {}
    rows = None
    for name, info in sorted(splits.items()):
        try:
            part = bundles.split_rows(spark, out, name)
        except FileNotFoundError:
            errors.append(f"no metadata of split {name}")
            continue
        counts[name] = part.count()
        if counts[name] != info.get("num_rows"):
            errors.append(f"split {name} has {counts[name]} rows, {info.get('num_rows')} by the manifest")
        part = part.select(F.lit(name).alias("split"), F.col("ord").alias("place"), "value")
        rows = part if rows is None else rows.unionByName(part)
    columns: list[str] = []
    n_errors = len(errors)
    if rows is not None:
        files = readers.listing(spark, out)
        problems = fixed(row_problems(rows, files))
        n_errors += problems.count()
        errors += [r["error"] for r in problems.orderBy("error").limit(max(0, shown - len(errors))).collect()]
        columns = [r["k"] for r in rows.select(F.explode(F.json_object_keys("value")).alias("k")).distinct().orderBy("k").collect()]
    return {"status": "passed" if not n_errors else "failed", "output_dir": ".", "splits": counts, "columns": columns, "n_errors": n_errors, "errors": errors[:shown]}


def validate_export(spark: SparkSession, out: str, shown: int = 200) -> dict[str, Any]:
    """An export's audit: counts of manifest, dataset and JSONL, columns, repeated ids, secrets of every leaf, shards that
    are missing or too many."""
    out = out.rstrip("/")
    manifest, errors = bundles.document(spark, f"{out}/manifest.json"), []
    errors += [f"missing: {n}" for n in ("manifest.json", "dataset", "card.json") if not writers.exists(spark, f"{out}/{n}")]
    errors += [f"secret at manifest{p[1:]}" for p in plain.secrets_in(manifest)]
    if writers.exists(spark, f"{out}/card.json"):
        errors += [f"secret at card{p[1:]}" for p in plain.secrets_in(bundles.document(spark, f"{out}/card.json"))]
    counts: dict[str, int] = {}
    found = None
    columns: list[str] = []
    if writers.exists(spark, f"{out}/dataset"):
        data = spark.read.parquet(f"{out}/dataset")
        columns = data.columns
        errors += [f"missing column: {c}" for c in audit.missing_columns(columns, list(record.EXPORT_COLUMNS))]
        counts = package.split_counts(data)
        wanted = {s: v.get("num_rows") for s, v in plain.as_object(manifest.get("splits")).items() if isinstance(v, dict)}
        if counts != wanted:
            errors.append(f"rows by split: {counts} in the dataset, {wanted} by the manifest")
        lines = spark.read.option("basePath", f"{out}/data").text(f"{out}/data") if writers.exists(spark, f"{out}/data") else spark.createDataFrame([], "value string, _split string")
        written = {r["_split"]: r["n"] for r in lines.groupBy("_split").agg(F.count("*").alias("n")).collect()}
        errors += [f"no JSONL of split {s}" for s in sorted(set(counts) - set(written))] + [f"unexpected JSONL of split {s}" for s in sorted(set(written) - set(counts))]
        errors += [f"split {s}: {written[s]} lines of JSONL, {counts[s]} rows" for s in sorted(set(counts) & set(written)) if counts[s] != written[s]]
        hits = F.concat(*(redact.findings(F.col(f.name), f.dataType, f"$.{f.name}", f.name) for f in data.schema))
        ids = lambda df, what: audit.duplicate_ids(df, "record_id", "record_id").select(F.concat(F.lit(f"repeated record id in {what}: "), "record_id").alias("error"))
        found = data.select("record_id", F.explode(hits).alias("at")).select(F.concat(F.lit("secret at "), "record_id", F.lit(" "), "at").alias("error")).unionByName(ids(data, "the dataset"))
        found = found.unionByName(ids(lines.select(F.get_json_object("value", "$.record_id").alias("record_id")), "the JSONL"))
        found = found.unionByName(lines.where(redact.redact_text(F.col("value")) != F.col("value")).select(F.concat(F.lit("secret in the JSONL: "), F.get_json_object("value", "$.record_id")).alias("error")))
    n_errors = len(errors)
    if found is not None:
        found = fixed(found)
        n_errors += found.count()
        errors += [r["error"] for r in found.orderBy("error").limit(max(0, shown - len(errors))).collect()]
    return {"status": "passed" if not n_errors else "failed", "output_dir": ".", "splits": counts, "columns": sorted(columns), "n_errors": n_errors, "errors": errors[:shown]}


__all__ = ["copy_media", "manifest_problems", "resolved", "row_problems", "validate", "validate_export", "write_package"]
