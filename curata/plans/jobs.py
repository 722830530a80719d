"""Jobs: sample and full translation of benchmarks and of the nested corpus, export, packaging, the report over packages.

A bundle is a folder for each benchmark with `rows` (accepted, JSONL), `failed` (dead letters, JSONL), `errors` (what breaks
a rule, JSONL) and the reports of BUNDLE_REPORTS. Each run adds a folder to all of them and a small report of its own in
`stats`, which commits it; the bundle's reports are sums of those, so a run that goes on where another one ended touches
its own rows only. Outputs are written by Spark, so any store will do. Translators are those of operators.transform.
"""

from __future__ import annotations

import json
import threading
import time
from collections import Counter
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import plain, text
from curata.operators import audit, media, report, sampling, transform, validate
from curata.operators.endpoint import safe_summary
from curata.operators.storage import fixed
from curata.plans import package, record, specs
from curata.sinks import writers
from curata.sources import bundles, readers

#: Documents of a bundle beside its rows.
BUNDLE_REPORTS = ("untranslated_fields.json", "inspection_examples.json", "translation_validation.json", "translation_summary.json")
PROGRESS = "translation_progress.json"
#: Errors that a validation report shows; the table `errors` of the bundle holds all. Rows that the examples show.
SHOWN_ERRORS, SHOWN_ROWS = 200, 3
#: Seconds from one progress report to the next.
PROGRESS_SECONDS = 15.0
#: The name under which the nested corpus is kept, and the benchmark that its exported rows are of.
CORPUS = "mmad"


def load(spark: SparkSession, root: str, benchmark_id: str, limit: int | None = None) -> tuple[str, DataFrame]:
    """The first registered file of a benchmark with rows, in its folder or as the root itself, and its adapted rows; an
    error if there is none."""
    benchmark_id = specs.normal_id(benchmark_id)
    root = root.rstrip("/")
    folder = f"{root}/{benchmark_id}"
    path, raw = None, None
    if not writers.is_empty_dir(spark, folder):
        path, raw = readers.load_first(spark, folder, specs.SPECS[benchmark_id].keys("files"))
    elif writers.exists(spark, root) and not writers.is_folder(spark, root):
        path, raw = root, readers.read_records(spark, root)
    if path is None or raw.isEmpty():
        raise FileNotFoundError(f"no rows of {benchmark_id} below {root}")
    dense = sampling.with_ordinal(raw.withColumnRenamed("ord", "place"), ["place"]).drop("place")
    return path, record.adapt(dense if limit is None else dense.where(F.col("ord") < limit), benchmark_id)


def load_corpus(spark: SparkSession, root: str, limit: int | None = None) -> tuple[str, DataFrame]:
    """The first file below root with rows, nested by image or flat, and its adapted rows; an error if there is none."""
    path, raw = readers.load_first(spark, root)
    if path is None:
        raise FileNotFoundError(f"no rows below {root}")
    dense = sampling.with_ordinal(raw.withColumnRenamed("ord", "place"), ["place"]).drop("place")
    return path, record.adapt_any(dense if limit is None else dense.where(F.col("ord") < limit))


def _texts(df: DataFrame) -> DataFrame:
    return df.select("ord", "source_id", "text_fields")


def _join_results(adapted: DataFrame, ok: DataFrame) -> DataFrame:
    """Adapted rows with `translated`, option labels kept."""
    done = ok.select(F.col("ord"), F.from_json("text_fields", "map<string,string>").alias("_done"))
    joined = adapted.join(done, "ord")
    kept = F.transform_values("_done", lambda k, v: F.coalesce(text.keep_option_label(F.col("text_fields")[k], v), v))
    return joined.withColumn("translated", kept).drop("_done")


def row_problems(translated: DataFrame) -> DataFrame:
    """ord, error of translated rows."""
    leaves = F.filter(
        F.transform(F.map_entries("translated"), lambda e: F.struct(F.concat(F.lit("text_fields."), e["key"]).alias("path"), e["value"].alias("text"))), lambda x: text.trimmed(x["text"]) != ""
    )
    rows = translated.select(
        "ord", "translated", "benchmark_id", "source_id", F.coalesce("missing_scope", F.array().cast("array<string>")).alias("missing"), F.to_json("source_record").alias("source"), leaves.alias("leaves"),
        text.option_count(F.col("text_fields")["options"]).alias("n_source"), text.option_count(F.col("translated")["options"]).alias("n_translated"),
    )
    return validate.row_errors(rows, "ord", "translated", "missing", "source", "source_id", "benchmark_id", "leaves", "n_source", "n_translated")


def _numbers(df: DataFrame, column: str) -> dict[str, int]:
    return {r["field"]: r["n"] for r in report.field_histogram(df, column).collect()}


def _commit(spark: SparkSession, adapted: DataFrame, out: str, run: str, seconds: float = 0.0) -> dict[str, Any]:
    """Rows, dead letters, errors and the report of one run, from its results. It may be done again: all of it is
    replaced, the report last."""
    results = spark.read.parquet(f"{out}/results/{run}")
    translated = _join_results(adapted, results.where("ok"))
    translated.write.mode("overwrite").json(f"{out}/rows/{run}")
    results.where("not ok").drop("ok").write.mode("overwrite").json(f"{out}/failed/{run}")
    rows = spark.read.schema(translated.schema).json(f"{out}/rows/{run}")
    problems = fixed(row_problems(rows))
    problems.orderBy("ord").write.mode("overwrite").json(f"{out}/errors/{run}")  # all of them; the report shows the first
    n, n_failed = rows.count(), results.where("not ok").count()
    found = {
        "run": run, "rows": n, "failed": n_failed, "errors": problems.count(), "seconds": round(seconds, 3), "translated_fields": _numbers(rows, "translation_scope"), "untranslated_fields": _numbers(rows, "untranslated"),
        "missing_fields": _numbers(rows, "missing_scope"), "examples": [[r["ord"], r["value"]] for r in rows.select("ord", F.to_json(F.struct(*rows.columns)).alias("value")).orderBy("ord").limit(SHOWN_ROWS).collect()],
        "shown_errors": [[r["ord"], r["error"]] for r in problems.orderBy("ord", "error").limit(SHOWN_ERRORS).collect()],
    }
    writers.write_report(spark, found, f"{out}/stats/{run}.json")
    return found


def merged(stats: list[dict[str, Any]]) -> dict[str, Any]:
    """The reports of several runs as one: sums, and the first examples and errors of all."""
    out: dict[str, Any] = {k: sum(s[k] for s in stats) for k in ("rows", "failed", "errors", "seconds")}
    for k in ("translated_fields", "untranslated_fields", "missing_fields"):
        out[k] = dict(sorted(sum((Counter(s[k]) for s in stats), Counter()).items()))
    first = lambda k, n: sorted(x for s in stats for x in s[k])[:n]
    return out | {"examples": first("examples", SHOWN_ROWS), "shown_errors": first("shown_errors", SHOWN_ERRORS)}


def _finish(spark: SparkSession, adapted: DataFrame, out: str, source_count: int, translate: Callable) -> dict[str, Any]:
    """Reports of a bundle from those of its runs. A run that ended before its report is committed now."""
    done = set(writers.names(spark, f"{out}/stats"))
    for run in _runs(spark, out):
        if f"{run}.json" not in done:
            _commit(spark, adapted, out, run)
    all_of = merged([bundles.document(spark, f"{out}/stats/{n}") for n in writers.names(spark, f"{out}/stats") if n.endswith(".json")])
    n, n_failed, n_errors = all_of["rows"], all_of["failed"], all_of["errors"]
    valid = not n_errors and n > 0
    skipped = {"untranslated_text_fields": all_of["untranslated_fields"], "missing_configured_translation_fields": all_of["missing_fields"]}
    summary = {
        "source_count": source_count, "translated_count": n, "failure_count": n_failed, "valid_count": n if valid else 0, "invalid_count": source_count - n + (0 if valid else n),
        "translated_fields": all_of["translated_fields"], "inference": safe_summary(translate), "status": "passed" if valid and n + n_failed == source_count else "failed",
    }
    checked = {"status": "passed" if valid else "failed", "n_errors": n_errors, "errors": [e for _, e in all_of["shown_errors"]] if n else ["no rows"]}
    for name, value in zip(BUNDLE_REPORTS, (skipped, [json.loads(x) for _, x in all_of["examples"]], checked, summary), strict=True):
        writers.write_report(spark, value, f"{out}/{name}")
    return summary


def _runs(spark: SparkSession, out: str) -> list[str]:
    """Runs whose results are whole."""
    return [n for n in writers.names(spark, f"{out}/results") if writers.exists(spark, f"{out}/results/{n}/_SUCCESS")]


class _Progress:
    """Writes how far a run has come, from what its finished tasks have counted."""

    def __init__(self, spark: SparkSession, out: str, fixed_part: dict[str, Any]) -> None:
        self.spark, self.path, self.fixed_part, self.began = spark, f"{out}/{PROGRESS}", fixed_part, time.time()
        self.counts = {k: spark.sparkContext.accumulator(0) for k in ("ok", "failed")}
        self.over = threading.Event()
        self.thread = threading.Thread(target=self._go, daemon=True)

    def _go(self) -> None:
        while not self.over.wait(PROGRESS_SECONDS):
            self.write()

    def write(self) -> None:
        ok, failed, took = self.counts["ok"].value, self.counts["failed"].value, max(1.0, time.time() - self.began)
        now = {"created_at": plain.stamp(), **self.fixed_part, "ok_written_this_run": ok, "failures_this_run": failed, "rows_per_second_this_run": round((ok + failed) / took, 4)}
        writers.write_report(self.spark, now, self.path)

    def __enter__(self) -> _Progress:
        self.write()
        self.thread.start()
        return self

    def __exit__(self, *error: object) -> None:
        self.over.set()
        self.thread.join()
        if error[0] is None:
            self.write()


def _translate(spark: SparkSession, adapted: DataFrame, out: str, source_count: int, translate: Callable, resume: bool = False, requests: int | None = None, commit_rows: int | None = None, name: str = "", **options) -> dict[str, Any]:
    """Maps adapted rows into a bundle; with resume only those that are neither accepted nor failed yet.

    requests: the most requests that the service gets at once, over all tasks. commit_rows: rows after which a run is
    committed, so that an interruption costs no more than those; without, all rows are one run.
    """
    if not resume:
        writers.clear(spark, out, True)
    todo, before = adapted, 0
    runs = _runs(spark, out)
    if runs:
        done = spark.read.parquet(*(f"{out}/results/{r}" for r in runs)).select("ord")  # no other column is read
        before = done.count()
        todo = audit.pending(adapted, done, "ord")
    lanes = None if requests is None else max(1, requests // max(1, getattr(translate, "concurrency", 1)))
    part = F.floor(F.col("ord") / commit_rows) if commit_rows else F.lit(0)
    parts = {r["k"]: r["n"] for r in todo.groupBy(part.alias("k")).agg(F.count("*").alias("n")).orderBy("k").collect()}  # a row a commit
    next_run = 1 + max((int(n.rsplit("-", 1)[-1]) for n in writers.names(spark, f"{out}/results")), default=-1)
    progress = _Progress(spark, out, {"benchmark_id": name, "source_count": source_count, "previously_done": before, "pending_start": sum(parts.values()), "commits_total": len(parts)})
    with progress:
        for i, k in enumerate(parts):
            own = todo.where(part == k) if commit_rows else todo
            run, began = f"run-{next_run + i:06d}", time.time()
            results = transform.map_texts(transform.dealt(_texts(own), lanes), translate, counts=progress.counts, **options)
            results.write.mode("overwrite").parquet(f"{out}/results/{run}")
            _commit(spark, adapted, out, run, time.time() - began)
    return _finish(spark, adapted, out, source_count, translate)


def translate_sample(spark: SparkSession, root: str, benchmark_ids: str, out: str, size: int = 3, seed: int = 1, translate: Callable = transform.mock, **options) -> dict[str, Any]:
    """A seeded sample of each benchmark, translated and validated."""
    summaries = {}
    for benchmark_id in specs.parse_ids(benchmark_ids):
        _, adapted = load(spark, root, benchmark_id)
        drawn = sampling.seeded_sample(adapted, "ord", adapted.count(), size, seed)
        summaries[benchmark_id] = _translate(spark, drawn, f"{out}/{benchmark_id}", drawn.count(), translate, name=benchmark_id, **options)
    writers.write_report(spark, summaries, f"{out}/summary.json")
    return summaries


def translate_full(spark: SparkSession, root: str, benchmark_id: str, out: str, limit: int | None = None, resume: bool = False, translate: Callable = transform.mock, **options) -> dict[str, Any]:
    """All rows of a benchmark; with resume only those that are neither accepted nor failed yet."""
    benchmark_id = specs.normal_id(benchmark_id)
    _, adapted = load(spark, root, benchmark_id, limit)
    return _translate(spark, adapted, f"{out}/{benchmark_id}", adapted.count(), translate, resume, name=benchmark_id, **options)


def translate_corpus(spark: SparkSession, root: str, out: str, size: int | None = None, seed: int = 1, resume: bool = False, translate: Callable = transform.mock, **options) -> dict[str, Any]:
    """The nested corpus, or a flat one: question, options and caption of each turn of each image, all of them or a seeded
    sample. Turns go in ranges of their order, so those of an image are translated one after the other."""
    _, adapted = load_corpus(spark, root)
    n = adapted.count()
    if size is not None and size < n:
        adapted, n = sampling.seeded_sample(adapted, "ord", n, size, seed), size
    return _translate(spark, adapted, f"{out}/{CORPUS}", n, translate, resume, name=CORPUS, **options)


def bundle_gaps(spark: SparkSession, out: str, benchmark_ids: list[str]) -> DataFrame:
    """benchmark_id, artifact that a bundle should have and hasn't."""
    files = readers.listing(spark, out).select(F.substring_index("path", "/", 1).alias("benchmark_id"), F.get(F.split("path", "/"), F.lit(1)).alias("artifact"))
    owners = spark.createDataFrame([(b,) for b in benchmark_ids], "benchmark_id string")
    return audit.required(owners, ["rows", *BUNDLE_REPORTS], files, "benchmark_id", "artifact")


def _translated(spark: SparkSession, out: str, benchmark_ids: list[str]) -> DataFrame:
    gaps = [f"{r['benchmark_id']}: {r['artifact']}" for r in bundle_gaps(spark, out, benchmark_ids).collect()]
    if gaps:
        raise ValueError("incomplete bundle: " + ", ".join(sorted(gaps)))
    kinds = {"media": "array<string>", "translation_scope": "array<string>", "ord": "bigint"}
    kinds |= dict.fromkeys(("text_fields", "preserve_fields", "skip_fields", "source_record", "translated"), "map<string,string>")
    kinds |= {"missing_scope": "array<string>", "untranslated": "array<string>"}
    names = ["ord", "benchmark_id", "benchmark_name", "source_id", "split", "task", "media", "text_fields", "preserve_fields", "skip_fields", "translation_scope", "source_record", "translated", "missing_scope", "untranslated"]
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).json([f"{out}/{b}/rows" for b in benchmark_ids])
    return rows.withColumn("benchmark_id", F.coalesce("benchmark_id", F.lit(CORPUS))).withColumn("benchmark_name", F.coalesce("benchmark_name", "benchmark_id"))


def bundle_ids(benchmark_ids: str) -> list[str]:
    """Names of bundles: benchmarks, and the corpus by its own."""
    names = [n.strip() for n in benchmark_ids.split(",")]
    others = [n for n in names if n.lower() != CORPUS]
    return [CORPUS] * (len(others) < len(names)) + (specs.parse_ids(",".join(others)) if others else [])


def export(spark: SparkSession, bundle: str, benchmark_ids: str, out: str, name: str, run_id: str, exported_at: str, qc_status: str = "unchecked") -> dict[str, Any]:
    """Export records as JSONL and parquet with a card and a manifest. Repeated record ids are an error."""
    if not writers.is_empty_dir(spark, out):
        raise FileExistsError(out)
    df = record.export(_translated(spark, bundle, bundle_ids(benchmark_ids)), name, bundle.rstrip("/").rsplit("/", 1)[-1], run_id, exported_at, qc_status)
    twice = [r["record_id"] for r in audit.duplicate_ids(df, "record_id", "split").limit(20).collect()]
    if twice:
        raise ValueError(f"repeated record ids: {', '.join(twice)}")
    writers.write_dataset(df, f"{out}/dataset", record.EXPORT_SCHEMA)
    writers.write_jsonl(df, f"{out}/data")
    counts = package.split_counts(df)
    manifest = package.manifest(name, counts, df.columns, translation={"qc_status": qc_status, "run_id": run_id})
    writers.write_report(spark, manifest, f"{out}/manifest.json")
    writers.write_report(spark, {"card": package.card(name, counts, qc_status)}, f"{out}/card.json")
    differs = audit.reconcile(df.groupBy("split").agg(F.count("*").alias("n")), spark.read.parquet(f"{out}/dataset").groupBy("split").agg(F.count("*").alias("n")), "split")
    if not differs.isEmpty():
        raise ValueError("what was written differs in its row counts")
    return manifest


def package_rows(spark: SparkSession, bundle: str, benchmark_ids: str, files: DataFrame, members: DataFrame, name: str, run_id: str, exported_at: str, qc_status: str = "unchecked", force_split: str = "") -> tuple[DataFrame, DataFrame]:
    """(public rows, missing media refs) of a self-contained package: files (path, root_ord), members as for media.resolve."""
    translated = _translated(spark, bundle, bundle_ids(benchmark_ids))
    rows = record.repackage(record.export(translated, name, "", run_id, exported_at, qc_status), ["benchmark_id", "source_id", "question_original"], force_split)
    refs = rows.select(F.col("record_id").alias("id"), F.posexplode(F.transform("media", media.clean_ref)).alias("pos", "ref"))
    done = media.package(media.resolve(refs, files, members))
    joined = rows.join(done.select(F.col("id").alias("record_id"), "media_files", "missing"), "record_id", "left")
    joined = joined.withColumn("media_files", F.coalesce("media_files", F.array().cast("array<string>")))
    return record.public(joined), joined.select("record_id", F.explode("missing").alias("ref"))


def public_rows(spark: SparkSession, package_dir: str) -> DataFrame:
    """The rows of a package on disk with its public columns."""
    kinds = {"media_files": "array<string>", "translation_scope": "array<string>"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in record.PACKAGE_COLUMNS)
    return bundles.package_rows(spark, package_dir).select(F.from_json("value", schema).alias("r")).select("r.*")


def _absent_media(df: DataFrame, files: DataFrame) -> DataFrame:
    """df with absent: whether one of a row's media files isn't in files (path below the package)."""
    refs = df.select("record_id", F.explode("media_files").alias("path")).join(files.select("path").distinct(), "path", "left_anti")
    return df.join(refs.select("record_id", F.lit(True).alias("absent")).distinct(), "record_id", "left").withColumn("absent", F.coalesce("absent", F.lit(False)))


def report_over(packages: dict[str, tuple]) -> tuple[dict[str, Any], str]:
    """One report over (translation summary, public rows, files of the package) by benchmark: totals, candidates, status,
    Markdown. Without files, media are taken to be there."""
    rows = []
    for name, (summary, df, *more) in sorted(packages.items()):
        df = _absent_media(df, more[0]) if more else df.withColumn("absent", F.lit(False))
        texts = F.array("question_ko", "caption_ko", "instruction_ko", "options_ko_json")
        reasons = validate.review_reasons(F.col("question_ko"), F.col("file_name"), F.col("media_files"), F.col("absent"), texts, F.col("options_original_json"), F.col("options_ko_json"))
        flagged = df.select("record_id", reasons.alias("reasons")).where(F.size("reasons") > 0)
        keys = ("source_count", "translated_count", "valid_count", "invalid_count", "failure_count")
        rows.append({"benchmark": name, **{k: summary.get(k, 0) for k in keys}, "packaged": df.count(), "review": flagged.count(), "examples": [r.asDict() for r in flagged.orderBy("record_id").limit(50).collect()]})
    numbers = [k for k in rows[0] if k not in ("benchmark", "examples")] if rows else []
    totals = {"benchmark": "total", **{k: sum(r[k] for r in rows) for k in numbers}}
    passed = bool(rows) and all(r["source_count"] > 0 and r["review"] == 0 and r["failure_count"] == 0 and r["valid_count"] == r["source_count"] for r in rows)
    return {"benchmarks": rows, "totals": totals, "status": "passed" if passed else "needs_review"}, report.markdown([*rows, totals], ["benchmark", *numbers])
