"""Commands: sample, translate, corpus, export, package, validate, report, viewer, sanity, prepare, record, download.

    python -m curata <command> ...      0: passed, 1: an error, 2: done, but not passed

Sessions come from spark-submit or the environment; every path is read and written by Spark.
"""

from __future__ import annotations

import argparse
import json
import sys
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from curata.functions import plain
from curata.operators import endpoint, transform
from curata.plans import checks, gates, jobs, packaging, prepare, record, specs
from curata.sinks import viewer, writers
from curata.sources import bundles, readers


def translator(args: argparse.Namespace, config: dict[str, Any]):
    if args.mock:
        return transform.mock
    more = {"whole_batches": getattr(args, "whole_batches", False)} | ({"concurrency": args.concurrency} if args.concurrency else {})
    return endpoint.HttpTranslator.of_config(config, **more)


def limits(args: argparse.Namespace) -> dict[str, Any]:
    """Sizes of a translation: of a batch, of what is asked at once over all tasks, of a commit; 0 is no limit."""
    return {"batch_size": args.batch_size, "retries": args.retries, "requests": args.requests or None, "commit_rows": args.commit_rows or None}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="curata", description=__doc__.splitlines()[0])
    out.add_argument("--config", default="")
    commands = out.add_subparsers(dest="command", required=True)

    def add(command: str, *positional: str, **options: Any) -> argparse.ArgumentParser:
        p = commands.add_parser(command)
        for x in positional:
            p.add_argument(x, **({"nargs": "+"} if x.endswith("s") and x != "benchmarks" else {}))
        for k, default in options.items():
            flag = "--" + k.replace("_", "-")
            if isinstance(default, bool):
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, default=default, type=type(default) if default is not None else str)
        return p

    add("list")
    add("sample", "root", "benchmarks", "out", size=3, seed=6029, mock=False, concurrency=0, validate_only=False)
    add("translate", "root", "benchmark", "out", limit=-1, resume=False, mock=False, concurrency=0, batch_size=8, retries=2, requests=0, commit_rows=0, whole_batches=False)
    add("corpus", "root", "out", size=-1, seed=6029, resume=False, mock=False, concurrency=0, batch_size=8, retries=2, requests=0, commit_rows=0, whole_batches=False)
    add("export", "bundle", "benchmarks", "out", name="dataset", run_id="", status="unchecked")
    add("package", "outputs", out=None, media_roots="", name="dataset", status="unchecked", fallback="benchmark", split="", allow_missing=False)
    add("validate", "path", kind="package")
    add("report", "packages", bundles="", out=None)
    add("view", "packages", out=None, overwrite=False)
    add("sanity", "root", out="", expected_rows=-1, allow_partial=False)
    add("prepare", "blink_root", "mme_root", "out", extract=False)
    add("record", "action", "path", run_id="")
    add("download", "target", method="hf-cli")
    return out


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[Any, bool]:
    """What a command found or made, and whether it passed."""
    config = readers.load_config(spark.read.text(args.config, wholetext=True).first()["value"]) if args.config else {}
    match args.command:
        case "list":
            return {b: r.name for b, r in specs.SPECS.items()}, True
        case "sample":
            if args.validate_only:
                gaps = [r.asDict() for r in jobs.bundle_gaps(spark, args.out, specs.parse_ids(args.benchmarks)).collect()]
                return {"gaps": gaps}, not gaps
            found = jobs.translate_sample(spark, args.root, args.benchmarks, args.out, args.size, args.seed, translator(args, config))
            return found, all(x["status"] == "passed" for x in found.values())
        case "translate":
            limit = None if args.limit < 0 else args.limit
            found = jobs.translate_full(spark, args.root, args.benchmark, args.out, limit, args.resume, translator(args, config), **limits(args))
            return found, found["status"] == "passed"
        case "corpus":
            found = jobs.translate_corpus(spark, args.root, args.out, None if args.size < 0 else args.size, args.seed, args.resume, translator(args, config), **limits(args))
            return found, found["status"] == "passed"
        case "export":
            manifest = jobs.export(spark, args.bundle, args.benchmarks, args.out, args.name, args.run_id, plain.stamp(), args.status)
            report = packaging.validate_export(spark, args.out)
            return {"manifest": manifest, "validation": report}, report["status"] == "passed"
        case "package":
            rows = bundles.adapted(spark, bundles.row_files(spark, args.outputs), args.fallback)
            exported = record.export(rows, args.name, "", "", plain.stamp(), args.status)
            manifest = packaging.write_package(spark, exported, [r for r in args.media_roots.split(",") if r], args.out, args.name, plain.stamp(), args.status, allow_missing=args.allow_missing, force_split=args.split)
            return manifest, manifest["validation"]["status"] == "passed"
        case "validate":
            check = {"package": packaging.validate, "export": packaging.validate_export, "viewer": viewer.validate, "output": checks.validate_output}[args.kind]
            report = check(spark, args.path)
            return report, report["status"] == "passed"
        case "report":
            names = {p.rstrip("/").rsplit("/", 1)[-1]: p for p in args.packages}
            packages = {n: (bundles.document(spark, f"{args.bundles}/{n}/translation_summary.json"), jobs.public_rows(spark, p), readers.listing(spark, p)) for n, p in names.items()}
            report, text = jobs.report_over(packages)
            if args.out:
                writers.write_report(spark, report, f"{args.out}/report.json")
                writers.write_text(spark, text, f"{args.out}/report.md")
            return report, report["status"] == "passed"
        case "view":
            made = viewer.write(spark, args.packages, args.out, args.overwrite)
            report = viewer.validate(spark, args.out)
            return made | report, report["status"] == "passed"
        case "sanity":
            report = gates.sanity(spark, args.root, config, None if args.expected_rows < 0 else args.expected_rows, args.allow_partial)
            if args.out:
                writers.write_report(spark, report, args.out)
            return report, report["status"] == "passed"
        case "prepare":
            found = {"blink": prepare.blink(spark, args.blink_root, f"{args.out}/blink"), "mme_realworld": prepare.mme(spark, args.mme_root, f"{args.out}/mme_realworld", args.extract)}
            return found, all(x["status"] == "passed" for x in found.values())
        case "record":
            if args.action == "init":
                writers.write_report(spark, made := gates.new_record(config, args.run_id or plain.stamp()), args.path)
                return made, True
            errors = gates.record_errors(bundles.document(spark, args.path))
            return {"errors": errors}, not errors
        case "download":
            plan = gates.download_plan(config, args.method, args.target)
            return plan, plan["tool_present"]
    raise ValueError(args.command)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"curata {args.command}").getOrCreate()
    try:
        found, passed = run(spark, args)
    except (ValueError, OSError, KeyError, PySparkException, endpoint.EndpointError) as e:
        print(plain.redacted_text(f"{type(e).__name__}: {e}"), file=sys.stderr)
        return 1
    print(json.dumps(plain.redacted(found), ensure_ascii=False, indent=2, default=str))
    return 0 if passed else 2


__all__ = ["main", "parser", "run"]
