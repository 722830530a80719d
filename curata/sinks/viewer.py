"""A viewer of packages: records as JSON lines, a page that shows them, and links to the packages' media."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import json_text, plain
from curata.operators.storage import fixed
from curata.plans.packaging import copy_media
from curata.sinks import writers
from curata.sources import archives, bundles

# Files of a viewer, and the fields of a record that it shows as they are.
INDEX, DATA = "index.html", "records.jsonl"
PLAIN = ("record_id", "benchmark_id", "benchmark_name", "split", "source_id", "task", "question_original", "question_ko", "caption_original", "caption_ko", "instruction_original", "instruction_ko", "answer")

PAGE = """<!doctype html>
<meta charset="utf-8"><title>Translated records</title>
<style>body{font:15px sans-serif;margin:1em auto;max-width:70em}article{border-top:1px solid #999;padding:.5em 0}img{max-width:20em}td{vertical-align:top;padding:.2em 1em .2em 0}</style>
<input id="find" placeholder="find"> <span id="count"></span><div id="rows"></div><button id="more">more</button>
<script>
const cell = (t, v) => { const e = document.createElement(t); e.textContent = v ?? ""; return e; };
fetch("records.jsonl").then(r => r.text()).then(text => {
  const records = text.split("\\n").filter(x => x).map(x => JSON.parse(x));
  let most = 200;
  const show = () => {
    const word = document.getElementById("find").value.toLowerCase();
    const rows = document.getElementById("rows");
    const found = records.filter(r => JSON.stringify(r).toLowerCase().includes(word));
    document.getElementById("count").textContent = `${Math.min(most, found.length)} of ${found.length} shown, ${records.length} in all`;
    document.getElementById("more").hidden = most >= found.length;
    rows.replaceChildren(...found.slice(0, most).map(r => {
      const a = document.createElement("article");
      a.append(cell("h3", r.record_id));
      for (const m of r.media) { const i = document.createElement("img"); i.src = m; a.append(i); }
      const t = document.createElement("table");
      for (const k of ["question", "caption", "instruction"]) if (r[k + "_original"] || r[k + "_ko"]) { const l = t.insertRow(); l.append(cell("td", k), cell("td", r[k + "_original"]), cell("td", r[k + "_ko"])); }
      const o = t.insertRow(); o.append(cell("td", "options"), cell("td", JSON.stringify(r.options_original)), cell("td", JSON.stringify(r.options_ko)));
      const n = t.insertRow(); n.append(cell("td", "answer"), cell("td", r.answer));
      a.append(t); return a;
    }));
  };
  document.getElementById("find").oninput = () => { most = 200; show(); };
  document.getElementById("more").onclick = () => { most += 200; show(); };
  show();
});
</script>
"""


def records(rows: DataFrame, media_prefix: str = "media") -> DataFrame:
    """The viewer's fields of package rows (columns, or `value` as JSON text): JSON columns become values, media links."""
    if "value" in rows.columns:
        get = lambda c: F.get_json_object("value", f"$.{c}")
        media = F.from_json(get("media_files"), "array<string>")
    else:
        get, media = F.col, F.col("media_files")
    either = lambda a, b: F.coalesce(F.when(get(a) != "", get(a)), get(b))
    links = F.transform(F.coalesce(media, F.array().cast("array<string>")), lambda m: F.concat(F.lit(f"{media_prefix}/"), m))
    return rows.select(
        *(F.coalesce(get(c), F.lit("")).alias(c) for c in PLAIN), either("source_record_id", "record_id").alias("source_record_id"), either("source_split", "split").alias("source_split"), links.alias("media"),
        F.try_parse_json(json_text.canonical(F.coalesce(get("options_original_json"), F.lit("null")))).alias("options_original"), F.try_parse_json(json_text.canonical(F.coalesce(get("options_ko_json"), F.lit("null")))).alias("options_ko"),
    )


def link_media(package: str, target: str) -> bool:
    """A link to a package's folder, where the file system of the viewer has links."""
    try:
        os.symlink(os.path.abspath(package.removeprefix("file://")), target.removeprefix("file://"), target_is_directory=True)
    except OSError:
        return False
    return True


def write(spark: SparkSession, packages: list[str], out: str, overwrite: bool = False) -> dict[str, Any]:
    """A viewer over packages in one order: counts by benchmark and media references."""
    out = out.rstrip("/")
    writers.safe_output(spark, out, packages, overwrite)
    writers.clear(spark, out, overwrite)
    writers.write_text(spark, PAGE, f"{out}/{INDEX}")
    parts = []
    for i, package in enumerate(p.rstrip("/") for p in packages):
        link = f"media-{i:02d}-{plain.link_name(package.rsplit('/', 1)[-1])}"
        rows = bundles.package_rows(spark, package)
        parts.append(records(rows, link))
        if not link_media(package, f"{out}/{link}"):
            files = rows.select(F.explode(F.from_json(F.get_json_object("value", "$.media_files"), "array<string>")).alias("target")).distinct()
            copied = files.select(F.concat(F.lit(f"{package}/"), "target").alias("source"), F.lit(None).cast("string").alias("member"), F.concat(F.lit(f"{link}/"), "target").alias("target"))
            copied = copied.withColumns({c: F.lit(None).cast("bigint") for c in archives.PLACE})
            copy_media(copied, out).count()
    rows = reduce(DataFrame.unionByName, parts)
    lines = rows.orderBy("benchmark_id", "record_id").select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value"))
    writers.write_lines(lines, f"{out}/{DATA}")
    counts = {r["benchmark_id"]: r["n"] for r in rows.groupBy("benchmark_id").agg(F.count("*").alias("n")).orderBy("benchmark_id").collect()}
    refs = rows.agg(F.coalesce(F.sum(F.size("media")), F.lit(0)).alias("n")).first()["n"]
    return {"record_count": sum(counts.values()), "benchmarks": counts, "media_refs": refs}


def _absent(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lost = [m for m in b.column(0).to_pylist() if not os.path.exists(f"{root}/{m}")]
            yield pa.RecordBatch.from_arrays([pa.array(lost, pa.string())], names=["media"])

    return run


def validate(spark: SparkSession, out: str, shown: int = 10) -> dict[str, Any]:
    """Whether a viewer's files are there, and how many media references lead nowhere, some of them by name."""
    out = out.rstrip("/")
    errors = [f"no file {n}" for n in (INDEX, DATA) if not writers.exists(spark, f"{out}/{n}")]
    n = 0
    if not errors:
        refs = spark.read.text(f"{out}/{DATA}").select(F.explode(F.from_json(F.get_json_object("value", "$.media"), "array<string>")).alias("media")).distinct()
        lost = fixed(refs.mapInArrow(_absent(writers.shared_folder(out)), "media string"))
        n = lost.count()
        errors += [f"no media {r['media']}" for r in lost.orderBy("media").limit(shown).collect()]
    return {"status": "failed" if errors else "passed", "missing_media": n, "errors": errors}
