"""Jobs over files, from raw records to the report."""

import json

import pytest

from curata.plans import jobs

ROWS = [
    {"uid": f"u{i}", "split": "val", "task": "count", "question": f"A. How many {i}?", "choices": "A. 3\nB. 4", "answer": "A", "images": ["img/a.png"]} for i in range(7)
]


def test_from_records_to_report(spark, tmp_path):
    (tmp_path / "in/blink").mkdir(parents=True)
    (tmp_path / "in/blink/blink.json").write_text(json.dumps(ROWS))
    root, out = str(tmp_path / "in"), str(tmp_path / "bundle")

    def translate(batch):
        if any("How many 5" in x["question"] for x in batch):
            raise RuntimeError("refused")
        return jobs.transform.mock(batch)

    first = jobs.translate_full(spark, root, "blink", out, translate=translate)
    assert (first["source_count"], first["translated_count"], first["failure_count"], first["status"]) == (7, 6, 1, "passed")
    again = jobs.translate_full(spark, root, "blink", out, resume=True)
    assert (again["translated_count"], again["failure_count"]) == (6, 1)  # what failed is done too
    fresh = jobs.translate_full(spark, root, "blink", out)
    assert (fresh["translated_count"], fresh["failure_count"], fresh["translated_fields"]) == (7, 0, {"question": 7, "options": 7})
    assert jobs.bundle_gaps(spark, out, ["blink"]).isEmpty()
    assert {r["artifact"] for r in jobs.bundle_gaps(spark, out, ["mmmu_pro"]).collect()} == {"rows", *jobs.BUNDLE_REPORTS}
    manifest = jobs.export(spark, out, "blink", str(tmp_path / "export"), "n", "run", "now", "passed")
    assert manifest["splits"] == {"val": {"num_rows": 7}}
    with pytest.raises(FileExistsError):
        jobs.export(spark, out, "blink", str(tmp_path / "export"), "n", "run", "now")
    with pytest.raises(ValueError, match="incomplete"):
        jobs.export(spark, out, "mmmu_pro", str(tmp_path / "none"), "n", "run", "now")
    files = spark.createDataFrame([("img/a.png", 0)], "path string, root_ord int")
    members = spark.createDataFrame([], "member string, archive string, archive_ord int")
    public, missing = jobs.package_rows(spark, out, "blink", files, members, "n", "run", "now", "passed")
    assert missing.isEmpty() and {r["split"] for r in public.collect()} == {"validation"}
    got, markdown = jobs.report_over({"blink": (fresh, public)})
    assert got["status"] == "passed" and got["totals"]["packaged"] == 7 and "| blink | 7 |" in markdown


def test_samples(spark, tmp_path):
    (tmp_path / "mmmu_pro").mkdir()
    (tmp_path / "mmmu_pro/test.json").write_text(json.dumps(ROWS))
    got = jobs.translate_sample(spark, str(tmp_path), "mmmu", str(tmp_path / "out"), size=3, seed=5)
    assert got["mmmu_pro"]["translated_count"] == 3 and got["mmmu_pro"]["status"] == "passed"
    with pytest.raises(FileNotFoundError):
        jobs.load(spark, str(tmp_path), "blink")
