"""Checks of translation outputs that are there already."""

import json

from curata import cli
from curata.plans import checks

GOOD = {"benchmark_id": "blink", "source_id": "q1", "source": {"text_fields": {"question": "One?", "options": ["a", "b"]}}, "translated": {"text_fields": {"question": "질문 하나", "options": ["가", "나"]}}}


def put(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))


def errors_of(found):
    return [e.split(": ", 1)[1] if " row " in e else e for e in found["errors"]]


def test_one_file(spark, tmp_path):
    put(tmp_path / "rows.jsonl", [GOOD, {**GOOD, "translated": {"question": "질문", "options": "A. 가\nB. 나"}}])
    assert checks.validate_output(spark, str(tmp_path / "rows.jsonl")) == {"status": "passed", "rows": {"rows.jsonl": 2}, "n_errors": 0, "errors": []}
    without = {k: v for k, v in GOOD.items() if k != "source"}
    rows = [
        {**GOOD, "translated": {}}, {**GOOD, "missing_translation_scope": ["options", "caption"]}, {**GOOD, "translated": {"question": "질문", "options": ["가"]}}, {**GOOD, "translated": {"question": "질문"}},
        without, {**GOOD, "source_id": ""}, {**GOOD, "translated": {"text_fields": {"question": "still english", "options": ["가", "나"]}}}, {**GOOD, "translated": {"question": " ", "options": {"A": "", "B": " "}}}, {**GOOD, "missing_translation_scope": "question"},
    ]
    put(tmp_path / "bad/translation_smoke.jsonl", rows)
    found = checks.validate_output(spark, str(tmp_path / "bad"))
    assert errors_of(found) == ["not translated", "missing options", "options differ", "options missing", "no source", "no source id", "field text_fields.question item 0 has no Korean text", "field is empty"]
    assert (found["status"], found["rows"], found["n_errors"]) == ("failed", {"translation_smoke.jsonl": 9}, 8)
    assert len(checks.validate_output(spark, str(tmp_path / "bad"), shown=2)["errors"]) == 2
    put(tmp_path / "none.jsonl", [])
    assert checks.validate_output(spark, str(tmp_path / "none.jsonl"))["errors"] == ["none.jsonl has no rows"]


def test_a_folder_of_benchmarks(spark, tmp_path):
    def benchmark(name, rows, said=None):
        put(tmp_path / name / "translation_smoke.jsonl", rows)
        for n in checks.REQUIRED[1:]:
            (tmp_path / name / n).write_text(json.dumps({"benchmark_id": said or name}))

    benchmark("blink", [GOOD, {**GOOD, "source_id": "q2"}])
    benchmark("mmmu_pro", [{**GOOD, "benchmark_id": "mmmu_pro"}])
    (tmp_path / "general_vqa_translation_summary.json").write_text(json.dumps({"benchmarks": ["blink", "mmmu_pro"]}))
    found = checks.validate_output(spark, str(tmp_path))
    assert (found["status"], found["rows"]) == ("passed", {"blink": 2, "mmmu_pro": 1})
    benchmark("mmmu_pro", [GOOD], "other")
    benchmark("extra", [GOOD])
    (tmp_path / "blink/inspection_examples.json").unlink()
    (tmp_path / "general_vqa_translation_summary.json").write_text(json.dumps({"benchmarks": ["blink", "mmmu_pro", "lost"]}))
    found = checks.validate_output(spark, str(tmp_path))
    assert found["errors"][:-1] == ["no output of lost", "unexpected output: extra", "blink: no inspection_examples.json", "mmmu_pro: the summary is of 'other'"]
    assert errors_of(found)[-1] == "the row is of blink" and found["n_errors"] == 5
    report, passed = cli.run(spark, cli.parser().parse_args(["validate", str(tmp_path), "--kind", "output"]))
    assert not passed and report == found


def test_no_outputs(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    found = checks.validate_output(spark, str(tmp_path / "empty"))
    assert found["status"] == "failed" and found["errors"] == ["no general_vqa_translation_summary.json", "no output of any benchmark"]
