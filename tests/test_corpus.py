"""Bundles in several runs, a limit on requests, and the nested corpus."""

import json
import os
import shutil
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from curata import cli
from curata.operators import endpoint, transform
from curata.plans import jobs
from curata.sources import bundles

ROWS = [{"uid": f"u{i}", "split": "val", "question": f"A. How many {i}?", "choices": "A. 3\nB. 4", "answer": "A", "images": ["a.png"], "rationale": "so"} for i in range(40)]


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names}


def content(spark, out):
    read = lambda part: sorted(r["value"] for r in spark.read.option("recursiveFileLookup", True).text(f"{out}/{part}").collect())
    return {part: read(part) for part in ("rows", "failed", "errors")} | {n: bundles.document(spark, f"{out}/{n}") for n in jobs.BUNDLE_REPORTS[:1] + jobs.BUNDLE_REPORTS[2:]}


def refuser():
    def refusing(batch):
        if any("How many 7?" in x["question"] for x in batch):
            raise RuntimeError("refused")
        return transform.mock(batch)

    return refusing


def test_a_resume_touches_its_own_rows(spark, tmp_path):
    """Runs add up to what one run over all rows gives, and leave each other's files alone."""
    (tmp_path / "in/blink").mkdir(parents=True)
    (tmp_path / "in/blink/blink.json").write_text(json.dumps(ROWS))
    root, one, several = str(tmp_path / "in"), str(tmp_path / "one"), str(tmp_path / "several")
    whole = jobs.translate_full(spark, root, "blink", one, translate=refuser())
    jobs.translate_full(spark, root, "blink", several, limit=38, translate=refuser(), commit_rows=20)
    before = files(tmp_path / "several/blink")
    assert sorted(os.listdir(tmp_path / "several/blink/stats"))[-2:] == ["run-000000.json", "run-000001.json"]
    again = jobs.translate_full(spark, root, "blink", several, resume=True, translate=refuser())
    after = files(tmp_path / "several/blink")
    kept = {f for f in before if "/run-" in f}
    assert kept and all(after[f] == before[f] for f in kept)
    new = [r["ord"] for r in spark.read.parquet(f"{several}/blink/results/run-000002").collect()]
    assert sorted(new) == [38, 39]
    assert again == whole and whole["failure_count"] == 1 and whole["status"] == "passed" and whole["inference"] == {"translator": "refusing"}
    assert content(spark, f"{one}/blink") == content(spark, f"{several}/blink")
    assert bundles.document(spark, f"{one}/blink/untranslated_fields.json") == {"untranslated_text_fields": {"answer": 40 - 1, "rationale": 40 - 1}, "missing_configured_translation_fields": {}}
    progress = bundles.document(spark, f"{several}/blink/{jobs.PROGRESS}")
    assert (progress["previously_done"], progress["pending_start"], progress["ok_written_this_run"], progress["failures_this_run"]) == (38, 2, 2, 0)
    with open(f"{several}/blink/inspection_examples.json") as f:
        assert [x["ord"] for x in json.load(f)] == [0, 1, 2]


def test_a_run_that_ended_early(spark, tmp_path):
    """Results without a report are committed by the next run; results that are not whole are done again."""
    (tmp_path / "in/blink").mkdir(parents=True)
    (tmp_path / "in/blink/blink.json").write_text(json.dumps(ROWS))
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    whole = jobs.translate_full(spark, root, "blink", out, commit_rows=15)
    expected = content(spark, f"{out}/blink")
    for n in ("stats/run-000001.json", "results/run-000002/_SUCCESS", "stats/run-000002.json"):
        os.unlink(f"{out}/blink/{n}")
    for part in ("rows", "failed", "errors"):
        shutil.rmtree(f"{out}/blink/{part}/run-000002")
    again = jobs.translate_full(spark, root, "blink", out, resume=True)
    assert again == whole
    assert content(spark, f"{out}/blink") == expected


@pytest.fixture
def counting():
    """A stub of a chat service that counts the requests that it has at once."""
    state = {"now": 0, "most": 0, "all": 0}
    lock = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            with lock:
                state["now"] += 1
                state["all"] += 1
                state["most"] = max(state["most"], state["now"])
            time.sleep(0.03)
            with lock:
                state["now"] -= 1
            data = json.dumps({"choices": [{"message": {"content": "번역 " + body["messages"][1]["content"]}}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1", state
    server.shutdown()


@pytest.mark.parametrize(("requests", "threads", "most"), [(2, 1, 2), (3, 2, 2), (None, 1, 4)])
def test_requests_at_once(spark, tmp_path, counting, requests, threads, most):
    url, state = counting
    (tmp_path / "in/blink").mkdir(parents=True)
    (tmp_path / "in/blink/blink.json").write_text(json.dumps(ROWS))
    done = jobs.translate_full(spark, str(tmp_path / "in"), "blink", str(tmp_path / "out"), translate=endpoint.HttpTranslator(url, "m", concurrency=threads), requests=requests)
    assert done["translated_count"] == 40 and state["all"] == 80 and state["most"] <= most
    assert done["inference"] == {"base_url": url, "model": "m", "auth_mode": "none", "api_key_env": "OPENAI_API_KEY"}


NESTED = {
    "img/a.png": {"mask_path": "m.png", "class_name": "bolt", "conversation": [{"Question": "Is it bent?", "Options": {"A": "Yes, it is.", "B": "No, it isn't."}, "Answer": "A", "note": "look closely"}, {"Question": "Where?", "Answer": "B"}]},
    "img/b.png": {"similar_templates": ["t.png"], "conversation": [{"Question": "A broken part?", "Options": {"A": "One part.", "B": "Two parts."}, "caption": "A bolt.", "Answer": "B"}]},
    "img/c.png": {"conversation": []},
}


def test_nested_corpus(spark, tmp_path):
    """Units are turns of images; rules R1 to R13 on what a turn lacks, and an export of it."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/mmad.json").write_text(json.dumps(NESTED))
    done = jobs.translate_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), requests=1)
    bundle = f"{tmp_path}/out/{jobs.CORPUS}"
    assert (done["source_count"], done["translated_count"], done["translated_fields"]) == (3, 3, {"question": 3, "options": 3, "caption": 3})
    errors = {(r["ord"], r["error"]) for r in spark.read.option("recursiveFileLookup", True).json(f"{bundle}/errors").collect()}
    assert errors == {(1, "missing options")} and done["status"] == "failed"  # R3: a question without options
    found = bundles.document(spark, f"{bundle}/untranslated_fields.json")
    assert found == {"untranslated_text_fields": {"note": 1}, "missing_configured_translation_fields": {"caption": 2, "options": 1}}
    rows = [r.asDict() for r in jobs._translated(spark, str(tmp_path / "out"), [jobs.CORPUS]).orderBy("ord").collect()]
    assert [r["source_record"]["mmad_image_key"] for r in rows] == ["img/a.png", "img/a.png", "img/b.png"] and [r["source_record"]["conversation_index"] for r in rows] == ["0", "1", "0"]
    assert rows[0]["translated"]["question"] == transform.MOCK_PREFIX + "Is it bent?" and rows[0]["media"] == ["img/a.png"] and rows[0]["benchmark_id"] == jobs.CORPUS
    manifest = jobs.export(spark, str(tmp_path / "out"), jobs.CORPUS, str(tmp_path / "export"), "n", "run", "now")
    assert manifest["splits"] == {"test": {"num_rows": 3}}
    ids = [r["source_id"] for r in spark.read.parquet(str(tmp_path / "export/dataset")).collect()]
    assert len(set(ids)) == 3
    assert jobs.bundle_gaps(spark, str(tmp_path / "out"), [jobs.CORPUS]).isEmpty()


def test_corpus_rules_and_sample(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"id": f"r{i}", "Question": f"What is part {i}?", "options": "A. one part\nB. two parts", "caption": ""} for i in range(20)]
    rows[3].pop("Question")
    rows[4] = {"id": "r4", "answer": "only"}
    (tmp_path / "in/annotations.json").write_text(json.dumps(rows))
    out = str(tmp_path / "out")
    done = jobs.translate_corpus(spark, str(tmp_path / "in"), out)
    errors = {(r["ord"], r["error"]) for r in spark.read.option("recursiveFileLookup", True).json(f"{out}/mmad/errors").collect()}
    assert errors == {(3, "missing question"), (4, "not translated")} and done["translated_count"] == 20
    assert bundles.document(spark, f"{out}/mmad/untranslated_fields.json")["missing_configured_translation_fields"] == {"caption": 20, "options": 1, "question": 2}
    drawn = jobs.translate_corpus(spark, str(tmp_path / "in"), str(tmp_path / "few"), size=5, seed=1)
    assert drawn["translated_count"] == 5
    args = cli.parser().parse_args(["corpus", str(tmp_path / "in"), str(tmp_path / "by-cli"), "--size", "3", "--mock", "--commit-rows", "2"])
    found, _ = cli.run(spark, args)
    assert found["translated_count"] == 3 and found["inference"] == {"translator": "mock"}


def test_rows_without_text_fields(spark, tmp_path):
    """R4: a benchmark's row without any configured field."""
    (tmp_path / "in/blink").mkdir(parents=True)
    (tmp_path / "in/blink/blink.json").write_text(json.dumps([ROWS[0], {"uid": "none", "answer": "A"}]))
    jobs.translate_full(spark, str(tmp_path / "in"), "blink", str(tmp_path / "out"))
    errors = {(r["ord"], r["error"]) for r in spark.read.option("recursiveFileLookup", True).json(f"{tmp_path}/out/blink/errors").collect()}
    assert errors == {(1, "missing text_fields"), (1, "field is empty")}
    (tmp_path / "alone.json").write_text(json.dumps(ROWS[:2]))  # a root that is the file itself
    path, rows = jobs.load(spark, str(tmp_path / "alone.json"), "blink")
    assert path.endswith("alone.json") and rows.count() == 2 and rows.select(F.max("ord")).first()[0] == 1


def test_doubled_keys_in_bundles(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"translated": {"question": "하나"}, "source": {"id": "a", "id": "b", "query": "One?"}, "split": "x", "split": "val"}\n')
    (row,) = bundles.adapted(spark, [str(tmp_path / "r.jsonl")]).collect()
    assert (row["split"], row["source_record"]["id"]) == ("val", "b")
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="not JSON"):
        bundles.adapted(spark, [str(tmp_path / "bad.jsonl")]).collect()
