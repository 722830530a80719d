"""Endpoints, archives, bundles of other shapes, packages on disk, their audits, gates, viewer and commands."""

import json
import os
import tarfile
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from curata import cli
from curata.functions import plain
from curata.operators import endpoint, transform
from curata.plans import gates, packaging, prepare, record
from curata.sinks import viewer, writers
from curata.sources import archives, bundles, readers


@pytest.fixture
def service():
    """A stub of a chat service: translates by rule, fails where the text says so."""
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.headers.get("Authorization"), body))
            text = body["messages"][1]["content"]
            if "refuse" in text:
                return self.send_error(500)
            if text.startswith('{"items"'):
                items = [{"index": x["index"], "translations": {k: f"번역 {v}" for k, v in x["text_fields"].items()}} for x in json.loads(text)["items"]]
                text = "```json\n" + json.dumps({"items": items[:-1] if "lose" in text else items}) + "\n```"
            else:
                text = f" 번역 {text.split('. ')[-1]} "
            data = json.dumps({"choices": [{"message": {"content": text}}]} if "odd" not in text else {"x": 1}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1", asked
    server.shutdown()


def test_endpoint(service, monkeypatch):
    url, asked = service
    one = endpoint.HttpTranslator(url, "m", concurrency=3)
    assert one([{"question": "A. What?", "note": " "}, {"question": "Why?"}]) == [{"question": "A. 번역 What?", "note": " "}, {"question": "번역 Why?"}]
    assert asked[0][0] is None and asked[0][1]["model"] == "m" and asked[0][1]["temperature"] == 0.0
    whole = endpoint.HttpTranslator(url, "m", auth="bearer", key_variable="SOME_KEY", whole_batches=True)
    with pytest.raises(endpoint.EndpointError, match="SOME_KEY"):
        whole([{"q": "x"}])
    monkeypatch.setenv("SOME_KEY", "s3cret-value")
    assert whole([{"q": "x"}, {"q": "B) y"}]) == [{"q": "번역 x"}, {"q": "B) 번역 B) y"}]
    assert asked[-1][0] == "Bearer s3cret-value" and "s3cret" not in json.dumps(whole.summary())
    for bad in ("lose", "refuse", "odd"):
        with pytest.raises(endpoint.EndpointError):
            (whole if bad == "lose" else one)([{"q": bad}])
    with pytest.raises(endpoint.EndpointError):
        endpoint.HttpTranslator("http://127.0.0.1:1/v1", "m", timeout=1)([{"q": "x"}])


def test_endpoint_in_the_map(spark, service):
    url, _ = service
    rows = spark.createDataFrame([(i, f"s{i}", {"q": "refuse" if i == 3 else f"text {i}"}) for i in range(6)], "ord bigint, source_id string, text_fields map<string,string>")
    got = {r["ord"]: (r["ok"], r["text_fields"]) for r in transform.map_texts(rows, endpoint.HttpTranslator(url, "m", concurrency=2), retries=1).collect()}
    assert [got[i][0] for i in range(6)] == [True, True, True, False, True, True] and json.loads(got[5][1]) == {"q": "번역 text 5"}


def test_auth_and_headers(monkeypatch):
    assert [endpoint.auth_mode(x) for x in (None, "", "OpenAI-OAuth", "api_key", "Bearer", "odd")] == ["none", "none", "none", "bearer_env", "bearer_env", "odd"]
    assert endpoint.request_headers("none") == {"Content-Type": "application/json"}
    with pytest.raises(endpoint.EndpointError, match="odd"):
        endpoint.request_headers("odd")
    hidden = endpoint.safe_headers({"Authorization": "Bearer abc", "X": "api_key=abcdef"}, plain.redacted_text)
    assert hidden == {"Authorization": "Bearer <redacted>", "X": "api_key=<redacted>"}
    assert endpoint.concurrency_of({"inference": {"concurrency": 4}, "smoke": {"concurrency": 2}}) == 4 and endpoint.concurrency_of({"smoke": {"concurrency": 2}}) == 2
    assert endpoint.concurrency_of({}, 0) == 1 and endpoint.concurrency_of({}) == 1
    t = endpoint.HttpTranslator.of_config({"inference": {"openai_compatible_base_url": "u", "model": "m", "timeout_seconds": 9, "auth_mode": "no_auth"}})
    assert (t.base_url, t.timeout, t.auth, t.concurrency) == ("u", 9, "no_auth", 1)


def test_plain_documents():
    document = {"a": {"token": "abc", "list": ["Authorization: Bearer xyz"]}, "password": "", "n": 3}
    assert list(plain.secrets_in(document)) == ["$.a.token", "$.a.list[0]"]
    assert plain.redacted(document) == {"a": {"token": "<redacted>", "list": ["Authorization: Bearer <redacted>"]}, "password": "", "n": 3}
    assert plain.relative_path("/a/b/c", "/a") == "b/c" and plain.relative_path("/x", "/a") == "/x"
    assert plain.download_url("http://h/", "a b.zip") == "http://h/a%20b.zip" and plain.link_name("..") == "media" and plain.link_name("a b") == "a_b"
    assert plain.config_path({"paths": {"dataset_root": "/d", "x": "y"}}, "x") == "/d/y" and plain.has_command("sh") and not plain.has_command("no-such-tool")
    assert writers.within("/a/b/../c", "/a") and not writers.within("/a/../c", "/a") and not writers.disjoint("file:///a/b", "/a")


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("one/a.png", b"aa")
        z.writestr("one/b.txt", b"b")
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    # over 2 GiB, nearly all of it a hole before the archive
    with open(tmp_path / "large.zip", "wb") as f:
        f.seek((2 << 30) + 12345)
        with zipfile.ZipFile(f, "w") as z:
            z.writestr("large/c.jpg", b"ccc")
    files = archives.listing(spark, str(tmp_path))
    held = archives.members(files)
    got = {(r["archive"].rsplit("/", 1)[-1], r["valid"], r["member"], r["size"]) for r in held.collect()}
    assert got == {("one.zip", True, "one/a.png", 2), ("one.zip", True, "one/b.txt", 1), ("bad.zip", False, None, None), ("large.zip", True, "large/c.jpg", 3)}
    report = archives.report(files, held, ["one.zip", "two.zip", "metadata.csv"])
    assert report["missing_expected_files"] == ["metadata.csv", "two.zip"] and report["present_expected_archives"] == ["one.zip"]
    assert [(a["valid_zip"], a["members"], a["image_members"]) for a in report["archives"]] == [(False, None, None), (True, 1, 1), (True, 2, 1)]
    wanted = held.where("member is not null").select("archive", "member").unionByName(spark.createDataFrame([(str(tmp_path / "one.zip"), "one/none"), (str(tmp_path / "one.zip"), "../x")], "archive string, member string"))
    done = {r["member"]: r["bytes"] for r in archives.extract(wanted, str(tmp_path / "out")).collect()}
    assert done == {"one/a.png": 2, "one/b.txt": 1, "large/c.jpg": 3, "one/none": None} and (tmp_path / "out/large/c.jpg").read_bytes() == b"ccc"


def test_tar_archives_in_parts(spark, tmp_path):
    whole = tmp_path / "x.tar.gz"
    with tarfile.open(whole, "w:gz") as t:
        for n in ("x/a.jpg", "x/b.jpg"):
            (tmp_path / "f").write_bytes(os.urandom(5000))
            t.add(tmp_path / "f", n)
    data = whole.read_bytes()
    whole.unlink()
    for i in range(0, len(data), 3000):
        (tmp_path / f"x.tar.gz.part_{i:06d}").write_bytes(data[i : i + 3000])
    groups = readers.archive_groups(archives.listing(spark, str(tmp_path), "*.tar.gz*"))
    wanted = spark.createDataFrame([("x", "x/a.jpg"), ("x", "x/b.jpg"), ("x", "x/none.jpg"), ("y", "y/a.jpg")], "stem string, member string")
    go = lambda w: {r["stem"]: (r["status"], r["n_wanted"], r["n_there"]) for r in archives.extract_tar(groups, w, str(tmp_path / "out")).collect()}
    assert go(wanted) == {"x": ("missing_members", 3, 2), "y": ("missing_archive", 1, 0)} and (tmp_path / "out/x/b.jpg").stat().st_size == 5000
    assert go(wanted.where("member <> 'x/none.jpg'"))["x"] == ("reused", 2, 2)


ROWS = [
    {"benchmark_id": "blink", "translated": {"text_fields": {"question": "질문 하나", "options": '["가", "나"]'}}, "source": {"source_record": {"id": "q1", "Question": "One?", "answer": "B", "image": "img/a.png"}, "text_fields": {"question": "One?", "options": '["a", "b"]'}, "media": ["img/a.png"]}, "source_id": "q1", "split": "val"},
    {"translated": {"question": "질문 둘", "caption": ""}, "source": {"id": "q2", "query": "Two?", "gt": {"x": ["C", "D"]}, "path": "pics.zip-member/b.png"}, "preserve_fields": {}, "source_id": "q2"},
]


def bundle(tmp_path):
    (tmp_path / "bundle/blink").mkdir(parents=True)
    (tmp_path / "bundle/blink/translation_smoke.jsonl").write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in ROWS))
    (tmp_path / "bundle/general_vqa_translation_summary.json").write_text(json.dumps({"benchmarks": ["blink"]}))
    (tmp_path / "media/img").mkdir(parents=True)
    (tmp_path / "media/img/a.png").write_bytes(b"\x89PNG1")
    with zipfile.ZipFile(tmp_path / "media/pics.zip", "w") as z:
        z.writestr("pics.zip-member/b.png", b"\x89PNG2")
    return str(tmp_path / "bundle")


def test_bundles_of_other_shapes(spark, tmp_path):
    path = bundle(tmp_path)
    files = bundles.row_files(spark, [path, f"{path}/blink", f"{path}/blink/translation_smoke.jsonl"])
    assert files == [f"{path}/blink/translation_smoke.jsonl"]
    with pytest.raises(FileNotFoundError):
        bundles.row_files(spark, [str(tmp_path / "none")])
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        bundles.row_files(spark, [str(tmp_path / "empty")])
    assert bundles.document(spark, str(tmp_path / "no.json")) == {}
    got = [r.asDict() for r in bundles.adapted(spark, files, "fallback").orderBy("ord").collect()]
    assert [r["benchmark_id"] for r in got] == ["blink", "fallback"] and [r["source_id"] for r in got] == ["q1", "q2"]
    assert got[0]["text_fields"] == {"question": "One?", "options": '["a", "b"]'} and got[1]["text_fields"] == {"question": "Two?"}
    assert got[1]["translated"] == {"question": "질문 둘"} and got[0]["translation_scope"] == ["question", "options"]
    assert got[0]["media"] == ["img/a.png"] and got[1]["media"] == ["pics.zip-member/b.png"] and got[0]["preserve_fields"] == {"answer": "B"}
    p = bundles.parts(F.col("value"))
    values = spark.read.text(files[0]).select(p["answer"].alias("a"), bundles.options_of(p).alias("o"), bundles.failure_id(p["own"], p["source"], F.lit(7)).alias("f")).collect()
    assert [r["a"] for r in values] == ["B", "C\nD"] and [r["o"] for r in values] == ['["a", "b"]', None] and [r["f"] for r in values] == ["q1", "q2"]


def package(spark, tmp_path, **more):
    rows = bundles.adapted(spark, bundles.row_files(spark, [bundle(tmp_path)]), "fallback")
    exported = record.export(rows, "set", "", "", "now", "passed")
    return packaging.write_package(spark, exported, [str(tmp_path / "media")], str(tmp_path / "package"), "set", "now", "passed", **more)


def test_package_on_disk(spark, tmp_path):
    made = package(spark, tmp_path)
    out = tmp_path / "package"
    assert made["splits"].keys() == {"validation", "test"} and made["media_packaging"]["copied_files"] == 2 and made["validation"]["status"] == "passed"
    rows = [json.loads(x) for s in ("test", "validation") for x in (out / s / "metadata.jsonl").read_text().splitlines()]
    assert {r["record_id"] for r in rows} == {"blink/validation/q1", "fallback/test/q2"} and set(rows[0]) == set(record.PACKAGE_COLUMNS)
    for r in rows:
        assert (out / r["media_files"][0]).read_bytes()[:4] == b"\x89PNG" and (out / r["split"] / r["file_name"]).exists()
    with pytest.raises(FileExistsError):
        packaging.write_package(spark, spark.createDataFrame([], record.EXPORT_SCHEMA), [], str(out), "n", "now", "passed")
    code = cli.main(["validate", str(out), "--kind", "package"])
    assert code == 0


def test_missing_media(spark, tmp_path):
    bundle(tmp_path)
    (tmp_path / "media/img/a.png").unlink()
    rows = bundles.adapted(spark, bundles.row_files(spark, [str(tmp_path / "bundle")]), "fallback")
    exported = record.export(rows, "set", "", "", "now", "passed")
    go = lambda allow: packaging.write_package(spark, exported, [str(tmp_path / "media")], str(tmp_path / f"package{allow}"), "set", "now", "passed", allow_missing=allow)
    with pytest.raises(ValueError, match="missing"):
        go(False)
    with pytest.raises(ValueError, match="file_name"):  # written, but not valid without a primary image
        go(True)


@pytest.mark.parametrize(
    ("change", "said"),
    [
        (lambda r: r.pop("question_ko"), "missing column"), (lambda r: r.update(extra=1), "unexpected column"), (lambda r: r.update(exported_at="x"), "process column"), (lambda r: r.update(file_name=""), "no file_name"),
        (lambda r: r.update(file_name="/etc/x.png"), "not relative"), (lambda r: r.update(file_name="../x.png"), "leaves the split"), (lambda r: r.update(media_files="x"), "no list"), (lambda r: r.update(media_files=["http://x/y.png"]), "not relative"),
        (lambda r: r.update(media_files=["a/../../x"]), "leaves the package"), (lambda r: r.update(media_files=["none.png"]), "no file"), (lambda r: r.update(answer="api_key=abcdefgh"), "secret"), (lambda r: r.update(answer="see /home/x"), "process marker"),
        (lambda r: r.update(record_id=""), "no record id"), (lambda r: r.update(preserve_fields_json='{"a": {"b": {"token": "abcdef"}}}'), "secret"),
    ],
)
def test_row_rules(spark, tmp_path, change, said):
    row = {c: "x" for c in record.PACKAGE_COLUMNS} | {"record_id": "r", "split": "test", "file_name": "images/a.png", "media_files": ["test/images/a.png"]}
    change(row)
    rows = spark.createDataFrame([("test", 0, json.dumps(row))], "split string, place bigint, value string")
    files = spark.createDataFrame([("test/images/a.png",)], "path string")
    found = [r["error"] for r in packaging.row_problems(rows, files).collect()]
    assert any(said in e for e in found), found


def test_manifest_rules():
    good = {"schema_version": 1, "splits": {"test": {"num_rows": 1}}, "columns": ["record_id"], "source": {}}
    assert packaging.manifest_problems(good) == []
    deep = {"a": {"b": {"c": {"d": {"e": {"Git_SHA": 1}}}}}}
    for bad, said in ((good | {"x": 1}, "unexpected key"), (good | {"source": {"y": 1}}, "unexpected key"), (good | {"source": deep}, "forbidden key"), (good | {"columns": "x"}, "no list"), (good | {"columns": ["zzz"]}, "unexpected column"), (good | {"splits": {}}, "no splits"), (good | {"splits": {"..": {"num_rows": 1}}}, "unsafe"), (good | {"splits": {"a": 1}}, "no object"), (good | {"splits": {"a": {"num_rows": True}}}, "number of rows"), (good | {"splits": {"a": {"num_rows": 1, "z": 1}}}, "unexpected key"), ([], "no JSON object"), (good | {"dataset_name": "token=abcdefgh"}, "secret"), (good | {"dataset_name": "MLXP"}, "marker")):
        assert any(said in e for e in packaging.manifest_problems(bad)), (bad, said)


def test_viewer(spark, tmp_path):
    package(spark, tmp_path)
    out = str(tmp_path / "view")
    made = viewer.write(spark, [str(tmp_path / "package")], out)
    assert made == {"record_count": 2, "benchmarks": {"blink": 1, "fallback": 1}, "media_refs": 2} and viewer.validate(spark, out)["status"] == "passed"
    first = json.loads((tmp_path / "view/records.jsonl").read_text().splitlines()[0])
    assert first["record_id"] == "blink/validation/q1" and first["options_ko"] == ["가", "나"] and os.path.exists(f"{out}/{first['media'][0]}")
    with pytest.raises(FileExistsError):
        viewer.write(spark, [str(tmp_path / "package")], out)
    with pytest.raises(ValueError, match="one another"):
        viewer.write(spark, [str(tmp_path / "package")], str(tmp_path / "package/view"))
    os.unlink(tmp_path / "package" / first["media"][0].split("/", 1)[1])
    assert viewer.validate(spark, out)["missing_media"] == 1


def test_sanity_gate(spark, tmp_path):
    rows = [{"question": f"q{i}", "options": ["a", "b"], "image": f"{i}.png"} for i in range(4)]
    (tmp_path / "annotations.json").write_text(json.dumps(rows))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.png", b"1")
    config = {"source": {"expected_rows": 4, "archive_files": ["a.zip"]}, "smoke": {"sample_size": 2}}
    report = gates.sanity(spark, str(tmp_path), config)
    assert (report["status"], report["errors"], report["checks"]["row_count"]) == ("passed", [], 4) and report["warnings"]
    config["source"] |= {"expected_rows": 5, "archive_files": ["a.zip", "b.zip"], "expected_images": 3}
    assert len(gates.sanity(spark, str(tmp_path), config)["errors"]) == 3 and gates.sanity(spark, str(tmp_path), config, allow_partial=True)["status"] == "passed"
    assert gates.sanity(spark, str(tmp_path / "none"), config)["status"] == "failed"


def test_run_records():
    made = gates.new_record({}, "run", "now")
    assert gates.record_errors(made) == []
    made |= {"status": "passed"}
    made["translation"]["mode"] = gates.DUAL_MODE
    errors = gates.record_errors(made)
    assert sum("is not" in e for e in errors) == 3 and sum("no evidence" in e for e in errors) == 9
    assert gates.record_errors({"schema_version": 1, "commands": [], "token": "abcdef"})[-1] == "schema_version is not 2"
    with pytest.raises(ValueError):
        gates.download_plan({"source": {"hf_url": "http://h/datasets/a/b"}}, "odd", "t")
    assert gates.download_plan({"source": {"hf_url": "http://h/datasets/a/b"}}, "hf-cli", "t")["commands"][0][2] == "a/b"


def test_prepared_sources(spark, tmp_path):
    (tmp_path / "blink/Count").mkdir(parents=True)
    image = {"bytes": b"\x89PNG\r\n", "path": None}
    schema = "idx string, question string, choices array<string>, answer string, prompt string, image_1 struct<bytes:binary,path:string>, image_2 struct<bytes:binary,path:string>"
    spark.createDataFrame([("c1", "how many", ["1", "2"], "A", "p", image, None), ("", "what", [], "B", "", image, image)], schema).coalesce(1).write.parquet(str(tmp_path / "raw"))
    part = next((tmp_path / "raw").glob("*.parquet"))
    part.rename(tmp_path / "blink/Count/val-00000.parquet")
    made = prepare.blink(spark, str(tmp_path / "blink"), str(tmp_path / "out/blink"))
    assert (made["rows"], made["media_files_written"], made["source_splits"], made["tasks"]) == (2, 3, {"val": 2}, {"Count": 2})
    rows = [json.loads(x) for x in (tmp_path / "out/blink/samples.jsonl").read_text().splitlines()]
    assert all((tmp_path / "out/blink" / p).read_bytes() == image["bytes"] for r in rows for p in r["image_paths"]) and {r["id"] for r in rows} == {"c1", "val_Count_000001"}
    assert prepare.blink(spark, str(tmp_path / "blink"), str(tmp_path / "out/blink"))["media_files_reused"] == 3
    (tmp_path / "mme").mkdir()
    (tmp_path / "mme/MME_RealWorld.json").write_text(json.dumps([{"Question_id": "m1", "Image": "./set/a.jpg", "Text": "t", "Answer choices": ["(A) x"], "Ground truth": "A", "Task": "T", "Subtask": "S"}, {"Image": "set/b.jpg", "Text": "u"}]))
    (tmp_path / "a").write_bytes(b"1")
    with tarfile.open(tmp_path / "mme/set.tar.gz", "w:gz") as t:
        t.add(tmp_path / "a", "set/a.jpg")
    made = prepare.mme(spark, str(tmp_path / "mme"), str(tmp_path / "out/mme"), extract=True)
    assert (made["rows"], made["status"], made["missing_media_after_prepare"], made["source_image_prefixes"]) == (2, "needs_media", 1, {"set": 2})
    assert made["media_extraction"] == {"set": {"status": "missing_members", "needed": 2, "missing": 1}} and made["tasks"] == {"S": 1, "unknown": 1}


def test_commands(spark, tmp_path, capsys):
    assert cli.main(["list"]) == 0 and "BLINK" in capsys.readouterr().out
    path = bundle(tmp_path)
    out = str(tmp_path / "made")
    assert cli.main(["package", path, "--out", out, "--media-roots", str(tmp_path / "media"), "--status", "passed", "--fallback", "other"]) == 0
    assert cli.main(["view", out, "--out", str(tmp_path / "view")]) == 0
    assert cli.main(["validate", str(tmp_path / "view"), "--kind", "viewer"]) == 0
    assert cli.main(["report", out, "--bundles", str(tmp_path), "--out", str(tmp_path / "report")]) == 2 and (tmp_path / "report/report.md").exists()
    assert cli.main(["record", "init", str(tmp_path / "record.json")]) == 0 and cli.main(["record", "validate", str(tmp_path / "record.json")]) == 0
    assert cli.main(["export", str(tmp_path / "none"), "blink", str(tmp_path / "export")]) == 1
    assert cli.main(["sanity", str(tmp_path / "nowhere")]) == 2
