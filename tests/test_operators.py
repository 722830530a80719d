"""Sources, sinks, plans and the resumable map on files."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from curata.functions.identity import safe_part
from curata.operators import audit, media, report, sampling, transform, validate
from curata.plans import package, record, specs
from curata.sinks import writers
from curata.sources import readers
from curata.streaming import resumable


def rows(df):
    return [r["row"] for r in df.orderBy("ord").collect()]


def test_json_shapes(spark, tmp_path):
    cases = {
        "list.json": ([{"id": 1}, 5, {"id": 2, "options": {"A": "x"}}], [{"id": "1"}, {"id": "2", "options": '{"A":"x"}'}]),
        "wrapped.json": ({"meta": 1, "questions": [{"id": 3}]}, [{"id": "3"}]),
        "one.json": ({"id": 4, "q": "x"}, [{"id": "4", "q": "x"}]),
        "scalar.json": (7, []),
    }
    for name, (value, expected) in cases.items():
        (tmp_path / name).write_text(json.dumps(value))
        assert rows(readers.read_records(spark, str(tmp_path / name))) == expected, name


def test_image_keyed_json(spark, tmp_path):
    doc = {"a.png": {"conversation": [{"Question": "q0"}, {"Question": "q1"}], "kind": "k"}, "b.png": {"kind": "l"}}
    (tmp_path / "mmad.json").write_text(json.dumps(doc))
    got = rows(readers.read_json(spark, str(tmp_path / "mmad.json")))
    assert [(r["mmad_image_key"], r.get("conversation_index"), r.get("Question"), r["kind"]) for r in got] == [("a.png", "0", "q0", "k"), ("a.png", "1", "q1", "k"), ("b.png", None, None, "l")]


def test_jsonl_modes(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": 1}\n\n[2]\n{"id": 3}\n')
    assert [r["id"] for r in rows(readers.read_jsonl(spark, str(path)))] == ["1", "3"]
    assert len(rows(readers.read_jsonl(spark, str(path), "any"))) == 3
    with pytest.raises(Exception, match="not a JSON object"):
        readers.read_jsonl(spark, str(path), "strict").collect()
    assert readers.count_jsonl(spark, str(path)) == 3


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿id,options\n1,"A: x\nB: ""y"""\n2,\n'.encode())
    assert rows(readers.read_records(spark, str(tmp_path / "a.csv"))) == [{"id": "1", "options": 'A: x\nB: "y"'}, {"id": "2", "options": None}]
    (tmp_path / "a.txt").write_text("x")
    assert rows(readers.read_records(spark, str(tmp_path / "a.txt"))) == []


def test_discovery(spark, tmp_path):
    for name in ("z/annotations.json", "a/other.json", "b/metadata.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("[]" if name.endswith("json") else "id\n")
    files = readers.listing(spark, str(tmp_path))
    assert readers.candidate_files(files) == ["b/metadata.csv", "z/annotations.json"]
    assert readers.candidate_files(files, ("other.json",)) == ["a/other.json"]
    assert readers.load_first(spark, str(tmp_path))[0] is None
    (tmp_path / "z/annotations.json").write_text('[{"id": 1}]')
    assert readers.load_first(spark, str(tmp_path))[0] == "z/annotations.json"


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a/x.png", b"1")
        z.writestr("a/y.txt", b"2")
    (tmp_path / "bad.zip").write_bytes(b"nothing")
    got = {(r["archive"].rsplit("/", 1)[-1], r["valid"], r["member"]) for r in readers.archive_members(spark, str(tmp_path)).collect()}
    assert got == {("a.zip", True, "a/x.png"), ("a.zip", True, "a/y.txt"), ("bad.zip", False, None)}
    listing = spark.createDataFrame([("p/x.tar.gz",), ("p/x.tar.gz.part_b",), ("p/x.tar.gz.part_a",), ("p/y.tar.gz",)], "path string")
    groups = {r["stem"]: r["parts"] for r in readers.archive_groups(listing).collect()}
    assert groups == {"x": ["p/x.tar.gz.part_a", "p/x.tar.gz.part_b"], "y": ["p/y.tar.gz"]}


def test_blob_parquet(spark, tmp_path):
    df = spark.sql("select 'q' as question, named_struct('bytes', cast('x' as binary), 'path', 'i.png') as image_1, cast(null as struct<bytes:binary,path:string>) as image_2")
    df.coalesce(1).write.parquet(str(tmp_path / "raw"))
    part = next((tmp_path / "raw").glob("*.parquet"))
    (tmp_path / "root/Counting").mkdir(parents=True)
    part.rename(tmp_path / "root/Counting/val-00000.parquet")
    r = readers.read_blob_parquet(spark, str(tmp_path / "root")).first()
    assert (r["task"], r["split"], len(r["images"]), r["images"][0]["path"]) == ("Counting", "val", 1, "i.png")


RAW = [
    {"uid": "u1", "split": "val", "task": "t", "question": "A. Which?", "choices": '{"A": "token=abc", "B": "3"}', "answer": "A", "images": '["b.png", "a.png"]', "rationale": "why"},
    {"uid": "u1", "split": "val", "task": "t", "question": "Other?", "answer": "B", "images": '["b.png"]'},
    {"question": "No id?", "choices": ""},
]


def exported(spark):
    raw = spark.createDataFrame([(r, i) for i, r in enumerate(RAW)], "row map<string,string>, ord bigint")
    adapted = record.translate_columns(record.adapt(raw, "blink"))
    return record.export(adapted, "name", "out/a.jsonl", "run", "20260101T000000Z", "passed")


def test_adapt(spark):
    raw = spark.createDataFrame([(r, i) for i, r in enumerate(RAW)], "row map<string,string>, ord bigint")
    got = record.adapt(raw, "blink").orderBy("ord").collect()
    assert [r["source_id"] for r in got] == ["u1", "u1", "blink-000002"]
    assert got[0]["translation_scope"] == ["question", "options"] and got[0]["media"] == ["b.png", "a.png"]
    assert got[0]["skip_fields"] == {"rationale": "why"} and got[0]["preserve_fields"] == {"answer": "A", "task": "t"}
    assert got[2]["split"] is None and got[2]["text_fields"] == {"question": "No id?"}


def test_export(spark):
    df = exported(spark)
    assert df.columns == list(record.EXPORT_COLUMNS) and len(record.EXPORT_COLUMNS) == 31
    got = {r["question_original"]: r for r in df.collect()}
    r = got["A. Which?"]
    assert r["record_id"] == "blink/val/u1" and r["media"] == ["a.png", "b.png"] and r["question_ko"].startswith("A. 한국어")
    assert "abc" not in json.dumps(r.asDict(), ensure_ascii=False) and got["No id?"]["split"] == "test" and got["No id?"]["options_original_json"] == "null"


def test_package(spark):
    packaged = record.repackage(exported(spark), ["question_original"])
    got = {r["question_original"]: r for r in packaged.collect()}
    assert got["A. Which?"]["record_id"] == "blink/validation/u1" and got["A. Which?"]["source_split"] == "val" and got["A. Which?"]["source_record_id"] == "blink/val/u1"
    assert got["Other?"]["record_id"].startswith("blink/validation/u1__dup_1_")
    public = record.public(packaged.withColumn("media_files", F.col("media")))
    assert package.column_errors(public) == []
    assert package.column_errors(public.withColumn("odd", F.lit(1)).withColumn("exported_at", F.lit(1))) == ["process column: exported_at", "unexpected column: odd"]
    errors = package.row_audit(public, spark.createDataFrame([("a.png",)], "path string"), ["run_records"]).collect()
    assert {r["error"] for r in errors} == {"no file b.png"}
    bad = public.withColumn("media_files", F.array(F.lit("../x"))).withColumn("answer", F.lit("password=zz run_records")).withColumn("split", F.lit(".."))
    assert {"unsafe split", "path leaves the package", "process marker", "secret at $.answer"} <= {r["error"] for r in package.row_audit(bad, public.select(F.lit("x").alias("path")), ["run_records"]).collect()}


def test_sinks(spark, tmp_path):
    df = exported(spark)
    writers.write_dataset(df, str(tmp_path / "d"), record.EXPORT_SCHEMA)
    assert {p.name for p in (tmp_path / "d").glob("split=*")} == {"split=val", "split=test"}
    assert spark.read.parquet(str(tmp_path / "d")).count() == 3
    writers.write_jsonl(df, str(tmp_path / "j"))
    back = readers.read_jsonl(spark, str(tmp_path / "j/*/*.txt"))
    assert back.count() == 3 and list(json.loads(writers.json_lines(df).first()["value"])) == sorted(df.columns)
    with pytest.raises(Exception, match="exists"):
        writers.write_jsonl(df, str(tmp_path / "j"))
    writers.write_report(spark, {"a": "한"}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": "한"}
    assert not writers.is_empty_dir(spark, str(tmp_path)) and writers.is_empty_dir(spark, str(tmp_path / "none"))
    assert writers.disjoint("/a/b", "/a/c") and not writers.disjoint("/a", "/a/c")


def test_manifest_and_run_record():
    m = package.manifest("n", {"test": 2}, ["b", "a"], source={"api_key": "x", "ok": 1})
    assert package.manifest_errors(m, {"": {"dataset_name", "splits", "columns", "source"}, "source": {"ok", "api_key"}}, {"api_key"}) == ["forbidden key: manifest.source.api_key"]
    assert package.manifest_errors(m, {"source": {"ok"}}, set()) == ["unexpected key: manifest.source.api_key"]
    r = package.run_record("id", "now", {}, {})
    assert package.run_record_errors(r) == []
    r["verification"]["status"] = "passed"
    assert package.run_record_errors(r) == ["empty: verification.evidence", "empty: outputs.artifacts"]
    assert "| test | 2 |" in package.card("n", {"test": 2}, "passed")
    assert package.root_labels(["/x/A b", "/"]) == ["input-00-a_b", "input-01-input"]


def test_ids():
    assert specs.parse_ids("MME, mmmu-pro,blink,mme") == ["mme_realworld", "mmmu_pro", "blink"]
    with pytest.raises(KeyError):
        specs.normal_id("other")


def test_retry_and_bisection():
    calls = []

    def translate(batch):
        calls.append(len(batch))
        if any("bad" in x["q"] for x in batch):
            raise RuntimeError("no")
        return [{"q": x["q"].upper()} for x in batch]

    batch = [(i, str(i), {"q": t}) for i, t in enumerate(["a", "b", "bad", "c"])]
    got = list(transform.attempt(batch, translate, transform.problems, 1, 0))
    assert [(x[0], r) for x, r, _ in got] == [(0, {"q": "A"}), (1, {"q": "B"}), (2, None), (3, {"q": "C"})]
    assert calls == [4, 4, 2, 2, 2, 1, 1, 1][: len(calls)] and got[2][2] == ["RuntimeError: no"]


def test_resumable(spark, tmp_path):
    schema = "i bigint, t string"
    prepare = lambda df: df.select(F.col("i").alias("ord"), F.col("i").cast("string").alias("source_id"), F.create_map(F.lit("q"), "t").alias("text_fields"))
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    spark.createDataFrame([(0, "a"), (1, "b")], schema).coalesce(1).write.parquet(source)
    go = lambda: resumable.run_available(spark, source, schema, prepare, out, mark)
    assert go() == {"ok": 2, "failed": 0}
    assert go() == {"ok": 0, "failed": 0}
    spark.createDataFrame([(2, "c")], schema).coalesce(1).write.mode("append").parquet(source)
    assert go() == {"ok": 1, "failed": 0}
    assert spark.read.parquet(out + "/rows").where("part = 'ok'").count() == 3


def test_samples(spark):
    assert sampling.sample_places(3, 5, 1) == [0, 1, 2]
    df = sampling.with_ordinal(spark.range(50).select((F.col("id") * 7 % 50).alias("k")), ["k"])
    assert [(r["k"], r["ord"]) for r in df.orderBy("k").collect()] == [(i, i) for i in range(50)]
    got = sorted(r["ord"] for r in sampling.seeded_sample(df, "ord", 50, 5, 9).collect())
    assert got == sampling.sample_places(50, 5, 9) and len(got) == 5


def test_media(spark):
    name = spark.range(1).select(media.file_name(F.lit("/a/b c.PNG"), F.lit("b c"), F.lit("PNG")).alias("n"), media.safe_member(F.lit("../x")).alias("a"), media.safe_member(F.lit("a/../x")).alias("b"), safe_part(F.lit("..é b")).alias("p")).first()
    assert name["n"].endswith("-b_c.png") and name["a"] == "x" and name["b"] is None and name["p"] == "é_b"
    sniff = spark.range(1).select(media.image_suffix(F.lit("a"), F.unhex(F.lit("89504E470D0A"))).alias("a"), media.image_suffix(F.lit("a.JPG"), F.lit(None).cast("binary")).alias("b"), media.image_suffix(F.lit("a"), F.unhex(F.lit("00"))).alias("c")).first()
    assert tuple(sniff) == (".png", ".jpg", ".bin")


def test_review_reasons(spark):
    reasons = validate.review_reasons(F.lit("질문"), F.lit("a"), F.array(F.lit("a")), F.lit(False), F.array(F.lit("assistant manager")), F.lit("[1]"), F.lit("[1, 2]"))
    assert spark.range(1).select(reasons.alias("r")).first()["r"] == ["options_cardinality_mismatch"]


def test_report(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "g string, ok boolean")
    got = {r["g"]: r["n"] for r in report.with_total(df, "g", [F.count_if("ok").alias("n")]).collect()}
    assert got == {"a": 1, "b": 1, "total": 2}
    assert report.markdown([{"a": 1}], ["a", "b"]).splitlines()[2] == "| 1 |  |"
    assert [tuple(r) for r in audit.duplicate_ids(df, "g", "ok").collect()] == [("a", 2, False)]
