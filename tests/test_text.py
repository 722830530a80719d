"""Text rules on literals."""

import pytest
from pyspark.sql import functions as F

from curata.functions import fields, identity, nested, redact, text


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value", [
    "12", "3.5 kg", "(A) 12 cm", "A. 12", "B) $4.50", "USD", "N/A", "Box A", "2019 to 2021", "5 days", "Sept 12", "AB12", "12V", "New York", "Red", "A. 1\nB. 2", "'3'", "10%", "EUR", "45 sqft", "x = 3e",
])
def test_nonlinguistic(spark, value):
    assert one(spark, text.is_nonlinguistic(F.col("v")), v=value) is True


@pytest.mark.parametrize("value", ["", "red", "small ring", "3 small rings", "School zone", "한국 3", "漢 3", "A. 1\nB. small ring", "blue"])
def test_linguistic(spark, value):
    assert one(spark, text.is_nonlinguistic(F.col("v")), v=value) is False


@pytest.mark.parametrize(("value", "short"), [("abc de", True), ("red", False), ("abcde", False), ("a b c d", False), ("(A) ab.", True), ("ab\n12", True), ("12", False), ("yes", False)])
def test_short_literal(spark, value, short):
    assert one(spark, text.is_short_literal(F.col("v")), v=value) is short


def test_exemption_is_for_the_options_themselves(spark):
    allowed = lambda path, **more: one(spark, text.allows_nonlinguistic(F.col("b"), F.col("p"), F.col("t"), F.col("s")), **{"b": "blink", "p": path, "t": "12", "s": "", **more})
    assert allowed("options") and allowed("text_fields.options")
    assert not allowed("text_fields.options.A") and not allowed("Options") and not allowed("question")
    assert allowed("options", b="mme_realworld", t="some words", s="a/ocr_cc/1")
    assert allowed("options", b="mme_realworld", t="ab cd", s="a/diagram_and_table/1")
    assert not allowed("options", t="ab cd", s="a/diagram_and_table/1")


@pytest.mark.parametrize(("source", "translated", "out"), [
    ("A. red", "빨강", "A. 빨강"), ("A. red", "A) 빨강", "A) 빨강"), ("1) one", "하나", "1) 하나"), ("(A) red", "빨강", "빨강"), ("red", "빨강", "빨강"), ("B: x", "A. y", "B: A. y"),
])
def test_option_labels(spark, source, translated, out):
    assert one(spark, text.keep_option_label(F.col("a"), F.col("b")), a=source, b=translated) == out


def test_option_labels_of_lists_are_cut_to_the_shorter(spark):
    assert one(spark, text.keep_option_labels(F.array(F.lit("A. x"), F.lit("B. y")), F.array(F.lit("p"), F.lit("q"), F.lit("r")))) == ["A. p", "B. q"]


@pytest.mark.parametrize(("value", "n"), [("A. x\nB. y", 2), ("A. x", None), ("A. x\ny", None), ("(1) x\n\n2) y\n", 2), ("", None)])
def test_option_count(spark, value, n):
    assert one(spark, text.option_count(F.col("v")), v=value) == n


@pytest.mark.parametrize(("value", "speech", "word"), [("Assistant director", False, True), ("Hi\nassistant: yes", True, True), ("As an AI model", True, False), ("assistants", False, False)])
def test_assistant(spark, value, speech, word):
    assert one(spark, text.has_assistant_speech(F.col("v")), v=value) is speech
    assert one(spark, text.has_assistant_word(F.col("v")), v=value) is word


@pytest.mark.parametrize(("value", "out"), [
    ("Authorization: Bearer abc.def", "Authorization: Bearer <redacted>"), ("Authorization: Bearer $KEY", "Authorization: Bearer $KEY"), ("token=$FOO", "token=$FOO"),
    ("api_key = zz", "api_key = <redacted>"), ('"my_token": "v"', '"my_token": "<redacted>"'), ("key sk-abcdefghij1 end", "key sk-<redacted> end"), ("max_tokens=5", "max_tokens=5"),
    ("password: <redacted>", "password: <redacted>"), ("nothing", "nothing"), ("pwd=a,b", "pwd=<redacted>,b"),
])
def test_redaction(spark, value, out):
    assert one(spark, redact.redact_text(F.col("v")), v=value) == out


def test_extra_secrets(spark):
    assert one(spark, redact.redact_text(F.col("v"), ["s3cr3t", ""]), v="a s3cr3t b") == "a <redacted> b"


def test_redaction_and_detection_disagree_on_zero(spark):
    df = spark.sql("select 0 as my_token, 'x' as api_key, 'token=abc' as note, array(named_struct('password', 'p', 'ok', 'q')) as list, map('secret', 'a', 'b', 'c') as m")
    found = F.concat(*(redact.findings(F.col(f.name), f.dataType, f"$.{f.name}", f.name) for f in df.schema))
    assert df.select(found.alias("f")).first()["f"] == ["$.my_token", "$.api_key", "$.note", "$.list[0].password", "$.m.secret"]
    clean = redact.redact_rows(df).first()
    assert clean["my_token"] == 0 and clean["api_key"] == "<redacted>" and clean["note"] == "token=<redacted>"
    assert clean["list"][0]["password"] == "<redacted>" and clean["list"][0]["ok"] == "q" and clean["m"] == {"secret": "<redacted>", "b": "c"}


@pytest.mark.parametrize(("value", "path"), [("a/b", True), ("x.PNG?w=1", True), ("a b.jpg", True), ("a / b", False), ("word", False)])
def test_paths(spark, value, path):
    assert one(spark, text.looks_path_like(F.col("v")), v=value) is path


def test_lookup_takes_exact_names_first(spark):
    row = F.create_map(*(F.lit(x) for x in ("Question", "a", "prompt", "b", "query", "")))
    assert tuple(one(spark, fields.get_first(row, ("question", "prompt")))) == ("prompt", "b")
    assert tuple(one(spark, fields.get_first(row, ("question", "query")))) == ("Question", "a")
    assert one(spark, fields.get_first(row, ("query", "other"))) is None
    both = F.create_map(*(F.lit(x) for x in ("ID", "1", "Id", "2")))
    assert one(spark, fields.get_first(both, ("id",))["value"]) == "2"


def test_present_fields(spark):
    row = F.create_map(*(F.lit(x) for x in ("Answer", "0", "label", "", "x", "y")))
    assert one(spark, fields.copy_present(row, ("answer", "label"))) == {"Answer": "0"}


@pytest.mark.parametrize(("value", "out", "package"), [("val", "val", "validation"), (" Dev ", "dev", "validation"), ("a b/c", "a_b_c", "a_b_c"), ("--", "test", "test"), ("", "test", "test")])
def test_splits(spark, value, out, package):
    assert one(spark, identity.normal_split(F.col("v")), v=value) == out
    assert one(spark, identity.package_split(F.col("v")), v=value) == package


def test_source_ids(spark):
    make = lambda own, other, turn: one(spark, identity.source_id(F.col("a"), [F.col("b")], F.lit(turn).cast("bigint"), F.lit("abc")), a=own, b=other)
    assert make("x", "y", 0) == "x#turn-0" and make("", "y", 1) == "y#turn-1" and make("", "", 2) == "row-abc" and make("x", "", None) == "x"


def test_repeated_ids_get_a_place(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2)], "id string, ord int")
    got = {r["ord"]: r["unique_id"] for r in identity.disambiguated(df, "id", ["ord"], F.lit("h")).collect()}
    assert got == {0: "a", 1: "a__dup_1_h", 2: "b"}


def test_conversations(spark):
    docs = [
        ("two", '{"conversation": [{"Question": "q0", "title": "own"}, {"Question": "q1"}], "title": "t"}'), ("none", '{"title": "t"}'), ("empty", '{"conversation": [], "title": "t"}'), ("text", '"just text"'),
    ]
    rows = nested.flatten_conversations(spark.createDataFrame(docs, "k string, d string"), "k", "d").collect()
    got = sorted((r["k"], r["conversation_index"] if r["conversation_index"] is not None else -1, r["row"].get("Question"), r["row"].get("title")) for r in rows)
    assert got == [("none", -1, None, "t"), ("text", -1, None, None), ("two", 0, "q0", "own"), ("two", 1, "q1", "t")]


@pytest.mark.parametrize(("value", "n"), [("[1,2]", 2), ('{"a":1}', 1), ("3", None), ("{", None), (None, None)])
def test_json_options(spark, value, n):
    assert one(spark, nested.json_option_count(F.col("v").cast("string")), v=value) == n


def test_json_leaves(spark):
    assert one(spark, nested.json_leaves(F.col("v")), v='["a", 1, {"b": "c", "d": [" ", "e"]}, true]') == ["a", "c", "e"]


def test_media(spark):
    assert one(spark, nested.media_list(F.array(F.lit("b"), F.lit("['a', 'c']"), F.lit(""), F.lit("b")))) == ["a", "b", "c"]
    assert one(spark, nested.media_objects(F.col("v")), v='["x", {"url": "u", "path": "p"}, {"none": 1}]') == ["x", "p"]
