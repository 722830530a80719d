"""JSON text with a strict reader's semantics, large documents in many tasks, redaction inside JSON text."""

import json
import random

import pytest
from pyspark.sql import functions as F

from curata.functions import json_text, plain, redact
from curata.operators import audit
from curata.sources import json_document, readers

ODD = [
    '{"a":1,"b":2,"a":3}', '{"a":1} xyz', '{"a":1}{"b":2}', "1],[2", '{"a":1},"w":2', "{'a':1}", '{"a":01}', '{"a":1,}', '{"a":NaN}', "", " ", "nul", '{"a":"x\ty"}', '{"a":{"x":1,"x":{"y":1,"y":2}},"c":[{"k":1,"k":2}]}',
    '{"a":"\\ud800"}', '{"":1,"":2}', "918273645546372819", '["918273645546372819"]', '1,918273645546372819],[2', "[" * 3000 + "]" * 3000, "﻿{}", '  {"a" : [1, 2] }\n', "[]", "{}", "3", '"s"', "null", "true", '{"a":1.10,"b":1e5}',
]


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind == 5:
        return "[" + ",".join(value(rng, depth + 1) for _ in range(rng.randrange(4))) + "]"
    if kind > 5:
        space = " " * rng.randrange(2)
        return "{" + ",".join(f'{space}"{rng.choice("abc")}"{space}:{value(rng, depth + 1)}' for _ in range(rng.randrange(4))) + "}"
    return rng.choice([str(rng.randrange(-99, 99)), "null", "true", '"a, b"', '"]}"', '"\\"{["', '"\\\\"', '"é\\u00e9\\n"', "2.5", '""', '"한"'])


def loads(text):
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def test_canonical_text(spark):
    rng = random.Random(4)
    texts = ODD + [value(rng) for _ in range(600)]
    texts += [t[: rng.randrange(len(t) + 1)] + rng.choice(["", "}", "]", '"', ","]) for t in texts[len(ODD) :]]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None])], "k int, t string").select("k", json_text.canonical(F.col("t")).alias("c"), json_text.is_plain(F.col("t")).alias("p"))
    got = {r["k"]: r for r in df.collect()}
    assert got[len(texts)]["c"] is None and got[len(texts)]["p"] is False
    for k, t in enumerate(texts):
        found, expected = got[k]["c"], loads(t)
        assert (found is None) == (expected is None and t.strip(" ") != "null"), t
        if found is not None:
            pairs = lambda x: (len(x), dict(x)) if len({p[0] for p in x}) == len(x) else pytest.fail(found)
            json.loads(found, object_pairs_hook=pairs)  # no key twice, at any depth
            if "NaN" not in t and "ud800" not in t:
                assert json.dumps(json.loads(found)) == json.dumps(expected)  # the order of keys, too
        if got[k]["p"]:
            assert found == t


def test_objects_and_lists(spark):
    texts = ['{"a":1,"b":"x","a":{"k":[1, 2]}}', " [1,{}]", "[]", "{}", "3", "x", None, '\n\t{"a":null}']
    c = json_text.canonical(F.col("t"))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(json_text.object_of(c).alias("o"), json_text.list_of(c).alias("l")).collect()
    assert [r["o"] for r in rows] == [{"a": '{"k":[1,2]}', "b": "x"}, None, None, {}, None, None, None, {"a": None}]
    assert [r["l"] for r in rows] == [None, ["1", "{}"], [], None, None, None, None, None]


def test_plain_text_stays_in_the_jvm(spark):
    """What Python gets of plain rows is null."""
    df = spark.createDataFrame([('{"a":1}',), ("[1,2]",)], "t string").select(F.when(~json_text.is_plain(F.col("t")), F.col("t")).alias("sent"))
    assert [r["sent"] for r in df.collect()] == [None, None]


# ---------------------------------------------------------------- large documents


def plain_rows(text):
    """What a document gives, by whole-document rules, each value as text; None where it is no JSON."""
    try:
        data = json.loads(text)
    except ValueError:
        return None
    shown = lambda v: v if isinstance(v, str) or v is None else json_text.written(v)
    row = lambda d: {k: shown(v) for k, v in d.items()}
    if isinstance(data, list):
        return [row(x) for x in data if isinstance(x, dict)]
    if not isinstance(data, dict):
        return []
    for key in readers.LIST_KEYS:
        if isinstance(data.get(key), list):
            return [row(x) for x in data[key] if isinstance(x, dict)]
    if data and all(isinstance(v, dict) for v in data.values()):
        flat = []
        for name, v in data.items():
            turns, own = v.get("conversation"), {"query_image": name, "mmad_image_key": name} | {k: x for k, x in v.items() if k != "conversation"}
            if isinstance(turns, list):
                flat += [row({**own, "conversation_index": i, **(t if isinstance(t, dict) else {"conversation": t})}) for i, t in enumerate(turns)]
            else:
                flat.append(row(own))
        if flat:
            return flat
    return [row(data)]


def pretty(rng, value):
    return json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]), separators=rng.choice([(",", ":"), (" , ", " : ")]))


def documents():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice('ab,{}[]:"\\\n é한') for _ in range(rng.randrange(12)))
    thing = lambda: {rng.choice(["id", "q", "x, y", 'k"']): rng.choice([word(), 3, None, [1, [word(), {}]], {"n": word(), "m": {"o": []}}]) for _ in range(rng.randrange(4))}
    things = lambda n: [rng.choice([thing(), thing(), thing(), 5, word(), [thing()], None]) for _ in range(n)]
    docs = [pretty(rng, things(n)) for n in (0, 1, 2, 30, 60)]
    docs += [pretty(rng, {word(): 1, "rows": things(20), "data": things(n), "z": thing()}) for n in (0, 1, 30)]
    docs += [pretty(rng, {word() + str(k): {"a": word(), "conversation": rng.choice([[*map(lambda _: thing(), range(rng.randrange(4))), rng.choice([5, "said", {"conversation_index": 7}])], {"b": 1}])} if k % 3 else thing() for k in range(n)}) for n in (1, 25)]
    docs += [pretty(rng, {"only": things(12), "b": thing(), "c": word()}), "{}", " [ ] ", '{"a": {}}', '{"a": {"conversation": []}}', "3", '"a, b"', "null", '{"data": []}', '{"data": {"a": 1}, "rows": [ ]}', '{"x": [ ] , "y": [1 , 2]}']
    # doubled keys: the last value, in the first one's place
    docs += ['{"data": [{"a": 1}], "data": [{"a": 2, "a": 3}, {"b": 1}]}', '{"data": [{"a": 1}], "rows": [{"r": 1}], "data": 5}', '{"a": 1, "b": 2, "a": [1, {"k": 1, "k": 2}]}', '{"i1": {"q": 1}, "i2": {"q": 2}, "i1": {"q": 3, "q": 4}}']
    bad = ["", " \n", "[", "[1,2", "{", '{"a"}', '{"a":1,}', "[1,]", "[,1]", "[1,,2]", "[1 2]", '{"a" 1}', "[1}", '{"a":[1}}', '{"a":[1]]', "[1]]", "[1] [2]", "[1],[2]", "[1] x", "x [1]", '{"a":1 "b":2}', '{1:2}', '{"a":}', '{"a":,"b":1}', '["a]', "[1:2]", '{"a":[1:2]}', '{"a":[1,]}', '{"a":[] 1}', '{"a": x []}', "tru", "1,2", '{"a":1}}', "]", '{"a":{"b":1]}']
    return docs, [b for b in bad if plain_rows(b) is None and b.strip()]


@pytest.mark.parametrize("block", [29, 1 << 20])
def test_documents_in_blocks(spark, tmp_path, block):
    """Equal to a reader of the whole document, whatever the size of blocks."""
    docs, bad = documents()
    options = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": str(block)}
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        (tmp_path / "d").mkdir()
        for n, text in enumerate(docs):
            (tmp_path / f"d/{n}.json").write_text(text)
        key = lambda r: json.dumps(r, sort_keys=True)
        got = [r["row"] for r in readers.read_json(spark, str(tmp_path / "d")).collect()]
        assert sorted(got, key=key) == sorted((r for t in docs for r in plain_rows(t)), key=key)
        for n in range(block % 5, len(docs), 9):  # one by one, in order
            got = sorted(((r["ord"], r["row"]) for r in readers.read_json(spark, str(tmp_path / f"d/{n}.json")).collect()), key=lambda x: x[0])
            assert len({o for o, _ in got}) == len(got) and [r for _, r in got] == plain_rows(docs[n]), docs[n]
        for text in bad[block % 3 :: 3]:
            (tmp_path / "bad.json").write_text(text)
            with pytest.raises(Exception, match=r"no JSON|isn't open|PythonException"):
                json_document.elements(spark, str(tmp_path / "bad.json"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_a_list_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(2)
    rows = [{"id": k, "text": "x, [y] {z} " * rng.randrange(30), "n": {"a": [k]}} for k in range(6000)]
    (tmp_path / "d.json").write_text(json.dumps(rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        pieces = json_document._pieces(spark, str(tmp_path / "d.json"))
        tasks = pieces.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 8 and max(r["count"] for r in tasks) < 0.3 * pieces.count()
        got = [r["row"] for r in readers.read_json(spark, str(tmp_path / "d.json")).orderBy("ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [{"id": str(r["id"]), "text": r["text"], "n": json_text.written(r["n"])} for r in rows]


# ---------------------------------------------------------------- redaction inside JSON text


def hide(value):
    """By the words of the rule: whole under a secret name, by text elsewhere, into strings that are JSON."""
    if isinstance(value, list):
        return [hide(v) for v in value]
    if isinstance(value, dict):
        secret = lambda k: k.lower() in redact.SECRET_NAMES or k.lower().endswith("_token")
        return {plain.redacted_text(k): (v if v == "" else "<redacted>") if secret(k) else hide(v) for k, v in value.items()}
    if isinstance(value, str):
        try:
            inside = json.loads(value)
        except ValueError:
            inside = None
        return json_text.written(hide(inside)) if isinstance(inside, (list, dict)) else plain.redacted_text(value)
    return value


def same_parts(a, b):
    """Equal, but for how JSON in strings is spaced."""
    if isinstance(a, str) and isinstance(b, str) and a != b and a.lstrip()[:1] in "{[" and b.lstrip()[:1] in "{[":
        a, b = loads(a), loads(b)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same_parts, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same_parts(a[k], b[k]) for k in a)
    return a == b


def secret_values(rng, depth=0):
    kind = rng.randrange(9 if depth < 4 else 5)
    if kind == 5:
        return [secret_values(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind in (6, 7):
        return {rng.choice(["a", "Token", "my_token", "tokens", "password", "x y", "secret", "api_key"]): secret_values(rng, depth + 1) for _ in range(rng.randrange(4))}
    if kind == 8:
        return json.dumps(secret_values(rng, depth + 1), ensure_ascii=rng.random() < 0.5)
    return rng.choice([0, 5, None, True, "", "plain", "token=abc", "Authorization:\tBearer x.y\nnext", "key sk-abcdefghijkl", "a \\ \"pwd\": \"q\"", "$HOME", "<redacted>", "한 token: 비밀", "{no json token=x", "[1"])


def test_redaction_inside_json_text(spark):
    rng = random.Random(8)
    values = [secret_values(rng) for _ in range(400)]
    values += [{"token": [1, {"a": "b"}]}, {"x": json.dumps({"y": json.dumps({"z": [{"refresh_token": {"deep": ["v"]}}]})})}, [], {}, {"token": ""}]
    texts = [json.dumps(v, ensure_ascii=rng.random() < 0.5) for v in values] + ['{"\\u0074oken": "v", "b": 1}', '{"token": "a", "token": ["b"]}', "token=abc", None]
    maps = [{"k": t, "password": "p", "n": None} for t in texts]
    df = spark.createDataFrame(list(zip(range(len(texts)), texts, maps, [[t, "pwd=x"] for t in texts], strict=True)), "k int, t string, m map<string,string>, l array<string>")
    got = {r["k"]: r for r in redact.redact_rows(df).collect()}
    for k, v in enumerate(values):
        wanted = hide(v) if isinstance(v, (list, dict)) else None
        if wanted is not None:
            assert same_parts(json.loads(got[k]["t"]), wanted)
            assert same_parts(json.loads(got[k]["m"]["k"]), wanted) and same_parts(json.loads(got[k]["l"][0]), wanted)
        else:
            assert got[k]["t"] == redact.plain_text(texts[k])
        assert got[k]["m"]["password"] == "<redacted>" and got[k]["m"]["n"] is None and got[k]["l"][1] == "pwd=<redacted>"
    n = len(values)
    assert [json.loads(got[n]["t"]), json.loads(got[n + 1]["t"]), got[n + 2]["t"], got[n + 3]["t"]] == [{"token": "<redacted>", "b": 1}, {"token": "<redacted>"}, "token=<redacted>", None]
    again = {r["k"]: r for r in redact.redact_rows(redact.redact_rows(df)).collect()}
    assert again == got


def test_forbidden_keys(spark):
    rows = [('{"token": 1, "x": {"token": 2, "token": 3}}', True), ('{"a": [{"Token": 1}]}', True), ('{"a": "token", "b": 1}', False), ("no json", True), ('{"t\\u006fken": 1, "t\\u006fken": 2}', True), (None, False), ('{"a": 1, "a": {"b": 2}}', False)]
    df = spark.createDataFrame(rows, "t string, bad boolean")
    assert df.where(audit.has_forbidden_key(F.col("t"), ["token"]) != F.col("bad")).collect() == []
