"""CSV in blocks against Python's reader."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from curata.sources import csv_lines, readers


def plain_rows(data):
    text = data.decode("utf-8-sig")
    return [{k: v or None for k, v in r.items() if k is not None} for r in csv.DictReader(io.StringIO(text, newline=""))]


def cell(rng):
    text = "".join(rng.choice('ab,"\n\r é한 ') for _ in range(rng.randrange(9)))
    kind = rng.randrange(4)
    if kind == 0:
        return "".join(c for c in text if c not in ',"\n\r')
    if kind == 1:
        return "x" + "".join(c for c in text if c not in ",\n\r")  # quotes that don't count
    return '"' + text.replace("\r", "").replace('"', '""') + '"' + ("tail" if rng.randrange(9) == 0 else "")


def files():
    rng = random.Random(6)
    out = []
    for n in range(6):
        end = rng.choice(["\n", "\r\n"])
        lines = ["id,text,note,text" if n == 3 else 'id,"the\ntext",note'] + [",".join([str(k), *(cell(rng) for _ in range(rng.choice([1, 2, 2, 2, 3])))]) for k in range(40)]
        lines[10:10] = ["", ""]
        out.append((b"\xef\xbb\xbf" if n % 2 else b"") + (end.join(lines) + end * rng.randrange(3)).encode())
    return [*out, b"a,b\r1,2\r3,4\r", b"a,b\n", b"\n\na\n\n1\n", b'a,b\n1,"open\nto the end,2', b"", b'a\n"' + b"x\n" * 3000 + b'",\n2\n']


@pytest.mark.parametrize("block", [150, 1 << 20])
def test_files_in_blocks(spark, tmp_path, block):
    options = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": str(block)}
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        for n, data in enumerate(files()):
            (tmp_path / f"{n}.csv").write_bytes(data)
        key = lambda r: sorted((k, v or "") for k, v in r.items())
        got = [r["row"] for r in readers.read_csv(spark, str(tmp_path)).collect()]
        assert sorted(got, key=key) == sorted((r for data in files() for r in plain_rows(data)), key=key)
        for n in (0, 3, 6):
            rows = sorted(((r["ord"], r["row"]) for r in readers.read_csv(spark, str(tmp_path / f"{n}.csv")).collect()), key=lambda x: x[0])
            assert [r for _, r in rows] == plain_rows(files()[n]) and len({o for o, _ in rows}) == len(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_lines_are_dealt(spark, tmp_path):
    rng = random.Random(1)
    data = "id,text\n" + "".join(f'{k},"{"line " * rng.randrange(9)}\nmore, ""{k}"""\n' for k in range(4000))
    (tmp_path / "d.csv").write_text(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert csv_lines._lines(spark, str(tmp_path / "d.csv")).select(F.spark_partition_id()).distinct().count() > 8
        got = [r["row"] for r in readers.read_csv(spark, str(tmp_path / "d.csv")).orderBy("ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == plain_rows(data.encode())
