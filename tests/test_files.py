"""Files written by many tasks, and members of archives read by their places."""

import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from curata.plans import packaging
from curata.sinks import writers
from curata.sources import archives


@pytest.mark.parametrize("range_bytes", [7, 64 << 20])
def test_one_file_of_many_tasks(spark, tmp_path, monkeypatch, range_bytes):
    monkeypatch.setattr(writers, "RANGE_BYTES", range_bytes)
    rows = spark.range(0, 500, 1, 7).select(F.concat(F.lit("line é "), "id", F.when(F.col("id") % 9 == 0, "\n").otherwise("")).alias("value"))
    for df, expected in ((rows, "".join(f"line é {k}" + "\n" * (k % 9 == 0) + "\n" for k in range(500))), (rows.where("id = 3"), "line é 3\n"), (rows.where("false"), "")):
        target = tmp_path / "a/b.jsonl"
        writers.write_lines(df, str(target))  # also over a file that is there
        assert target.read_text() == expected
        assert sorted(os.listdir(tmp_path / "a")) in (["b.jsonl"], [".b.jsonl.crc", "b.jsonl"])
    writers.write_lines(rows.orderBy(F.desc("id")), "file://" + str(tmp_path / "c"))
    assert (tmp_path / "c").read_text().startswith("line é 499\n")


def test_no_data_passes_the_driver(spark, tmp_path, monkeypatch):
    """Tasks fill the file; what the driver gets is a number of bytes."""
    seen = []
    own = writers.fill
    monkeypatch.setattr(writers, "fill", lambda target, ranges: seen.append((target, ranges)) or own(target, ranges))
    monkeypatch.setattr(writers, "RANGE_BYTES", 1000)
    writers.write_lines(spark.range(0, 2000, 1, 4).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("value")), str(tmp_path / "x"))
    (target, ranges), *rest = seen
    assert not rest and ranges.columns == ["source", "start", "size", "place"]
    assert os.path.getsize(tmp_path / "x") == 20_000 and (tmp_path / "x").read_text().split()[1234] == "000001234"


def test_stores_are_refused(spark, tmp_path):
    assert writers.shared_folder("file:///a/b") == writers.shared_folder("/a/b/") == "/a/b"
    for path in ("s3a://bucket/a", "hdfs://host/a"):
        with pytest.raises(ValueError, match="store"):
            writers.shared_folder(path)
    wanted = spark.createDataFrame([("a.zip", "m")], "archive string, member string")
    with pytest.raises(ValueError, match="store"):
        archives.extract(wanted, "s3a://bucket/out")
    with pytest.raises(ValueError, match="store"):
        packaging.copy_media(wanted, "s3a://bucket/out")


class Counted(io.FileIO):
    total = 0

    def read(self, size=-1):
        data = super().read(size)
        Counted.total += len(data)
        return data


def make(path, rng, n=60, size=20_000):
    with zipfile.ZipFile(path, "w") as z:
        for k in range(n):
            method = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)[k % 4 if k < 8 else k % 2]
            z.writestr(zipfile.ZipInfo(f"d/é{k}.bin"), (rng.randbytes(size) if k % 3 else b"x" * size) if k else b"", method)
    with zipfile.ZipFile(path) as z:
        return {x.filename: z.read(x) for x in z.infolist()}


def test_members_by_place(tmp_path):
    """What is read is what is extracted, and each archive is opened once."""
    rng, opened = random.Random(1), []
    held = [make(tmp_path / f"{n}.zip", rng) for n in range(2)]
    rows = []
    for n, names in enumerate(held):
        valid, places = archives.members_of(str(tmp_path / f"{n}.zip"))
        assert valid and {p[0]: p[1] for p in places} == {k: len(v) for k, v in names.items()}
        rows += [(str(tmp_path / f"{n}.zip"), str(tmp_path / f"out/{n}/{p[0]}"), *p[1:]) for p in places if int(p[0][3:-4]) % 10 < 3]

    def opens(path):
        opened.append(path)
        return Counted(path)

    done = list(archives.unpack_all(rows, opens))
    assert opened == [str(tmp_path / "0.zip"), str(tmp_path / "1.zip")]
    for (_, path, *place), (to, size) in zip(rows, done, strict=True):
        n, name = path.split("/out/")[1].split("/", 1)
        if place[3] == 14:  # a way to pack that isn't read by place
            assert size is None and not os.path.exists(path)
        else:
            assert to == path and size == len(held[int(n)][name]) and open(path, "rb").read() == held[int(n)][name]
    packed = sum(r[4] for r in rows if r[5] != 14)
    assert packed <= Counted.total < packed + 200 * len(rows)
    assert not [f for _, _, names in os.walk(tmp_path / "out") for f in names if f.endswith(".tmp")]


def test_damaged_members(tmp_path):
    rng = random.Random(2)
    make(tmp_path / "a.zip", rng, 4)
    _, places = archives.members_of(str(tmp_path / "a.zip"))
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[places[1][2] + 200] ^= 255
    data[places[2][2]] ^= 255
    (tmp_path / "b.zip").write_bytes(data)
    rows = [(str(tmp_path / "b.zip"), str(tmp_path / f"out{k}"), *p[1:]) for k, p in enumerate(places)] + [(str(tmp_path / "none.zip"), str(tmp_path / "out9"), 1, 0, 1, 0, 0), (str(tmp_path / "b.zip"), str(tmp_path / "out8"), None, None, None, None, None)]
    assert [n for _, n in archives.unpack_all(rows)] == [0, None, None, None, None, None]
    assert sorted(os.listdir(tmp_path)) == ["a.zip", "b.zip", "out0"]


def test_extraction_by_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "TASK_MEMBERS", 10)
    rng = random.Random(3)
    held = {f"{n}.zip": make(tmp_path / f"{n}.zip", rng, 30, 500) for n in range(2)}
    with zipfile.ZipFile(tmp_path / "0.zip", "a") as z:  # of members of one name the last counts
        z.writestr("d/é8.bin", b"again")
    held["0.zip"]["d/é8.bin"] = b"again"
    listed = archives.members(archives.listing(spark, str(tmp_path)))
    wanted = listed.where("method in (0, 8)").select("archive", "member")
    got = archives.extract(wanted, str(tmp_path / "out"), listed)
    assert got.rdd.getNumPartitions() > 3
    sizes = {(r["archive"].rsplit("/", 1)[-1], r["member"]): r["bytes"] for r in got.collect()}
    assert sizes == {(a, m): len(d) for a, names in held.items() for m, d in names.items() if (int(m[3:-4]) >= 8 or int(m[3:-4]) % 4 < 2)}
    placed = archives.placed(listed.where("archive like '%1.zip' and method = 8").select("archive", "member"), listed).withColumnRenamed("archive", "source").withColumn("target", F.concat(F.lit("t/"), "member"))
    done = packaging.copy_media(placed, str(tmp_path / "package")).collect()
    assert done and all(r["done"] for r in done)
    assert all((tmp_path / "package" / r["target"]).read_bytes() == held["1.zip"][r["target"][2:]] for r in done)
