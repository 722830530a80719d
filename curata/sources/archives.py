"""Archives of any size: members by the central directory, contents by seeking, tar files as streams.

Only names and the places of members are read to list a zip file, so a listing costs the same for 1 MB and 100 GB. Work
is dealt by archive, and extraction by ranges of members, to executors that open the file where it is.
"""

from __future__ import annotations

import bz2
import os
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import IO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions.text import IMAGE_SUFFIXES
from curata.sinks.writers import shared_folder

#: Members that one task extracts.
TASK_MEMBERS = 2000
_PLACES = "archive string, valid boolean, member string, size bigint, offset bigint, packed bigint, method int, crc bigint"
PLACE = ("size", "offset", "packed", "method", "crc")


def open_file(path: str) -> IO[bytes]:
    """A seekable file of a local path or of a store that Arrow knows."""
    if "://" not in path:
        return open(path.removeprefix("file:"), "rb")
    if path.startswith("file://"):
        return open("/" + path.removeprefix("file://").lstrip("/"), "rb")
    fs, below = pafs.FileSystem.from_uri(path)
    return pa.PythonFile(fs.open_input_file(below), mode="r")


def members_of(path: str) -> tuple[bool, list[tuple]]:
    """Whether an archive can be read, and (name, bytes, offset, packed bytes, method, checksum) of its files; the last four
    are of zip archives: where a member's own header is, and how it is packed."""
    try:
        with open_file(path) as f:
            if path.endswith(".zip"):
                with zipfile.ZipFile(f) as z:
                    return True, [(x.filename, x.file_size, x.header_offset, x.compress_size, -1 if x.flag_bits & 1 else x.compress_type, x.CRC) for x in z.infolist() if not x.is_dir()]
            with tarfile.open(fileobj=f, mode="r|*") as t:
                return True, [(x.name, x.size, None, None, None, None) for x in t if x.isfile()]
    except (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError):
        return False, []


def members(archives: DataFrame) -> DataFrame:
    """archive, valid, member, size, offset, packed, method, crc of every file in the archives (path); an archive that can't
    be read has one row without a member."""
    names, kinds = zip(*(c.split() for c in _PLACES.split(", ")), strict=True)
    types = {"string": pa.string(), "boolean": pa.bool_(), "bigint": pa.int64(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                valid, found = members_of(path)
                found = found or [(None,) * 6]
                for k in range(0, len(found), 10_000):
                    part = [(path, valid, *m) for m in found[k : k + 10_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, t in zip(zip(*part, strict=True), kinds, strict=True)], names=list(names))

    n = max(1, min(archives.count(), 10_000))
    return archives.select("path").repartition(n).mapInArrow(run, _PLACES)


def listing(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """path (whole), length of the archives below root; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return df.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def report(files: DataFrame, held: DataFrame, expected: list[str]) -> dict:
    """Expected files that are there and that aren't, and for each archive its size, validity and members."""
    spark = files.sparkSession
    name = F.substring_index("path", "/", -1)
    wanted = spark.createDataFrame([(x,) for x in expected], "name string")
    there = {r["name"] for r in files.select(name.alias("name")).join(wanted, "name", "left_semi").distinct().collect()}
    is_image = F.lower(F.substring_index("member", ".", -1)).isin(*IMAGE_SUFFIXES)
    counts = held.groupBy("archive", "valid").agg(F.count("member").alias("members"), F.count_if(is_image).alias("image_members"))
    archives = [
        {"path": r["path"], "size_bytes": r["length"], "valid_zip": r["valid"], "members": r["members"] if r["valid"] else None, "image_members": r["image_members"] if r["valid"] else None}
        for r in files.join(counts, files["path"] == counts["archive"]).orderBy("path").collect()
    ]
    zips = [x for x in expected if x.lower().endswith(".zip")]
    return {
        "expected_files": expected, "present_expected_files": sorted(there), "missing_expected_files": sorted(set(expected) - there), "expected_archives": zips,
        "present_expected_archives": sorted(there & set(zips)), "missing_expected_archives": sorted(set(zips) - there), "archives": archives,
    }


def unpack(f: IO[bytes], size: int, offset: int, packed: int, method: int, crc: int) -> Iterator[bytes]:
    """The bytes of a member of a zip archive by its place: its own header and its packed bytes are read, nothing else.
    An OSError if they aren't what the directory says."""
    f.seek(offset)
    head = f.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04" or method not in _METHODS:
        raise OSError(f"no member that can be read at byte {offset}")
    f.seek(offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    unpacker, left, done, check = _METHODS[method](), packed, 0, 0
    while left > 0 and (piece := f.read(min(left, 1 << 20))):
        left -= len(piece)
        data = piece if unpacker is None else unpacker.decompress(piece)
        if data:
            done, check = done + len(data), zlib.crc32(data, check)
            yield data
    if unpacker is not None and hasattr(unpacker, "flush") and (data := unpacker.flush()):
        done, check = done + len(data), zlib.crc32(data, check)
        yield data
    if (done, check) != (size, crc):
        raise OSError(f"the member at byte {offset} is damaged")


#: Numbers of the ways to pack a member.
_METHODS = {0: lambda: None, 8: lambda: zlib.decompressobj(-15), 12: bz2.BZ2Decompressor}


def unpack_all(rows: Iterable[tuple], opened: Callable[[str], IO[bytes]] = open_file) -> Iterator[tuple[str, int | None]]:
    """(path, bytes) of members (archive, path, *PLACE) written to their paths; null bytes for one that can't be read.
    Each archive is opened once for the rows that follow each other."""
    f: IO[bytes] | None = None
    now = None
    try:
        for archive, path, *place in rows:
            try:
                if archive != now:
                    if f:
                        f.close()
                    f, now = None, None
                    f, now = opened(archive), archive
                if None in place:
                    raise OSError(f"{archive} has no such member")
                yield path, write_aside(path, unpack(f, *place))
            except (OSError, zlib.error):
                yield path, None
    finally:
        if f:
            f.close()


def write_aside(path: str, pieces: Iterable[bytes]) -> int:
    """Bytes written to a file of another name and renamed: tasks that run again, or at once, leave one whole file."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    aside, size = f"{path}.{uuid.uuid4().hex}.tmp", 0
    try:
        with open(aside, "wb") as out:
            for piece in pieces:
                size += out.write(piece)
        os.replace(aside, path)
    except BaseException:
        if os.path.exists(aside):
            os.unlink(aside)
        raise
    return size


def placed(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """wanted (archive, member, ...) with the place of each member, null where there is none; of members of one name the last."""
    last = held.where("member is not null").groupBy("archive", "member").agg(F.max_by(F.struct(*PLACE), "offset").alias("_place"))
    return wanted.join(last, ["archive", "member"], "left").select(*wanted.columns, *(F.col(f"_place.{c}").alias(c) for c in PLACE))


def extract(wanted: DataFrame, target: str, held: DataFrame | None = None) -> DataFrame:
    """archive, member, path, bytes of members (archive, member) written below target; null bytes where one is missing.

    held: what `members` says of the archives, to save listing them again. Tasks take ranges of an archive's bytes and read
    those of their members alone. A target of executors' own disks is of no use on a cluster: it must be a folder that
    all of them share.
    """
    root = shared_folder(target).rstrip("/")
    safe = wanted.select("archive", "member").distinct().where(~F.rlike("member", F.lit(r"(?:^|/)\.\.(?:/|$)|^/")))
    held = members(safe.select(F.col("archive").alias("path")).distinct()) if held is None else held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            paths = [f"{root}/{m}" for m in columns[1]]
            sizes = [n for _, n in unpack_all(zip(columns[0], paths, *columns[2:], strict=True))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["archive", "member", "path", "bytes"])

    rows = placed(safe, held)
    n = max(1, -(-safe.count() // TASK_MEMBERS))
    return rows.repartitionByRange(n, "archive", "offset").sortWithinPartitions("archive", "offset").select("archive", "member", *PLACE).mapInArrow(run, "archive string, member string, path string, bytes bigint")


class Parts:
    """Files one after the other as one stream, for a tar archive in parts."""

    def __init__(self, paths: list[str]) -> None:
        self.left, self.now = list(paths), None

    def read(self, size: int = -1) -> bytes:
        out = bytearray()
        while size < 0 or len(out) < size:
            if self.now is None:
                if not self.left:
                    break
                self.now = open_file(self.left.pop(0))
            piece = self.now.read(-1 if size < 0 else size - len(out))
            if not piece:
                self.now.close()
                self.now = None
            out += piece
        return bytes(out)


def extract_tar(groups: DataFrame, wanted: DataFrame, target: str) -> DataFrame:
    """stem, n_wanted, n_there, status of tar archives (stem, parts): their wanted members (stem, member) that aren't below
    target yet are written there. The status is passed, reused (all were there),
    missing_archive or missing_members. One task reads one archive, once: what is packed as one stream can't be entered in
    the middle."""
    target = shared_folder(target)
    lists = wanted.groupBy("stem").agg(F.array_sort(F.collect_set("member")).alias("members"))
    rows = lists.join(groups, "stem", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for stem, names, parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                place = lambda n: f"{target.rstrip('/')}/{n}"
                todo = {n for n in names if ".." not in n.split("/") and not n.startswith("/") and not os.path.exists(place(n))}
                status = "missing_archive" if not parts else "reused" if not todo else "passed"
                if todo and parts:
                    with tarfile.open(fileobj=Parts(parts), mode="r|*") as t:
                        for x in t:
                            name = x.name.removeprefix("./")
                            if x.isfile() and name in todo:
                                with t.extractfile(x) as source:
                                    write_aside(place(name), iter(lambda: source.read(1 << 20), b""))
                there = sum(os.path.exists(place(n)) for n in names)
                if status == "passed" and there < len(names):
                    status = "missing_members"
                yield pa.RecordBatch.from_arrays([pa.array([stem]), pa.array([len(names)], pa.int64()), pa.array([there], pa.int64()), pa.array([status])], names=["stem", "n_wanted", "n_there", "status"])

    n = max(1, min(rows.count(), 10_000))
    return rows.select("stem", "members", "parts").repartition(n, "stem").mapInArrow(run, "stem string, n_wanted bigint, n_there bigint, status string")
