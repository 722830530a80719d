"""Helpers shared by the training-data operators: shared storage, Arrow buffers, word hashes."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step of a Python operator works on; it bounds the memory of a worker.
CHUNK_BYTES = 2 << 20
#: Rows and bytes of an Arrow batch at most (a single row may be larger).
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20

#: Words are runs of characters other than these, as code points and bytes alike (all are ASCII).
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local master gets a folder
    of its own; on a cluster that is an error, as each executor would write to its own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="curata-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet into the shared folder and read again: cuts lineage and survives lost executors.

    The shuffle files of the write are deleted once it is done, where this version of Spark can do that."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/curata/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN.append(path)
    out.written_path = path
    return out


_WRITTEN: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tables_written() -> list[str]:
    """Paths of this process's intermediate tables."""
    return list(_WRITTEN)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(*tables: DataFrame) -> None:
    """Deletes tables that `written` returned, once everything made from them is written itself."""
    for t in tables:
        if t.written_path in _WRITTEN:
            _WRITTEN.remove(t.written_path)
            _delete(t.sparkSession, t.written_path)


def remove_written(spark: SparkSession, *keep: DataFrame | str) -> None:
    """Deletes the intermediate tables of this process but those to keep, once no result that reads them is needed."""
    kept = {t if isinstance(t, str) else t.written_path for t in keep}
    for path in [p for p in _WRITTEN if p not in kept]:
        _WRITTEN.remove(path)
        _delete(spark, path)


def small_batches(spark: SparkSession) -> None:
    """Bound rows and bytes of an Arrow batch, so that texts of any length stay within a worker's memory.

    These are settings of the session, read when a query runs; lower ones that it has already are left alone."""
    now = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    if not 0 < int(now) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


# ---------------------------------------------------------------- column names


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """Names like these that no column has; Spark compares names without case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def others(columns: Iterable[str], results: Iterable[str]) -> list[str]:
    """The columns that don't have the name of a result, whatever the case."""
    taken = {r.lower() for r in results}
    return [c for c in columns if c.lower() not in taken]


def mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow, by place: it can't take columns with a dot in their name."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, column: str | int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose `column` holds about `limit` bytes each (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    _, offsets = text_buffer(batch.column(column if isinstance(column, int) else batch.schema.get_field_index(column)))
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column in one array, and n + 1 offsets into it; a null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32, n + 1 + column.offset)[column.offset :].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


# ---------------------------------------------------------------- hashes of byte runs, all positions at once

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"n": 0, "up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        size = max(n, 1 << 16)

        def grow(base: int) -> np.ndarray:
            out = np.ones(size, np.uint64)
            done, step = 1, np.uint64(base)
            with np.errstate(over="ignore"):
                while done < size:
                    more = min(done, size - done)
                    out[done : done + more] = out[:more] * step
                    step = step * step
                    done += more
            return out

        _POWERS.update(n=size, up=grow(_BASE), down=grow(_INVERSE))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    return x


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer spans are hashed one by one.
_LONG = 128


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans: eight bytes at a step, each mixed in by a bijection."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    size = end - start
    with np.errstate(over="ignore"):
        out = mixed(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        out = mixed(out ^ (eights[start] & _MASKS[np.minimum(size, 8)]))
        more, step = np.flatnonzero((size > 8) & (size <= _LONG)), 8
        while len(more):
            left = size[more] - step
            out[more] = mixed((out[more] + np.uint64(0xD6E8FEB86659FD93)) ^ (eights[start[more] + step] & _MASKS[np.minimum(left, 8)]))
            more, step = more[left > 8], step + 8
    long = np.flatnonzero(size > _LONG)
    if len(long):
        view = data.tobytes() if len(long) > 16 else memoryview(data)
        out[long] = [xxhash.xxh3_64_intdigest(view[a:z], seed) for a, z in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    return out


def span_digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cryptographic 128-bit digests of byte spans, as two columns of bigint."""
    raw = data.tobytes()
    found = b"".join([hashlib.blake2b(raw[a:z], digest_size=16).digest() for a, z in zip(start.tolist(), end.tolist(), strict=True)])
    both = np.frombuffer(found, "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def sequence_hashes(values: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of runs of a sequence of hashes, a few dozen values each at most."""
    with np.errstate(over="ignore"):
        out = mixed(size.astype(np.uint64) + np.uint64(seed))
        live, step = np.flatnonzero(size > 0), 0
        while len(live):
            out[live] = mixed((out[live] + np.uint64(0xD6E8FEB86659FD93)) ^ values[start[live] + step])
            step += 1
            live = live[size[live] > step]
    return out


class RunHashes:
    """Polynomial hashes (mod 2**64) of any run of a sequence, from prefix sums.

    For candidates only: some different runs (of the Thue-Morse sequence) have equal hashes whatever the base."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """Of every run of `size` values."""
        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True


#: Every ASCII character but letters and digits.
IS_PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word of all texts in the buffer, and offsets of the texts into the words.

    A word is a maximal run of bytes that are not in gaps (white space by default) within one text.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~gaps[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[at] = inside[at]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
