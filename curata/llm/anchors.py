"""Candidate search for repeated windows of a fixed length, by window anchors.

The anchor of a window is the k-gram in it with the smallest hash (the leftmost of equals), so it depends on the
window's content alone: equal windows have equal anchors at equal places. Neighbouring windows mostly share their
anchor's occurrence; a run is all windows of one occurrence. A window can only repeat if its anchor's hash occurs
again, so only such runs go on to an exact search, dealt by the anchor's hash.

Hashes that may be frequent are seen in a sample of the texts, one for each shuffle partition at most; they are dealt by
document, the others by themselves. Each partition is streamed in order; what a frequent hash leaves open in a partition
is settled by a small aggregate.

A text of more than a few steps' bytes is taken in segments that overlap by a window, so memory doesn't grow with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import pieces, text_buffer, written

#: Bytes of text of one step; each byte takes about a hundred bytes of arrays.
STEP_BYTES = 1 << 20
#: Runs of one anchor that a single task searches, about 5 MB of text; those of a more frequent one are split further.
HOT_RUNS = 1 << 14
#: Share of the texts in which frequent hashes are looked for, and how often one is seen there at least.
SAMPLE, SEEN = 0.02, 8

_PLACE_BITS = 24
_LOW = np.uint64((1 << _PLACE_BITS) - 1)


class Runs(NamedTuple):
    doc: np.ndarray  # row of the batch
    first: np.ndarray  # first and end window, as places in the whole buffer
    end: np.ndarray
    at: np.ndarray  # the anchor's place
    h: np.ndarray


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def least_places(grams: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of each `width` neighbours (by its upper bits), the leftmost of equals."""
    n = len(grams) - width + 1
    out = np.zeros(max(0, n), np.int64)
    step = (1 << _PLACE_BITS) - width  # places count from the part's start, so they always fit
    for a in range(0, n, step):
        part = grams[a : a + step + width - 1]
        least = sliding_min((part & ~_LOW) | np.arange(len(part), dtype=np.uint64), width)
        out[a : a + len(least)] = a + (least & _LOW).astype(np.int64)
    return out


def runs(grams: np.ndarray, offsets: np.ndarray, k: int, window: int) -> Runs:
    """Runs of the windows of each text. grams: hash of the k-gram at each place; offsets: of the texts."""
    n, width = int(offsets[-1]), window - k + 1
    if n < window:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64))
    grams = grams[: n - k + 1]
    at = least_places(grams, width)
    change = np.ones(len(at), bool)
    change[1:] = at[1:] != at[:-1]
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes >= window)
    change[offsets[full]] = True
    inside = np.zeros(len(at) + 1, np.int8)
    np.add.at(inside, offsets[full], 1)
    np.add.at(inside, offsets[full] + sizes[full] - window + 1, -1)
    valid = np.cumsum(inside[:-1]).astype(bool)
    stop = np.flatnonzero(change | ~valid)
    first = stop[valid[stop]]
    end = np.append(stop, len(at))[np.searchsorted(stop, first) + 1]
    return Runs(np.searchsorted(offsets, first, side="right") - 1, first, end, at[first], grams[at[first]])


def _keys(of: Callable) -> Callable:
    """(h, doc, key) of every run. of(data, offsets): row and hash of the runs, in steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, "text", STEP_BYTES):
                for found in of(*text_buffer(b.column(2))):
                    row = pa.array(found.doc)
                    yield pa.RecordBatch.from_arrays([pa.array(found.h.view(np.int64)), b.column(0).take(row), b.column(1).take(row)], names=["h", "doc", "key"])

    return run


FOUND, OPEN, KNOWN = 0, 1, 2


def _repeated(by_doc: bool) -> Callable:
    """Over sorted (h, doc, key, spread), rows by kind: FOUND of hashes found twice (by_doc: in two documents), OPEN of a
    spread hash that wasn't, and one KNOWN for each spread hash that was."""
    names = ["h", "doc", "key", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows of the last hash, as long as it isn't found twice
        again = None

        def out(t: pa.Table, kind: int) -> Iterator[pa.RecordBatch]:
            yield from pa.table([*(t[c] for c in names[:3]), pa.array(np.full(t.num_rows, kind, np.int32))], names=names).to_batches()

        for b in batches:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            h, doc = t["h"].to_numpy(), t["doc"].to_numpy()
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            begins, of = np.flatnonzero(new), np.cumsum(new) - 1
            differs = new.copy()
            differs[1:] |= (doc[1:] != doc[:-1]) if by_doc else True
            twice = np.bincount(of, differs) >= 2
            fresh = twice.copy()
            if again is not None and int(h[0]) == again:
                twice[0], fresh[0] = True, False
            rows, spread = twice[of], t["spread"].to_numpy(zero_copy_only=False)
            if rows.any():
                yield from out(t.filter(pa.array(rows)), FOUND)
            if (known := begins[fresh & spread[begins]]).size:
                yield from out(t.take(pa.array(known)), KNOWN)
            last = len(begins) - 1
            again = int(h[-1]) if twice[last] else None
            waiting = ~rows & spread
            waiting[begins[last] :] = False
            if waiting.any():
                yield from out(t.filter(pa.array(waiting)), OPEN)
            held = None if twice[last] else t.slice(int(begins[last])).combine_chunks()
        if held is not None and held["spread"][0].as_py():
            yield from out(held, OPEN)

    return run


def frequent(sample: DataFrame) -> list[int]:
    """The hashes seen most often in a sample of keys (h): one for each shuffle partition at most."""
    n = int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = sample.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= SEEN).orderBy(F.desc("n"), "h").limit(n)
    return [r["h"] for r in seen.collect()]


def repeated_keys(keys: DataFrame, sample: DataFrame, by_doc: bool, name: str) -> DataFrame:
    """The rows (h, doc, key: bigint) of hashes that occur twice, or in two documents. sample: some of the keys."""
    spark = keys.sparkSession
    hot = frequent(sample)
    flagged = keys.withColumn("spread", F.lit(False))
    if hot:
        flagged = keys.join(F.broadcast(spark.createDataFrame([(x, True) for x in hot], "h bigint, _hot boolean")), "h", "left").select("h", "doc", "key", F.coalesce("_hot", F.lit(False)).alias("spread"))
    bucket = F.when(F.col("spread"), F.xxhash64("h", "doc")).otherwise(F.col("h"))
    dealt = flagged.repartition(bucket).sortWithinPartitions("h", "doc", "key")
    found = written(dealt.mapInArrow(_repeated(by_doc), "h bigint, doc bigint, key bigint, kind int"), name)
    of = lambda kind: found.where(F.col("kind") == kind).select("h", "doc", "key")
    sure, waiting = of(FOUND), of(OPEN)
    if not hot:
        return sure
    # what is open is of one document for each partition and frequent hash
    known = of(KNOWN).select("h").distinct().withColumn("n", F.lit(2).cast("bigint"))
    n = F.when(F.min("doc") < F.max("doc"), 2).otherwise(1).cast("bigint") if by_doc else F.count("*")
    over = waiting.groupBy("h").agg(n.alias("n")).unionByName(known).groupBy("h").agg(F.max("n").alias("n")).where("n >= 2").select("h")
    return sure.unionByName(waiting.join(F.broadcast(over), "h", "left_semi").select("h", "doc", "key"))


def shared_anchors(rows: DataFrame, of: Callable, by_doc: bool, name: str) -> DataFrame:
    """doc, key, shared (array of hashes of its anchors that occur again), hot (those with over HOT_RUNS runs).

    rows: doc, key (not null), text. of(data, offsets): the runs of a batch, in steps.
    """
    schema = "h bigint, doc bigint, key bigint"
    every = rows.select("doc", "key", "text").mapInArrow(_keys(of), schema)
    some = rows.select("doc", "key", "text").sample(SAMPLE, 1).mapInArrow(_keys(of), schema)
    shared = repeated_keys(every, some, by_doc, name)
    hot = shared.groupBy("h").agg(F.count("*").alias("runs")).where(F.col("runs") > HOT_RUNS).select("h", F.lit(True).alias("is_hot"))
    flagged = shared.distinct().join(hot, "h", "left")
    return flagged.groupBy("doc", "key").agg(F.collect_list("h").alias("shared"), F.collect_list(F.when(F.col("is_hot"), F.col("h"))).alias("hot"))


def chosen(found_h: np.ndarray, row: np.ndarray, shared: pa.Array, hots: pa.Array, hot: bool) -> np.ndarray:
    """Which runs have an anchor of their row's list: of `hots`, or of `shared` without `hots`. row is sorted."""
    keep = np.zeros(len(row), bool)
    edges = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])) if len(row) else np.zeros(1, np.int64)
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        very = hots[int(row[a])].values.to_numpy(zero_copy_only=False)
        wanted = very if hot else np.setdiff1d(shared[int(row[a])].values.to_numpy(zero_copy_only=False), very)
        keep[a:z] = np.isin(found_h[a:z].view(np.int64), wanted)
    return np.flatnonzero(keep)


#: One in so many anchors starts a new chunk.
CHUNK_RUNS = 8


def chunks(found: Runs, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the runs i of each chunk, and the last: neighbouring runs up to an anchor whose hash starts a new one,
    so that equal stretches are cut at equal places."""
    new = np.ones(len(i), bool)
    new[1:] = (found.doc[i[1:]] != found.doc[i[:-1]]) | (found.first[i[1:]] != found.end[i[:-1]]) | (found.h[i[1:]] % np.uint64(CHUNK_RUNS) == 0)
    at = np.flatnonzero(new)
    return i[at], i[np.append(at[1:], len(i)) - 1]


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_texts(rows: DataFrame) -> DataFrame:
    """doc, key, z: the text compressed, for what a shuffle moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for b in pieces(batch, "text"):
                z = [press.compress(x.encode()) for x in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(z, pa.binary())], names=["doc", "key", "z"])

    return rows.select("doc", "key", "text").mapInArrow(run, "doc bigint, key bigint, z binary")


def unpack_batch(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of steps over a column of compressed texts."""
    open_up, start, parts, size = zstandard.ZstdDecompressor(), 0, [], 0
    for i, z in enumerate(column):
        parts.append(open_up.decompress(z.as_py()))
        size += len(parts[-1])
        if size >= limit or i + 1 == len(column):
            yield start, i + 1, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
            start, parts, size = i + 1, [], 0


def cut(spans_of: np.ndarray, ends_of: np.ndarray, n: int) -> np.ndarray:
    """A mask of n places that the spans cover."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, spans_of, 1)
    np.add.at(steps, ends_of, -1)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0
