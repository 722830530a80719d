"""Line dedup: range-partitioned line keys, secondary sort by document and position, keep bitmaps.

A line's key is the line without white space at its ends and with A-Z lower-cased, as a cryptographic 128-bit digest. Keys go
through a range partitioning on (key, document, position), so a key of any frequency is spread over partitions by
document, and each partition is streamed in order: a key's lines are held back only until its documents reach the
threshold, and only so many of them. A key that crosses a partition's edge below the threshold, or has more lines in
few documents, is settled by a small aggregate. What comes back is one compressed bitmap per document that loses
lines, never text.

Rows are told apart by (doc_id, text): rows that repeat both get the same result; a key's documents are counted by
distinct doc_id (null counts as one document). A null text is one empty line. Blank lines have no key and stay.
Lines keep their order; documents of any length are one row; an empty table gives an empty result. Further columns
are handed on, whatever their names; one that has the name of a result, in any case of letters, is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import forget, fresh, lower_ascii, mapped, others, pieces, quoted, small_batches, span_digests, text_buffer, written

_KEYS = "h1 bigint, h2 bigint, doc bigint, row_key bigint, pos int"
_FOUND = "doc bigint, row_key bigint, pos int, open boolean, h1 bigint, h2 bigint"


def _line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in pieces(batch, "text"):
            raw, offsets = text_buffer(b.column(2))
            data = lower_ascii(raw)
            breaks = np.flatnonzero(data == 10)
            start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
            # a break that ends a text starts an empty line of that text, not one of the next
            own = np.repeat(np.arange(b.num_rows), np.bincount(np.searchsorted(offsets, breaks, side="right") - 1, minlength=b.num_rows) + 1)
            first_line = np.searchsorted(own, np.arange(b.num_rows))
            end = np.empty_like(start)
            end[:-1] = start[1:] - 1
            end[first_line[1:] - 1] = offsets[1:-1]
            end[-1] = offsets[-1]
            solid = np.flatnonzero(~((data == 32) | ((data >= 9) & (data <= 13))))
            lo, hi = np.searchsorted(solid, start), np.searchsorted(solid, end)
            full = np.flatnonzero(lo < hi)
            if len(full) == 0:
                continue
            a, z = solid[lo[full]], solid[hi[full] - 1] + 1
            pos = (np.arange(len(start)) - first_line[own])[full]
            rows = pa.array(own[full])
            yield pa.RecordBatch.from_arrays([*map(pa.array, span_digests(data, a, z)), b.column(0).take(rows), b.column(1).take(rows), pa.array(pos.astype(np.int32))], names=["h1", "h2", "doc", "row_key", "pos"])


#: Lines of a key in too few documents that a task holds back; beyond them they are settled as the edges are.
HELD_LINES = 1 << 18
#: Keys that are broadcast at most; more of them are joined by shuffle.
BROADCAST_KEYS = 1 << 20


def _stream(least: int, most_held: int):
    """Over sorted keys: the lines of keys in `least` documents or more; open: of a key at the partition's edge, or of
    over most_held lines in too few documents so far."""
    names = ["doc", "row_key", "pos", "open", "h1", "h2"]

    def out(t: pa.RecordBatch, is_open: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([t.column("doc"), t.column("row_key"), t.column("pos"), pa.array(np.full(t.num_rows, is_open)), t.column("h1"), t.column("h2")], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple[int, int] | None = None  # the last key, its documents so far, the last of them
        docs_so_far, last_doc = 0, (0, False)
        held: list[pa.RecordBatch] = []  # lines of the last key, as long as it is in too few documents
        at_edge = True  # the last key is the partition's first
        for b in batches:
            if b.num_rows == 0:
                continue
            h1, h2 = b.column("h1").to_numpy(), b.column("h2").to_numpy()
            # integers beside a null mask: with nulls in it, a column would turn into floats, and large ids fall together
            doc, null = b.column("doc").fill_null(0).to_numpy(), np.asarray(b.column("doc").is_null())
            new_key, changed = np.ones(len(h1), bool), np.ones(len(h1), bool)
            new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            changed[1:] = (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])
            begins = np.flatnonzero(new_key)
            run_of = np.cumsum(new_key) - 1
            if key != (int(h1[0]), int(h2[0])):  # the last key has ended
                if at_edge and docs_so_far < least:
                    yield from (out(t, True) for t in held)
                at_edge, held, docs_so_far = key is None, [], 0
            else:
                changed[0] = new_key[0] = (int(doc[0]), bool(null[0])) != last_doc
            docs = np.bincount(run_of, new_key | changed).astype(np.int64)
            docs[0] += docs_so_far
            drop, last = docs >= least, len(begins) - 1
            if drop[0]:
                yield from (out(t, False) for t in held)
                held = []
            if drop.any():
                yield out(b.filter(pa.array(drop[run_of])), False)
            if last:
                if at_edge and not drop[0]:
                    yield from (out(t, True) for t in [*held, b.slice(0, int(begins[1]))])
                at_edge, held = False, []
            if not drop[last]:
                held.append(b.slice(int(begins[last])))
                if sum(t.num_rows for t in held) > most_held:
                    yield from (out(t, True) for t in held)
                    held = []
            key, docs_so_far, last_doc = (int(h1[-1]), int(h2[-1])), int(docs[last]), (int(doc[-1]), bool(null[-1]))
        yield from (out(t, True) for t in held)

    return run


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, row_key (a hash of the text), text."""
    source = F.coalesce(F.col(quoted(text)), F.lit(""))
    return docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc"), F.xxhash64(source).alias("row_key"), source.alias("text"))


def keep_bitmaps(docs: DataFrame, least_docs: int = 10, keep_first: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, row_key, n_dropped, keep: a zlib-compressed little-endian bitmap with a 1 for each line that stays.

    keep_first: a key's first line by (document, position) stays, where it would else be dropped everywhere.

    Only documents that lose a line have a row; lines beyond the bitmap's end stay.
    """
    small_batches(docs.sparkSession)
    # written, since the range partitioning reads its input twice
    lines = written(keyed(docs, doc_id, text).mapInArrow(_line_keys, _KEYS), "line-keys")
    order = ["h1", "h2", "doc", "row_key", "pos"]
    found = written(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_stream(least_docs, HELD_LINES), _FOUND), "line-dedup")
    forget(lines)
    # what partitions left open: fewer than least_docs documents of two keys each, and of keys with very many lines
    waiting = found.where("open")
    open_keys = waiting.select("h1", "h2").distinct()
    small = F.broadcast if open_keys.count() <= BROADCAST_KEYS else (lambda keys: keys)
    settled = waiting.groupBy("h1", "h2").agg(F.count_distinct(F.coalesce("doc", F.lit(0)), F.col("doc").isNull()).alias("docs"))
    # a key that is hot in one partition can go on, cold, in the next
    decided = found.where("not open").join(small(open_keys), ["h1", "h2"], "left_semi").select("h1", "h2").distinct().withColumn("docs", F.lit(least_docs).cast("bigint"))
    over = settled.unionByName(decided).groupBy("h1", "h2").agg(F.max("docs").alias("docs")).where(F.col("docs") >= least_docs).select("h1", "h2")
    place = ["doc", "row_key", "pos"]
    dropped = found.where("not open").select("h1", "h2", *place).unionByName(waiting.join(small(over), ["h1", "h2"], "left_semi").select("h1", "h2", *place))
    if keep_first:
        first = dropped.groupBy("h1", "h2").agg(F.min(F.struct(*place)).alias("f")).select(*(F.col(f"f.{c}").alias(f"f_{c}") for c in place))
        same = [dropped[c].eqNullSafe(first[f"f_{c}"]) for c in place]
        dropped = dropped.join(first, same[0] & same[1] & same[2], "left_anti")
    lists = dropped.groupBy("doc", "row_key").agg(F.collect_set("pos").alias("pos"))

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, maps = [], []
            for positions in b.column(2):
                p = np.asarray(positions.values)
                bits = np.ones((int(p.max()) // 8 + 1) * 8, bool)
                bits[p] = False
                counts.append(len(p))
                maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int64()), pa.array(maps, pa.binary())], names=["doc", "row_key", "n_dropped", "keep"])

    return lists.mapInArrow(bitmaps, "doc bigint, row_key bigint, n_dropped bigint, keep binary")


def kept_lines(text: str, keep: bytes | None) -> tuple[str, int]:
    """The text without the lines that the bitmap drops, and how many lines it had."""
    lines = text.split("\n")
    if keep is None:
        return text, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return "\n".join(x for i, x in enumerate(lines) if i >= len(bits) or bits[i]), len(lines)


def drop_lines(docs: DataFrame, least_docs: int = 10, keep_first: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of docs with the text cleaned, plus n_lines and n_dropped (bigint; in place of any of that name)."""
    maps = keep_bitmaps(docs, least_docs, keep_first, doc_id, text)
    names = others(docs.columns, ["n_lines", "n_dropped"])
    key, doc, row_key, keep, dropped = fresh(names, "key", "doc", "row_key", "keep", "dropped")
    maps = maps.select(F.col("doc").alias(doc), F.col("row_key").alias(row_key), F.col("keep").alias(keep), F.col("n_dropped").alias(dropped))
    rows = docs.select(*map(quoted, names), F.xxhash64(F.coalesce(F.col(quoted(text)), F.lit(""))).alias(key))
    joined = rows.join(maps, F.col(quoted(doc_id)).cast("bigint").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(row_key)), "left").select(*map(quoted, names), keep, dropped)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"{quoted(c)} {'string' if c == text else kinds[c]}" for c in names), "n_lines bigint", "n_dropped bigint"])
    place, own = len(names), names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, own):
                done = [kept_lines(x or "", keep) for x, keep in zip(b.column(own).to_pylist(), b.column(place).to_pylist(), strict=True)]
                cleaned = pa.array([x for x, _ in done], pa.string())
                yield pa.RecordBatch.from_arrays([*(cleaned if i == own else b.column(i) for i in range(place)), pa.array([n for _, n in done], pa.int64()), b.column(place + 1).fill_null(0)], names=[*names, "n_lines", "n_dropped"])

    return mapped(joined, run, schema)
