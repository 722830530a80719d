"""Suffix-array dedup: every byte in a string of `window` bytes that starts anywhere else too is removed.

Candidates come from window anchors (see `anchors`): runs of windows whose anchor occurs again are dealt by the anchor's
hash, so equal strings meet in one task. There, blocks of a few MB are sorted with a difference cover:

- Runs are laid out so that every anchor lies at a multiple of PERIOD. COVER is a set of residues such that any two
  places have a common offset at which both are in it; ranks of the texts that start at cover places are worked out
  first, by doubling, in the memory of one block.
- Suffixes are sorted one bucket at a time. A bucket holds the suffixes that start the same number of bytes before their
  anchor, which is where equal strings must lie; the few bytes up to the next cover place are compared as they are, and
  ties, however long, by the rank there.
- Neighbours in a sorted bucket repeat each other if `window` bytes are equal, which ranks of two overlapping cover texts
  and the bytes at both ends tell exactly.

An anchor with very many runs is narrowed first, on what lies around it. Neighbouring runs of such anchors are cut into
chunks by their content; equal chunks, and equal runs, repeat each other whole, so one of each kind goes on. Two runs of one anchor can share a window only if the bytes before the anchor, or those after it, are
equal for half of what the window has besides the anchor: the windows with the longer part before go on by the anchor
and those bytes, the others by the anchor and the bytes after it. So every round halves what is still to be compared,
each window goes one way only, and what meets few others is sorted in a block like any run.

A null text is empty. Rows are places of their own: a repeated row of `window` bytes or more is removed whole, in each.
Rows are told apart by (doc_id, 64-bit hash of the text); rows without doc_id by their text. Texts are taken whole, long
ones in segments that overlap by a window. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm import anchors
from curata.llm.common import RunHashes, pieces, quoted, small_batches, text_buffer, written

#: Fixed: a perfect difference set; every number modulo PERIOD is the difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Bytes of different runs that are sorted together.
BLOCK_BYTES = 3 << 20
_NULL_DOC = -(1 << 63)


def byte_runs(window: int):
    """A function of (data, offsets) that yields the runs of windows of the texts in a buffer."""
    k = window // 2

    def whole(data: np.ndarray, offsets: np.ndarray) -> anchors.Runs:
        return anchors.runs(RunHashes(data).windows(k) if len(data) >= k else np.zeros(0, np.uint64), offsets, k, window)

    def of(data: np.ndarray, offsets: np.ndarray) -> Iterator[anchors.Runs]:
        step = anchors.STEP_BYTES
        if offsets[-1] <= 4 * step:
            yield whole(data, offsets)
            return
        for row, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for s in range(a, z, step):
                e = min(z, s + step + window - 1)
                found = whole(data[s:e], np.array([0, e - s]))
                yield anchors.Runs(found.doc + row, found.first + s, found.end + s, found.at + s, found.h)
                if e == z:
                    break

    return of


class Cover:
    """A text with ranks of what starts at its cover places."""

    def __init__(self, text: np.ndarray, window: int) -> None:
        n = len(text)
        self.text = np.concatenate([text, np.zeros(window + 64, np.uint8)])
        self.eights = np.ndarray((len(self.text) - 7,), ">u8", self.text.data, strides=(1,))
        residue = np.arange(n) % PERIOD
        self.offset = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
        at = np.flatnonzero(np.isin(residue, COVER))
        words = [self.eights[at + i].astype(np.uint64) for i in (0, 8, 16, 24)]
        words[3] &= ~np.uint64(0xFF)  # 31 bytes
        order = np.lexsort(words[::-1])
        new = np.zeros(len(at), bool)
        for w in words:
            new[1:] |= w[order][1:] != w[order][:-1]
        ranks = np.zeros(len(self.text), np.int32)
        ranks[at[order]] = np.cumsum(new) + 1
        self.reach, self.rank = [PERIOD], [ranks]
        while self.reach[-1] < window:
            step, before = self.reach[-1], self.rank[-1]
            pairs = before[at].astype(np.int64) * (len(at) + 2) + before[np.minimum(at + step, len(before) - 1)]
            ranks = np.zeros(len(self.text), np.int32)
            ranks[at] = np.unique(pairs, return_inverse=True)[1] + 1
            # two lengths are used: the first to cover the window, and the one before
            self.reach, self.rank = [step, 2 * step], [before, ranks]

    def head(self, at: np.ndarray, size: int) -> list[np.ndarray]:
        """The first `size` bytes at places, as numbers that sort like them."""
        out = []
        for i in range(0, size, 8):
            w = self.eights[at + i].astype(np.uint64)
            if size - i < 8:
                w &= ~np.uint64((1 << 8 * (8 - size + i)) - 1)
            out.append(w)
        return out

    def sort(self, at: np.ndarray) -> np.ndarray:
        """Order of the suffixes at places of one residue."""
        skip = int(self.offset[at[0] % PERIOD]) if len(at) else 0
        return np.lexsort([self.rank[-1][at + skip], *self.head(at, skip)[::-1]])

    def same(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether `size` bytes are equal, for pairs of places of one residue."""
        if len(a) == 0:
            return np.zeros(0, bool)
        skip = int(self.offset[a[0] % PERIOD])
        level = max((i for i, r in enumerate(self.reach) if r + PERIOD <= size), default=0)
        reach, rank = self.reach[level], self.rank[level]
        out = np.ones(len(a), bool)
        for x, y in zip(self.head(a, skip), self.head(b, skip), strict=True):
            out &= x == y
        place = skip
        while True:
            out &= rank[a + place] == rank[b + place]
            if place + reach >= size - PERIOD:
                break
            place = min(place + reach, skip + (size - reach - skip) // PERIOD * PERIOD)
        for i in range(place + reach, size, 8):
            i = min(i, size - 8)
            out &= self.eights[a + i] == self.eights[b + i]
        return out


def repeats(texts: list[bytes], leads: list[int], window: int) -> list[list[tuple[int, int]]]:
    """Of each different run: ranges [first, end) of windows that start elsewhere too. leads: place of the anchor."""
    starts, at = [], 0
    for text, lead in zip(texts, leads, strict=True):
        at += -(at + lead) % PERIOD
        starts.append(at)
        at += len(text)
    laid = np.zeros(at, np.uint8)
    for s, text in zip(starts, texts, strict=True):
        laid[s : s + len(text)] = np.frombuffer(text, np.uint8)
    start, lead = np.array(starts), np.array(leads)
    count = np.array([len(t) for t in texts]) - window + 1
    cover = Cover(laid, window)
    twice = np.zeros(at + 1, bool)
    for before in range(int(lead.max()) + 1):
        own = np.flatnonzero((lead >= before) & (lead - before < count))
        if len(own) < 2:
            continue
        place = (start + lead)[own] - before
        place = place[cover.sort(place)]
        equal = cover.same(place[:-1], place[1:], window)
        twice[place[:-1][equal]] = True
        twice[place[1:][equal]] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], twice]).astype(np.int8)))
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        j = int(np.searchsorted(start, a, side="right")) - 1
        out[j].append((a - starts[j], b - starts[j]))
    return out


_RUN = "h bigint, doc bigint, key bigint, place bigint, lead int, piece binary, alone boolean"
#: Of runs that are narrowed: the way they went so far, and what all runs of (h, path) have in common.
_ITEM = f"{_RUN}, path int, fa int, fb int"


def _emit(window: int):
    """Runs of shared anchors that aren't hot: rows of _RUN; place: of the first window in the text."""
    names = [c.split(" ")[0] for c in _RUN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_runs(window)
        for b in batches:
            for a, _, data, offsets in anchors.unpack_batch(b.column(2)):
                raw = memoryview(data)
                for found in of(data, offsets):
                    row = found.doc + a
                    i = anchors.chosen(found.h, row, b.column(3), b.column(4), False)
                    if len(i) == 0:
                        continue
                    pieces = [bytes(raw[s:e]) for s, e in zip(found.first[i].tolist(), (found.end[i] + window - 1).tolist(), strict=True)]
                    lead, rows = (found.at[i] - found.first[i]).astype(np.int32), pa.array(row[i])
                    columns = [pa.array(found.h[i].view(np.int64)), b.column(0).take(rows), b.column(1).take(rows), pa.array(found.first[i] - offsets[found.doc[i]]), pa.array(lead), pa.array(pieces, pa.binary()), pa.array(np.ones(len(i), bool))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _emit_chunks(window: int):
    """(doc, key, place, piece) of chunks of neighbouring runs of hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_runs(window)
        for b in batches:
            for a, _, data, offsets in anchors.unpack_batch(b.column(2)):
                raw = memoryview(data)
                for found in of(data, offsets):
                    row = found.doc + a
                    i = anchors.chosen(found.h, row, b.column(3), b.column(4), True)
                    if len(i) == 0:
                        continue
                    first, last = anchors.chunks(found, i)
                    pieces = [bytes(raw[s:e]) for s, e in zip(found.first[first].tolist(), (found.end[last] + window - 1).tolist(), strict=True)]
                    rows = pa.array(row[first])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(found.first[first] - offsets[found.doc[first]]), pa.array(pieces, pa.binary())], names=["doc", "key", "place", "piece"])

    return run


def _runs_of_chunks(window: int):
    """The runs of chunks (doc, key, place, piece, alone), as rows of _ITEM; a window's anchor depends on nothing else."""
    names = [c.split(" ")[0] for c in _ITEM.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, k = byte_runs(window), window // 2
        for batch in batches:
            for b in pieces(batch, "piece"):
                data, offsets = text_buffer(b.column(3))
                raw = memoryview(data)
                for found in of(data, offsets):
                    rows, lead = pa.array(found.doc), (found.at - found.first).astype(np.int32)
                    text = [bytes(raw[s:e]) for s, e in zip(found.first.tolist(), (found.end + window - 1).tolist(), strict=True)]
                    place = b.column(2).to_numpy()[found.doc] + found.first - offsets[found.doc]
                    columns = [pa.array(found.h.view(np.int64)), b.column(0).take(rows), b.column(1).take(rows), pa.array(place), pa.array(lead), pa.array(text, pa.binary()), b.column(4).take(rows), pa.array(np.ones(len(lead), np.int32)), pa.array(lead), pa.array(lead + np.int32(k))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def narrower(piece: bytes, fa: int, fb: int, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """The windows of a piece, all of which hold its bytes [fa, fb), in two parts: (side, first and end byte of the part,
    and what its windows hold, as places in the piece)."""
    need = window - (fb - fa)
    if need == 0:
        return
    before, last = (need + 1) // 2, len(piece) - window
    top = min(last, fa - before)
    if top >= 0:
        yield 0, 0, top + window, fa - before, fb
    low = max(0, fa - before + 1)
    if low <= last:
        yield 1, low, len(piece), fa, fb + need - before + 1


def _narrow(window: int):
    """Rows of _ITEM, each as one or two rows with a longer common part."""
    names = [c.split(" ")[0] for c in _ITEM.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for _, doc, key, place, lead, piece, alone, path, fa, fb in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for side, low, high, a, z in narrower(piece, fa, fb, window):
                    way = 2 * path + side
                    h = xxhash.xxh3_64_intdigest(piece[a:z], way)
                    out.append((h - (1 << 64) if h >> 63 else h, doc, key, place + low, lead - low, piece[low:high], alone, way, a - low, z - low))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def _blocks(window: int):
    """Over rows of _RUN sorted by h: spans of bytes [first, end) to remove, of runs that are `alone`. A block ends where
    a new anchor starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[tuple[int, bytes], int] = {}
        texts, leads, many, rows, size, last = [], [], [], [], 0, None

        def spans() -> Iterator[pa.RecordBatch]:
            found = repeats(texts, leads, window) if texts else []
            for j, n in enumerate(many):
                if n > 1:
                    found[j] = [(0, len(texts[j]) - window + 1)]
            out = [(doc, key, place + a, place + b - 1 + window) for doc, key, place, j in rows for a, b in found[j]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc", "key", "first", "end"])

        for batch in batches:
            for h, doc, key, place, lead, piece, alone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != last and size >= BLOCK_BYTES:
                    yield from spans()
                    number.clear()
                    texts, leads, many, rows, size = [], [], [], [], 0
                last = h
                j = number.setdefault((h, piece), len(texts))
                if j == len(texts):
                    texts.append(piece)
                    leads.append(lead)
                    many.append(0)
                    size += len(piece)
                many[j] += 1
                if alone:
                    rows.append((doc, key, place, j))
                size += 32
        if rows:
            yield from spans()

    return run


_SPANS = "doc bigint, key bigint, first bigint, end bigint"


def _sorted(runs: DataFrame, window: int) -> DataFrame:
    return runs.select("h", "doc", "key", "place", "lead", "piece", "alone").repartition("h").sortWithinPartitions("h").mapInArrow(_blocks(window), _SPANS)


def _narrowed(chunks: DataFrame, window: int) -> list[DataFrame]:
    """Spans of the runs of anchors that are too many for a block, in rounds; `window` halves to the last byte bound them."""
    chunks = written(chunks, "suffix-chunks")
    kinds = written(chunks.groupBy("piece").agg(F.count("*").alias("n"), F.min(F.struct("doc", "key", "place")).alias("one")), "suffix-kinds")
    whole = lambda df: df.select("doc", "key", F.col("place").alias("first"), (F.col("place") + F.octet_length("piece")).alias("end"))
    out = [whole(chunks.join(kinds.where("n > 1").select("piece"), "piece", "left_semi"))]
    items = kinds.select("one.doc", "one.key", "one.place", "piece", (F.col("n") == 1).alias("alone")).mapInArrow(_runs_of_chunks(window), _ITEM)
    same = ["h", "path", "piece"]
    while True:
        items = written(items, "suffix-hot")
        if items.isEmpty():
            return out
        one = F.min(F.struct("doc", "key", "place", "lead", "fa", "fb", "alone")).alias("one")
        kinds = written(items.groupBy(*same).agg(F.count("*").alias("n"), one), "suffix-kinds")
        out.append(whole(items.where("alone").join(kinds.where("n > 1").select(*same), same, "left_semi")))
        sizes = kinds.groupBy("h", "path").agg(F.count("*").alias("kinds")).where("kinds > 1")
        left = kinds.join(sizes, ["h", "path"])
        rows = left.select("h", "one.doc", "one.key", "one.place", "one.lead", "piece", (F.col("one.alone") & (F.col("n") == 1)).alias("alone"), "path", "one.fa", "one.fb", "kinds")
        out.append(_sorted(rows.where(F.col("kinds") <= anchors.HOT_RUNS), window))
        items = rows.where(F.col("kinds") > anchors.HOT_RUNS).drop("kinds").mapInArrow(_narrow(window), _ITEM)


def spans(rows: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The candidate texts (doc, key, z), and the bytes [first, end) to remove of (doc, key)."""
    candidates = anchors.shared_anchors(rows, byte_runs(window), False, "suffix-anchors")
    joined = written(anchors.pack_texts(rows).join(candidates, ["doc", "key"]).select("doc", "key", "z", "shared", "hot"), "suffix-candidates")
    found = _sorted(joined.mapInArrow(_emit(window), _RUN), window)
    busy = joined.where(F.size("hot") > 0)
    if not busy.isEmpty():
        for more in _narrowed(busy.mapInArrow(_emit_chunks(window), "doc bigint, key bigint, place bigint, piece binary"), window):
            found = found.unionByName(more)
    return joined.select("doc", "key", "z"), written(found, "suffix-spans")


def removed(docs: DataFrame, window: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (bigint), kept_sha256, kept (binary, the remaining bytes; null where nothing
    was removed): a row for each row of docs."""
    small_batches(docs.sparkSession)
    source = F.coalesce(F.col(quoted(text)), F.lit(""))
    rows = docs.select(F.coalesce(F.col(quoted(doc_id)).cast("bigint"), F.lit(_NULL_DOC)).alias("doc"), F.xxhash64(source).alias("key"), source.alias("text"))
    candidates, found = spans(rows, window)
    lists = found.groupBy("doc", "key").agg(F.collect_list(F.struct(F.col("first").cast("int").alias("a"), F.col("end").cast("int").alias("b"))).alias("spans"))
    joined = candidates.dropDuplicates(["doc", "key"]).join(lists, ["doc", "key"]).select("doc", "key", "z", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, "z", 1 << 19):
                n_removed, n_spans, sha, kept = [], [], [], []
                for r, z in enumerate(b.column(2).to_pylist()):
                    data = np.frombuffer(anchors.unpacked(z), np.uint8)
                    own = b.column(3)[r].values
                    gone = anchors.cut(own.field(0).to_numpy(), own.field(1).to_numpy(), len(data))
                    left = data[~gone].tobytes()
                    n_removed.append(int(gone.sum()))
                    n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], names=["c_doc", "c_key", "n_removed", "n_spans", "c_sha", "kept"])

    changed = joined.mapInArrow(cut, "c_doc bigint, c_key bigint, n_removed bigint, n_spans bigint, c_sha string, kept binary")
    whole = rows.select("doc", "key", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    out = whole.join(changed, (F.col("doc") == F.col("c_doc")) & (F.col("key") == F.col("c_key")), "left")
    none = F.lit(0).cast("bigint")
    return out.select(F.nullif(F.col("doc"), F.lit(_NULL_DOC)).alias("doc_id"), "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("c_sha", "sha").alias("kept_sha256"), "kept")
