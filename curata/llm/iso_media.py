"""Media columns: ISO base media containers (MP4, MOV) in a binary column.

`packed` stores bytes losslessly as a gray picture track: 8-bit samples, 64 of them (8 x 8) a frame, with sample tables of
the usual form. `probed` walks the boxes of any container, decodes the sample tables and gives codec, duration and the
byte ranges of keyframes for each track; media data is never read, and no payload is decoded. `stored_bytes` cuts the
ranges that a track's samples take out of the container.

Boxes: a 32- or 64-bit size, or 0 for the rest; sample tables stsd, stts, stsc, stsz, stz2, stco, co64 and stss. Sample
tables of fragments (moof) are not read. What is no container, or is cut or contradictory, has an error and no
tracks; tables are checked against the length of their boxes before anything of their size is made.

A null value gives null in every result, without an error. An empty value is no container. Each row is judged alone:
ties and repeated rows have no effect on others. Values of any length are taken whole. Further columns are handed on; one
that has the name of a result, in any case of letters, is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.common import mapped, others, pieces, quoted, small_batches

#: Of `packed`: side of a frame, frames a second, frames from one keyframe to the next, frames a chunk.
SIDE, FRAMES_A_SECOND, KEY_EVERY, CHUNK_FRAMES = 8, 25, 25, 256
FRAME = SIDE * SIDE
#: Fixed: QuickTime's uncompressed pictures, and its number for 8-bit gray.
CODEC, GRAY_8 = b"raw ", 40
#: Fixed: boxes that hold boxes.
HOLDERS = frozenset([b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex", b"moof", b"traf"])
#: Nested boxes beyond this are an error.
DEEPEST = 16

RANGE = "struct<first_sample:bigint,samples:bigint,offset:bigint,size:bigint>"
TRACK = f"struct<track_id:bigint,handler:string,codec:string,timescale:bigint,duration:bigint,samples:bigint,sample_bytes:bigint,keyframes:array<{RANGE}>,chunks:array<{RANGE}>>"
_RANGE = pa.struct([(n, pa.int64()) for n in ("first_sample", "samples", "offset", "size")])
_TRACK = pa.struct([("track_id", pa.int64()), ("handler", pa.string()), ("codec", pa.string()), *((n, pa.int64()) for n in ("timescale", "duration", "samples", "sample_bytes")), ("keyframes", pa.list_(_RANGE)), ("chunks", pa.list_(_RANGE))])


class Malformed(ValueError):
    """Bytes that are no container, or contradict themselves."""


# ---------------------------------------------------------------- writing


def _box(kind: bytes, *parts: bytes) -> bytes:
    size = 8 + sum(map(len, parts))
    return b"".join([struct.pack(">I4s", size, kind), *parts])


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


_UNITY = struct.pack(">9i", 1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30)


def pack(data: bytes) -> bytes:
    """A container whose one track holds data, padded with 0 to a positive number of whole frames."""
    frames = max(1, -(-len(data) // FRAME))
    payload = data.ljust(frames * FRAME, b"\0")
    file_type = _box(b"ftyp", b"qt  ", struct.pack(">I", 0), b"qt  ")
    wide = len(payload) >= 1 << 31
    head = struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload)) if wide else struct.pack(">I4s", 8 + len(payload), b"mdat")
    at = len(file_type) + len(head)
    chunks = np.arange(0, frames, CHUNK_FRAMES, dtype=np.int64)
    rest = frames - int(chunks[-1])
    runs = [(1, CHUNK_FRAMES)] * (len(chunks) > 1) + [(len(chunks), rest)] * (len(chunks) == 1 or rest != CHUNK_FRAMES)
    entry = _box(CODEC, bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 72 << 16, 72 << 16, 0, 1), bytes(32), struct.pack(">Hh", GRAY_8, -1))
    where = at + chunks * FRAME
    offsets = _full(b"co64", struct.pack(">I", len(where)), where.astype(">u8").tobytes()) if wide else _full(b"stco", struct.pack(">I", len(where)), where.astype(">u4").tobytes())
    keys = np.arange(1, frames + 1, KEY_EVERY)
    tables = _box(
        b"stbl",
        _full(b"stsd", struct.pack(">I", 1), entry),
        _full(b"stts", struct.pack(">III", 1, frames, 1)),
        _full(b"stss", struct.pack(">I", len(keys)), keys.astype(">u4").tobytes()),
        _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", first, n, 1) for first, n in runs)),
        _full(b"stsz", struct.pack(">II", FRAME, frames)),
        offsets,
    )
    media = _box(
        b"mdia",
        _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, FRAMES_A_SECOND, frames, 0x55C4, 0)),
        _full(b"hdlr", struct.pack(">I4s", 0, b"vide"), bytes(13)),
        _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), tables),
    )
    track = _box(b"trak", _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, frames), bytes(16), _UNITY, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3), media)
    movie = _box(b"moov", _full(b"mvhd", struct.pack(">IIIIIH", 0, 0, FRAMES_A_SECOND, frames, 1 << 16, 1 << 8), bytes(10), _UNITY, bytes(24), struct.pack(">I", 2)), track)
    return b"".join([file_type, head, payload, movie])


# ---------------------------------------------------------------- reading


def boxes(data: memoryview, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, first byte of the content, end) of each box side by side in data[start:end]."""
    while start < end:
        if end - start < 8:
            raise Malformed("a box's head is cut")
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if end - start < 16:
                raise Malformed("a box's head is cut")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise Malformed(f"box {kind.decode('latin-1')} of {size} bytes doesn't fit")
        yield kind, start + head, start + size
        start += size


def _leaves(data: memoryview, start: int, end: int, depth: int = 0) -> list[tuple[bytes, int, int]]:
    """The boxes below, holders walked into; a track's are kept together by its own entry before them."""
    if depth > DEEPEST:
        raise Malformed("boxes are nested too deeply")
    out = []
    for kind, a, z in boxes(data, start, end):
        out.append((kind, a, z))
        if kind in HOLDERS:
            out += _leaves(data, a, z, depth + 1)
    return out


def _table(data: memoryview, a: int, z: int, kind: str, head: int = 8) -> np.ndarray:
    """The entries after version and flags, further head bytes and, at their end, the number of entries."""
    if z - a < head:
        raise Malformed("a table's head is cut")
    (n,) = struct.unpack_from(">I", data, a + head - 4)
    entry = np.dtype(kind)
    if n * entry.itemsize > z - a - head:
        raise Malformed(f"a table of {n} entries doesn't fit its box")
    return np.frombuffer(data, entry, n, a + head)


def _sizes(data: memoryview, found: dict[bytes, tuple[int, int]]) -> tuple[int, np.ndarray | int]:
    """Number of samples, and their sizes: one, or one for each."""
    if b"stsz" in found:
        a, z = found[b"stsz"]
        if z - a < 12:
            raise Malformed("a table's head is cut")
        size, n = struct.unpack_from(">II", data, a + 4)
        return (n, size) if size else (n, _table(data, a, z, ">u4", 12).astype(np.int64))
    if b"stz2" in found:
        a, z = found[b"stz2"]
        if z - a < 12:
            raise Malformed("a table's head is cut")
        bits, n = data[a + 7], struct.unpack_from(">I", data, a + 8)[0]
        if bits in (8, 16):
            return n, _table(data, a, z, f">u{bits // 8}", 12).astype(np.int64)
        if bits != 4 or (n + 1) // 2 > z - a - 12:
            raise Malformed("a table of small sizes doesn't fit its box")
        both = np.frombuffer(data, np.uint8, (n + 1) // 2, a + 12)
        return n, np.stack([both >> 4, both & 15], 1).ravel()[:n].astype(np.int64)
    raise Malformed("a track has no sample sizes")


def _header(data: memoryview, a: int, z: int) -> tuple[int, int]:
    """Timescale and duration of mdhd."""
    form, at = (">IQ", 20) if data[a] == 1 else (">II", 12)
    if z - a < at + struct.calcsize(form):
        raise Malformed("a header is cut")
    return struct.unpack_from(form, data, a + at)


def _track(data: memoryview, found: dict[bytes, tuple[int, int]]) -> dict:
    for kind in (b"tkhd", b"mdhd", b"hdlr", b"stsd", b"stts", b"stsc"):
        if kind not in found:
            raise Malformed(f"a track has no {kind.decode()}")
        if found[kind][1] - found[kind][0] < 16 - 8 * (kind in (b"stts", b"stsc")):
            raise Malformed(f"{kind.decode()} is cut")
    timescale, duration = _header(data, *found[b"mdhd"])
    a, z = found[b"tkhd"]
    at = 20 if data[a] == 1 else 12
    if z - a < at + 4:
        raise Malformed("tkhd is cut")
    (track_id,) = struct.unpack_from(">I", data, a + at)
    handler = bytes(data[found[b"hdlr"][0] + 8 : found[b"hdlr"][0] + 12])
    codec = bytes(data[found[b"stsd"][0] + 12 : found[b"stsd"][0] + 16])
    n, sizes = _sizes(data, found)
    if isinstance(sizes, int) and n * sizes > len(data):
        raise Malformed("samples lie beyond the end")
    times = _table(data, *found[b"stts"], "2>u4").reshape(-1, 2).astype(np.int64)
    if int(times[:, 0].sum()) != n:
        raise Malformed("times and sizes are of different numbers of samples")
    if duration in (0, (1 << 32) - 1, (1 << 64) - 1):  # unknown: the samples say it
        duration = int((times[:, 0].astype(np.uint64) * times[:, 1].astype(np.uint64)).sum())  # below 2**64, as there are fewer than 2**32 samples
    if duration >= 1 << 63:
        raise Malformed("a track is too long")
    per_chunk = _table(data, *found[b"stsc"], "3>u4").reshape(-1, 3).astype(np.int64)
    if b"co64" in found:
        offsets = _table(data, *found[b"co64"], ">u8").astype(np.int64)
    elif b"stco" in found:
        offsets = _table(data, *found[b"stco"], ">u4").astype(np.int64)
    else:
        raise Malformed("a track has no chunk offsets")
    # each entry of per_chunk holds up to the next one's first chunk
    first = per_chunk[:, 0]
    if len(first) and (first[0] != 1 or (np.diff(first) <= 0).any() or first[-1] > max(1, len(offsets))) or (len(offsets) and not len(first)):
        raise Malformed("chunks are out of order")
    counts = np.repeat(per_chunk[:, 1], np.diff(np.append(first, len(offsets) + 1))) if len(first) and len(offsets) else np.zeros(0, np.int64)
    if int(counts.sum()) != n:
        raise Malformed("chunks and sizes are of different numbers of samples")
    starts = np.cumsum(counts) - counts  # of each chunk, its first sample
    if isinstance(sizes, int):
        ends = None
        chunk_bytes, total = counts * sizes, n * sizes
    else:
        ends = np.cumsum(sizes)
        before = np.append(0, ends)
        chunk_bytes, total = before[starts + counts] - before[starts], int(ends[-1]) if n else 0
    if len(offsets) and (int(offsets.min()) < 0 or int(offsets.max()) > len(data) or int((offsets + chunk_bytes).max()) > len(data)):
        raise Malformed("samples lie beyond the end")
    if b"stss" in found:
        keys = _table(data, *found[b"stss"], ">u4").astype(np.int64) - 1
        if len(keys) and (keys[0] < 0 or keys[-1] >= n or (np.diff(keys) <= 0).any()):
            raise Malformed("keyframes are out of order")
        chunk = np.searchsorted(starts + counts, keys, side="right")
        into = (keys - starts[chunk]) * sizes if ends is None else before[keys] - before[starts[chunk]]
        key_ranges = _joined(keys, np.ones(len(keys), np.int64), offsets[chunk] + into, np.full(len(keys), sizes) if ends is None else sizes[keys])
    else:  # every sample is one
        key_ranges = _joined(starts, counts, offsets, chunk_bytes)
    return {
        "track_id": track_id, "handler": handler.decode("latin-1"), "codec": codec.decode("latin-1"), "timescale": timescale, "duration": duration, "samples": n, "sample_bytes": total,
        "keyframes": key_ranges, "chunks": _joined(starts, counts, offsets, chunk_bytes),
    }


def _joined(first: np.ndarray, samples: np.ndarray, offset: np.ndarray, size: np.ndarray) -> list[dict]:
    """Ranges of samples, with those that follow each other in samples and bytes as one."""
    full = np.flatnonzero(samples > 0)
    first, samples, offset, size = first[full], samples[full], offset[full], size[full]
    if not len(full):
        return []
    begins = np.append(True, (first[1:] != first[:-1] + samples[:-1]) | (offset[1:] != offset[:-1] + size[:-1]))
    at = np.flatnonzero(begins)
    columns = first[at], np.add.reduceat(samples, at), offset[at], np.add.reduceat(size, at)
    return [dict(zip(("first_sample", "samples", "offset", "size"), r, strict=True)) for r in zip(*(c.tolist() for c in columns), strict=True)]


def probe(data: bytes) -> list[dict]:
    """The tracks of a container, in their order; Malformed where there is none, or it contradicts itself."""
    view, tracks, own = memoryview(data), [], None
    movies = [(a, z) for kind, a, z in boxes(view, 0, len(view)) if kind == b"moov"]
    if not movies:
        raise Malformed("no moov box")
    for a, z in movies:
        for kind, b, e in _leaves(view, a, z):
            if kind == b"trak":
                own = {}
                tracks.append(own)
            elif own is not None and kind not in HOLDERS:
                own.setdefault(kind, (b, e))
    return [_track(view, t) for t in tracks]


def read(data: bytes, ranges: list[dict]) -> bytes:
    return b"".join([data[r["offset"] : r["offset"] + r["size"]] for r in ranges])


# ---------------------------------------------------------------- columns


def _added(df: DataFrame, source: str, more: list[tuple[str, str]], columns) -> DataFrame:
    """All columns of df, plus more (name, type): columns(values of source) gives a list of arrays."""
    small_batches(df.sparkSession)
    keep = others(df.columns, [n for n, _ in more])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    taken = df.select(*map(quoted, keep), *([] if source in keep else [quoted(source)]))
    own = taken.columns.index(source)
    names = [*keep, *(n for n, _ in more)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, own):
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *columns(b.column(own))], names=names)

    return mapped(taken, run, ", ".join([*(f"{quoted(c)} {kinds[c]}" for c in keep), *(f"{n} {t}" for n, t in more)]))


def packed(df: DataFrame, data: str = "data") -> DataFrame:
    """All columns of df, plus media (binary): a container that holds data (binary or string; a null is empty)."""
    binary = df.withColumn(data, F.coalesce(F.col(quoted(data)).cast("binary"), F.lit(b"")))
    return _added(binary, data, [("media", "binary")], lambda values: [pa.array([pack(v.as_buffer().to_pybytes()) for v in values], pa.binary())])


def _probed(values: pa.Array) -> list[pa.Array]:
    tracks, errors = [], []
    for v in values:
        try:
            tracks.append(None if not v.is_valid else probe(v.as_buffer()))
            errors.append(None)
        except Malformed as e:
            tracks.append(None)
            errors.append(str(e))
    return [pa.array(tracks, pa.list_(_TRACK)), pa.array(errors, pa.string())]


def probed(df: DataFrame, media: str = "media") -> DataFrame:
    """All columns of df, plus tracks (array of track_id, handler, codec, timescale, duration, samples, sample_bytes,
    keyframes and chunks: ranges of samples and bytes) and media_error (string: why there are none)."""
    return _added(df, media, [("tracks", f"array<{TRACK}>"), ("media_error", "string")], _probed)


def stored_bytes(media: Column, ranges: Column) -> Column:
    """The bytes of ranges (as in keyframes and chunks) of a container, in one value; null where either is."""
    cuts = F.transform(ranges, lambda r: F.substring(media, (r["offset"] + 1).cast("int"), r["size"].cast("int")))
    return F.when(media.isNotNull() & ranges.isNotNull(), F.aggregate(cuts, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)))
