"""Substring dedup by relative Lempel-Ziv parsing: word windows that an earlier document holds are removed.

1. Window anchors (see `anchors`) drop documents, and runs of windows, that no other document can share.
2. What is left is dealt by anchor, to find which blocks have to meet: the document with the smallest doc_id of those with
   a window's hash is a reference of the others. Anchors with very many runs are aggregated first: their neighbouring
   runs are cut into chunks by content, and equal chunks, or equal runs, have one first holder; what a text repeats
   within CELL_WORDS words is one row. Of all this only pairs of blocks are kept, CHUNK_WORDS words of a reference and CELL_WORDS of a later document; which windows met is forgotten.
3. Every block of a later document, neighbouring ones joined, is factored greedily against the reference block: at each
   place the longest copy from the reference, or one word where there is none. The longest copies come from a suffix
   array over both together, by prefix doubling: a place's longest copy is the longer of what it shares with the
   references next to it in order.
4. A factor of `window` words or more is a duplicate span. At a factor's end, the copies that start within it and cross
   the end are checked too, so a window that lies in two factors is found. Only these spans are removed: hashes choose
   what is compared, the words themselves decide.

References with many stretches are split by document, each part with a copy of the reference.

Words are runs of bytes other than ASCII white space. A null text has no words. Rows without doc_id are neither searched
nor a reference. Rows are told apart by (doc_id, 64-bit hash of the text); rows with one doc_id are one document, so they
remove nothing from each other. Texts are taken whole, long ones in segments that overlap by a window; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm import anchors
from curata.llm.common import SPACE_BYTES, mixed, pieces, quoted, sequence_hashes, small_batches, span_hashes, text_buffer, words_of, written

GRAM = 4
#: Words of one reference block, and of a block of a later document; pairs of blocks of one part of a reference's; words
#: that are factored together.
CHUNK_WORDS, CELL_WORDS, PART_LINKS, BLOCK_WORDS = 200_000, 64, 8000, 400_000
#: Windows that are compared together.
LINK_WINDOWS = 1 << 19

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True


class WordRuns(anchors.Runs):
    """Runs of a step, with the hashes of its words and their bytes, and for each run its first word's place in the text."""

    words: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    place: np.ndarray


def word_segments(data: np.ndarray, window: int, step: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of one text: (first word's number, start and end bytes of words) of segments that share window - 1 words."""
    at, number, end, n = 0, 0, 0, len(data)
    while True:
        end = min(n, end + step)
        while end < n and not _IS_SPACE[data[end]]:
            gap = np.flatnonzero(_IS_SPACE[data[end : end + step]])
            end = end + int(gap[0]) if len(gap) else min(n, end + step)
        start, stop, _ = words_of(data[at:end], np.array([0, end - at]))
        yield number, start + at, stop + at
        if end >= n:
            return
        shared = min(window - 1, len(start))
        number += len(start) - shared
        at = at + int(start[-shared]) if shared else end


def word_runs(window: int):
    """A function of (data, offsets) that yields the runs of windows of words of the texts in a buffer."""

    def one(data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray, row: int, number: int, base: int) -> WordRuns:
        words = span_hashes(data, start, end)
        h = np.zeros(max(0, len(words) - GRAM + 1), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(GRAM):
                h = mixed(h + words[k : k + len(h)])
        found = anchors.runs(h, at, GRAM, window)
        out = WordRuns(found.doc + row, *found[1:])
        out.words, out.start, out.stop, out.place = words, start + base, end + base, found.first - at[found.doc] + number
        return out

    def of(data: np.ndarray, offsets: np.ndarray) -> Iterator[WordRuns]:
        if offsets[-1] <= 4 * anchors.STEP_BYTES:
            yield one(data, *words_of(data, offsets), 0, 0, 0)
            return
        for row, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for number, start, end in word_segments(data[a:z], window, anchors.STEP_BYTES):
                yield one(data[a:z], start, end, np.array([0, len(start)]), row, number, a)

    return of


# ---------------------------------------------------------------- which document to compare with which

_RUN = "h bigint, doc bigint, key bigint, place bigint, windows binary"
_LINK = "rdoc bigint, rkey bigint, rplace bigint, doc bigint, key bigint, first bigint, n int"
_LINK_NAMES = [c.split(" ")[0] for c in _LINK.split(", ")]


def _run_columns(found: WordRuns, i: np.ndarray, window: int) -> tuple[pa.Array, pa.Array]:
    """The anchors of the runs i, and the hashes of their windows."""
    many = (found.end - found.first)[i]
    each = np.repeat(found.first[i] - np.cumsum(many) + many, many) + np.arange(many.sum())
    hashes = sequence_hashes(found.words, each, np.full(len(each), window))
    ends = np.concatenate([[0], 8 * np.cumsum(many)]).astype(np.int32)
    return pa.array(found.h[i].view(np.int64)), pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(hashes.tobytes())])


_RUN_NAMES = [c.split(" ")[0] for c in _RUN.split(", ")]
#: Chunks and runs of hot anchors. n: windows from `place` on, as far as equal ones follow each other.
_CHUNK, _HOT_RUN = "doc bigint, key bigint, place bigint, piece binary, n int", _RUN + ", n int"


def repeats_joined(row: np.ndarray, what: list, place: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Which stay of equal items of a row that begin within CELL_WORDS words of each other, the first of each, and how many
    windows they reach over. No cell lies between such items, so the cells that they touch are the same."""
    number: dict = {}
    kind = np.array([number.setdefault(x, len(number)) for x in what], np.int64)
    order = np.lexsort((place, kind, row))
    new = np.ones(len(order), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (kind[order][1:] != kind[order][:-1]) | (np.diff(place[order]) > CELL_WORDS)
    at = np.flatnonzero(new)
    first, last = order[at], order[np.append(at[1:], len(order)) - 1]
    return first, pa.array((place[last] + many[last] - place[first]).astype(np.int32))


def _emit(window: int):
    """Runs of shared anchors that aren't hot: rows of _RUN."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = word_runs(window)
        for b in batches:
            for a, _, data, offsets in anchors.unpack_batch(b.column(2)):
                for found in of(data, offsets):
                    row = found.doc + a
                    i = anchors.chosen(found.h, row, b.column(3), b.column(4), False)
                    if len(i):
                        h, lists = _run_columns(found, i, window)
                        rows = pa.array(row[i])
                        yield pa.RecordBatch.from_arrays([h, b.column(0).take(rows), b.column(1).take(rows), pa.array(found.place[i]), lists], names=_RUN_NAMES)

    return run


def _emit_chunks(window: int):
    """Rows of _CHUNK of neighbouring runs of hot anchors; piece: the words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = word_runs(window)
        for b in batches:
            for a, _, data, offsets in anchors.unpack_batch(b.column(2)):
                raw = data.tobytes()
                for found in of(data, offsets):
                    row = found.doc + a
                    i = anchors.chosen(found.h, row, b.column(3), b.column(4), True)
                    if len(i) == 0:
                        continue
                    first, last = anchors.chunks(found, i)
                    begin, stop = found.start[found.first[first]], found.stop[found.end[last] + window - 2]
                    pieces = [b" ".join(raw[s:e].split()) for s, e in zip(begin.tolist(), stop.tolist(), strict=True)]
                    kept, n = repeats_joined(row[first], pieces, found.place[first], found.end[last] - found.first[first])
                    rows = pa.array(row[first[kept]])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(found.place[first[kept]]), pa.array([pieces[j] for j in kept.tolist()], pa.binary()), n], names=["doc", "key", "place", "piece", "n"])

    return run


def _runs_of_chunks(window: int):
    """The runs of chunks (doc, key, place, piece) as rows of _HOT_RUN; a window's anchor depends on nothing else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = word_runs(window)
        for batch in batches:
            for b in pieces(batch, "piece", anchors.STEP_BYTES):
                data, offsets = text_buffer(b.column(3))
                for found in of(data, offsets):
                    h, lists = _run_columns(found, np.arange(len(found.h)), window)
                    place = b.column(2).to_numpy()[found.doc] + found.place
                    kept, n = repeats_joined(found.doc, list(zip(found.h.tolist(), lists.to_pylist(), strict=True)), place, found.end - found.first)
                    rows, kept = pa.array(found.doc[kept]), pa.array(kept)
                    yield pa.RecordBatch.from_arrays([h.take(kept), b.column(0).take(rows), b.column(1).take(rows), pa.array(place).take(kept), lists.take(kept), n], names=[*_RUN_NAMES, "n"])

    return run


def first_holders(h: np.ndarray, doc: np.ndarray, key: np.ndarray, place: np.ndarray, windows: list[bytes]) -> list[np.ndarray]:
    """Columns of _LINK of runs sorted by (h, doc, key, place): windows that a smaller document holds, and the first that does."""
    many = np.array([len(w) // 8 for w in windows])
    of = np.repeat(np.arange(len(many)), many)
    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    values = np.frombuffer(b"".join(windows), np.uint64)
    order = np.lexsort((values, h[of]))  # stable, so windows with one hash stay in order of (doc, key, place)
    new = np.ones(len(order), bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (h[of[order]][1:] != h[of[order]][:-1])
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    linked = doc[of] > doc[of[first]]
    starts = linked.copy()  # neighbours that link to neighbours are one link
    starts[1:] &= ~(linked[:-1] & (of[1:] == of[:-1]) & (first[1:] == first[:-1] + 1) & (of[first[1:]] == of[first[:-1]]))
    at = np.flatnonzero(starts)
    number = np.cumsum(starts) - 1
    n = np.bincount(number[linked], minlength=len(at))
    ref = first[at]
    return [doc[of[ref]], key[of[ref]], place[of[ref]] + offset[ref], doc[of[at]], key[of[at]], place[of[at]] + offset[at], n.astype(np.int32)]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows of _RUN sorted by (h, doc, key, place): rows of _LINK. An anchor's runs are compared together."""
    held: list[pa.RecordBatch] = []
    size = 0

    def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        found = first_holders(*(rows.column(c).to_numpy() for c in range(4)), rows.column(4).to_pylist())
        if len(found[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=_LINK_NAMES)

    for b in batches:
        if b.num_rows == 0:
            continue
        held.append(b)
        size += b.column(4).nbytes >> 3
        if size < LINK_WINDOWS:
            continue
        rows = pa.Table.from_batches(held)
        h = rows.column(0).to_numpy()
        done = int(np.count_nonzero(h != h[-1]))  # the last anchor may go on
        if done:
            yield from out(rows.slice(0, done))
            rows = rows.slice(done).combine_chunks()
        held = rows.to_batches()
        size = sum(x.column(4).nbytes >> 3 for x in held)
    if held:
        yield from out(pa.Table.from_batches(held))


def _dealt(runs: DataFrame) -> DataFrame:
    return runs.select("h", "doc", "key", "place", "windows").repartition("h").sortWithinPartitions("h", "doc", "key", "place").mapInArrow(_links, _LINK)


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a run as a run of its own (rows of _HOT_RUN), dealt by anchor and window."""
    for b in batches:
        many = np.array([len(w.as_py()) // 8 for w in b.column(4)])
        of = np.repeat(np.arange(len(many)), many)
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        raw = b"".join(w.as_py() for w in b.column(4))
        values = np.frombuffer(raw, np.uint64)
        h = mixed(values ^ mixed(b.column(0).to_numpy().view(np.uint64)[of]))
        rows = pa.array(of)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column(1).take(rows), b.column(2).take(rows), pa.array(b.column(3).to_numpy()[of] + offset), pa.array([raw[i : i + 8] for i in range(0, len(raw), 8)], pa.binary()), pa.array(np.ones(len(of), np.int32))], names=[*_RUN_NAMES, "n"])


def _to_first(rows: DataFrame, kinds: DataFrame, same: list[str], *more: Column) -> DataFrame:
    """Rows of _LINK: all windows of the rows whose kind a smaller document holds first."""
    later = rows.join(kinds, same).where("doc > one.doc")
    return later.select(F.col("one.doc").alias("rdoc"), F.col("one.key").alias("rkey"), F.col("one.place").alias("rplace"), "doc", "key", F.col("place").alias("first"), "n", *more)


def _within_blocks(found: DataFrame) -> DataFrame:
    """Links cut where their place in the reference, `held` windows long, passes from one of its blocks to the next. What is
    repeated (n over held, and held at most CELL_WORDS) meets both blocks whole."""
    chunk = F.explode(F.sequence(F.floor(F.col("rplace") / CHUNK_WORDS), F.floor((F.col("rplace") + F.col("held") - 1) / CHUNK_WORDS))).alias("c")
    start, end = F.greatest(F.col("rplace"), F.col("c") * CHUNK_WORDS), F.least(F.col("rplace") + F.col("held"), (F.col("c") + 1) * CHUNK_WORDS)
    once = F.col("n") == F.col("held")
    first, n = F.when(once, F.col("first") + start - F.col("rplace")).otherwise(F.col("first")), F.when(once, end - start).otherwise(F.col("n"))
    return found.select("*", chunk).select("rdoc", "rkey", start.alias("rplace"), "doc", "key", first.alias("first"), n.cast("int").alias("n"))


def _frequent_links(chunks: DataFrame, window: int) -> list[DataFrame]:
    """Links of the runs of anchors that are too many for one task: equal chunks, then equal runs, have one first holder;
    it goes on alone, and where those are still too many, window by window."""
    one = F.min(F.struct("doc", "key", "place")).alias("one")
    chunks = written(chunks, "substring-chunks")
    kinds = written(chunks.groupBy("piece").agg(one), "substring-kinds")
    n_words = F.size(F.split(F.col("piece").cast("string"), " "))
    out = [_within_blocks(_to_first(chunks, kinds, ["piece"], (n_words - window + 1).alias("held")))]
    runs = kinds.select("one.doc", "one.key", "one.place", "piece").mapInArrow(_runs_of_chunks(window), _HOT_RUN)
    for single in (False, True):
        runs = written(runs, "substring-hot")
        if runs.isEmpty():
            break
        kinds = written(runs.groupBy("h", "windows").agg(one), "substring-kinds")
        out.append(_to_first(runs, kinds, ["h", "windows"]))
        if single:
            break
        sizes = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
        left = kinds.join(sizes, "h").select("h", "one.doc", "one.key", "one.place", "windows", "kinds")
        out.append(_dealt(left.where(F.col("kinds") <= anchors.HOT_RUNS)))
        runs = left.where(F.col("kinds") > anchors.HOT_RUNS).drop("kinds").mapInArrow(_apart, _HOT_RUN)
    return out


def links(candidates: DataFrame, window: int) -> DataFrame:
    """Rows of _LINK for the candidates (doc, key, z, shared, hot): n windows from `first` on, which the document rdoc
    (a smaller one) holds from `rplace` on."""
    found = _dealt(candidates.mapInArrow(_emit(window), _RUN))
    busy = candidates.where(F.size("hot") > 0)
    if not busy.isEmpty():
        for more in _frequent_links(busy.mapInArrow(_emit_chunks(window), _CHUNK), window):
            found = found.unionByName(more)
    return written(found, "substring-links")


# ---------------------------------------------------------------- parsing


class Parser:
    """Longest copies of stretches from their references, for several references at once."""

    def __init__(self, groups: list[tuple[list[bytes], list[list[bytes]]]]) -> None:
        numbers, self.begin, mine, next_word = [], [], [], 1
        for reference, stretches in groups:
            words: dict[bytes, int] = {}  # each reference has an alphabet of its own; 0 is a word that it lacks
            for w in reference:
                if w not in words:
                    words[w] = next_word
                    next_word += 1
            numbers.append([words[w] for w in reference])
            mine.append(True)
            for s in stretches:
                numbers.append([words.get(w, 0) for w in s])
                mine.append(False)
        sizes = np.array([len(x) + 1 for x in numbers])
        self.begin = np.cumsum(sizes) - sizes
        text = np.concatenate([np.array([*x, next_word + j], np.int64) for j, x in enumerate(numbers)])  # each ends with a mark of its own
        longest = max((len(x) for x, m in zip(numbers, mine, strict=True) if not m), default=0)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int32)
        self.ranks, n = [rank], len(text)
        while (1 << len(self.ranks) - 1) <= longest and int(rank.max()) + 1 < n:
            step = 1 << len(self.ranks) - 1
            pairs = rank.astype(np.int64) * (n + 1)
            pairs[: n - step] += rank[step:] + 1
            rank = np.unique(pairs, return_inverse=True)[1].astype(np.int32)
            self.ranks.append(rank)
        order = np.argsort(rank, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        is_ref = np.repeat(mine, sizes)
        here = np.where(is_ref[order], np.arange(n), -1)
        before = np.maximum.accumulate(here)
        after = n - 1 - np.maximum.accumulate(np.where(is_ref[order][::-1], np.arange(n), -1))[::-1]
        own = np.flatnonzero(~is_ref)
        left, right = before[place[own]], after[place[own]]
        # a place with no reference on one side is compared with the end of one, which nothing equals
        end = self.begin[0] + sizes[0] - 1
        left, right = np.where(left >= 0, order[left], end), np.where(right < n, order[np.minimum(right, n - 1)], end)
        a, b = self.shared(own, left), self.shared(own, right)
        self.length, self.source = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.length[own], self.source[own] = np.maximum(a, b), np.where(a >= b, left, right)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from places a and b on."""
        out = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            out += (rank[a + out] == rank[b + out]).astype(np.int64) << level
        return out


def factors(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """The greedy parse as (start, end), given the longest copy at each place: that copy, or one word."""
    i = 0
    while i < len(lengths):
        end = i + max(1, lengths[i])
        yield i, end
        i = end


def duplicate_spans(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """Spans [first, end) of words in factors of `window` words or more, and in such copies that cross a factor's end."""
    out: list[tuple[int, int]] = []
    for start, end in factors(lengths):
        crossing = (i for i in range(max(start + 1, end - window + 1), end) if lengths[i] >= window and i + lengths[i] > end)
        for i in (start, *crossing):
            if lengths[i] >= window:
                if out and out[-1][1] >= i:
                    out[-1] = (out[-1][0], max(out[-1][1], i + lengths[i]))
                else:
                    out.append((i, i + lengths[i]))
    return out


_PIECE = "rdoc bigint, rkey bigint, chunk bigint, part bigint, kind int, doc bigint, key bigint, place bigint, piece binary"
_PIECE_NAMES = [c.split(" ")[0] for c in _PIECE.split(", ")]


def _reference(window: int):
    """The reference blocks of texts: (doc, key, chunk, parts, z) as rows of _PIECE, one for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, key, chunk, parts, z in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = anchors.unpacked(z).split()
                piece = b" ".join(words[chunk * CHUNK_WORDS : (chunk + 1) * CHUNK_WORDS + 2 * window])
                yield pa.RecordBatch.from_pylist([dict(zip(_PIECE_NAMES, (doc, key, chunk, part, 0, doc, key, 0, piece), strict=True)) for part in range(parts)], schema=_PIECES)

    return run


_PIECES = pa.schema([(n, {"kind": pa.int32(), "piece": pa.binary()}.get(n, pa.int64())) for n in _PIECE_NAMES])


def _stretches(window: int):
    """The stretches of texts that meet a reference block, neighbouring cells joined: (doc, key, z, cells) as rows of _PIECE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            for doc, key, z, met in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = anchors.unpacked(z).split()
                order = sorted((x["rdoc"], x["rkey"], x["chunk"], x["part"], x["cell"]) for x in met)
                for ref, own in groupby(order, key=lambda x: x[:4]):
                    joined: list[list[int]] = []
                    for *_, cell in own:
                        if joined and cell == joined[-1][1]:
                            joined[-1][1] = cell + 1
                        else:
                            joined.append([cell, cell + 1])
                    for first, end in ((c * CELL_WORDS, min(len(words), d * CELL_WORDS + window - 1)) for c, d in joined):
                        for a in range(first, max(first + 1, end - window + 1), CHUNK_WORDS // 2):
                            piece = b" ".join(words[a : min(end, a + CHUNK_WORDS // 2 + window - 1)])
                            out.append((*ref, 1, doc, key, a, piece))
                            size += len(piece)
                if size > anchors.STEP_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECES.types, strict=True)], schema=_PIECES)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECES.types, strict=True)], schema=_PIECES)

    return run


def _parsed(window: int):
    """Over rows of _PIECE sorted by reference, the reference first: spans (doc, key, first, end) of words to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[tuple[list[bytes], list[list[bytes]]]] = []
        whose: list[list[tuple[int, int, int]]] = []
        size, now = 0, None

        def spans() -> Iterator[pa.RecordBatch]:
            parser, out, number = Parser(groups), [], 0
            for (_, stretches), owners in zip(groups, whose, strict=True):
                number += 1
                for s, (doc, key, place) in zip(stretches, owners, strict=True):
                    at = parser.begin[number]
                    out += [(doc, key, place + a, place + z) for a, z in duplicate_spans(parser.length[at : at + len(s)].tolist(), window)]
                    number += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc", "key", "first", "end"])

        for b in batches:
            for rdoc, rkey, chunk, part, kind, doc, key, place, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = piece.split()
                if size + len(words) > BLOCK_WORDS and any(s for _, s in groups):
                    yield from spans()
                    groups, whose = ([(groups[-1][0], [])], [[]]) if kind else ([], [])
                    size = sum(len(r) for r, _ in groups)
                if kind == 0:
                    if groups and not groups[-1][1]:  # a reference without stretches
                        groups.pop(), whose.pop()
                    now = (rdoc, rkey, chunk, part)
                    groups.append((words, []))
                    whose.append([])
                elif now == (rdoc, rkey, chunk, part):
                    groups[-1][1].append(words)
                    whose[-1].append((doc, key, place))
                size += len(words)
        if any(s for _, s in groups):
            yield from spans()

    return run


def meetings(found: DataFrame) -> DataFrame:
    """rdoc, rkey, chunk, doc, key, cell: the pairs of blocks that links (rows of _LINK) touch, each once. They say what is
    to be factored against what, not what is equal."""
    cells = F.explode(F.sequence(F.floor(F.col("first") / CELL_WORDS), F.floor((F.col("first") + F.col("n") - 1) / CELL_WORDS))).alias("cell")
    return written(found.select("rdoc", "rkey", F.floor(F.col("rplace") / CHUNK_WORDS).alias("chunk"), "doc", "key", cells).distinct(), "substring-meetings")


def spans(rows: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The candidate texts (doc, key, z), and the words [first, end) to remove of (doc, key)."""
    shared = anchors.shared_anchors(rows, word_runs(window), True, "substring-anchors")
    joined = anchors.pack_texts(rows).join(shared, ["doc", "key"]).dropDuplicates(["doc", "key"])
    candidates = written(joined.select("doc", "key", "z", "shared", "hot"), "substring-candidates")
    texts = candidates.select("doc", "key", "z")
    found = meetings(links(candidates, window))
    parts = F.ceil(F.col("cells") / PART_LINKS)
    blocks = written(found.groupBy("rdoc", "rkey", "chunk").agg(F.count("*").alias("cells")).select("rdoc", "rkey", "chunk", parts.alias("parts")), "substring-references")
    split = blocks.where("parts > 1")
    placed = found.join(split, ["rdoc", "rkey", "chunk"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc"), F.col("parts")), F.lit(0).cast("bigint")))
    lists = placed.groupBy("doc", "key").agg(F.collect_list(F.struct("rdoc", "rkey", "chunk", "part", "cell")).alias("cells"))
    references = texts.join(blocks.select(F.col("rdoc").alias("doc"), F.col("rkey").alias("key"), "chunk", "parts"), ["doc", "key"]).select("doc", "key", "chunk", "parts", "z").mapInArrow(_reference(window), _PIECE)
    stretches = texts.join(lists, ["doc", "key"]).select("doc", "key", "z", "cells").mapInArrow(_stretches(window), _PIECE)
    block = ["rdoc", "rkey", "chunk", "part"]
    dealt = references.unionByName(stretches).repartition(*block).sortWithinPartitions(*block, "kind")
    return texts, written(dealt.mapInArrow(_parsed(window), "doc bigint, key bigint, first bigint, end bigint"), "substring-spans")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text: its words' number, and the digest of its words joined by one space."""
    for batch in batches:
        for b in pieces(batch, "text"):
            words = [x.encode().split() for x in b.column(2).to_pylist()]
            digests = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(w) for w in words], pa.int64()), pa.array(digests, pa.string())], names=["doc", "key", "n_words", "sha"])


def removed(docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed (bigint), kept_sha256, kept (binary, the remaining words joined by one space; null
    where nothing was removed): a row for each row of docs."""
    small_batches(docs.sparkSession)
    source = F.coalesce(F.col(quoted(text)), F.lit(""))
    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc"), F.xxhash64(source).alias("key"), source.alias("text"))
    candidates, found = spans(rows.where("doc is not null"), window)
    lists = found.groupBy("doc", "key").agg(F.collect_list(F.struct(F.col("first").cast("int").alias("a"), F.col("end").cast("int").alias("b"))).alias("spans"))
    joined = candidates.join(lists, ["doc", "key"]).select("doc", "key", "z", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, "z", 1 << 19):
                n_removed, sha, kept = [], [], []
                for r, z in enumerate(b.column(2)):
                    words, own = anchors.unpacked(z.as_py()).split(), b.column(3)[r].values
                    gone = anchors.cut(own.field(0).to_numpy(), own.field(1).to_numpy(), len(words))
                    left = b" ".join(compress(words, (~gone).tolist()))
                    n_removed.append(int(gone.sum()))
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], names=["c_doc", "c_key", "n_removed", "c_sha", "kept"])

    changed = joined.mapInArrow(cut, "c_doc bigint, c_key bigint, n_removed bigint, c_sha string, kept binary")
    whole = rows.select("doc", "key", "text").mapInArrow(_whole, "doc bigint, key bigint, n_words bigint, sha string")
    out = whole.join(changed, (F.col("doc") == F.col("c_doc")) & (F.col("key") == F.col("c_key")), "left")
    return out.select(F.col("doc").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"), F.coalesce("c_sha", "sha").alias("kept_sha256"), "kept")
