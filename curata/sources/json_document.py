"""One JSON document of any size, read by many tasks.

A document is split at its commas, whatever they mean, by Spark's own text reader, so its blocks are dealt like those of any
text file. Whether a byte lies in a string, and how deep, depends on all that stands before it: the first pass works out
for each block how it changes that state (quotes by parity, brackets as what it closes and what it leaves open), a fold
over the blocks of a document gives the state at the start of each, and the second pass cuts out the parts at the top of the
document. Only parts that cross an edge of a block move. A part has to fit into a row; a document needn't.

Parts are the items of a list at the top; of an object at the top its keys, its values, and the items of values that are
lists. What is no JSON fails, as a strict reader would, wherever the fault is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.functions import json_text
from curata.operators.storage import fixed

#: Bits of a place within a block; the block's number stands before them.
PLACE_BITS = 40
#: Deeper nesting is refused, as readers refuse it.
DEEPEST = 10_000
#: Blocks of one call: their states, some hundred bytes each, go to every task.
MOST_BLOCKS = 1 << 20

_CHANGE = "doc bigint, file string, block bigint, ends0 int, pops0 int, opens0 string, ends1 int, pops1 int, opens1 string"
_START = "doc bigint, block bigint, number bigint, quoted int, depth int, stack string"
_PART = "doc bigint, at bigint, block bigint, top string, level int, opener string, closer string, began boolean, key string, key_at bigint, text string"

_COMMA = pa.scalar(b",", pa.large_binary())
_KIND = np.zeros(256, np.int8)
for _c, _d in zip(b"{[]},:", (1, 1, -1, -1, 2, 2), strict=True):
    _KIND[_c] = _d


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.option("lineSep", ",").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("doc"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes]]:
    """(first row without its value, bytes) of each stretch of one block within a batch: the pieces with their commas."""
    for b in batches:
        if not b.num_rows:
            continue
        doc, block = b.column("doc").to_numpy(), b.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero((doc[1:] != doc[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), b.num_rows]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            values = b.column("value").slice(a, z - a)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, z - a], pa.int32()), values.cast(pa.large_binary())), _COMMA)[0].as_py()
            yield {n: b.column(n)[a].as_py() for n in b.schema.names if n != "value"}, joined + b","


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    types = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def _quotes(d: np.ndarray) -> np.ndarray:
    """Places of quotes that begin or end a string: those after an odd number of backslashes don't. No piece begins in an
    escape, as none holds a comma."""
    quotes = np.flatnonzero(d == 34)
    slashes = np.flatnonzero(d == 92)
    if len(slashes) and len(quotes):
        first = np.append(True, np.diff(slashes) != 1)
        begins = slashes[first]
        sizes = np.diff(np.append(np.flatnonzero(first), len(slashes)))
        quotes = quotes[~np.isin(quotes, (begins + sizes)[sizes % 2 == 1])]
    return quotes


def _outside(d: np.ndarray, quotes: np.ndarray, quoted: int) -> np.ndarray:
    """Places of brackets, commas and colons that are in no string."""
    marks = np.flatnonzero(_KIND[d])
    return marks[(np.searchsorted(quotes, marks) + quoted) % 2 == 0]


def _compose(pops: int, opens: bytes, then_pops: int, then_opens: bytes) -> tuple[int, bytes]:
    taken = min(then_pops, len(opens))
    return pops + then_pops - taken, opens[: len(opens) - taken] + then_opens


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block and both states that it may start in: the state it ends in, how many brackets it closes that it
    didn't open, and those that it leaves open."""
    row: dict | None = None
    state: list[tuple[int, int, bytes]] = []

    def out() -> pa.RecordBatch:
        values = [row["doc"], row["file"], row["block"], *(x for ends, pops, opens in state for x in (ends, pops, opens.decode()))]
        return _batch(_CHANGE, [tuple(values)])

    for head, data in _runs(batches):
        if row is None or (row["doc"], row["block"]) != (head["doc"], head["block"]):
            if row:
                yield out()
            row, state = head, [(0, 0, b""), (1, 0, b"")]
        d = np.frombuffer(data, np.uint8)
        quotes = _quotes(d)
        after = []
        for quoted, pops, opens in state:
            marks = _outside(d, quotes, quoted)
            step = _KIND[d[marks]]
            marks, step = marks[step < 2], step[step < 2].astype(np.int64)
            depth = np.cumsum(step)
            lowest = int(min(0, depth.min(initial=0)))
            # open at the end: brackets whose level is never left again
            left = (step > 0) & (np.minimum.accumulate(depth[::-1])[::-1] >= depth) if len(depth) else np.zeros(0, bool)
            change = _compose(pops, opens, -lowest, d[marks[left]].tobytes())
            if len(change[1]) > DEEPEST:
                raise ValueError(f"brackets are nested over {DEEPEST} deep")
            after.append(((quoted + len(quotes)) % 2, *change))
        state = after
    if row:
        yield out()


def _starts(blocks: pd.DataFrame) -> pd.DataFrame:
    """Of one document's blocks: the state at the start of each."""
    quoted, opens, rows = 0, "", []
    blocks = blocks.sort_values("block")
    for number, b in enumerate(blocks.itertuples()):
        rows.append((b.doc, b.block, number, quoted, len(opens), opens[:2]))
        ends, pops, more = (b.ends1, b.pops1, b.opens1) if quoted else (b.ends0, b.pops0, b.opens0)
        if pops > len(opens):
            raise ValueError(f"{b.file} is no JSON: a bracket is closed that isn't open")
        quoted, opens = ends, opens[: len(opens) - pops] + more
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _START.split(", ")])


class _Block:
    """The parts of one block, as its bytes come in."""

    def __init__(self, head: dict) -> None:
        if head["number"] is None:
            raise ValueError("the blocks of the document are other ones than before: it, or the session's settings, have changed")
        self.doc, self.block, self.base = head["doc"], head["block"], head["number"] << PLACE_BITS
        self.quoted, self.depth, self.stack = head["quoted"], head["depth"], (head["stack"] + "  ")[:2]
        self.began, self.opener = head["number"] == 0, None
        self.waiting: list[bytes] = []
        self.seen = 0  # bytes before what comes next
        self.at = 0
        self.key: str | None = None
        self.key_at: int | None = None
        self.rows: list[tuple] = []

    @property
    def level(self) -> int:
        """Of the part that is open: outside of the document, in it, or in a list that an object at the top holds."""
        return min(self.depth, 2 if self.stack == "{[" else 1)

    def part(self, closer: str | None, text: bytes) -> None:
        said = (b"".join([*self.waiting, text]) if self.waiting else text).decode()
        if closer is not None and self.began and not said.strip() and (self.opener, closer) in ((None, "["), (None, "{"), ("]", ","), ("]", "}")):
            pass  # nothing between two parts
        else:
            self.rows.append((self.doc, self.base + self.at, self.block, self.stack[0] if self.depth else None, self.level, self.opener, closer, self.began, self.key, self.key_at, said))
        if closer == ":":
            self.key, self.key_at = (said, self.base + self.at) if self.began else (None, None)

    def feed(self, data: bytes) -> None:
        d = np.frombuffer(data, np.uint8)
        quotes = _quotes(d)
        marks = _outside(d, quotes, self.quoted)
        kinds = d[marks]
        step = np.where(np.abs(_KIND[kinds]) == 1, _KIND[kinds], 0).astype(np.int64)
        after = self.depth + np.cumsum(step)
        low = np.minimum(after, after - step)
        wanted = (low <= 1) | ((low == 2) & (kinds == 44))
        start = 0
        for pos, mark, depth in zip(marks[wanted].tolist(), kinds[wanted].tolist(), after[wanted].tolist(), strict=True):
            ch, before, end = chr(mark), depth - int(_KIND[mark] if abs(_KIND[mark]) == 1 else 0), False
            if before == 0:  # also a comma out of place
                end = True
            elif before == 1:
                end = depth == 0 or ch == "," or (self.stack[0] == "{" and ch in ":[")
            elif before == 2 and self.stack == "{[":
                end = depth == 1 or ch == ","
            if end:
                self.part(ch, data[start:pos])
                self.waiting, self.opener, self.began, start = [], ch, True, pos + 1
                self.at = self.seen + start
            if depth > before and depth <= 2:
                self.stack = (ch + " ") if depth == 1 else self.stack[0] + ch
            elif depth < before <= 2:
                self.stack = "  " if before == 1 else self.stack[0] + " "
            self.depth = depth
        if start < len(data):
            self.waiting.append(data[start:])
        self.seen += len(data)
        self.quoted = (self.quoted + len(quotes)) % 2
        self.depth = int(after[-1]) if len(after) else self.depth


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own: _Block | None = None
    for head, data in _runs(batches):
        if own is None or (own.doc, own.block) != (head["doc"], head["block"]):
            if own:
                own.part(None, b"")
                yield _batch(_PART, own.rows)
            own = _Block(head)
        own.feed(data)
        if own.rows:
            yield _batch(_PART, own.rows)
            own.rows = []
    if own:
        own.part(None, b"")  # goes on in the next block, or ends with the document
        yield _batch(_PART, own.rows)


def _role(brackets: Column) -> Column:
    """What a part is: item, key, value, list (where one begins), list_item, empty (an object), scalar (a document); null
    for nothing, "fault" for what JSON hasn't. The reader puts a comma after the last piece, too."""
    top, opener, closer = F.col("top"), F.col("opener"), F.col("closer")
    blank = F.rlike("text", F.lit(r"^[ \t\r\n]*\z"))
    fault, none = F.lit("fault"), F.lit(None).cast("string")
    in_list = lambda role: F.when(blank, F.when((opener == "[") & (closer == "]"), none).otherwise(fault)).when(closer.isin(",", "]"), role).otherwise(fault)
    in_object = (
        F.when(closer == ":", F.when(opener.isin("{", ",") & ~blank, "key").otherwise(fault))
        .when(closer == "[", F.when((opener == ":") & blank, "list").otherwise(fault))
        .when(~closer.isin(",", "}"), fault)
        .when(opener == ":", F.when(blank, fault).otherwise("value"))
        .when(blank & (opener == "]"), none)
        .when(blank & (opener == "{") & (closer == "}"), "empty")
        .otherwise(fault)
    )
    outside = (
        F.when(closer.isNull(), F.when(blank & (opener == ","), none).otherwise(fault))
        .when(closer.isin("[", "{"), F.when(blank & opener.isNull(), none).otherwise(fault))
        .when(closer != ",", fault)
        .when(opener.isNull(), F.when(brackets | blank, fault).otherwise("scalar"))
        .when(blank & opener.isin("]", "}"), none)
        .otherwise(fault)
    )
    return F.when(F.col("level") == 0, outside).when(closer.isNull(), fault).when(F.col("level") == 2, in_list("list_item")).when(top == "[", in_list("item")).otherwise(in_object)


def elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, ord (by place in the file), role (item, value, list, list_item, empty), key (as it reads), key_ord, text
    (canonical JSON) of the top parts of JSON documents. A list that an object at the top holds has a row of its own,
    without text, before its items; an empty object is one row. A scalar has no parts.

    Written to the shared folder, as it takes two passes over the same blocks."""
    pieces = _pieces(spark, path)
    changes = fixed(pieces.mapInArrow(_changes, _CHANGE))  # a row a block
    if changes.count() > MOST_BLOCKS:
        raise ValueError(f"over {MOST_BLOCKS} blocks: read the documents in several calls")
    starts = changes.groupBy("doc").applyInPandas(_starts, _START)
    docs = changes.groupBy("doc").agg(F.first("file").alias("file"))
    # broadcast for its bound, and because a shuffle would lose the order of the pieces
    placed = pieces.select("doc", "block", "value").join(F.broadcast(starts), ["doc", "block"], "left").select("doc", "block", "value", "number", "quoted", "depth", "stack")
    found = fixed(placed.mapInArrow(_parts, _PART))
    parts = found.where("began and closer is not null").unionByName(_across(found.where("not began or closer is null")))
    brackets = found.where("top is not null").select("doc").distinct().withColumn("brackets", F.lit(True))
    known = parts.join(F.broadcast(docs), "doc").join(F.broadcast(brackets), "doc", "left")
    known = known.withColumn("role", _role(F.coalesce("brackets", F.lit(False)))).where("role is not null")
    # a part whose key stands in an earlier block: a block's last key goes on in the next ones
    keys = known.where("role = 'key'").groupBy("doc", "block").agg(F.max("at").alias("key_at"), F.max_by("text", "at").alias("key"))
    before = Window.partitionBy("doc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = starts.select("doc", "block").join(keys, ["doc", "block"], "left").select("doc", "block", F.last("key", True).over(before).alias("_key"), F.last("key_at", True).over(before).alias("_key_at"))
    named = known.join(F.broadcast(earlier), ["doc", "block"], "left").withColumn("key", F.coalesce("key", "_key")).withColumn("key_at", F.coalesce("key_at", "_key_at"))
    read = named.withColumn("text", json_text.canonical(F.when(F.col("role") != "list", F.col("text")))).withColumn("key", json_text.canonical(F.when(F.col("role").isin("value", "list", "list_item"), F.col("key"))))
    bad = (F.col("role") == "fault") | (~F.col("role").isin("list", "empty") & F.col("text").isNull()) | ((F.col("role") == "key") & ~json_text.starts(F.col("text"), '"'))
    said = F.raise_error(F.concat("file", F.lit(" is no JSON near "), F.concat_ws("", "opener", F.substring(F.coalesce("text", F.lit("")), 1, 80), "closer")))
    name = F.from_json(F.concat(F.lit("["), "key", F.lit("]")), "array<string>")[0]
    checked = read.select("file", F.col("at").alias("ord"), F.when(bad, said).otherwise(F.col("role")).alias("role"), name.alias("key"), F.when(F.col("key").isNotNull(), F.col("key_at")).alias("key_ord"), F.when(F.col("role") != "empty", F.col("text")).alias("text"))
    return fixed(checked).where("role not in ('key', 'scalar')")


def _across(edges: DataFrame) -> DataFrame:
    """The parts that cross edges of blocks, of their pieces: a block's last part, and the first one of the next."""
    order = Window.partitionBy("doc").orderBy("at", F.col("began").cast("int"))
    groups = edges.withColumn("_group", F.sum(F.col("began").cast("bigint")).over(order))
    first, last = (lambda c: F.min_by(c, "at").alias(c)), (lambda c: F.max_by(c, "at").alias(c))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"])
    joined = groups.groupBy("doc", "_group").agg(F.min("at").alias("_at"), *map(first, ("block", "opener", "key", "key_at")), *map(last, ("top", "level", "closer")), F.array_join(texts, "").alias("text"))
    return joined.select("doc", F.col("_at").alias("at"), "block", "top", "level", "opener", "closer", F.lit(True).alias("began"), "key", "key_at", "text")
