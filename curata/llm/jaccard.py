"""N-gram Jaccard join: sets in a prefix tree, classes of linked documents.

Documents link if 100 * intersection >= percent * union of their sets of distinct n-word shingles. Exactly equal sets
are one class from the start. The rest is candidate search, a join within candidate groups, and components:

1. A sketch of fixed size counts all shingles; rarest first, it gives one global order. Two sets that link share one of
   their first p = n - ceil(percent * n) + 1 shingles in any common order, and k + 1 of their first p + k. With k an
   eighth of n (four at least), a document that shares too few of its own first p + k with any others has no link.
2. What is left of a document's p + k shingles is dealt into k rounded down to a power of two parts by hash, so two of
   the k + 1 that a linked pair shares are in one part (for all k that a pair can have). Documents that share a pair of
   shingles of one part, directly or in a chain, form a candidate group; links never cross groups.
3. Within a group, sets go into a tree, commonest shingle first, one after the other; each first traverses the tree with
   its overlap so far, shared by all sets below a node. A subtree is left if what remains of the query and of the
   longest set below can't reach the overlap that the smallest set below needs, or if all sets below are linked with
   the query already.
4. A group over GROUP_DOCS is dealt over blocks that share a few documents. What the blocks' links leave in different
   components while sharing a pair of shingles meets again, in pairs of blocks. Where that is over PAIR_BLOCKS blocks,
   it meets by cells instead: by each such pair of shingles and by size, as linked sets are in the same or in neighbouring
   classes of size (powers of 100 / percent). So no link is lost, a group of near copies, which the shared documents hold
   together, is not compared pair by pair, and the number of times that a text is sent doesn't grow with its group.

Words are runs of characters other than ASCII white space, A-Z lower-cased. A document of fewer words than n has its
whole word sequence as its one shingle; without words, or null, it has none and links with nothing. Rows of one doc_id
are one document with the links of each row. Rows without doc_id are not linked. An empty table gives no rows; further
columns are not read. A text of any length is one set, in the memory of one task. Sets are of 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.anchors import SAMPLE, repeated_keys
from curata.llm.common import lower_ascii, mixed, pieces, quoted, small_batches, span_hashes, text_buffer, words_of, written
from curata.llm.components import Union, components

SKETCH_BITS = 18
SLICES = 16
#: Documents of a candidate group that one task joins, and how many of a larger group all of its blocks share.
GROUP_DOCS, SHARED_DOCS = 1000, 8
#: Blocks of a group that are compared in all pairs; in a larger group only documents of one cell meet.
PAIR_BLOCKS = 64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = lower_ascii(data)
    start, end, at = words_of(data, offsets)
    words = span_hashes(data, start, end)
    counts = np.diff(at)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    h = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = mixed(h + padded[k : k + len(words)])
    out = []
    for a, c in zip(at[:-1].tolist(), counts.tolist(), strict=True):
        if c >= n:
            out.append(np.unique(h[a : a + c - n + 1]))
        elif c:
            whole = np.uint64(c)
            with np.errstate(over="ignore"):
                for w in words[a : a + c]:
                    whole = mixed(np.array([whole ^ w]))[0]
            out.append(np.array([whole]))
        else:
            out.append(words[:0])
    return out


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, sketch = np.uint64((1 << SKETCH_BITS) - 1), np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc", "n", "s1", "s2", "slice", "counts"]
        for batch in batches:
            for b in pieces(batch, "text"):
                sets = shingle_sets(*text_buffer(b.column(1)), n)
                with np.errstate(over="ignore"):
                    s1 = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
                    s2 = np.array([np.bitwise_xor.reduce(mixed(x)) if len(x) else 0 for x in sets], np.uint64).view(np.int64)
                for x in sets:
                    sketch += np.bincount((x & mask).astype(np.int64), minlength=len(sketch)) if len(x) > 50_000 else 0
                rest = [x for x in sets if len(x) <= 50_000]
                if rest:
                    sketch += np.bincount((np.concatenate(rest) & mask).astype(np.int64), minlength=len(sketch))
                sizes = np.array([len(x) for x in sets], np.int64)
                none = pa.nulls(b.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(s1), pa.array(s2), none, pa.nulls(b.num_rows, pa.binary())], names=names)
        part = len(sketch) // SLICES
        if sketch.any():
            null = pa.nulls(SLICES, pa.int64())
            counts = [sketch[i * part : (i + 1) * part].astype("<u4").tobytes() for i in range(SLICES)]
            yield pa.RecordBatch.from_arrays([null, null, null, null, pa.array(range(SLICES), pa.int32()), pa.array(counts, pa.binary())], names=names)

    return run


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x = np.frombuffer(counts, "<u4").astype(np.int64)
            sums[k] = sums[k] + x if k in sums else x
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(x, (1 << 32) - 1).astype("<u4").tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])


def extra(n: int) -> int:
    """How many shingles more than the prefix filter needs are taken of n; it never falls as n grows."""
    return max(4, n // 8)


def prefix_size(n: int, percent: int) -> int:
    """How many of the first of n ordered shingles are taken."""
    return min(n, n - -(-percent * n // 100) + 1 + extra(n))


def pair_keys(docs: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of each pair of a document's tokens that are in one part; docs is sorted.

    The smaller set of a linked pair decides the number of parts; it has percent of the size at least.
    """

    def power(n: np.ndarray) -> np.ndarray:
        """A power of two below what two sets share at least, of which the smaller has n shingles."""
        shared = np.minimum(np.maximum(4, n // 8) + 1, -(-percent * n // 100))  # as in extra() and least_shared()
        return 1 << np.floor(np.log2(np.maximum(1, shared - 1))).astype(np.int64)

    most, least = power(sizes), power(-(-percent * sizes // 100))
    out_docs, out_keys = [], []
    parts = least
    while True:
        part = (mixed(tokens) >> np.uint64(40)).astype(np.int64) & (parts - 1)
        order = np.lexsort((tokens, part, docs))
        d, p, t, q = docs[order], part[order], tokens[order], parts[order].astype(np.uint64)
        shift = 1
        while shift < len(d):
            same = np.flatnonzero((d[shift:] == d[:-shift]) & (p[shift:] == p[:-shift]))
            if len(same) == 0:
                break
            with np.errstate(over="ignore"):
                out_keys.append(mixed(mixed(t[same] + q[same]) + t[same + shift]))
            out_docs.append(d[same])
            shift += 1
        more = parts < most
        if not more.any():
            break
        docs, tokens, parts, most = docs[more], tokens[more], 2 * parts[more], most[more]
    none = np.zeros(0, np.uint64)
    return np.concatenate(out_docs or [docs[:0]]), np.concatenate(out_keys or [none])


def least_shared(n: int, percent: int) -> int:
    """How many of them a linked set shares at least: a linked set has percent of n shingles or more."""
    return min(extra(-(-percent * n // 100)) + 1, -(-percent * n // 100))


# ---------------------------------------------------------------- the tree


class _Node:
    __slots__ = ("below", "docs", "last", "least", "longest", "mask", "one", "rep", "tokens")

    def __init__(self, tokens: list[int], rep: int) -> None:
        self.tokens, self.mask, self.last = tokens, sum(1 << t for t in tokens), tokens[-1] if tokens else -1
        self.below: dict[int, _Node] = {}
        self.docs: list[int] = []
        self.rep, self.one = rep, True  # a document below, and whether all below were in its component
        self.least, self.longest = 1 << 60, 0  # smallest whole size, and most tokens of a set below


class Tree:
    """Sets of ints in a path-compressed prefix tree. A set's size may exceed its tokens: the rest is in no other set."""

    def __init__(self, sizes: list[int], percent: int, union: Union) -> None:
        self.sizes, self.percent, self.union, self.root = sizes, percent, union, _Node([], -1)

    def need(self, a: int, b: int) -> int:
        p = self.percent
        return -(-p * (a + b) // (100 + p))

    def link(self, doc: int, tokens: list[int]) -> None:
        """Joins doc with the component of every set that it links with."""
        size, union, sizes, find = self.sizes[doc], self.union, self.sizes, self.union.find
        mask, lowest = sum(1 << t for t in tokens), -(-self.percent * size // 100)
        own = find(doc)
        stack = [(x, 0, 0) for x in self.root.below.values()]
        if self.root.docs and not tokens:
            return
        while stack:
            node, overlap, depth = stack.pop()
            if node.one and find(node.rep) == own:
                continue
            overlap += (node.mask & mask).bit_count()
            depth += len(node.tokens)
            left = min(len(tokens) - bisect_right(tokens, node.last), node.longest - depth)
            if overlap + left < self.need(size, max(node.least, lowest)):
                continue
            for other in node.docs:
                if overlap >= self.need(size, sizes[other]) and find(other) != own:
                    own = union.join(other, own)
            stack += [(x, overlap, depth) for x in node.below.values()]

    def insert(self, doc: int, tokens: list[int]) -> None:
        node, at, size, own = self.root, 0, self.sizes[doc], self.union.find(doc)
        while True:
            if node is not self.root:
                node.least, node.longest = min(node.least, size), max(node.longest, len(tokens))
                node.one = node.one and self.union.find(node.rep) == own
            if at == len(tokens):
                node.docs.append(doc)
                return
            below = node.below.get(tokens[at])
            if below is None:
                below = node.below[tokens[at]] = _Node(tokens[at:], doc)
                below.least, below.longest = size, len(tokens)
                below.docs.append(doc)
                return
            edge, k = below.tokens, 1
            while k < len(edge) and at + k < len(tokens) and edge[k] == tokens[at + k]:
                k += 1
            if k < len(edge):
                upper = _Node(edge[:k], below.rep)
                upper.one, upper.least, upper.longest = below.one, below.least, below.longest
                below.tokens = edge[k:]
                below.mask ^= upper.mask
                upper.below[edge[k]] = below
                node.below[tokens[at]] = upper
                below = upper
            node, at = below, at + k


def link_sets(sets: list[np.ndarray], percent: int, labels: list[int] | None = None) -> list[int]:
    """The component of each set: the smallest index that it is linked with through links (or equal labels)."""
    union = Union(len(sets))
    first: dict[int, int] = {}
    for i, label in enumerate(labels or []):
        union.join(i, first.setdefault(label, i))
    filled = [x for x in sets if len(x)]
    if len(filled) > 1:
        tokens, where, counts = np.unique(np.concatenate(filled), return_inverse=True, return_counts=True)
        rank = np.empty(len(tokens), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(tokens))
        shared = counts[where] > 1
        numbers, at = rank[where], 0
        tree = Tree([len(x) for x in sets], percent, union)
        for i, x in enumerate(sets):
            if len(x) == 0:
                continue
            own = np.sort(numbers[at : at + len(x)][shared[at : at + len(x)]]).tolist()
            at += len(x)
            if own:
                tree.link(i, own)
                tree.insert(i, own)
    return [union.find(i) for i in range(len(sets))]


def _join_blocks(n: int, percent: int):
    """Over rows sorted by block: a row (a, b) for each document that is linked with a smaller one of its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, labels, sets = None, [], [], []

        def links() -> Iterator[pa.RecordBatch]:
            order = np.argsort(docs)
            ids = [docs[i] for i in order]
            of = link_sets([sets[i] for i in order], percent, [labels[i] for i in order])
            pairs = [(ids[i], ids[r]) for i, r in enumerate(of) if r != i]
            if pairs:
                a, b = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for b in pieces(batch, "text"):
                found = shingle_sets(*text_buffer(b.column(3)), n)
                for block, doc, label, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), found, strict=True):
                    if block != key:
                        if len(docs) > 1:
                            yield from links()
                        key, docs, labels, sets = block, [], [], []
                    docs.append(doc)
                    labels.append(label)
                    sets.append(own)
        if len(docs) > 1:
            yield from links()

    return run


def classes(docs: DataFrame, percent: int = 85, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (bigint): a row for each row of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    made = written(rows.mapInArrow(_signatures(shingle), "doc bigint, n bigint, s1 bigint, s2 bigint, slice int, counts binary"), "jaccard-signatures")
    signed = made.where("slice is null").select("doc", "n", "s1", "s2")
    # a table of fixed size: 4 bytes for each of 2 ** SKETCH_BITS counts
    slices = {r["slice"]: r["counts"] for r in made.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(_add_slices, "slice int, counts binary").collect()}
    result = signed.select("doc", "n", "s1", "s2")
    if not slices:
        return result.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("doc").alias("component_id"))
    sketch = spark.sparkContext.broadcast(np.frombuffer(b"".join(slices[k] for k in range(SLICES)), "<u4"))
    equal = written(signed.where("n > 0 and doc is not null").groupBy("s1", "s2", "n").agg(F.min("doc").alias("doc")), "jaccard-classes")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, mask = sketch.value, np.uint64((1 << SKETCH_BITS) - 1)
        for batch in batches:
            for b in pieces(batch, "text"):
                lists, needs, sizes = [], [], []
                for x in shingle_sets(*text_buffer(b.column(1)), shingle):
                    order = np.lexsort((x, counts[(x & mask).astype(np.int64)]))
                    lists.append(x[order[: prefix_size(len(x), percent)]].view(np.int64) if len(x) else np.zeros(0, np.int64))
                    needs.append(least_shared(len(x), percent))
                    sizes.append(len(x))
                offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(needs, pa.int32()), pa.array(sizes, pa.int32()), tokens], names=["doc", "need", "size", "tokens"])

    firsts = rows.where("doc is not null").mapInArrow(prefixes, "doc bigint, need int, size int, tokens array<bigint>")
    firsts = written(firsts.join(equal.select("doc"), "doc", "left_semi").distinct(), "jaccard-prefixes")
    keys = lambda df: df.select(F.explode("tokens").alias("h"), "doc", F.lit(0).cast("bigint").alias("key"))
    meets = repeated_keys(keys(firsts), keys(firsts.sample(SAMPLE, 1)), True, "jaccard-shared").select("h", "doc")
    needs = firsts.groupBy("doc").agg(F.min("need").alias("need"))
    for k in range(2):  # who shares too little goes, and with it what it alone shared with others
        enough = meets.groupBy("doc").agg(F.count("*").alias("n")).join(needs, "doc").where("n >= need").select("doc")
        left = meets.select("h", "doc").join(enough, "doc", "left_semi")
        shared = left.groupBy("h").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("h")
        meets = written(left.join(shared, "h", "left_semi").select("h", "doc"), f"jaccard-candidates-{k}")

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            counts = np.diff(lists.offsets.to_numpy())
            docs, keys = pair_keys(np.repeat(np.arange(b.num_rows), counts), lists.flatten().to_numpy().view(np.uint64), np.repeat(b.column(2).to_numpy().astype(np.int64), counts), percent)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(docs)), pa.array(keys.view(np.int64))], names=["doc", "token"])

    left = meets.groupBy("doc").agg(F.collect_list("h").alias("hs")).join(firsts.select("doc", "size").distinct(), "doc")
    keys = left.select("doc", "hs", "size").mapInArrow(paired, "doc bigint, token bigint").distinct()
    both = written(keys, "jaccard-pairs")
    shared = both.groupBy("token").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("token", "least")
    meets = written(both.join(shared, "token").select("token", "doc", "least"), "jaccard-meets")
    groups = components(meets.select(F.col("doc").alias("a"), F.col("least").alias("b")), "jaccard-groups")
    members = groups.select(F.col("node").alias("doc"), F.col("component").alias("grp"))
    members = members.unionByName(members.select(F.col("grp").alias("doc"), "grp").distinct())
    sizes = members.groupBy("grp").agg(F.count("*").alias("size"))
    placed = written(members.join(sizes, "grp").select("doc", "grp", "size"), "jaccard-members")

    spread = F.pmod(F.xxhash64("doc"), F.ceil(F.col("size") / GROUP_DOCS))
    is_shared = F.pmod(F.xxhash64("doc", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("size") / SHARED_DOCS))) == 0
    n_blocks = F.ceil(F.col("size") / GROUP_DOCS)
    blocks = F.when(n_blocks == 1, F.array(F.lit(0).cast("bigint"))).when(is_shared, F.sequence(F.lit(0).cast("bigint"), n_blocks - 1)).otherwise(F.array(spread))
    links = _linked(rows, placed.select("doc", F.lit(None).cast("bigint").alias("label"), F.explode(blocks).alias("block"), "grp").select("doc", F.coalesce("label", "doc").alias("label"), F.xxhash64("grp", "block").alias("block")), shingle, percent)
    big = placed.where(F.col("size") > GROUP_DOCS)
    if not big.isEmpty():
        now = components(links, "jaccard-links")
        labelled = big.select("doc", "grp").join(now, F.col("doc") == F.col("node"), "left").select("doc", "grp", F.coalesce("component", "doc").alias("label"))
        # pairs of shingles that still lead from one component to another
        labels = meets.select("token", "doc").join(labelled, "doc").groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("m"))
        unsettled = written(meets.select("token", "doc").join(labels.where("l <> m").select("token"), "token", "left_semi"), "jaccard-unsettled")
        docs_left = written(unsettled.select("doc").distinct().join(labelled, "doc"), "jaccard-unsettled-docs")
        counts = written(docs_left.groupBy("grp").agg(F.count("*").alias("size")), "jaccard-unsettled-sizes")
        few = F.col("size") <= GROUP_DOCS * PAIR_BLOCKS
        again = [_pairs(docs_left.join(counts.where(few), "grp"), F.col("grp"))]
        if not (many := counts.where(~few)).isEmpty():
            size_class = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9) if percent < 100 else F.col("size")
            sized = firsts.select("doc", size_class.cast("bigint").alias("c")).distinct()
            cells = unsettled.join(docs_left.join(many.select("grp"), "grp", "left_semi"), "doc").join(sized, "doc").select("token", "doc", "label", F.explode(F.array(F.col("c"), F.col("c") + 1)).alias("cell"))
            apart = cells.groupBy("token", "cell").agg(F.count("*").alias("size"), F.min("label").alias("l"), F.max("label").alias("m")).where("l <> m").select("token", "cell", "size")
            again.append(_pairs(cells.join(apart, ["token", "cell"]), F.xxhash64("token", "cell")))
        links = reduce(DataFrame.unionByName, [links, *(_linked(rows, x, shingle, percent) for x in again)])
    # a document of several texts holds the classes of each together
    several = signed.where("n > 0 and doc is not null").groupBy("doc").agg(F.min(F.struct("s1", "s2", "n")).alias("a"), F.max(F.struct("s1", "s2", "n")).alias("b")).where("a <> b").select("doc")
    both = signed.where("n > 0").join(several, "doc", "left_semi").join(equal.withColumnRenamed("doc", "b"), ["s1", "s2", "n"]).select(F.col("doc").alias("a"), "b")
    links = links.unionByName(both.where("a <> b").distinct())
    found = components(links, "jaccard-components")
    named = equal.join(found, F.col("doc") == F.col("node"), "left").select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.col("n").alias("tn"), F.coalesce("component", "doc").alias("component"))
    joined = result.join(named, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")) & (F.col("n") == F.col("tn")) & F.col("doc").isNotNull(), "left")
    return joined.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def _pairs(docs: DataFrame, group: Column) -> DataFrame:
    """doc, label, block of docs (doc, label, size of the group): a group is cut into blocks, each pair of which is a block."""
    last = F.ceil(F.col("size") / GROUP_DOCS) - 1
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda k: F.xxhash64("group", F.lit("pair"), F.least(k, F.col("own")), F.greatest(k, F.col("own"))))
    placed = docs.select("doc", "label", group.alias("group"), "size").withColumn("own", F.pmod(F.xxhash64("doc", F.lit(2)), last + 1))
    return placed.select("doc", "label", F.explode(pairs).alias("block")).distinct()


def _linked(rows: DataFrame, dealt: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) within each block of dealt (doc, label, block)."""
    texts = rows.join(dealt, "doc").select("block", "doc", "label", "text")
    ordered = texts.repartition("block").sortWithinPartitions("block")
    return written(ordered.mapInArrow(_join_blocks(shingle, percent), "a bigint, b bigint"), "jaccard-block-links")
