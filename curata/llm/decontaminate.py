"""Benchmark decontamination: every training passage as a query to a BM25 index of the test items.

An item's passages are overlapping runs of words, twice as long as the item (128 words at least) and starting every
half length, so that its text lies whole in one passage. They are its own: what other items there are changes nothing.
Items are indexed by classes of length, powers of two. An index is searched with passages that hold every passage of
its items whole; what is found is judged on the item's own. The index holds, for each word, blocks of (item, impact)
with the block's largest impact; impacts are BM25's, divided by the item's score against itself, so one threshold
holds for all items. Block-max WAND finds every item at or over the threshold. Its bound is first taken for a whole
batch of passages at once: a passage in which the largest impacts of its words add up to the threshold for no block
of items has no such item, and is not searched.
What is found counts as a leak if the item's question and its answer (its last sentence, or its last third where
there is only one) each have least_overlap of their distinct words in a passage that scores the threshold.

Words are runs of letters and digits with A-Z lower-cased. Items without words match nothing; a null or empty text has no
words. Repeated items are items of their own, and so are items with a null item_id; of passages that score the same, the
one with the larger overlaps counts. Rows of one doc_id (null is one too) are one document. An empty table, of documents
or items, gives no rows; further columns are not read. Texts of any length are judged whole, some passages at a time.

The index goes to executors in blocks of at most BLOCK_BYTES of item text, all its classes in one pass over the documents,
with statistics over all items; so any number of items works. Where there are several blocks, each block's finds are
written and its broadcast is released before the next.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import IS_PUNCTUATION, lower_ascii, pieces, quoted, small_batches, span_hashes, text_buffer, words_of, written

K1, B = 1.2, 0.75
#: Neighbouring items of a block, and bytes of item text of one index that is sent to the executors.
BLOCK, BLOCK_BYTES = 4, 4 << 20
#: Passages times blocks of items whose bounds are worked out at once.
BOUNDS = 1 << 21
#: Least half length of a passage.
HALF = 64
_ENDS = tuple(b".!?\n")


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = lower_ascii(data)
    start, end, at = words_of(data, offsets, IS_PUNCTUATION)
    return span_hashes(data, start, end), at, start, end


def answer_place(text: str, n_words: int, ends: np.ndarray) -> int:
    """The word at which the answer starts: after the last sentence end that has words on both sides."""
    raw = text.encode()
    for cut in range(n_words - 1, 0, -1):
        between = raw[int(ends[cut - 1]) : int(ends[cut])]
        if any(b in _ENDS for b in between):
            return cut
    return n_words - max(1, n_words // 3) if n_words > 1 else 0


def length_class(n_words: int) -> int:
    """The half length of the passages that items of so many words are searched with."""
    return max(HALF, 1 << max(0, n_words - 1).bit_length())


class Index:
    """Blocks of impacts by word, for some of the items; df, count and mean length are of all items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[int, int], count: int, mean: float) -> None:
        self.ids: list[int] = []
        self.question: list[np.ndarray] = []
        self.answer: list[np.ndarray] = []
        self.halves: list[int] = []
        self.own: list[dict[int, float]] = []
        lists: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for item, text in sorted(items, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
            raw = np.frombuffer(text.encode(), np.uint8)
            h, _, _, end = hashed_words(raw, np.array([0, len(raw)]))
            if len(h) == 0:
                continue
            self.halves.append(max(HALF, len(h)))
            cut = answer_place(text, len(h), end)
            number = len(self.ids)
            self.ids.append(item)
            self.question.append(np.unique(h[:cut]))
            self.answer.append(np.unique(h[cut:]))
            words, tf = np.unique(h, return_counts=True)
            norm = K1 * (1 - B + B * len(h) / mean)
            impact = [math.log(1 + (count - df[w] + 0.5) / (df[w] + 0.5)) * f * (K1 + 1) / (f + norm) for w, f in zip(words.tolist(), tf.tolist(), strict=True)]
            total = sum(impact)
            self.own.append({w: x / total for w, x in zip(words.tolist(), impact, strict=True)})
            for w, x in self.own[-1].items():
                lists[w].append((number, x))
        self.words = np.array(sorted(lists), np.uint64)
        self.items = [[i for i, _ in lists[w]] for w in self.words.tolist()]
        self.impacts = [[x for _, x in lists[w]] for w in self.words.tolist()]
        # a block is a range of BLOCK item numbers, the same for all words
        self.block_max: list[dict[int, float]] = []
        for items, impacts in zip(self.items, self.impacts, strict=True):
            most: dict[int, float] = {}
            for i, x in zip(items, impacts, strict=True):
                most[i // BLOCK] = max(most.get(i // BLOCK, 0.0), x)
            self.block_max.append(most)
        self.word_max = [max(x) for x in self.impacts]
        self.first_block = np.cumsum([0, *map(len, self.block_max)])
        self.blocks = np.array([b for most in self.block_max for b in most], np.int64)
        self.maxima = np.array([x for most in self.block_max for x in most.values()])
        self.n_blocks = len(self.ids) // BLOCK + 1
        self.half = length_class(max(self.halves, default=0))
        # a passage holds each own passage that starts in its first half
        self.n_halves = 2 if all(x == self.half for x in self.halves) else 3

    def number(self, h: np.ndarray) -> np.ndarray:
        """The place in `words` of each hash, -1 where there is none."""
        if len(self.words) == 0:
            return np.full(len(h), -1)
        i = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[i] == h, i, -1)

    def search(self, words: list[int], threshold: float) -> dict[int, float]:
        """Score of every item that reaches the threshold for a query of distinct words: block-max WAND."""
        threshold -= 1e-9
        out: dict[int, float] = {}
        at = {w: 0 for w in words}
        now = sorted((self.items[w][0], w) for w in words)
        while now:
            bound, pivot = 0.0, -1
            for k, (_, w) in enumerate(now):
                bound += self.word_max[w]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = now[pivot][0]
            while pivot + 1 < len(now) and now[pivot + 1][0] == item:
                pivot += 1
            # what the lists can add in the pivot's block, and where the next block starts
            block = item // BLOCK
            shallow = sum(self.block_max[w].get(block, 0.0) for _, w in now[: pivot + 1])
            if shallow >= threshold:
                if now[0][0] == item:
                    score = sum(self.impacts[w][at[w]] for _, w in now[: pivot + 1])
                    if score >= threshold:
                        out[item] = score
                    target = item + 1
                else:
                    target = item
            else:
                target = (block + 1) * BLOCK
                if pivot + 1 < len(now):
                    target = min(target, max(now[pivot + 1][0], item + 1))
            moved = []
            for current, w in now[: pivot + 1]:
                if current < target:
                    at[w] = bisect_left(self.items[w], target, at[w])
                    if at[w] < len(self.items[w]):
                        moved.append((self.items[w][at[w]], w))
                else:
                    moved.append((current, w))
            now = sorted(moved + now[pivot + 1 :])
        return out

    def judge(self, i: int, h: np.ndarray, start: int, end: int, threshold: float, least_overlap: float) -> tuple[float, float, float] | None:
        """Score, question and answer overlap of item i's best own passage that starts in [start, end) of a text's words."""
        half, best = self.halves[i], None
        for a in range(-(-start // half) * half, min(end, len(h)), half):
            here = np.unique(h[a : a + 2 * half])
            score = sum(x for w, x in self.own[i].items() if here[min(np.searchsorted(here, np.uint64(w)), len(here) - 1)] == w)
            if score < threshold - 1e-9:
                continue
            question, answer = (float(np.isin(x, here).mean()) if len(x) else 1.0 for x in (self.question[i], self.answer[i]))
            if question >= least_overlap and answer >= least_overlap:
                best = max(best or (0.0, 0.0, 0.0), (score, question, answer))
        return best

    def bounds(self, passage: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The largest sum over blocks of items of the words' largest impacts there, for each passage (sorted)."""
        number = np.cumsum(np.concatenate([[0], passage[1:] != passage[:-1]]))
        many = self.first_block[word + 1] - self.first_block[word]
        place = np.repeat(self.first_block[word] - np.cumsum(many) + many, many) + np.arange(many.sum())
        n = int(number[-1]) + 1
        return np.bincount(np.repeat(number, many) * self.n_blocks + self.blocks[place], self.maxima[place], n * self.n_blocks).reshape(n, self.n_blocks).max(axis=1)

    def leaks(self, h: np.ndarray, at: np.ndarray, threshold: float, least_overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) for the best own passage of each text and item."""
        half = self.half
        numbers = self.number(h)
        known = np.flatnonzero(numbers >= 0)
        if len(known) == 0:
            return
        row = np.searchsorted(at, known, side="right") - 1
        local = (known - at[row]) // half
        # word i lies in the passages that start at half-lengths i // half and one or two before
        stride = int(local.max()) + 2
        first = row * stride + local
        both = np.concatenate([first[local >= k] - k for k in range(self.n_halves)])
        key = np.unique(both * len(self.words) + np.concatenate([numbers[known][local >= k] for k in range(self.n_halves)]))
        passage, word = key // len(self.words), key % len(self.words)
        starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        ends = np.append(starts[1:], len(passage))
        step = max(1, BOUNDS // self.n_blocks)
        bound = np.concatenate([self.bounds(passage[starts[k] : ends[min(k + step, len(ends)) - 1]], word[starts[k] : ends[min(k + step, len(ends)) - 1]]) for k in range(0, len(starts), step)])
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for k in np.flatnonzero(bound >= threshold - 1e-9).tolist():
            found = self.search(word[starts[k] : ends[k]].tolist(), threshold)
            if not found:
                continue
            r, p = divmod(int(passage[starts[k]]), stride)
            text = h[at[r] : at[r + 1]]
            for i in found:
                values = self.judge(i, text, p * half, (p + 1) * half, threshold, least_overlap)
                if values:
                    best[r, i] = max(best.get((r, i), values), values)
        for (r, i), values in sorted(best.items()):
            yield r, self.ids[i], *values


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each item, and on the item's first word its length."""
    for b in batches:
        h, at, _, _ = hashed_words(*text_buffer(b.column(0)))
        for r in range(b.num_rows):
            own = np.unique(h[at[r] : at[r + 1]]).view(np.int64)
            sizes = np.zeros(len(own), np.int64)
            sizes[:1] = at[r + 1] - at[r]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sizes)], names=["h", "n"])


def index_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[Index]]:
    """Indexes that together hold all items, in blocks of at most block_bytes of text (or one item), one for each class of length."""
    rows = items.select(F.col(quoted(item_id)).cast("bigint").alias("id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    words = rows.select("text").mapInArrow(_item_words, "h bigint, n bigint")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("n") > 0, 1)), F.lit(0)).alias("items")).first()
    if not total["items"]:
        return
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    n_blocks = max(1, math.ceil(1.5 * size / block_bytes))
    df = words.groupBy("h").count()
    for k in range(n_blocks):
        own = rows if n_blocks == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k)
        held = own.collect()  # block_bytes or so
        own_words = own.select("text").mapInArrow(_item_words, "h bigint, n bigint").select("h").distinct()
        counts = {r["h"] & ((1 << 64) - 1): r["count"] for r in df.join(own_words, "h").collect()}
        by_class: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for r in held:
            raw = np.frombuffer(r["text"].encode(), np.uint8)
            by_class[length_class(len(hashed_words(raw, np.array([0, len(raw)]))[0]))].append((r["id"], r["text"]))
        yield [Index(by_class[c], counts, total["items"], total["n"] / total["items"]) for c in sorted(by_class)]


def indexes(items: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Index]:
    """The indexes of all blocks."""
    for block in index_blocks(items, item_id, text, block_bytes):
        yield from block


def leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.6, least_overlap: float = 0.8, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id (bigint), score, question_overlap, answer_overlap (double): a row for each document and item of
    which it holds question and answer, for the passage that scores best. A doc_id that repeats counts once."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    schema = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"
    parts: list[DataFrame] = []
    blocks = index_blocks(items, item_id, item_text)
    block = next(blocks, None)
    while block is not None:
        after = next(blocks, None)
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in pieces(batch, "text"):
                    h, at, _, _ = hashed_words(*text_buffer(b.column(1)))
                    found = [x for index in held.value for x in index.leaks(h, at, threshold, least_overlap)]
                    if found:
                        r, *values = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(r)), *(pa.array(x, k) for x, k in zip(values, kinds, strict=True))], names=names)

        parts.append(source.mapInArrow(run, schema))
        if after is not None or len(parts) > 1:
            parts[-1] = written(parts[-1], "leaks")
            held.unpersist()
        block = after
    if not parts:
        return spark.createDataFrame([], schema)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
