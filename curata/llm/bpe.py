"""BPE encoding and decoding by depth-first traversal of a trie of distinct words.

The words of a batch go into a trie of their UTF-8 bytes. Walking it depth first, each node takes the last token
of the encoding of its prefix: the one token that ends there and follows the last token of the shorter prefix
cleanly (no merge would have crossed the seam). A shared prefix is encoded once, and a word's ids are read back
along the last tokens.

Results equal those of the `tokenizers` library for byte-level BPE files without normaliser: added special tokens
are cut out of the text first, as the library does. A null text is empty and has no tokens. Ties, repeated rows and
extra columns have no effect on a row's result; texts of any length are encoded whole. A column with the name of a
result, in any case of letters, is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from curata.llm.common import mapped, others, pieces, quoted, small_batches

#: Fixed: how byte-level BPE splits a text into words before merging; white space is Unicode's White_Space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Entries that a worker keeps, of words it has encoded and of seams it has judged; beyond them it starts anew. About
#: 250 bytes each.
CACHE_WORDS, CACHE_SEAMS = 400_000, 300_000
#: Characters of the longest word that goes into the trie; a longer one shares nothing worth a node for each of its bytes.
TRIE_LENGTH = 1024


def _latin_words() -> re.Pattern:
    """WORDS for texts of code points under 256, where the plain `re` module can list each class: twice as fast."""
    letters, numbers = ("".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == k) for k in "LN")
    space = "\t-\r \x85\xa0"
    return re.compile(rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if visible Latin-1, else from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in visible}
    out |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(visible))}
    return out


_LOADED: dict[str, Bpe] = {}


class Bpe:
    """A byte-level BPE vocabulary. Inside, a token is its rank: a byte, or 256 plus the place of its merge."""

    def __init__(self, spec: dict) -> None:
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        to_bytes = lambda s: bytes(letters[c] for c in s)
        self.text: list[bytes] = [bytes([b]) for b in range(256)]
        self.halves: list[tuple[int, int]] = [(b, b) for b in range(256)]
        rank_of = {t: i for i, t in enumerate(self.text)}
        self.merged: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            a, b = rank_of[to_bytes(a)], rank_of[to_bytes(b)]
            rank = len(self.text)
            self.merged[a, b] = rank
            self.text.append(self.text[a] + self.text[b])
            self.halves.append((a, b))
            rank_of.setdefault(self.text[-1], rank)
        by_bytes = {to_bytes(s): i for s, i in vocab.items() if all(c in letters for c in s)}
        self.ids = [by_bytes.get(t, 0) for t in self.text]
        self.id_bytes = [int(i).to_bytes(4, "little") for i in self.ids]
        self.id_text = {i: t for t, i in by_bytes.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.id_text |= {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.words, self.latin = regex.compile(WORDS), _latin_words()
        self.backwards: dict = {}  # trie of reversed tokens; key -1: rank of the token that is complete here
        for rank, t in enumerate(self.text):
            node = self.backwards
            for b in reversed(t):
                node = node.setdefault(b, {})
            node.setdefault(-1, rank)
        self.seams: dict[tuple[int, int], bool] = {}
        self.known: dict[str | int, bytes] = {}  # ids of words so far

    @classmethod
    def load(cls, path: str) -> Bpe:
        """Of a file that every node has; a worker reads it once."""
        if path not in _LOADED:
            with open(path, encoding="utf-8") as f:
                _LOADED[path] = cls(json.load(f))
        return _LOADED[path]

    def clean_seam(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens ends in just these two: undo the later merge of the two sides
        again and again; a merge across the seam that comes before the one undone would have been taken instead."""
        key = (left, right)
        if (known := self.seams.get(key)) is not None:
            return known
        limit, ok, merged, halves = 1 << 60, True, self.merged, self.halves
        while True:
            across = merged.get((left, right))
            if across is not None and across < limit:
                ok = False
                break
            if left > right and left >= 256:
                limit, left = left, halves[left][1]
            elif right >= 256:
                limit, right = right + 1, halves[right][0]
            elif left >= 256:
                limit, left = left, halves[left][1]
            else:
                break
        if len(self.seams) > CACHE_SEAMS:
            self.seams.clear()
        self.seams[key] = ok
        return ok

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of each distinct word, as little-endian unsigned 32-bit integers."""
        root: dict = {}
        for word in words:
            node = root
            for b in word.encode():
                below = node.get(b)
                if below is None:
                    below = node[b] = {}
                node = below
            node[-1] = word
        out: dict[str, bytes] = {}
        path = bytearray()
        last: list[int] = []  # last token of the prefix that ends at each depth
        text, id_bytes, backwards, seams, clean = self.text, self.id_bytes, self.backwards, self.seams, self.clean_seam
        stack: list[tuple[int, int, dict]] = [(0, b, child) for b, child in root.items() if b != -1]
        while stack:
            depth, byte, node = stack.pop()
            del path[depth:], last[depth:]
            path.append(byte)
            at, tail = depth, backwards[byte]
            while True:
                token = tail.get(-1)
                if token is not None:
                    if at == 0:
                        found = token if len(text[token]) == 1 or self.own(token) else None
                    else:
                        before = last[at - 1]
                        ok = seams.get((before, token))
                        found = token if (clean(before, token) if ok is None else ok) else None
                    if found is not None:
                        last.append(found)
                        break
                at -= 1
                tail = tail[path[at]]
            for b, child in node.items():
                if b == -1:
                    ids, i = [], depth
                    while i >= 0:
                        ids.append(id_bytes[last[i]])
                        i -= len(text[last[i]])
                    ids.reverse()
                    out[child] = b"".join(ids)
                else:
                    stack.append((depth + 1, b, child))
        return out

    def encode_long(self, word: str) -> bytes:
        """Ids of one word, along an array of the last tokens: some ten bytes of memory for each of the word's."""
        path, last = word.encode(), array("i")
        text, backwards, clean = self.text, self.backwards, self.clean_seam
        for i, byte in enumerate(path):
            at, tail = i, backwards[byte]
            while True:
                token = tail.get(-1)
                if token is not None and ((len(text[token]) == 1 or self.own(token)) if at == 0 else clean(last[at - 1], token)):
                    last.append(token)
                    break
                at -= 1
                tail = tail[path[at]]
        ids, i = array("I"), len(path) - 1
        while i >= 0:
            ids.append(self.ids[last[i]])
            i -= len(text[last[i]])
        ids.reverse()
        return np.frombuffer(ids, np.uint32).astype("<u4", copy=False).tobytes()

    def own(self, token: int) -> bool:
        """Whether a merged token's own bytes are encoded as this one token."""
        return self.merged.get(self.halves[token]) == token

    def find_words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words.findall(text)
        return self.latin.findall(text)

    def split(self, text: str) -> list[str | int]:
        """Words of a text, and ids of the special tokens in it."""
        if self.cut is None or not self.cut.search(text):
            return self.find_words(text)
        out: list[str | int] = []
        at = 0
        for m in self.cut.finditer(text):
            out += self.find_words(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.find_words(text[at:])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Words encoded before are remembered, up to CACHE_WORDS."""
        split = [self.split(t) for t in texts]
        new: set = set()
        for words in split:
            new.update(words)
        long = {w: self.encode_long(w) for w in new if not isinstance(w, int) and len(w) > TRIE_LENGTH}  # not remembered
        new.difference_update(long)
        fresh = new.difference(self.known)
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known.clear()
            fresh = new
        self.known.update({i: int(i).to_bytes(4, "little") for i in fresh if isinstance(i, int)})
        self.known.update(self.encode_words(w for w in fresh if not isinstance(w, int)))
        if long:
            return [b"".join([long[w] if w in long else self.known[w] for w in words]) for words in split]
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        table = self.id_text
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: str, text: str = "text", check: bool = False) -> DataFrame:
    """All columns of docs, plus token_ids (array of int): the whole text's ids; with check also round_trip (boolean):
    whether decoding them gives the text back."""

    def columns(bpe: Bpe, ids: list[bytes], texts: list[str]) -> list[pa.Array]:
        offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
        return [lists, *([pa.array([bpe.decode(x) == t for x, t in zip(ids, texts, strict=True)])] if check else [])]

    return _apply(docs, vocabulary, text, [("token_ids", "array<int>"), *([("round_trip", "boolean")] if check else [])], columns)


def decode(tokens: DataFrame, vocabulary: str, ids: str = "token_ids") -> DataFrame:
    """All columns of tokens, plus decoded (string): special tokens kept; a null list is null."""
    small_batches(tokens.sparkSession)
    keep = others(tokens.columns, ["decoded"])
    schema = ", ".join([*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in tokens.schema if f.name in keep), "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(vocabulary)
        for b in batches:
            lists = b.column(own).to_pylist()
            texts = [None if x is None else bpe.decode(np.array(x, "<u4").tobytes()) for x in lists]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*keep, "decoded"])

    own = keep.index(ids)
    return mapped(tokens.select(*map(quoted, keep)), run, schema)


def digests(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """All columns of docs, plus n_tokens, ids_sha256 and decoded_sha256 of the encoding and its decoding."""

    def columns(bpe: Bpe, ids: list[bytes], texts: list[str]) -> list[pa.Array]:
        return [
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
        ]

    return _apply(docs, vocabulary, text, [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")], columns)


def _apply(docs: DataFrame, vocabulary: str, text: str, more: list[tuple[str, str]], columns) -> DataFrame:
    small_batches(docs.sparkSession)
    keep = others(docs.columns, [n for n, _ in more])
    schema = ", ".join([*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema if f.name in keep), *(f"{n} {t}" for n, t in more)])
    source, reads = docs.select(*map(quoted, keep)), keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(vocabulary)
        gc.disable()  # nothing here makes cycles, and scans of the cache would take a third of the time
        for batch in batches:
            for b in pieces(batch, reads):
                texts = [x or "" for x in b.column(reads).to_pylist()]
                ids = bpe.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([*b.columns, *columns(bpe, ids, texts)], names=[*keep, *(n for n, _ in more)])

    return mapped(source, run, schema)
