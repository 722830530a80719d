"""Periodic run detection: harmonic grid probing over the words of a text.

For each period p the grid points p, 2p, 3p... are probed: a stretch of 3p words or more with period p makes the words at
jp and (j+1)p equal for two neighbouring j at least. That is n/p tests for each p, n log n in all, and all of them are
array comparisons. Survivors are extended to both sides by comparing the text with itself, p words further, in
chunks that double. Grid points within runs found already, of p or of a divisor of p, are skipped: what such a point
could belong to is that very run.

A run is a stretch of words with smallest period p and at least max(least_words, least_repeats * p) words that no
neighbouring word extends. Words are runs of characters other than white space (0x20, 0x09-0x0D), compared exactly.

Each row is judged alone, so ties, repeated rows and a null or repeated id have no effect on others. A null or empty
text has no words and no runs, and collapses to the empty text. Texts of any length are taken whole; one text is one
task's, in memory of some hundred bytes a word. Further columns are handed on; one that has the name of a result, in
any case of letters, is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curata.llm.common import mapped, others, pieces, quoted, small_batches

#: Grid points probed at a time; bounds the memory of a probe.
PROBE_POINTS = 1 << 18
#: Words compared at first on each side of a survivor; doubled up to the larger number.
CHUNK, LARGEST_CHUNK = 32, 1 << 16

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words alone."""
    ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(ids.__getitem__, words), np.int32, len(words))


def _probes(ids: np.ndarray, largest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(period, grid point) of every two neighbouring grid points whose words both recur a period later, by period."""
    n, low = len(ids), 1
    while low <= largest:
        # as many periods as make PROBE_POINTS grid points, one at least
        counts = (n - 1) // np.arange(low, min(largest, low + PROBE_POINTS) + 1)
        taken = max(1, int(np.searchsorted(np.cumsum(counts), PROBE_POINTS, side="right")))
        counts = counts[:taken]
        period = np.repeat(np.arange(low, low + taken), counts)
        first = np.cumsum(counts) - counts
        at = (np.arange(len(period)) - np.repeat(first, counts)) * period
        equal = ids[at] == ids[at + period]
        pair = np.flatnonzero(equal[:-1] & equal[1:] & (period[:-1] == period[1:]))
        yield period[pair], at[pair]
        low += taken


def _same_until(ids: np.ndarray, at: int, period: int) -> int:
    """The first place from `at` on whose word doesn't recur a period later."""
    end, size = len(ids) - period, CHUNK
    while at < end:
        to = min(at + size, end)
        differs = ids[at:to] != ids[at + period : to + period]
        k = int(differs.argmax())
        if differs[k]:
            return at + k
        at, size = to, min(2 * size, LARGEST_CHUNK)
    return end


def _same_from(ids: np.ndarray, at: int, period: int, least: int) -> int:
    """The smallest place, `least` or more, from which all words up to `at` recur a period later."""
    size = CHUNK
    while at > least:
        low = max(at - size, least)
        differs = ids[low:at] != ids[low + period : at + period]
        k = int(differs[::-1].argmax())
        if differs[len(differs) - 1 - k]:
            return at - k
        at, size = low, min(2 * size, LARGEST_CHUNK)
    return least


def find_runs(ids: np.ndarray, least_words: int = 24, least_repeats: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    if least_repeats < 3:
        raise ValueError("grid probing needs three repeats or more")
    n = len(ids)
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by period: starts and ends, both in order
    if n < max(least_words, least_repeats):
        return []
    for periods, points in _probes(ids, n // least_repeats):
        edges = np.append(np.flatnonzero(np.diff(periods, prepend=-1)), len(periods))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            p, at = int(periods[low]), points[low:high]
            for q, (starts, ends) in found.items():
                if p % q == 0 and len(at):
                    # a period of words that lies in a run of period q recurs with period q: nothing new starts here
                    last = np.searchsorted(starts, at, side="right") - 1
                    at = at[(last < 0) | (at + p >= ends[last])]
            own: list[tuple[int, int]] = []
            done = 0  # what is left starts here or later
            for point in at.tolist():
                if point < done:
                    continue
                start, done = _same_from(ids, point, p, done), _same_until(ids, point, p)
                if done - start + p >= max(least_words, least_repeats * p):
                    own.append((start, done + p))
                done += 1
            if own:
                found[p] = tuple(np.array(own).T)
    return sorted((int(s), int(e - s), p) for p, (starts, ends) in found.items() for s, e in zip(starts, ends, strict=True))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for each word that a run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:n]) == 0


def runs(docs: DataFrame, text: str = "text", least_words: int = 24, least_repeats: int = 3) -> DataFrame:
    """All columns of docs, plus n_words (bigint), runs (array of start, length and period in words, by start and
    period) and collapsed (string): the words that no run holds after its first period, joined by one space."""
    small_batches(docs.sparkSession)
    results = ["n_words", "runs", "collapsed"]
    keep = others(docs.columns, results)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    source = docs.select(*map(quoted, keep), *([] if text in keep else [quoted(text)]))
    schema = ", ".join([*(f"{quoted(c)} {kinds[c]}" for c in keep), "n_words bigint", f"runs array<{RUN}>", "collapsed string"])
    own, run_type = source.columns.index(text), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, own):
                sizes, found, collapsed = [], [], []
                for t in b.column(own).to_pylist():
                    words = (t or "").encode().split()  # bytes split at just these characters
                    own_runs = find_runs(word_ids(words), least_words, least_repeats)
                    if own_runs:
                        words, n = [words[k] for k in np.flatnonzero(kept_words(len(words), own_runs)).tolist()], len(words)
                    else:
                        n = len(words)
                    sizes.append(n)
                    found.append([{"start": s, "length": size, "period": p} for s, size, p in own_runs])
                    collapsed.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(sizes, pa.int64()), pa.array(found, run_type), pa.array(collapsed, pa.string())], names=[*keep, *results])

    return mapped(source, run, schema)
