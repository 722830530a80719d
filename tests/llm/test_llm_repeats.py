"""Substring dedup of texts that repeat a few words very often."""

import pyarrow as pa
import pytest
from test_llm_operators import by_id, expected_windows

from curata.llm import anchors, substring_dedup
from curata.llm.common import text_buffer


def pair(cuts: bool) -> str:
    """Two words, whose repetition has one anchor: one that starts a new chunk, or one that doesn't."""
    for i in range(1000):
        data, offsets = text_buffer(pa.array([f"left{i} right{i} " * 30]))
        (found,) = substring_dedup.word_runs(13)(data, offsets)
        if len(set(found.h.tolist())) == 1 and (int(found.h[0]) % anchors.CHUNK_RUNS == 0) == cuts:
            return f"left{i} right{i} "
    raise AssertionError


def texts(two: str) -> list[tuple[int, str]]:
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(20))
    lengths = [300, 300, 250, 7, 6, 300, 40]
    rows = [(i, f"{own(i)} {two * n}{own(i)} tail") for i, n in enumerate(lengths)]
    apart = " ".join(f"gap{k}" for k in range(100))
    return [*rows, (20, two * 50 + apart + " " + two * 50), (21, two * 20 + own(21) + " " + two * 20), (22, apart)]


@pytest.mark.parametrize("cuts", [True, False])
def test_a_repeated_pair_is_a_few_rows(spark, monkeypatch, cuts):
    monkeypatch.setattr(anchors, "HOT_RUNS", 2)
    made, to_first = [], substring_dedup._to_first
    monkeypatch.setattr(substring_dedup, "_to_first", lambda *a: made.append(to_first(*a)) or made[-1])
    rows = texts(pair(cuts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = by_id(substring_dedup.removed(df, 13), "n_words", "n_removed", "kept_sha256")
    assert got == expected_windows(rows, 13)
    assert len(made) >= 2
    assert sum(x.count() for x in made) <= 10 * len(rows)  # about a thousand, were each repetition a row


def test_a_repeated_pair_over_the_edge_of_a_block(spark, monkeypatch):
    monkeypatch.setattr(anchors, "HOT_RUNS", 2)
    two = pair(True)
    edge = substring_dedup.CHUNK_WORDS
    filling = " ".join(f"w{k}" for k in range(edge - 7))
    rows = [(1, f"{filling} {two * 30}end"), (2, f"start {two * 100}end"), (3, two * 8), (4, f"w{edge - 9} w{edge - 8} {two * 9}")]
    got = by_id(substring_dedup.removed(spark.createDataFrame(rows, "doc_id bigint, text string"), 13), "n_words", "n_removed", "kept_sha256")
    assert got == expected_windows(rows, 13)


def test_repeats_joined_touch_no_further_cell():
    import random

    import numpy as np

    rng = random.Random(4)
    cells = lambda a, n: set(range(a // substring_dedup.CELL_WORDS, (a + n - 1) // substring_dedup.CELL_WORDS + 1))
    for _ in range(200):
        size = rng.randint(1, 30)
        row, what = sorted(rng.randint(0, 2) for _ in range(size)), [rng.choice("ab") for _ in range(size)]
        place, many = np.array([rng.randint(0, 900) for _ in range(size)]), np.array([{"a": 3, "b": 17}[w] for w in what])
        first, n = substring_dedup.repeats_joined(np.array(row), what, place, many)
        for r in range(3):
            for w in "ab":
                mine = [cells(int(place[j]), int(many[j])) for j in range(size) if (row[j], what[j]) == (r, w)]
                joined = [cells(int(place[j]), m) for j, m in zip(first.tolist(), n.to_pylist(), strict=True) if (row[j], what[j]) == (r, w)]
                assert set().union(*mine) == set().union(*joined)
