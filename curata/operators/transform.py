"""The resumable map over an external text transform, with retries, bisection and a dead-letter output.

The translator is any callable of a list of dictionaries of texts. It runs in partitions over Arrow batches; a batch
whose results don't all validate is tried again, then halved, down to single rows, which go to the dead letters.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.text import MOCK_PREFIX

Fields = dict[str, str]
OUTPUT = "ord bigint, source_id string, ok boolean, text_fields string, errors array<string>"


def mock(batch: list[Fields]) -> list[Fields]:
    return [{k: v if not v.strip() else MOCK_PREFIX + v for k, v in x.items()} for x in batch]


def problems(source: Fields, result: Fields | None) -> list[str]:
    """Why a result can't be accepted: the default check."""
    if result is None:
        return ["no result"]
    return [f"{k} is missing" for k in source if k not in result] + [f"{k} is empty" for k, v in source.items() if v.strip() and not str(result.get(k, "")).strip()]


def attempt(batch: list[tuple], translate: Callable, check: Callable, retries: int, pause: float) -> Iterator[tuple]:
    """(row, result, errors) of each row of a batch."""
    errors: list[list[str]] = [["no result"]] * len(batch)
    for n in range(retries + 1):
        try:
            results = translate([x[2] for x in batch])
            errors = [check(x[2], r) for x, r in zip(batch, results, strict=True)]
            if not any(errors):
                yield from ((x, r, []) for x, r in zip(batch, results, strict=True))
                return
        except Exception as e:  # noqa: BLE001  whatever a service raises
            errors = [[f"{type(e).__name__}: {e}"]] * len(batch)
        if n < retries and pause:
            time.sleep(min(10.0, pause * 2**n))
    if len(batch) == 1:
        yield batch[0], None, errors[0]
        return
    half = len(batch) // 2
    yield from attempt(batch[:half], translate, check, retries, pause)
    yield from attempt(batch[half:], translate, check, retries, pause)


def map_texts(items: DataFrame, translate: Callable = mock, check: Callable = problems, batch_size: int = 8, retries: int = 2, pause: float = 0.0, counts: dict | None = None) -> DataFrame:
    """items (ord, source_id, text_fields map<string,string>) through the translator; text_fields of the result is JSON.
    counts: accumulators `ok` and `failed` for rows that are done."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [(o, s, dict(f or [])) for o, s, f in zip(*(c.to_pylist() for c in part.columns), strict=True)]
            out = [y for i in range(0, len(rows), batch_size) for y in attempt(rows[i : i + batch_size], translate, check, retries, pause)]
            if counts:
                good = sum(r is not None for _, r, _ in out)
                counts["ok"].add(good)
                counts["failed"].add(len(out) - good)
            columns = [
                pa.array([x[0] for x, _, _ in out], pa.int64()), pa.array([x[1] for x, _, _ in out], pa.string()), pa.array([r is not None for _, r, _ in out]),
                pa.array([json.dumps(x[2] if r is None else r, ensure_ascii=False, sort_keys=True) for x, r, _ in out], pa.string()), pa.array([e for _, _, e in out], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["ord", "source_id", "ok", "text_fields", "errors"])

    return items.select("ord", "source_id", "text_fields").mapInArrow(run, OUTPUT)


def dealt(items: DataFrame, lanes: int | None) -> DataFrame:
    """items in at most `lanes` tasks by ranges of ord, in order: a translator that asks one thing at a time is then never
    asked for more than `lanes` at once, however many cores there are. Rows that follow each other stay together."""
    return items if lanes is None else items.repartitionByRange(lanes, "ord").sortWithinPartitions("ord")
