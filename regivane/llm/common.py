"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regivane.storage import discard, fixed, shared_path

materialise = fixed

__all__ = ["MEMO_CHARS", "UNICODE_SPACE", "TwoGenerationCache", "discard", "documents", "frames_in_portions", "kept_fields", "materialise", "per_process", "portions", "shared_path", "text_or_empty"]

#: White space as Rust and PCRE engines read ``\s`` (Python's own adds 1C-1F).
UNICODE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Rows and bytes that an operator works on at once.
PORTION_ROWS, PORTION_BYTES = 128, 1 << 20
#: Longer keys are not kept in memos, so a memo's entries bound its bytes.
MEMO_CHARS = 64


def portions(batches: Iterable[pa.RecordBatch], rows: int = PORTION_ROWS, size: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into portions of at most ``rows`` rows and, but for single rows, ``size`` bytes.

    Spark bounds a batch by bytes; what an operator makes of a portion is bounded by this.  What
    the task before has freed goes back first, and what this one has freed in the end.
    """
    _begin()
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows)
            while part.num_rows > 1 and part.nbytes > size:
                part = part.slice(0, part.num_rows // 2)
            yield part
            at += part.num_rows
        del batch
    give_back()


def give_back() -> None:
    """Freed memory back to the system, where the libraries can, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def frames_in_portions(frames: Iterable[pd.DataFrame], rows: int = 128) -> Iterator[pd.DataFrame]:
    _begin()
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at : at + rows]
    give_back()


def kept_fields(df: DataFrame, added: Iterable[str]) -> list:
    """The fields of ``df`` but for those with an added name, in whichever case, as Spark tells names apart."""
    names = {n.lower() for n in added}
    return [f for f in df.schema if f.name.lower() not in names]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


_HELD: list = [None, None, None]


def _task() -> int | None:
    context = TaskContext.get()
    return context.taskAttemptId() if context else None


def _let_go() -> None:
    _HELD[:] = [None, None, None]
    gc.collect()
    give_back()


def per_process(key: tuple, make):
    """The object of ``key``, kept between the tasks of this worker process; one at a time, so memos do not add up.

    A task calls this before it takes its :func:`portions`, which let go what it has not called for.
    """
    if _HELD[0] != key:
        _let_go()
        _HELD[:2] = [key, make()]
    _HELD[2] = _task()
    return _HELD[1]


def _begin() -> None:
    """Without the object of an earlier task that this one does without, and with what that task has freed given back."""
    if _HELD[0] is not None and _HELD[2] != _task():
        _let_go()
    else:
        give_back()


class TwoGenerationCache:
    """A memo of at most ``2 * limit`` short keys: when the young half is full it becomes the old half."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def put(self, key, value):
        if len(key) <= MEMO_CHARS:
            if len(self.young) >= self.limit:
                self.old, self.young = self.young, {}
            self.young[key] = value
        return value

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value
