"""Comma-separated files by byte ranges: quoted line breaks, columns by name, a status for each file.

A quoted field may hold line breaks, so whether a line begins a record depends on all before it in
its file.  Files are still read by ranges, in parallel:

1.  Each range tells, for both cases (its first line begins a record, or lies inside quotes), in
    which case its end is and how many records begin in it.
2.  For each file these results are chained in the order of its ranges, which gives each range its
    case, and the numbers of the records and lines before it.
3.  Each range then cuts its lines into records.  A record that goes on over a range's end leaves
    pieces, which meet by record number.

Fields are read as Python's csv module reads them: quotes count at a field's beginning only, a
doubled quote inside is one, what follows a closing quote belongs to the field.  Line breaks of any
kind come out as one line feed.  Empty lines are no records.

Every file has its own header: values are found by name, so files may differ in the order and number
of their columns.  A file is ``empty`` without a record; it is ``unreadable``, and left out alone,
if a record has more fields than its header, if a byte does not fit the encoding, or if it ends
inside quotes; else it is ``read``.
"""

from __future__ import annotations

import codecs
import csv
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane.storage import fixed

#: Ranges that may be broadcast; a range is a path and a few numbers.
BROADCAST_RANGES = 100_000
_RANGE = ["file", "block"]
_RECORDS = "file string, line bigint, physical_line bigint, block bigint, fields array<string>, piece string, bad boolean"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of a line lies inside quotes, for a line that begins there or begins a record."""
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] != '"':
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
            at += 1
        inside = False
        while True:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] != '"':
                break
            at += 2
        at = line.find(",", at + 1) + 1
        if not at:
            return False


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Parts of a batch that come from one range."""
    files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
    at = 0
    for k in range(1, len(files) + 1):
        if k == len(files) or blocks[k] != blocks[at] or files[k] != files[at]:
            yield files[at], blocks[at], batch.slice(at, k - at)
            at = k


def _texts(values: pa.Array, encoding: str) -> tuple[pa.Array, np.ndarray]:
    """The lines as texts, and which of them hold a byte that does not fit the encoding."""
    if codecs.lookup(encoding).name == "utf-8":
        try:
            return values.cast(pa.string()), np.zeros(len(values), dtype=bool)
        except pa.ArrowInvalid:
            pass
    out, bad = [], np.zeros(len(values), dtype=bool)
    for k, value in enumerate(values.to_pylist()):
        try:
            out.append(value.decode(encoding))
        except UnicodeDecodeError:
            out.append(value.decode(encoding, "replace"))
            bad[k] = True
    return pa.array(out, pa.string()), bad


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, block, value binary): the lines of all files, those of a range in their order."""
    read = spark.read.text(paths)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, size) of all files; their content is not read."""
    # scans leave out files without a byte, the driver's listing has them
    names = [f.replace("file:///", "file:/", 1) for f in spark.read.text(paths).inputFiles()]  # as a file's metadata has it
    every = spark.createDataFrame([(f,) for f in names], "file string")
    sized = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"), "length")
    return every.join(sized, "file", "left").select("file", F.coalesce("length", F.lit(0)).alias("size"))


def _summaries(rows: DataFrame, encoding: str) -> DataFrame:
    """(file, block, lines, end0, begun0, end1, begun1): for both cases of a range its end and the records that begin in it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def told() -> pa.RecordBatch:
            (file, block), n, ends, begun = held
            columns = [[file], [block], [n], [ends[0]], [begun[0]], [ends[1]], [begun[1]]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "block", "lines", "end0", "begun0", "end1", "begun1"])

        for batch in batches:
            for file, block, part in _runs(batch):
                if held and held[0] != (file, block):
                    yield told()
                    held = []
                if not held:
                    held = [(file, block), 0, [False, True], [0, 0]]
                texts, _ = _texts(part.column("value"), encoding)
                filled = np.concatenate(([0], np.cumsum(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))))
                quoted = np.flatnonzero(pc.match_substring(texts, '"').to_numpy(zero_copy_only=False))
                held[1] += len(texts)
                at = 0
                # only lines with a quote can change the case; between them all filled lines begin a record, or none does
                for k, line in zip(quoted.tolist(), texts.take(pa.array(quoted)).to_pylist(), strict=True):
                    for case in (0, 1):
                        if not held[2][case]:
                            held[3][case] += int(filled[k] - filled[at]) + 1
                        held[2][case] = ends_inside(line, held[2][case])
                    at = k + 1
                for case in (0, 1):
                    if not held[2][case]:
                        held[3][case] += int(filled[-1] - filled[at])
        if held:
            yield told()

    return rows.mapInArrow(counted, "file string, block bigint, lines bigint, end0 boolean, begun0 bigint, end1 boolean, begun1 bigint")


def ranges(rows: DataFrame, encoding: str) -> DataFrame:
    """(file, block, inside, records, lines, open): the case of each range and what is before it; ``open`` is its end's case."""

    def chained(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        out, inside, records, before = [], False, 0, 0
        for r in frame.itertuples(index=False):
            end, begun = (r.end1, r.begun1) if inside else (r.end0, r.begun0)
            out.append((r.file, r.block, inside, records, before, end))
            inside, records, before = end, records + begun, before + r.lines
        return pd.DataFrame(out, columns=["file", "block", "inside", "records", "lines", "open"])

    # a row a range, so a file's are few
    return _summaries(rows, encoding).groupBy("file").applyInPandas(chained, "file string, block bigint, inside boolean, records bigint, lines bigint, open boolean")


def _fields(text: str) -> list[str]:
    return next(csv.reader(text.split("\n") if "\n" not in text else [x + "\n" for x in text.split("\n")[:-1]] + [text.split("\n")[-1]]))


class _Cutter:
    """Cuts the lines of one range into records."""

    def __init__(self, file: str, block: int, inside: bool, records: int, before: int):
        self.file, self.block, self.inside, self.record, self.at = file, block, inside, records, before
        self.pieces: list[str] = []
        self.begun = 0  # the line that the open record begins on; 0 where that is in a range before
        self.bad = False

    def _row(self, line, physical, fields, piece, bad) -> tuple:
        return self.file, line, physical, self.block, fields, piece, bad

    def whole(self, texts: pa.Array, bad: np.ndarray) -> pa.RecordBatch | None:
        """Lines without a quote, outside of quotes."""
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        own = np.flatnonzero(filled)
        base, at = self.record, self.at
        self.record, self.at = base + len(own), at + len(texts)
        if not len(own):
            return None
        n = len(own)
        columns = [pa.array([self.file] * n), pa.array(base + 1 + np.arange(n)), pa.array(at + 1 + own), pa.array(np.full(n, self.block)), pc.split_pattern(texts.take(pa.array(own)), ","), pa.nulls(n, pa.string()), pa.array(bad[own])]
        return pa.RecordBatch.from_arrays(columns, ["file", "line", "physical_line", "block", "fields", "piece", "bad"])

    def line(self, text: str, bad: bool) -> tuple | None:
        self.at += 1
        if not self.inside and not text:
            return None
        if not self.inside:
            self.record += 1
            self.begun, self.pieces, self.bad = self.at, [], False
        self.pieces.append(text)
        self.bad |= bad
        self.inside = ends_inside(text, self.inside)
        return None if self.inside else self.ended()

    def ended(self) -> tuple:
        """The record that ends with this line, or the piece of one that the range's end leaves or that began before."""
        text, self.pieces = "\n".join(self.pieces), []
        if self.inside or not self.begun:
            return self._row(self.record, self.begun or None, None, text, self.bad)
        return self._row(self.record, self.begun, _fields(text), None, self.bad)


def records(spark: SparkSession, paths: str | list[str], encoding: str = "utf-8") -> DataFrame:
    """(file, line, physical_line, fields, bad, open): the records of all files, written once.

    ``line`` numbers a file's records from 1, its header; ``physical_line`` is the line that the
    record begins on; ``bad`` says that a byte does not fit, ``open`` that the file ends inside quotes.
    """
    rows = lines(spark, paths)
    known = fixed(ranges(rows, encoding), "csv-ranges")
    if known.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES:
        met = rows.join(F.broadcast(known), _RANGE)  # keeps the order of lines
    else:
        met = rows.withColumn("row", F.monotonically_increasing_id()).join(known, _RANGE).sortWithinPartitions(*_RANGE, "row").drop("row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, schema = None, pa.schema([("file", pa.string()), ("line", pa.int64()), ("physical_line", pa.int64()), ("block", pa.int64()), ("fields", pa.list_(pa.string())), ("piece", pa.string()), ("bad", pa.bool_())])

        def out(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), schema.types, strict=True)], schema.names)

        for batch in batches:
            for file, block, part in _runs(batch):
                if own is None or (own.file, own.block) != (file, block):
                    if own is not None and own.pieces:
                        yield out([own.ended()])
                    own = _Cutter(file, block, *(part.column(c)[0].as_py() for c in ("inside", "records", "lines")))
                texts, bad = _texts(part.column("value"), encoding)
                quoted = np.flatnonzero(pc.match_substring(texts, '"').to_numpy(zero_copy_only=False))
                found, at = [], 0
                for k in [*quoted.tolist(), len(texts)]:
                    if own.inside:  # the lines up to the next quote go on with the open record
                        for j in range(at, k):
                            own.line(texts[j].as_py(), bool(bad[j]))
                    elif k > at:
                        if found:
                            yield out(found)
                            found = []
                        if (whole := own.whole(texts.slice(at, k - at), bad[at:k])) is not None:
                            yield whole.cast(schema)
                    if k < len(texts) and (row := own.line(texts[k].as_py(), bool(bad[k]))):
                        found.append(row)
                    at = k + 1
                if found:
                    yield out(found)
        if own is not None and own.pieces:
            yield out([own.ended()])

    found = fixed(met.mapInArrow(cut, _RECORDS), "csv-records")
    ends = known.groupBy("file").agg(F.max_by("open", "block").alias("open"))
    whole = found.where("piece IS NULL").select("file", "line", "physical_line", "fields", "bad")
    parted = found.where("piece IS NOT NULL").groupBy("file", "line").agg(F.min("physical_line").alias("physical_line"), F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("p"), F.max("bad").alias("bad"))
    parted = parted.select("file", "line", "physical_line", F.array_join(F.col("p.piece"), "\n").alias("text"), "bad")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = pa.array([_fields(t) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], fields, batch.column("bad")], ["file", "line", "physical_line", "fields", "bad"])

    joined = whole.unionByName(parted.mapInArrow(parsed, "file string, line bigint, physical_line bigint, fields array<string>, bad boolean"))
    return joined.join(ends, "file")


@dataclass
class Tables:
    """Files read by name: ``rows`` have the wanted columns, file, line and physical_line; ``status`` has a row a file."""

    rows: DataFrame
    status: DataFrame
    #: (file, names): the header of each file that has one.
    headers: DataFrame


def read(spark: SparkSession, paths: str | list[str], columns: list[str] | None, encoding: str = "utf-8", nulls: tuple[str, ...] = ("",)) -> Tables:
    """Text columns by name from files that may differ; a column that a file lacks is null in its rows.

    ``columns`` None takes all names that a header has.  Whole fields that are one of ``nulls`` are null.
    """
    every = records(spark, paths, encoding)
    first = F.when(F.col("line") == 1, F.transform("fields", lambda n, k: F.when(k == 0, F.regexp_replace(n, "^﻿", "")).otherwise(n)))
    headers = fixed(every.where("line = 1").select("file", first.alias("names")), "csv-headers")
    told = every.join(headers, "file")
    over = F.max((F.size("fields") > F.size("names")) | F.col("bad") | F.col("open"))
    counted = told.groupBy("file").agg((F.count("*") - 1).alias("n_rows"), over.alias("odd"))
    status = files(spark, paths).join(counted, "file", "left").select("file", "size", F.when(F.col("n_rows").isNull(), "empty").when(F.col("odd"), "unreadable").otherwise("read").alias("status"), F.when(~F.col("odd"), F.col("n_rows")).otherwise(0).alias("n_rows"))
    status = fixed(status.select("file", "size", "status", F.coalesce("n_rows", F.lit(0)).alias("n_rows")), "csv-status")
    if columns is None:
        columns = sorted(r.name for r in headers.select(F.explode("names").alias("name")).distinct().collect())  # names, not rows
    place = lambda name: F.get("fields", F.array_position("names", name).cast("int") - 1)
    value = lambda name: F.when(F.array_contains("names", name) & ~place(name).isin(*nulls), place(name)).alias(name)
    kept = told.where("line > 1").join(status.where("status = 'read'").select("file"), "file", "left_semi")
    return Tables(kept.select("file", "line", "physical_line", *map(value, columns)), status, headers)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types, beside the others; what does not fit is null."""
    names = set(schema.names)
    return rows.select(*(c for c in rows.columns if c not in names), *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))
