"""A table of monthly files in which a month of a status is whole or absent.

Writers put Parquet files of their own names below ``data``; a month exists once ``months`` has a
manifest that lists its files.  A manifest is written aside and then linked to its name, which fails
where another loader was first: of two loaders one adds the month, the other takes its files back.
A job that fails leaves no manifest, and its files are removed.

The writer is a Python data source: its tasks run where the rows are, and hand the driver the names
of their files only.  It opens paths by itself, so the folder has to be mounted by all machines.
"""

from __future__ import annotations

import contextlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from regivane import schemas as S

MONTH_KEY = ["anio", "mes", "id_estatus_victima"]
FORMAT = "regivane_months"
_MANIFEST = "anio bigint, mes bigint, id_estatus_victima bigint, files array<string>, n_rows bigint"


def mounted(path: str) -> str:
    """The path of a folder that programs open by themselves."""
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path} is no mounted folder")
    return unquote(parts.path) if parts.scheme else path


@dataclass
class Staged(WriterCommitMessage):
    """(month, file, rows) of what one task wrote."""

    files: list[tuple[tuple, str, int]]


class MonthWriter(DataSourceArrowWriter):
    """Stages a job's files; :meth:`commit` makes its months visible one by one, :meth:`abort` none."""

    def __init__(self, folder: str):
        self.folder, self.job = mounted(folder), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """Rows come sorted by month, so one file is open at a time."""
        task, out = TaskContext.get(), []
        # files of an attempt that fails are never named in a manifest
        stem = f"data/{self.job}/{task.partitionId()}-{task.taskAttemptId()}"
        month, file, n = None, None, 0
        os.makedirs(os.path.join(self.folder, f"data/{self.job}"), exist_ok=True)
        try:
            for batch in iterator:
                keys = list(zip(*(batch.column(c).to_pylist() for c in MONTH_KEY), strict=True))
                at = 0
                for k in range(1, len(keys) + 1):
                    if k == len(keys) or keys[k] != keys[at]:
                        if file is None or keys[at] != month:
                            if file is not None:
                                file.close()
                                out.append((month, f"{stem}-{len(out)}.parquet", n))
                            month, n = keys[at], 0
                            file = pq.ParquetWriter(os.path.join(self.folder, f"{stem}-{len(out)}.parquet"), batch.schema, compression="snappy")
                        file.write_batch(batch.slice(at, k - at))
                        n, at = n + k - at, k
        finally:
            if file is not None:
                file.close()
        if file is not None:
            out.append((month, f"{stem}-{len(out)}.parquet", n))
        return Staged(out)

    def commit(self, messages: list[Staged | None]) -> None:
        by_month: dict[tuple, list] = {}
        for message in messages:
            for month, file, n in message.files if message else []:
                by_month.setdefault(month, []).append((file, n))
        for month, files in by_month.items():
            if not self._publish(month, files):
                for file, _ in files:
                    os.remove(os.path.join(self.folder, file))

    def _publish(self, month: tuple, files: list) -> bool:
        """Whether the month was absent and is now there."""
        root = os.path.join(self.folder, "months")
        os.makedirs(root, exist_ok=True)
        aside = os.path.join(root, f".{self.job}")
        with open(aside, "w", encoding="utf-8") as f:
            json.dump(dict(zip(MONTH_KEY, month, strict=True)) | {"files": sorted(name for name, _ in files), "n_rows": sum(n for _, n in files)}, f)
        try:
            os.link(aside, os.path.join(root, "-".join(map(str, month)) + ".json"))
        except FileExistsError:
            return False
        finally:
            os.remove(aside)
        return True

    def abort(self, messages: list[Staged | None]) -> None:
        with contextlib.suppress(FileNotFoundError):
            shutil.rmtree(os.path.join(self.folder, f"data/{self.job}"))


class MonthSource(DataSource):
    """The write side of the table: option ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> MonthWriter:
        if overwrite:
            raise ValueError("months are added, never replaced")
        return MonthWriter(self.options["path"])


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """(anio, mes, id_estatus_victima, files, n_rows) of the months that are there."""
    root = os.path.join(mounted(folder), "months")
    if not os.path.isdir(root):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).json(f"file://{root}")


def read_months(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all months that are there; files that no manifest names are not read."""
    names = [r.name for r in manifests(spark, folder).select(F.explode("files").alias("name")).collect()]  # names, not rows
    if not names:
        return spark.createDataFrame([], S.RAW_SCHEMA)
    return spark.read.schema(S.RAW_SCHEMA).parquet(*(f"file://{mounted(folder)}/{name}" for name in names))


def add_months(df: DataFrame, folder: str) -> None:
    """Add the months of each status that ``folder`` lacks, each whole or not at all.

    A large month goes over several tasks; a month that another loader adds meanwhile stays as that
    one wrote it.
    """
    spark = df.sparkSession
    spark.dataSource.register(MonthSource)
    present = manifests(spark, folder).select(MONTH_KEY).alias("present")
    same = [F.col(f"fresh.{c}").eqNullSafe(F.col(f"present.{c}")) for c in MONTH_KEY]
    fresh = df.select(S.RAW_SCHEMA.names).alias("fresh").join(present, same, "left_anti")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = fresh.repartitionByRange(parts, *MONTH_KEY, F.xxhash64(*S.RAW_SCHEMA.names)).sortWithinPartitions(*MONTH_KEY)
    dealt.write.format(FORMAT).mode("append").option("path", folder).save()
