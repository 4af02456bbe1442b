"""Incremental loads: new files of a folder, each month once, or each record's last version."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from regivane import schemas as S
from regivane.operators.dedup import keep_last
from regivane.sources.sinks import write_new_months

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ADDRESS = ["file_name", "row_number"]


def load_new_months(spark: SparkSession, incoming: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Append the months in ``incoming`` CSV files that ``folder`` lacks, and stop when all are read.

    A file whose header has other names, or another order, is an error.  A batch that runs again after a failure finds its months present and adds nothing.
    """

    def append(batch: DataFrame, number: int) -> None:
        write_new_months(batch, folder)

    stream = spark.readStream.schema(S.RAW_SCHEMA).option("header", True).option("enforceSchema", False).csv(incoming)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class LastVersion(StatefulProcessor):
    """Keeps, for each key, the address of its last row so far, and lets through rows that come behind it in that order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "file_name string, row_number bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.last.get()) if self.last.exists() else None
        found = None
        for frame in rows:
            best = frame.sort_values(_ADDRESS).tail(1)
            address = best["file_name"].iloc[0], int(best["row_number"].iloc[0])
            if held is None or address > held:
                held, found = address, best
        if found is not None:
            self.last.update(held)
            yield found

    def close(self) -> None:
        pass


@contextlib.contextmanager
def _state_in_files(spark: SparkSession) -> Iterator[None]:
    """The state store that such processors need, for the query that is started inside."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def load_last_versions(spark: SparkSession, incoming: str, versions: str, checkpoint: str, files_a_batch: int = 64) -> StreamingQuery:
    """Add to ``versions`` the records of new ``incoming`` Parquet files that come last for their key, and stop.

    Last is by file name, then row, whichever file arrives first: a file that comes late replaces
    only what names before its own have brought.  State is an address a key.  ``versions`` holds each
    version that was the last for a time; :func:`last_versions` reads what stays.
    """
    stream = spark.readStream.schema(S.RAW_SCHEMA).option("maxFilesPerTrigger", files_a_batch).parquet(incoming)
    placed = stream.select(*S.RAW_SCHEMA.names, F.col("_metadata.file_name").alias(_ADDRESS[0]), F.col("_metadata.row_index").alias(_ADDRESS[1]))
    passed = placed.groupBy(*S.RECORD_KEY).transformWithStateInPandas(LastVersion(), placed.schema, "append", "none")
    with _state_in_files(spark):
        return passed.writeStream.format("parquet").outputMode("append").option("path", versions).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_versions(spark: SparkSession, versions: str) -> DataFrame:
    """The records that :func:`load_last_versions` has left as the last of their keys."""
    kept = keep_last(spark.read.parquet(versions), S.RECORD_KEY, F.struct(*_ADDRESS))
    return kept.select(S.RAW_SCHEMA.names)
