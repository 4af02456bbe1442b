"""Fixing intermediate rows in the shared folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a rule table that may be broadcast; a row is a few short texts.
BROADCAST_ROWS = 200_000


def sized_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint where a count shows that it is small, else as it is.

    For tables whose size the planner overrates, so that the large side need not be shuffled
    before adaptive execution sees the true size.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


@functools.cache
def _local_root() -> str:
    return "file://" + tempfile.mkdtemp(prefix="regivane-ckpt-")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; without one, a local folder if Spark runs in this process alone.

    The session's setting is read, never changed.  On a cluster a lack of it is an error, since
    executors would write where nobody else reads.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or _local_root()).rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in a folder of this application."""
    return f"{checkpoint_root(spark)}/regivane/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


#: Writer options for tables of rows of many kilobytes: pages and row groups are closed by bytes after
#: any row (Parquet looks after 100 rows first), since writers and readers hold them whole.
LARGE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def fixed(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and fixes the rows.

    A lost executor costs only its unfinished tasks, since readers use the written files.
    ``options`` go to the writer.
    """
    path = shared_path(df.sparkSession, label)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Remove the files of tables that :func:`fixed` returned, once nothing reads them any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
