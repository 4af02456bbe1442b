"""Writers for the output CSVs, the monthly files and the consolidated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from regivane.operators.quality import report_order
from regivane.storage import discard, fixed, shared_path

MONTH_KEY = ["anio", "mes", "id_estatus_victima"]


#: Bytes that a task copies at once when parts are assembled.
CHUNK_BYTES = 64 << 20


def write_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Header, nothing for null or empty, in the order of columns given.

    One file goes through one task, which is for reports of a few rows; :func:`write_sorted_csv`
    makes one of any size.
    """
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path object) of a path."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def move_file(spark: SparkSession, folder: str, path: str) -> None:
    """The one file that a write has left in ``folder`` as ``path``."""
    system, name = _hadoop(spark, folder)
    (file,) = [s.getPath() for s in system.listStatus(name) if s.getPath().getName().startswith("part-")]
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system.mkdirs(target.getParent())
    if not system.rename(file, target):
        raise OSError(f"{file} cannot be moved to {path}")
    system.delete(name, True)


def write_sorted_csv(df: DataFrame, path: str, *order: str | Column) -> None:
    """One file with a header, in ``order``, below ``path``; no task holds or copies more than its part.

    Tasks write ranges of the order as files without a header.  Where the file system can join files
    (as HDFS can, without reading them) they are joined in its metadata; on a folder that all
    machines mount, tasks copy pieces of them to the places where they belong.
    """
    spark = df.sparkSession
    staged, root = shared_path(spark, "sorted-csv"), path.rstrip("/")
    rows = fixed(df, "unsorted")  # the ranges are sampled first
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.write.option("header", False).option("escape", '"').option("emptyValue", "").csv(f"{staged}/parts")
    discard(rows)
    header = spark.range(1).select(F.lit(",".join(df.columns)).alias("value"))
    header.coalesce(1).write.text(f"{staged}/header")
    files = []
    for folder in ("header", "parts"):
        system, name = _hadoop(spark, f"{staged}/{folder}")
        found = [(s.getPath(), s.getLen()) for s in system.listStatus(name) if s.getPath().getName().startswith("part-") and s.getLen()]
        files += sorted(found, key=lambda f: f[0].getName())  # a partition's number is in its name
    system, target = _hadoop(spark, root)
    system.delete(target, True)
    system.mkdirs(target)
    whole = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/part-00000.csv")
    if not _joined(spark, system, whole, [f for f, _ in files]):
        _assembled(spark, whole, files)
    system.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_SUCCESS")).close()
    system, name = _hadoop(spark, staged)
    system.delete(name, True)


def _joined(spark: SparkSession, system, whole, files: list) -> bool:
    """Whether the file system has joined ``files`` by itself."""
    if system.getScheme() == "file":
        return False
    first, *rest = files
    if not system.rename(first, whole):
        raise OSError(f"{first} cannot be moved to {whole}")
    if rest:
        system.concat(whole, _paths(spark, rest))
    return True


def _paths(spark: SparkSession, files: list):
    out = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(files))
    for k, f in enumerate(files):
        out[k] = f
    return out


def _assembled(spark: SparkSession, whole, files: list) -> None:
    """Copy pieces of ``files`` (path, size) to their places in one file of a mounted folder, in tasks."""
    target, pieces, at = whole.toUri().getPath(), [], 0
    for file, size in files:
        pieces += [(file.toUri().getPath(), begin, min(CHUNK_BYTES, size - begin), at + begin) for begin in range(0, size, CHUNK_BYTES)]
        at += size
    with open(target, "wb") as f:
        f.truncate(at)

    def copied(batches):
        for batch in batches:
            for source, begin, size, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open(source, "rb") as a, open(target, "r+b") as b:
                    a.seek(begin)
                    b.seek(place)
                    while size > 0:
                        data = a.read(min(size, 1 << 20))
                        if not data:
                            raise OSError(f"{source} is shorter than it was")
                        b.write(data)
                        size -= len(data)
            yield batch.slice(0, 0)

    tasks = spark.createDataFrame(pieces, "source string, begin bigint, size bigint, place bigint").repartition(max(1, min(len(pieces), spark.sparkContext.defaultParallelism)))
    tasks.mapInArrow(copied, tasks.schema).count()


def write_discrepancies(df: DataFrame, path: str, datasets: list[str]) -> bool:
    """Write, in the order of the report, only where there is a row; tells whether it did."""
    if df.isEmpty():
        return False
    write_sorted_csv(df, path, *report_order(datasets))
    return True


def present_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """(anio, mes, id_estatus_victima) of the months and statuses that have rows."""
    try:
        return spark.read.parquet(folder).select(*(F.col(c).cast("bigint") for c in MONTH_KEY)).distinct()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], ", ".join(f"{c} bigint" for c in MONTH_KEY))
        raise


def write_new_months(df: DataFrame, folder: str) -> None:
    """Append the months of each status that ``folder`` lacks, one folder a month; present ones stay, empty ones are not made."""
    present = present_partitions(df.sparkSession, folder).alias("present")
    same = [F.col(f"fresh.{c}").eqNullSafe(F.col(f"present.{c}")) for c in MONTH_KEY]
    fresh = df.alias("fresh").join(present, same, "left_anti")
    fresh.repartition(*MONTH_KEY).write.mode("append").partitionBy("anio", "mes").option("compression", "snappy").parquet(folder)


def consolidate(monthly: DataFrame, path: str) -> None:
    """All months as one Snappy Parquet table, in file order."""
    monthly.orderBy("ordinal").drop("ordinal").write.mode("overwrite").option("compression", "snappy").parquet(path)
