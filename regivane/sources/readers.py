"""Typed readers.  Codes are always text, and file order becomes an explicit ordinal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from regivane import schemas
from regivane.functions import text
from regivane.sources import delimited
from regivane.storage import discard, fixed, sized_broadcast


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Consolidated records; ``ordinal`` is a row's address as a number, by file name, then row."""
    df = spark.read.schema(schemas.RAW_SCHEMA).parquet(*paths)
    names = sorted(f.replace("file:///", "file:/", 1) for f in df.inputFiles())  # the driver's listing, as a file's metadata has it
    numbers = spark.createDataFrame(list(enumerate(names)), "file_number bigint, file_name string")
    placed = df.withColumns({"file_name": F.col("_metadata.file_path"), "row_number": F.col("_metadata.row_index")})
    return placed.join(sized_broadcast(numbers), "file_name").select(*schemas.RAW_SCHEMA.names, (F.shiftleft("file_number", 40) + F.col("row_number")).alias("ordinal"))


def monthly_tables(spark: SparkSession, paths: str | list[str]) -> delimited.Tables:
    """Monthly CSV files, columns by name, with a status for each file; empty and unreadable ones give no rows."""
    return delimited.read(spark, paths, schemas.RAW_SCHEMA.names, nulls=schemas.TABLE_NULLS)


def read_monthly(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """Records of monthly CSV files; ``ordinal`` orders by file name, then record."""
    return _ordered(delimited.typed(monthly_tables(spark, glob).rows, schemas.RAW_SCHEMA))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.select(*(c for c in rows.columns if c not in ("file", "line", "physical_line")), F.struct("file", "line").alias("ordinal"))


def null_tokens(df: DataFrame, tokens: tuple[str, ...] = schemas.CATALOG_NULLS) -> DataFrame:
    """Null where a whole text field is one of ``tokens``."""
    return df.select(*(F.when(F.col(f.name).isin(*tokens), None).otherwise(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The official code catalog, an ISO-8859-1 CSV with its columns in any order; ``ordinal`` is the file order."""
    found = delimited.read(spark, path, schemas.CATALOG_SCHEMA.names, "iso-8859-1", ("", *schemas.CATALOG_NULLS))
    return _ordered(found.rows)


def clean_audit_catalog(catalog: DataFrame) -> DataFrame:
    """The catalog as the audit sees it: blanks and quotes off, codes as written, the last of equal codes."""
    bare = {c: text.strip(F.translate(F.col(c), '"', "")) for c in schemas.CATALOG_SCHEMA.names}
    rest = F.struct(F.col("CVE_ENT").alias("cve_ent"), F.col("CVE_MUN").alias("cve_mun"))
    last = catalog.withColumns(bare).groupBy(F.col("CVEGEO").alias("cvegeo")).agg(F.max_by(rest, "ordinal").alias("x"))
    return last.select("cvegeo", "x.*")


def _rules(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV of rules as text, columns by name, with its file order; without a file, or one of some bytes, an empty table."""
    try:
        found = delimited.read(spark, path, schema.names, nulls=schemas.TABLE_NULLS)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema).withColumn("ordinal", F.lit(0).cast("bigint"))
        raise
    long_enough = found.status.where(F.col("size") >= schemas.LEAST_RULE_BYTES).select("file")
    return _ordered(found.rows.join(long_enough, "file", "left_semi"))


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    return _rules(spark, path, schemas.CORRECTIONS_SCHEMA)


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    return _rules(spark, path, schemas.OVERRIDES_SCHEMA)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """A processed CSV with its types; codes keep their zeros."""
    return delimited.typed(delimited.read(spark, path, schemas.FACT_SCHEMA.names).rows, schemas.FACT_SCHEMA).select(*schemas.FACT_SCHEMA.names)


def read_fact_text(spark: SparkSession, path: str) -> DataFrame:
    """A processed CSV as text, its columns in the order of its header; ``line`` counts the records, the first on 2.

    A record counts once, whatever line breaks its fields hold.  Of several files, by name, the
    header is that of the first, and the records of each follow those of the one before.
    """
    found = delimited.read(spark, path, None)
    first = found.headers.orderBy("file").limit(1).collect()
    names = first[0]["names"] if first else []
    # a row a file
    before = found.status.select("file", (F.sum("n_rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    rows = found.rows.join(before, "file").withColumn("line", F.col("line") + F.coalesce("before", F.lit(0)))
    return rows.select(*names, "line")


def number_lines(df: DataFrame, *order: str, name: str = "line", first: int = 2) -> DataFrame:
    """Consecutive line numbers by ``order`` (a unique key) without gathering the rows in one task.

    The rows are written, so that finding the ranges does not compute them twice, range-sorted and
    fixed; a task numbers its own and adds the sizes of the parts before.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = fixed(df, "unnumbered")
    ranged = fixed(rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "lines")
    discard(rows)
    # one row a partition, so this window is small
    sizes = ranged.groupBy("__part").count()
    starts = sizes.select("__part", (F.sum("count").over(Window.partitionBy(F.lit(0)).orderBy("__part")) - F.col("count")).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(starts, "__part").withColumn(name, (F.col("__start") + inside + (first - 1)).cast("bigint")).drop("__part", "__start")
