"""Row-level audit of a published table against the catalog: every broken rule is a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.functions import text


def _error(check: str, detail: Column, when: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(check).alias("check"), F.col("line"), F.col("code").alias("cvegeo"), detail.alias("detail")))


def audit_rows(rows: DataFrame, catalog: DataFrame, years: tuple[int, int] = S.YEARS, months: tuple[int, int] = S.MONTHS) -> DataFrame:
    """(check, line, cvegeo, detail) of each error.

    ``rows`` hold text fields and ``line``; ``catalog`` is (cvegeo, cve_ent, cve_mun).  A
    duplicate points to the line before with the same repaired code and the same text of
    year, month and status.  Rows with a sentinel code skip the catalog checks only.
    """
    number = lambda c: text.strip(F.col(c).cast("string")).try_cast("bigint")
    coded = rows.withColumn("code", text.code_repair(F.col("cvegeo").cast("string"), 5))
    same = Window.partitionBy("code", "year", "month", "status_id").orderBy("line")
    coded = coded.withColumn("before", F.lag("line").over(same))
    known = catalog.select(F.col("cvegeo").alias("known_code"), F.col("cve_ent").alias("known_ent"), F.col("cve_mun").alias("known_mun"))
    joined = coded.join(known, F.col("code") == F.col("known_code"), "left")
    male, female, undefined, total = map(number, ("male", "female", "undefined", "total"))
    year, month = number("year"), number("month")
    mun = text.safe_int(F.col("cve_mun"))
    checked = ~F.col("code").isin(*S.SENTINEL_CVEGEO) & ~F.coalesce(mun.isin(*S.SENTINEL_CVE_MUN), F.lit(False))
    missing, found = F.col("known_code").isNull(), F.col("known_code").isNotNull()
    estado = text.code_repair(F.col("cve_estado").cast("string"), 2)
    municipality = F.when(F.coalesce(mun, F.lit(0)) == 0, F.lit("")).otherwise(text.zfill(mun.cast("string"), 3))
    said = lambda *parts: F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))
    errors = F.array(
        _error("sex_total", said(male, "+", female, "+", undefined, "=", male + female + undefined, " != ", total), male + female + undefined != total),
        _error("year_range", said("year=", year), ~year.between(*years)),
        _error("month_range", said("month=", month), ~month.between(*months)),
        _error("duplicate", said("Duplicate of line ", F.col("before")), F.col("before").isNotNull()),
        _error("ageeml_missing", said("cvegeo ", F.col("code"), " not in AGEEML"), checked & missing),
        _error("estado_mismatch", said("cve_estado=", estado, " but AGEEML says ", F.col("known_ent")), checked & found & ~estado.eqNullSafe(F.col("known_ent"))),
        _error("mun_mismatch", said("cve_mun=", municipality, " but AGEEML says ", F.col("known_mun")), checked & found & ~municipality.eqNullSafe(F.col("known_mun"))),
    )
    return joined.select(F.explode(F.filter(errors, lambda e: e.isNotNull())).alias("e")).select("e.*")


def schema_error(spark: SparkSession, columns: list[str]) -> DataFrame:
    """One row where the columns are not the published ones in their order."""
    rows = [] if columns == S.TARGET_COLUMNS else [("schema", None, None, f"Expected {S.TARGET_COLUMNS}, got {columns}")]
    return spark.createDataFrame(rows, S.ERROR_SCHEMA)


def first_errors(errors: DataFrame, shown: int = 20, label: str = "file") -> DataFrame:
    """The first errors of each file by line and check, and how many more there are."""
    # top-k by file: Spark keeps k rows of a partition before the shuffle
    order = Window.partitionBy(label).orderBy("line", "check", "detail")
    top = errors.withColumn("place", F.row_number().over(order)).where(F.col("place") <= shown)
    counts = errors.groupBy(label).agg(F.count("*").alias("n_errors"))
    return top.join(counts, label).withColumn("more", F.greatest(F.col("n_errors") - shown, F.lit(0)))


def file_summary(rows: DataFrame, errors: DataFrame, expected: list[str], label: str = "file") -> DataFrame:
    """Rows, persons and errors of each expected file; a missing file or any error is a failure."""
    spark = rows.sparkSession
    names = spark.createDataFrame([(x,) for x in expected], f"{label} string")
    sizes = rows.groupBy(label).agg(F.count("*").alias("n_rows"), F.sum(F.col("total").try_cast("bigint")).alias("persons"))
    counts = errors.groupBy(label).agg(F.count("*").alias("n_errors"))
    joined = names.join(sizes, label, "left").join(counts, label, "left")
    return joined.select(
        label, F.col("n_rows").isNotNull().alias("present"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("persons", F.lit(0)).alias("persons"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
        (F.col("n_rows").isNotNull() & F.col("n_errors").isNull()).alias("passed"),
    )


def verdict(summary: DataFrame, cross: DataFrame) -> DataFrame:
    """One row (files, files_passed, consistent, passed): whether every file passed and the totals agree."""
    files = summary.agg(F.count("*").alias("files"), F.count_if("passed").alias("files_passed"))
    both = files.crossJoin(cross.select("consistent"))  # a row each
    return both.withColumn("passed", (F.col("files") == F.col("files_passed")) & F.col("consistent"))
