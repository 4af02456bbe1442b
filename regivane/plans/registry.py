"""The registry run from files to files: records, catalog and rules in, published tables and reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.operators import acquire, assemble, audit, quality, resolve
from regivane.sources import readers, sinks
from regivane.storage import fixed


def load_records(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All datasets as one table with a ``dataset`` column; keys never cross datasets."""
    return acquire.union_months([readers.read_records(spark, path).withColumn("dataset", F.lit(name)) for name, path in paths.items()])


def process(records: DataFrame, catalog: DataFrame, corrections: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fact, discrepancies) of all datasets in one plan; discrepancies are taken before corrections."""
    ref = resolve.build_reference(catalog)
    deduped = resolve.dedup_records(records, "dataset")
    fact = assemble.aggregate_collisions(assemble.assemble(resolve.resolve_by_name(deduped, ref, corrections, overrides)))
    return fact, quality.discrepancies(resolve.normalize_records(deduped), ref)


def run(spark: SparkSession, paths: dict[str, str], catalog: str, corrections: str, overrides: str, out: str, total: str = "total") -> dict[str, DataFrame]:
    """Write ``<out>/<dataset>.csv`` folders, the quality report and the discrepancies; return all tables."""
    tables = readers.read_catalog(spark, catalog), readers.read_corrections(spark, corrections), readers.read_overrides(spark, overrides)
    fact, issues = process(load_records(spark, paths), *tables)
    fact, issues = fixed(fact, "fact"), fixed(issues, "discrepancies")
    for name in paths:
        sinks.write_sorted_csv(fact.where(F.col("dataset") == name).select(*S.TARGET_COLUMNS), f"{out}/{name}.csv", *assemble.OUTPUT_ORDER)
    report = quality.quality_report(fact)
    sinks.write_csv(report, f"{out}/quality_report.csv")
    sinks.write_discrepancies(issues, f"{out}/discrepancies.csv", list(paths))
    return {"fact": fact, "quality": report, "discrepancies": issues, "cross_status": quality.cross_status(fact, total)}


def audit_files(spark: SparkSession, out: str, datasets: list[str], catalog: str) -> tuple[DataFrame, DataFrame]:
    """(errors, summary) of the published files; a file that is missing fails."""
    known = readers.clean_audit_catalog(readers.read_catalog(spark, catalog))
    errors, rows = [], []
    for name in datasets:
        try:
            table = readers.read_fact_text(spark, f"{out}/{name}.csv")
        except readers.AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                continue
            raise
        columns = [c for c in table.columns if c != "line"]
        errors.append(audit.schema_error(spark, columns).withColumn("file", F.lit(name)))
        if set(S.TARGET_COLUMNS) <= set(columns):
            errors.append(audit.audit_rows(table, known).withColumn("file", F.lit(name)))
        rows.append(table.select(F.lit(name).alias("file"), F.col("total") if "total" in columns else F.lit(None).cast("string").alias("total")))
    empty = spark.createDataFrame([], S.ERROR_SCHEMA).withColumn("file", F.lit(""))
    all_errors = acquire.union_months([empty, *errors])
    all_rows = acquire.union_months([spark.createDataFrame([], "file string, total string"), *rows])
    return all_errors, audit.file_summary(all_rows, all_errors, datasets)


def audit_run(spark: SparkSession, out: str, datasets: list[str], catalog: str, total: str = "total") -> DataFrame:
    """One row that says whether every published file passes and the total agrees with the others."""
    errors, summary = audit_files(spark, out, datasets, catalog)
    found = fixed(summary, "audit-summary")
    totals = found.select(F.col("file").alias("dataset"), F.col("persons").alias("total"))
    return audit.verdict(found, quality.cross_status(totals, total))
