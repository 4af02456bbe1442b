"""Quality report, discrepancy listing and cross-status consistency."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.functions import text


def quality_report(fact: DataFrame, label: str = "dataset", years: tuple[int, int] = S.YEARS, months: tuple[int, int] = S.MONTHS) -> DataFrame:
    """One row of ten metrics for each value of the ``label`` column.

    ``duplicates`` are rows beyond the first of a key, among rows with a code; comparisons
    with null are not counted.
    """
    columns = [c for c in fact.columns if c != label]
    coded = F.col("cvegeo").isNotNull()
    # first by key, so that the distinct count needs no rows of a whole dataset in one place
    by_key = fact.groupBy(label, *S.FACT_KEY).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("state").isNull()).alias("missing_state"),
        F.count_if(F.col("male") + F.col("female") + F.col("undefined") != F.col("total")).alias("mismatch"),
    )
    n = F.col("n")
    report = by_key.groupBy(F.col(label).alias("dataset")).agg(
        F.sum(n).alias("total_rows"),
        F.sum(F.when(~coded, n).otherwise(0)).alias("missing_cvegeo"),
        F.sum("missing_state").alias("missing_state"),
        F.sum(F.when(coded, n - 1).otherwise(0)).alias("duplicates"),
        F.sum(F.when(~F.col("year").between(*years), n).otherwise(0)).alias("invalid_year"),
        F.sum(F.when(~F.col("month").between(*months), n).otherwise(0)).alias("invalid_month"),
        F.sum("mismatch").alias("sex_total_mismatch"),
    )
    return report.select(
        "dataset",
        F.lit(columns == S.TARGET_COLUMNS).alias("schema_ok"),
        "total_rows", "missing_cvegeo", "missing_state", "duplicates", "invalid_year", "invalid_month", "sex_total_mismatch",
        text.percent(F.col("total_rows") - F.col("missing_cvegeo"), F.col("total_rows")).alias("match_rate_pct"),
    )


def discrepancies(records: DataFrame, ref: DataFrame, dataset: str | None = None) -> DataFrame:
    """Municipalities whose name the catalog knows only elsewhere, or that stand under the unknown state.

    Measured on normalised records before any correction; null group keys are left out.
    """
    under = ref.where("municipality IS NOT NULL").groupBy(F.col("municipality").alias("known")).agg(text.list_text(F.collect_set("cve_estado")).alias("states"))
    pairs = ref.select(F.col("cve_estado").alias("valid_state"), F.col("municipality").alias("valid_name")).distinct()
    keys = ["id_estado", "municipio", "municipio_norm"]
    label = ["dataset"] if dataset is None and "dataset" in records.columns else []
    source = records.where("id_estado IS NOT NULL AND municipio IS NOT NULL AND municipio_norm IS NOT NULL")
    grouped = source.groupBy(*label, *keys, "cve_estado_raw").agg(F.count("*").alias("row_count"), F.coalesce(F.sum("total_personas"), F.lit(0)).cast("bigint").alias("total_persons"))
    unknown = grouped.where(F.col("id_estado") == S.UNKNOWN_STATE_ID).join(under, F.col("municipio_norm") == F.col("known"), "left")
    unknown = unknown.select(
        *label, *keys, "row_count", "total_persons",
        F.when(F.col("known").isNotNull(), "possible_wrong_state").otherwise("unknown_state").alias("issue_type"),
        F.when(F.col("known").isNotNull(), F.concat(F.lit("id_estado=33 but '"), "municipio", F.lit("' exists under "), "states")).otherwise("id_estado=33; municipio not in AGEEML").alias("notes"),
    )
    known = grouped.where((F.col("id_estado") != S.UNKNOWN_STATE_ID) & F.col("cve_estado_raw").isNotNull())
    known = known.join(pairs, (F.col("cve_estado_raw") == F.col("valid_state")) & (F.col("municipio_norm") == F.col("valid_name")), "left_anti")
    known = known.join(under, F.col("municipio_norm") == F.col("known")).select(
        *label, *keys, "row_count", "total_persons",
        F.lit("possible_wrong_state").alias("issue_type"),
        F.concat(F.lit("Not under estado "), "cve_estado_raw", F.lit("; found under "), "states").alias("notes"),
    )
    both = unknown.unionByName(known)
    named = F.col("dataset") if label else F.lit(dataset)
    return both.select(named.alias("dataset"), "id_estado", F.col("municipio").alias("municipio_raw"), "municipio_norm", "row_count", "total_persons", "issue_type", "notes")


def report_order(datasets: list[str]) -> list[Column]:
    """Datasets as given, the unknown state first, then by state and name."""
    place = F.array_position(F.array(*(F.lit(d) for d in datasets)), F.col("dataset"))
    return [place, F.col("id_estado") != S.UNKNOWN_STATE_ID, F.col("id_estado"), F.col("municipio_raw"), F.col("municipio_norm")]


def in_report_order(rows: DataFrame, datasets: list[str]) -> DataFrame:
    return rows.orderBy(*report_order(datasets))


def cross_status(totals: DataFrame, total: str, label: str = "dataset", persons: str = "total", limit_pct: float = 1.0) -> DataFrame:
    """Persons of the total dataset against the sum of all others, with both shares in use.

    ``pipeline_pct`` is relative to the sum of the parts, ``audit_pct`` to the total; both are
    0 where that is 0.
    """
    sums = totals.agg(
        F.coalesce(F.sum(F.when(F.col(label) == total, F.col(persons))), F.lit(0)).cast("bigint").alias("total_persons"),
        F.coalesce(F.sum(F.when(F.col(label) != total, F.col(persons))), F.lit(0)).cast("bigint").alias("sub_persons"),
    )
    diff = F.col("total_persons") - F.col("sub_persons")
    share = lambda whole: F.coalesce(F.try_divide(F.abs(diff).cast("double"), F.col(whole).cast("double")) * 100, F.lit(0.0))
    return sums.select("total_persons", "sub_persons", diff.alias("difference"), share("sub_persons").alias("pipeline_pct"), share("total_persons").alias("audit_pct"), (share("total_persons") <= limit_pct).alias("consistent"))


def match_type_counts(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("match_type").agg(F.count("*").alias("n_rows"))


class StageCounts:
    """Rows that pass each stage of a plan, observed while the plan runs once."""

    def __init__(self):
        self.stages: dict[str, Observation] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, observed under ``name``."""
        self.stages[name] = Observation()
        return df.observe(self.stages[name], F.count(F.lit(1)).alias("n_rows"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, n_rows), once an action has run the plan."""
        return spark.createDataFrame([(name, seen.get["n_rows"]) for name, seen in self.stages.items()], "stage string, n_rows bigint")


def log_counts(counts: DataFrame, log: logging.Logger) -> None:
    """One line a stage to a logger, whose handlers decide between file and console."""
    for row in counts.collect():
        log.info("%s: %s rows", row["stage"], f"{row['n_rows']:,}")
