"""From resolved records to the published fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.functions import text

_COUNTS = ["male", "female", "undefined", "total"]
_NAMES = ["cve_estado", "state", "cve_mun", "municipality"]


def assemble(resolved: DataFrame) -> DataFrame:
    """Rename, pad and type the columns; ``ordinal`` and any dataset label stay beside them."""
    beside = [c for c in ("dataset", "ordinal") if c in resolved.columns]
    return resolved.select(
        text.pad_code(F.col("geo_cvegeo"), 5).alias("cvegeo"),
        text.pad_code(F.col("geo_cve_estado"), 2).alias("cve_estado"),
        F.col("geo_state").alias("state"),
        text.pad_code(F.col("geo_cve_mun"), 3).alias("cve_mun"),
        F.col("geo_municipality").alias("municipality"),
        *(F.col(a).cast("bigint").alias(b) for a, b in (("hombres", "male"), ("mujeres", "female"), ("indeterminado", "undefined"), ("total_personas", "total"), ("anio", "year"), ("mes", "month"), ("id_estatus_victima", "status_id"))),
        *beside,
    )


def aggregate_collisions(fact: DataFrame, order: str = "ordinal", n_rows: bool = False) -> DataFrame:
    """One row a key: counts summed (null: 0), all names from the first row; null keys form a group.

    ``n_rows`` adds how many rows a key has.
    """
    keys = [*(["dataset"] if "dataset" in fact.columns else []), *S.FACT_KEY]
    summed = fact.groupBy(*keys).agg(F.min_by(F.struct(*_NAMES), order).alias("names"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS), F.count("*").alias("n_rows"))
    flat = summed.select(*keys, *(F.col(f"names.{c}").alias(c) for c in _NAMES), *_COUNTS, "n_rows")
    return flat.select(*(["dataset"] if "dataset" in fact.columns else []), *S.TARGET_COLUMNS, *(["n_rows"] if n_rows else []))


#: The order of a published table; the status, which parts equal places and months, makes it whole.
OUTPUT_ORDER = ["cvegeo", "year", "month", "status_id"]
