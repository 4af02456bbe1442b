"""Summary tables behind the published charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.functions import text

_SEXES = ["male", "female", "undefined"]
_SENTINEL_PLACE = "^[0-9]{2}(998|999)$"


def monthly_trend(fact: DataFrame) -> DataFrame:
    """National counts a month by sex, dated to its middle; the two codes without a place are left out."""
    placed = fact.where(~F.col("cvegeo").isin(*S.SENTINEL_CVEGEO) | F.col("cvegeo").isNull())
    sums = placed.groupBy("year", "month").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SEXES))
    return sums.withColumn("date", text.mid_month(F.col("year").cast("int"), F.col("month").cast("int"))).orderBy("date")


def state_distribution(fact: DataFrame, order: str = "ordinal", legacy_int_codes: bool = False) -> DataFrame:
    """Counts by state code and sex under the state's first name in file order, least total first.

    Sentinel codes are left out.  ``legacy_int_codes`` reads codes as numbers, as a tool that
    loses leading zeros would: sentinels of states 01 to 09 then stay.
    """
    code = F.col("cvegeo").cast("bigint").cast("string") if legacy_int_codes else F.col("cvegeo")
    placed = fact.where(~F.coalesce(code.isin(*S.SENTINEL_CVEGEO) | code.rlike(_SENTINEL_PLACE), F.lit(False)) & F.col("cve_estado").isNotNull())
    name = F.min_by(F.col("state"), F.when(F.col("state").isNotNull(), F.col(order)))
    sums = placed.groupBy("cve_estado").agg(name.alias("state"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SEXES))
    total = F.col("male") + F.col("female") + F.col("undefined")
    return sums.select("cve_estado", text.title(F.col("state")).alias("state"), *_SEXES, total.alias("total")).orderBy("total", "cve_estado")
