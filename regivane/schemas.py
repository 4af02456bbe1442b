"""Schemas, dimensions and sentinel codes of the registry data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_TEXT, _LONG = T.StringType(), T.LongType()

# Names, types and order of the columns of each table.
RAW_SCHEMA = _schema(
    ("municipio", _TEXT),
    ("hombres", _LONG),
    ("mujeres", _LONG),
    ("indeterminado", _LONG),
    ("total_personas", _LONG),
    ("id_estado", _LONG),
    ("estado", _TEXT),
    ("anio", _LONG),
    ("mes", _LONG),
    ("id_estatus_victima", _LONG),
)
CATALOG_SCHEMA = _schema(("CVEGEO", _TEXT), ("CVE_ENT", _TEXT), ("NOM_ENT", _TEXT), ("CVE_MUN", _TEXT), ("NOM_MUN", _TEXT))
CORRECTIONS_SCHEMA = _schema(("source_id_estado", _TEXT), ("raw_municipio", _TEXT), ("target_cve_estado", _TEXT), ("target_cve_mun", _TEXT))
OVERRIDES_SCHEMA = _schema(("raw_id_estado", _TEXT), ("raw_municipio", _TEXT), ("cvegeo", _TEXT), ("notes", _TEXT), ("source_dataset", _TEXT))
FACT_SCHEMA = _schema(
    ("cvegeo", _TEXT),
    ("cve_estado", _TEXT),
    ("state", _TEXT),
    ("cve_mun", _TEXT),
    ("municipality", _TEXT),
    ("male", _LONG),
    ("female", _LONG),
    ("undefined", _LONG),
    ("total", _LONG),
    ("year", _LONG),
    ("month", _LONG),
    ("status_id", _LONG),
)
QUALITY_SCHEMA = _schema(
    ("dataset", _TEXT),
    ("schema_ok", T.BooleanType()),
    ("total_rows", _LONG),
    ("missing_cvegeo", _LONG),
    ("missing_state", _LONG),
    ("duplicates", _LONG),
    ("invalid_year", _LONG),
    ("invalid_month", _LONG),
    ("sex_total_mismatch", _LONG),
    ("match_rate_pct", T.DoubleType()),
)
DISCREPANCY_SCHEMA = _schema(
    ("dataset", _TEXT),
    ("id_estado", _LONG),
    ("municipio_raw", _TEXT),
    ("municipio_norm", _TEXT),
    ("row_count", _LONG),
    ("total_persons", _LONG),
    ("issue_type", _TEXT),
    ("notes", _TEXT),
)
ERROR_SCHEMA = _schema(("check", _TEXT), ("line", _LONG), ("cvegeo", _TEXT), ("detail", _TEXT))
TARGET_COLUMNS = FACT_SCHEMA.names

GEO_COLUMNS = ["geo_cvegeo", "geo_cve_estado", "geo_cve_mun", "geo_state", "geo_municipality"]
RECORD_KEY = ["id_estado", "municipio", "anio", "mes", "id_estatus_victima"]
FACT_KEY = ["cvegeo", "year", "month", "status_id"]

# The sentinel codes of the output format.
UNKNOWN_STATE_ID = 33
UNKNOWN_STATE_CVEGEO, UNKNOWN_STATE_CODE, UNKNOWN_STATE_NAME = "99998", "99", "unknown"
UNRESOLVED_CVEGEO, UNRESOLVED_MUN, UNRESOLVED_NAME = "99999", "999", "unresolved"
SENTINEL_MUNICIPALITIES = {"sin municipio de referencia": "998", "se desconoce": "999"}
SENTINEL_CVEGEO = ("99998", "99999")
SENTINEL_CVE_MUN = (998, 999)
CATALOG_NULLS = ("----", "---", "--", "-")
# Fields that table readers take for null, and the least size of a file of rules.
TABLE_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
LEAST_RULE_BYTES = 10
YEARS, MONTHS = (2015, 2025), (1, 12)

# Victim status by id, with the title that a request carries.
STATUSES = {
    0: ("total", "PERSONAS DESAPARECIDAS, NO LOCALIZADAS Y LOCALIZADAS"),
    7: ("desaparecidas_no_localizadas", "PERSONAS DESAPARECIDAS Y NO LOCALIZADAS"),
    2: ("localizadas_con_vida", "PERSONAS LOCALIZADAS CON VIDA"),
    3: ("localizadas_sin_vida", "PERSONAS LOCALIZADAS SIN VIDA"),
}

# State names by id, 1 to 33.
STATES = (
    "Aguascalientes",
    "Baja California",
    "Baja California Sur",
    "Campeche",
    "Coahuila",
    "Colima",
    "Chiapas",
    "Chihuahua",
    "Ciudad de México",
    "Durango",
    "Guanajuato",
    "Guerrero",
    "Hidalgo",
    "Jalisco",
    "México",
    "Michoacán",
    "Morelos",
    "Nayarit",
    "Nuevo León",
    "Oaxaca",
    "Puebla",
    "Querétaro",
    "Quintana Roo",
    "San Luis Potosí",
    "Sinaloa",
    "Sonora",
    "Tabasco",
    "Tamaulipas",
    "Tlaxcala",
    "Veracruz",
    "Yucatán",
    "Zacatecas",
    "Se desconoce",
)

#: Output datasets in their order: label and status; the first is the total of the others.
DATASETS = {"total": 0, "disappeared_not_located": 7, "located_alive": 2, "located_dead": 3}


def state_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(STATES, start=1)), "id_estado bigint, estado string")


def status_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, name, title) for k, (name, title) in STATUSES.items()], "status_id bigint, name string, title string")
