"""Registry records, catalog and rules made from the driver's star-schema tables.

Every branch of the resolution is populated at every scale.  The same tables are stated in
SQL as common table expressions for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regivane.functions import text
from regivane.operators import assemble, resolve


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _places(spark, sf_dir)

    def rows(df, shift, prefix, step):
        ent = text.zfill(F.col("n_regionkey") + 1, 2)
        mun = text.zfill(F.col("n_nationkey") + 1 + shift, 3)
        return df.select(F.concat(ent, mun).alias("CVEGEO"), ent.alias("CVE_ENT"), F.col("r_name").alias("NOM_ENT"), mun.alias("CVE_MUN"), F.concat(F.lit(prefix), "n_name").alias("NOM_MUN"), (F.col("n_nationkey") + step).cast("bigint").alias("ordinal"))

    twins = places.where(F.col("n_nationkey").isin(3, 7))
    return rows(places, 0, "Ciudad de ", 0).unionByName(rows(twins, 100, "Ciudad ", 100))


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.build_reference(catalog(spark, sf_dir))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(_places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(*(F.expr(e).alias(n) for n, e in RAW_COLUMNS.items()))


#: Name and expression of each raw column, the same in Spark and DuckDB.
RAW_COLUMNS = {
    "ordinal": "o_orderkey",
    "id_estado": "CAST(CASE WHEN o_orderkey % 50 = 0 THEN 33 WHEN o_orderkey % 37 = 0 THEN (n_regionkey + 1) % 5 + 1 ELSE n_regionkey + 1 END AS BIGINT)",
    "municipio": (
        "CASE WHEN o_orderkey % 41 = 0 THEN 'SE DESCONOCE' WHEN o_orderkey % 43 = 0 THEN 'SIN MUNICIPIO DE REFERENCIA' "
        "WHEN o_orderkey % 37 = 0 THEN 'CIUDAD DE ' || n_name WHEN o_orderkey % 11 = 0 THEN 'CD. ' || n_name "
        "WHEN o_orderkey % 13 = 0 THEN n_name ELSE 'CIUDAD DE NATIÓN_' || CAST(n_nationkey AS STRING) END"
    ),
    "estado": "r_name",
    "anio": "CAST(year(o_orderdate) AS BIGINT)",
    "mes": "CAST(month(o_orderdate) AS BIGINT)",
    "id_estatus_victima": "CAST(CASE o_orderstatus WHEN 'P' THEN 7 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT)",
    "hombres": "CAST(o_orderkey % 3 AS BIGINT)",
    "mujeres": "CAST(o_orderkey % 2 AS BIGINT)",
    "indeterminado": "CAST(CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS BIGINT)",
    "total_personas": "CAST(o_orderkey % 3 + o_orderkey % 2 + CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS BIGINT)",
}


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).where("n_nationkey < 10").select(
        ((F.col("n_regionkey") + 1) % 5 + 1).cast("string").alias("source_id_estado"),
        F.concat(F.lit("CIUDAD DE "), "n_name").alias("raw_municipio"),
        (F.col("n_regionkey") + 1).cast("string").alias("target_cve_estado"),
        F.lit(None).cast("string").alias("target_cve_mun"),
        F.col("n_nationkey").cast("bigint").alias("ordinal"),
    )


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).where("n_nationkey % 5 = 0").select(
        (F.col("n_regionkey") + 1).cast("string").alias("raw_id_estado"),
        F.col("n_name").alias("raw_municipio"),
        F.concat((F.col("n_regionkey") + 1).cast("string"), text.zfill(F.col("n_nationkey") + 1, 3)).alias("cvegeo"),
        F.lit("").alias("notes"),
        F.lit("").alias("source_dataset"),
        F.col("n_nationkey").cast("bigint").alias("ordinal"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated records, normalised; the key has the names as they were read, so fewer are normalised."""
    return resolve.normalize_records(resolve.dedup_records(raw(spark, sf_dir)))


def corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.apply_corrections(records(spark, sf_dir), resolve.correction_rules(corrections(spark, sf_dir)))


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduplicated = resolve.dedup_records(raw(spark, sf_dir))
    return resolve.resolve_by_name(deduplicated, reference(spark, sf_dir), corrections(spark, sf_dir), overrides(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.aggregate_collisions(assemble.assemble(resolved(spark, sf_dir)))


# ---- the same in DuckDB's SQL ----


def norm_sql(x: str) -> str:
    return f"CASE WHEN lower(trim({x})) = 'nan' THEN '' ELSE trim(regexp_replace(regexp_replace(lower(strip_accents({x})), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) END"


def agg_sql(x: str) -> str:
    words = norm_sql(x)
    for short, full in text.ABBREVIATIONS.items():
        words = rf"regexp_replace({words}, '\b{short}\b', '{full}', 'g')"
    return rf"trim(regexp_replace(regexp_replace({words}, '\bde\b', '', 'g'), ' +', ' ', 'g'))"


def round2_sql(x: str) -> str:
    """Two digits of a double, from all digits that it has: the tail decides, an exact half goes to the even digit."""
    written = f"format('{{:.120f}}', abs({x}))"
    head, tail = f"CAST(replace({written}[:-119], '.', '') AS HUGEINT)", f"{written}[-118:]"
    half = "5" + "0" * 117
    up = f"CASE WHEN {tail} > '{half}' OR ({tail} = '{half}' AND {head} % 2 = 1) THEN 1 ELSE 0 END"
    return f"sign({x}) * CAST(CAST({head} + {up} AS DECIMAL(38, 0)) AS DOUBLE) / 100"


_RAW_SQL = ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {n}" for n, e in RAW_COLUMNS.items())

CTE = f"""WITH places AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
catalog AS (
  SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') AS cve_estado, lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS cve_mun, r_name AS nom_ent, 'Ciudad de ' || n_name AS nom_mun, CAST(n_nationkey AS BIGINT) AS ordinal FROM places
  UNION ALL SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey + 101 AS VARCHAR), 3, '0'), r_name, 'Ciudad ' || n_name, CAST(n_nationkey + 100 AS BIGINT) FROM places WHERE n_nationkey IN (3, 7)),
ref AS (SELECT cve_estado || cve_mun AS cvegeo, cve_estado, cve_mun, {norm_sql("nom_ent")} AS state, {norm_sql("nom_mun")} AS municipality, {agg_sql("nom_mun")} AS municipality_agg, ordinal FROM catalog),
corrections AS (SELECT lpad(CAST((n_regionkey + 1) % 5 + 1 AS VARCHAR), 2, '0') AS key_state, 'ciudad de ' || {norm_sql("n_name")} AS key_name, lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') AS target_state FROM places WHERE n_nationkey < 10),
overrides AS (SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') AS key_state, {norm_sql("n_name")} AS key_name, lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS code FROM places WHERE n_nationkey % 5 = 0),
raw AS (SELECT {_RAW_SQL} FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey),
normed AS (SELECT *, {norm_sql("municipio")} AS municipio_norm, {agg_sql("municipio")} AS municipio_norm_agg, {norm_sql("estado")} AS estado_norm, CASE WHEN id_estado = 33 THEN NULL ELSE lpad(CAST(id_estado AS VARCHAR), 2, '0') END AS cve_estado_raw FROM raw),
records AS (SELECT * FROM normed QUALIFY row_number() OVER (PARTITION BY id_estado, municipio, anio, mes, id_estatus_victima ORDER BY ordinal DESC) = 1),
corrected AS (SELECT r.* EXCLUDE (cve_estado_raw), coalesce(c.target_state, r.cve_estado_raw) AS cve_estado_raw, c.target_state IS NOT NULL AS was_corrected FROM records r LEFT JOIN corrections c ON r.cve_estado_raw = c.key_state AND r.municipio_norm = c.key_name),
simple AS (SELECT * FROM ref QUALIFY row_number() OVER (PARTITION BY cve_estado, municipality ORDER BY ordinal) = 1),
aggressive AS (SELECT * FROM ref QUALIFY count(*) OVER (PARTITION BY cve_estado, municipality_agg) = 1),
joined AS (SELECT c.*, coalesce(s.cvegeo, a.cvegeo) AS g0, coalesce(s.cve_estado, a.cve_estado) AS g1, coalesce(s.cve_mun, a.cve_mun) AS g2, coalesce(s.state, a.state) AS g3, coalesce(s.municipality, a.municipality) AS g4,
  CASE WHEN s.cvegeo IS NOT NULL THEN 'simple' WHEN a.cvegeo IS NOT NULL THEN 'aggressive' WHEN c.cve_estado_raw IS NULL THEN 'unknown_state' ELSE 'unmatched' END AS m0
  FROM corrected c LEFT JOIN simple s ON c.cve_estado_raw = s.cve_estado AND c.municipio_norm = s.municipality LEFT JOIN aggressive a ON c.cve_estado_raw = a.cve_estado AND c.municipio_norm_agg = a.municipality_agg),
overridden AS (SELECT j.*, CASE WHEN o.cvegeo IS NULL THEN g0 ELSE o.cvegeo END AS h0, CASE WHEN o.cvegeo IS NULL THEN g1 ELSE o.cve_estado END AS h1, CASE WHEN o.cvegeo IS NULL THEN g2 ELSE o.cve_mun END AS h2, CASE WHEN o.cvegeo IS NULL THEN g3 ELSE o.state END AS h3, CASE WHEN o.cvegeo IS NULL THEN g4 ELSE o.municipality END AS h4,
  CASE WHEN o.cvegeo IS NULL THEN m0 ELSE 'override' END AS m1 FROM joined j LEFT JOIN (SELECT key_state, key_name, r.* FROM overrides JOIN ref r ON code = r.cvegeo) o ON j.m0 = 'unmatched' AND j.cve_estado_raw = o.key_state AND j.municipio_norm = o.key_name),
labelled AS (SELECT *, CASE municipio_norm WHEN 'sin municipio de referencia' THEN '998' WHEN 'se desconoce' THEN '999' END AS lab FROM overridden),
sentinels AS (SELECT *, CASE WHEN id_estado = 33 THEN '99998' WHEN lab IS NOT NULL THEN cve_estado_raw || lab ELSE h0 END AS i0, CASE WHEN id_estado = 33 THEN '99' WHEN lab IS NOT NULL THEN cve_estado_raw ELSE h1 END AS i1,
  CASE WHEN lab IS NOT NULL THEN lab WHEN id_estado = 33 THEN '998' ELSE h2 END AS i2, CASE WHEN id_estado = 33 THEN 'unknown' WHEN lab IS NOT NULL THEN estado_norm ELSE h3 END AS i3, CASE WHEN lab IS NOT NULL THEN municipio_norm WHEN id_estado = 33 THEN NULL ELSE h4 END AS i4,
  CASE WHEN id_estado = 33 THEN 'sentinel_unknown_state' WHEN lab IS NOT NULL THEN 'sentinel_muni_' || lab ELSE m1 END AS m2 FROM labelled),
resolved AS (SELECT *, CASE WHEN m2 = 'unmatched' THEN '99999' ELSE i0 END AS geo_cvegeo, CASE WHEN m2 = 'unmatched' THEN '99' ELSE i1 END AS geo_cve_estado, CASE WHEN m2 = 'unmatched' THEN '999' ELSE i2 END AS geo_cve_mun, CASE WHEN m2 = 'unmatched' THEN 'unresolved' ELSE i3 END AS geo_state, CASE WHEN m2 = 'unmatched' THEN municipio_norm ELSE i4 END AS geo_municipality,
  CASE WHEN m2 = 'unmatched' THEN 'unresolved_state_99' ELSE m2 END AS match_type FROM sentinels),
fact AS (SELECT geo_cvegeo AS cvegeo, n.a AS cve_estado, n.b AS state, n.c AS cve_mun, n.d AS municipality, male, female, undefined, total, year, month, status_id FROM (
  SELECT geo_cvegeo, anio AS year, mes AS month, id_estatus_victima AS status_id, arg_min({{'a': geo_cve_estado, 'b': geo_state, 'c': geo_cve_mun, 'd': geo_municipality}}, ordinal) AS n,
  CAST(sum(hombres) AS BIGINT) AS male, CAST(sum(mujeres) AS BIGINT) AS female, CAST(sum(indeterminado) AS BIGINT) AS undefined, CAST(sum(total_personas) AS BIGINT) AS total FROM resolved GROUP BY ALL))
"""
