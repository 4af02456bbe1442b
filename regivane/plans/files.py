"""Queries that go through the readers and sinks: files are written to the shared folder and read back."""

from __future__ import annotations

import contextlib
import functools
import json
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane import schemas as S
from regivane.operators import acquire, assemble, audit, quality, resolve
from regivane.plans import registry
from regivane.plans import synthetic as syn
from regivane.sources import delimited, months, readers, requests, sinks
from regivane.storage import fixed, shared_path
from regivane.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register a query under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


_RAW = ", ".join(S.RAW_SCHEMA.names)
_FACT = ", ".join(S.FACT_SCHEMA.names)


@query(syn.CTE + f"SELECT {_RAW} FROM records")
def records_from_parquet(spark, sf_dir):
    """Records read from Parquet files; of equal keys the last by file name and row stays."""
    path = shared_path(spark, "records.parquet")
    syn.raw(spark, sf_dir).orderBy("ordinal").select(S.RAW_SCHEMA.names).write.parquet(path)
    return resolve.dedup_records(readers.read_records(spark, path)).select(S.RAW_SCHEMA.names)


@query(syn.CTE + f"SELECT {_RAW} FROM raw QUALIFY row_number() OVER (PARTITION BY id_estado, municipio, anio, mes, id_estatus_victima ORDER BY ordinal % 2 DESC, ordinal DESC) = 1")
def records_from_monthly_csv(spark, sf_dir):
    """CSV files in the order of their names, so that the later file's rows win; consolidated to Parquet and read again."""
    root = shared_path(spark, "monthly")
    for name, half in (("01", 0), ("02", 1)):
        sinks.write_csv(syn.raw(spark, sf_dir).where(F.col("ordinal") % 2 == half).orderBy("ordinal").select(S.RAW_SCHEMA.names), f"{root}/{name}.csv", single_file=False)
    whole = shared_path(spark, "consolidated.parquet")
    sinks.consolidate(readers.read_monthly(spark, f"{root}/*.csv"), whole)
    return resolve.dedup_records(readers.read_records(spark, whole)).select(S.RAW_SCHEMA.names)


@query(syn.CTE + "SELECT anio, mes, id_estatus_victima, count(*) AS n_rows, CAST(sum(total_personas) AS BIGINT) AS persons FROM raw GROUP BY ALL")
def months_written_once(spark, sf_dir):
    """Months of a status that the folder has are passed over, however often they are written."""
    folder = shared_path(spark, "months")
    raw = syn.raw(spark, sf_dir).select(S.RAW_SCHEMA.names)
    for part in (raw.where("mes <= 6"), raw.where("id_estatus_victima = 2"), raw):
        sinks.write_new_months(part, folder)
    return spark.read.parquet(folder).groupBy(*(F.col(c).cast("bigint").alias(c) for c in sinks.MONTH_KEY)).agg(F.count("*").alias("n_rows"), F.sum("total_personas").alias("persons"))


#: A file in the usual shape, one with its columns in another order, one that lacks two, one with a column more.
_SHAPES = {1: S.RAW_SCHEMA.names, 2: S.RAW_SCHEMA.names[::-1], 3: [c for c in S.RAW_SCHEMA.names if c not in ("estado", "indeterminado")], 4: [*S.RAW_SCHEMA.names[5:], "extra", *S.RAW_SCHEMA.names[:5]]}


def _differing_files(spark, sf_dir) -> str:
    """A folder of monthly files by month; months 5 and 6 cannot be read, 7 is a header alone, 8 has no byte."""
    root = shared_path(spark, "differing")
    raw = syn.raw(spark, sf_dir).where("mes <= 6").withColumn("extra", F.lit("x"))
    # every ninth name has a line break in it
    raw = raw.withColumn("municipio", F.when(F.col("ordinal") % 9 == 0, F.concat("municipio", F.lit('\n"x",'))).otherwise(F.col("municipio")))
    for month, names in _SHAPES.items():
        raw.where(f"mes = {month}").select(names).repartition(2).write.option("header", True).option("escape", '"').csv(f"{root}/{month}.csv")
    own = raw.where("mes >= 5").select(F.concat_ws(",", F.lit("a"), "municipio", F.col("total_personas").cast("string")).alias("value"), "mes")
    header = spark.range(1).select(F.lit("municipio,total_personas").alias("value"))
    for month in (5, 6):  # rows of three fields below a header of two, and quotes that never close
        rows = own.where(f"mes = {month}").select("value") if month == 5 else header.select(F.lit('"open,1').alias("value"))
        header.unionByName(rows).coalesce(1).write.text(f"{root}/{month}.csv")
    header.coalesce(1).write.text(f"{root}/7.csv")
    header.limit(0).coalesce(1).write.text(f"{root}/8.csv")
    return root


_BROKEN = "CASE WHEN ordinal % 9 = 0 THEN municipio || chr(10) || '\"x\",' ELSE municipio END"


@query(
    syn.CTE + f"SELECT {_BROKEN} AS municipio, hombres, mujeres, CASE WHEN mes <> 3 THEN indeterminado END AS indeterminado, total_personas, id_estado, CASE WHEN mes <> 3 THEN estado END AS estado, anio, mes, id_estatus_victima FROM raw WHERE mes <= 4"
)
def monthly_files_by_name(spark, sf_dir):
    """Files that differ in the order and number of their columns; broken ones are passed over alone."""
    return readers.read_monthly(spark, f"{_differing_files(spark, sf_dir)}/*.csv").drop("ordinal")


@query(
    syn.CTE + "SELECT CAST(mes AS VARCHAR) AS month, 'read' AS status, count(*) AS n_rows FROM raw WHERE mes <= 4 GROUP BY mes "
    "UNION ALL SELECT * FROM (VALUES ('5', 'unreadable', CAST(0 AS BIGINT)), ('6', 'unreadable', 0), ('7', 'read', 0), ('8', 'empty', 0))"
)
def monthly_file_status(spark, sf_dir):
    """What became of each file, months with several files together."""
    status = readers.monthly_tables(spark, f"{_differing_files(spark, sf_dir)}/*.csv").status
    return status.groupBy(F.regexp_extract("file", r"/([0-9]+)\.csv/", 1).alias("month"), "status").agg(F.sum("n_rows").alias("n_rows"))


@query(
    syn.CTE.rstrip() + f", published AS (SELECT *, CASE WHEN male % 3 = 1 THEN municipality || chr(10) || 'a,' || chr(10) || '\"b\"' ELSE municipality END AS broken FROM fact) "
    "SELECT cvegeo, year, month, status_id, broken AS municipality, row_number() OVER w + 1 AS line, CAST(1 + row_number() OVER w + 2 * coalesce(sum(CAST(municipality <> broken AS INTEGER)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS physical_line FROM published WINDOW w AS (ORDER BY cvegeo, year, month, status_id)"
)
def csv_line_breaks(spark, sf_dir):
    """A record whose fields hold line breaks is one row; ``line`` counts records, ``physical_line`` the file's lines."""
    path = shared_path(spark, "breaks.csv")
    broken = F.when(F.col("male") % 3 == 1, F.concat("municipality", F.lit('\na,\n"b"'))).otherwise(F.col("municipality"))
    fact = syn.fact(spark, sf_dir).orderBy("cvegeo", "year", "month", "status_id").withColumn("municipality", broken)
    fact.select(S.TARGET_COLUMNS).coalesce(1).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    names = ["cvegeo", "year", "month", "status_id", "municipality"]
    found = delimited.typed(delimited.read(spark, path, names).rows, T.StructType([S.FACT_SCHEMA[n] for n in names]))
    return found.select(*names, "line", "physical_line")


@query(
    syn.CTE + "SELECT anio, mes, id_estatus_victima, count(*) AS n_rows, CAST(sum(total_personas) AS BIGINT) AS persons, CASE WHEN mes <= 6 THEN 'first' ELSE 'last' END AS loaded, CAST(0 AS BIGINT) AS after_failure FROM raw GROUP BY ALL"
)
def months_committed(spark, sf_dir):
    """A load that fails leaves nothing, one that is repeated adds only what is not there; ``loaded`` is told by the names."""
    folder = shared_path(spark, "committed")
    raw = fixed(syn.raw(spark, sf_dir).select(S.RAW_SCHEMA.names), "raw")
    broken = raw.withColumn("municipio", F.when(F.col("mes") == 9, F.raise_error(F.lit("no such month"))).otherwise(F.col("municipio")))
    with contextlib.suppress(PySparkException):
        months.add_months(broken, folder)
    failed = months.manifests(spark, folder).count()
    for name, part in (("first", raw.where("mes <= 6")), ("first", raw.where("id_estatus_victima = 2 AND mes <= 6")), ("last", raw)):
        months.add_months(part.withColumn("municipio", F.lit(name)), folder)
    sums = months.read_months(spark, folder).groupBy(*months.MONTH_KEY).agg(F.count("*").alias("n_rows"), F.sum("total_personas").alias("persons"), F.max("municipio").alias("loaded"))
    return sums.withColumn("after_failure", F.lit(failed).cast("bigint"))


#: The state, month and status that a customer's page belongs to.
_PLACED = "c_nationkey + 1 AS id_estado, CAST(CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 7 WHEN 2 THEN 2 ELSE 3 END AS BIGINT) AS status_id, CAST(2015 + c_custkey % 3 AS BIGINT) AS year, CAST(1 + c_custkey % 12 AS BIGINT) AS month"
_ASKED = "year = 2016 AND status_id IN (7, 2, 3) AND month >= 3"


@query(
    f"WITH placed AS (SELECT c_custkey, {_PLACED} FROM customer), "
    "asked AS (SELECT s AS status_id, m AS month, e AS id_estado FROM (SELECT unnest([7, 2, 3]) AS s), (SELECT unnest(range(3, 13)) AS m), (SELECT unnest(range(1, 34)) AS e) WHERE NOT (s = 7 AND m = 5)), "
    "pages AS (SELECT status_id, month, id_estado, count(*) FILTER (id_estado % 5 <> 0) AS n, sum(c_custkey) FILTER (id_estado % 5 <> 0) AS persons FROM placed WHERE year = 2016 GROUP BY ALL), "
    "tried AS (SELECT a.*, p.n, p.persons, CASE WHEN p.id_estado IS NULL OR a.id_estado % 5 = 0 THEN 4 WHEN a.id_estado % 5 = 1 THEN 3 ELSE 1 END AS attempts FROM asked a LEFT JOIN pages p USING (status_id, month, id_estado)) "
    "SELECT CAST(status_id AS BIGINT) AS status_id, CAST(month AS BIGINT) AS month, count(*) AS n_requests, CAST(sum(attempts) AS BIGINT) AS attempts, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, CAST(coalesce(sum(persons), 0) AS BIGINT) AS persons FROM tried GROUP BY ALL"
)
def acquired_months(spark, sf_dir):
    """Responses of the months that filters leave and that are not there, asked for again after failures.

    The service answers from files; those of every fifth state never answer, those of the next one
    fail twice, once without a connection.
    """
    folder = shared_path(spark, "responses")
    placed = syn.table(spark, sf_dir, "customer").selectExpr("c_custkey", *_PLACED.replace("c_nationkey + 1 AS", "CAST(c_nationkey + 1 AS BIGINT) AS").split(", "))
    row = F.concat(F.lit("<tr><td>"), F.col("c_custkey").cast("string"), F.lit("</td><td>0</td><td>"), F.col("c_custkey").cast("string"), F.lit("</td><td>0</td></tr>"))
    pages = placed.groupBy("status_id", "year", "month", "id_estado").agg(F.to_json(F.struct(F.array_join(F.collect_list(row), "").alias("Html"))).alias("body"))
    answer = lambda status, body: F.struct(F.lit(status).alias("status"), body.alias("body"))
    good = answer(200, F.col("body"))
    state = F.col("id_estado") % 5
    answers = F.when(state == 0, F.array(answer(500, F.lit("busy")))).when(state == 1, F.array(answer(0, F.lit("")), answer(200, F.lit("no json")), good)).otherwise(F.array(good))
    pages.select("status_id", "year", "month", "id_estado", answers.alias("answers")).write.partitionBy("status_id", "year", "month").json(folder)
    there = spark.createDataFrame([(7, 2016, 5)], "status_id bigint, year bigint, month bigint")
    before = spark.conf.get(requests.PUSHDOWN, None)
    spark.conf.set(requests.PUSHDOWN, "true")
    try:
        asked = fixed(requests.responses(spark, functools.partial(requests.StoredResponses, folder), there, pause=0.0).where(_ASKED), "responses")
    finally:
        spark.conf.unset(requests.PUSHDOWN) if before is None else spark.conf.set(requests.PUSHDOWN, before)
    rows = acquire.records_from_responses(asked).groupBy(F.col("id_estatus_victima").alias("status_id"), F.col("mes").alias("month")).agg(F.count("*").alias("n_rows"), F.sum("total_personas").alias("persons"))
    sums = asked.groupBy("status_id", "month").agg(F.count("*").alias("n_requests"), F.sum("attempts").cast("bigint").alias("attempts"))
    return sums.join(rows, ["status_id", "month"], "left").select("status_id", "month", "n_requests", "attempts", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "persons")))


@query(syn.CTE + f"SELECT {_RAW} FROM raw QUALIFY row_number() OVER (PARTITION BY id_estado, municipio, anio, mes, id_estatus_victima ORDER BY ordinal % 3 DESC, ordinal DESC) = 1")
def last_versions_incremental(spark, sf_dir):
    """A1 under C2: files that arrive in any order leave what a run over all of them leaves; the last by name comes first here."""
    incoming, versions = shared_path(spark, "incoming"), shared_path(spark, "versions")
    raw = fixed(syn.raw(spark, sf_dir), "raw")
    for arrival, third in enumerate((2, 0, 1)):
        staged = shared_path(spark, "file")
        raw.where(F.col("ordinal") % 3 == third).orderBy("ordinal").select(S.RAW_SCHEMA.names).coalesce(1).write.parquet(staged)
        sinks.move_file(spark, staged, f"{incoming}/{third}.parquet")
        load = incremental.load_last_versions(spark, incoming, versions, f"{versions}-checkpoint") if arrival != 1 else None  # the second waits for the third
        if load:
            load.awaitTermination()
    return incremental.last_versions(spark, versions)


_ACCENTED = "replace(nom_mun, 'Ciudad', 'Ciudád')"


@query(syn.CTE + f"SELECT cve_estado || cve_mun AS \"CVEGEO\", cve_estado AS \"CVE_ENT\", CASE WHEN ordinal % 5 = 0 THEN NULL ELSE nom_ent END AS \"NOM_ENT\", cve_mun AS \"CVE_MUN\", {_ACCENTED} AS \"NOM_MUN\", row_number() OVER (ORDER BY ordinal) AS place FROM catalog")
def catalog_from_csv(spark, sf_dir):
    """An ISO-8859-1 file with its columns in another order and tokens for null; ``place`` is the file order."""
    path = shared_path(spark, "catalog.csv")
    _write_catalog(syn.catalog(spark, sf_dir).withColumns({"NOM_ENT": F.when(F.col("ordinal") % 5 == 0, "---").otherwise(F.col("NOM_ENT")), "NOM_MUN": F.replace("NOM_MUN", F.lit("Ciudad"), F.lit("Ciudád"))}), path)
    read = readers.read_catalog(spark, path)
    return readers.number_lines(read, "ordinal", name="place", first=1).select(*S.CATALOG_SCHEMA.names, "place")


def _write_catalog(catalog: DataFrame, path: str) -> None:
    ordered = catalog.orderBy("ordinal").select("NOM_MUN", "CVEGEO", "CVE_MUN", "CVE_ENT", "NOM_ENT")
    ordered.coalesce(1).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)


@query(syn.CTE + "SELECT match_type, count(*) AS n_rows FROM resolved GROUP BY match_type")
def rules_from_csv(spark, sf_dir):
    """Corrections and overrides read as text, in file order, and applied."""
    paths = []
    for name, rules, schema in (("corrections", syn.corrections(spark, sf_dir), S.CORRECTIONS_SCHEMA), ("overrides", syn.overrides(spark, sf_dir), S.OVERRIDES_SCHEMA)):
        paths.append(shared_path(spark, f"{name}.csv"))
        sinks.write_csv(rules.orderBy("ordinal").select(schema.names), paths[-1])
    rules = readers.read_corrections(spark, paths[0]), readers.read_overrides(spark, paths[1])
    return quality.match_type_counts(resolve.resolve(syn.records(spark, sf_dir), syn.reference(spark, sf_dir), *rules))


@query(syn.CTE + f"SELECT {_FACT} FROM fact")
def fact_from_csv(spark, sf_dir):
    """The published table written in its order and read with its types; codes keep their zeros."""
    path = shared_path(spark, "fact.csv")
    sinks.write_sorted_csv(syn.fact(spark, sf_dir).select(S.TARGET_COLUMNS), path, *assemble.OUTPUT_ORDER)
    return readers.read_fact(spark, path)


@query(syn.CTE + f"SELECT row_number() OVER (ORDER BY cvegeo, year, month, status_id) + 1 AS line, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in S.FACT_SCHEMA.names)} FROM fact")
def fact_lines_from_csv(spark, sf_dir):
    """The published table as text with the lines of its file."""
    path = shared_path(spark, "fact.csv")
    sinks.write_sorted_csv(syn.fact(spark, sf_dir).select(S.TARGET_COLUMNS), path, *assemble.OUTPUT_ORDER)
    return readers.read_fact_text(spark, path)


_LABELLED = "SELECT CASE status_id WHEN 7 THEN 'disappeared_not_located' WHEN 2 THEN 'located_alive' ELSE 'located_dead' END AS dataset, fact.* FROM fact"


@query(
    syn.CTE.rstrip() + f", labelled_fact AS ({_LABELLED}) SELECT dataset, true AS schema_ok, count(*) AS total_rows, CAST(0 AS BIGINT) AS missing_cvegeo, count(*) FILTER (state IS NULL) AS missing_state, CAST(0 AS BIGINT) AS duplicates, "
    "count(*) FILTER (NOT year BETWEEN 1996 AND 2000) AS invalid_year, CAST(0 AS BIGINT) AS invalid_month, CAST(0 AS BIGINT) AS sex_total_mismatch, CAST(100 AS DOUBLE) AS match_rate_pct FROM labelled_fact GROUP BY dataset"
)
def quality_report_from_csv(spark, sf_dir):
    """The report written as CSV and read with its types."""
    path = shared_path(spark, "quality_report.csv")
    fact = spark.sql(_LABELLED.replace("FROM fact", "FROM {fact} AS fact"), fact=syn.fact(spark, sf_dir))
    sinks.write_csv(quality.quality_report(fact, years=(1996, 2000)), path)
    return spark.read.schema(S.QUALITY_SCHEMA).option("header", True).csv(path)


_STATES_OF = "under AS (SELECT municipality AS known, '[' || array_to_string(list_transform(list_sort(list(DISTINCT cve_estado)), lambda v: '''' || v || ''''), ', ') || ']' AS states FROM ref GROUP BY municipality)"


@query(
    syn.CTE.rstrip() + f", {_STATES_OF}, grouped AS (SELECT id_estado, municipio, municipio_norm, cve_estado_raw, count(*) AS row_count, CAST(sum(total_personas) AS BIGINT) AS total_persons FROM records GROUP BY ALL), "
    "issues AS (SELECT id_estado, municipio, municipio_norm, row_count, total_persons, CASE WHEN known IS NULL THEN 'unknown_state' ELSE 'possible_wrong_state' END AS issue_type, CASE WHEN known IS NULL THEN 'id_estado=33; municipio not in AGEEML' ELSE 'id_estado=33 but ''' || municipio || ''' exists under ' || states END AS notes FROM grouped LEFT JOIN under ON municipio_norm = known WHERE id_estado = 33 "
    "UNION ALL SELECT id_estado, municipio, municipio_norm, row_count, total_persons, 'possible_wrong_state', 'Not under estado ' || cve_estado_raw || '; found under ' || states FROM (SELECT * FROM grouped g ANTI JOIN ref ON g.cve_estado_raw = ref.cve_estado AND g.municipio_norm = ref.municipality) JOIN under ON municipio_norm = known WHERE id_estado <> 33) "
    "SELECT 'registry' AS dataset, id_estado, municipio AS municipio_raw, municipio_norm, row_count, total_persons, issue_type, notes, row_number() OVER (ORDER BY id_estado <> 33, id_estado, municipio, municipio_norm) + 1 AS line FROM issues"
)
def discrepancies_from_csv(spark, sf_dir):
    """The listing, written only where there is a row, read with its types and its lines."""
    path = shared_path(spark, "discrepancies.csv")
    issues = quality.discrepancies(syn.records(spark, sf_dir), syn.reference(spark, sf_dir), "registry")
    sinks.write_discrepancies(issues, path, ["registry"])
    if sinks.write_discrepancies(issues.limit(0), f"{path}-none", ["registry"]):
        raise ValueError("an empty listing was written")
    return delimited.typed(delimited.read(spark, path, S.DISCREPANCY_SCHEMA.names).rows, S.DISCREPANCY_SCHEMA).drop("file", "physical_line")


#: Published files: one as it should be, one with its columns in another order, one that is missing.
_FILES = ["located_alive", "located_dead", "total"]
_SWAPPED = [*S.TARGET_COLUMNS[1:], S.TARGET_COLUMNS[0]]


def _audited(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    out, catalog = shared_path(spark, "published"), shared_path(spark, "catalog.csv")
    _write_catalog(syn.catalog(spark, sf_dir), catalog)
    fact = fixed(syn.fact(spark, sf_dir), "fact")
    sinks.write_sorted_csv(fact.where("status_id = 2").select(S.TARGET_COLUMNS), f"{out}/located_alive.csv", *assemble.OUTPUT_ORDER)
    sinks.write_sorted_csv(fact.where("status_id = 3").select(_SWAPPED), f"{out}/located_dead.csv", *assemble.OUTPUT_ORDER)
    return registry.audit_files(spark, out, _FILES, catalog)


_SCHEMA_DETAIL = f"Expected {S.TARGET_COLUMNS}, got {_SWAPPED}".replace("'", "''")
_FILE_ERRORS = f"""SELECT 'schema' AS "check", CAST(NULL AS BIGINT) AS line, CAST(NULL AS VARCHAR) AS cvegeo, '{_SCHEMA_DETAIL}' AS detail, 'located_dead' AS file
 UNION ALL SELECT 'year_range', line, cvegeo, 'year=' || CAST(year AS VARCHAR), file FROM (SELECT *, CASE status_id WHEN 2 THEN 'located_alive' ELSE 'located_dead' END AS file, row_number() OVER (PARTITION BY status_id ORDER BY cvegeo, year, month) + 1 AS line FROM fact WHERE status_id IN (2, 3))"""


@query(syn.CTE + _FILE_ERRORS)
def audit_errors_from_csv(spark, sf_dir):
    """S6, S7, Q3 with its ``schema`` check: errors of published files, whose years are all outside the usual range."""
    return _audited(spark, sf_dir)[0].select("check", "line", "cvegeo", "detail", "file")


@query(
    syn.CTE.rstrip() + f", errors AS ({_FILE_ERRORS}) SELECT file, n_rows IS NOT NULL AS present, coalesce(n_rows, 0) AS n_rows, coalesce(persons, 0) AS persons, coalesce(n_errors, 0) AS n_errors, n_rows IS NOT NULL AND n_errors IS NULL AS passed "
    "FROM (VALUES ('located_alive', 2), ('located_dead', 3), ('total', 0)) AS f(file, status_id) LEFT JOIN (SELECT status_id, count(*) AS n_rows, CAST(sum(total) AS BIGINT) AS persons FROM fact GROUP BY status_id) USING (status_id) LEFT JOIN (SELECT file, count(*) AS n_errors FROM errors GROUP BY file) USING (file)"
)
def audit_summary_from_csv(spark, sf_dir):
    """Rows, persons and errors by file; the missing file fails."""
    return _audited(spark, sf_dir)[1]


@query(
    syn.CTE.rstrip() + ", files AS (SELECT status_id, CAST(sum(total) AS BIGINT) AS persons, count(*) FILTER (year NOT BETWEEN 2015 AND 2025) AS n_errors FROM fact GROUP BY status_id), "
    "parts AS (SELECT sum(persons) FILTER (status_id = 7) AS whole, sum(persons) FILTER (status_id <> 7) AS parts FROM files) "
    "SELECT count(*) AS files, count(*) FILTER (n_errors = 0) AS files_passed, (SELECT abs(whole - parts)::DOUBLE / whole::DOUBLE * 100 <= 1.0 FROM parts) AS consistent, "
    "count(*) = count(*) FILTER (n_errors = 0) AND (SELECT abs(whole - parts)::DOUBLE / whole::DOUBLE * 100 <= 1.0 FROM parts) AS passed FROM files"
)
def audit_verdict(spark, sf_dir):
    """Q6: one call from published files to pass or fail; the years of these are all out of range."""
    out, catalog = shared_path(spark, "published"), shared_path(spark, "catalog.csv")
    _write_catalog(syn.catalog(spark, sf_dir), catalog)
    fact = fixed(syn.fact(spark, sf_dir), "fact")
    names = {"total": 7, "located_alive": 2, "located_dead": 3}
    for name, status in names.items():
        sinks.write_sorted_csv(fact.where(F.col("status_id") == status).select(S.TARGET_COLUMNS), f"{out}/{name}.csv", *assemble.OUTPUT_ORDER)
    return registry.audit_run(spark, out, list(names), catalog)


@query(syn.CTE + f"SELECT 1 AS line, '{','.join(S.TARGET_COLUMNS)}' AS record UNION ALL SELECT row_number() OVER (ORDER BY cvegeo, year, month, status_id) + 1, {' || chr(44) || '.join(f'coalesce(CAST({c} AS VARCHAR), chr(32)[2:])' for c in S.FACT_SCHEMA.names)} FROM fact")
def fact_file_lines(spark, sf_dir):
    """The lines of the one published file, whose parts several tasks write and put together."""
    path = shared_path(spark, "fact.csv")
    sinks.write_sorted_csv(syn.fact(spark, sf_dir).select(S.TARGET_COLUMNS), path, *assemble.OUTPUT_ORDER)
    return delimited.records(spark, path).select("line", F.array_join("fields", ",").alias("record"))


def _answers() -> Callable[[str], tuple[int, str]]:
    """A service that refuses the first request of a third of the payloads, answers wrongly that of another, and fails for every fifth."""
    asked: dict[str, int] = {}

    def send(payload: str) -> tuple[int, str]:
        number = json.loads(payload)["number"]
        asked[payload] = asked.get(payload, 0) + 1
        if asked[payload] == 1 and number % 3 == 0:
            raise OSError("refused")
        if number % 5 == 0 or (asked[payload] == 1 and number % 3 == 1):
            return 500, "busy"
        return 200, json.dumps({"Html": f"<table>{number}</table>"})

    return send


@query("SELECT n_nationkey, CAST(CASE WHEN n_nationkey % 5 = 0 THEN 500 ELSE 200 END AS INTEGER) AS http_status, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE '<table>' || CAST(n_nationkey AS VARCHAR) || '</table>' END AS html FROM nation")
def requests_with_retries(spark, sf_dir):
    """Requests sent again after errors and wrong answers; the last answer stays."""
    requests = syn.table(spark, sf_dir, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_nationkey").alias("number"))).alias("payload"))
    # a service for each partition, as it remembers what it was asked
    return acquire.fetch(requests, _answers(), pause=0.0).select("n_nationkey", "http_status", acquire.page_html(F.col("body")).alias("html"))
