"""Queries over the driver tables, one for each operator, and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.functions import text
from regivane.operators import acquire, assemble, audit, dedup, quality, report, resolve
from regivane.plans import synthetic as syn
from regivane.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- scalar functions: X1 to X19, P1 to P12 ----


@query(f"SELECT doc_id, {syn.norm_sql('text')} AS norm FROM documents")
def normalize_std(spark, sf_dir):
    """X1, P2, P3."""
    return syn.table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("norm"))


@query(f"SELECT conv_id, turn, {syn.agg_sql('text')} AS norm_agg FROM conversations")
def normalize_aggressive(spark, sf_dir):
    """X2."""
    return syn.table(spark, sf_dir, "conversations").select("conv_id", "turn", text.normalize_aggressive(F.col("text")).alias("norm_agg"))


@query(
    "SELECT s_suppkey, CASE WHEN length(CAST(s_suppkey AS VARCHAR)) >= 2 THEN CAST(s_suppkey AS VARCHAR) ELSE lpad(CAST(s_suppkey AS VARCHAR), 2, '0') END AS code2, "
    "CASE WHEN length(CAST(s_suppkey AS VARCHAR)) >= 5 THEN CAST(s_suppkey AS VARCHAR) ELSE lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS code5, "
    "CASE WHEN length(CAST(s_nationkey AS VARCHAR)) >= 3 THEN CAST(s_nationkey AS VARCHAR) ELSE lpad(CAST(s_nationkey AS VARCHAR), 3, '0') END AS code3 FROM supplier"
)
def zero_pad_codes(spark, sf_dir):
    """P1, X3, X4, X6."""
    t = syn.table(spark, sf_dir, "supplier")
    return t.select("s_suppkey", text.pad_code(F.col("s_suppkey"), 2).alias("code2"), text.pad_code(F.col("s_suppkey"), 5).alias("code5"), text.pad_code(F.col("s_nationkey"), 3).alias("code3"))


@query(syn.CTE + "SELECT ordinal, cve_estado_raw FROM normed")
def conditional_null_code(spark, sf_dir):
    """P4, F1."""
    return resolve.normalize_records(syn.raw(spark, sf_dir)).select("ordinal", "cve_estado_raw")


@query(
    "SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS digits, CAST(0 AS BIGINT) AS word, "
    "c_custkey * 1000 + 7 AS thousands FROM customer"
)
def lenient_int_parse(spark, sf_dir):
    """X5."""
    t = syn.table(spark, sf_dir, "customer")
    grouped = F.concat(F.lit(" "), text.thousands(F.col("c_custkey") * 1000 + 7), F.lit("\n"))
    return t.select("c_custkey", text.to_int(F.substring("c_name", 10, 20)).alias("digits"), text.to_int(F.col("c_name")).alias("word"), text.to_int(grouped).alias("thousands"))


@query(
    "SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey >= 10000 THEN CAST(p_partkey AS VARCHAR) ELSE lpad(CAST(p_partkey AS VARCHAR), 5, '0') END AS repaired, "
    "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS size_int FROM part"
)
def code_repair(spark, sf_dir):
    """X7, X8."""
    t = syn.table(spark, sf_dir, "part")
    as_read = F.when(F.col("p_partkey") % 10 == 0, "").otherwise(F.concat(F.col("p_partkey").cast("string"), F.lit(".0")))
    odd = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".75")))
    return t.select("p_partkey", text.code_repair(as_read, 5).alias("repaired"), text.safe_int(odd).alias("size_int"))


@query(
    "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, "
    "strftime(date_trunc('month', o_orderdate) + INTERVAL 14 DAY, '%Y-%m-%d') AS month_mid FROM orders"
)
def month_bounds(spark, sf_dir):
    """P11, P12, X17."""
    t = syn.table(spark, sf_dir, "orders")
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return t.select("o_orderkey", text.first_of_month(y, m).alias("month_start"), text.last_of_month(y, m).alias("month_end"), F.date_format(text.mid_month(y, m), "yyyy-MM-dd").alias("month_mid"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) > 50 AS over_half FROM events")
def json_field(spark, sf_dir):
    """X18."""
    k = F.get_json_object("props", "$.k")
    return syn.table(spark, sf_dir, "events").select("event_id", k.alias("k"), (text.to_int(k) > 50).alias("over_half"))


_BODY = "CASE WHEN event_id % 4 = 0 THEN 'no json' WHEN event_id % 4 = 1 THEN '{\"Html\": \"\"}' WHEN event_id % 4 = 2 THEN '{\"Other\": 1}' ELSE '{\"Html\": \"<tr>' || event_type || '</tr>\"}' END"


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '<tr>' || event_type || '</tr>' END AS html FROM events")
def response_gate(spark, sf_dir):
    """F12."""
    return syn.table(spark, sf_dir, "events").select("event_id", acquire.page_html(F.expr(_BODY)).alias("html"))


_STATES_SQL = ", ".join(f"({k}, '{n}')" for k, n in enumerate(S.STATES, start=1))


@query(f"SELECT c_custkey, CAST(c_custkey % 36 AS BIGINT) AS id_estado, coalesce(name, '') AS estado FROM customer LEFT JOIN (VALUES {_STATES_SQL}) AS d(id, name) ON c_custkey % 36 = id")
def dimension_lookup(spark, sf_dir):
    """P9, X19."""
    t = syn.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 36).cast("bigint").alias("id_estado"))
    return acquire.with_dimensions(t)


@query("SELECT n_name, upper(substr(lower(n_name), 1, 1)) || substr(lower(n_name), 2) AS titled, CAST(sum(c_custkey) AS BIGINT) AS keys, format('{:,}', CAST(sum(c_custkey) AS BIGINT)) AS shown FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def display_formats(spark, sf_dir):
    """X11, X16."""
    t = syn.table(spark, sf_dir, "customer").join(syn.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return t.groupBy("n_name").agg(F.sum("c_custkey").alias("keys")).select("n_name", text.title(F.col("n_name")).alias("titled"), "keys", text.thousands(F.col("keys")).alias("shown"))


_TITLES = "upper(substr(lower(n_name), 1, 1)) || substr(lower(n_name), 2)"


@query(f"SELECT c_custkey, CAST(c_custkey % 10 AS VARCHAR) || 'A O''Brien-' || {_TITLES} || '/Éte_2Nd' AS titled FROM customer JOIN nation ON c_nationkey = n_nationkey")
def titles(spark, sf_dir):
    """X11: letters behind digits, quotes and signs begin a word."""
    t = syn.table(spark, sf_dir, "customer").join(syn.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return t.select("c_custkey", text.title(F.concat((F.col("c_custkey") % 10).cast("string"), F.lit("a o'BRIEN-"), "n_name", F.lit("/éTE_2ND"))).alias("titled"))


#: Ties of doubles, decimals whose doubles lie beside a tie, and rates.
_RATES = {"tie": "p_partkey / CAST(1024 AS DOUBLE)", "beside": "(2 * p_partkey + 1) / CAST(200 AS DOUBLE)", "negative": "-(2 * p_partkey + 1) / CAST(1000 AS DOUBLE)", "rate": "p_partkey / CAST(p_partkey + 7 AS DOUBLE) * 100", "tiny": "p_partkey / CAST(1000000000 AS DOUBLE) / 1000"}


@query(f"SELECT p_partkey, {', '.join(f'{syn.round2_sql(e)} AS {n}' for n, e in _RATES.items())} FROM part")
def rounded_rates(spark, sf_dir):
    """Doubles rounded by their exact value, exact halves to the even digit."""
    return syn.table(spark, sf_dir, "part").select("p_partkey", *(text.round_half_even(F.expr(e)).alias(n) for n, e in _RATES.items()))


# ---- sources and sinks with a relational part: S2, S10, S11, U1, U3, C2, C4, J11 ----


@query("SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN NULL ELSE n_name END AS name FROM nation")
def null_tokens(spark, sf_dir):
    """Whole fields that stand for null."""
    tokens = F.element_at(F.array(*(F.lit(t) for t in S.CATALOG_NULLS)), (F.col("n_nationkey") % 4 + 1).cast("int"))
    t = syn.table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 5 == 0, tokens).otherwise(F.col("n_name")).alias("name"))
    return readers.null_tokens(t)


@query("SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS mes, CASE WHEN month(o_orderdate) <= 6 THEN o_orderstatus END AS status FROM orders")
def consolidate_union(spark, sf_dir):
    """Monthly tables by column name, lacking columns null."""
    t = syn.table(spark, sf_dir, "orders").select("o_orderkey", F.month("o_orderdate").alias("mes"), F.col("o_orderstatus").alias("status"))
    return acquire.union_months([t.where(F.col("mes") == m) if m <= 6 else t.where(F.col("mes") == m).drop("status") for m in range(1, 13)])


_GRID = "SELECT CAST(s AS BIGINT) AS status_id, CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month, CAST(e AS BIGINT) AS id_estado, strftime(make_date(y, m, 1), '%Y-%m-%d') AS date_start, strftime(last_day(make_date(y, m, 1)), '%Y-%m-%d') AS date_end FROM (SELECT unnest([0, 7, 2, 3]) AS s), (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (SELECT unnest(range(1, 13)) AS m), (SELECT unnest(range(1, 34)) AS e)"


def _years(spark, sf_dir) -> list[int]:
    """The years that the orders have: a few numbers."""
    return sorted(r.y for r in syn.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).distinct().collect())


@query(_GRID)
def request_grid(spark, sf_dir):
    """All requests of the years that the orders have."""
    return acquire.request_grid(spark, years=_years(spark, sf_dir))


_PRESENT = "SELECT DISTINCT CASE o_orderstatus WHEN 'P' THEN 7 WHEN 'O' THEN 2 ELSE 3 END AS status_id, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders"


@query(f"SELECT DISTINCT g.status_id, g.year, g.month FROM (SELECT CAST(s AS BIGINT) AS status_id, CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month FROM (SELECT unnest([0, 7, 2, 3]) AS s), (SELECT unnest(range(1995, 2003)) AS y), (SELECT unnest(range(1, 13)) AS m)) g ANTI JOIN ({_PRESENT}) p ON g.status_id = p.status_id AND g.year = p.year AND g.month = p.month")
def pending_partitions(spark, sf_dir):
    """Months without rows yet."""
    present = syn.raw(spark, sf_dir).select(F.col("id_estatus_victima").alias("status_id"), F.col("anio").alias("year"), F.col("mes").alias("month")).distinct()
    return acquire.pending_months(acquire.request_grid(spark, years=list(range(1995, 2003))), present)


@query(f"SELECT status_id, year, month, id_estado, CASE status_id WHEN 0 THEN '{S.STATUSES[0][1]}' WHEN 7 THEN '{S.STATUSES[7][1]}' WHEN 2 THEN '{S.STATUSES[2][1]}' ELSE '{S.STATUSES[3][1]}' END AS titulo, date_end AS fecha_fin, CAST(id_estado AS VARCHAR) AS estado, CAST(32 AS BIGINT) AS n_fields FROM ({_GRID}) WHERE month = 2")
def request_payload(spark, sf_dir):
    """C4: the bodies of the requests for February of the years that the orders have."""
    p = acquire.payloads(acquire.request_grid(spark, years=_years(spark, sf_dir), months=[2]))
    field = lambda n: F.get_json_object("payload", f"$.{n}")
    return p.select("status_id", "year", "month", "id_estado", field("titulo").alias("titulo"), field("fechaFin").alias("fecha_fin"), field("idEstado").alias("estado"), F.json_object_keys("payload").alias("k")).withColumn("n_fields", F.size("k").cast("bigint")).drop("k")


# ---- deduplication: A1, W2, A16 ----


@query(syn.CTE + "SELECT id_estado, municipio, anio, mes, id_estatus_victima, ordinal, hombres, mujeres, indeterminado, total_personas FROM records")
def dedup_keep_last(spark, sf_dir):
    """A1, W2, S1."""
    return syn.records(spark, sf_dir).select(*S.RECORD_KEY, "ordinal", "hombres", "mujeres", "indeterminado", "total_personas")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def dedup_events(spark, sf_dir):
    """A1 on the event stream's table."""
    t = syn.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return dedup.keep_last(t, ["user_id", "event_type"], F.struct("ts", "event_id")).select("user_id", "event_type", "event_id", "value")


@query(syn.CTE + "SELECT cve_estado, municipality, cvegeo, ordinal FROM simple")
def catalog_first_wins(spark, sf_dir):
    """J1's build side, D2."""
    return resolve.simple_lookup(syn.reference(spark, sf_dir)).select("cve_estado", "municipality", "cvegeo", "ordinal")


@query(syn.CTE + "SELECT cve_estado, municipality_agg, count(*) AS n_rows FROM ref GROUP BY ALL HAVING count(*) > 1")
def ambiguous_keys(spark, sf_dir):
    """A5."""
    return resolve.aggressive_counts(syn.reference(spark, sf_dir)).where("n_rows > 1")


@query(syn.CTE + "SELECT cve_estado, municipality_agg, cvegeo FROM aggressive")
def aggressive_lookup(spark, sf_dir):
    """J2's build side."""
    return resolve.aggressive_lookup(syn.reference(spark, sf_dir)).select(F.col("key_state").alias("cve_estado"), "municipality_agg", "cvegeo")


@query(syn.CTE + "SELECT DISTINCT cve_estado, municipality FROM ref")
def valid_pairs(spark, sf_dir):
    """A16."""
    return syn.reference(spark, sf_dir).select("cve_estado", "municipality").distinct()


@query(syn.CTE + "SELECT municipality, '[' || array_to_string(list_transform(list_sort(list(DISTINCT cve_estado)), lambda v: '''' || v || ''''), ', ') || ']' AS states FROM ref GROUP BY municipality")
def states_by_municipality(spark, sf_dir):
    """A6, O7, X13."""
    return syn.reference(spark, sf_dir).groupBy("municipality").agg(text.list_text(F.collect_set("cve_estado")).alias("states"))


@query("SELECT c_custkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey")
def semi_membership(spark, sf_dir):
    """J5, F9."""
    return syn.table(spark, sf_dir, "customer").select("c_custkey").join(syn.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query(syn.CTE + "SELECT ordinal FROM records r ANTI JOIN ref ON r.cve_estado_raw = ref.cve_estado AND r.municipio_norm = ref.municipality")
def anti_membership(spark, sf_dir):
    """J6, F9."""
    pairs = syn.reference(spark, sf_dir).select("cve_estado", "municipality").distinct()
    r = syn.records(spark, sf_dir)
    return r.join(pairs, (r.cve_estado_raw == pairs.cve_estado) & (r.municipio_norm == pairs.municipality), "left_anti").select("ordinal")


# ---- resolution: J1 to J4, J7, J8, I1 to I4 ----


@query(syn.CTE + "SELECT ordinal, cve_estado_raw, was_corrected AS corrected FROM corrected")
def state_corrections(spark, sf_dir):
    """J7, I1, S3, D3, X15."""
    return syn.corrected(spark, sf_dir).select("ordinal", "cve_estado_raw", "corrected")


@query(syn.CTE + "SELECT c.ordinal, s.cvegeo FROM corrected c JOIN simple s ON c.cve_estado_raw = s.cve_estado AND c.municipio_norm = s.municipality")
def geo_join_simple(spark, sf_dir):
    """J1."""
    found = resolve.geo_join(syn.corrected(spark, sf_dir), syn.reference(spark, sf_dir))
    return found.where("match_type = 'simple'").select("ordinal", F.col("geo_cvegeo").alias("cvegeo"))


@query(syn.CTE + "SELECT ordinal, g0 AS cvegeo, g1 AS cve_estado, g2 AS cve_mun, g3 AS state, g4 AS municipality, m0 AS match_type FROM joined")
def geo_join_two_pass(spark, sf_dir):
    """J1, J2, J3, D5."""
    found = resolve.geo_join(syn.corrected(spark, sf_dir), syn.reference(spark, sf_dir))
    return found.select("ordinal", *(F.col(f"geo_{c}").alias(c) for c in ("cvegeo", "cve_estado", "cve_mun", "state", "municipality")), "match_type")


@query(syn.CTE + "SELECT match_type, count(*) AS n_rows FROM resolved GROUP BY match_type")
def match_type_counts(spark, sf_dir):
    """A7."""
    return quality.match_type_counts(syn.resolved(spark, sf_dir))


def _overridden(spark, sf_dir):
    ref = syn.reference(spark, sf_dir)
    return resolve.apply_overrides(resolve.geo_join(syn.corrected(spark, sf_dir), ref), resolve.override_rules(syn.overrides(spark, sf_dir), ref))


@query(syn.CTE + "SELECT ordinal, h0 AS cvegeo, h4 AS municipality FROM overridden WHERE m1 = 'override'")
def override_resolution(spark, sf_dir):
    """J4, J8, I2, S4, D4."""
    return _overridden(spark, sf_dir).where("match_type = 'override'").select("ordinal", F.col("geo_cvegeo").alias("cvegeo"), F.col("geo_municipality").alias("municipality"))


@query("SELECT n_name AS raw_municipio, lpad(CAST(n_nationkey + 1 AS VARCHAR), 5, '7') AS cvegeo FROM nation WHERE n_nationkey % 5 = 0")
def unmatched_overrides(spark, sf_dir):
    """J8's warning: codes that the catalog lacks."""
    o = syn.overrides(spark, sf_dir).withColumn("cvegeo", F.lpad((F.col("ordinal") + 1).cast("string"), 5, "7"))
    return resolve.unmatched_overrides(o, syn.reference(spark, sf_dir)).select("raw_municipio", "cvegeo")


@query(syn.CTE + "SELECT ordinal, i0 AS cvegeo, i1 AS cve_estado, i2 AS cve_mun, i3 AS state, i4 AS municipality, m2 AS match_type FROM sentinels WHERE starts_with(m2, 'sentinel')")
def sentinels(spark, sf_dir):
    """I3, F6, X9."""
    found = resolve.assign_sentinels(_overridden(spark, sf_dir)).where(F.coalesce(F.col("match_type").startswith("sentinel"), F.lit(False)))
    return found.select("ordinal", *(F.col(f"geo_{c}").alias(c) for c in ("cvegeo", "cve_estado", "cve_mun", "state", "municipality")), "match_type")


@query(syn.CTE + "SELECT ordinal, geo_cvegeo AS cvegeo, geo_municipality AS municipality FROM resolved WHERE match_type = 'unresolved_state_99'")
def unresolved(spark, sf_dir):
    """I4."""
    return syn.resolved(spark, sf_dir).where("match_type = 'unresolved_state_99'").select("ordinal", F.col("geo_cvegeo").alias("cvegeo"), F.col("geo_municipality").alias("municipality"))


@query(syn.CTE + "SELECT * FROM fact")
def resolve_full(spark, sf_dir):
    """The whole resolution to the 12-column fact table: E1, P5 to P7, D6."""
    return syn.fact(spark, sf_dir)


@query(syn.CTE + "SELECT cvegeo, year, month, status_id, count(*) AS n_rows, CAST(sum(total) AS BIGINT) AS total FROM (SELECT geo_cvegeo AS cvegeo, anio AS year, mes AS month, id_estatus_victima AS status_id, total_personas AS total FROM resolved) GROUP BY ALL HAVING count(*) > 1")
def aggregate_collisions(spark, sf_dir):
    """A2: the keys that more than one record falls on."""
    counted = assemble.aggregate_collisions(assemble.assemble(syn.resolved(spark, sf_dir)), n_rows=True)
    return counted.where("n_rows > 1").select(*S.FACT_KEY, "n_rows", "total")


@query(syn.CTE + "SELECT CAST((SELECT sum(total_personas) FROM records) AS BIGINT) AS before, CAST((SELECT sum(total) FROM fact) AS BIGINT) AS after")
def person_conservation(spark, sf_dir):
    """No stage after deduplication loses a person."""
    before = syn.records(spark, sf_dir).agg(F.sum("total_personas").alias("before"))
    return before.crossJoin(syn.fact(spark, sf_dir).agg(F.sum("total").alias("after")))


@query(syn.CTE + "SELECT 'raw' AS stage, count(*) AS n_rows FROM raw UNION ALL SELECT 'deduplicated', count(*) FROM records UNION ALL SELECT 'resolved', count(*) FROM resolved UNION ALL SELECT 'fact', count(*) FROM fact")
def stage_counts(spark, sf_dir):
    """Q7, S15."""
    counted = quality.StageCounts()
    raw = counted("raw", syn.raw(spark, sf_dir))
    deduplicated = counted("deduplicated", resolve.dedup_records(resolve.normalize_records(raw)))
    resolved = counted("resolved", resolve.resolve(deduplicated, syn.reference(spark, sf_dir), syn.corrections(spark, sf_dir), syn.overrides(spark, sf_dir)))
    counted("fact", assemble.aggregate_collisions(assemble.assemble(resolved))).write.format("noop").mode("overwrite").save()
    return counted.table(spark)


# ---- quality: Q1, Q2, Q5 ----

_STATES_OF = "under AS (SELECT municipality AS known, '[' || array_to_string(list_transform(list_sort(list(DISTINCT cve_estado)), lambda v: '''' || v || ''''), ', ') || ']' AS states FROM ref GROUP BY municipality)"
_GROUPED = f", {_STATES_OF}, grouped AS (SELECT id_estado, municipio, municipio_norm, cve_estado_raw, count(*) AS row_count, CAST(sum(total_personas) AS BIGINT) AS total_persons FROM records GROUP BY ALL) "
_COLUMNS = "'registry' AS dataset, id_estado, municipio AS municipio_raw, municipio_norm, row_count, total_persons"


@query(syn.CTE.rstrip() + _GROUPED + f"SELECT {_COLUMNS}, CASE WHEN known IS NULL THEN 'unknown_state' ELSE 'possible_wrong_state' END AS issue_type, CASE WHEN known IS NULL THEN 'id_estado=33; municipio not in AGEEML' ELSE 'id_estado=33 but ''' || municipio || ''' exists under ' || states END AS notes FROM grouped LEFT JOIN under ON municipio_norm = known WHERE id_estado = 33")
def discrepancies_unknown_state(spark, sf_dir):
    """Q2, A3, F1, J5, X14, D8."""
    return quality.discrepancies(syn.records(spark, sf_dir), syn.reference(spark, sf_dir), "registry").where("id_estado = 33")


@query(syn.CTE.rstrip() + _GROUPED + f"SELECT {_COLUMNS}, 'possible_wrong_state' AS issue_type, 'Not under estado ' || cve_estado_raw || '; found under ' || states AS notes FROM (SELECT * FROM grouped g ANTI JOIN ref ON g.cve_estado_raw = ref.cve_estado AND g.municipio_norm = ref.municipality) JOIN under ON municipio_norm = known WHERE id_estado <> 33")
def discrepancies_wrong_state(spark, sf_dir):
    """Q2, A4, J5, J6, X13, X14."""
    return quality.discrepancies(syn.records(spark, sf_dir), syn.reference(spark, sf_dir), "registry").where("id_estado != 33")


_LABEL = "CASE status_id WHEN 7 THEN 'disappeared_not_located' WHEN 2 THEN 'located_alive' ELSE 'located_dead' END"
#: The fact with flaws of every kind that the report counts.
_FLAWED = f"SELECT {_LABEL} AS dataset, CASE WHEN total % 7 = 5 THEN NULL ELSE cvegeo END AS cvegeo, cve_estado, CASE WHEN total % 11 = 3 THEN NULL ELSE state END AS state, cve_mun, municipality, male, female, undefined, CASE WHEN month = 2 AND male = 1 THEN total + 1 ELSE total END AS total, year, CASE WHEN year = 1996 AND month = 5 THEN 4 WHEN year = 1997 AND month = 12 THEN 13 ELSE month END AS month, status_id FROM fact"


def _flawed(spark, sf_dir):
    return spark.sql(_FLAWED.replace("FROM fact", "FROM {fact}"), fact=syn.fact(spark, sf_dir))


@query(
    syn.CTE.rstrip() + f", flawed AS ({_FLAWED}) "
    "SELECT dataset, true AS schema_ok, count(*) AS total_rows, count(*) FILTER (cvegeo IS NULL) AS missing_cvegeo, count(*) FILTER (state IS NULL) AS missing_state, "
    "count(*) FILTER (cvegeo IS NOT NULL) - count(DISTINCT CASE WHEN cvegeo IS NOT NULL THEN {'a': cvegeo, 'b': year, 'c': month, 'd': status_id} END) AS duplicates, "
    "count(*) FILTER (NOT year BETWEEN 1996 AND 2000) AS invalid_year, count(*) FILTER (NOT month BETWEEN 1 AND 12) AS invalid_month, count(*) FILTER (male + female + undefined <> total) AS sex_total_mismatch, "
    f"{syn.round2_sql('(count(*) - count(*) FILTER (cvegeo IS NULL))::DOUBLE / count(*)::DOUBLE * 100')} AS match_rate_pct FROM flawed GROUP BY dataset"
)
def quality_report(spark, sf_dir):
    """Q1, A8 to A11, F2, F3, F10, X12, D7, S13, U2."""
    return quality.quality_report(_flawed(spark, sf_dir), years=(1996, 2000))


@query(
    syn.CTE.rstrip() + ", t AS (SELECT CAST(coalesce(sum(total_personas) FILTER (ordinal % 89 <> 0), 0) AS BIGINT) AS total_persons, CAST(coalesce(sum(total_personas), 0) AS BIGINT) AS sub_persons FROM records) "
    "SELECT total_persons, sub_persons, total_persons - sub_persons AS difference, abs(total_persons - sub_persons)::DOUBLE / sub_persons::DOUBLE * 100 AS pipeline_pct, abs(total_persons - sub_persons)::DOUBLE / total_persons::DOUBLE * 100 AS audit_pct, abs(total_persons - sub_persons)::DOUBLE / total_persons::DOUBLE * 100 <= 1.0 AS consistent FROM t"
)
def cross_status_check(spark, sf_dir):
    """Q5, A12, F11, S5, U2."""
    r = syn.records(spark, sf_dir).select("ordinal", F.col("total_personas").alias("total"))
    both = r.where("ordinal % 89 != 0").withColumn("dataset", F.lit("total")).unionByName(r.withColumn("dataset", F.lit("parts")))
    return quality.cross_status(both, "total")


# ---- audit: Q3, Q4, W1, J9, O4 ----

#: A published table as text with seeded errors: sums, ranges, codes, and repeated keys.
_PUBLISHED = """SELECT line, CASE WHEN line % 83 = 0 THEN '77777.0' ELSE cvegeo END AS cvegeo, CASE WHEN line % 89 = 0 THEN '42' ELSE cve_estado END AS cve_estado, state,
 CASE WHEN line % 79 = 0 THEN '900' ELSE cve_mun END AS cve_mun, municipality, CAST(male AS STRING) AS male, CAST(female AS STRING) AS female, CAST(undefined AS STRING) AS undefined,
 CAST(CASE WHEN line % 97 = 0 THEN total + 1 ELSE total END AS STRING) AS total, CAST(CASE WHEN line % 71 = 0 THEN 2030 ELSE year END AS STRING) AS year, CAST(CASE WHEN line % 73 = 0 THEN 13 ELSE month END AS STRING) AS month, CAST(status_id AS STRING) AS status_id
 FROM (SELECT * FROM numbered UNION ALL SELECT line + 1000000 AS line, cvegeo, cve_estado, state, cve_mun, municipality, male, female, undefined, total, year, month, status_id FROM numbered WHERE line % 101 = 0)"""
_COLUMNS12 = ", ".join(S.TARGET_COLUMNS)
_AUDIT = (
    syn.CTE.rstrip()
    + f", numbered AS (SELECT row_number() OVER (ORDER BY cvegeo, year, month, status_id) + 1 AS line, {_COLUMNS12} FROM fact), published AS ({_PUBLISHED.replace('AS STRING', 'AS VARCHAR')}), "
    "coded AS (SELECT *, lpad(CAST(CAST(CAST(cvegeo AS DOUBLE) AS BIGINT) AS VARCHAR), 5, '0') AS code FROM published), "
    "looked AS (SELECT c.*, lag(line) OVER (PARTITION BY code, year, month, status_id ORDER BY line) AS before, r.cve_estado AS known_ent, r.cve_mun AS known_mun, r.cvegeo IS NOT NULL AS known, code NOT IN ('99998', '99999') AND CAST(c.cve_mun AS INTEGER) NOT IN (998, 999) AS checked FROM coded c LEFT JOIN (SELECT * FROM ref QUALIFY row_number() OVER (PARTITION BY cvegeo ORDER BY ordinal DESC) = 1) r ON code = r.cvegeo), "
    "errors AS (SELECT 'sex_total' AS \"check\", line, code AS cvegeo, male || '+' || female || '+' || undefined || '=' || CAST(male::BIGINT + female::BIGINT + undefined::BIGINT AS VARCHAR) || ' != ' || total AS detail FROM looked WHERE male::BIGINT + female::BIGINT + undefined::BIGINT <> total::BIGINT "
    "UNION ALL SELECT 'year_range', line, code, 'year=' || year FROM looked WHERE NOT year::BIGINT BETWEEN 1995 AND 2001 UNION ALL SELECT 'month_range', line, code, 'month=' || month FROM looked WHERE NOT month::BIGINT BETWEEN 1 AND 12 "
    "UNION ALL SELECT 'duplicate', line, code, 'Duplicate of line ' || CAST(before AS VARCHAR) FROM looked WHERE before IS NOT NULL "
    "UNION ALL SELECT 'ageeml_missing', line, code, 'cvegeo ' || code || ' not in AGEEML' FROM looked WHERE checked AND NOT known "
    "UNION ALL SELECT 'estado_mismatch', line, code, 'cve_estado=' || cve_estado || ' but AGEEML says ' || known_ent FROM looked WHERE checked AND known AND cve_estado <> known_ent "
    "UNION ALL SELECT 'mun_mismatch', line, code, 'cve_mun=' || cve_mun || ' but AGEEML says ' || known_mun FROM looked WHERE checked AND known AND cve_mun <> known_mun) "
)


def _published(spark, sf_dir):
    numbered = readers.number_lines(syn.fact(spark, sf_dir), "cvegeo", "year", "month", "status_id").select("line", *S.TARGET_COLUMNS)
    return spark.sql(_PUBLISHED.replace("FROM numbered", "FROM {numbered}"), numbered=numbered)


def _audit(spark, sf_dir):
    return audit.audit_rows(_published(spark, sf_dir), readers.clean_audit_catalog(syn.catalog(spark, sf_dir)), years=(1995, 2001))


@query(_AUDIT + 'SELECT * FROM errors WHERE "check" = \'sex_total\'')
def audit_sex_total(spark, sf_dir):
    """Q3, F10, D9, X10, S7."""
    return _audit(spark, sf_dir).where("check = 'sex_total'")


@query(_AUDIT + "SELECT * FROM errors WHERE \"check\" IN ('year_range', 'month_range')")
def audit_ranges(spark, sf_dir):
    """Q3, F3."""
    return _audit(spark, sf_dir).where("check IN ('year_range', 'month_range')")


@query(_AUDIT + "SELECT * FROM errors WHERE \"check\" = 'duplicate'")
def audit_duplicates(spark, sf_dir):
    """Q3, W1."""
    return _audit(spark, sf_dir).where("check = 'duplicate'")


@query(_AUDIT + "SELECT * FROM errors WHERE \"check\" IN ('ageeml_missing', 'estado_mismatch', 'mun_mismatch')")
def audit_catalog(spark, sf_dir):
    """Q3, Q4, J9, F7, S6, X7, X8."""
    return _audit(spark, sf_dir).where("check IN ('ageeml_missing', 'estado_mismatch', 'mun_mismatch')")


@query(_AUDIT + ", filed AS (SELECT \"check\" AS file, * FROM errors) SELECT file, line, \"check\", cvegeo, detail, CAST(row_number() OVER w AS INTEGER) AS place, count(*) OVER (PARTITION BY file) AS n_errors, greatest(count(*) OVER (PARTITION BY file) - 20, 0) AS more FROM filed WINDOW w AS (PARTITION BY file ORDER BY line, \"check\", detail) QUALIFY row_number() OVER w <= 20")
def audit_summary_top20(spark, sf_dir):
    """O4."""
    return audit.first_errors(_audit(spark, sf_dir).withColumn("file", F.col("check")))


@query(_AUDIT + ", f AS (SELECT 'located_alive' AS file UNION ALL SELECT 'located_dead' UNION ALL SELECT 'total'), s AS (SELECT CASE status_id WHEN '2' THEN 'located_alive' WHEN '3' THEN 'located_dead' ELSE 'other' END AS file, count(*) AS n_rows, CAST(sum(total::BIGINT) AS BIGINT) AS persons FROM published GROUP BY ALL), e AS (SELECT CASE status_id WHEN '2' THEN 'located_alive' WHEN '3' THEN 'located_dead' ELSE 'other' END AS file, count(*) AS n_errors FROM errors JOIN published USING (line) GROUP BY ALL) SELECT file, n_rows IS NOT NULL AS present, coalesce(n_rows, 0) AS n_rows, coalesce(persons, 0) AS persons, coalesce(n_errors, 0) AS n_errors, n_rows IS NOT NULL AND n_errors IS NULL AS passed FROM f LEFT JOIN s USING (file) LEFT JOIN e USING (file)")
def audit_files(spark, sf_dir):
    """Q6, A15."""
    rows = _published(spark, sf_dir).withColumn("file", F.expr("CASE status_id WHEN '2' THEN 'located_alive' WHEN '3' THEN 'located_dead' ELSE 'other' END"))
    errors = audit.audit_rows(rows, readers.clean_audit_catalog(syn.catalog(spark, sf_dir)), years=(1995, 2001)).join(rows.select("line", "file"), "line")
    return audit.file_summary(rows, errors, ["located_alive", "located_dead", "total"])


# ---- reports: R1, R2 ----


@query(syn.CTE + "SELECT year, month, CAST(sum(male) AS BIGINT) AS male, CAST(sum(female) AS BIGINT) AS female, CAST(sum(undefined) AS BIGINT) AS undefined, make_date(year, month, 15) AS date FROM fact WHERE cvegeo NOT IN ('99998', '99999') AND status_id = 7 GROUP BY year, month")
def monthly_trend(spark, sf_dir):
    """R1, F4, A13, P12, O2."""
    return report.monthly_trend(syn.fact(spark, sf_dir).where("status_id = 7"))


_STATE_SQL = "SELECT cve_estado, array_to_string(list_transform(string_split(arg_min(state, o), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS state, CAST(sum(male) AS BIGINT) AS male, CAST(sum(female) AS BIGINT) AS female, CAST(sum(undefined) AS BIGINT) AS undefined, CAST(sum(male) + sum(female) + sum(undefined) AS BIGINT) AS total FROM (SELECT *, {'a': cvegeo, 'b': year, 'c': month, 'd': status_id} AS o FROM fact) WHERE NOT regexp_matches({CODE}, '^(99998|99999|[0-9]{2}(998|999))$') GROUP BY cve_estado"
_FILE_ORDER = "struct(cvegeo, year, month, status_id)"


@query(syn.CTE + _STATE_SQL.replace("{CODE}", "cvegeo"))
def state_distribution(spark, sf_dir):
    """R2, F5, A14, P10, O3, J10, X11."""
    return report.state_distribution(syn.fact(spark, sf_dir).withColumn("ordinal", F.expr(_FILE_ORDER)))


@query(syn.CTE + _STATE_SQL.replace("{CODE}", "CAST(CAST(cvegeo AS BIGINT) AS VARCHAR)"))
def state_distribution_legacy(spark, sf_dir):
    """R2 as a reader that loses leading zeros gives it, S8."""
    return report.state_distribution(syn.fact(spark, sf_dir).withColumn("ordinal", F.expr(_FILE_ORDER)), legacy_int_codes=True)


# ---- pages to rows: H1, H2, X5, F8 ----

_ROWS_SQL = "SELECT n_nationkey, c_name || 'x' || n_name AS municipio, CAST(c_custkey % 7 AS BIGINT) AS hombres, CAST(1000 + c_custkey % 1000 AS BIGINT) AS mujeres, CAST(0 AS BIGINT) AS indeterminado, CAST(c_custkey % 7 + 1000 + c_custkey % 1000 AS BIGINT) AS total_personas FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 <> 0 AND c_custkey % 11 <> 0"


def _pages(spark, sf_dir):
    """A page for each nation: a row a customer, some with too few cells, some of zeros, some with a cell too many."""
    t = syn.table(spark, sf_dir, "customer").join(syn.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    row = F.expr(
        "CASE WHEN c_custkey % 10 = 0 THEN '<tr><td>short</td><td>1</td><td>2</td></tr>' WHEN c_custkey % 11 = 0 THEN '<tr><td>zero</td><td>0</td><td>-</td><td></td></tr>' "
        "ELSE '<tr class=\"r\"><td> <b>' || c_name || ' </b> x ' || '<i>' || n_name || '</i></td><td> ' || CAST(c_custkey % 7 AS STRING) || ' </td><TD>1,' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') || '</TD><td>n/a</td>' || CASE WHEN c_custkey % 3 = 0 THEN '<td>extra</td>' ELSE '' END || '</tr>' END"
    )
    return t.groupBy("n_nationkey").agg(F.concat(F.lit("<table>"), F.array_join(F.collect_list(row), "\n"), F.lit("</table>")).alias("html"))


@query(_ROWS_SQL)
def html_rows(spark, sf_dir):
    """H1, H2, X5, F8, P8, D13 in the JVM."""
    return acquire.extract_rows(_pages(spark, sf_dir))


@query(_ROWS_SQL)
def html_rows_tolerant(spark, sf_dir):
    """H1, H2 through the tolerant parser, on markup without end tags of rows."""
    return acquire.extract_rows_tolerant(_pages(spark, sf_dir).withColumn("html", F.replace("html", F.lit("</table>"), F.lit(""))))


_OUTER = "c_name || 'inner111'"
_STRUCTURAL_SQL = f"""WITH own AS (SELECT n_nationkey, c_custkey, c_custkey % 6 AS kind, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey <> 7),
found AS (
  SELECT n_nationkey, 'É' || c_name || ' & ' || n_name AS municipio, 2 AS h, 1000 AS m, c_custkey % 5 AS i FROM own WHERE kind = 0
  UNION ALL SELECT n_nationkey, c_name, 3, 4, 0 FROM own WHERE kind = 1
  UNION ALL SELECT n_nationkey, {_OUTER}, 0, 1, 1 FROM own WHERE kind = 2
  UNION ALL SELECT n_nationkey, 'inner', 1, 1, 1 FROM own WHERE kind = 2
  UNION ALL SELECT n_nationkey, c_name || '123', 123, 23, 3 FROM own WHERE kind = 3
  UNION ALL SELECT n_nationkey, c_name || n_name, 7, 0, 0 FROM own WHERE kind = 4
  UNION ALL SELECT n_nationkey, c_name, 8, 12, 0 FROM own WHERE kind = 5)
SELECT n_nationkey, municipio, CAST(h AS BIGINT) AS hombres, CAST(m AS BIGINT) AS mujeres, CAST(i AS BIGINT) AS indeterminado, CAST(h + m + i AS BIGINT) AS total_personas FROM found"""


@query(_STRUCTURAL_SQL)
def html_rows_structural(spark, sf_dir):
    """H1, H2 on markup of any quality: references, nested rows, rows and cells without end tags, comments and scripts.

    A customer a row, a nation a page; the page with a superscript for a count gives nothing.
    """
    t = syn.table(spark, sf_dir, "customer").join(syn.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    row = F.expr(
        "CASE c_custkey % 6 WHEN 0 THEN '<tr><td>&nbsp;&Eacute;' || c_name || ' &amp; ' || n_name || '&#160;</td><td>&#50;</td><td> 1,&#x30;00 </td><td>' || CAST(c_custkey % 5 AS STRING) || '</td></tr>' "
        "WHEN 1 THEN '<table><tr><td>' || c_name || '</td><td>3</td><td>٤</td><td>-</td></table>' "
        "WHEN 2 THEN '<tr><td>' || c_name || '<table><tr><td>inner</td><td>1</td><td>1</td><td>1</td></tr></table></td><td>5</td><td>6</td><td>7</td></tr>' "
        "WHEN 3 THEN '<tr><td>' || c_name || '<td>1<td>2<td>3</tr>' "
        "WHEN 4 THEN '<TR CLASS=\"a>b\"><TD> <b>' || c_name || ' </b><br> ' || n_name || '</TD><td>7</td><td></td><td>n/a</td><td>9</td></TR>' "
        "ELSE '<tr><!-- <td>no</td> --><td><script>if (1<2) { }</script>' || c_name || '</td><td>8</td><td>1<i>2</i></td><td/></tr>' END"
    )
    odd = F.when(F.col("n_nationkey") == 7, "<tr><td>odd</td><td>1²</td><td>2</td><td>3</td></tr>").otherwise("")
    pages = t.groupBy("n_nationkey").agg(F.concat(F.lit("<table>"), F.array_join(F.collect_list(row), "\n"), F.lit("</table>")).alias("html"))
    return acquire.extract_rows(pages.withColumn("html", F.concat("html", odd)))


@query(r"SELECT page_id, CAST(len(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS BIGINT) AS n_items, array_to_string(list_transform(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g'))), '|') AS items FROM pages")
def page_items(spark, sf_dir):
    """H1's extraction on the raw pages."""
    found = F.regexp_extract_all("html", F.lit(r"(?is)<li[^>]*>(.*?)</li>"), 1)
    return syn.table(spark, sf_dir, "pages").select("page_id", F.size(found).cast("bigint").alias("n_items"), F.array_join(F.transform(found, lambda x: F.trim(F.regexp_replace(x, "<[^>]*>", ""))), "|").alias("items"))


# ---- orders: O1, O5, O6 as positions, so that they can be compared ----


@query(syn.CTE + "SELECT cvegeo, year, month, status_id, row_number() OVER (ORDER BY cvegeo NULLS FIRST, year, month, status_id) + 1 AS line FROM fact")
def output_lines(spark, sf_dir):
    """The line of each row in the sorted output."""
    return readers.number_lines(syn.fact(spark, sf_dir), "cvegeo", "year", "month", "status_id").select(*S.FACT_KEY, "line")
