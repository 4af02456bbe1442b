import csv
import glob

import pytest
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.operators import acquire, assemble, audit, dedup, quality, report, resolve
from regivane.plans import registry
from regivane.sources import readers, sinks

CATALOG = [
    ("05001", "5", "Coahuila", "1", "Abasolo"), ("05002", "5", "Coahuila", "2", "Ciudad de Acuña"), ("05003", "5", "Coahuila", "3", "Cd. Acuña"),
    ("25017", "25", "Sinaloa", "17", "Sinaloa"), ("26001", "26", "Sonora", "1", "Rosario"), ("25014", "25", "Sinaloa", "14", "Rosario"),
    ("05004", "5", "Coahuila", "4", "Dr. Mora"), ("05009", "5", "Coahuila", "9", "Abasolo"), ("02004", "2", "Baja California", "4", "Tijuana"),
]


def make_catalog(spark):
    rows = [(*r, k) for k, r in enumerate(CATALOG)]
    return spark.createDataFrame(rows, "CVEGEO string, CVE_ENT string, NOM_ENT string, CVE_MUN string, NOM_MUN string, ordinal bigint")


def make_records(spark, rows):
    """rows: (municipio, id_estado, estado, total)."""
    data = [(m, t, 0, 0, t, i, e, 2020, 1, 7, k) for k, (m, i, e, t) in enumerate(rows)]
    return spark.createDataFrame(data, "municipio string, hombres bigint, mujeres bigint, indeterminado bigint, total_personas bigint, id_estado bigint, estado string, anio bigint, mes bigint, id_estatus_victima bigint, ordinal bigint")


@pytest.fixture(scope="module")
def ref(spark):
    return resolve.build_reference(make_catalog(spark))


def rules(spark):
    corrections = spark.createDataFrame([("10", "SINALOA", "25", "017", 0), ("33", "XALAPA", "30", "087", 1)], "source_id_estado string, raw_municipio string, target_cve_estado string, target_cve_mun string, ordinal bigint")
    overrides = spark.createDataFrame([("05", "CUATRO", "05001", "", "", 0), ("05", "CUATRO", "05004", "", "", 1), ("05", "ABASOLO", "02004", "", "", 2), ("05", "NADA", "99123", "", "", 3)], "raw_id_estado string, raw_municipio string, cvegeo string, notes string, source_dataset string, ordinal bigint")
    return corrections, overrides


def test_resolution_cases(spark, ref):
    given = [
        ("ABASOLO", 5, "Coahuila", 1), ("DOCTOR MORA", 5, "Coahuila", 1), ("ACUÑA CIUDAD", 5, "Coahuila", 1), ("SINALOA", 10, "Durango", 1), ("XALAPA", 33, "x", 1),
        ("CUATRO", 5, "Coahuila", 1), ("SE DESCONOCE", 33, "x", 1), ("SE DESCONOCE", 5, "Coahuila", 1), ("SIN MUNICIPIO DE REFERENCIA", 5, "Coahuila", 1),
        ("NO ESPECIFICADO", 5, "Coahuila", 1), ("ABASOLO", None, "x", 1), ("CIUDAD ACUÑA", 5, "Coahuila", 1), (None, 5, "Coahuila", 1),
    ]
    out = resolve.resolve(resolve.normalize_records(make_records(spark, given)), ref, *rules(spark)).orderBy("ordinal").collect()
    got = [(r.geo_cvegeo, r.geo_cve_mun, r.geo_municipality, r.match_type) for r in out]
    assert got == [
        ("05001", "001", "abasolo", "simple"), ("05004", "004", "dr mora", "aggressive"), ("99999", "999", "acuna ciudad", "unresolved_state_99"), ("25017", "017", "sinaloa", "simple"),
        ("99998", "998", None, "sentinel_unknown_state"), ("05004", "004", "dr mora", "override"), ("99998", "999", "se desconoce", "sentinel_unknown_state"),
        ("05999", "999", "se desconoce", "sentinel_muni_999"), ("05998", "998", "sin municipio de referencia", "sentinel_muni_998"),
        ("99999", "999", "no especificado", "unresolved_state_99"), (None, None, None, "unknown_state"), ("99999", "999", "ciudad acuna", "unresolved_state_99"), ("99999", "999", None, "unresolved_state_99"),
    ]
    assert [r.geo_state for r in out][7] == "coahuila"
    assert [r.cvegeo for r in resolve.unmatched_overrides(rules(spark)[1], ref).collect()] == ["99123"]


def test_keep_last_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), (None, 1, 1), (None, 3, 2)], "k string, o int, v int")
    assert {(r.k, r.v) for r in dedup.keep_last(df, ["k"], "o").collect()} == {("a", None), (None, 2)}
    assert {(r.k, r.v) for r in dedup.keep_first(df, ["k"], "o").collect()} == {("a", 5), (None, 1)}


def test_collisions_sum_and_keep_persons(spark, ref):
    flat = assemble.assemble(resolve.resolve(resolve.normalize_records(make_records(spark, [("UNO X", 5, "c", 2), ("DOS X", 5, "c", 3)])), ref, *rules(spark)))
    rows = assemble.aggregate_collisions(flat).collect()
    assert len(rows) == 1 and rows[0].total == 5 and rows[0].municipality == "uno x" and rows[0].cvegeo == "99999"
    empty = assemble.aggregate_collisions(flat.withColumn("male", F.lit(None).cast("bigint"))).first()
    assert empty.male == 0


def test_discrepancies(spark, ref):
    given = [("ROSARIO", 8, "x", 2), ("ROSARIO", 33, "x", 3), ("SE DESCONOCE", 33, "x", 4), ("ABASOLO", 5, "x", 1), (None, 5, "x", 1)]
    out = quality.in_report_order(quality.discrepancies(resolve.normalize_records(make_records(spark, given)), ref, "d"), ["d"]).collect()
    assert [(r.id_estado, r.municipio_raw, r.total_persons, r.issue_type, r.notes) for r in out] == [
        (33, "ROSARIO", 3, "possible_wrong_state", "id_estado=33 but 'ROSARIO' exists under ['25', '26']"),
        (33, "SE DESCONOCE", 4, "unknown_state", "id_estado=33; municipio not in AGEEML"),
        (8, "ROSARIO", 2, "possible_wrong_state", "Not under estado 08; found under ['25', '26']"),
    ]


def test_cross_status(spark):
    df = spark.createDataFrame([("total", 1000), ("a", 900), ("b", 85)], "dataset string, total bigint")
    r = quality.cross_status(df, "total").first()
    assert (r.difference, round(r.audit_pct, 3), round(r.pipeline_pct, 3), r.consistent) == (15, 1.5, 1.523, False)
    assert quality.cross_status(df.limit(0), "total").first().audit_pct == 0


FACT = "line bigint, cvegeo string, cve_estado string, state string, cve_mun string, municipality string, male string, female string, undefined string, total string, year string, month string, status_id string"


def test_audit(spark):
    base = ("05", "c", "001", "a", "1", "0", "0", "1", "2020", "1", "7")
    rows = [
        (2, "5001.0", *base), (3, "99999", "99", "u", "999", "x", "1", "1", "0", "3", "2020", "1", "7"), (4, "05001", *base), (5, "05001", *base),
        (6, "05001", "06", "c", "002", "a", "1", "0", "0", "1", "2014", "13", "7"), (7, "12345", "12", "c", "345", "a", "1", "0", "0", "1", "2020", "2", "7"), (8, "05998", "05", "c", "998", "a", "1", "0", "0", "1", "2020", "2", "7"),
    ]
    known = readers.clean_audit_catalog(spark.createDataFrame([("05001", " 05 ", "x", '"001"', "a", 0)], "CVEGEO string, CVE_ENT string, NOM_ENT string, CVE_MUN string, NOM_MUN string, ordinal int"))
    got = {(r.check, r.line, r.detail) for r in audit.audit_rows(spark.createDataFrame(rows, FACT), known).collect()}
    assert got == {
        ("sex_total", 3, "1+1+0=2 != 3"), ("duplicate", 4, "Duplicate of line 2"), ("duplicate", 5, "Duplicate of line 4"), ("year_range", 6, "year=2014"), ("month_range", 6, "month=13"),
        ("estado_mismatch", 6, "cve_estado=06 but AGEEML says 05"), ("mun_mismatch", 6, "cve_mun=002 but AGEEML says 001"), ("ageeml_missing", 7, "cvegeo 12345 not in AGEEML"),
    }


def test_reports(spark):
    rows = [("01998", "01", "x", 1), ("05001", "05", None, 2), ("05002", "05", "coahuila", 3), ("99999", "99", "unresolved", 9)]
    df = spark.createDataFrame([(c, e, s, n, 0, 0, 2020, 1, k) for k, (c, e, s, n) in enumerate(rows)], "cvegeo string, cve_estado string, state string, male bigint, female bigint, undefined bigint, year bigint, month bigint, ordinal int")
    assert [(r.cve_estado, r.state, r.total) for r in report.state_distribution(df).collect()] == [("05", "Coahuila", 5)]
    assert [r.cve_estado for r in report.state_distribution(df, legacy_int_codes=True).collect()] == ["01", "05"]
    trend = report.monthly_trend(df).first()
    assert str(trend.date) == "2020-01-15" and trend.male == 6


def test_html(spark):
    page = "<table><tr><td>a</td><td>1</td><td>2</td></tr><tr><td>z</td><td>0</td><td>0</td><td>0</td></tr><tr><td>Foo <b>Bar</b></td><td>1,234</td><td>5</td><td>x</td><td>9</td></tr></table>"
    for f in (acquire.extract_rows, acquire.extract_rows_tolerant):
        rows = f(spark.createDataFrame([(1, page), (2, ""), (3, None)], "id int, html string")).collect()
        assert [(r.id, r.municipio, r.hombres, r.mujeres, r.indeterminado, r.total_personas) for r in rows] == [(1, "FooBar", 1234, 5, 0, 1239)]
    loose = spark.createDataFrame([("<tr><td>A &amp; B<td>1<td>2<td>3",)], "html string")
    assert len(acquire.extract_rows_tolerant(loose).collect()) <= 1


def test_fetch_and_assemble(spark, tmp_path):
    page = '{"Html": "<tr><td>A</td><td>1</td><td>0</td><td>2</td></tr>"}'
    grid = acquire.payloads(acquire.request_grid(spark, [7], [2016], [2])).where("id_estado <= 4")
    log = str(tmp_path / "log")

    def send(payload):
        with open(log, "a") as f:
            f.write(".")
        if '"idEstado":"1"' in payload:
            return 200, page
        if '"idEstado":"2"' in payload:
            raise OSError("down")
        return (500, "") if '"idEstado":"3"' in payload else (200, "no json")

    answers = acquire.fetch(grid.coalesce(1), send, pause=0).cache()
    assert {(r.id_estado, r.http_status) for r in answers.collect()} == {(1, 200), (2, None), (3, 500), (4, 200)}
    assert len(open(log).read()) == 1 + 3 * 4
    for tolerant in (False, True):
        rows = acquire.records_from_responses(answers, tolerant)
        assert rows.schema.names == S.RAW_SCHEMA.names
        assert [(r.municipio, r.total_personas, r.estado, r.anio, r.mes, r.id_estatus_victima) for r in rows.collect()] == [("A", 3, "Aguascalientes", 2016, 2, 7)]


def test_grid_and_payload(spark):
    grid = acquire.request_grid(spark)
    assert grid.count() == 17_424
    body = acquire.payloads(acquire.request_grid(spark, [7], [2016], [2])).select(F.json_object_keys("payload").alias("k"), "payload").first()
    assert len(body.k) == 32 and '"fechaFin":"2016-02-29"' in body.payload
    assert acquire.pending_months(grid, grid.select("status_id", "year", "month").limit(0)).count() == 528


def test_files_end_to_end(spark, tmp_path):
    with open(tmp_path / "catalog.csv", "w", encoding="latin1", newline="") as f:
        w = csv.writer(f)
        w.writerow(["CVE_ENT", "CVEGEO", "NOM_ENT", "CVE_MUN", "NOM_MUN"])
        for cvegeo, ent, state, mun, name in CATALOG:
            w.writerow([ent.zfill(2), cvegeo, state, mun.zfill(3), name])
        w.writerow(["07", "07001", "Chiapas", "001", "----"])
    (tmp_path / "overrides.csv").write_text('raw_id_estado,raw_municipio,cvegeo,notes,source_dataset\n05,CUATRO,05004,say "x" here,y\n')
    parts = {}
    for k, name in enumerate(("total", "a")):
        make_records(spark, [("ABASOLO", 5, "Coahuila", 2), ("CUATRO", 5, "Coahuila", 1), ("ROSARIO", 8, "Chihuahua", 1)]).drop("ordinal").withColumn("id_estatus_victima", F.lit(k).cast("bigint")).write.parquet(str(tmp_path / name))
        parts[name] = str(tmp_path / name)
    out = str(tmp_path / "out")
    tables = registry.run(spark, parts, str(tmp_path / "catalog.csv"), str(tmp_path / "none.csv"), str(tmp_path / "overrides.csv"), out)
    assert tables["fact"].count() == 6 and tables["cross_status"].first().consistent
    line = open(glob.glob(f"{out}/total.csv/part-*.csv")[0]).read().splitlines()
    assert line[0] == ",".join(S.TARGET_COLUMNS) and line[1].startswith("05001,05,coahuila,001,abasolo,2,0,0,2,2020,1,0")
    assert {r.match_rate_pct for r in tables["quality"].collect()} == {100.0}
    errors, summary = registry.audit_files(spark, out, ["total", "a", "missing"], str(tmp_path / "catalog.csv"))
    assert errors.count() == 0 and {(r.file, r.passed) for r in summary.collect()} == {("total", True), ("a", True), ("missing", False)}
    assert readers.read_fact(spark, f"{out}/total.csv").where("cvegeo = '05001'").count() == 1


def test_monthly_files(spark, tmp_path):
    df = make_records(spark, [("A", 1, "x", 1), ("B", 2, "x", 2)]).drop("ordinal")
    folder = str(tmp_path / "months")
    sinks.write_new_months(df, folder)
    sinks.write_new_months(df.unionByName(df.withColumn("mes", F.lit(2).cast("bigint"))), folder)
    assert spark.read.parquet(folder).count() == 4
    sinks.consolidate(df.withColumn("ordinal", F.monotonically_increasing_id()), str(tmp_path / "all"))
    assert readers.read_records(spark, str(tmp_path / "all")).count() == 2
    assert not sinks.write_discrepancies(df.limit(0), str(tmp_path / "none"), ["d"])


def test_months_are_present_by_status(spark, tmp_path):
    df = make_records(spark, [("A", 1, "x", 1)]).drop("ordinal")
    folder = str(tmp_path / "months")
    for status in (0, 7, None, 7, None):
        sinks.write_new_months(df.withColumn("id_estatus_victima", F.lit(status).cast("bigint")), folder)
    got = [r.id_estatus_victima for r in spark.read.parquet(folder).collect()]
    assert sorted(got, key=str) == [0, 7, None]


def test_incremental_load(spark, tmp_path):
    from regivane.streaming.incremental import load_new_months

    df = make_records(spark, [("A", 1, "x", 1)]).drop("ordinal")
    df.write.option("header", True).csv(str(tmp_path / "in"))
    for _ in range(2):
        load_new_months(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_number_lines(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id"))
    got = [r.line for r in readers.number_lines(df, "k").orderBy("k").collect()]
    assert got == list(range(2, 1002))


def test_empty_tables(spark, ref):
    none = make_records(spark, [("A", 5, "x", 1)]).limit(0)
    fact = assemble.aggregate_collisions(assemble.assemble(resolve.resolve(resolve.normalize_records(none), ref, *rules(spark))))
    assert fact.count() == 0 and report.monthly_trend(fact).count() == 0
    assert quality.quality_report(fact.withColumn("dataset", F.lit("d"))).count() == 0
