import duckdb
import pytest

from regivane.plans import catalogue, files

QUERIES, ORACLES = catalogue.QUERIES | files.QUERIES, catalogue.ORACLES | files.ORACLES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(names), sorted((tuple(str(r[k]) if hasattr(r[k], "year") else r[k] for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, found.fetchall())


def test_no_views_stay(spark, sf):
    for name in ("quality_report", "audit_ranges", "html_rows_tolerant"):
        QUERIES[name](spark, sf)
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and not set(catalogue.QUERIES) & set(files.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
