"""Files read by byte ranges against Python's csv module."""

import csv
import io
import random

import pytest

from regivane.sources import delimited, readers


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that records go over several."""
    keys = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(folder, name, rows, rng, blank=0.1, encoding="utf-8"):
    buffer = io.StringIO(newline="")
    writer = csv.writer(buffer, lineterminator=rng.choice(["\n", "\r\n"]))
    for row in rows:
        writer.writerow(row)
        if rng.random() < blank:
            buffer.write("\n")
    (folder / name).write_bytes(buffer.getvalue().encode(encoding))


def plain(path, encoding="utf-8"):
    """(line, physical line, fields) of the records of a file."""
    with open(path, encoding=encoding) as f:
        reader, out, begun = csv.reader(f), [], 1
        for fields in reader:
            if fields:
                out.append((len(out) + 1, begun, fields))
            begun = reader.line_num + 1
    return out


def test_records_over_many_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(4)
    values = ["a", "", "x,y", 'q"q', "l1\nl2", "l1\r\n\r\nl3", '"', "é", "plain", "two words"]
    for n in range(5):
        rows = [["k", "a", "b"]] + [[str(k), rng.choice(values), rng.choice([*values, "long " * rng.randint(1, 150) + "\n" * rng.randint(0, 4)])] for k in range([0, 1, 30, 120, 200][n])]
        written(tmp_path, f"f{n}.csv", rows, rng)
    (tmp_path / "literal.csv").write_text('k,a,b\n1,x "y" z,"p" q\n2,a""b,"c""d"\n\n3,"open\n, still')
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    found = delimited.records(spark, str(tmp_path)).collect()
    for path in tmp_path.iterdir():
        got = sorted((r.line, r.physical_line, r.fields) for r in found if r.file.endswith(path.name))
        assert got == plain(path), path.name
    assert {r.file[-11:] for r in found if r.open} == {"literal.csv"}


def test_columns_by_name_and_status(spark, tmp_path, small_ranges):
    files = {"a.csv": b"x,y\n1,2\n", "b.csv": b"\xef\xbb\xbfy,x,z\n2,1,3\nNA,,5\n", "c.csv": b"x\n7\n", "empty.csv": b"", "blank.csv": b"\n\n", "wide.csv": b"x,y\n1,2,3\n", "open.csv": b'x,y\n1,"2\n', "bytes.csv": b"x,y\n1,\xff\n", "header.csv": b"x,y\n", "short.csv": b"x,y\n5\n"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    found = delimited.read(spark, str(tmp_path), ["x", "y", "q"], nulls=("", "NA"))
    rows = sorted((r.file.rsplit("/", 1)[1], r.line, r.x, r.y, r.q) for r in found.rows.collect())
    assert rows == [("a.csv", 2, "1", "2", None), ("b.csv", 2, "1", "2", None), ("b.csv", 3, None, None, None), ("c.csv", 2, "7", None, None), ("short.csv", 2, "5", None, None)]
    status = {r.file.rsplit("/", 1)[1]: (r.status, r.n_rows) for r in found.status.collect()}
    assert status == {"a.csv": ("read", 1), "b.csv": ("read", 2), "c.csv": ("read", 1), "empty.csv": ("empty", 0), "blank.csv": ("empty", 0), "wide.csv": ("unreadable", 0), "open.csv": ("unreadable", 0), "bytes.csv": ("unreadable", 0), "header.csv": ("read", 0), "short.csv": ("read", 1)}


def test_latin1_and_rules(spark, tmp_path):
    (tmp_path / "catalog.csv").write_bytes("NOM_MUN,CVEGEO,CVE_MUN,CVE_ENT,NOM_ENT\nCiudad de Acuña,05002,002,05,Coahuila\n---,05003,003,05,-\n".encode("latin1"))
    rows = readers.read_catalog(spark, str(tmp_path / "catalog.csv")).orderBy("ordinal").collect()
    assert [(r.CVEGEO, r.NOM_MUN, r.NOM_ENT) for r in rows] == [("05002", "Ciudad de Acuña", "Coahuila"), ("05003", None, None)]
    (tmp_path / "rules.csv").write_text("raw_municipio,target_cve_estado,source_id_estado,target_cve_mun\nFOO,25,10,017\n")
    rule = readers.read_corrections(spark, str(tmp_path / "rules.csv")).first()
    assert (rule.source_id_estado, rule.raw_municipio, rule.target_cve_estado) == ("10", "FOO", "25")
    (tmp_path / "tiny.csv").write_text("a,b\n1,2\n")
    assert readers.read_corrections(spark, str(tmp_path / "tiny.csv")).count() == 0
    assert readers.read_overrides(spark, str(tmp_path / "none.csv")).count() == 0


def test_later_files_win_by_name(spark, tmp_path):
    # the larger file comes first in Spark's splits, the later name has the last word
    (tmp_path / "a.csv").write_text("raw_municipio,raw_id_estado,cvegeo,notes,source_dataset\n" + "x,1,00001,,\n" * 500 + "same,1,11111,,\n")
    (tmp_path / "b.csv").write_text("raw_municipio,raw_id_estado,cvegeo,notes,source_dataset\nsame,1,22222,,\n")
    last = readers.read_overrides(spark, str(tmp_path)).where("raw_municipio = 'same'").orderBy("ordinal").collect()
    assert [r.cvegeo for r in last] == ["11111", "22222"]
