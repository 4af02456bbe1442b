import glob
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from regivane.operators import acquire
from regivane.sources import months, requests

RAW = "municipio string, hombres bigint, mujeres bigint, indeterminado bigint, total_personas bigint, id_estado bigint, estado string, anio bigint, mes bigint, id_estatus_victima bigint"


def records(spark, rows):
    return spark.createDataFrame([(name, 1, 0, 0, 1, 1, "x", 2020, month, status) for name, month, status in rows], RAW)


def held(spark, folder):
    return sorted(((r.municipio, r.mes, r.id_estatus_victima) for r in months.read_months(spark, folder).collect()), key=str)


def test_months_are_whole_or_absent(spark, tmp_path):
    folder = str(tmp_path / "table")
    assert held(spark, folder) == []
    months.add_months(records(spark, [("a", 1, 7), ("b", 1, 7), ("c", 2, None)]), folder)
    broken = records(spark, [("d", 3, 7), ("e", 4, 7)]).withColumn("estado", F.when(F.col("mes") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("estado")))
    with pytest.raises(PySparkException):
        months.add_months(broken, folder)
    assert held(spark, folder) == [("a", 1, 7), ("b", 1, 7), ("c", 2, None)]
    months.add_months(records(spark, [("x", 1, 7), ("x", 2, None), ("f", 1, 0)]), folder)
    assert held(spark, folder) == [("a", 1, 7), ("b", 1, 7), ("c", 2, None), ("f", 1, 0)]
    # nothing but what manifests name, and no manifest half written
    named = {f for r in months.manifests(spark, folder).collect() for f in r.files}
    assert {os.path.relpath(f, folder) for f in glob.glob(f"{folder}/data/*/*.parquet")} == named
    assert all(name.endswith(".json") for name in os.listdir(f"{folder}/months"))


def test_of_two_loaders_one_adds_a_month(tmp_path):
    folder = str(tmp_path)
    writers = [months.MonthWriter(folder), months.MonthWriter(folder)]
    for k, writer in enumerate(writers):
        os.makedirs(f"{folder}/data/{writer.job}")
        open(f"{folder}/data/{writer.job}/0.parquet", "w").close()
        writer.commit([months.Staged([((2020, 1, 7), f"data/{writer.job}/0.parquet", k)]), None])
    manifest = json.load(open(f"{folder}/months/2020-1-7.json"))
    assert manifest["files"] == [f"data/{writers[0].job}/0.parquet"]
    assert os.listdir(f"{folder}/data/{writers[1].job}") == []


def test_a_folder_that_is_not_mounted():
    with pytest.raises(ValueError):
        months.mounted("hdfs://host/x")


def test_payloads_agree(spark):
    grid = acquire.payloads(acquire.request_grid(spark, [0, 7, 2], [2016, 2017], [2, 12])).where("id_estado IN (1, 33)").collect()
    assert {r.payload for r in grid} == {requests.payload_of(r.status_id, r.year, r.month, r.id_estado) for r in grid}


def test_only_months_that_filters_leave_are_asked_for(spark, tmp_path):
    log = str(tmp_path / "log")

    def connect():
        def send(payload):
            with open(log, "a") as f:
                f.write(payload + "\n")
            return 200, '{"Html": "<tr></tr>"}'

        return send

    present = spark.createDataFrame([(7, 2020, 2)], "status_id bigint, year bigint, month bigint")
    asked = requests.responses(spark, connect, present).where("year = 2020 AND status_id IN (7, 3) AND month < 4 AND month > 1 AND id_estado <= 30")
    rows = asked.collect()
    assert {(r.status_id, r.month) for r in rows} == {(3, 2), (7, 3), (3, 3)} and len(rows) == 90 and {r.attempts for r in rows} == {1}
    assert len(open(log).readlines()) == 3 * 33
    assert requests.responses(spark, connect).where("year = 1900").collect() == []


def test_stored_answers_in_order(tmp_path):
    month = tmp_path / "status_id=7" / "year=2020" / "month=3"
    month.mkdir(parents=True)
    (month / "part-0.json").write_text(json.dumps({"id_estado": 4, "answers": [{"status": 0, "body": ""}, {"status": 500, "body": "x"}, {"status": 200, "body": '{"Html": "y"}'}]}) + "\n")
    send = requests.StoredResponses(str(tmp_path))
    assert requests.ask(send, requests.payload_of(7, 2020, 3, 4), 4, 0.0, 1.5) == (200, '{"Html": "y"}', 3)
    assert requests.ask(send, requests.payload_of(7, 2020, 3, 5), 4, 0.0, 1.5) == (404, "", 4)
    assert requests.ask(send, requests.payload_of(7, 2020, 4, 4), 2, 0.0, 1.5) == (404, "", 2)
