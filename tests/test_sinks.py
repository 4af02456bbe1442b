import glob

import pytest
from pyspark.sql import functions as F

from regivane import storage
from regivane.operators import dedup
from regivane.sources import sinks


def test_one_sorted_file_without_one_task(spark, tmp_path, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 3 == 0, F.concat(F.lit('a,"b"'), F.col("id").cast("string"))).alias("name"), F.lit("").alias("none")).repartition(5)
    df.orderBy("k").coalesce(1).write.option("header", True).option("emptyValue", "").option("escape", '"').csv(str(tmp_path / "plain"))
    whole = open(glob.glob(f"{tmp_path}/plain/part-*.csv")[0], "rb").read()
    monkeypatch.setattr(sinks, "CHUNK_BYTES", 1000)
    for _ in range(2):  # the second replaces the first
        sinks.write_sorted_csv(df, str(tmp_path / "out"), "k")
        assert open(glob.glob(f"{tmp_path}/out/part-*.csv")[0], "rb").read() == whole
    assert len(glob.glob(f"{tmp_path}/out/part-*")) == 1
    sinks.write_sorted_csv(df.limit(0), str(tmp_path / "empty"), "k")
    assert open(glob.glob(f"{tmp_path}/empty/part-*.csv")[0]).read() == "k,name,none\n"
    largest = max(spark.read.csv(str(tmp_path / "out"), header=True).groupBy().agg(F.count("*")).first())
    assert largest == 5000


def test_keep_last_by_address_shuffles_no_whole_rows_through_the_aggregate(spark):
    df = spark.createDataFrame([("d", "a", 1, 5), ("d", "a", 2, None), ("d", None, 1 << 41, 1), ("d", None, 3, 2), ("e", "a", 1, 7)], "dataset string, k string, at bigint, v int")
    got = dedup.keep_last_by_address(df, ["dataset", "k"], ["dataset", "at"])
    assert {(r.dataset, r.k, r.at, r.v) for r in got.collect()} == {("d", "a", 2, None), ("d", None, 1 << 41, 1), ("e", "a", 1, 7)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext, conf = Context(), type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(RuntimeError):
        storage.checkpoint_root(Session())
