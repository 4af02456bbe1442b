import itertools

import pytest
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.operators.dedup import keep_last
from regivane.streaming.incremental import last_versions, load_last_versions


def table(spark, rows):
    """rows: (municipio, persons)."""
    return spark.createDataFrame([(name, n, 0, 0, n, 1, "x", 2020, 1, 7) for name, n in rows], S.RAW_SCHEMA)


FILES = {"a": [("x", 1), ("y", 2), ("x", 3)], "b": [("x", 4), (None, 5)], "c": [("z", 6), (None, 7), ("y", 8)]}


@pytest.mark.parametrize("order", list(itertools.permutations("abc"))[1::2])
def test_files_in_any_order(spark, tmp_path, order):
    for name in order:
        table(spark, FILES[name]).coalesce(1).write.parquet(str(tmp_path / "stage" / name))
        (tmp_path / "in").mkdir(exist_ok=True)
        (part,) = (tmp_path / "stage" / name).glob("part-*.parquet")
        part.rename(tmp_path / "in" / f"{name}.parquet")
        load_last_versions(spark, str(tmp_path / "in"), str(tmp_path / "versions"), str(tmp_path / "check")).awaitTermination()
    got = {(r.municipio, r.total_personas) for r in last_versions(spark, str(tmp_path / "versions")).collect()}
    rows = [(*r, k) for k, r in enumerate(itertools.chain(*FILES.values()))]
    whole = keep_last(spark.createDataFrame(rows, "municipio string, total bigint, place int"), ["municipio"], F.col("place"))
    assert got == {(r.municipio, r.total) for r in whole.collect()} == {("x", 4), (None, 7), ("y", 8), ("z", 6)}
    # a version that a later name has replaced before is not let through
    assert last_versions(spark, str(tmp_path / "versions")).count() <= spark.read.parquet(str(tmp_path / "versions")).count() <= 7
