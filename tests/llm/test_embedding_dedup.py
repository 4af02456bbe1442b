"""The epsilon grid order join against all pairs."""

import numpy as np
import pytest

from regivane.llm import embedding_dedup
from regivane.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, root string, n_links string, part string"


def usable(vector):
    if vector is None or not vector or any(x is None for x in vector):
        return None
    x = np.array(vector, dtype=float)
    return x if np.isfinite(x).all() and x.any() else None


def brute(rows, similarity=0.93):
    """[(vec_id, n_links, component_id, kept)] by comparing all pairs of rows (id, vector, label)."""
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    vectors = [usable(v) for _, v, _ in rows]
    for i, x in enumerate(vectors):
        for j, y in enumerate(vectors[:i]):
            if x is None or y is None or len(x) != len(y) or rows[i][2] is None or rows[i][2] != rows[j][2]:
                continue
            top = np.abs(x).max(), np.abs(y).max()
            a, b = x / top[0], y / top[1]
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= similarity:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    found = [(i, links[k], None if i is None else least[root(k)]) for k, (i, _, _) in enumerate(rows)]
    return sorted(((*f, f[0] == f[2]) for f in found), key=str)  # a null id is kept


def result(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, embedding_dedup.classes(table, **options).collect()), key=str)


def grouped_vectors(rng, n, size, labels):
    """Vectors around a few means: exact copies, near ones that chain, and others."""
    means = rng.normal(size=(n // 8, size))
    rows = []
    for k in range(n):
        x = means[rng.integers(len(means))]
        x = x if k % 5 == 0 else x + rng.normal(size=size) * rng.choice([0.1, 0.25, 0.4])
        rows.append((k, (x * rng.choice([1.0, 2.0, 3.0])).astype(np.float32).tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("size, interval_bytes, leaf", [(2, 1 << 19, 128), (8, 8 * 8 * 20, 4), (24, 8 * 24 * 7, 3)])
def test_all_links_are_found(spark, size, interval_bytes, leaf):
    rows = grouped_vectors(np.random.default_rng(size), 400, size, 3)
    got = result(spark, rows, interval_bytes=interval_bytes, leaf=leaf)
    assert got == brute(rows)
    assert any(r[1] > 1 for r in got) and (size == 2 or any(r[1] == 0 for r in got))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, None], 1), (8, [1.0, 0.0], None)]
    rows += [(9, [2.0, 0.0], 1), (9, [2.0, 0.0], 1), (9, [0.0, 5.0], 1), (10, [-0.0, 1e-44], 1), (11, [3e38, -0.0], 1), (None, [1.0, 0.1], 1), (None, [7.0, 7.0, 7.0], 1), (12, [1.0, 0.0], 2), (13, [1.0, 0.0, 0.0], 1)]
    got = result(spark, rows)
    assert got == brute(rows)
    assert (8, 0, 8, True) in got and (13, 0, 13, True) in got and (None, 0, None, False) not in got
    assert result(spark, []) == [] and result(spark, rows[1:8]) == brute(rows[1:8])


def test_one_group_of_near_copies_over_many_intervals(spark):
    rng = np.random.default_rng(3)
    mean = rng.normal(size=16)
    rows = [(k, (mean + rng.normal(size=16) * 0.15).tolist(), 1) for k in range(300)]
    rows += [(k, rng.normal(size=16).tolist(), k % 4) for k in range(300, 400)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    assert result(spark, rows, interval_bytes=16 * 8 * 16, leaf=5) == brute(rows)


def test_distant_sequences_are_skipped():
    rng = np.random.default_rng(5)
    means = rng.normal(size=(64, 6))
    x = np.concatenate([m + rng.normal(size=(32, 6)) * 0.02 for m in means])
    x = embedding_dedup.unit_rows(x)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :4].T
    cells = np.floor(x @ axes.T / np.sqrt(0.14))
    own = embedding_dedup.Sequence(x[np.lexsort(cells.T[::-1])], axes, 32)
    leaves = [(k, k + 32) for k in range(0, own.n, 32)]
    near = sum(embedding_dedup.apart(*own.box(*a), *own.box(*b)) <= 0.14 for a in leaves for b in leaves if a <= b)
    compared = len(leaves) * (len(leaves) + 1) // 2
    links = sum(int(m.sum()) for _, _, m in embedding_dedup.joined(own, own, 0.93))
    every = own.unit @ own.unit.T >= 0.93
    assert links == int(np.triu(every, 1).sum()) and near < 0.6 * compared


def test_query_holds_every_vector(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = sorted(map(tuple, QUERIES["op11_embedding_dedup"](spark, sf).collect()), key=str)
    assert got == brute(rows)
