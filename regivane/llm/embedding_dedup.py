"""Near-duplicate vectors by an epsilon grid order join.

Only vectors of equal label and length are compared.  Vectors of unit length with a cosine of at
least c are at most ``sqrt(2 - 2c)`` apart, the epsilon.  The method:

1.  Equal vectors of a label (but for a power of two) become one class, so copies are not compared.
2.  All classes give one matrix of second moments; its leading eigenvectors are the axes of a grid
    whose cells are epsilon wide.
3.  Classes are sorted by label, length and grid cell (the epsilon grid order) in a distributed
    sort, and each partition is cut into intervals of bounded bytes, stored with their bounds.
4.  Intervals join recursively: groups of intervals first, then their parts, and a pair whose
    bounds are more than epsilon apart is dropped with all its parts.
5.  A task reads a pair of intervals and goes on: sequences that are too far apart are skipped,
    long ones are halved, and short ones are compared exactly, in double precision.  A pair gives
    one row for each class that has a link: how many rows it links to, and an edge to the least
    class of its component inside the pair, so nothing grows with the square of a group.
6.  The components of these edges are the components of all links.

Each comparison is skipped only by a proven bound, so no link is lost, whatever the data; how much
is skipped follows the data.

Defined results: rows are vectors, and a repeated row is a vector of its own that links with the
others; null labels, and vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are components of their own; vectors of different lengths do not link; a
null id gives a null component and is kept, and does not name a component with others; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regivane.llm.common import discard, give_back, materialise, portions
from regivane.llm.components import components

SIMILARITY = 0.93
#: Leading principal dimensions of the grid; axes are fitted on so many of a vector's first dimensions.
GRID_DIMENSIONS, FITTED_DIMENSIONS = 12, 1024
#: Bytes of an interval's vectors; rows of a sequence that is compared at once.
INTERVAL_BYTES, LEAF_ROWS = 1 << 19, 128
#: Partitions of sorted classes below one node of the interval tree.
FAN_OUT = 8


def scaled(vector: np.ndarray) -> np.ndarray | None:
    """The vector as doubles times a power of two, its largest component between 0.5 and 1; None if it takes no part."""
    x = np.asarray(vector, dtype=np.float64)
    if not len(x) or not np.isfinite(x).all() or not (top := np.abs(x).max()):
        return None
    return np.ldexp(x, -int(np.frexp(top)[1])) + 0.0  # no negative zeros


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of a list column; None where null or with a null component."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends, there = column.values, column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
    holes = np.concatenate(([0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))))
    numbers = flat.to_numpy(zero_copy_only=False)
    return [numbers[a:b] if ok and holes[a] == holes[b] else None for a, b, ok in zip(ends[:-1], ends[1:], there, strict=True)]


def fingerprinted(table: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, size, print binary, vector binary): print and vector are null for rows that take no part.

    ``vector`` holds the scaled doubles; the print is a 128-bit hash of them.
    """

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 4096):
            labelled = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            found = [scaled(v) if ok and v is not None else None for ok, v in zip(labelled, _vectors(batch.column(2)), strict=True)]
            stored = [None if x is None else x.tobytes() for x in found]
            prints = [None if s is None else xxhash.xxh3_128_digest(s) for s in stored]
            sizes = [None if x is None else len(x) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(prints, pa.binary()), pa.array(stored, pa.binary())], ["vec_id", "label", "size", "print", "vector"])

    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    own = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    return own.mapInArrow(marked, f"vec_id {kinds[vec_id]}, label {kinds[label]}, size int, print binary, vector binary")


def principal_axes(classes: DataFrame, dimensions: int, fitted: int = FITTED_DIMENSIONS) -> np.ndarray:
    """Leading eigenvectors (rows) of the second moments of all unit vectors, on their first ``fitted`` dimensions.

    Tasks add up matrices and the executors add those up by row; shorter vectors count as if filled with zeros.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 0))
        for batch in portions(batches, 4096):
            rows = [np.frombuffer(v, dtype=np.float64) for v in batch.column(0).to_pylist()]
            width = min(fitted, max(map(len, rows)))
            x = np.zeros((len(rows), width))
            for k, v in enumerate(rows):
                x[k, : len(v)] = v[:width] / np.linalg.norm(v)
            if width > len(total):
                total = np.pad(total, (0, width - len(total)))
            total[:width, :width] += x.T @ x
        if len(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["row", "sums"])

    parts = classes.select("vector").mapInArrow(moments, "row int, sums array<double>")
    # at most `fitted` rows of as many numbers
    cells = parts.select("row", F.posexplode("sums").alias("column", "value")).groupBy("row", "column").agg(F.sum("value").alias("value"))
    found = cells.toArrow()
    if not found.num_rows:
        return np.zeros((0, 0))
    row, column, value = (found[c].to_numpy() for c in ("row", "column", "value"))
    matrix = np.zeros((row.max() + 1,) * 2)
    matrix[row, column] = value
    return np.ascontiguousarray(np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1][:, :dimensions].T)


def projected(matrix: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit rows of ``matrix`` on the axes; distances there are never larger than between the rows."""
    width = min(matrix.shape[1], axes.shape[1])
    return matrix[:, :width] @ axes[:, :width].T


def apart(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> float:
    """Least squared distance of two boxes."""
    gap = np.maximum(0.0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap)


class Sequence:
    """An interval of rows in epsilon grid order, with the bounds of all its halvings."""

    def __init__(self, matrix: np.ndarray, axes: np.ndarray, leaf: int = LEAF_ROWS):
        self.unit, self.n, self.leaf = unit_rows(matrix), len(matrix), leaf
        self.grid, self.bounds = projected(self.unit, axes), {}

    def box(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        if (a, b) not in self.bounds:
            if b - a <= self.leaf:
                self.bounds[a, b] = self.grid[a:b].min(0), self.grid[a:b].max(0)
            else:
                (low, high), (low2, high2) = (self.box(*half) for half in self.halves(a, b))
                self.bounds[a, b] = np.minimum(low, low2), np.maximum(high, high2)
        return self.bounds[a, b]

    def halves(self, a: int, b: int) -> list[tuple[int, int]]:
        middle = a + self.leaf * (-(-(b - a) // self.leaf) // 2)
        return [(a, middle), (middle, b)]


def joined(one: Sequence, two: Sequence, similarity: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin in one, begin in two, links) of all pairs of leaves that have links; of one sequence with itself, each pair of rows once."""
    same, far = one is two, 2 - 2 * similarity + 1e-9
    todo = [((0, one.n), (0, two.n))]
    while todo:
        (a, b), (c, d) = todo.pop()
        if (same and a > c) or apart(*one.box(a, b), *two.box(c, d)) > far:
            continue
        long_one, long_two = b - a > one.leaf, d - c > two.leaf
        if long_one and (b - a >= d - c or not long_two):
            todo += [(half, (c, d)) for half in one.halves(a, b)] if not (same and (a, b) == (c, d)) else [(x, y) for x in one.halves(a, b) for y in two.halves(c, d)]
        elif long_two:
            todo += [((a, b), half) for half in two.halves(c, d)]
        else:
            links = one.unit[a:b] @ two.unit[c:d].T >= similarity
            if same and a == c:
                links &= ~np.tri(b - a, dtype=bool)
            if links.any():
                yield a, c, links


def pair_links(one: Sequence, two: Sequence, sizes_one: np.ndarray, sizes_two: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(linked rows, least place in its component) of the classes of both sequences, those of ``two`` behind those of ``one``."""
    base = 0 if one is two else one.n
    count = np.zeros(base + two.n, dtype=np.int64)
    parent = np.arange(base + two.n)
    for a, c, links in joined(one, two, similarity):
        rows, columns = slice(a, a + links.shape[0]), slice(base + c, base + c + links.shape[1])
        count[rows] += links @ sizes_two[c : c + links.shape[1]]
        count[columns] += links.T @ sizes_one[a : a + links.shape[0]]
        x, y = np.nonzero(links)
        x, y = x + a, y + base + c
        while True:  # the least ends meet until every link lies in one component
            p, q = parent[x], parent[y]
            open_ = p != q
            if not open_.any():
                break
            np.minimum.at(parent, np.maximum(p, q)[open_], np.minimum(p, q)[open_])
            while (parent[parent] != parent).any():
                parent = parent[parent]
    return count, parent


def _pack(column: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([column], pa.list_(kind))


def intervals(classes: DataFrame, axes: np.ndarray, similarity: float, interval_bytes: int = INTERVAL_BYTES) -> DataFrame:
    """Sorted classes (label, size, print, n, vector) in intervals: one row for each, with its classes packed.

    (interval, part, label, size, low, high, first, prints, counts, vectors): the classes of an
    interval are the nodes ``first``, ``first + 1``, ...
    """
    width = max(1e-3, np.sqrt(2 - 2 * similarity))

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 4096):
            rows = [np.frombuffer(v, dtype=np.float64) for v in batch.column("vector").to_pylist()]
            cells = np.array([np.floor(projected((v / np.linalg.norm(v))[None, :], axes)[0] / width) for v in rows]).astype(np.int16)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(cells), pa.list_(pa.int16()))], [*batch.schema.names, "cells"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    order = ["label", "size", "cells", "print"]  # the print parts a crowded cell
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(classes.mapInArrow(celled, ", ".join(f"{k} {v}" for k, v in kinds.items()) + ", cells array<smallint>"), "grid-cells")
    dealt = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, begun, most, label_kind = [], None, 0, 1, None

        def stored() -> pa.RecordBatch:
            nonlocal begun
            matrix = np.stack([np.frombuffer(v, dtype=np.float64) for _, v, _ in held])
            grid = projected(unit_rows(matrix), axes)
            first = (part << 40) + begun
            begun += len(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()), pa.array([part], pa.int32()), pa.array([key[0]], label_kind), pa.array([key[1]], pa.int32()), _pack(grid.min(0), pa.float64()), _pack(grid.max(0), pa.float64()), pa.array([[p for p, _, _ in held]], pa.list_(pa.binary())), _pack(np.array([n for _, _, n in held], dtype=np.int64), pa.int64()), pa.array([matrix.tobytes()], pa.binary())],
                ["interval", "part", "label", "size", "low", "high", "prints", "counts", "vectors"],
            )

        for batch in portions(batches, 4096):
            label_kind = batch.schema.field("label").type
            for label, size, print_, n, vector, part_ in zip(*(batch.column(c).to_pylist() for c in ("label", "size", "print", "n", "vector", "part")), strict=True):
                if held and ((label, size) != key or len(held) >= most):
                    yield stored()
                    held = []
                part, key, most = part_, (label, size), max(1, interval_bytes // (8 * size))
                held.append((print_, vector, n))
        if held:
            yield stored()

    kind = f"interval bigint, part int, label {kinds['label']}, size int, low array<double>, high array<double>, prints array<binary>, counts array<bigint>, vectors binary"
    found = materialise(dealt.mapInArrow(cut, kind), "intervals")
    discard(placed)
    return found


def _near(a: str, b: str, far: float):
    """Whether the boxes of two nodes are at most epsilon apart."""
    gaps = F.zip_with(F.arrays_zip(F.col(f"{a}.low").alias("low"), F.col(f"{a}.high").alias("high")), F.arrays_zip(F.col(f"{b}.low").alias("low"), F.col(f"{b}.high").alias("high")), lambda x, y: F.greatest(F.lit(0.0), x["low"] - y["high"], y["low"] - x["high"]))
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= far


def interval_pairs(stored: DataFrame, similarity: float, fan_out: int = FAN_OUT) -> DataFrame:
    """(one, two): intervals of one label and size whose bounds are at most epsilon apart, each pair once.

    A tree stands over the intervals: partitions, groups of partitions and so on.  Pairs of the
    highest nodes come first; each level replaces the pairs that are near by pairs of their parts.
    """
    far, grid = 2 - 2 * similarity + 1e-9, stored.select("interval", "part", "label", "size", "low", "high")
    axes = len(stored.select("low").first()["low"])
    highest = stored.agg(F.max("part")).first()[0]
    levels = 1
    while fan_out ** (levels - 1) <= highest:
        levels += 1

    def nodes(level: int) -> DataFrame:
        """The bounds of level 1 (partitions) and above, by label and size."""
        step = fan_out ** (level - 1)
        up = F.floor(F.col("part") / (step * fan_out)).cast("bigint")
        bounds = [f(F.col(c)[k]).alias(f"{c}{k}") for c, f in (("low", F.min), ("high", F.max)) for k in range(axes)]
        own = grid.groupBy("label", "size", F.floor(F.col("part") / step).cast("bigint").alias("node"), up.alias("parent")).agg(*bounds)
        return own.select("label", "size", "node", "parent", *(F.array(*(f"{c}{k}" for k in range(axes))).alias(c) for c in ("low", "high")))

    leaves = grid.select("label", "size", F.col("interval").alias("node"), F.col("part").cast("bigint").alias("parent"), "low", "high")
    top = nodes(levels)
    pairs = top.select("label", "size", F.col("node").alias("one"), F.col("node").alias("two"))  # one node a label and size
    for level in range(levels - 1, -1, -1):
        below = nodes(level) if level else leaves
        down = pairs.join(below.select("label", "size", F.col("parent").alias("one"), F.struct("node", "low", "high").alias("a")), ["label", "size", "one"])
        down = down.join(below.select("label", "size", F.col("parent").alias("two"), F.struct("node", "low", "high").alias("b")), ["label", "size", "two"])
        down = down.where((F.col("a.node") <= F.col("b.node")) & _near("a", "b", far))
        before, pairs = pairs, materialise(down.select("label", "size", F.col("a.node").alias("one"), F.col("b.node").alias("two")), "near-intervals")
        if hasattr(before, "stored_at"):
            discard(before)
    return pairs.select("one", "two")


def class_links(stored: DataFrame, pairs: DataFrame, axes: np.ndarray, similarity: float, leaf: int = LEAF_ROWS) -> DataFrame:
    """(node, root, links): for each pair of intervals, of each class with a link its linked rows and an edge to its component's least class."""
    ends = pairs.select(F.xxhash64("one", "two").alias("pair"), "one", "two").select("pair", "one", "two", F.explode(F.expr("IF(one = two, array(one), array(one, two))")).alias("interval"))
    parts = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = stored.select("interval", "size", "counts", "vectors").join(ends, "interval").repartition(parts, "pair").sortWithinPartitions("pair", "one", "two", "interval")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waits = None
        for batch in portions(batches, 8):
            for k in range(batch.num_rows):
                interval, size, one, two = (batch.column(c)[k].as_py() for c in ("interval", "size", "one", "two"))
                sizes = batch.column("counts")[k].values.to_numpy()
                own = Sequence(np.frombuffer(batch.column("vectors")[k].as_py(), dtype=np.float64).reshape(-1, size), axes, leaf)
                if one != two and interval == one:
                    waits = own, sizes
                    continue
                first, sizes_first = waits if one != two else (own, sizes)
                count, root = pair_links(first, own, sizes_first, sizes, similarity)
                names = np.arange(first.n) + one if one == two else np.concatenate([np.arange(first.n) + one, np.arange(own.n) + two])
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(names[root[some]]), pa.array(count[some])], ["node", "root", "links"])
                waits = None
        give_back()

    return met.mapInArrow(linked, "node bigint, root bigint, links bigint")


def classes(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", similarity: float = SIMILARITY, interval_bytes: int = INTERVAL_BYTES, leaf: int = LEAF_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``table``.

    ``similarity`` is above 0; ``component_id`` is the least id that links reach.
    """
    marked = materialise(fingerprinted(table, vec_id, vector, label), "vectors")
    rows = marked.select("vec_id", "label", "print")
    own = marked.where("print IS NOT NULL")
    # a row for each class; the join below finds one vector of it
    key = ["label", "print"]
    counted = own.groupBy(*key).agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    counted = materialise(counted, "vector-classes")
    alone = own.where("vec_id IS NOT NULL").join(counted.select(*key, F.col("least").alias("vec_id")), [*key, "vec_id"], "left_semi").unionByName(own.where("vec_id IS NULL").join(counted.where("least IS NULL").select(*key), key, "left_semi"))
    alone = alone.groupBy(*key).agg(F.max("size").alias("size"), F.max("vector").alias("vector")).join(counted.select(*key, "n"), key)
    alone = materialise(alone.select("label", "size", "print", "n", "vector"), "distinct-vectors")
    axes = principal_axes(alone, GRID_DIMENSIONS)
    none = F.col("vec_id")
    if not len(axes):
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), none.alias("component_id"), F.lit(True).alias("kept"))
    stored = intervals(alone, axes, similarity, interval_bytes)
    found = materialise(class_links(stored, interval_pairs(stored, similarity), axes, similarity, leaf), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "root")
    nodes = stored.select("label", "interval", F.posexplode("prints").alias("k", "print")).select("label", "print", (F.col("interval") + F.col("k")).alias("node"))
    named = nodes.join(links, "node", "left").join(roots.select(F.col("id").alias("node"), "root"), "node", "left")
    named = materialise(named.select("label", "print", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")).join(counted, key), "class-components")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    # written, so that a vector with very many copies can be split in the join with the rows
    named = materialise(named.join(least, "root").select("label", "print", (F.col("links") + F.col("n") - 1).alias("n_links"), "component"), "named-classes")
    both = rows.join(named, key, "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return both.select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
