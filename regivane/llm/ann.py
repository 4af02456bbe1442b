"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a bounded sample by splitting: a cluster that is too large for its share
is halved again and again by two-means, so lists stay balanced.  Every row of the table is
put into the list of its nearest centroid, and a boundary row also into further lists whose
centroid is nearly as near, unless a nearer chosen centroid shadows it.  A query walks a
neighbour graph of the centroids in memory, takes the lists whose distance is within a ratio
of the best, and is compared exactly, in double precision, with the rows of these lists.

The ratio alone selects lists; no number of lists bounds it.  It is measured: for a bounded
set of sampled queries the true neighbours among all rows are found in blocks, and the ratio
is the least that reaches the lists of the wanted share of them.  So clustered vectors are
pruned to few lists however many there are, and vectors that are spread evenly are not
pruned to a recall that was not asked for.  An infinite ratio takes every list, which is exact.

Nearness is the inner product.  Vectors are not assumed to have equal length: for placing,
each gets a further component that makes all lengths equal to the longest, which turns the
largest inner product into the smallest distance.  Lists are dealt into blocks of bounded
size by hash, so a crowded list is read by many tasks; each query meets every block of the
lists it takes.

Defined results: null vectors, vectors of zero length, vectors with null or non-finite
components and vectors of another length than the most frequent one (the shorter of equally
frequent ones) take no part, on either side; rows with a null id neither; ties go to the
smaller id; with fewer candidates than asked for all found are returned; repeated ids count
once, with their best score, and a query that repeats is asked with each of its vectors; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane.llm.common import materialise, per_process, portions

#: Rows wanted in a list, vectors sampled for each list, and the most lists.
LIST_ROWS, SAMPLE_PER_LIST, MOST_LISTS = 160, 24, 32_768
#: Bytes of the sampled vectors that the driver holds, as doubles.
SAMPLE_BYTES = 1 << 29
#: Lists of a row at most, and how much farther than the nearest centroid the others may be.
COPIES, SPREAD_RATIO = 4, 1.5
#: Share of the true neighbours of the sampled queries that the ratio must reach, and the most such queries.
TARGET, TUNING_QUERIES = 0.97, 192
BLOCK_ROWS = 4096
#: Hits that a task holds.
HELD_HITS = 1 << 20
#: Centroids that a walk begins at, and nodes that it opens in one step.
ENTRIES, STEP = 16, 4


def usable(vector: Column) -> Column:
    """Not null, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Means of about ``lists`` parts of nearly equal size."""
    rng = np.random.default_rng(seed)
    goal = max(1, -(-len(sample) // lists))
    parts, done = [np.arange(len(sample))], []
    while parts:
        own = parts.pop()
        x = sample[own]
        if len(own) <= goal or (x == x[0]).all():
            done.append(x.mean(0))
            continue
        a, b = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(8):
            near = x @ (b - a) - (b @ b - a @ a) / 2
            half = near > np.median(near)
            if not half.any():
                half = np.arange(len(x)) % 2 == 0
            a, b = x[~half].mean(0), x[half].mean(0)
        parts += [own[~half], own[half]]
    return np.array(done, dtype=np.float32)


def neighbour_graph(centroids: np.ndarray, degree: int = 24) -> np.ndarray:
    """Near centroids of each, and a few random ones that keep the graph connected.

    Of the nearest, those that no nearer link shadows (is nearer to them than the centroid
    itself) come first, so that links spread; the nearest others fill up.
    """
    n = len(centroids)
    rng = np.random.default_rng(11)
    graph = np.full((n, degree + 4), -1, dtype=np.int32)
    graph[:, degree:] = rng.integers(0, n, (n, 4))
    width = min(n - 1, 2 * degree)
    if width < 1:
        return graph
    norms = (centroids**2).sum(1)
    for at in range(0, n, 256):
        part = centroids[at : at + 256]
        far = norms[None, :] - 2 * part @ centroids.T + norms[at : at + 256, None]
        far[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
        near = np.argpartition(far, width - 1, axis=1)[:, :width]
        near = np.take_along_axis(near, np.take_along_axis(far, near, 1).argsort(1), 1)
        own = np.take_along_axis(far, near, 1)
        x = centroids[near]
        between = norms[near][:, :, None] + norms[near][:, None, :] - 2 * x @ x.transpose(0, 2, 1)
        spread = np.zeros(near.shape, dtype=bool)
        for k in range(width):
            spread[:, k] = ~(spread[:, :k] & (between[:, k, :k] < own[:, k, None])).any(1)
        first = np.argsort(~spread, axis=1, kind="stable")[:, :degree]
        graph[at : at + len(part), : first.shape[1]] = np.take_along_axis(near, first, 1)
    return graph


@dataclass
class Index:
    """Centroids, their graph and the length that placed vectors are lifted to."""

    centroids: np.ndarray
    graph: np.ndarray
    longest: float
    #: Median distance of sampled rows to their nearest centroid.
    radius: float = 0.0
    #: Median distance of a centroid to its nearest other one.
    spacing: float = 0.0

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        if query:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True) * self.longest
            return np.hstack([unit, np.zeros((len(x), 1))])
        rest = np.maximum(self.longest**2 - (x**2).sum(1), 0.0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def walk(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids of each vector and their squared distances, ascending.

        Best-first search of the graph for all vectors at once: in each step every vector opens
        its nearest nodes that are not opened yet, until its whole beam is.  Where the beam is
        a quarter of all centroids, all are read.
        """
        n = len(self.centroids)
        beam = min(beam, n)
        if 4 * beam >= n:
            c = self.centroids.astype(np.float64)
            far = np.maximum((c**2).sum(1)[None, :] - 2 * x @ c.T + (x**2).sum(1)[:, None], 0)
            near = np.argsort(far, axis=1, kind="stable")[:, :beam]
            return near, np.take_along_axis(far, near, 1)
        x = x.astype(np.float32)
        seen = np.zeros((len(x), n), dtype=bool)
        start = np.unique(np.linspace(0, n - 1, ENTRIES).astype(np.int32))
        seen[:, start] = True
        near = np.tile(start, (len(x), 1))
        far = ((self.centroids[start][None, :, :] - x[:, None, :]) ** 2).sum(2)
        opened = np.zeros(near.shape, dtype=bool)
        while True:
            waiting = np.where(opened, np.inf, far)
            rows = np.flatnonzero(np.isfinite(waiting).any(1))
            if not len(rows):
                break
            step = min(STEP, near.shape[1])
            pick = np.argpartition(waiting[rows], step - 1, axis=1)[:, :step]
            live = np.isfinite(np.take_along_axis(waiting[rows], pick, 1))
            opened[rows[:, None], pick] = True
            nodes = self.graph[np.take_along_axis(near[rows], pick, 1)]
            nodes = np.where(live[:, :, None], nodes, -1).reshape(len(rows), -1)
            nodes = np.sort(nodes, axis=1)
            fresh = (nodes >= 0) & ~seen[rows[:, None], nodes]
            fresh[:, 1:] &= nodes[:, 1:] != nodes[:, :-1]
            which, column = np.nonzero(fresh)
            seen[rows[which], nodes[which, column]] = True
            distance = np.full(nodes.shape, np.inf, dtype=np.float32)
            apart = self.centroids[nodes[which, column]] - x[rows[which]]
            distance[which, column] = np.einsum("ij,ij->i", apart, apart)
            if near.shape[1] < beam:  # the beam is not full yet
                more = min(beam - near.shape[1], nodes.shape[1])
                near = np.pad(near, ((0, 0), (0, more)))
                far = np.pad(far, ((0, 0), (0, more)), constant_values=np.inf)
                opened = np.pad(opened, ((0, 0), (0, more)), constant_values=True)
            all_far = np.concatenate([far[rows], distance], axis=1)
            keep = np.argpartition(all_far, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
            far[rows] = np.take_along_axis(all_far, keep, 1)
            near[rows] = np.take_along_axis(np.concatenate([near[rows], nodes], axis=1), keep, 1)
            opened[rows] = np.take_along_axis(np.concatenate([opened[rows], ~fresh], axis=1), keep, 1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1)

    def places(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list, and for boundary rows others that none of them shadows."""
        near, far = self.walk(self.lift(vectors, query=False), 32)
        near, far = near[:, : 2 * COPIES], far[:, : 2 * COPIES]
        taken = np.zeros(near.shape, dtype=bool)
        taken[:, :1] = True
        for k in range(1, near.shape[1]):
            between = ((self.centroids[near[:, k]][:, None] - self.centroids[near[:, :k]]) ** 2).sum(2)
            shadowed = (taken[:, :k] & (between <= 0.5 * self.spacing**2)).any(1)
            taken[:, k] = ~shadowed & (taken.sum(1) < COPIES) & (far[:, k] <= SPREAD_RATIO**2 * far[:, 0])
        row, column = np.nonzero(taken)
        return row, near[row, column]

    def probes(self, vectors: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: all lists as far as ``ratio`` times the best (or the usual) distance."""
        x = self.lift(vectors, query=True)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        todo = [(np.arange(len(x)), 64)]
        while todo:
            rows, beam = todo.pop()
            near, far = self.walk(x[rows], beam)
            inside = far <= (ratio * self._unit(far[:, 0]))[:, None] ** 2
            whole = ~inside[:, -1] | (near.shape[1] == len(self.centroids))
            row, column = np.nonzero(inside & whole[:, None])
            found.append((rows[row], near[row, column]))
            # the others walk on with a larger beam, as many at once as bounded memory allows
            rest, beam = rows[~whole], 4 * beam
            few = max(1, (1 << 20) // min(beam, len(self.centroids)))
            todo += [(rest[at : at + few], beam) for at in range(0, len(rest), few)]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _unit(self, best: np.ndarray) -> np.ndarray:
        """What ratios are of: the distance of the nearest list, or the usual one."""
        return np.sqrt(np.maximum(best, self.radius**2))

    def ratios(self, query: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
        """The least ratio at which a query's probes meet each of its neighbours."""
        x = self.lift(query[None, :], query=True)
        far = ((self.centroids - x) ** 2).sum(1)
        row, lists = self.places(neighbours)
        least = np.full(len(neighbours), np.inf)
        np.minimum.at(least, row, far[lists])
        return np.sqrt(least) / self._unit(far.min())


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _sampled(rows: DataFrame, most: int, total: int, salt: int) -> DataFrame:
    """About ``most`` of the rows, by id hash."""
    hashed = F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(1 << 20))
    return rows.where(hashed < int(min(1.0, most / total) * (1 << 20)) + 1)


def fit(rows: DataFrame, n: int, longest: float, list_rows: int = LIST_ROWS, most_lists: int = MOST_LISTS) -> Index:
    """Fit on at most about ``SAMPLE_PER_LIST`` vectors for each of at most ``most_lists`` lists, taken by id hash.

    Of long vectors fewer are taken, and fewer lists made, so that the sample stays within ``SAMPLE_BYTES``.

    ``rows`` has ``n`` rows (id, vector), with vectors of one size, the longest of length ``longest``.
    """
    first = rows.select(F.size("vector").alias("size")).first()
    most = max(SAMPLE_PER_LIST, SAMPLE_BYTES // (8 * ((first["size"] if first else 0) + 1)))
    lists = int(min(most_lists, max(1, n // list_rows), max(1, most // 4)))
    sample = _sampled(rows, min(lists * SAMPLE_PER_LIST, most), n, 0).select("vector").toArrow()["vector"]
    if not len(sample):
        sample = rows.select("vector").limit(1).toArrow()["vector"]
    index = Index(np.zeros((0, 0)), np.zeros((0, 0)), longest * (1 + 1e-9))
    lifted = index.lift(_matrix(sample), query=False)
    index.centroids = balanced_centroids(lifted, lists)
    # as long as the vectors, else a list of very like vectors seems far beside the mean of a wide one
    lengths = np.linalg.norm(index.centroids, axis=1, keepdims=True)
    index.centroids = (index.centroids * (index.longest / np.maximum(lengths, 1e-6 * index.longest))).astype(np.float32)
    index.graph = neighbour_graph(index.centroids)
    nearest = index.walk(index.centroids[:2000].astype(np.float64), 32)[1]
    if nearest.shape[1] > 1:
        index.spacing = float(np.sqrt(np.median(nearest[:, 1])))
    index.radius = float(np.sqrt(np.median(index.walk(lifted[:2000], 32)[1][:, 0])))
    return index


def tuned_ratio(rows: DataFrame, n: int, index: Index, k: int, target: float = TARGET, queries: int = TUNING_QUERIES) -> float:
    """The least ratio that reaches ``target`` of the true ``k`` neighbours of sampled queries.

    About ``queries`` rows, taken by id hash, are compared with all rows, block by block; each
    task keeps its ``k`` best for each of them.
    """
    spark = rows.sparkSession
    asked = _sampled(rows, queries, n, 1).toArrow()
    if not len(asked) or len(index.centroids) < 2:
        return 1.0
    sent = spark.sparkContext.broadcast((asked["id"].to_numpy(), _matrix(asked["vector"])))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = sent.value
        score, ids, vectors = np.full((len(names), 0), -np.inf), np.zeros((len(names), 0), np.int64), None
        for batch in portions(batches, 4096):
            x, own = _matrix(batch.column(1)), batch.column(0).to_numpy()
            near = matrix @ x.T
            near[names[:, None] == own[None, :]] = -np.inf
            place = np.argpartition(-near, min(k, len(own)) - 1, axis=1)[:, :k]
            found = x[place]
            score = np.concatenate([score, np.take_along_axis(near, place, 1)], axis=1)
            ids = np.concatenate([ids, own[place]], axis=1)
            vectors = found if vectors is None else np.concatenate([vectors, found], axis=1)
            keep = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, ids = (np.take_along_axis(a, keep, 1) for a in (score, ids))
            vectors = np.take_along_axis(vectors, keep[:, :, None], 1)
        row, column = np.nonzero(np.isfinite(score))
        if len(row):
            flat = pa.array(vectors[row, column].ravel())
            ends = pa.array(np.arange(len(row) + 1, dtype=np.int32) * vectors.shape[2])
            columns = [pa.array(row.astype(np.int32)), pa.array(ids[row, column]), pa.array(score[row, column]), pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score", "vector"])

    hits = rows.select("id", "vector").mapInArrow(best, "query int, id bigint, score double, vector array<double>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).toArrow()
    needed = []
    if len(top):
        query, vectors = top["query"].to_numpy(), _matrix(top["vector"])
        needed = [index.ratios(sent.value[1][q], vectors[query == q]) for q in np.unique(query)]
    return max(1.0, float(np.quantile(np.concatenate(needed), target, method="higher")) * (1 + 1e-6)) if needed else 1.0


def search(table: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", ratio: float | None = None, target: float = TARGET, list_rows: int = LIST_ROWS, most_lists: int = MOST_LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product found for each query row.

    ``ratio`` None is measured for a recall of ``target``; an infinite one takes all lists.
    """
    spark = table.sparkSession
    kept = "float" if table.schema[vector].dataType.elementType == T.FloatType() else "double"
    rows = table.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast(f"array<{kept}>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    usual = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.max(length).alias("longest")).orderBy(F.desc("n"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("vector") == usual["size"])
    index = fit(rows, usual["n"], usual["longest"], list_rows, most_lists)
    ratio = tuned_ratio(rows, usual["n"], index, k, target) if ratio is None else ratio
    sent = spark.sparkContext.broadcast(pickle.dumps(index))

    def filed_under(lists_of) -> Iterator[pa.RecordBatch]:
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = per_process(("ann", hash(sent.value)), lambda: pickle.loads(sent.value))
            for batch in portions(batches):
                row, lists = lists_of(index, _matrix(batch.column(1)))
                for at in range(0, len(row), 1 << 15):
                    own = pa.array(row[at : at + (1 << 15)])
                    yield pa.RecordBatch.from_arrays([pa.array(lists[at : at + (1 << 15)].astype(np.int32)), batch.column(0).take(own), batch.column(1).take(own)], ["list", "id", "vector"])

        return listed

    kind = f"list int, id bigint, vector array<{kept}>"
    filed = materialise(rows.select("id", "vector").mapInArrow(filed_under(lambda index, x: index.places(x)), kind), "posting-lists")
    sizes = filed.groupBy("list").count()  # one row a list: bounded by the number of lists
    blocks = F.broadcast(sizes.select("list", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("n")))
    stored = filed.join(blocks, "list").select("list", F.pmod(F.xxhash64("id"), F.col("n")).cast("int").alias("block"), "id", "vector", F.lit(False).alias("asks"))
    queries = rows.where("asks").select("id", "vector").mapInArrow(filed_under(lambda index, x: index.probes(x, ratio)), kind)
    queries = queries.join(blocks, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"), "id", "vector", F.lit(True).alias("asks"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = stored.unionByName(queries).repartition(parts, "list", "block").sortWithinPartitions("list", "block", "asks", "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block's rows come first, by id, then its queries, which may be many
        key, held, names, matrix = None, [], None, None
        hits, size = [], 0  # a task's best of all its blocks meet before the shuffle
        for batch in portions(batches, 4096):
            lists, block, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "block", "asks"))
            changes = np.flatnonzero((lists[1:] != lists[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
            for at, to in zip([0, *changes.tolist()], [*changes.tolist(), len(lists)], strict=True):
                if (lists[at], block[at]) != key:
                    key, held, matrix = (lists[at], block[at]), [], None
                ids, vectors = batch.column("id").slice(at, to - at).to_numpy(), _matrix(batch.column("vector").slice(at, to - at))
                if not asks[at]:
                    held.append((ids, vectors))
                    continue
                if matrix is None:
                    names, matrix = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int64), vectors[:0])
                for q in range(0, len(ids) if len(names) else 0, 256):
                    hits.append(_best(ids[q : q + 256], vectors[q : q + 256], names, matrix, k))
                    size += hits[-1].num_rows
            if size > HELD_HITS:
                hits = [_merged(hits, k)]
                size = hits[0].num_rows
                if size > HELD_HITS // 2:  # bounded memory for any number of queries
                    yield hits.pop()
                    size = 0
        if hits:
            yield _merged(hits, k)

    hits = met.mapInArrow(compared, "query_id bigint, vec_id bigint, score double")
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _merged(hits: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """The ``k`` best of all hits of each query, an id once with its best score, ties to the smaller id."""
    query, vec, score = (np.concatenate([h.column(c).to_numpy() for h in hits]) for c in range(3))
    order = np.lexsort((-score, vec, query))
    query, vec, score = query[order], vec[order], score[order]
    fresh = np.concatenate(([True], (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])))[: len(query)]
    query, vec, score = query[fresh], vec[fresh], score[fresh]
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    top = np.arange(len(query)) - np.searchsorted(query, query) < k
    return pa.RecordBatch.from_arrays([pa.array(query[top]), pa.array(vec[top]), pa.array(score[top], pa.float64())], ["query_id", "vec_id", "score"])


def _best(ids: np.ndarray, queries: np.ndarray, names: np.ndarray, matrix: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` best rows of a block for each query, other rows than its own; exact scores, ties to the smaller id.

    Ids may repeat; such rows count once, so that they cannot push others out.
    """
    near = queries @ matrix.T
    near[ids[:, None] == names[None, :]] = -np.inf
    # products of a matrix may differ in the last bits from those of single rows
    slack = (1e-12 * np.linalg.norm(queries, axis=1) * np.linalg.norm(matrix, axis=1).max())[:, None]
    again = np.concatenate(([False], names[1:] == names[:-1]))  # rows come by id
    if again.any():
        first = np.flatnonzero(~again)
        best = np.maximum.reduceat(near, first, axis=1)
        spread = np.repeat(best, np.diff([*first, len(names)]), axis=1)
        near = np.where(near >= spread - slack, near, -np.inf)
    wanted = min(len(names), k + int(again.sum()))
    cut = np.partition(near, -wanted, axis=1)[:, -wanted]
    row, column = np.nonzero((near >= cut[:, None] - slack) & np.isfinite(near))
    exact = (queries[row] * matrix[column]).sum(1)
    order = np.lexsort((names[column], -exact, row))
    row, column, exact = row[order], column[order], exact[order]
    fresh = np.concatenate(([True], (row[1:] != row[:-1]) | (names[column][1:] != names[column][:-1])))[: len(row)]
    row, column, exact = row[fresh], column[fresh], exact[fresh]
    begin = np.searchsorted(row, np.arange(len(ids)))
    top = np.arange(len(row)) - begin[row] < k
    return pa.RecordBatch.from_arrays([pa.array(ids[row[top]]), pa.array(names[column[top]]), pa.array(exact[top], pa.float64())], ["query_id", "vec_id", "score"])
