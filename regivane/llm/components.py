"""Connected components of an edge table by contraction in parts and alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regivane.llm.common import discard, materialise

#: Edges of one part, which a task holds.
PART_EDGES = 1 << 20


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of every node but the least ones."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        x, y = parent[one], parent[two]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]
    below = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[below], nodes[parent[below]]


def _contracted(edges: DataFrame, parts: int) -> DataFrame:
    """The edges (u, v) dealt over ``parts``, each part replaced by the stars that span its components."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            kind = table.schema.field("u").type
            u, v = spanning_stars(*(table.column(c).to_numpy() for c in ("u", "v")))
            for at in range(0, len(u), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)], kind) for x in (u, v)], ["u", "v"])

    return edges.repartition(parts).mapInArrow(stars, edges.schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every id of ``edges``: root is the least id of its component.

    The edges are dealt into parts of at most about ``PART_EDGES`` and each is replaced by
    spanning stars, which a task finds in bounded memory.  One part is thereby solved.  Several
    go on by large-star and small-star steps, until the edges no longer change, which takes
    about the logarithm of the widest path.  Each step joins on node ids only and is written
    to the shared folder; what it has read is removed then.  Ids are of any one type.  Edges of
    a node to itself and nulls are ignored; an empty table gives no rows.
    """
    proper = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    first = materialise(proper.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    parts = -(-first.count() // PART_EDGES)
    now = materialise(_contracted(first, max(1, parts)), "stars")
    discard(first)
    before = None
    while parts > 1:
        state = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            break
        before = state
        # every node hands its larger neighbours to the least node it sees
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # written, so that the join has a plain shuffle on both sides and a hub's rows can be split
        least = materialise(least, "least")
        held = [now, least]
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # every node hands its smaller neighbours, and itself, to the least of them
        large = materialise(large, "large-star")
        discard(*held)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = materialise(small, "small-star")
        discard(large)
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
