"""Ranked lexical search by a two-level quantised index.

Terms are runs of ASCII letters, digits and non-ASCII characters; only A-Z are lower-cased.  A
document's score for an item sums, over the item's terms, a weight of the term times an integer
impact below 10^6 that follows from the term's occurrences and the document's relative length
(:func:`impacts`).

The index is cut into shards of bounded size, dealt as the documents are, so no posting is
shuffled.  Its two levels are tables with one row for each shard:

* level 2, exact: terms, and for each the documents that have it and how often; lengths.
* level 1, quantised: the same documents, with one byte for each posting, the impact divided by
  a unit and rounded upward.

A sum of weights times bytes is an upper bound of a score, in units; the same less the weights of
the item's terms is a lower one.  A search takes the items in blocks of bounded size.  For a block
the tasks first count in how many documents its terms are; then they read level 1 alone and keep,
for each item, the ``k`` largest lower bounds, of which the ``k``-th over all tasks is the item's
limit; and last they rescore, in exact integers from level 2, every document whose upper bound
reaches its item's limit.  A task hands on its ``k`` best of these, so groups of equal documents
of any size stay in their tasks.  A shard none of whose documents reaches a limit is not rescored.

Defined results: documents without a term (null and empty texts too) are not counted and never
found; each row is a document, so repeated rows are found, and ranked, each by itself, and a null
doc_id comes last among equal scores; repeated items (id and text) are one, items with equal ids
and different texts are ranked each by itself; items without a term that a document has find
nothing; empty tables give no rows; other columns are ignored; a text of any length is read whole.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regivane.llm.common import give_back, materialise, portions
from regivane.storage import LARGE_ROWS

#: Documents found for each item.
BEST = 10
#: Postings of a shard at most, but for single documents.
SHARD_POSTINGS = 1 << 18
#: Items, and their terms, that are sent to the tasks at once; a longer item is a block of its own.
BLOCK_ITEMS, BLOCK_TERMS = 512, 1 << 16
#: Impacts are below this; a byte counts units of impact.
MOST_IMPACT = 1_000_000
UNIT = -(-MOST_IMPACT // 255)

#: Every byte that ends a term becomes a space, A-Z become a-z; bytes of non-ASCII characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def relative_length(n: int, documents: int, tokens: int) -> int:
    """Percent of the mean length, nine parts of it, and ten."""
    return 10 + (90 * n * documents) // tokens


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer impacts of terms that occur ``tf`` times in documents of relative lengths ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    """The weight of a term that ``df`` documents have."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Index:
    """Both levels, the number of documents with a term and that of all their terms."""

    exact: DataFrame
    quantised: DataFrame
    documents: int
    tokens: int


def numbering() -> dict[bytes, int]:
    """Numbers terms as they come; it does not refer to itself, so that it is freed with its shard and not when Python looks for cycles."""
    return defaultdict(count().__next__)


def _shard(names: pa.Array, lengths: list[int], words: dict[bytes, int], tokens: list[np.ndarray]) -> pa.RecordBatch:
    """One row of level 2; ``tokens`` are the numbers of each document's terms, in order of ``words``."""
    n = len(lengths)
    owner = np.repeat(np.arange(n, dtype=np.int64), [len(t) for t in tokens])
    postings, tf = np.unique(np.concatenate(tokens).astype(np.int64) * n + owner, return_counts=True)
    counts = np.bincount(postings // n, minlength=len(words))
    one = lambda values, kind: pa.array([values], kind)
    columns = [
        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), names),
        one(lengths, pa.list_(pa.int64())),
        one([w.decode("utf-8", "surrogatepass") for w in words], pa.list_(pa.string())),
        one(counts.astype(np.int32), pa.list_(pa.int32())),
        pa.array([(postings % n).astype(np.uint32).tobytes()], pa.binary()),
        pa.array([tf.astype(np.int64).astype(np.uint32).tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["docs", "lengths", "terms", "counts", "places", "tfs"])


def exact_postings(docs: DataFrame, doc_id: str, text: str, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Level 2: rows (docs, lengths, terms, counts, places, tfs), one for each shard."""

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            return numbering(), [], [], []

        (words, names, lengths, tokens), size = fresh(), 0
        for batch in portions(batches):
            for k, value in enumerate(batch.column(1).to_pylist()):
                if own := terms_of(value):
                    numbers = np.fromiter(map(words.__getitem__, own), np.int32, len(own))
                    names.append(batch.column(0).slice(k, 1))
                    lengths.append(len(own))
                    tokens.append(numbers)
                    size += len(own)
                    if size >= shard_postings:
                        yield _shard(pa.concat_arrays(names), lengths, words, tokens)
                        (words, names, lengths, tokens), size = fresh(), 0
        if names:
            yield _shard(pa.concat_arrays(names), lengths, words, tokens)
        give_back()

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(sharded, f"docs array<{kind}>, lengths array<bigint>, terms array<string>, counts array<int>, places binary, tfs binary")


def _relative(lengths: pa.Scalar, documents: int, tokens: int) -> np.ndarray:
    return np.array([relative_length(n, documents, tokens) for n in lengths.as_py()], dtype=np.int64)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_postings: int = SHARD_POSTINGS) -> Index:
    """Index every row of ``docs``: one pass over the texts, one over level 2."""
    exact = materialise(exact_postings(docs, doc_id, text, shard_postings), "postings", LARGE_ROWS)
    sums = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda s, n: s + n)
    documents, tokens = exact.agg(F.coalesce(F.sum(F.size("docs").cast("bigint")), F.lit(0)), F.coalesce(F.sum(sums), F.lit(0))).first()

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1):
            m = _relative(batch.column("lengths")[0], documents, tokens)
            places, tf = (np.frombuffer(batch.column(c)[0].as_py(), dtype=np.uint32).astype(np.int64) for c in ("places", "tfs"))
            units = -(-impacts(tf, m[places]) // UNIT)
            yield pa.RecordBatch.from_arrays([pa.array([len(m)], pa.int32()), *(batch.column(c) for c in ("terms", "counts", "places")), pa.array([units.astype(np.uint8).tobytes()], pa.binary())], ["n", "terms", "counts", "places", "units"])

    quantised = exact.select("lengths", "terms", "counts", "places", "tfs").mapInArrow(rounded, "n int, terms array<string>, counts array<int>, places binary, units binary")
    return Index(exact, materialise(quantised, "impacts", LARGE_ROWS), documents, tokens)


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, terms): each item's terms once, items without one left out."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [[t.decode("utf-8", "surrogatepass") for t in dict.fromkeys(terms_of(v))] for v in batch.column(1).to_pylist()]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["item_id", "terms"])
            yield out.filter(pa.array([bool(f) for f in found], pa.bool_()))

    kind = items.schema[item_id].dataType.simpleString()
    return items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct().mapInArrow(listed, f"item_id {kind}, terms array<string>")


def blocks(items: DataFrame, most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> Iterator[list]:
    """The items (item_id, terms) in lists of bounded size; the driver holds a partition of items and a block."""
    held, size = [], 0
    for row in items.toLocalIterator():
        if held and (len(held) >= most_items or size + len(row.terms) > most_terms):
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row.terms)
    if held:
        yield held


class Query:
    """A block of items: the number of each term, and each item's terms by number with their weights."""

    def __init__(self, items: list, frequencies: dict[str, int], documents: int):
        names = sorted(frequencies)
        self.numbers = {t: k for k, t in enumerate(names)}
        self.weights = np.array([weight(documents, frequencies[t]) for t in names], dtype=np.int64)
        self.items = [np.array([self.numbers[t] for t in row.terms if t in self.numbers], dtype=np.int64) for row in items]


class Shard:
    """The postings of one shard for the terms of a query."""

    def __init__(self, n: int, terms: list[str], counts: np.ndarray, places: bytes, query: Query):
        self.n, self.query = n, query
        ends = np.cumsum(counts)
        wanted = query.numbers.get
        self.at = {number: (int(ends[k] - counts[k]), int(ends[k])) for k, t in enumerate(terms) if (number := wanted(t)) is not None}
        self.places = np.frombuffer(places, dtype=np.uint32)

    def bounds(self, units: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        """(item, upper bounds of all documents, weights of its terms here) of each item with a term here; in units."""
        scaled = {number: units[a:b].astype(np.float64) * self.query.weights[number] for number, (a, b) in self.at.items()}
        for item, numbers in enumerate(self.query.items):
            own = [x for x in numbers.tolist() if x in scaled]
            if own:
                places = np.concatenate([self.places[slice(*self.at[x])] for x in own])
                # sums of integers below 2^53
                upper = np.bincount(places, np.concatenate([scaled[x] for x in own]), self.n)
                yield item, upper, int(self.query.weights[own].sum())

    def scores(self, item: int, tf: np.ndarray, m: np.ndarray, known: dict[int, np.ndarray]) -> np.ndarray:
        """Exact scores of all documents for an item; ``known`` keeps the terms' shares between items."""
        total = np.zeros(self.n, dtype=np.int64)
        for number in self.query.items[item].tolist():
            if number in self.at:
                a, b = self.at[number]
                if number not in known:
                    known[number] = self.query.weights[number] * impacts(tf[a:b], m[self.places[a:b]])
                total[self.places[a:b]] += known[number]
        return total


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    return values if len(values) <= k else np.partition(values, len(values) - k)[len(values) - k :]


def document_frequencies(index: Index, items: list) -> dict[str, int]:
    """In how many documents the terms of a block are; terms in none are left out."""
    spark = index.exact.sparkSession
    wanted = spark.sparkContext.broadcast(frozenset(t for row in items for t in row.terms))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = defaultdict(int)
        for batch in portions(batches, 8):
            for terms, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for term, n in zip(terms, counts, strict=True):
                    if term in wanted.value:
                        found[term] += n
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

    return {r.term: r.n for r in index.quantised.select("terms", "counts").mapInArrow(counted, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _shards(batches: Iterator[pa.RecordBatch], query: Query) -> Iterator[tuple[Shard, Callable[[str], pa.Scalar]]]:
    for batch in portions(batches, 1):
        of = lambda name, b=batch: b.column(name)[0]
        yield Shard(len(of("docs")) if "docs" in batch.schema.names else of("n").as_py(), of("terms").as_py(), of("counts").values.to_numpy(), of("places").as_py(), query), of


def limits(index: Index, sent, k: int) -> DataFrame:
    """(item, limit): the ``k``-th largest lower bound of each item, in units, 0 if there are fewer documents."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for shard, of in _shards(batches, sent.value):
            for item, upper, slack in shard.bounds(np.frombuffer(of("units").as_py(), dtype=np.uint8)):
                lower = _largest(upper, k) - slack
                best[item] = _largest(np.concatenate([best.get(item, lower[:0]), lower[lower > 0]]), k)
        if best:
            items = np.repeat(np.array(list(best), dtype=np.int32), [len(b) for b in best.values()])
            yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(np.concatenate(list(best.values())).astype(np.int64))], ["item", "lower"])

    found = index.quantised.mapInArrow(bounded, "item int, lower bigint")
    order = Window.partitionBy("item").orderBy(F.desc("lower"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.groupBy("item").agg(F.when(F.count("*") >= k, F.min("lower")).otherwise(0).cast("bigint").alias("limit"))


def rescored(index: Index, sent, reached, k: int) -> DataFrame:
    """(item, doc_id, score): of each task the ``k`` best documents whose upper bounds reach their items' limits."""
    kind = index.exact.schema["docs"].dataType.elementType.simpleString()
    documents, tokens = index.documents, index.tokens

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = defaultdict(list)
        id_kind = None
        for shard, of in _shards(batches, sent.value):
            names, id_kind = of("docs").values, of("docs").values.type
            m = _relative(of("lengths"), documents, tokens)
            tf = np.frombuffer(of("tfs").as_py(), dtype=np.uint32).astype(np.int64)
            units, known = -(-impacts(tf, m[shard.places]) // UNIT), {}
            for item, upper, _ in shard.bounds(units):
                open_ = np.flatnonzero((upper >= reached.value.get(item, 0)) & (upper > 0))
                if len(open_):
                    exact = shard.scores(item, tf, m, known)[open_]
                    least = _largest(exact, k).min()
                    for place, score in zip(open_[exact >= least].tolist(), exact[exact >= least].tolist(), strict=True):
                        name = names[place].as_py()
                        best[item].append((-score, name is None, name))
                    best[item] = sorted(best[item], key=lambda hit: hit if not hit[1] else hit[:2])[:k]
        rows = [(item, hit[2], -hit[0]) for item, hits in best.items() for hit in hits]
        if rows:
            item, name, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(name, id_kind), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return index.exact.mapInArrow(scored, f"item int, doc_id {kind}, score bigint")


def search(index: Index, items: DataFrame, k: int = BEST, item_id: str = "item_id", text: str = "text", most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``k`` documents of highest score above 0, equal scores by doc_id."""
    spark = items.sparkSession
    asked = materialise(_items(items, item_id, text), "items")
    schema = f"item_id {asked.schema['item_id'].dataType.simpleString()}, rank int, doc_id {index.exact.schema['docs'].dataType.elementType.simpleString()}, score bigint"
    parts = [spark.createDataFrame([], schema)]
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in blocks(asked, most_items, most_terms):
        sent = spark.sparkContext.broadcast(Query(block, document_frequencies(index, block), index.documents))
        reached = spark.sparkContext.broadcast({r.item: r.limit for r in limits(index, sent, k).collect()})  # one row an item of the block
        hits = rescored(index, sent, reached, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, row.item_id) for n, row in enumerate(block)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        found = hits.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        parts.append(materialise(found, "ranked"))
        sent.destroy()
        reached.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
