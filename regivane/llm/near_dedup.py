"""Near-duplicate documents by BagMinHash signatures over weighted word shingles.

A document is the multiset of its five-word shingles (lower-cased runs of letters and
digits).  For each shingle and each dyadic weight interval a Poisson process, seeded by the
shingle, throws points at signature registers in order of time; a register keeps the earliest
point whose weight position the document's count covers.  Two registers agree with exactly
the probability of the weighted Jaccard similarity.  Processes stop once they are later than
every register.

The splits of an interval by a point's position are drawn at once, as one uniform number,
and not level by level; the points have the same distribution.

Equal multisets collapse first.  Bands of registers link each document to the least one of
its bucket; the exact multiset overlap of each linked pair decides, and the components of
links that hold are first classes.  A bucket whose members are of one class is settled.  In
the others, every member is compared with all others exactly: the bucket is dealt into blocks
of bounded size, block pairs are spread over tasks, and an index of shared shingles in each
block finds who overlaps.  Only links that join two
classes leave a block, so nothing grows with the square of a bucket but the exact work on
what no link has settled.  Classes are the components of verified links.

Defined results: texts without a word are alike only if equal (null counts as empty); fewer
than five words make one shingle; the class id is the least doc_id of the class; ids are of
any one type; rows with null doc_id get a null class; repeated rows share a class; an empty
table gives no rows; other columns are ignored; a text of any length is read whole, a task
holds its shingles, and what is kept between texts (short words only) does not grow with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane.llm.common import MEMO_CHARS, discard, materialise, per_process, portions
from regivane.llm.components import components
from regivane.sources.readers import number_lines

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 6
#: Shingles, and documents, in one block of a candidate group.
BLOCK_ELEMENTS, BLOCK_MEMBERS = 100_000, 512
#: Ids that may be broadcast, 8 bytes each; beyond this a join shuffles.
BROADCAST_IDS = 1_000_000

_WORD = re.compile(r"\w+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the public splitmix64 finaliser)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted shingle hashes of a text; word hashes come from a memo."""

    def __init__(self, words: int = WORDS, memo: int = 1 << 18):
        self.words, self.limit, self.memo = words, memo, {}
        self.powers = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(words)], dtype=np.uint64)

    def word_hashes(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        fresh = set(words).difference(memo)
        if fresh:
            if len(memo) + len(fresh) > self.limit:
                memo.clear()
                fresh = set(words)
            memo.update((w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))) for w in fresh)
        out = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
        for w in fresh:
            if len(w) > MEMO_CHARS:
                del memo[w]
        return out

    def hashes(self, text: str) -> np.ndarray:
        words = _WORD.findall(text.lower())
        if not words:
            return np.zeros(0, dtype=np.uint64)
        h = self.word_hashes(words)
        size = min(self.words, len(h))
        out = np.zeros(len(h) - size + 1, dtype=np.uint64)
        for k in range(size):
            out += h[k : k + len(out)] * self.powers[k]
        return np.sort(mix(out))


def elements(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct codes of (shingle, occurrence): overlap of multisets becomes overlap of sets."""
    if not len(hashes):
        return hashes
    first = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    nth = np.arange(len(hashes)) - np.maximum.accumulate(np.where(first, np.arange(len(hashes)), 0))
    return np.sort(np.where(nth == 0, hashes, mix(hashes ^ mix(nth.astype(np.uint64)))))


def bag_minhash(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """Signatures (docs x registers, earliest times) of integer-weighted elements.

    Row k says that document ``owner[k]`` has element ``key[k]`` ``weight[k]`` times.
    """
    top = int(weight.max(initial=0))
    parts = []
    level, low = 0, 0
    with np.errstate(over="ignore"):
        while low < top:  # intervals (0, 1], (1, 2], (2, 4], (4, 8], ...
            own = np.flatnonzero(weight > low)
            width = max(1, low)
            parts.append((owner[own], mix(key[own] ^ np.uint64(level)), np.full(len(own), float(width)), np.full(len(own), float(low)), weight[own].astype(float)))
            level, low = level + 1, low + width
        signature = np.full(docs * registers, np.inf)
        if not parts:
            return signature.reshape(docs, registers)
        doc, seed, rate, base, limit = (np.concatenate(x) for x in zip(*parts, strict=True))
        time, step = np.zeros(len(doc)), 0
        while len(doc):
            step += 1
            draw = mix(seed + np.uint64(step) * _GOLDEN)
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate
            latest = signature.reshape(docs, registers).max(axis=1)
            live = time < latest[doc]
            if not live.all():
                doc, seed, rate, base, limit, time, draw = (x[live] for x in (doc, seed, rate, base, limit, time, draw))
            at = mix(draw)
            register = (at >> np.uint64(32)) % np.uint64(registers)
            # where in the interval the point lies: the splits of the interval, all drawn at once
            place = base + rate * (((at & np.uint64(0xFFFFFFFF)).astype(float) + 0.5) * 2.0**-32)
            inside = (rate == 1.0) | (place <= limit)
            np.minimum.at(signature, doc[inside] * registers + register[inside].astype(np.int64), time[inside])
    return signature.reshape(docs, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 63-bit key for each document and band."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        key = np.tile(mix(np.arange(bands, dtype=np.uint64)), (len(signature), 1))
        for k in range(rows):
            key = mix(key ^ bits[:, :, k]) if k else mix(key + bits[:, :, k])
    return (key >> np.uint64(1)).astype(np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, print binary, size long, bands array<long>): fingerprint of the shingle multiset and its band keys."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = per_process(("shingler", WORDS), Shingler)
        for batch in portions(batches):
            with np.errstate(over="ignore"):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                hashes = [shingler.hashes(t) for t in texts]
            prints = [xxhash.xxh3_128_digest(h.tobytes()) if len(h) else b"-" + xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for h, t in zip(hashes, texts, strict=True)]
            counted = [np.unique(h, return_counts=True) for h in hashes]
            keys: list = [[]] * len(texts)
            todo = [k for k, h in enumerate(hashes) if len(h)]
            if todo:
                owner = np.repeat(np.arange(len(todo)), [len(counted[k][0]) for k in todo])
                signature = bag_minhash(owner, np.concatenate([counted[k][0] for k in todo]), np.concatenate([counted[k][1] for k in todo]), len(todo), bands * rows)
                for k, row in zip(todo, band_keys(signature, bands, rows).tolist(), strict=True):
                    keys[k] = row
            columns = [batch.column(0), pa.array(prints, pa.binary()), pa.array([len(h) for h in hashes], pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "print", "size", "bands"])

    return docs.select(doc_id, text).mapInArrow(signed, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, print binary, size bigint, bands array<bigint>")


def with_ids(df: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows whose ``column`` is (``left_anti``: is not) in ``ids``; numbers are broadcast below a checked count."""
    if ids.schema[column].dataType.simpleString() in ("int", "bigint") and ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, column, how)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def alike(both, a, b, similarity: float):
    """Whether an overlap of two multisets of given sizes is a weighted Jaccard similarity of at least ``similarity``."""
    return both >= similarity * (a + b - both) - 1e-9


def verified_pairs(texts: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of at least ``similarity``; ``texts`` has (doc_id, text), one row a document."""
    kind = pairs.schema["a"].dataType.simpleString()
    own = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("one")), "a")
    # plain shuffles on both sides, so that the rows of a document that many link to can be split
    both = own.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("two")), "b").select("a", "b", "one", "two")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = per_process(("shingler", WORDS), Shingler)
        for batch in portions(batches):
            known: dict[str, np.ndarray] = {}  # a linked document stands in many rows
            marks = []
            with np.errstate(over="ignore"):
                for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True):
                    x, y = (known[t] if t in known else known.setdefault(t, elements(shingler.hashes(t))) for t in (one or "", two or ""))
                    smaller, larger = sorted((len(x), len(y)))
                    marks.append(smaller >= similarity * larger - 1e-9 and alike(_overlap(x, y), len(x), len(y), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(marks, pa.bool_()))

    return both.mapInArrow(kept, f"a {kind}, b {kind}")


def verified_links(docs: DataFrame, groups: DataFrame, doc_id: str, text: str, similarity: float = SIMILARITY, block_elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """(a, b): classes of a candidate group that a link of at least ``similarity`` joins.

    ``groups`` has (doc_id, root, size) and class, the least document of those known to be
    linked; without it each document is a class.  A group is dealt into blocks by hash; every
    pair of blocks meets in one task, whatever its size.
    """
    if "class" not in groups.columns:
        groups = groups.withColumn("class", F.col("doc_id"))
    blocks = groups.groupBy("root").agg(F.greatest(F.ceil(F.sum("size") / block_elements), F.ceil(F.count("*") / BLOCK_MEMBERS)).cast("int").alias("n"))
    dealt = groups.join(blocks, "root").select("doc_id", "root", "class", "n", F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int").alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.select("doc_id", "root", "class", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block")
    texts = with_ids(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), groups.select("doc_id"), "doc_id")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = texts.join(dealt, "doc_id").repartition(parts, "root", "one", "two").sortWithinPartitions("root", "one", "two", "doc_id")
    kind = docs.schema[doc_id].dataType.simpleString()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = per_process(("shingler", WORDS), Shingler)
        key, members, ids = None, [], None
        for batch in portions(batches):
            ids = batch.schema.field("doc_id").type
            for doc, value, root, one, two, block, class_ in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "root", "one", "two", "block", "class")), strict=True):
                if (root, one, two) != key:
                    if len(members) > 1:
                        yield _links(members, similarity, ids)
                    key, members = (root, one, two), []
                if not members or members[-1][0] != doc:  # repeated rows
                    with np.errstate(over="ignore"):
                        members.append((doc, elements(shingler.hashes(value or "")), block if one != two else -1, class_))
        if len(members) > 1:
            yield _links(members, similarity, ids)

    return met.mapInArrow(linked, f"a {kind}, b {kind}")


class SharedCodes:
    """An index of the codes that several members of a block have."""

    def __init__(self, members: list[np.ndarray]):
        self.n, sizes = len(members), [len(e) for e in members]
        owner = np.repeat(np.arange(self.n), sizes)
        codes, count = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)[1:]
        shared = count[codes] > 1  # a code of one member joins nobody
        owner, self.codes = owner[shared], codes[shared]
        self.begins = np.concatenate(([0], np.cumsum(np.where(count > 1, count, 0))))
        self.having = owner[np.argsort(self.codes, kind="stable")]
        self.starts = np.searchsorted(owner, np.arange(self.n + 1))

    def overlaps(self, k: int) -> np.ndarray:
        """How many codes each member has in common with member ``k``."""
        own = self.codes[self.starts[k] : self.starts[k + 1]]
        n = self.begins[own + 1] - self.begins[own]
        at = np.repeat(self.begins[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.having[at], minlength=self.n)


def _links(members: list, similarity: float, kind: pa.DataType) -> pa.RecordBatch:
    """Pairs of classes that the members' exact overlap joins (of two blocks: overlap between the blocks).

    Shingles lead to the members that have them, so a member meets only those it overlaps with.
    """
    first: dict = {}
    parent = [first.setdefault(c, k) for k, (_, _, _, c) in enumerate(members)]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    sizes = np.array([len(e) for _, e, _, _ in members])
    index = SharedCodes([e for _, e, _, _ in members])
    side = np.array([s for _, _, s, _ in members])
    label = np.array(parent)
    a, b = [], []
    for k in range(len(members) - 1):
        # a class's other members need no further look at what is in the class already
        open_ = (label != label[k]) & ((side != side[k]) | (side == -1))
        open_[:k] = False
        if not open_.any():
            continue
        both = index.overlaps(k)
        found = np.flatnonzero(open_ & (both > 0) & alike(both, sizes, sizes[k], similarity))
        for j in found.tolist():
            x, y = root(k), root(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(members[k][3])
                b.append(members[j][3])
        if len(found):
            label = np.array([root(x) for x in range(len(members))])
    return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id, exact_id): one row for each row of ``docs``.

    ``exact_id`` is the least doc_id with the same shingle multiset, ``class_id`` that of the
    whole near-duplicate class.
    """
    signed = materialise(signatures(docs, doc_id, text, bands, rows), "signatures")
    # written first, so that a multiset with very many copies can be split in the join below
    first = materialise(signed.where("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("exact_id")), "first-copies")
    named = materialise(signed.select("doc_id", "print").join(first, "print", "left"), "exact-classes")
    # one document stands for each multiset; its rows may be repeated
    banded = with_ids_of(signed, first).select("doc_id", "size", F.explode("bands").alias("band"))
    ends = banded.groupBy("band").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least != most")
    # members of buckets of several documents
    banded = materialise(banded.join(ends.select("band", "least"), "band"), "buckets")
    pairs = materialise(banded.where("doc_id != least").select(F.col("doc_id").alias("a"), F.col("least").alias("b")).distinct(), "band-pairs")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    some = materialise(with_ids(texts, banded.select("doc_id").distinct(), "doc_id").dropDuplicates(["doc_id"]), "banded-texts")
    near = materialise(verified_pairs(some, pairs, similarity), "near-pairs")
    early = components(near)
    known = banded.join(early.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("class", F.coalesce("root", "doc_id"))
    known = materialise(known.select("doc_id", "size", "band", "class").distinct(), "bucket-classes")
    # all members of a bucket of several classes are compared; of buckets with the same members, one is
    open_ = known.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("members"), F.count("*").alias("n")).where("low != high")
    open_ = open_.groupBy("members", "n").agg(F.min("band").alias("band")).select("band")
    groups = materialise(known.join(open_, "band").select("doc_id", F.col("band").alias("root"), "size", "class"), "open-buckets")
    late = verified_links(some, groups, "doc_id", "text", similarity)
    joined = components(late)
    discard(signed, first, banded, pairs, some, near, known, groups)
    result = named.join(early.select(F.col("id").alias("exact_id"), F.col("root").alias("early")), "exact_id", "left").withColumn("early", F.coalesce("early", "exact_id"))
    result = result.join(joined.select(F.col("id").alias("early"), "root"), "early", "left").withColumn("root", F.coalesce("root", "early"))
    return result.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "exact_id")).alias("class_id"), F.when(F.col("doc_id").isNotNull(), F.col("exact_id")).alias("exact_id"))


def with_ids_of(signed: DataFrame, first: DataFrame) -> DataFrame:
    """The rows of ``signed`` that stand for their multiset, joined on fingerprint and id."""
    return signed.join(first.withColumnRenamed("exact_id", "doc_id"), ["print", "doc_id"], "left_semi")


def numbered_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "__row") -> DataFrame:
    """``docs`` with a number for each different pair of id and text, in the order of ids; null where the id is."""
    hashed = docs.withColumn("__hash", F.xxhash64(text))
    keys = hashed.where(F.col(doc_id).isNotNull()).select(doc_id, "__hash").distinct()
    return hashed.join(number_lines(keys, doc_id, "__hash", name=name, first=0), [doc_id, "__hash"], "left").select(*docs.columns, name)


def has_repeated_ids(docs: DataFrame, doc_id: str = "doc_id") -> bool:
    return docs.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1").limit(1).count() > 0


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class, the least doc_id of it; rows with null doc_id stay.

    Where a doc_id repeats, its different texts are documents of their own, and of rows equal in
    id and text one stays.
    """
    found = materialise(classes(docs, doc_id, text, **options), "near-classes")
    columns, key = docs.columns, doc_id
    repeated = has_repeated_ids(found)
    if repeated:
        key = "__row"
        docs = materialise(numbered_texts(docs, doc_id, text, key), "numbered-texts")
        found = materialise(classes(docs, key, text, **options), "near-classes")
    gone = found.where("doc_id != class_id").select(F.col("doc_id").alias(key)).distinct()
    kept = with_ids(docs, gone, key, "left_anti")
    if repeated:
        kept = kept.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(kept.where(F.col(key).isNull()))
    return kept.select(columns)
