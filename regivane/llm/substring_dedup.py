"""Repeated passages across documents: paragraph MinHash banding, exact windows, components.

Two kinds of paragraphs are joined.  Lines of at least 50 words are compared by MinHash over
their five-word shingles, in bands tuned for the wanted recall at similarity 0.8; lines that
share a band are verified by the exact Jaccard similarity of their shingles, each against all
others of the band, in blocks.

A passage may also stand in the middle of other text, where no line shows it.  So texts are
cut by content as well: of any 25 runs of 26 words in a row the one with the least hash is a
band key; any two equal passages of 50 words hold the same key at the same place.  Where a
key's context (the 24 words on each side) is that of an earlier document, all windows of 50
words around the key are, and the context goes.  A key that has several contexts leaves the
question open; then every window of 50 words around its occurrences is looked up by itself.
So exactly those words go that lie in a window of 50 words which an earlier document has (or
in a context, or line, that one has): no partner is skipped and none depends on partitions.
Equality is that of two independent 64-bit hashes of the words.

Occurrences with equal context meet inside each partition first and leave one row for it, and
a key with several contexts in a partition leaves one row in all, however hot it is; what is
linked on one diagonal of two documents is one row.  The later occurrence goes, so the least
document keeps every passage.  Removals are clustered by components of links.

Defined results: null and empty texts have no passages; passages repeated inside one document
alone stay; rows with null doc_id take no part; rows that repeat a doc_id count as one document
(of different texts one is compared; places beyond the end of another are not cut); doc_id is a
long; an empty table gives no rows; other columns pass through; a text of any length is cut
whole, a task holds its words' hashes and those of ``FLUSH`` keys, and nothing else grows with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane.llm.common import MEMO_CHARS, discard, materialise, per_process, portions
from regivane.llm.components import components
from regivane.llm.near_dedup import SharedCodes, alike, mix, with_ids

PASSAGE, GRAM = 50, 26
#: Words on each side of a key that the windows around it reach, and the keys of a window, of which one is taken.
SIDE, SPREAD = PASSAGE - GRAM, PASSAGE - GRAM + 1
SHINGLE, SIMILARITY, REGISTERS, RECALL = 5, 0.8, 24, 0.995
#: Occurrences that meet inside a partition before they are passed on.
FLUSH = 400_000
#: Words of the lines of one band that are compared in one block.
BLOCK_WORDS = 100_000
#: Words of a text whose pieces are asked for together.
PORTION_WORDS = 1 << 16

_RUN = re.compile(r"\S+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1B54A32D192ED03)
#: Kinds of rows of the first pass: the first occurrence of a context, a link inside a partition, a line, and an occurrence whose windows are looked up.
HEAD, LINK, LINE, ASKED = range(4)
_ROWS = "kind int, key bigint, context bigint, doc bigint, start bigint, words bigint, source bigint, source_start bigint, several boolean, bands array<bigint>"
_PIECES = "doc bigint, low bigint, high bigint, piece string"
_PAIR = ("doc", "first", "last", "source", "source_first", "source_last")


def tune_bands(registers: int = REGISTERS, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose chance to meet at ``similarity`` is at least ``recall``."""
    fit = [(registers // r, r) for r in range(1, registers + 1) if 1 - (1 - similarity**r) ** (registers // r) >= recall]
    return max(fit, key=lambda x: x[1])


def _slide(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``size``, by doubling."""
    width = 1
    while 2 * width <= size:
        x = pick(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return pick(x[:-rest], x[rest:]) if rest else x


def gram_hashes(hashes: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Hashes of all runs of each of the ``sizes``, put together from runs of 1, 2, 4, ... words."""
    base, powers, width = 0x9E3779B97F4A7C15, {1: hashes}, 1
    while 2 * width <= min(max(sizes), len(hashes)):
        x = powers[width]
        powers[2 * width] = x[:-width] * np.uint64(pow(base, width, 1 << 64)) + x[width:]
        width *= 2
    out = []
    for size in sizes:
        if len(hashes) < size:
            out.append(np.zeros(0, dtype=np.uint64))
            continue
        n, at, sum_ = len(hashes) - size + 1, 0, None
        for w in sorted(powers, reverse=True):
            if size & w:
                x = powers[w][at : at + n]
                sum_ = x if sum_ is None else sum_ * np.uint64(pow(base, w, 1 << 64)) + x
                at += w
        out.append(mix(sum_))
    return out


def _spaces() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[cp for cp in range(0x3001) if chr(cp).isspace()]] = True
    return table


class Words:
    """Hashes of the words (runs between white space) of some texts, with ``SIDE`` ends (hash 0) before and behind each text.

    ``begin`` and ``n`` say where a text's words begin among ``hashes``, and how many it has;
    ``line`` numbers the lines of all texts, by word, and ``at`` has each word's place.
    """

    def __init__(self, texts: list[str], spaces: np.ndarray):
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        inside = ~spaces[points]
        edges = np.diff(inside.view(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        ahead = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))[: len(texts)]
        owner = np.searchsorted(ahead, start, side="right") - 1
        length, own = end - start, np.zeros(len(start), dtype=np.uint64)
        left = np.arange(len(start))
        for k in range(int(min(MEMO_CHARS, length.max(initial=0)))):
            left = left[length[left] > k]
            own[left] = own[left] * _BASE + points[start[left] + k] + np.uint64(1)
        for k in np.flatnonzero(length > MEMO_CHARS).tolist():
            own[k] = xxhash.xxh3_64_intdigest(joined[start[k] : end[k]].encode("utf-8", "surrogatepass"))
        own = mix(own + length.astype(np.uint64) * _OTHER)
        self.n = np.bincount(owner, minlength=len(texts))
        self.begin = np.cumsum(self.n) - self.n + SIDE * np.arange(1, len(texts) + 1)
        self.at = np.arange(len(own)) + SIDE * (owner + 1)
        self.hashes = np.zeros(len(own) + SIDE * (len(texts) + 1), dtype=np.uint64)
        self.hashes[self.at] = own
        self.line = np.cumsum(points == 10)[start]

    def second(self) -> np.ndarray:
        """Independent hashes of the same words."""
        return np.where(self.hashes == 0, self.hashes, mix(self.hashes ^ _OTHER))

    def owner(self, place: np.ndarray) -> np.ndarray:
        """The text that holds each place."""
        return np.searchsorted(self.begin, place, side="right") - 1


def chosen(grams: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places that hold the least gram hash of some ``SPREAD`` grams in a row of one text."""
    if len(grams) < SPREAD:
        return np.zeros(0, dtype=np.int64)
    least = _slide(grams, SPREAD, np.minimum)
    long = n >= PASSAGE
    edges = np.zeros(len(least) + 1, dtype=np.int64)
    np.add.at(edges, begin[long], 1)
    np.add.at(edges, (begin + n - PASSAGE + 1)[long], -1)
    least = np.where(np.cumsum(edges[:-1]) > 0, least, 0)
    around = np.concatenate((np.zeros(SPREAD - 1, grams.dtype), least, np.zeros(SPREAD - 1, grams.dtype)))
    return np.flatnonzero(_slide(around, SPREAD, np.maximum) == grams)


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (n of them) for each pair, one after the other."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Cutter:
    """Band keys of content-cut paragraphs, and MinHash bands of long lines."""

    def __init__(self):
        self.spaces = _spaces()
        self.bands, self.rows = tune_bands()
        self.seeds = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
        self.tags = mix(np.arange(100, 100 + self.bands, dtype=np.uint64))

    def keys(self, words: Words) -> tuple[np.ndarray, ...]:
        """(key, context, text, start, words): ``start`` is the key's first word, ``words`` counts those of the context."""
        short, context = gram_hashes(words.hashes, GRAM, GRAM + 2 * SIDE)
        at = chosen(short, words.begin, words.n)
        text = words.owner(at)
        start = at - words.begin[text]
        size = np.minimum(start + GRAM + SIDE, words.n[text]) - np.maximum(start - SIDE, 0)
        return short[at], context[at - SIDE], text, start, size

    def lines(self, words: Words) -> tuple[np.ndarray, ...]:
        """(hash, other hash, text, start, words, bands) of each line of at least ``PASSAGE`` words."""
        first = np.flatnonzero(np.diff(words.line, prepend=-1))
        n = np.diff(first, append=len(words.line))
        first, n = first[n >= PASSAGE], n[n >= PASSAGE]
        if not len(first):
            return tuple(np.zeros(0, dtype=np.uint64) for _ in range(5)) + (np.zeros((0, self.bands), dtype=np.uint64),)
        place = words.at[first]
        own, ends = words.hashes[_ranges(place, n)], np.cumsum(n) - n
        order = mix(_ranges(np.zeros(len(n), dtype=np.int64), n).astype(np.uint64))
        whole, other = (np.add.reduceat(mix(own ^ mix(order + seed)), ends) for seed in (_BASE, _OTHER))
        grams = n - SHINGLE + 1
        shingles, begins = gram_hashes(words.hashes, SHINGLE)[0][_ranges(place, grams)], np.cumsum(grams) - grams
        least = np.stack([np.minimum.reduceat(shingles * seed, begins) for seed in self.seeds], axis=1)
        bands = np.tile(self.tags, (len(n), 1))
        for k in range(self.rows):
            bands = mix(bands ^ least[:, k :: self.rows][:, : self.bands])
        text = words.owner(place)
        return whole, other, text, place - words.begin[text], n, bands


def _batch(kind: int, n: int, **columns) -> pa.RecordBatch:
    """Rows of a kind; columns that are not given are null."""
    fields = [f.split(" ") for f in _ROWS.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}
    given = {"kind": np.full(n, kind, dtype=np.int32)} | columns
    arrays = []
    for name, type_ in fields:
        x = given.get(name)
        if x is None:
            arrays.append(pa.nulls(n, kinds[type_]))
        elif x.ndim == 2:
            arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(_signed(x).ravel())))
        else:
            arrays.append(pa.array(_signed(x), kinds[type_]))
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def met(held: list[tuple[np.ndarray, ...]], side: int, asks: bool) -> Iterator[pa.RecordBatch]:
    """What is left of occurrences (key, context, doc, start, words) once those of equal key and context have met.

    A context's first document keeps a row, others are linked to it.  With ``asks``, a key that
    several documents have in several contexts has the windows around these rows looked up, and
    leaves one row, which says so.
    """
    key, context, doc, start, words = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((start, doc, context, key))
    key, context, doc, start, words = (x[order] for x in (key, context, doc, start, words))
    fresh_key = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
    fresh = fresh_key.copy()
    fresh[1:] |= context[1:] != context[:-1]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
    own = doc == doc[head]
    later = np.flatnonzero(~own)
    yield from _merged(doc[later], np.maximum(start[later] - side, 0), words[later], doc[head[later]], np.maximum(start[head[later]] - side, 0))
    keep, several = own, np.zeros(len(key), dtype=bool)
    if asks and len(key):
        number, firsts = np.cumsum(fresh_key) - 1, np.flatnonzero(fresh_key)
        mixed = (np.bincount(number[fresh]) > 1) & (np.minimum.reduceat(doc, firsts) != np.maximum.reduceat(doc, firsts))
        several = mixed[number]
        asked = own & several
        yield _batch(ASKED, int(asked.sum()), doc=doc[asked], start=start[asked])
        keep = own & (~several | fresh_key)
    yield _batch(HEAD, int(keep.sum()), key=key[keep], context=context[keep], doc=doc[keep], start=start[keep], words=words[keep], several=several[keep])


def _merged(doc: np.ndarray, first: np.ndarray, words: np.ndarray, source: np.ndarray, source_first: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links on one diagonal of two documents that touch become one."""
    if not len(doc):
        return
    shift, last = first - source_first, first + words
    order = np.lexsort((last, first, shift, source, doc))
    doc, first, last, source, shift = (x[order] for x in (doc, first, last, source, shift))
    same = (doc[1:] == doc[:-1]) & (source[1:] == source[:-1]) & (shift[1:] == shift[:-1]) & (first[1:] <= last[:-1])
    begin = np.flatnonzero(np.concatenate(([True], ~same)))
    end = np.maximum.reduceat(last, begin)
    yield _batch(LINK, len(begin), doc=doc[begin], start=first[begin], words=end - first[begin], source=source[begin], source_start=first[begin] - shift[begin])


def first_pass(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of all kinds for the texts, those of each partition met."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held, size = per_process(("cutter",), Cutter), [], 0
        for batch in portions(batches):
            doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(over="ignore"):
                words = Words(batch.column(1).to_pylist(), cutter.spaces)
                key, context, owner, start, n = cutter.keys(words)
                held.append((key, context, doc[owner], start, n))
                size += len(key)
                whole, other, owner, start, n, bands = cutter.lines(words)
            if len(whole):
                yield _batch(LINE, len(whole), key=whole, context=other, doc=doc[owner.astype(np.int64)], start=start, words=n, bands=bands)
            if size >= FLUSH:
                yield from met(held, SIDE, True)
                held, size = [], 0
        if held:
            yield from met(held, SIDE, True)

    return docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).cast("bigint"), text).mapInArrow(found, _ROWS)


def _links(rows: DataFrame, side: int) -> DataFrame:
    """Links as (doc, first, last, source, source_first); ``start`` and ``source_start`` are keys with ``side`` words before them."""
    first, source_first = (F.greatest(F.col(c) - side, F.lit(0)) for c in ("start", "source_start"))
    return rows.select("doc", first.alias("first"), (first + F.col("words")).alias("last"), "source", source_first.alias("source_first"))


def exact_links(docs: DataFrame, rows: DataFrame, doc_id: str, text: str, scratch: list[DataFrame]) -> DataFrame:
    """All links between equal contexts and windows of 50 words, merged along diagonals."""
    by_context, by_key = Window.partitionBy("key", "context").orderBy("doc", "start"), Window.partitionBy("key")
    heads = rows.where(F.col("kind") == HEAD).select("key", "context", "doc", "start", "words", "several").repartition("key")
    heads = heads.withColumns({"source": F.first("doc").over(by_context), "source_start": F.first("start").over(by_context)})
    heads = heads.withColumns({"known": F.max("several").over(by_key), "mixed": F.min("context").over(by_key) != F.max("context").over(by_key), "shared": F.min("doc").over(by_key) != F.max("doc").over(by_key)})
    shared = materialise(heads.where("(shared OR known) AND (source != doc OR ((mixed OR known) AND NOT several))").select("doc", "start", "words", "source", "source_start"), "passage-shared")
    asked = shared.where("source = doc").select("doc", "start").unionByName(rows.where(F.col("kind") == ASKED).select("doc", "start"))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held, size = per_process(("cutter",), Cutter), [], 0
        for batch in portions(batches, 128):
            doc, starts = batch.column("doc").to_numpy(), batch.column("starts").to_pylist()
            with np.errstate(over="ignore"):
                words = Words([t or "" for t in batch.column("text").to_pylist()], cutter.spaces)
                owner = np.repeat(np.arange(len(doc)), [len(x) for x in starts])
                start = np.array([x for own in starts for x in own], dtype=np.int64)
                # windows of PASSAGE words that hold the key, inside the text
                low, high = np.maximum(start - SIDE, 0), np.minimum(start, words.n[owner] - PASSAGE)
                n = np.maximum(high - low + 1, 0)
                place = np.unique(words.begin[np.repeat(owner, n)] + _ranges(low, n))
                code, other = (gram_hashes(h, PASSAGE)[0][place] for h in (words.hashes, words.second())) if len(place) else (place.astype(np.uint64),) * 2
            owner = words.owner(place)
            held.append((code, other, doc[owner], place - words.begin[owner], np.full(len(place), PASSAGE)))
            size += len(place)
            if size >= FLUSH:
                yield from met(held, 0, False)
                held, size = [], 0
        if held:
            yield from met(held, 0, False)

    part = F.floor(F.col("start") / PORTION_WORDS).alias("part")
    asked = materialise(asked.groupBy("doc", part).agg(F.collect_set("start").alias("starts")), "passage-starts")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    windows = materialise(_one_each(texts, asked).select("doc", "text", "starts").mapInArrow(looked_up, _ROWS), "passage-windows")
    again = windows.where(F.col("kind") == HEAD).select("key", "context", "doc", "start", "words")
    again = again.withColumns({"source": F.first("doc").over(by_context), "source_start": F.first("start").over(by_context)}).where("source != doc")
    links = _links(shared.where("source != doc"), SIDE).unionByName(_links(again, 0))
    for met_inside in (rows, windows):
        links = links.unionByName(_links(met_inside.where(F.col("kind") == LINK), 0))
    scratch += [shared, asked, windows]
    shift = (F.col("first") - F.col("source_first")).alias("shift")
    merged = _islands(links.select("doc", "source", shift, "first", "last"), "doc", "source", "shift")
    merged = merged.groupBy("doc", "source", "shift", F.col("begin").alias("first")).agg(F.max("last").alias("last"))
    return merged.select("doc", "first", "last", "source", (F.col("first") - F.col("shift")).alias("source_first"), (F.col("last") - F.col("shift")).alias("source_last"))


def banded_lines(rows: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    """(key, doc, start, words): the different lines of each band that several documents have.

    Of equal lines the first stands for all: the others go with the windows that they share.
    """
    first = rows.where(F.col("kind") == LINE).groupBy(F.col("key").alias("whole"), "context").agg(F.min(F.struct("doc", "start", "words", "bands")).alias("line"))
    # written, so that the join has a plain shuffle on both sides and a hot band's lines can be split
    lines = materialise(first.select("line.doc", "line.start", "line.words", F.explode("line.bands").alias("key")), "passage-bands")
    scratch.append(lines)
    some = lines.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n"), F.sum(F.xxhash64("doc", "start").cast("decimal(38,0)")).alias("members")).where("least != most")
    # of bands with the same lines one is compared
    some = some.groupBy("n", "members").agg(F.min("key").alias("key")).select("key")
    return lines.join(some, "key").select("key", "doc", "start", "words")


def alike_lines(docs: DataFrame, lines: DataFrame, doc_id: str, text: str, scratch: list[DataFrame], block_words: int = BLOCK_WORDS) -> DataFrame:
    """Verified pairs among the lines of each band, every line against all others in blocks dealt over tasks."""
    lines = materialise(lines, "passage-lines")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL")
    pieces = _pieces(texts, lines.select("doc", F.col("start").alias("low"), (F.col("start") + F.col("words")).alias("high")))
    scratch += [lines, pieces]
    pieces = pieces.select("doc", F.col("low").alias("start"), (F.col("high") - F.col("low")).alias("words"), "piece")
    blocks = lines.groupBy("key").agg(F.ceil(F.sum("words") / block_words).cast("int").alias("n"))
    dealt = lines.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("doc", "start"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).join(pieces, ["doc", "start", "words"])
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = dealt.select("key", "one", "two", "block", "doc", "start", "words", "piece").repartition(parts, "key", "one", "two").sortWithinPartitions("key", "one", "two", "doc", "start")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces = per_process(("cutter",), Cutter).spaces
        group, members = None, []
        for batch in portions(batches):
            with np.errstate(over="ignore"):
                words = Words([p or "" for p in batch.column("piece").to_pylist()], spaces)
                grams = gram_hashes(words.hashes, SHINGLE)[0]
            for k, (key, one, two, side, doc, start, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "one", "two", "block", "doc", "start", "words")), strict=True)):
                if (key, one, two) != group:
                    if len(members) > 1:
                        yield _alike(members)
                    group, members = (key, one, two), []
                own = grams[words.begin[k] : words.begin[k] + max(0, words.n[k] - SHINGLE + 1)]
                members.append((doc, start, n, side if one != two else -1, np.unique(own)))
        if len(members) > 1:
            yield _alike(members)

    return met.mapInArrow(compared, ", ".join(f"{c} bigint" for c in _PAIR)).distinct()


def _alike(members: list) -> pa.RecordBatch:
    """Alike lines of different documents (of two blocks: of one each); members come by document.

    Each line is compared with all before it and linked to the first alike one, and to every other
    that these links do not join to it already; so all that are alike end up in one class.
    """
    doc, start, words, side = (np.array(x) for x in list(zip(*members, strict=True))[:4])
    sizes = np.array([len(m[4]) for m in members])
    index = SharedCodes([m[4] for m in members])
    own, source, joined = [], [], np.arange(len(members))
    for k in range(1, len(members)):
        before = (doc[:k] < doc[k]) & ((side[:k] != side[k]) | (side[k] == -1))
        if before.any():
            both = index.overlaps(k)[:k]
            found = before & (both > 0) & alike(both, sizes[:k], sizes[k], SIMILARITY)
            # one link to each class of lines that it is alike to, the first of all among them
            classes, firsts = np.unique(joined[np.flatnonzero(found)], return_index=True)
            if len(classes):
                linked = np.flatnonzero(found)[np.sort(firsts)]
                own += [k] * len(linked)
                source += linked.tolist()
                joined[np.isin(joined, classes)] = joined[k] = classes[0]
    own, source = np.array(own, dtype=int), np.array(source, dtype=int)
    columns = [x.astype(np.int64) for at in (own, source) for x in (doc[at], start[at], start[at] + words[at])]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], list(_PAIR))


def _one_each(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """Texts joined to what is asked of them, a written table; of rows that repeat a document one is taken."""
    return with_ids(texts, asked.select("doc").distinct(), "doc").dropDuplicates(["doc"]).join(asked, "doc")


def _pieces(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, low, high, piece): the words from ``low`` to ``high`` (excluded) of each span; ``low`` may lie before the text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 64):
            rows: list[tuple] = []
            for doc, value, asked in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "spans")), strict=True):
                words = (value or "").split()
                rows += [(doc, s["low"], s["high"], " ".join(words[max(0, s["low"]) : s["high"]])) for s in asked]
            for at in range(0, len(rows), 4096):
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 4096], strict=True), kinds, strict=True)], ["doc", "low", "high", "piece"])

    part = F.floor(F.col("low") / PORTION_WORDS).alias("part")
    asked = materialise(spans.distinct().groupBy("doc", part).agg(F.collect_list(F.struct("low", "high")).alias("spans")), "passage-spans")
    pieces = materialise(_one_each(texts, asked).select("doc", "text", "spans").mapInArrow(cut, _PIECES), "passage-pieces")
    discard(asked)
    return pieces


def _islands(spans: DataFrame, *by: str) -> DataFrame:
    """Add ``begin``, the first word of the run of spans (of a document, if ``by`` names nothing else) that overlap or touch."""
    order = Window.partitionBy(*(by or ["doc"])).orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("first") > before), F.col("first"))
    return spans.withColumn("begin", F.last(fresh, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, first, last, source_id, class_id): spans of words (``last`` excluded) that repeat an earlier document.

    Words are the runs of characters between white space, numbered from 0.

    Spans of a document neither overlap nor touch; ``class_id`` is shared by all passages that
    links join, ``source_id`` is the least document of the class.
    """
    scratch: list[DataFrame] = []
    rows = materialise(first_pass(docs, doc_id, text), "passage-keys")
    exact = exact_links(docs, rows, doc_id, text, scratch)
    near = alike_lines(docs, banded_lines(rows, scratch), doc_id, text, scratch)
    pairs = materialise(exact.unionByName(near), "passages")
    discard(rows, *scratch)
    span = ["doc", "first", "last"]
    theirs = pairs.select(F.col("source").alias("doc"), F.col("source_first").alias("first"), F.col("source_last").alias("last"))
    # equal spans become one before the window, however often a passage is repeated
    nodes = materialise(_islands(pairs.select(span).unionByName(theirs).distinct()).select(*span, F.xxhash64("doc", "begin").alias("node")), "passage-nodes")
    other = nodes.select(F.col("doc").alias("source"), F.col("first").alias("source_first"), F.col("last").alias("source_last"), F.col("node").alias("b"))
    edges = pairs.join(nodes.withColumnRenamed("node", "a"), span).join(other, ["source", "source_first", "source_last"])
    roots = components(edges.select("a", "b"))
    named = materialise(nodes.join(roots.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node")), "passage-classes")
    least = named.groupBy(F.col("root").alias("class_id")).agg(F.min("doc").alias("source_id"))
    own = pairs.select(span).distinct().join(named, span)
    spans = _islands(own).groupBy("doc", "begin").agg(F.max("last").alias("last"), F.min("root").alias("class_id"))
    discard(nodes)
    return spans.join(least, "class_id").select(F.col("doc").alias("doc_id"), F.col("begin").alias("first"), "last", "source_id", "class_id")


def remove(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of ``text``; all other columns and rows stay."""
    by_doc = spans.groupBy(F.col("doc_id").alias("__doc")).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("__spans"))
    joined = docs.join(by_doc, F.col(doc_id) == F.col("__doc"), "left").drop("__doc")
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            columns = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            spans = columns.pop("__spans").to_pylist()
            columns[text] = pa.array([_without(v, s) if s and v else v for v, s in zip(columns[text].to_pylist(), spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return joined.mapInArrow(cut, T.StructType(docs.schema.fields))


def _without(text: str, spans: list[dict]) -> str:
    place = [m.span() for m in _RUN.finditer(text)]
    out, at = "", 0
    for s in spans:
        if s["last"] > len(place):
            continue
        out = _joined(out, text[at : place[s["first"]][0]])
        at = place[s["last"] - 1][1]
    return _joined(out, text[at:])


def _joined(a: str, b: str) -> str:
    """Two remaining pieces with one line break or blank between them."""
    if not a.strip() or not b.strip():
        return (a if a.strip() else b).strip() if a else b
    x, y = a.rstrip(), b.lstrip()
    gap = a[len(x) :] + b[: len(b) - len(y)]
    return x + ("\n" if "\n" in gap else " ") + y
