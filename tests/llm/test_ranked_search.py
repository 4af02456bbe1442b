"""Ranked search against plain scoring of all documents."""

import gc
import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from regivane.llm import ranked_search
from regivane.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) from lists of (id, text), scoring every document."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, tokens = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n) // tokens
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def result(spark, docs, items, shard_postings=ranked_search.SHARD_POSTINGS, partitions=4, **options):
    table = spark.createDataFrame([(*d, "x", "x", 1) for d in docs], "doc_id bigint, text string, docs string, terms string, n int").repartition(partitions)
    asked = spark.createDataFrame([(*i, "x", "x") for i in items], "item_id bigint, text string, item string, rank string")
    index = ranked_search.build_index(table, shard_postings=shard_postings)
    return sorted(map(tuple, ranked_search.search(index, asked, **options).collect()), key=str)


def collection(rng, n):
    words = [f"{a}{b}" for a in ("Ba", "ké", "Lo", "漢", "x9", "ÉN") for b in ("", "r", "STU", "ß", "42")]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [(k, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 300])))) for k in range(n)]


@pytest.mark.parametrize("shard_postings, most_items", [(1 << 18, 512), (60, 3)])
def test_scores_and_ranks(spark, shard_postings, most_items):
    rng = random.Random(7)
    docs = collection(rng, 300)
    items = [(k, " ".join(rng.sample(docs[rng.randrange(300)][1].split(" "), 1) + rng.choices(["bar", "KÉ", "nowhere", "x942!", "漢ß"], k=3))) for k in range(12)]
    got = result(spark, docs, items, shard_postings, most_items=most_items)
    assert got == brute(docs, items) and len(got) > 60


def test_ties_and_groups_of_copies(spark):
    copies = [(k, "the same words again and again") for k in range(500, 0, -1)]
    docs = copies + [(1000 + k, f"other words {k}") for k in range(50)]
    items = [(1, "same again"), (2, "words"), (3, "other 7")]
    assert result(spark, docs, items, 400) == brute(docs, items)


def test_odd_texts_and_items(spark):
    long = "lorem Ipsum dolor " * 20000
    docs = [(1, "Hello, world"), (2, None), (3, ""), (4, "hello"), (4, "hello"), (None, "hello world"), (5, " .!? "), (6, long), (7, "É é E e\x00zero_sep"), (8, "🙂x 漢字")]
    items = [(1, "hello"), (1, "hello"), (1, "LOREM"), (None, "world é"), (2, None), (3, ""), (4, "??"), (5, "absent"), (6, "🙂X zero sep"), (7, long)]
    got = result(spark, docs, items, 50)
    assert got == brute(docs, items) and (1, 4, None, got[0][3]) in got  # behind equal scores
    assert result(spark, [], items) == [] and result(spark, docs, []) == [] and result(spark, docs[1:3], items) == []


def test_a_term_of_all_documents_and_a_very_long_document(spark):
    docs = [(1, "all " * 5000 + "one"), (2, "all"), (3, "all two")]
    items = [(1, "all"), (2, "all one two")]
    assert result(spark, docs, items) == brute(docs, items)


def test_bytes_bound_the_impacts():
    import numpy as np

    tf = np.arange(1, 20000, dtype=np.int64)
    for m in (10, 100, 1237, 10**6, 10**11):
        exact = ranked_search.impacts(tf, np.full(len(tf), m))
        units = -(-exact // ranked_search.UNIT)
        assert exact.max() < ranked_search.MOST_IMPACT and units.max() <= 255
        assert (units * ranked_search.UNIT >= exact).all() and ((units - 1) * ranked_search.UNIT < exact)[exact > 0].all()


def test_query_ranks_all_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op12_ranked_search"](spark, sf).collect()), key=str)
    assert got == brute(docs, items)


def test_row_groups_of_shards_are_bounded_by_bytes(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(k, " ".join(f"{rng.getrandbits(40):x}" for _ in range(20_000))) for k in range(50)], "doc_id bigint, text string").coalesce(1)
    index = ranked_search.build_index(docs, shard_postings=1)
    for table, least in ((index.exact, 3), (index.quantised, 2)):
        files = [pq.ParquetFile(f).metadata for f in Path(table.stored_at.removeprefix("file:")).rglob("*.parquet")]
        sizes = [m.row_group(k).total_byte_size for m in files for k in range(m.num_row_groups)]
        assert sum(m.num_rows for m in files) == 50 and len(sizes) >= least and max(sizes) < 12 << 20


def test_the_numbers_of_a_shard_are_freed_at_once():
    gc.collect()
    gc.disable()
    try:
        for _ in range(50):
            words = ranked_search.numbering()
            assert [words[t] for t in (b"a", b"b", b"a", b"c")] == [0, 1, 0, 2]
        del words
        assert not [x for x in gc.get_objects() if type(x) is defaultdict and x.keys() == {b"a", b"b", b"c"}]
    finally:
        gc.enable()
