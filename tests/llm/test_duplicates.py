import importlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from regivane.llm import near_dedup, substring_dedup
from regivane.llm.common import documents
from regivane.llm.components import components

WORDS = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("r", "st", "nd", "l")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def brute_classes(docs, similarity=0.8):
    def bag(t):
        w = re.findall(r"\w+", (t or "").lower())
        return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter({("=", t or ""): 1})

    bags = {i: bag(t) for i, t in docs}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bags)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = sum((bags[a] & bags[b]).values())
            if both >= similarity * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def planted(rng):
    docs = []
    for k in range(30):
        words = prose(rng, rng.randint(3, 400)).split()
        docs.append((10 * k, " ".join(words)))
        for c in range(rng.choice([0, 0, 1, 3])):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(copy) // 60))):
                copy[rng.randrange(len(copy))] = "changed"
            docs.append((10 * k + c + 1, " ".join(copy)))
    repeated = "so it goes on and on and on " * 30
    return docs + [(1001, repeated), (1002, repeated + "and on "), (1003, None), (1004, ""), (1005, "!!! ???"), (1006, "!!! ???"), (1007, "a b"), (1008, "A, b")]


@pytest.mark.parametrize("part", [1 << 20, 50])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr(importlib.import_module("regivane.llm.components"), "PART_EDGES", part)
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in parent}
    named = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in edges if a is not None], "a string, b string")
    whole = {}
    for x, r in got.items():
        whole.setdefault(r, []).append(f"n{x}")
    assert {r.id: r.root for r in components(named).collect()} == {x: min(c) for c in whole.values() for x in c}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_bag_minhash_is_unbiased():
    rng = np.random.default_rng(5)
    with np.errstate(over="ignore"):
        keys = near_dedup.mix(np.arange(60, dtype=np.uint64))
        a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
        exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        owner = np.repeat([0, 1], 60)
        signature = near_dedup.bag_minhash(owner, np.concatenate([keys, keys]), np.concatenate([a, b]), 2, 4096)
    assert abs((signature[0] == signature[1]).mean() - exact) < 0.03


def test_classes_equal_brute_force(spark, make_docs):
    docs = planted(random.Random(1))
    table = make_docs([*docs, docs[0], (None, "nobody's")]).repartition(5)
    rows = near_dedup.classes(table).collect()
    assert len(rows) == len(docs) + 2
    assert {r.doc_id: r.class_id for r in rows if r.doc_id is not None} == brute_classes(docs)
    assert [r.class_id for r in rows if r.doc_id is None] == [None]


def test_string_ids(make_docs):
    docs = planted(random.Random(5))
    table = make_docs(docs).withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 6, "0")))
    got = {r.doc_id: r.class_id for r in near_dedup.classes(table).collect()}
    assert got == {f"d{i:06d}": f"d{c:06d}" for i, c in brute_classes(docs).items()}


def test_block_size_does_not_change_classes(spark, make_docs):
    rng = random.Random(2)
    base = prose(rng, 120).split()
    docs = []
    for k in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        docs.append((k, " ".join(copy)))
    table = make_docs(docs)
    groups = table.select("doc_id", F.lit(0).cast("bigint").alias("root"), F.lit(116).cast("bigint").alias("size"))
    truth = brute_classes(docs)
    for block in (10**6, 900):
        got = {r.id: r.root for r in components(near_dedup.verified_links(table, groups, "doc_id", "text", block_elements=block)).collect()}
        assert {i: got.get(i, i) for i in truth} == truth


def test_keep_one(make_docs):
    docs = planted(random.Random(4))
    truth = brute_classes(docs)
    kept = near_dedup.keep_one(make_docs([*docs, docs[0]])).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(truth.values())) and kept[0].root == "x"
    assert near_dedup.keep_one(make_docs(docs[:1]).limit(0)).count() == 0


def test_different_texts_of_one_id_are_documents(make_docs):
    rng = random.Random(6)
    a, b, c = (prose(rng, 80) for _ in range(3))
    docs = [(1, a), (1, b), (1, b), (2, b), (3, c), (3, a), (None, a), (None, a), (4, None), (4, "")]
    kept = sorted(((r.doc_id, r.text) for r in near_dedup.keep_one(make_docs(docs).repartition(3)).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (3, c), (None, a), (None, a), next(k for k in kept if k[0] == 4)], key=str)


def test_blocks_of_different_sizes_meet(spark, make_docs):
    """Every two members that are alike enough meet, whatever blocks they are in."""
    rng = random.Random(8)
    base = prose(rng, 400).split()
    docs = [(k, " ".join(base[: 120 + 9 * k])) for k in range(30)]
    table = make_docs(docs)
    groups = spark.createDataFrame([(i, 0, len(t.split()) - 4) for i, t in docs], "doc_id bigint, root bigint, size bigint")
    truth = brute_classes(docs)
    for block in (10**6, 700):
        got = {r.id: r.root for r in components(near_dedup.verified_links(table, groups, "doc_id", "text", block_elements=block)).collect()}
        assert {i: got.get(i, i) for i in truth} == truth


def test_every_window_holds_a_chosen_key():
    rng = np.random.default_rng(0)
    cut = substring_dedup.Cutter()
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, n)) for n in (0, 49, 50, 51, 200, 0, 75)]
    with np.errstate(over="ignore"):
        words = substring_dedup.Words(texts, cut.spaces)
        key, context, text, start, n = cut.keys(words)
    found = {(t, s) for t, s in zip(text.tolist(), start.tolist(), strict=True)}
    assert words.n.tolist() == [0, 49, 50, 51, 200, 0, 75] and not any(t in (0, 1, 5) for t, _ in found)
    for t, own in enumerate(texts):
        for first in range(len(own.split()) - 49):
            assert any((t, s) in found for s in range(first, first + 25))
    assert all(min(s + 50, words.n[t]) - max(0, s - 24) == k for t, s, k in zip(text, start, n, strict=True))


def test_words_are_those_of_split():
    cut = substring_dedup.Cutter()
    texts = ["a\x1cb\u00a0c\u2003dé \n漢字 🙂x", "", " \t", "dé c", "x" * 100 + " " + "x" * 99]
    with np.errstate(over="ignore"):
        words = substring_dedup.Words(texts, cut.spaces)
    assert words.n.tolist() == [len(t.split()) for t in texts]
    by_word = {}
    for w, h in zip(" ".join(texts).split(), words.hashes[words.at].tolist(), strict=True):
        by_word.setdefault(w, set()).add(h)
    assert all(len(x) == 1 for x in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)


def repeated_words(docs, size=50):
    """By document, the words that lie in a run of ``size`` that an earlier document has; straight from the definition."""
    first, out = {}, {}
    for i, text in sorted(docs):
        words, own, gone = text.split(), set(), set()
        for k in range(len(words) - size + 1):
            run = tuple(words[k : k + size])
            if run in first:
                gone.update(range(k, k + size))
            else:
                own.add(run)
        for run in own:
            first[run] = i
        out[i] = gone
    return out


def test_against_brute_force(spark, sf):
    """All runs of 50 words of the sf0.01 documents that an earlier document has go."""
    docs = documents(spark, sf.replace("0.001", "0.01")).select("doc_id", "text")
    truth = repeated_words([(r.doc_id, r.text) for r in docs.collect()])
    got = {i: set() for i in truth}
    for r in substring_dedup.removals(docs).collect():
        got[r.doc_id].update(range(r.first, r.last))
        assert r.source_id < r.doc_id
    assert sum(map(len, truth.values())) > 1000
    assert all(truth[i] <= got[i] for i in truth)
    # what goes beyond them are alike lines
    assert sum(len(got[i] - truth[i]) for i in truth) < 0.2 * sum(map(len, got.values()))


def test_groups_of_four(make_docs):
    """A passage whose middle other documents share goes whole, at one and at seven partitions."""
    rng = random.Random(12)
    new = lambda n: ["".join(rng.choice("bcdfghjk") for _ in range(9)) for _ in range(n)]
    rows = []
    for g in range(150):
        passage = new(50)
        for k in range(4):
            part = passage if k % 2 else new(6) + passage[6:44] + new(6)
            rows.append((4 * g + k, " ".join(new(rng.randint(5, 40)) + part + new(rng.randint(5, 40)))))
    results = []
    for parts in (1, 7):
        table = make_docs(rows).repartition(parts)
        spans = substring_dedup.removals(table)
        results.append(sorted(map(tuple, spans.collect())))
        assert sorted(r[0] for r in results[-1]) == [4 * g + 3 for g in range(150)]
        assert all(r[2] - r[1] == 50 and r[3] == r[0] - 2 for r in results[-1])
    assert results[0] == results[1]


def test_odd_rows_of_passages(make_docs):
    rng = random.Random(13)
    text = prose(rng, 120)
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (4, ""), (5, text + "\n" + "x" * 300_000)]
    table = make_docs(rows)
    spans = substring_dedup.removals(table)
    assert sorted((r.doc_id, r.first, r.last, r.source_id) for r in spans.collect()) == [(2, 0, 120, 1), (5, 0, 120, 1)]
    after = sorted((r.doc_id or 0, len(r.text or "")) for r in substring_dedup.remove(table, spans).collect())
    assert after == [(0, len(text)), (1, len(text)), (1, len(text)), (2, 0), (3, 0), (4, 0), (5, 300_001)]


def test_gram_hashes_depend_on_words_alone():
    x = near_dedup.mix(np.arange(40, dtype=np.uint64))
    y = np.concatenate([x[30:], x])
    with np.errstate(over="ignore"):
        for size in (1, 5, 12, 31):
            a, b = (substring_dedup.gram_hashes(v, size)[0] for v in (x, y))
            assert (a == b[10:]).all() and len(set(a.tolist())) == len(a)


def test_tuned_bands():
    bands, rows = substring_dedup.tune_bands()
    assert bands * rows <= substring_dedup.REGISTERS and 1 - (1 - 0.8**rows) ** bands >= 0.995


def test_passages_in_the_middle_of_text_go(make_docs):
    rng = random.Random(7)
    docs = [[k, prose(rng, rng.randint(60, 300)).split()] for k in range(40)]
    passages = [prose(rng, n).split() for n in (51, 55, 70, 200)]
    where = {}
    for n, p in enumerate(passages):
        for k in rng.sample(range(40), 4):
            at = rng.randint(0, len(docs[k][1]))
            if not any(docs[k][0] in w for w in where.values()):
                docs[k][1][at:at] = p
                where.setdefault(n, []).append(k)
    rows = [(k, " ".join(w)) for k, w in docs]
    line = prose(rng, 60)
    near = line.split()
    near[30] = "altered"
    rows += [(100, f"{prose(rng, 20)}\n{line}\n{prose(rng, 20)}"), (101, f"{prose(rng, 30)}\n{' '.join(near)}"), (102, None), (103, ""), (104, f"{line} {line}"), (105, prose(rng, 80))]
    table = make_docs(rows)
    spans = substring_dedup.removals(table)
    after = {r.doc_id: r.text for r in substring_dedup.remove(table, spans).collect()}
    assert len(after) == len(rows) and after[102] is None and after[103] == ""
    for n, ks in where.items():
        text = " ".join(passages[n])
        assert sorted(k for k in ks if text in after[k]) == [min(ks)]
    assert after[100] == rows[40][1] and "altered" not in after[101]
    touched = {k for ks in where.values() for k in ks} | {100, 101, 104}
    before = dict(rows)
    assert all(after[k] == before[k] for k in before if k not in touched)
    got = spans.collect()
    assert all(r.source_id < r.doc_id for r in got) and len({r.class_id for r in got}) >= len(where)


def test_every_partner_of_a_hot_key_is_compared(make_docs, monkeypatch):
    rng = random.Random(11)
    new = lambda: "".join(rng.choice("bcdfghjk") for _ in range(9))
    template = [new() for _ in range(90)]

    def variant(changes):
        out = list(template)
        for k in rng.sample(range(90), changes):
            out[k] = new()
        return out

    rows, pairs = [], []
    for k in range(30):  # few of these are alike
        line = variant(3)
        near = list(line)
        near[rng.choice((0, 89))] = new()
        rows += [(k, " ".join(line)), (500 + k, " ".join(near))]
        pairs.append((k, 500 + k))
    # a passage's middle stands in many others; only the fourth and the ninth hold all of it
    passage = [new() for _ in range(60)]
    for k in range(12):
        middle = passage if k in (4, 9) else [new() for _ in range(12)] + passage[12:48] + [new() for _ in range(12)]
        rows.append((1000 + k, " ".join([new() for _ in range(20)] + middle + [new() for _ in range(20)])))
    # a passage twice in one document, and once in an earlier one of another partition
    twice = " ".join(new() for _ in range(60))
    rows += [(2000, f"{new()} {twice} {new()}"), (2001, f"{new()} {twice} {new()} {new()} {twice}")]

    def shingles(text):
        w = text.split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    sets = {k: shingles(t) for k, t in rows[:60]}
    alike = {k for k in sets for j in sets if j < k and len(sets[j] & sets[k]) >= 0.8 * len(sets[j] | sets[k])}
    assert {b for _, b in pairs} <= alike
    results = []
    for parts, flush in ((1, 200_000), (5, 1)):
        monkeypatch.setattr(substring_dedup, "FLUSH", flush)
        table = make_docs(rows).repartition(parts)
        spans = substring_dedup.removals(table)
        after = {r.doc_id: r.text for r in substring_dedup.remove(table, spans).collect()}
        assert {k for k in alike if after[k]} == set()
        assert sorted(k for k in range(1000, 1012) if " ".join(passage) in after[k]) == [1004]
        assert twice in after[2000] and twice not in after[2001]
        results.append(sorted(tuple(r)[:4] for r in spans.collect()))
    assert results[0] == results[1]


def test_no_removals(make_docs):
    table = make_docs([(1, "short"), (2, "short")])
    assert substring_dedup.removals(table).count() == 0
    assert substring_dedup.removals(table.limit(0)).count() == 0
    assert substring_dedup.remove(table, substring_dedup.removals(table)).count() == 2


def test_cutting_text():
    cut = substring_dedup._without
    assert cut("a bb cc d", [{"first": 1, "last": 3}]) == "a d"
    assert cut("a\nbb cc\nd", [{"first": 1, "last": 3}]) == "a\nd"
    assert cut("bb cc", [{"first": 0, "last": 2}]) == ""


def test_a_line_joins_all_the_lines_it_is_alike_to():
    """In one band: the third is alike to the first two, the fourth to the second alone, the fifth to all that are joined."""
    base = np.arange(1, 181, dtype=np.uint64)
    codes = [np.concatenate((base, more)).astype(np.uint64) for more in (range(1000, 1030), range(2000, 2030), [*range(1000, 1010), *range(2000, 2010)], range(2000, 2045), ())]
    codes[3] = codes[3][10:]
    alike = {(b, a) for b in range(5) for a in range(b) if len(set(codes[a]) & set(codes[b])) >= 0.8 * len(set(codes[a]) | set(codes[b]))}
    assert {(2, 0), (2, 1), (3, 1)} <= alike and not {(1, 0), (3, 0), (3, 2)} & alike
    for sides in ((-1,) * 5, (0, 0, 1, 1, 1), (1, 0, 1, 0, 1)):
        wanted = {(b, a) for b, a in alike if sides[a] != sides[b] or sides[a] == -1}
        got = substring_dedup._alike([(k, 7, 50, side, c) for k, (side, c) in enumerate(zip(sides, codes, strict=True))]).to_pylist()
        pairs = {(r["doc"], r["source"]) for r in got}
        assert pairs <= wanted and {b for b, _ in pairs} == {b for b, _ in wanted}

        def classes(links):
            of = list(range(5))
            for b, a in links:
                of = [of[a] if x == of[b] else x for x in of]
            return {frozenset(k for k in range(5) if of[k] == x) for x in of}

        assert classes(pairs) == classes(wanted)
