import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from regivane.llm import language_id, queries, toxicity
from regivane.llm.common import documents, materialise
from test_duplicates import brute_classes, repeated_words


def test_against_brute_force(spark, sf):
    """Each stage against a plain version of its rule, over what the stage before kept."""
    stages = dict(pipeline.STAGES)
    docs = documents(spark, sf)
    kept = materialise(stages["toxicity"](spark, docs, sf), "test")
    model = queries.toxicity_model(spark, sf, docs)
    scores = {r.doc_id: r.s for r in toxicity.score(docs, model, out="s").collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s < 0.5}
    docs, kept = kept, materialise(stages["language_id"](spark, kept, sf), "test")
    models = language_id.train(docs, queries.crc_mod("doc_id", 4) != 2)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in language_id.identify(docs, models).collect() if not r.rejected}
    docs, kept = kept, materialise(stages["near_dedup"](spark, kept, sf), "test")
    truth = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in kept.collect()} == set(truth.values())
    docs, kept = kept, materialise(stages["substring_dedup"](spark, kept, sf), "test")
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in (docs, kept))
    gone = repeated_words(before.items())
    assert after.keys() == before.keys()
    for i, text in before.items():
        left = [w for k, w in enumerate(text.split()) if k not in gone[i]]
        assert len(after[i].split()) <= len(left) and (gone[i] or after[i] == text or len(after[i].split()) <= len(left) - 50)
    assert not any(repeated_words(after.items()).values())
    library = Tokenizer.from_str(queries.tokenizer_source("word_bpe_49k.json"))
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for i, t in after.items()}
    pieces, sequences = {}, {}
    for p in stages["packing"](spark, kept, sf).collect():
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        pieces.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert {i: sum(n for _, n in x) for i, x in pieces.items()} == {i: len(x) for i, x in ids.items()}
    for parts in (*pieces.values(), *sequences.values()):
        at = 0
        for begin, n in sorted(parts):
            assert begin == at
            at += n


def test_stages(spark, sf):
    """Each stage keeps whole rows of its input, in the documents' columns."""
    docs = documents(spark, sf)
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "language_id", "near_dedup", "substring_dedup", "packing"]
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert len(after) <= len(before) and after.keys() <= before.keys() and docs.count() == len(after)
        if name != "substring_dedup":
            assert all(before[i] == t for i, t in after.items())
        before = after
    pieces = pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {p.doc_id for p in pieces} == before.keys()


def test_clean_documents_stay(spark, sf):
    docs = documents(spark, sf)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in pipeline.drop_toxic(spark, docs, sf).collect()}
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in kept for i in clean) / len(clean) > 0.97
    assert pipeline.drop_unidentified(spark, docs, sf).count() > 0.98 * docs.count()


def test_odd_rows_and_clashing_columns(spark, sf, odd):
    """Null and empty texts, repeated rows, a very long text, and columns that operators use inside."""
    docs = documents(spark, sf).unionByName(odd.withColumn("doc_id", odd.doc_id + 10_000_000), allowMissingColumns=True)
    kept = pipeline.drop_toxic(spark, docs, sf)
    assert kept.columns == docs.columns and kept.where("rejected = 'x'").count() == odd.count()
    named = pipeline.drop_unidentified(spark, kept, sf)
    assert named.where("rejected = 'x' AND size = 'x'").count() >= 6
    once = pipeline.drop_near_duplicates(spark, named, sf)
    assert once.where("doc_id > 10000000").count() >= 4 and once.columns == docs.columns
    cut = pipeline.cut_repeats(spark, once, sf)
    assert cut.count() == once.count() and cut.where("n_chars != length(text)").count() == 0
    assert pipeline.pack_tokens(spark, cut, sf).where("doc_id IS NULL AND start = 0").count() == cut.where("doc_id IS NULL").count()


def test_repeated_ids_with_different_texts(make_docs, spark, sf):
    passage = " ".join(f"word{k}" for k in range(70))
    docs = make_docs([(1, f"first text\n{passage}"), (1, f"another beginning of it\n{passage}\nand an end"), (2, "short")])
    cut = sorted(r.text for r in pipeline.cut_repeats(spark, docs, sf).collect())
    assert len(cut) == 3 and sum(passage in t for t in cut) == 1 and "short" in cut
    # of neither text anything else goes
    assert {"first", "another", "beginning", "end", "short"} <= {w for t in cut for w in t.split()}


def test_empty_table(spark, sf):
    docs = documents(spark, sf).limit(0)
    for _, stage in pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0
