import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regivane.llm import bpe_codec, common, packing, queries, token_counts, transducer

BYTE, WORD = queries.tokenizer_source("byte_bpe_50k.json"), queries.tokenizer_source("word_bpe_49k.json")


@pytest.fixture(scope="module")
def libraries():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(BYTE), Tokenizer.from_str(WORD)


@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 50_000), min_size=1, max_size=4), max_size=60))
@settings(max_examples=60, deadline=None)
def test_transducer_round_trip(entries):
    lexicon = transducer.mapped(transducer.compile_lexicon(entries))
    for word, ids in entries.items():
        assert lexicon.lookup(word) == ids
        for other in (word + b"\x00", word[:-1], b"\xff" + word):
            assert lexicon.lookup(other) == entries.get(other)


def test_transducer_shares_suffixes():
    words = {f"{p}{s}".encode(): [1] for p in "abcdefgh" for s in ("tion", "ing", "ness")}
    block = transducer.compile_lexicon(words)
    states = int.from_bytes(block[:4], "little")
    assert states < 15  # a tree would need over a hundred


def test_merging_is_exact():
    tokenizer = bpe_codec.Tokenizer(BYTE)
    merge = tokenizer.merger()
    for word in (" hello", "thstanding", " naïveté", "🙂", "aaaaaaaaaa"):
        assert list(merge(word.encode())) == tokenizer.merge(word.encode())


def test_encode_and_decode(odd, libraries):
    lexicon = bpe_codec.build_lexicon(odd, BYTE, min_count=2)
    rows = bpe_codec.decode(bpe_codec.encode(odd, BYTE, lexicon), BYTE).select("doc_id", "text", "ids", "decoded", "source").collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = libraries[0].encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == libraries[0].decode(ids, skip_special_tokens=False) and r.source == "s"


def test_word_counts_cover_everything(make_docs):
    docs = make_docs([(k, "a b b") for k in range(50)]).repartition(7)
    assert {r.word: r.n for r in bpe_codec.count_words(docs, BYTE).collect()} == {"a": 50, " b": 100}


def test_empty_tables(odd):
    none = odd.limit(0)
    assert bpe_codec.encode(none, BYTE, bpe_codec.build_lexicon(none, BYTE)).count() == 0
    assert token_counts.count_tokens(none, BYTE).count() == 0
    assert packing.pack(none, WORD).count() == 0


def greedy(word: bytes, pieces) -> int:
    n = at = 0
    while at < len(word):
        size = next(k for k in range(len(word) - at, 0, -1) if word[at : at + k] in pieces)
        at, n = at + size, n + 1
    return n


@given(st.text(max_size=12))
@settings(max_examples=300, deadline=None)
def test_piece_counter(word):
    assert COUNTER.count(word.encode()) == greedy(word.encode(), PIECES)


PIECES = bpe_codec.Tokenizer(BYTE).ids
COUNTER = token_counts.PieceCounter(PIECES)


def test_piece_counter_without_a_piece():
    counter = token_counts.PieceCounter([b"a", b"ab", b"abcd", b"c"])
    assert counter.count(b"abc") == 2 and counter.count(b"abcd") == 1 and counter.count(b"abx") == -1 and counter.count(b"") == 0


def test_token_counts(odd):
    tokenizer = bpe_codec.Tokenizer(BYTE)
    for r in token_counts.count_tokens(odd, BYTE).collect():
        words = tokenizer.words(r.text or "")
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(w.encode(), PIECES) for w in words)), r.doc_id


def check_packing(pieces, docs, library, window=2048):
    ids = {}
    for i, t in docs:
        ids.setdefault(i, []).append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        # rows of one id, and those without, are packed each for itself
        assert any(bytes(p.ids) == own[p.start : p.start + p.length].tobytes() and p.doc_tokens == len(own) for own in ids[p.doc_id])
    for i, own in by_doc.items():
        assert sum(p.length for p in own) == sum(map(len, ids[i])) and sum(p.start == 0 for p in own) == len(ids[i])
    assert by_doc.keys() == ids.keys()
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)


def test_packing(odd, libraries):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    check_packing(packing.pack(odd.repartition(3), WORD).collect(), docs, libraries[1])
    check_packing(packing.pack(odd.repartition(5), WORD, window=64, open_windows=2, fan_in=2).collect(), docs, libraries[1], 64)
    check_packing(packing.pack(odd.coalesce(1), WORD).collect(), docs, libraries[1])


def test_word_encoder(libraries):
    encoder = packing.WordEncoder(WORD, runs=8)
    texts = ["Hello, World. x., 'quoted' (a) &&&, don't ÉTÉ. 12, b_", "Á İstanbul ΣΑΣ. x\x1cy", "<|endoftext|>, <|startoftext|>.", "", "...,\n.\n a ,b", "ﬁne ² Ⅷ x²,"]
    for text in texts * 2:
        assert encoder([text])[0] == np.array(libraries[1].encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text


def test_word_encoder_on_random_strings(libraries):
    """Strings over all classes of the tokenizer's pattern, apostrophes at word starts included."""
    rng = random.Random(6)
    short = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
    pieces = [*short, *(x.upper() for x in short), "'", "''", "'tis", "'the cat'", "he said 'some people' left", "'Don", *"abdlmrstveABDSTZéßÉñиЖσςΣİıſK漢字あ한ﬁ", "word", "Word", "12", "٣", "²", "Ⅷ", "½", "_", ",", ".", "!", "&&", "(", "\"", "’", "…", "🙂", "e\u0301", "x\u0302", "\u0301", "\u200d", "\u00a0", "\u3000", "\x1c", "\x00", "\n", "\t", ", ", ". ", " ", " ", " ", "<|endoftext|>", "<|startoftext|>"]
    encoder = packing.WordEncoder(WORD, runs=512)
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(12_000)]
    for at in range(0, len(texts), 40):
        part = texts[at : at + 40]
        for text, got in zip(part, encoder(part), strict=True):
            assert got == np.array(libraries[1].encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text


def test_long_words_stay_in_no_memo(libraries):
    """Of texts without white space nothing is kept, and their ids are right."""
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefgh.,'", k=200_000)) for _ in range(4)]
    words = packing.WordEncoder(WORD)
    assert words(texts) == [np.array(libraries[1].encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    byte = bpe_codec.Encoder(bpe_codec.Tokenizer(BYTE), None)
    assert [np.frombuffer(byte.encode(t), dtype="<i4").tolist() for t in texts] == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
    for memo in (words.runs, words.marks, byte.memo):
        assert sum(map(len, memo)) < 100_000


def test_portions():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 5_000_000, 5_000_000, 20, 30, 40)] + ["y"] * 2000})
    parts = list(common.portions([batch]))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or (p.nbytes <= common.PORTION_BYTES and p.num_rows <= common.PORTION_ROWS) for p in parts)


def test_digest_queries(spark, sf, libraries):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op2_bpe_codec(spark, sf).collect():
        ids = libraries[0].encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    for r in queries.op9_packing(spark, sf).collect():
        ids = np.array([*libraries[1].encode(docs[r.doc_id], add_special_tokens=False).ids, 1], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_words_come_from_the_model_and_the_older_generation(monkeypatch):
    """Ids stay those of the library when the memo turns over; a word that is still in it is not encoded again."""
    encoder = packing.WordEncoder(queries.tokenizer_source("word_bpe_49k.json"), runs=16)
    assert encoder.direct
    asked = []
    monkeypatch.setattr(encoder, "word", lambda w, own=encoder.word: asked.append(w) or own(w))
    texts = ["Alpha beta gamma", "delta epsilon zeta", "eta theta iota", "alpha BETA don't kappa's", "straße Σας alpha", "lambda mu nu xi omicron pi", "alpha"]
    for text in texts:
        assert encoder([text])[0] == np.asarray(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert asked.count("beta") == asked.count("alpha") == 1 and len(encoder.runs) <= 8 and len(encoder.old) <= 8


def test_many_words_walk_the_transducer_at_once():
    """Looked up side by side, words have the ids that they have one by one; an empty lexicon has none."""
    rng = random.Random(3)
    entries = {bytes(rng.choices(b"abc\x00\xff", k=rng.randint(1, 7))): [k, k + 1] for k in range(400)}
    words = [*entries, *(bytes(rng.choices(b"abcd\x00\xff", k=rng.randint(1, 9))) for _ in range(2000))]
    lexicon = transducer.mapped(transducer.compile_lexicon(entries))
    assert lexicon.lookup_all(words) == [entries.get(w) for w in words] == [lexicon.lookup(w) for w in words]
    assert lexicon.lookup_all([]) == [] and transducer.mapped(transducer.compile_lexicon({})).lookup_all([b"a"]) == [None]


def test_a_portion_is_encoded_and_decoded_at_once(libraries):
    """Special tokens, chunks met again and a memo that is too small for a portion change no id; decoding gives the texts."""
    import pyarrow as pa

    texts = ["Hello, hello. hello's%%% <|endoftext|>\nWord", "", "<|endoftext|>", " ".join(f"w{k}x" for k in range(50)), "ß, é. 漢字 🙂", "hello"]
    truth = [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
    for memo in (4, 1 << 10):
        encoder = bpe_codec.Encoder(bpe_codec.Tokenizer(BYTE), None, memo)
        for _ in range(2):
            assert [np.frombuffer(p, dtype="<i4").tolist() for p in encoder.encode_all(texts)] == truth
        assert len(encoder.memo) <= memo
    table = bpe_codec.piece_table(bpe_codec.Tokenizer(BYTE))
    ids = pa.array([None, *truth, [int(np.frombuffer("é".encode(), np.uint8)[0])]], pa.list_(pa.int32()))
    for at in (0, 2):
        assert bpe_codec.decoded_texts(table, ids.slice(at, len(truth) + 1 - at)) == ["", *texts][at:]
    with pytest.raises((KeyError, IndexError)):
        bpe_codec.decoded_texts(table, pa.array([[10**5]], pa.list_(pa.int32())))


def test_latin_words_are_merged_by_compiled_code(libraries):
    """Every word of a-z and Latin letters of the vocabulary, its pieces joined and random ones have the library's ids."""
    import json

    model = json.loads(WORD)["model"]
    assert packing.compiled_merges(model | {"merges": model["merges"][:-1]}) is None and packing.compiled_merges(model | {"end_of_word_suffix": None}) is None
    encoder, rng = packing.WordEncoder(WORD), random.Random(4)
    assert encoder.direct
    stems = sorted({p.removesuffix("</w>") for p in model["vocab"] if p.removesuffix("</w>").isascii() and p.removesuffix("</w>").isalpha()})
    words = stems + ["".join(rng.choices(stems, k=2)) for _ in range(5000)] + ["".join(rng.choices("aeinrstéüßñÀÉåøł", k=rng.randint(1, 14))) for _ in range(5000)]
    for at in range(0, len(words), 500):
        part = words[at : at + 500]
        assert [i for w in part for i in np.frombuffer(encoder.word(w), "<u2").tolist()] == libraries[1].encode(" ".join(part), add_special_tokens=False).ids


def test_portions_let_go_what_an_earlier_task_held(monkeypatch):
    """A task that asks for no object of its own does not carry that of the task before; its own stays."""
    monkeypatch.setattr(common, "_HELD", [None, None, None])
    task = [1]
    monkeypatch.setattr(common, "_task", lambda: task[0])
    made = []
    for task[0] in (1, 2):
        assert common.per_process(("x",), lambda: made.append(1) or "held") == "held"
        assert list(common.portions([])) == [] and common._HELD[1] == "held"
    task[0] = 3
    assert list(common.portions([])) == [] and common._HELD[1] is None and made == [1]
