"""Byte-level BPE with a memory-mapped lexicon of frequent words.

Words are counted over all documents; the most frequent are encoded once, compiled into a
minimal acyclic transducer and sent to the executors, which map it.  A word outside the
lexicon is merged exactly by the tokenizer's ranked merges.  Ids equal those of the
``tokenizers`` library for the same file without added special tokens; a special token's
own string in a text becomes its id, as there.

Defined results: a null text counts as empty and gives an empty id list; null ids decode
to the empty text; other columns pass through untouched, but for one named as the output in
whichever case, which is replaced; repeated rows stay repeated; an empty table gives no rows,
and an empty lexicon; a text of any length is encoded whole, and what is kept between texts
(short pieces only) does not grow with it.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane.llm.common import MEMO_CHARS, UNICODE_SPACE, discard, kept_fields, materialise, per_process, portions
from regivane.llm.transducer import Lexicon, compile_lexicon, mapped

#: Fixed value: the byte-level pre-tokenisation pattern of the tokenizer files.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A run of white space and the run of other characters after it: never split inside a word.
CHUNK = re.compile(f"[{UNICODE_SPACE}]*[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+")

LEXICON_WORDS = 65_536
MIN_COUNT = 4


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizer:
    """Vocabulary, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        alphabet = byte_alphabet()
        raw = lambda piece: bytes(alphabet[c] for c in piece)
        self.ids = {raw(piece): i for piece, i in spec["model"]["vocab"].items()}
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault((raw(a), raw(b)), rank)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: piece for piece, i in self.ids.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.words = regex.compile(WORD_PATTERN).findall
        parts = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, parts)) + ")") if parts else None

    def merge(self, word: bytes) -> list[int]:
        """Apply the lowest-ranked merge again and again until none applies."""
        parts = [word[k : k + 1] for k in range(len(word))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(p, 1 << 60), k) for k, p in enumerate(zip(parts, parts[1:], strict=False)))
            if best == 1 << 60:
                break
            a, b = parts[at], parts[at + 1]
            joined, k, n = [], 0, len(parts)
            while k < n:
                if k + 1 < n and parts[k] == a and parts[k + 1] == b:
                    joined.append(a + b)
                    k += 2
                else:
                    joined.append(parts[k])
                    k += 1
            parts = joined
        return [self.ids[p] for p in parts]

    def merger(self):
        """The fastest exact merging: compiled code where ids follow the merges' order, else :meth:`merge`."""
        ranked = sorted(self.ranks, key=self.ranks.get)
        ids = [self.ids[a + b] for a, b in ranked]
        if len(self.ids) != 256 + len(ids) or ids != sorted(ids) or any(len(p) > 1 for p, i in self.ids.items() if i < 256):
            return self.merge
        import tiktoken

        return tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=self.ids, special_tokens={})._core_bpe.encode_single_piece

    def words_of(self, chunk: str) -> Sequence[str]:
        """The pre-tokens of a chunk; the plainest kinds are told without the pattern."""
        rest = chunk[1:] if chunk[0] == " " else chunk
        if rest.isalpha():
            return (chunk,)
        if rest[-1:] in (",", ".") and rest[:-1].isalpha():
            return chunk[:-1], chunk[-1]
        return self.words(chunk)

    def segments(self, text: str) -> list[str]:
        """Text and special-token strings in turn."""
        return self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]


class Encoder:
    """Chunk memo over the lexicon over exact merging."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon | None, memo: int = 3 << 18):
        self.tokenizer, self.lexicon, self.memo, self.limit = tokenizer, lexicon, {}, memo
        self.merge = tokenizer.merger()

    def learn(self, chunks: set[str]) -> None:
        """Put chunks into the memo; their words meet the lexicon all at once."""
        special = self.tokenizer.special
        split = [(c, self.tokenizer.words_of(c)) for c in chunks if c not in special]
        raw = [w.encode("utf-8", "surrogatepass") for _, words in split for w in words]
        ids = iter([i or self.merge(w) for i, w in zip(self.lexicon.lookup_all(raw), raw, strict=True)] if self.lexicon else map(self.merge, raw))
        for chunk, words in split:
            self.memo[chunk] = array("i", next(ids) if len(words) == 1 else [i for _ in words for i in next(ids)]).tobytes()
        self.memo.update((c, array("i", [special[c]]).tobytes()) for c in chunks if c in special)

    def chunks(self, text: str) -> list[str]:
        """Chunks and special-token strings in turn."""
        segments = self.tokenizer.segments(text)
        if len(segments) == 1:
            return [text] if text in self.tokenizer.special else CHUNK.findall(text)
        return [c for s in segments for c in ([s] if s in self.tokenizer.special else CHUNK.findall(s))]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian 32-bit integers."""
        split = [self.chunks(t) for t in texts]
        lacking: set[str] = set()
        for chunks in split:
            lacking.update(filterfalse(self.memo.__contains__, chunks))
        if len(self.memo) + len(lacking) > self.limit:
            self.memo.clear()
            lacking = set().union(*split)
        self.learn(lacking)
        packed = [b"".join(map(self.memo.__getitem__, chunks)) for chunks in split]
        for chunk in lacking if len(self.memo) > self.limit else [c for c in lacking if len(c) > MEMO_CHARS]:
            del self.memo[chunk]
        return packed

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def count_words(docs: DataFrame, source: str, text: str = "text", special_cut: bool = True) -> DataFrame:
    """(word, n) over all documents; counts are summed inside each partition before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, chunks, letters = Tokenizer(source), Counter(), 0

        def flush():
            words: Counter = Counter()
            for chunk, n in chunks.items():
                for word in tokenizer.words_of(chunk):
                    words[word] += n
            chunks.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})

        for batch in portions(batches):
            for value in batch.column(0).to_pylist():
                for segment in tokenizer.segments(value or "") if special_cut else [value or ""]:
                    if segment not in tokenizer.special:
                        chunks.update(CHUNK.findall(segment))
                        letters += len(segment)
                if len(chunks) > 400_000 or letters > 1 << 26:  # bounded in number and in bytes
                    yield flush()
                    letters = 0
        yield flush()

    return docs.select(text).mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, source: str, text: str = "text", size: int = LEXICON_WORDS, min_count: int = MIN_COUNT) -> bytes:
    """The compiled transducer of the most frequent words, ``size`` at most.

    Counts cover every document.  Words are taken by steps of their count (sixteen to a
    doubling), as many whole steps as ``size`` allows; so only these words and a histogram of
    steps reach the driver, not the best words of each partition.
    """
    tokenizer = Tokenizer(source)
    counts = materialise(count_words(docs, source, text).where(F.col("n") >= min_count), "word-counts")
    step = F.floor(F.log2("n") * 16)
    lowest, total = None, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > size:
            break
        lowest = row["step"]
    words = [r.word.encode() for r in counts.where(step >= lowest).select("word").collect()] if lowest is not None else []
    discard(counts)
    return compile_lexicon({w: tokenizer.merge(w) for w in words})


def encode(docs: DataFrame, source: str, lexicon: bytes, text: str = "text", out: str = "ids") -> DataFrame:
    """Append ``out`` array<int>: the ids of ``text`` (null: empty)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((source, lexicon))
    schema = T.StructType([*kept_fields(docs, [out]), T.StructField(out, T.ArrayType(T.IntegerType()))])
    names = [f.name for f in schema][:-1]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = "encoder", hash(sent.value[1]), hash(sent.value[0])
        encoder = per_process(key, lambda: Encoder(Tokenizer(sent.value[0]), mapped(sent.value[1])))
        for batch in portions(batches):
            packed = encoder.encode_all([v or "" for v in batch.column(batch.schema.get_field_index(text)).to_pylist()])
            ends = np.zeros(len(packed) + 1, dtype=np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=ends[1:])
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), ids], [*names, out])

    return docs.mapInArrow(encoded, schema)


def piece_table(tokenizer: Tokenizer) -> pa.Array:
    """The bytes of each id, null where there is none."""
    return pa.array(map(tokenizer.bytes_of.get, range(max(tokenizer.bytes_of) + 1)), pa.large_binary())


def decoded_texts(table: pa.Array, ids: pa.ListArray) -> list[str]:
    """The text of each list of ids; all pieces are fetched at once."""
    ends = ids.offsets.to_numpy()
    pieces = table.take(ids.values.slice(ends[0], ends[-1] - ends[0]))
    if pieces.null_count:
        raise KeyError("an id that the tokenizer lacks")
    at = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset :][ends - ends[0]].tolist() if len(pieces) else [0] * len(ends)
    data = memoryview(pieces.buffers()[2] or b"")
    return [str(data[a:b], "utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]


def decode(encoded: DataFrame, source: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append ``out``: the text that ``ids`` stand for, special tokens included (invalid UTF-8 becomes U+FFFD)."""
    spark = encoded.sparkSession
    sent = spark.sparkContext.broadcast(source)
    schema = T.StructType([*kept_fields(encoded, [out]), T.StructField(out, T.StringType())])
    names = [f.name for f in schema][:-1]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = per_process(("pieces", hash(sent.value)), lambda: piece_table(Tokenizer(sent.value)))
        for batch in portions(batches):
            column = batch.column(batch.schema.get_field_index(ids))
            texts = decoded_texts(table, column)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(texts, pa.string())], [*names, out])

    return encoded.mapInArrow(decoded, schema)
