"""Bounded-space online packing of token streams into fixed windows.

Each partition keeps a fixed number of open windows.  A document longer than a window first
fills whole windows; its rest goes into the open window that it fits most closely.  Where it
fits none and no new window may be opened, the fullest is topped up with its front and
emitted, and what is left is placed again.  At the end a partition's open windows run
together, leaving one partial window; these are merged level by level, a bounded number at a
time, until one is left, which is cut at powers of two.  So no sequence needs padding; every
id lies in exactly one piece.

Defined results: a null text counts as empty, an empty text has the end id alone; repeated
rows are packed each for itself; a null doc_id stays null; doc_id is a long; an empty table
gives no rows; other columns are ignored; a text of any length is packed whole, a task holds
its ids and ``open_windows`` windows, and what is kept between texts (short runs only) does not
grow with it.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import filterfalse
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regivane.llm.bpe_codec import byte_alphabet
from regivane.llm.common import MEMO_CHARS, materialise, per_process, portions

WINDOW, OPEN_WINDOWS, FAN_IN = 2048, 64, 256
#: Separators to Python's split() that the tokenizer's pattern takes for characters.
_ODD = "\x1c\x1d\x1e\x1f"
#: A comma or full stop behind another mark.
_STACKED = re.compile(r"[.,](?<=(?:[^\w\s]|_)[.,])(?!\S)")
_MARKED_WORD = re.compile(r"([\W_]*)([^\W\d_]+)([\W_]*)")
#: Endings that the tokenizer's pattern cuts off with the apostrophe before them.
_SHORT = ("s", "t", "re", "ve", "m", "ll", "d")

#: Bytes of lower-case words, and the stand-in of each that can be a word's last.
_IN_WORDS = bytes([*range(97, 123), *range(128, 256)])
_LAST = bytes.maketrans(bytes([*range(97, 123), *range(128, 192)]), bytes([*range(65, 91), *range(64)]))
#: Code points below this were letters, and had their cases, in every version of Unicode in use.
_LATIN_END = "\u0250"

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, part bigint"


class Window:
    __slots__ = ("pieces", "used")

    def __init__(self):
        self.pieces, self.used = [], 0


class Packer:
    """Places (doc_id, start, ids, doc_tokens); ids are packed 32-bit integers."""

    def __init__(self, size: int, limit: int, emit: Callable[[Window], None]):
        self.size, self.limit, self.emit = size, limit, emit
        self.open: list[tuple[int, int]] = []  # (room, number), ascending
        self.windows: dict[int, Window] = {}
        self.made = 0

    def add(self, doc: int, start: int, ids: bytes, total: int) -> None:
        whole = 4 * self.size
        while len(ids) >= whole:
            window = Window()
            self._put(window, doc, start, ids[:whole], total)
            self.emit(window)
            ids, start = ids[whole:], start + self.size
        while ids:
            n = len(ids) // 4
            at = bisect_left(self.open, (n, -1))
            if at < len(self.open):
                _, number = self.open.pop(at)
                window = self.windows[number]
            elif len(self.open) < self.limit:
                self.made += 1
                number, window = self.made, Window()
                self.windows[number] = window
            else:
                room, number = self.open.pop(0)
                window = self.windows[number]
                n = room
            self._put(window, doc, start, ids[: 4 * n], total)
            ids, start = ids[4 * n :], start + n
            if window.used == self.size:
                self.emit(self.windows.pop(number))
            else:
                insort(self.open, (self.size - window.used, number))

    @staticmethod
    def _put(window: Window, doc: int, start: int, ids: bytes, total: int) -> None:
        window.pieces.append((doc, start, ids, total))
        window.used += len(ids) // 4

    def rest(self) -> list[tuple[int, int, bytes, int]]:
        """Run the open windows together, fullest first; emit whole ones, return the last one's pieces."""
        pieces = [p for _, number in self.open for p in self.windows[number].pieces]
        self.open, self.windows = [], {}
        return fill(pieces, self.size, self.emit)


def fill(pieces: list, size: int, emit: Callable[[Window], None]) -> list:
    """Lay pieces end to end, emit each full window, return the pieces of the last, partial one."""
    window = Window()
    for doc, start, ids, total in pieces:
        while ids:
            n = min(len(ids) // 4, size - window.used)
            Packer._put(window, doc, start, ids[: 4 * n], total)
            ids, start = ids[4 * n :], start + n
            if window.used == size:
                emit(window)
                window = Window()
    return window.pieces


def compiled_merges(model: dict) -> Callable[[bytes], list[int]] | None:
    """``tiktoken``'s compiled merging of the bytes of a lower-case Latin word; None where it may differ from the model's own.

    Of the last byte, the one with the end mark, :data:`_LAST` has the stand-in.  Ranks are the ids, so
    these must ascend with the merges, and every longer piece come from just one merge.
    """
    suffix, vocabulary = model.get("end_of_word_suffix"), model.get("vocab")
    if model.get("type") != "BPE" or not suffix or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "ignore_merges")):
        return None
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    alphabet, pieces = byte_alphabet(), {}
    for piece, i in vocabulary.items():
        stem = bytes(alphabet.get(c, 0) for c in piece.removesuffix(suffix))
        if not stem.translate(None, _IN_WORDS):
            if not piece.endswith(suffix):
                pieces[stem] = i
            elif stem[-1] < 0xC0:
                pieces[stem[:-1] + stem[-1:].translate(_LAST)] = i
    if made != sorted(set(made)) or not {i for p, i in pieces.items() if len(p) > 1} <= set(made) or sum(len(p) == 1 for p in pieces) != len(_IN_WORDS) + 26 + 64:
        return None
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=pieces, special_tokens={})._core_bpe.encode_single_piece


class WordEncoder:
    """Ids of whole texts as packed 32-bit integers, by the ``tokenizers`` library.

    The tokenizer drops white space and lower-cases, so each run of other characters is
    encoded by itself, and a word among marks as the lower-cased word and the marks.
    What was encoded before comes from a memo of two generations, with 16-bit ids where the
    vocabulary allows.  Latin words go to the tokenizer's merges by themselves, where probes show
    that its other parts do no more to them than lower-casing.
    """

    def __init__(self, source: str, runs: int = 1 << 18):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.runs, self.old, self.limit = Tokenizer.from_str(source), {}, {}, runs // 2
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.kind = "<u2" if len(self.ends) <= 1 << 16 else "<u4"
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.marks: dict[str, bytes] = {"": b""}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = compiled_merges(json.loads(source)["model"])
        self.direct = self.merge is not None and all(self.word(w) == self.plain(w) for w in ("a", "The", "tokenizer", "xqzjvk", "I" * 40, "".join(map(chr, range(65, 91))), "\xc9t\xe9", "stra\xdfe", "\xfc"))

    def word(self, word: str) -> bytes:
        """Ids of a Latin word by the model's merges alone."""
        raw = word.lower().encode()
        return array("H" if self.kind == "<u2" else "I", self.merge(raw[:-1] + raw[-1:].translate(_LAST))).tobytes()

    def plain(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def split(self, run: str) -> tuple[str, str, str] | None:
        """(marks before, lower-cased word, marks behind) of a run that is just that."""
        found = _MARKED_WORD.fullmatch(run)
        if not found or any(t in run for t in self.special):
            return None
        before, word, behind = found.groups()
        if not word.isalpha() or not (before + behind).isascii() or not self.foldable(word):
            return None
        word = word.lower()
        if before.endswith("'") and word.startswith(_SHORT):  # an opening quote takes the beginning along
            return None
        return before, word, behind

    @staticmethod
    def foldable(word: str) -> bool:
        """Lower-casing is letter by letter, and composing changes nothing."""
        if word.isascii():
            return True
        low = word.lower()
        return len(low) == len(word) and low.isalpha() and "\u03a3" not in word and is_normalized("NFC", word)

    def learn(self, lacking: set[str], split: list[list[str] | None]) -> None:
        """Put runs into the memo; new words are encoded in one go and cut at their last pieces."""
        memo = self.runs
        if len(memo) + len(lacking) > self.limit:  # keep what is in use, and the rest for a generation
            self.old, memo = memo, {r: memo[r] for r in set().union(*filter(None, split)) - lacking}
            self.runs = memo
        if self.old:
            known = {r: self.old[r] for r in lacking if r in self.old}
            memo.update(known)
            lacking = lacking.difference(known)
        whole, odd = [], {}
        for run in lacking:
            if run.isalpha() and self.foldable(run):
                whole.append(run)
            else:
                odd[run] = self.split(run)
        self.encode_words(whole)
        self.encode_words(list({x[1] for x in odd.values() if x}.difference(memo)))
        for run, x in odd.items():
            memo[run] = self.mark(x[0]) + memo[x[1]] + self.mark(x[2]) if x else self.plain(run)

    def encode_words(self, fresh: list[str]) -> None:
        if self.direct:
            self.runs.update((w, self.word(w)) for w in fresh if max(w) < _LATIN_END)
            fresh = [w for w in fresh if max(w) >= _LATIN_END]
        ids = np.asarray(self.tokenizer.encode(" ".join(fresh), add_special_tokens=False).ids, dtype=self.kind)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(fresh):
            packed, at = ids.tobytes(), [0, *(ids.itemsize * cuts).tolist()]
            self.runs.update({w: packed[a:b] for w, a, b in zip(fresh, at, at[1:], strict=False)})
        else:  # a word was more than one pre-token
            self.runs.update((w, self.plain(w)) for w in fresh)

    def mark(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            if len(self.marks) > 1 << 16:
                self.marks = {"": b""}
            ids = self.plain(marks)
            if len(marks) <= MEMO_CHARS:
                self.marks[marks] = ids
        return ids

    def runs_of(self, text: str) -> list[str] | None:
        """Runs with the same ids as the text's, lower-cased and with a mark at a word's end by itself where that is safe."""
        if any(c in text for c in _ODD):
            return None
        if not text.isascii():
            low = text.lower()
            if len(low) != len(text) or "\u03a3" in text or not is_normalized("NFC", text):
                return text.split()
        if any(t in text for t in self.special):
            return text.split()
        text = text.lower()
        if not _STACKED.search(text):  # such marks belong together
            text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " .\n").replace(",\n", " ,\n")
        return text.split()

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = list(map(self.runs_of, texts))
        lacking: set[str] = set()
        for runs in filter(None, split):
            lacking.update(filterfalse(self.runs.__contains__, runs))
        if lacking:
            self.learn(lacking, split)
        joined = [self.plain(t) if r is None else b"".join(map(self.runs.__getitem__, r)) for t, r in zip(texts, split, strict=True)]
        if any(len(r) > MEMO_CHARS for r in lacking):
            for run in [r for r in self.runs if len(r) > MEMO_CHARS]:
                del self.runs[run]
        return joined if self.kind == "<u4" else [np.frombuffer(x, dtype=self.kind).astype("<u4").tobytes() for x in joined]


class _Rows:
    """Collects piece rows and numbers the sequences of one task."""

    def __init__(self, level: int, task: int):
        self.base, self.next, self.rows, self.bytes = (level << 56) + (task << 28), 0, [], 0

    def emit(self, window: Window) -> None:
        at = 0
        for doc, start, ids, total in window.pieces:
            self.rows.append((doc, start, len(ids) // 4, total, self.base + self.next, at, ids, None))
            at += len(ids) // 4
            self.bytes += len(ids)
        self.next += 1

    def leave(self, pieces: list, part: int) -> None:
        self.rows += [(doc, start, len(ids) // 4, total, None, None, ids, part) for doc, start, ids, total in pieces]

    def batch(self) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "part"]
        kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[]] * len(names)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack(docs: DataFrame, source: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of ``window``-token sequences.

    ``ids`` holds the piece's token ids as little-endian 32-bit integers.  A sequence number
    is made of merge level, task and a running number.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(source)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_process(("word-encoder", hash(sent.value)), lambda: WordEncoder(sent.value))
        task, end = TaskContext.get().partitionId(), np.uint32(end_id).tobytes()
        rows = _Rows(0, task)
        packer = Packer(window, open_windows, rows.emit)
        for batch in portions(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids += end
                packer.add(doc, 0, ids, len(ids) // 4)
                if rows.bytes > 1 << 22:
                    yield rows.batch()
        rows.leave(packer.rest(), task)
        yield rows.batch()

    done = materialise(docs.select(doc_id, text).mapInArrow(placed, PIECES), "packed")
    last = done.agg(F.max("part")).first()[0]
    results = [done.where("part IS NULL")]
    left, level, parts = done.where("part IS NOT NULL"), 1, (last or 0) + 1
    while last is not None:
        parts = -(-parts // fan_in)
        left = materialise(_merged(left, level, parts, fan_in, window), f"leftovers{level}")
        results.append(left.where("part IS NULL"))
        left, level = left.where("part IS NOT NULL"), level + 1
        if parts == 1:
            break
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.drop("part")


def _merged(left: DataFrame, level: int, parts: int, fan_in: int, window: int) -> DataFrame:
    """One merge level: ``fan_in`` partial windows to a task; the last level cuts its rest at powers of two."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list] = {}
        for batch in portions(batches):
            for r in batch.to_pylist():
                groups.setdefault(r["part"] // fan_in, []).append((r["part"], r["doc_id"], r["start"], r["ids"], r["doc_tokens"]))
        for group, pieces in sorted(groups.items()):
            rows = _Rows(level, group)
            pieces.sort(key=lambda p: (p[0], p[1] is None, p[1] or 0, p[2]))  # null ids last
            rest = fill([p[1:] for p in pieces], window, rows.emit)
            if parts > 1:
                rows.leave(rest, group)
            while parts == 1 and rest:
                size = 1 << (sum(len(p[2]) // 4 for p in rest).bit_length() - 1)
                rest = _front(rest, size, rows.emit)
            yield rows.batch()

    return left.repartition(parts, F.floor(F.col("part") / fan_in)).mapInArrow(merged, PIECES)


def _front(pieces: list, size: int, emit: Callable[[Window], None]) -> list:
    """Emit the first ``size`` ids as a sequence of their own and return the rest."""
    first: list[Window] = []
    rest = []
    window = Window()
    for doc, start, ids, total in pieces:
        n = min(len(ids) // 4, size - window.used)
        if n:
            Packer._put(window, doc, start, ids[: 4 * n], total)
        if len(ids) > 4 * n:
            rest.append((doc, start + n, ids[4 * n :], total))
    first.append(window)
    emit(first[0])
    return rest
