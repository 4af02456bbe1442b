"""Greedy word-piece lengths by one pass over a trie with failure links.

A trie node whose string cannot be extended pops the pieces at its front and goes on from
its failure node.  Both are worked out when the automaton is built, and only the number of
popped pieces is kept, so a count walks each byte once and makes no pieces.

The vocabulary is that of a byte-level tokenizer file: every single byte is a piece, so each
word has a segmentation.  Words are the pre-tokens of that file's pattern.

Defined results: null and empty texts have 0 words and 0 pieces; other columns pass through,
but for those named as the output in whichever case, which are replaced; repeated rows are
counted each for itself; an empty table gives no rows; a text of any length is counted whole,
and what is kept between texts (short pieces only) does not grow with it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from regivane.llm.bpe_codec import CHUNK, Tokenizer
from regivane.llm.common import TwoGenerationCache, kept_fields, per_process, portions


class PieceCounter:
    """Children by byte, failure node and popped-piece count of every trie node."""

    def __init__(self, pieces: Iterable[bytes]):
        children: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                at = children[node].get(b)
                if at is None:
                    at = children[node][b] = len(children)
                    children.append({})
                    ends.append(False)
                node = at
            ends[node] = node != 0
        failure, popped = [-1] * len(children), [0] * len(children)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for b, node in children[parent].items():
                queue.append(node)
                if ends[node]:
                    failure[node], popped[node] = 0, 1
                    continue
                at, n = failure[parent], popped[parent]
                while at >= 0 and b not in children[at]:
                    n += popped[at]
                    at = failure[at]
                if at >= 0:
                    failure[node], popped[node] = children[at][b], n
        self.children, self.failure, self.popped = children, failure, popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match segmentation; -1 where there is none."""
        children, failure, popped = self.children, self.failure, self.popped
        node = n = 0
        for b in word:
            while b not in children[node]:
                n += popped[node]
                node = failure[node]
                if node < 0:
                    return -1
            node = children[node][b]
        while node:
            n += popped[node]
            node = failure[node]
            if node < 0:
                return -1
        return n


def count_tokens(docs: DataFrame, source: str, text: str = "text", memo: int = 1 << 18) -> DataFrame:
    """Append ``n_words`` and ``n_tokens`` (both long) for the whole ``text``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(source)
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]
    schema = T.StructType([*kept_fields(docs, ["n_words", "n_tokens"]), *added])
    names = [f.name for f in schema][:-2]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make():
            tokenizer = Tokenizer(sent.value)
            return tokenizer.words, PieceCounter(tokenizer.ids), TwoGenerationCache(memo)

        words, counter, cache = per_process(("piece-counter", hash(sent.value)), make)

        def fresh(chunk: str) -> int:
            found = words(chunk)
            # both figures in one integer, so that a text's figures are one sum
            return cache.put(chunk, (len(found) << 40) + sum(counter.count(w.encode("utf-8", "surrogatepass")) for w in found))

        get = cache.get
        for batch in portions(batches):
            sums = [sum(get(c) or fresh(c) for c in CHUNK.findall(v or "")) for v in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([s >> 40 for s in sums], pa.int64()), pa.array([s & (1 << 40) - 1 for s in sums], pa.int64())], [*names, "n_words", "n_tokens"])

    return docs.mapInArrow(counted, schema)
