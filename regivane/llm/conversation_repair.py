"""Repair of the structure of conversations by a dynamic programme shared in a trie.

A conversation's rows, in order of their turns, become a signature of one character a row: ``d``
for a row that has to go (blank, or role and text seen earlier), else the row's role as ``s``,
``u``, ``a`` or ``x`` (any other), in capitals where the text is truncated.  The edits that give
roles of the form ``(s?(ua)+)?`` at least cost depend on the signature alone.

*   Equal signatures become one.  The distinct ones are sorted over all partitions, so that each
    task inserts them, in order, into a prefix trie, of which it holds the path to the last one.
    A node has one layer of the programme: the least cost of each of four states after the rows
    so far.  A shared prefix's layers are computed once; a terminal node gives its signature's
    cost and edits: from its end back the states of cheapest solutions are marked, then forward
    the ASCII-least edit between marked states is taken (from a state each edit has one next state).
*   Rows are handled by their keys (conversation, turn, role, hashes of the text) and partitions
    are ranges of these, cut into segments of bounded size, so a conversation may be longer than a
    task holds.  Its signature is joined from its segments, a character a row.
*   Texts move once, together with their rows' edits, to the digest of the repaired conversation,
    which is taken as they stream past.  SHA-256 has no parts: a conversation's texts pass through
    one task, which holds one of them at a time.

Order: turn (null first); rows of one turn by role, then by two 64-bit hashes of the text (equal
rows stand together).  A role's initial is its first character, told by case.

Defined results: null conv_ids are one conversation; null turns sort first and take no part in
gaps; null roles and texts are one space; an empty or blank role has to be given another role or
go; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regivane.llm.common import materialise, portions

#: White space of the contract: a space and the characters 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits and what a truncated row that stays adds.
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: Rows of one segment.
SEGMENT_ROWS = 2048

#: States: nothing yet, behind a system row, behind a user row, behind an assistant row.
STATES, ENDS = 4, (0, 3)
_FAR = 255
#: A state that costs more than this beyond the cheapest one is on no cheapest way: two insertions lead from the
#: cheapest to the state behind an assistant row or stay below, and only a system row is better off elsewhere, by 2.
_OPEN = 10
#: The state behind a row of a role, and behind one that is given the role that fits or inserted.
_KEPT = {"s": (1, _FAR, _FAR, _FAR), "u": (2, 2, _FAR, 2), "a": (_FAR, _FAR, 3, _FAR), "x": (_FAR,) * 4}
_FITTING = (2, 2, 3, 2)


class Layers:
    """The layers of the trie's path to the last signature: least costs of the states, less the cheapest, and its rise."""

    def __init__(self):
        self.path, self.costs, self.rises, self.computed = "", array("B"), array("B"), 0
        self._add([0, _FAR, _FAR, _FAR])

    def _add(self, row: list[int]) -> None:
        for _ in range(2):  # at most two insertions lead from any state to any other
            for q in range(STATES):
                if row[q] != _FAR:
                    row[_FITTING[q]] = min(row[_FITTING[q]], row[q] + COST[INSERT])
        least = min(row)
        self.rises.append(least)
        self.costs.extend(c - least if c - least <= _OPEN else _FAR for c in row)

    def _step(self, sign: str) -> None:
        before, row = self.costs[-STATES:], [_FAR] * STATES
        for q, cost in enumerate(before):
            if cost != _FAR:
                for edit, then, price in edits(sign, q):
                    if edit != INSERT:
                        row[then] = min(row[then], cost + price)
        self._add(row)
        self.computed += 1

    def insert(self, signature: str) -> tuple[int, str]:
        """(cost, edits) of a signature, no smaller than the one before; layers of their shared prefix stay."""
        shared, most = 0, min(len(self.path), len(signature))
        if self.path[:most] == signature[:most]:
            shared = most
        else:
            low, high = 0, most
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if self.path[:middle] == signature[:middle] else (low, middle - 1)
            shared = low
        del self.costs[STATES * (shared + 1) :], self.rises[shared + 1 :]
        for sign in signature[shared:]:
            self._step(sign)
        self.path = signature
        return self._answer()

    def _answer(self) -> tuple[int, str]:
        signature, n = self.path, len(self.path)
        costs, rises = self.costs, self.rises
        best = min(costs[STATES * n + q] for q in ENDS)
        # bit q of marked[i]: state q after i rows (insertions included) lies on a cheapest way
        marked = bytearray(n + 1)
        marked[n] = sum(1 << q for q in ENDS if costs[STATES * n + q] == best)
        for i in range(n, -1, -1):
            own = costs[STATES * i : STATES * i + STATES]
            for _ in range(2):
                for q in range(STATES):
                    then = _FITTING[q]
                    if own[q] != _FAR and marked[i] >> then & 1 and own[q] + COST[INSERT] == own[then]:
                        marked[i] |= 1 << q
            if i:
                before = costs[STATES * (i - 1) : STATES * i]
                for q in range(STATES):
                    if before[q] != _FAR and any(edit != INSERT and marked[i] >> then & 1 and before[q] + price == own[then] + rises[i] for edit, then, price in edits(signature[i - 1], q)):
                        marked[i - 1] |= 1 << q
        out, i, q = [], 0, 0
        while True:
            own = costs[STATES * i : STATES * i + STATES]
            for edit, then, price in edits(signature[i] if i < n else "", q):
                if edit == INSERT:
                    if marked[i] >> then & 1 and own[q] + price == own[then]:
                        break
                elif marked[i + 1] >> then & 1 and own[q] + price == costs[STATES * (i + 1) + then] + rises[i + 1]:
                    break
            else:
                break
            out.append(edit)
            i, q = i + (edit != INSERT), then
        return sum(rises) + best, "".join(out)


def _edits(sign: str, state: int) -> list[tuple[str, int, int]]:
    found = []
    if sign:
        found.append((DELETE, state, COST[DELETE]))
    found.append((INSERT, _FITTING[state], COST[INSERT]))
    if sign and sign != "d":
        more = TRUNCATED_COST if sign.isupper() else 0
        kept = _KEPT[sign.lower()][state]
        if kept != _FAR:
            found.append((KEEP, kept, COST[KEEP] + more))
        found.append((REROLE, _FITTING[state], COST[REROLE] + more))
    return found


_EDITS = {(sign, q): _edits(sign, q) for sign in ["", *"dsuaxSUAX"] for q in range(STATES)}


def edits(sign: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, next state, cost) of all edits at a row of a signature, or behind the last, in ASCII order."""
    return _EDITS[sign, state]


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text): the rows with the damage that their key's checksum names."""
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    own = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    own = own.where("kind != 0").withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    own = own.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    return own.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


_KEY = ["conv_id", "turn", "role", "h1", "h2"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", "role", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")


def _same(columns: list[str], a: str, b: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def _stripped_end() -> Column:
    return F.rtrim(F.col("text"), F.lit(SPACE))


def faulty(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, n, blank, truncated, first) of the distinct rows of :func:`damaged`.

    ``n`` equal rows of a turn are one here; ``first`` says that no earlier turn has the role and text.
    """
    end = _stripped_end()
    own = _keyed(rows).withColumn("blank", end == "").withColumn("truncated", ~F.right(end, F.lit(1)).isin(".", "!", "?"))
    distinct = materialise(own.groupBy(*_KEY).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")), "rows")
    # nulls sort first, so a null turn is the earliest
    earliest = distinct.groupBy("conv_id", "role", "h1", "h2").agg(F.count("*").alias("turns"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unknown"))
    repeated = materialise(earliest.where("turns > 1"), "repeated")
    seen = distinct.alias("r").join(repeated.alias("e"), _same(["conv_id", "role", "h1", "h2"], "r", "e"), "left")
    first = F.col("e.turns").isNull() | F.when(F.col("e.unknown"), F.col("r.turn").isNull()).otherwise(F.col("r.turn") == F.col("e.least"))
    return materialise(seen.select("r.*", first.alias("first")), "faults")


def segments(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The rows of :func:`faulty` in order, cut into segments of one conversation and bounded size.

    (segment, conv_id, signature, head, tail, illegal, turns, roles, h1s, h2s, counts): segments
    are numbered in the order of the rows; ``head`` and ``tail`` are the first and last role's
    initials and ``illegal`` counts the neighbours inside whose initials do not fit.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *_KEY).sortWithinPartitions(*_KEY).withColumn("part", F.spark_partition_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number, schema = [], 0, 0, None

        def made() -> pa.RecordBatch:
            nonlocal number
            signs, initials = [], []
            for row in held:
                name, n = row["role"][:1], row["n"]
                sign = name if name in ("s", "u", "a") else "x"
                sign = "d" if row["blank"] or not row["first"] else sign.upper() if row["truncated"] else sign
                signs.append(sign + "d" * (n - 1))
                initials += [name] * n
            illegal = sum((a, b) not in _FIT for a, b in zip(initials, initials[1:], strict=False))
            segment, number = (held[0]["part"] << 40) + number, number + 1
            names = ["turn", "role", "h1", "h2", "n"]
            columns = [pa.array([segment], pa.int64()), pa.array([held[0]["conv_id"]], schema.field("conv_id").type), pa.array(["".join(signs)]), pa.array([initials[0]]), pa.array([initials[-1]]), pa.array([illegal], pa.int64())]
            columns += [pa.array([[row[c] for row in held]], pa.list_(schema.field(c).type)) for c in names]
            return pa.RecordBatch.from_arrays(columns, ["segment", "conv_id", "signature", "head", "tail", "illegal", "turns", "roles", "h1s", "h2s", "counts"])

        for batch in portions(batches, 4096):
            schema = batch.schema
            for row in batch.to_pylist():
                while row:
                    if held and (row["conv_id"] != held[-1]["conv_id"] or size >= segment_rows):
                        yield made()
                        held, size = [], 0
                    now = row | {"n": min(row["n"], segment_rows - size)}  # very many equal rows go over several segments
                    held.append(now)
                    size += now["n"]
                    row = row | {"n": row["n"] - now["n"], "first": False} if row["n"] > now["n"] else None
        if held:
            yield made()

    kind = f"segment bigint, conv_id {kinds['conv_id']}, signature string, head string, tail string, illegal bigint, turns array<{kinds['turn']}>, roles array<string>, h1s array<bigint>, h2s array<bigint>, counts array<bigint>"
    return materialise(dealt.mapInArrow(cut, kind), "segments")


#: Initials of neighbours that fit.
_FIT = {("s", "u"), ("u", "a"), ("a", "u")}


def solved(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of distinct signatures."""
    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = signatures.select("signature").repartitionByRange(parts, "signature").sortWithinPartitions("signature")

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers = Layers()
        for batch in portions(batches, 1024):
            found = [layers.insert(s) for s in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], ["signature", "cost", "audit"])

    return dealt.mapInArrow(answered, "signature string, cost bigint, audit string")


def conversation_signatures(cut: DataFrame) -> DataFrame:
    """(conv_id, signature, illegal, parts): a conversation's segments joined; ``parts`` are (segment, rows) in order."""
    own = cut.select("conv_id", F.struct("segment", "signature", "head", "tail", "illegal").alias("s"))
    # a character a row and a few numbers a segment
    joined = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("s"))
    fits = F.zip_with(F.expr("slice(s, 1, size(s) - 1)"), F.expr("slice(s, 2, size(s) - 1)"), lambda a, b: (~F.concat(a["tail"], b["head"]).isin("su", "ua", "au")).cast("bigint"))
    between = F.when(F.size("s") > 1, F.aggregate(fits, F.lit(0).cast("bigint"), lambda t, x: t + x)).otherwise(0)
    inside = F.aggregate("s", F.lit(0).cast("bigint"), lambda t, x: t + x["illegal"])
    return joined.select("conv_id", F.array_join(F.col("s.signature"), "").alias("signature"), (between + inside).cast("bigint").alias("illegal"), F.transform("s", lambda x: F.struct(x["segment"].alias("segment"), F.length(x["signature"]).alias("n"))).alias("parts"))


def row_edits(cut: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, segment, edits): of each row the edits that leave something, insertions before it first.

    Insertions behind the last row of a conversation are that row's too.  ``audits`` has audit and
    parts of each conversation; equal rows of a turn are one row here, at most one of them stays.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = []
            for audit, parts in zip(batch.column("audit").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                at = 0
                for k, part in enumerate(parts):
                    to = _behind(audit, at, part["n"], k == len(parts) - 1)
                    out.append((part["segment"], audit[at:to]))
                    at = to
            if out:
                segment, piece = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(segment, pa.int64()), pa.array(piece)], ["segment", "audit"])

    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}
    met = cut.join(audits.select("audit", "parts").mapInArrow(sliced, "segment bigint, audit string"), "segment")
    names = ["turns", "roles", "h1s", "h2s", "counts"]

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 64):
            out = []
            for segment, conv, audit, *rows in zip(*(batch.column(c).to_pylist() for c in ("segment", "conv_id", "audit", *names)), strict=True):
                at, last = 0, len(rows[0]) - 1
                for k, (turn, role, h1, h2, n) in enumerate(zip(*rows, strict=True)):
                    to = _behind(audit, at, n, k == last)
                    if left := audit[at:to].replace(DELETE, ""):
                        out.append((conv, turn, role, h1, h2, segment, left))
                    at = to
            if out:
                types = [batch.schema.field("conv_id").type, batch.schema.field("turns").type.value_type, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], [*_KEY, "segment", "edits"])

    met = met.select("segment", "conv_id", "audit", *names)
    return met.mapInArrow(given, f"conv_id {kinds['conv_id']}, turn {kinds['turns'][6:-1]}, role string, h1 bigint, h2 bigint, segment bigint, edits string")


def _behind(audit: str, at: int, rows: int, last: bool) -> int:
    """The place in ``audit`` behind the edits of the next ``rows`` rows; behind all if they are the last."""
    if last:
        return len(audit)
    while rows:
        rows -= audit[at] != INSERT
        at += 1
    return at


class Digest:
    """The SHA-256 of a repaired conversation, fed with the rows that stay and what is inserted."""

    def __init__(self, conv_id):
        self.conv_id, self.hash, self.last, self.key, self.waiting = conv_id, None, "", None, ""

    def _add(self, role: str, text: str) -> None:
        if self.hash is None:
            self.hash = hashlib.sha256()
        else:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.last = role[:1]

    def _fitting(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _insert(self) -> None:
        while self.waiting[:1] == INSERT:
            self._add(self._fitting(), "")
            self.waiting = self.waiting[1:]

    def edits(self, key: tuple, left: str) -> None:
        self.key, self.waiting = key, (self.waiting if key == self.key else "") + left
        self._insert()

    def text(self, key: tuple, role: str, text: str) -> None:
        """The row that edits wait for; its copies find none and go."""
        if key == self.key and self.waiting:
            self._add(role if self.waiting[0] == KEEP else self._fitting(), text)
            self.waiting = self.waiting[1:]
            self._insert()


def repaired_digests(rows: DataFrame, left: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of conversations that keep something: rows and their edits stream past together."""
    kind_of = rows.schema["conv_id"].dataType.simpleString()
    texts = _keyed(rows.where(_stripped_end() != "")).withColumns({"segment": F.lit(None).cast("bigint"), "edits": F.lit(None).cast("string")})
    both = texts.unionByName(left.withColumn("text", F.lit(None).cast("string")))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a row's edits come before its text
    met = both.repartition(parts, "conv_id").sortWithinPartitions(*_KEY, F.asc_nulls_last("segment"))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kind = None, None

        def ended(digests: list[Digest]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([d.conv_id for d in digests], kind), pa.array([d.hash.hexdigest() for d in digests], pa.string())], ["conv_id", "repaired_sha256"])

        for batch in portions(batches):
            kind, done = batch.schema.field("conv_id").type, []
            for *key, text, edits_ in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "text", "edits")), strict=True):
                if own is None or own.conv_id != key[0]:
                    done += [own] if own is not None and own.hash else []
                    own = Digest(key[0])
                if edits_ is not None:
                    own.edits(tuple(key), edits_)
                else:
                    own.text(tuple(key), key[2], text)
            yield ended(done)
        if own is not None and own.hash:
            yield ended([own])

    return met.mapInArrow(digested, f"conv_id {kind_of}, repaired_sha256 string")


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conversation of ``rows``.

    ``rows`` has conv_id, turn, role and text, already damaged; see the module for orders and odd values.
    """
    faults = faulty(rows)
    turns = faults.groupBy("conv_id", "turn").agg(F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"), F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.col("first").cast("int"))).alias("duplicate"), F.sum((~F.col("blank") & F.col("first") & F.col("truncated")).cast("bigint")).alias("truncated"))
    gaps = F.expr("coalesce(try_cast(cast(max(turn) AS decimal(38, 0)) - min(turn) + 1 - count(turn) AS bigint), 0)")
    counts = turns.groupBy("conv_id").agg(gaps.alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    cut = segments(faults, segment_rows)
    conversations = materialise(conversation_signatures(cut), "signatures")
    answers = materialise(solved(conversations.select("signature").distinct()), "answers")
    audits = materialise(conversations.join(answers, "signature").select("conv_id", "illegal", "cost", "audit", "parts"), "audits")
    digests = repaired_digests(rows, row_edits(cut, audits))
    found = audits.drop("parts").alias("l").join(counts.alias("r"), _same(["conv_id"], "l", "r")).select("l.*", "r.gaps", "r.blank", "r.duplicate", "r.truncated")
    found = found.alias("l").join(digests.alias("r"), _same(["conv_id"], "l", "r"), "left").select("l.*", "r.repaired_sha256")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damage_and_repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """:func:`repair` of the :func:`damaged` rows, with a row for every conversation of ``rows``."""
    found = repair(damaged(rows, conv_id, turn, role, text), segment_rows)
    every = rows.select(F.col(conv_id).alias("conv_id")).distinct()
    both = every.alias("l").join(found.alias("r"), _same(["conv_id"], "l", "r"), "left")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    zero = F.lit(0).cast("bigint")
    return both.select("l.conv_id", *(F.coalesce(f"r.{c}", nothing.get(c, zero)).alias(c) for c in found.columns if c != "conv_id"))
