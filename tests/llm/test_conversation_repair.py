"""Conversation repair against a plain programme over each conversation by itself."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from regivane.llm import conversation_repair
from regivane.llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment string, audit string, h1 string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(signs):
    """(cost, edits) of [(initial, has to go, truncated)], the ASCII-least of the cheapest."""

    def then(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    @functools.cache
    def best(at, state, inserted):
        found = [(0, "")] if at == len(signs) and state in ("", "a") else []
        fit = "a" if state == "u" else "u"
        if inserted < 3:
            found.append((5, "I", at, fit, inserted + 1))
        if at < len(signs):
            initial, gone, truncated = signs[at]
            found.append((2, "D", at + 1, state, 0))
            if not gone:
                found.append((1 + 5 * truncated, "R", at + 1, fit, 0))
                if then(state, initial):
                    found.append((5 * truncated, "K", at + 1, then(state, initial), 0))
        out = []
        for f in found:
            if len(f) == 2:
                out.append(f)
            elif (rest := best(*f[2:])) is not None:
                out.append((f[0] + rest[0], f[1] + rest[1]))
        return min(out) if out else None

    for at in range(len(signs), 0, -100):  # the recursion stays shallow
        for state in ("", "s", "u", "a"):
            best(at, state, 0)
    return best(0, "", 0)


def brute(rows):
    """Sorted results of the damaged rows, for each conversation by itself."""
    held, out = defaultdict(list), []
    for row in damage(rows):
        held[row[0]].append(row[1:])
    for conv in {r[0] for r in rows}:
        own = sorted(held[conv], key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, role, text in own:
            end = text.rstrip(SPACES)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in itertools.pairwise(initials))
        cost, audit = cheapest([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)])
        pieces, at = [], 0
        for edit in audit:
            fit = "assistant" if pieces and pieces[-1][:1] == "u" else "user"
            if edit == "I":
                pieces.append(fit + ":")
                continue
            if edit != "D":
                pieces.append(f"{own[at][1] if edit == 'K' else fit}:{own[at][2]}")
            at += 1
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(pieces).encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, segment_rows=conversation_repair.SEGMENT_ROWS):
    table = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, conversation_repair.damage_and_repair(table, segment_rows=segment_rows).collect()), key=str)


def conversations(rng, n, longest):
    rows = []
    for conv in range(n):
        turn = rng.choice([0, 0, 1, 5])
        for k in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[k % 2]
            role = rng.choice(["tool", "", "User", "ursula"]) if rng.random() < 0.05 else role
            text = rng.choice(["Yes.", "No", "Well? ", f"Answer {k}!", f"no end {k}", "a.b. \n", "...", "\t \n", "\xa0", "é!?"])
            rows.append((conv, turn, role, text))
            turn += rng.choice([1, 1, 1, 2, 4])
    return rows


@pytest.mark.parametrize("segment_rows", [2048, 3])
def test_random_conversations(spark, segment_rows):
    rows = conversations(random.Random(segment_rows), 250, 12)
    got = result(spark, rows, segment_rows)
    assert got == brute(rows)
    assert {c for r in got for c in r[7]} >= set("DKR")


def test_a_conversation_longer_than_its_segments(spark):
    rng = random.Random(5)
    rows = [(1000, k, rng.choice(["user", "assistant"]), rng.choice(["one.", "two", f"text {k}."])) for k in range(900)] + conversations(rng, 20, 4)
    assert result(spark, rows, 16) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, "assistant", "Hello."), (1, None, None, None), (1, None, "user", "x."), (2, 3, "", "?"), (2, 9, "user", "Long. " * 50000), (3, -4, "assistant", "."), (3, 2**62, "user", "y!")]
    rows += [(4, 0, "user", "same.")] * 9 + [(4, 1, "assistant", "ok.")] + [(5, t, "user", "same.") for t in range(9)]
    lost = next(k for k in range(100, 999) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    rows.append((lost, 1, "user", "gone"))
    for segment_rows in (2048, 2):
        got = result(spark, rows, segment_rows)
        assert got == brute(rows)
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert result(spark, []) == []


def test_edits_of_every_short_signature():
    signs = {c: (c.lower() if c != "d" else "u", c == "d", c.isupper()) for c in "dsuaxSUAX"}
    layers = conversation_repair.Layers()
    every = sorted("".join(s) for n in range(5) for s in itertools.product("dsuaxSUAX", repeat=n))
    for signature in every:
        assert layers.insert(signature) == cheapest([signs[c] for c in signature]), signature
    # a layer for each node of the trie, not for each character
    assert layers.computed == len(every) - 1


def test_edits_of_long_signatures():
    rng = random.Random(1)
    signs = {c: (c.lower() if c != "d" else "u", c == "d", c.isupper()) for c in "dsuaxSUAX"}
    every = sorted("".join(rng.choices("dsuaxSUAX", [3, 1, 4, 4, 1, 1, 1, 1, 1], k=rng.randint(5, 60))) for _ in range(300))
    layers = conversation_repair.Layers()
    assert [layers.insert(s) for s in every] == [cheapest([signs[c] for c in s]) for s in every]
    # system rows behind very many rows that have to go
    for signature in ("d" * 400 + "sua", "s" + "d" * 300 + "ua", "x" * 300 + "sua"):
        fresh = conversation_repair.Layers()
        cost, audit = fresh.insert(signature)
        assert len(audit.replace("I", "")) == len(signature) and cost == {"d": 800, "s": 600, "x": 300}[signature[0]] + (2 if signature[0] == "x" else 0)


def test_query_holds_every_conversation(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, sf).collect()), key=str)
    assert got == brute(rows)
