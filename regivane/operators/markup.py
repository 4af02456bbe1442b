"""Table rows of pages of any quality, as Column expressions.

A page is read as a tree that lenient parsers build: a start tag opens an element below the
innermost open one, an end tag closes the innermost open element of its name with all inside it
(and is passed over where none is open), void elements hold nothing, and the end of the page
closes what is open.  Every ``tr`` is a row, and every ``td`` inside it is its cell, those of nested
tables too.  A cell's text nodes are decoded one by one.

Pages whose rows hold only closed cells with text and closed inline elements are cut by regular
expressions in the JVM; for others one pass over the page's tags, in Python, carries the open
elements and rows, and the JVM decodes the text nodes that it finds.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from regivane.functions import text

#: Cells that a row needs, and that are read of it.
CELLS = 4
# Elements without an end.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Elements that the fast path may find inside a cell.
_INLINE = "a|abbr|b|code|em|font|i|small|span|strong|sub|sup|u"
_QUOTED = r"""(?:[^<>"']|"[^"]*"|'[^']*')*+"""
#: A comment or declaration, a script or style with its content, a tag, or text (a ``<`` before anything else is text).
_TOKEN = rf"""(?ais)<!--.*?(?:-->|\Z)|<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-z][^\s/>]*{_QUOTED}(?:>|\Z)|(?P<text>(?:[^<]|<(?![a-z/!?])|</(?![a-z]))++)"""
_TOKENS, _TAG = re.compile(_TOKEN), re.compile(r"(?a)</?([a-zA-Z][^\s/>]*)")
#: Scripts and styles, and tags that close themselves.
_RAW, _CLOSED = re.compile(r"(?ai)<(?:script|style)\b"), re.compile(r"(?a)/\s*>$")


@cache
def _names() -> str:
    """Named character references without their semicolons, as JSON."""
    return json.dumps({name.rstrip(";"): value for name, value in html.entities.html5.items()})


def decode_references(x: Column) -> Column:
    """Character references as the characters they name; numbers below 160 as Windows-1252 has them.

    A name needs no semicolon; an unknown one stays, without it; a number that is no character
    gives the replacement character.
    """
    known = F.from_json(F.lit(_names()), "map<string,string>")
    low = [(chr(b), bytes([b]).decode("cp1252", "replace")) for b in range(0x80, 0xA0)]
    low = [(a, b) for a, b in low if b != "�"]

    def numbered(token: Column) -> Column:
        digits = F.regexp_extract(token, "^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
        code = F.when(token.rlike("^&#[xX]"), F.when(F.length(digits) <= 6, F.conv(digits, 16, 10).try_cast("bigint"))).otherwise(F.when(F.length(digits) <= 7, digits.try_cast("bigint")))
        code = F.when(digits == "", F.lit(0)).otherwise(code)
        valid = (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(valid, F.translate(character, "".join(a for a, _ in low), "".join(b for _, b in low))).otherwise(F.lit("�"))

    def named(token: Column) -> Column:
        name = F.regexp_extract(token, "^&([a-zA-Z][-.a-zA-Z0-9]*);?$", 1)
        return F.coalesce(F.try_element_at(known, name), F.concat(F.lit("&"), name))

    def decoded(token: Column) -> Column:
        return F.when(token.rlike("^&#[0-9]|^&#[xX][0-9a-fA-F]"), numbered(token)).when(token.rlike("^&[a-zA-Z]"), named(token)).otherwise(token)

    tokens = F.regexp_extract_all(x, F.lit(r"&#[0-9]++;?|&#[xX][0-9a-fA-F]++;?|&[a-zA-Z][-.a-zA-Z0-9]*+;?|[^&]++|&"), F.lit(0))
    return F.when(F.instr(x, "&") == 0, x).otherwise(F.array_join(F.transform(tokens, decoded), ""))


def _count(x: Column, pattern: str) -> Column:
    return F.regexp_count(x, F.lit(pattern))


def _fast_rows(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))


def is_plain(x: Column) -> Column:
    """Whether all rows of a page hold nothing but closed cells of text and closed inline elements."""
    inline = rf"(?is)<({_INLINE})\b[^<>]*>([^<]*)</\1\s*>"

    def plain_row(row: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(row, inline, "$2"), inline, "$2")
        return F.instr(F.regexp_replace(bare, r"(?is)<td\b[^<>]*>[^<]*</td\s*>", ""), "<") == 0

    odd = x.rlike(r"""(?i)<[!?]|<(?:script|style)\b|=\s*"[^"<>]*[<>]|=\s*'[^'<>]*[<>]|<[a-z][^<>]*/>""")
    same = (_count(x, r"(?i)<tr\b") == _count(x, r"(?i)</tr\s*>")) & (_count(x, r"(?i)</tr\b") == F.size(_fast_rows(x)))
    return ~odd & same & F.forall(_fast_rows(x), plain_row)


def _plain_cells(x: Column) -> Column:
    """Cells of the rows of a plain page, the first :data:`CELLS` of each."""

    def cells(row: Column) -> Column:
        found = F.slice(F.regexp_extract_all(row, F.lit(r"(?is)<td\b[^>]*>(.*?)</td\s*>"), F.lit(1)), 1, CELLS)
        return F.transform(found, lambda c, k: F.array_join(F.transform(F.split(c, "<[^>]*>"), lambda t: _node(t, k)), ""))

    return F.transform(_fast_rows(x), cells)


def _node(node: Column, place: Column) -> Column:
    """A text node of a row's cell: the first cell's are stripped."""
    decoded = decode_references(node)
    return F.when(place == 0, text.strip(decoded)).otherwise(decoded)


def _tree_nodes(page: str) -> list[list[list[str]]]:
    """The text nodes of the first cells of a page's rows, in the order of the rows' beginnings.

    One pass: a cell is one list that all rows around it share, so a token costs the cells it is in.
    """
    rows, within, stack, cells, names = [], [], [], [], Counter()

    def close(name: str) -> None:
        while names[name]:
            last, cell = stack.pop()
            names[last] -= 1
            if last == "tr":
                within.pop()
            if cell is not None:
                cells.pop()
            if last == name:
                return

    for token in _TOKENS.finditer(page):
        t = token[0]
        if token["text"] is not None:
            for cell in cells:
                cell.append(t)
        elif (found := _TAG.match(t)) and (name := found[1].lower()) not in VOID and not _RAW.match(t):
            if t[1] == "/":
                close(name)
                continue
            cell = None
            if name == "tr":
                rows.append([])
                within.append(rows[-1])
            elif name == "td" and (wanting := [row for row in within if len(row) < CELLS]):
                cell = []
                cells.append(cell)
                for row in wanting:
                    row.append(cell)
            stack.append((name, cell))
            names[name] += 1
            if _CLOSED.search(t):
                close(name)
    return rows


def _tree_cells(x: Column) -> Column:
    """Cells of the rows of any page, in the order of the rows' beginnings; null for a null page."""

    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: None if page is None else _tree_nodes(page))

    nodes = F.pandas_udf(read, "array<array<array<string>>>")(x)
    return F.transform(nodes, lambda row: F.transform(row, lambda cell, k: F.array_join(F.transform(cell, lambda node: _node(node, k)), "")))


def row_cells(x: Column) -> Column:
    """The rows of a page, each the texts of its first cells; rows of fewer than :data:`CELLS` are left out.

    The first cell's text nodes are stripped and joined, the others' are joined as they are.  A
    null page has no rows.
    """
    page = F.coalesce(x, F.lit(""))
    plain = is_plain(page)
    rows = F.when(plain, _plain_cells(page)).otherwise(_tree_cells(F.when(~plain, page)))
    return F.filter(rows, lambda r: F.size(r) == CELLS)
