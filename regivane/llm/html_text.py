"""Main text of web pages by differencing each page with the nearest pages of its host.

A page is cut into lines (the text between block-level tags) that carry where they stand.
Pages are ordered by host and URL path; each is compared with the ``REACH`` nearest pages of its
host on both sides.  Lines are aligned by longest common subsequence.  Outside ``article`` and
``main`` a line that any neighbour shares is template and goes: a menu entry or advert that one
neighbour lacks is found by another.  Inside, a sentence may recur on some pages, so only a line
that all neighbours share, two at least, goes; and where over half of the letters inside are
shared, the page is a copy and these lines stay.  Few pages cannot show a template, so lines
inside navigation, header, footer, aside, form, script, hidden or so named elements go as well.

Only line hashes travel to the neighbour.  The order is found by a range sort and global
positions, so a host with a third of all pages is spread like any other.

Defined results: null html counts as empty and gives an empty text; a null or odd URL has an
empty host and path; a page with no neighbour on its host is judged by its own marks (of a
page with ``article`` or ``main``, the lines inside); a page
whose every line outside boilerplate is shared (a copy) keeps these lines; equal paths are
ordered arbitrarily; repeated rows stay repeated; an empty table gives no rows; other columns
are ignored; a page of any length is read whole, in time linear in its length but for the
alignment of lines that both pages have and that do not stand at their ends.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regivane.llm.common import frames_in_portions, materialise

_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][\w:-]*+)(?=[\s/>]))")
_STOP = re.compile("[>\"']")
#: An attribute begins where no name runs on, so that each character is read once.
_ATTRIBUTE = re.compile(r"(?<![\w:-])([\w:-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|(?<=\s)(hidden)(?=\s|$|/)", re.S)
_SPACE = re.compile(r"\s+")

#: Elements whose content is not text of the page.
RAW = frozenset("script style noscript template svg canvas iframe object math head title textarea audio video".split())
#: Elements that hold no main text.
BOILERPLATE = frozenset("nav header footer aside form button select dialog menu fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CONTENT = frozenset("article main".split())
#: Class and id names (whole ones) of elements that hold no main text.
NAMES = frozenset(
    """ad ads adv advert advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr
    notice notification alert sidebar side menu navbar nav navigation breadcrumb breadcrumbs footer header masthead
    comment comments disqus respond reply share sharing social related recommended newsletter subscribe signup
    login popup modal overlay widget pagination pager toolbar skip""".split()
)
#: Neighbours on each side that a page is compared with.
REACH = 2
#: Bits of an alignment that are held at once.
TABLE_BITS = 1 << 28
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that others of the same kind, or the end of what is around, close silently.
LOOSE = INLINE | frozenset("p li dt dd tr td th option thead tbody tfoot colgroup".split())


class Tags:
    """The tags, comments and declarations of a page in order, in time linear in its length.

    A tag ends at the first ``>`` outside quotes; a ``<`` without such an end is text.
    """

    def __init__(self, source: str):
        self.source, self.last = source, source.rfind(">")
        self.dead: set[int] = set()  # quotes that open outside quotes of a tag without an end
        self.gap = (0, -1)  # a stretch without quotes and ends, and where it stops

    def _end(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``; -1 if it does not."""
        source, path = self.source, []
        if not self.gap[0] <= at <= self.gap[1]:
            stop = _STOP.search(source, at)
            self.gap = (at, stop.start() if stop else len(source))
        stop = self.gap[1]
        while stop < len(source) and stop not in self.dead:
            if source[stop] == ">":
                return stop
            path.append(stop)
            close = source.find(source[stop], stop + 1)
            found = _STOP.search(source, close + 1) if close >= 0 else None
            stop = found.start() if found else len(source)
        self.dead.update(path)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, closing slash, name, attributes) of the next one; comments and declarations have no name."""
        source = self.source
        while found := _OPEN.search(source, at):
            comment, closing, name = found.groups()
            at = found.end()
            if comment:
                end = source.find("-->", at)
                return found.start(), (end + 3 if end >= 0 else len(source)), "", "", ""
            if found.start() > self.last:
                continue
            if name is None:
                return found.start(), source.index(">", at) + 1, "", "", ""
            end = self._end(at)
            if end >= 0:
                return found.start(), end + 1, closing, name.lower(), source[at:end]
        return None


def lines_of(source: str) -> list[tuple[str, bool, bool]]:
    """(text, inside content, inside boilerplate) of each line that is not empty, in page order."""
    out: list[tuple[str, bool, bool, int]] = []
    stack: list[tuple[str, bool, bool, int]] = []  # name, content, boilerplate, innermost element around that is named as such
    open_names: Counter = Counter()
    above: list[int] = []  # by named element: the named one around it, or -1
    holders: set[int] = set()  # named elements that hold an article or main
    unclosed: set[str] = set()  # raw elements that are not closed any more
    text: list[str] = []
    tags, at, n = Tags(source), 0, len(source)

    def flush() -> None:
        if text:
            line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if line:
                _, content, waste, around = stack[-1] if stack else ("", False, False, -1)
                out.append((line, content, waste, around))

    while at < n:
        found = tags.next(at)
        if not found:
            text.append(source[at:])
            break
        start, end, closing, name, attributes = found
        if start > at:
            text.append(source[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            text.append(" ")
            continue
        if name not in INLINE:
            flush()
        if closing:
            if name not in LOOSE and open_names[name]:
                while True:
                    ended = stack.pop()[0]
                    open_names[ended] -= 1
                    if ended == name:
                        break
            continue
        if name in RAW:
            end = None if name in unclosed else re.compile(rf"</{name}\s*+>", re.I).search(source, at)
            if not end:
                unclosed.add(name)
            at = end.end() if end else (n if name in ("script", "style") else at)
            if name not in INLINE:
                flush()
            continue
        if name in VOID or name in LOOSE or attributes.rstrip().endswith("/"):
            continue
        _, content, waste, around = stack[-1] if stack else ("", False, False, -1)
        named, role, hidden = _marks(attributes)
        inner_header = name == "header" and content
        if (name in CONTENT or role in ("main", "article")) and not waste:
            k = around
            while k >= 0 and k not in holders:
                holders.add(k)
                k = above[k]
        content = content or name in CONTENT or role in ("main", "article")
        waste = waste or (name in BOILERPLATE and not inner_header) or role in ROLES or hidden
        if named and name not in ("body", "html", "article", "main"):
            above.append(around)
            around = len(above) - 1
        stack.append((name, content, waste, around))
        open_names[name] += 1
    flush()
    return _without_wrappers(out, above, holders)


def _without_wrappers(lines: list[tuple[str, bool, bool, int]], above: list[int], holders: set[int]) -> list[tuple[str, bool, bool]]:
    """Lines inside named elements are boilerplate, unless the element wraps the page's content.

    That is so where no article or main stands outside named elements: then those that hold
    one are wrappers, or, without any, those with over half of the page's letters.
    """

    def inside(wrappers: set[int]) -> list[bool]:
        """By named element: whether it and all named ones around it are wrappers; the last, for none, holds."""
        whole = [True] * (len(above) + 1)
        for k, over in enumerate(above):
            whole[k] = k in wrappers and whole[over]
        return whole

    clear = inside(set())
    if above and not any(content and not waste and clear[around] for _, content, waste, around in lines):
        clear = inside(holders)
        if not any(content and not waste and clear[around] for _, content, waste, around in lines):
            sizes = [0] * (len(above) + 1)
            for t, _, waste, around in lines:
                sizes[around] += len(t) if not waste else 0
            half = sum(sizes) / 2
            for k in range(len(above) - 1, -1, -1):
                sizes[above[k]] += sizes[k]
            clear = inside(holders | {k for k in range(len(above)) if sizes[k] > half})
    return [(t, content, waste or not clear[around]) for t, content, waste, around in lines]


def _marks(attributes: str) -> tuple[bool, str, bool]:
    """Whether class or id name boilerplate, the role, whether the element is hidden."""
    named, role, hidden = False, "", False
    if not attributes.strip():
        return named, role, hidden
    for key, a, b, c, bare in _ATTRIBUTE.findall(attributes):
        value, key = (a or b or c).lower(), (key or bare).lower()
        if key in ("class", "id"):
            named = named or not NAMES.isdisjoint(value.split())
        elif key == "role":
            role = value.strip()
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            hidden = True
        elif key == "style":
            hidden = hidden or "display:none" in value.replace(" ", "")
    return named, role, hidden


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``.

    Lines that the other page lacks and then common ends go first; the rest is aligned by the
    bit-parallel recurrence, one addition over all lines of ``b`` for each line of ``a``.
    """
    theirs, mine = set(b), set(a)
    own = [k for k, x in enumerate(a) if x in theirs]
    other = [x for x in b if x in mine]
    lo, up, least = 0, 0, min(len(own), len(other))
    while lo < least and a[own[lo]] == other[lo]:
        lo += 1
    while up < least - lo and a[own[-1 - up]] == other[-1 - up]:
        up += 1
    out = {*own[:lo], *own[len(own) - up :]}
    own, other = own[lo : len(own) - up], other[lo : len(other) - up]
    todo = [(own, other)]
    while todo:
        part, other = todo.pop()
        if not part or not other:
            continue
        if len(part) * len(other) <= TABLE_BITS or len(part) == 1:
            out.update(_aligned(a, part, other))
            continue
        # too large for a table: halve one side where both halves together reach the best (Hirschberg)
        half = len(part) // 2
        left = _lengths([a[k] for k in part[:half]], other)
        right = _lengths([a[k] for k in reversed(part[half:])], other[::-1])
        cut = int((left + right[::-1]).argmax())
        todo += [(part[:half], other[:cut]), (part[half:], other[cut:])]
    return out


def _steps(a: Iterable[int], b: list[int]) -> Iterator[int]:
    """After each line of ``a``, the bits of ``b``: 0 where one more line of ``b`` makes a longer common subsequence."""
    where: dict[int, int] = defaultdict(int)
    for k, x in enumerate(b):
        where[x] |= 1 << k
    whole = state = (1 << len(b)) - 1
    for x in a:
        matched = state & where.get(x, 0)
        state = ((state + matched) | (state - matched)) & whole
        yield state


def _bits(state: int, n: int) -> bytes:
    return state.to_bytes((n + 7) // 8, "little")


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    state = 0
    for state in _steps(a, b):
        pass
    gains = np.unpackbits(np.frombuffer(_bits(state, len(b)), dtype=np.uint8), count=len(b), bitorder="little") == 0
    return np.concatenate(([0], np.cumsum(gains)))


def _aligned(a: list[int], part: list[int], b: list[int]) -> Iterator[int]:
    rows = [_bits(state, len(b)) for state in _steps((a[k] for k in part), b)]
    i, j = len(part), len(b)
    while i and j:
        byte, bit = (j - 1) >> 3, 1 << ((j - 1) & 7)
        if rows[i - 1][byte] & bit:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1][byte] & bit:
            j -= 1
            yield part[i]


def candidates(lines: list[tuple[str, bool, bool]]) -> list[tuple[int, str, bool]]:
    """(place, text, inside content) of the lines outside boilerplate, which may stay."""
    return [(k, t, content) for k, (t, content, waste) in enumerate(lines) if not waste]


def main_lines(lines: list[tuple[int, str, bool]], shared: set[int] | None, agreed: set[int] = frozenset()) -> list[str]:
    """The lines that stay, of those that any neighbour and that all neighbours share; ``shared`` is None without neighbours."""
    marked = [(k, t) for k, t, content in lines if content]
    if shared is None:
        return [t for _, t in marked] or [t for _, t, _ in lines]
    copy = 2 * sum(len(t) for k, t in marked if k in shared) > sum(len(t) for _, t in marked)
    own = [t for k, t, content in lines if (copy or k not in agreed if content else k not in shared)]
    return own or [t for _, t, _ in lines]


def support(keys: list[int], others: list[list[int]]) -> tuple[set[int], set[int]]:
    """Places of the lines that any of the neighbours shares, and that all of two or more share."""
    counts = Counter(k for other in others for k in common_lines(keys, other))
    return set(counts), {k for k, n in counts.items() if n == len(others) > 1}


def line_keys(lines: list[tuple[str, bool, bool]]) -> list[int]:
    return [xxhash.xxh32_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 31) for t, _, _ in lines]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_lines, n_shared) of each page.

    Pages are cut twice: once for the line hashes that neighbours are compared by, and once
    for the lines, which so cross the network once, packed, and are stored nowhere.
    """
    spark = pages.sparkSession
    plain = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    address = F.regexp_replace(F.lower(F.coalesce(F.col("url"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(address, r"^([^/?#]*)", 1)
    path = F.regexp_extract(address, r"^[^/?#]*([^?#]*)", 1)
    # equal rows share an identity, and with it the neighbour of one of them
    plain = plain.withColumn("row", F.xxhash64("page_id", "url", "html"))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_in_portions(frames):
            yield frame[["row", "host", "path"]].assign(keys=[line_keys(lines_of(h or "")) for h in frame["html"]])

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_in_portions(frames):
            lines = [lines_of(h or "") for h in frame["html"]]
            kept = [zlib.compress(json.dumps(candidates(x), ensure_ascii=False).encode("utf-8", "surrogatepass"), 6) for x in lines]
            yield frame[["row", "page_id", "url"]].assign(keys=[line_keys(x) for x in lines], lines=kept)

    def differenced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_in_portions(frames):
            texts, n_lines, n_shared = [], [], []
            for pack, keys, others in zip(frame["lines"], frame["keys"], frame["others"], strict=True):
                lines = json.loads(zlib.decompress(pack).decode("utf-8", "surrogatepass"))
                shared, agreed = support(list(keys), [list(other) for other in others]) if others is not None else (None, set())
                texts.append("\n\n".join(main_lines(lines, shared, agreed)))
                n_lines.append(len(keys))
                n_shared.append(len(shared or ()))
            yield frame[["page_id", "url"]].assign(text=texts, n_lines=n_lines, n_shared=n_shared)

    kind = f"page_id {pages.schema[page_id].dataType.simpleString()}, url string"
    cut = plain.select("row", host.alias("host"), path.alias("path"), "html").mapInPandas(hashed, "row bigint, host string, path string, keys array<int>")
    cut = materialise(cut.withColumn("uid", F.monotonically_increasing_id()), "page-keys")
    theirs = cut.select(F.col("uid").alias("partner"), F.col("keys").alias("other"))
    # equal rows have the neighbours of one of them
    first = cut.groupBy("row").agg(F.min("uid").alias("uid"))
    matched = neighbours(cut.select("uid", "host", "path")).join(first, "uid").join(theirs, "partner")
    matched = matched.groupBy("row").agg(F.collect_list("other").alias("others"))  # at most twice the reach
    lines = plain.mapInPandas(packed, f"row bigint, {kind}, keys array<int>, lines binary")
    joined = lines.join(matched, "row", "left").drop("row")
    return joined.mapInPandas(differenced, f"{kind}, text string, n_lines bigint, n_shared bigint")


def neighbours(rows: DataFrame, reach: int = REACH) -> DataFrame:
    """(uid, partner): the pages of the same host at most ``reach`` places away in the order of paths."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "host", "path", "uid").sortWithinPartitions("host", "path", "uid")
    ordered = materialise(ordered.withColumn("at", F.monotonically_increasing_id()), "page-order")
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row["part"], total))
        total += row["count"]
    starts = spark.createDataFrame(starts, "part bigint, start bigint")
    placed = ordered.withColumn("part", part).join(F.broadcast(starts), "part")
    placed = placed.select("uid", "host", (F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("place"))
    after = placed.select(F.col("uid").alias("next"), F.col("host").alias("next_host"), "place", F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("back"))
    after = after.select("next", "next_host", (F.col("place") - F.col("back")).alias("place"))
    pairs = placed.join(after, "place").where("host = next_host")
    sides = F.array(F.struct(F.col("uid"), F.col("next").alias("partner")), F.struct(F.col("next").alias("uid"), F.col("uid").alias("partner")))
    return pairs.select(F.explode(sides).alias("x")).select("x.*")
