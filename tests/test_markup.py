"""Rows of pages against a tree built by the standard library's tokeniser."""

import html
import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from regivane.operators import acquire, markup


class Tree(HTMLParser):
    """Elements with children; an end tag closes the innermost open element of its name and what is inside."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.root = ("", [])
        self.open, self.last = [self.root], None

    def handle_starttag(self, tag, attrs):
        element = (tag, [])
        self.open[-1][1].append(element)
        self.last = None
        if tag not in markup.VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.last = None
        for k in range(len(self.open) - 1, 0, -1):
            if tag not in markup.VOID and self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_comment(self, data):
        self.last = None

    def handle_data(self, data):
        if self.open[-1][0] in ("script", "style"):
            return
        if self.last is None:
            self.last = [""]
            self.open[-1][1].append(self.last)
        self.last[0] += data

    def handle_charref(self, name):
        n = int(name[1:], 16) if name[0] in "xX" else int(name)
        try:
            self.handle_data(bytes([n]).decode("cp1252") if n < 256 else chr(n))
        except UnicodeDecodeError:
            self.handle_data(chr(n))
        except (ValueError, OverflowError):
            self.handle_data("�")

    def handle_entityref(self, name):
        self.handle_data(html.entities.html5.get(name + ";") or html.entities.html5.get(name) or "&" + name)


def below(element, name):
    for child in element[1]:
        if isinstance(child, tuple):
            if child[0] == name:
                yield child
            yield from below(child, name)


def nodes(element):
    for child in element[1]:
        yield from nodes(child) if isinstance(child, tuple) else [child[0]]


def expected(page):
    tree = Tree()
    tree.feed(page)
    tree.close()
    rows = []
    for row in below(tree.root, "tr"):
        cells = list(below(row, "td"))
        if len(cells) >= 4:
            rows.append(["".join(t.strip() for t in nodes(cells[0])), *("".join(nodes(c)) for c in cells[1:4])])
    return rows


def found(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "k int, html string")
    return [r.rows for r in df.select("k", markup.row_cells(F.col("html")).alias("rows")).orderBy("k").collect()]


PARTS = ["<tr>", "</tr>", "<td>", "</td>", "<TD class='x'>", "</TD >", "<table>", "</table>", "<b>", "</b>", "<br>", "<p>", "</p>", "<td/>", "<!-- <tr> -->", " a ", "1", "23", "&amp;", "&nbsp;", "&eacute;", "&#50;", "&#x41;", "&#150;", "&nope;", " < ", "x\n", "<script>'<td>'</script>"]


def test_random_markup(spark):
    rng = random.Random(1)
    pages = ["".join(rng.choices(PARTS, k=rng.randint(1, 40))) + " " for _ in range(1500)]
    flat = "<tr><td>{}</td><td>{}</td><td>{}</td><td>{}</td>{}</tr>"
    text = ["a", " b ", "&nbsp;c", "<b> d </b>e", "1,2", "", "<i>&lt;</i>", "<br>"]
    pages += ["".join(flat.format(*rng.choices(text, k=5)) for _ in range(rng.randint(1, 6))) for _ in range(200)]
    assert found(spark, pages) == [expected(p) for p in pages]


@pytest.mark.parametrize(
    "page, rows",
    [
        ("<tr><td>&nbsp;Foo&nbsp;</td><td>&#50;</td><td>1</td><td>3</td></tr>", [["Foo", "2", "1", "3"]]),
        ("<tr><td>Cuauht&eacute;moc</td><td>1</td><td>1</td><td>1</td>", [["Cuauhtémoc", "1", "1", "1"]]),
        ("<tr><td>A<table><tr><td>B</td><td>5</td><td>6</td><td>7</td></tr></table></td><td>1</td></tr>", [["AB567", "B", "5", "6"], ["B", "5", "6", "7"]]),
        ("", []),
        (None, []),
    ],
)
def test_cases(spark, page, rows):
    assert found(spark, [page]) == [rows]


def test_a_large_page_takes_its_share_of_time(spark):
    rows = ["<tr><td>x<table><tr><td>in</td><td>1</td><td>1</td><td>1</td></tr></table></td><td>5</td><td>6</td><td>7</td></tr>", "<tr><td>y<td>1<td>2<td>3</tr>", "<tr><td>" + "long < text " * 2000 + "</td><td>&#50;</td><td/><td></td></tr>"]
    pages = ["".join(rows[k % 3 if k % 500 == 2 else k % 2] for k in range(n)) for n in (300, 9000)]
    took = []
    for page in [pages[0], *pages]:
        began = time.monotonic()
        assert found(spark, [page]) == [expected(page)]
        took.append(time.monotonic() - began)
    assert took[2] < 30 * max(took[1], 1.0)


def test_references_as_the_parser_reads_them(spark):
    pages = [f"<tr><td>x{r}</td><td></td><td></td><td></td></tr>" for r in ("&Agrave;", "&notin;", "&not", "&#x80;", "&#129;", "&#0;", "&#1114112;", "&#xD800;", "&#12345678901234567890;", "&#x0000041;", "&;", "&&amp;", "&#;", "&zwj;", "&NotEqualTilde;", "&#x1F600;")]
    got = [rows[0][0] for rows in found(spark, pages)]
    assert got == ["xÀ", "x∉", "x¬", "x€", "x\x81", "x\x00", "x�", "x�", "x�", "xA", "x&;", "x&&", "x&#;", "x‍", "x≂̸", "x😀"]


def test_a_count_that_cannot_be_read_drops_its_page(spark):
    cell = "<tr><td>{}</td><td>{}</td><td>2</td><td>3</td></tr>"
    pages = [(1, cell.format("a", "1") + cell.format("b", "1²")), (2, cell.format("c", "٣") + cell.format("d", "½")), (3, "<tr><td>e</td><td>²</td><td>2</td></tr>" + cell.format("f²", "x²"))]
    rows = acquire.extract_rows(spark.createDataFrame(pages, "page int, html string")).collect()
    assert [(r.page, r.municipio, r.hombres) for r in rows] == [(2, "c", 3), (2, "d", 0), (3, "f²", 0)]
