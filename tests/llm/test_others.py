import math
import random
import tarfile
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from regivane.llm import ann, html_text, media, queries
from regivane.llm.common import shared_path

# ---- nearest neighbours ----


def brute(table, is_query, k):
    good = [(i, np.array(v, dtype=float)) for i, v in table if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if is_query(i):
            scored = {}
            for j, w in good:
                if j != i:
                    scored[j] = max(scored.get(j, -np.inf), float(v @ w))
            out[i] = sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def search(spark, rows, k=20, every=20):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("list", F.lit("x"))
    got = {}
    for r in ann.search(table, F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(size=5).astype(np.float32).tolist()) for k in range(90)]
    rows += [(100, None), (120, [0.0] * 5), (140, [float("nan"), 1.0, 1.0, 1.0, 1.0]), (160, [None, 1.0, 1.0, 1.0, 1.0]), (180, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (200, rows[3][1]), (201, rows[3][1]), (202, rows[3][1])]
    got, truth = search(spark, rows), brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == truth.keys()
    for i in truth:
        assert [j for j, _ in got[i]] == [j for j, _ in truth[i]]
        assert np.allclose([s for _, s in got[i]], [s for _, s in truth[i]], rtol=0, atol=1e-12)


def test_few_and_none(spark):
    assert search(spark, [(0, [1.0, 0.0]), (1, [2.0, 0.0])]) == {0: [(1, 2.0)]}
    assert search(spark, [(0, [1.0, 0.0])]) == {} and search(spark, []) == {}


def test_recall_on_many(spark, sf):
    table = spark.read.parquet(sf.replace("0.001", "0.1") + "/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    truth = brute(rows, lambda i: i % 20 == 0, 20)
    got = {}
    for r in queries.op1_ann(spark, sf.replace("0.001", "0.1")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[i] & {j for j, _ in t}) / len(t) for i, t in truth.items()]) >= 0.9


def clustered(n, size=16, seed=5):
    """Unit vectors in groups of about fifty."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n // 50, size))[rng.integers(0, n // 50, n)] + 0.15 * rng.normal(size=(n, size))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_far_more_lists_than_probes(spark):
    """The lists that a query takes do not grow with the table, and recall holds; an infinite ratio is exact."""
    taken = []
    for n in (3000, 12_000):
        x = clustered(n)
        table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id bigint, embedding array<float>").repartition(4)
        rows = table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
        index = ann.fit(rows, n, 1.0, list_rows=12)
        ratio = ann.tuned_ratio(rows, n, index, 20)
        queries = np.arange(0, n, 30)
        owner, _ = index.probes(x[queries].astype(float), ratio)
        taken.append(len(owner) / len(queries))
        near = x.astype(float)[queries] @ x.astype(float).T
        near[np.arange(len(queries)), queries] = -np.inf
        truth = np.argsort(-near, axis=1, kind="stable")[:, :20]
        got = {}
        for r in ann.search(table, F.col("vec_id") % 30 == 0, list_rows=12).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        recall = np.array([len(got[q] & set(t)) / 20 for q, t in zip(queries.tolist(), truth.tolist(), strict=True)])
        print(f"{n} vectors, {len(index.centroids)} lists, {taken[-1]:.1f} taken, recall {recall.mean():.3f}, worst {recall.min():.2f}")
        assert recall.mean() >= 0.95 and len(index.centroids) > 10 * taken[-1]
    assert taken[1] < 1.5 * taken[0]


def test_infinite_ratio_is_exact(spark):
    x = np.random.default_rng(3).normal(size=(1500, 24)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, ratio=math.inf, list_rows=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {i: [j for j, _ in t] for i, t in brute(rows, lambda i: i % 20 == 0, 20).items()}


def test_ties_lengths_and_repeated_ids(spark):
    """Equal vectors are cut in the block to the least ids; other lengths take no part; an id counts once."""
    same = [1.0, 0.5, 0.25]
    rows = [(k, same) for k in range(1, 400)] + [(7, [3.0, 0.0, 0.0]), (7, [0.1, 0.0, 0.0]), (0, same), (900, [1.0, 2.0]), (920, [1.0, 2.0, 3.0, 4.0])]
    got = search(spark, rows)
    assert got.keys() == {0, *range(20, 400, 20)}
    assert [j for j, _ in got[0]] == [7, *(j for j in range(1, 21) if j != 7)] and got[0][0][1] == 3.0
    block = ann._best(np.array([0]), np.array([same]), np.arange(1, 4097), np.tile(same, (4096, 1)), 20)
    assert block.num_rows == 20 and block.column("vec_id").to_pylist() == list(range(1, 21))


def test_lists_are_balanced():
    rng = np.random.default_rng(2)
    crowd = np.concatenate([rng.normal(size=(200, 8)), 5 + 0.01 * rng.normal(size=(1800, 8))])
    centroids = ann.balanced_centroids(crowd, 32)
    sizes = np.bincount(((crowd[:, None] - centroids[None]) ** 2).sum(2).argmin(1), minlength=len(centroids))
    assert len(centroids) >= 32 and sizes.max() < 8 * len(crowd) / len(centroids)
    assert len(ann.balanced_centroids(np.ones((50, 3)), 8)) == 1


# ---- html ----

PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad banner">Buy!</div>{body}<aside>side</aside><form><label>mail</label></form>
<div id="comments"><p>first!</p></div><div style="display: none">hidden</div><footer>&copy; x &middot; y</footer></body></html>"""


def extract(spark, rows):
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("lines", F.lit("x"))
    return {r.page_id: r for r in html_text.extract(table).collect()}


def test_main_text(spark):
    rows = [
        (1, "http://a.example/en/1", PAGE.format(body="<article><header><h1>Head</h1></header><p>One &amp; two\n three<br>four<p><b>Five</b> <i>six</i></article>")),
        (2, "http://a.example/en/2", PAGE.format(body="<div><p>Seven &lt;8&gt;</p><p>Nine</p></div>")),
        (3, None, None), (4, "", ""), (5, "http://b.example/", "plain text &am &eacute;"), (6, "http://c.example/x", "<p>unclosed <b>bold"),
        (7, "http://a.example/en/1", PAGE.format(body="<main>x</main>")),
    ]
    got = extract(spark, rows)
    assert got[1].text == "Head\n\nOne & two three four\n\nFive six"
    assert got[2].text == "Seven <8>\n\nNine"
    assert [got[k].text for k in (3, 4, 5, 6, 7)] == ["", "", "plain text &am é", "unclosed bold", "x"]
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_shared_lines_go(spark):
    def body(k):
        return "".join(f"<p>{t}</p>" for t in ("Top of every page", f"Own text {k}", f"More {k}", "Bottom of every page"))

    rows = [(k, f"http://h.example/p/{k}", body(k)) for k in range(30)] + [(99, "http://other.example/p/1", body(99))]
    got = extract(spark, [*rows, (200, "http://copy.example/a", body(200)), (201, "http://copy.example/b", body(200))])
    assert all(got[k].text == f"Own text {k}\n\nMore {k}" for k in range(30))
    assert "Top of every page" in got[99].text
    assert got[200].text == got[201].text and "Own text 200" in got[200].text


def test_alignment_decides_on_marked_pages(spark):
    def body(k, own="Long own text of the article, number"):
        return f"<div><p>Site line</p></div><article><p>By our staff</p><p>{own} {k}</p></article><div><p>Second block {k}</p></div>"

    rows = [(k, f"http://h.example/p/{k}", body(k)) for k in range(6)]
    copies = [(k, f"http://copy.example/{k}", body(k, "The same article on both pages").replace(f"pages {k}", "pages")) for k in (10, 11)]
    got = extract(spark, [*rows, *copies, (20, "http://alone.example/", body(20))])
    assert all(got[k].text == f"Long own text of the article, number {k}\n\nSecond block {k}" for k in range(6))
    assert all(got[k].text == f"By our staff\n\nThe same article on both pages\n\nSecond block {k}" for k in (10, 11))
    assert got[20].text == "By our staff\n\nLong own text of the article, number 20"


def test_named_wrappers_keep_their_content():
    def kept(source):
        return html_text.main_lines(html_text.candidates(html_text.lines_of(source)), None)

    for name in ("site has-sidebar", "with-header", "post share-enabled", "no-comments", "sidebar", "content header"):
        assert kept(f"<nav>Home</nav><div class='{name}'><article><p>Text</p><div class='comments'>Reply</div></article></div>") == ["Text"]
        assert kept(f"<nav>Home</nav><div class='{name}'><p>Most of the text</p><div class='ad'>Buy</div></div><p>Rest</p>") == ["Most of the text", "Rest"]
    comments = "<div id='comments'><article><p>A comment longer than the text</p></article></div>"
    assert kept(f"<article><p>Text</p></article>{comments}<div class='ad'>Buy</div>") == ["Text"]
    assert kept("<p>Long text of the page</p><div class='ad'>Buy</div>") == ["Long text of the page"]


def test_neighbours_are_global(spark):
    rng = random.Random(1)
    rows = [(k, f"h{rng.randrange(3)}", f"/{rng.randrange(50)}/{rng.randrange(50)}") for k in range(400)]
    got = {}
    for r in html_text.neighbours(spark.createDataFrame(rows, "uid bigint, host string, path string")).collect():
        got.setdefault(r.uid, []).append(r.partner)
    order = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    for at, (uid, host, _) in enumerate(order):
        near = [order[k] for k in (at - 2, at - 1, at + 1, at + 2) if 0 <= k < len(order)]
        assert sorted(got[uid]) == sorted(r[0] for r in near if r[1] == host)


def plain_extract(rows):
    """Texts by page id, with every page compared by itself: rows (page_id, url, html) with urls that differ."""

    def common(a, b):
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                table[i, j] = table[i + 1, j + 1] + 1 if a[i] == b[j] else max(table[i + 1, j], table[i, j + 1])
        return table

    split = {i: (*u.split("://")[1].partition("/")[::2], [(t, c, w) for t, c, w in html_text.lines_of(h)]) for i, u, h in rows}
    out = {}
    for i, (host, path, lines) in split.items():
        own = sorted((p, j) for j, (h, p, _) in split.items() if h == host)
        at = own.index((path, i))
        others = [[t for t, _, _ in split[own[k][1]][2]] for k in (at - 2, at - 1, at + 1, at + 2) if 0 <= k < len(own)]
        texts = [t for t, _, _ in lines]
        # lines are unlike inside a page here, so the subsequence is a line's own
        counts = [sum(t in other and common(texts, other)[0, 0] > 0 for other in others) for t in texts]
        clean = [(t, c, n) for (t, c, w), n in zip(lines, counts, strict=True) if not w]
        inside = [(t, n) for t, c, n in clean if c]
        copy = 2 * sum(len(t) for t, n in inside if n) > sum(len(t) for t, _ in inside)
        kept = [t for t, c, n in clean if (copy or not (n == len(others) > 1) if c else not n)]
        out[i] = "\n\n".join((kept or [t for t, _, _ in clean]) if others else ([t for t, _ in inside] or [t for t, _, _ in clean]))
    return out


def test_extract_equals_plain_comparison(spark):
    """Menus and adverts that some neighbours lack, sentences that recur inside articles, lone pages and copies."""
    rng = random.Random(8)
    rows = []
    for k in range(120):
        menu = [f"<div>Menu {m}</div>" for m in range(6) if rng.random() < 0.7]
        advert = [f"<div>Advert {m}</div>" for m in range(4) if rng.random() < 0.4]
        closing = [f"<p>Closing {m}</p>" for m in range(2) if rng.random() < 0.5]
        own = [f"<p>Own text {k} line {m}</p>" for m in range(rng.randint(1, 4))]
        inner = ["<p>By our staff</p>", *own, *closing]
        body = f"<article>{''.join(inner)}</article>" if rng.random() < 0.6 else "".join(inner)
        rows.append((k, f"http://h{rng.choice([0, 0, 0, 1, 1, 2, 10 + k])}.example/{rng.randrange(30)}/{k:03}", f"<nav>Home</nav>{''.join(menu)}{body}{''.join(advert)}<footer>end</footer>"))
    rows += [(200 + k, f"http://copies.example/{k}", "<article><p>The same article on all pages</p><p>and more of it</p></article>") for k in range(6)]
    got = {i: r.text for i, r in extract(spark, rows).items()}
    assert got == plain_extract(rows)
    assert any("Closing" in t for t in got.values()) and not any("Menu" in t and "Own" in t and "By our" not in t for i, t in got.items() if i > 500)


def test_a_very_long_path(spark):
    rows = [(k, f"http://h.example/{'x' * 200_000}{k}", f"<p>Site</p><p>Own {k}</p>") for k in range(3)]
    assert {r.text for r in extract(spark, rows).values()} == {f"Own {k}" for k in range(3)}


def test_common_lines():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        got = sorted(html_text.common_lines(a, b))
        assert len(got) == table[-1, -1]
        rest = iter(b)
        assert all(a[k] in rest for k in got)


def test_alignment_halved(monkeypatch):
    """A table of few bits is put together from halves."""
    monkeypatch.setattr(html_text, "TABLE_BITS", 40)
    test_common_lines()


def test_odd_markup_takes_linear_time():
    for part in ('<a href="', "<a ", "<!", "</x>", "<div class=ad>", "<textarea>", "<a \"<b '", "<p>same line"):
        began = time.process_time()
        html_text.lines_of(part * 50_000)
        assert time.process_time() - began < 8, part
    html_text.lines_of("<a " + "x" * 1_000_000 + ">")
    began = time.process_time()
    assert len(html_text.common_lines([1, *[7] * 100_000, 2], [3, *[7] * 99_000, 4])) == 99_000
    assert time.process_time() - began < 8


def test_word_named_blocks_of_an_article_stay():
    for name in ("related-work", "side-effects", "share-price"):
        lines = html_text.lines_of(f"<article><p>Text</p><div class='{name}'><p>More</p></div></article>")
        assert [t for t, _, waste in lines if not waste] == ["Text", "More"]


def test_repeated_rows_and_long_pages(spark):
    long = "<article>" + "".join(f"<p>Line {k} of a long page</p>" for k in range(20_000)) + "</article>"
    rows = [(1, "http://a.example/1", "<article><p>One</p></article>")] * 3 + [(2, "http://a.example/2", long), (None, "http://a.example/3", "<p>No id</p>")]
    table = spark.createDataFrame(rows, "page_id bigint, link string, html string").withColumn("url", F.lit("http://x.example/"))
    got = html_text.extract(table, url="link").collect()
    assert sorted((r.page_id or 0, r.url) for r in got) == sorted((i or 0, u) for i, u, _ in rows)
    assert [r.text for r in got if r.page_id == 1] == ["One"] * 3
    assert [len(r.text.split("\n\n")) for r in got if r.page_id == 2] == [20_000]


# ---- media ----


def test_media_round_trip(spark, odd):
    rows = media.store_and_read(odd.repartition(3)).collect()
    texts = sorted(r.text or "" for r in odd.collect())
    assert sorted(r.payload.rstrip(b"\xff").decode() for r in rows) == texts
    for r in rows:
        assert len(r.payload) % 576 == 0 and len(r.payload) > 0 and r.error is None and media.decode_png(bytes(r.media)) == r.payload
    by_payload = {}
    for r in rows:
        by_payload.setdefault(bytes(r.payload), set()).add((bytes(r.media), r.feature))
    assert all(len(v) == 1 for v in by_payload.values())
    assert media.store_and_read(odd.limit(0)).count() == 0


def test_archives_are_tar_and_ranges_cover_them(spark, odd, tmp_path):
    folder = shared_path(spark, "media-test")
    media.write_archives(odd.repartition(2), folder)
    local = folder.removeprefix("file://")
    import glob

    assert sum(len(tarfile.open(p).getmembers()) for p in glob.glob(f"{local}/*.tar")) == odd.count()
    assert media.read_archives(spark, folder, range_bytes=700).count() == odd.count()


def test_ordinary_archives(spark, tmp_path):
    """Tar files without an index, in three formats; what is no such picture has an error."""
    import io

    good = [media.encode_png(media.payload_of(t)) for t in ("one", "two " * 900, "")]
    for n, form in enumerate((tarfile.GNU_FORMAT, tarfile.PAX_FORMAT, tarfile.USTAR_FORMAT)):
        with tarfile.open(tmp_path / f"a{n}.tar", "w", format=form) as tar:
            for k, data in enumerate([*good, b"no picture"]):
                info = tarfile.TarInfo(f"{'long/' * (30 if n < 2 else 1)}é{k}.png")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    for size in (700, 1 << 20):
        rows = media.read_archives(spark, str(tmp_path), range_bytes=size).collect()
        assert len(rows) == 12 and all(r.doc_id is None for r in rows)
        assert sorted(bytes(r.media) for r in rows if r.error is None) == sorted(good * 3)
        assert [r.media for r in rows if r.error] == [None] * 3


def test_connection_is_opened_anew():
    class Flaky:
        opened = 0

        def open_input_file(self, path):
            Flaky.opened += 1
            return self

        def read_at(self, n, at):
            if Flaky.opened < 3:
                raise OSError("connection lost")
            return b"x" * n

    handle = media._Handle(Flaky(), "a.tar")
    for _ in range(2):
        with pytest.raises(OSError):
            handle.read_at(0, 4)
    assert handle.read_at(0, 4) == b"xxxx" == handle.read_at(9, 4) and Flaky.opened == 3


def test_members_are_retried_one_by_one():
    good = media.encode_png(media.payload_of("text"))
    entry = {"data": 3, "size": len(good), "crc": zlib.crc32(good), "known": 3}
    calls = []

    def flaky(at, n):
        calls.append((at, n))
        if len(calls) < 3:
            raise OSError("gone")
        return good

    assert media.read_member(flaky, entry, pause=0)[0] == good and calls == [(3, len(good))] * 3
    bad = media.read_member(lambda at, n: good[:-1] + b"x", entry, pause=0)
    assert bad[:2] == (None, None) and "differ" in bad[2]
    with pytest.raises(ValueError):
        media.decode_png(good[:40])


def test_media_query(spark, sf):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op7_media(spark, sf).collect():
        assert r.n_bytes == len(docs[r.doc_id]) and r.tail_crc32 == zlib.crc32(media.payload_of(docs[r.doc_id].decode())[-32:])
