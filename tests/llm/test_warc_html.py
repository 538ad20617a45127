import hashlib
import html as H
import re

import pytest
import zstandard

from costlake.llm import html_mss, warc
from costlake.session import scratch_path
from tests.conftest import SF_SMALL

PAGE = "page_id long, url string, html string"


def plan(rows):
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        same = [q for q, _, g in rows if q is not None and (g or "").encode() == b]
        top = max(same) if same and len(b) >= 1000 else None
        other = top is not None and p != top
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if other else "response", top if other else None))
    return sorted(out, key=str)


def test_round_trip_with_revisits(spark):
    big, huge = "é<p>" * 400, "z" * 300_000
    rows = [(1, "http://a/ü b", big), (2, "http://b/\r\nX: 1", big), (3, None, big), (4, "u", None), (5, "u", ""),
            (6, "u", "small"), (7, "u", "small"), (None, "u", big), (9, "u", huge), (8, "u", huge), (9, "u", huge)]
    df = spark.createDataFrame([(*r, "x") for r in rows], PAGE + ", payload string")
    folder = scratch_path(spark, "warc")
    manifest = warc.write_warc(df, folder, archive_bytes=4000)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = warc.read_warc(spark, folder).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in got], key=str) == plan(rows)
    assert sorted((str(r["page_id"]), str(r["url"])) for r in got) == sorted((str(p), str(u)) for p, u, _ in rows)
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in got if r["payload"] is not None}[9] == huge
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_do_not_depend_on_the_order_of_rows(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7} " + "word " * 300) for i in range(60)] + [(None, "u", "x"), (5, None, "x")]
    told = []
    for given in (rows, rows[::-1]):
        folder = scratch_path(spark, "warc")
        warc.write_warc(spark.createDataFrame(given, PAGE).coalesce(1), folder, archive_bytes=4000)
        files = spark.read.format("binaryFile").load(folder).collect()
        told.append(sorted((f["path"].rsplit("/", 1)[1], bytes(f["content"])) for f in files))
    assert len(told[0]) > 2 and told[0] == told[1]


def test_archive_layout():
    records = [warc.record(i, f"http://h/{i}", b"<html>" + bytes(str(i), "ascii") * 50, 60, "00" * 20, None) for i in range(500)]
    data = warc.pack(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    size = int.from_bytes(data[4:8], "little")
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    # the second frame stands alone: one record each
    first = d.decompressobj().decompress(data[8 + size:])
    assert first == records[0]
    assert [int(h["WARC-Record-ID"][10:-1]) for h, _ in warc.unpack(data)] == list(range(500))
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompressobj().decompress(data[8 + size:])


def test_article_of_every_page(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    out = {r["page_id"]: r for r in html_mss.main_text(pages).collect()}
    for r in pages.collect():
        a = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        a = re.sub(r"</?(p|h1|br|b)>", lambda m: "" if m[1] == "b" else " ", a)
        want = " ".join(H.unescape(a).split())
        assert out[r["page_id"]]["text"] == want and out[r["page_id"]]["n_chars"] == len(want)


BODY = "<p>One two three four five six seven.</p><p>Eight <b>ni</b>ne &amp; ten&nbsp;eleven</p>"
TEXT = "One two three four five six seven. Eight nine & ten eleven"


@pytest.mark.parametrize("page", [
    f"<html><body><nav><a href=x>a b c d e f g h i j k l</a></nav><div id='main-text'>{BODY}</div></body></html>",
    f"<article><header></header>{BODY}<aside>buy this thing now please</aside></article><div>short tail here</div>",
    f"<main>{BODY}<section class='comments'><p>{'I agree with all of it ' * 20}</p></section></main>",
    f"<div class='cookie-notice'>We use cookies {'a b c ' * 30}</div><article>{BODY}</article>",
    f"<article>{BODY}<script>var a = '</p> words words words';</script><form><p>Name it</p></form></article>",
    f"<header><p>Site name and a slogan of words</p></header><article>{BODY}<!-- a > b --></article><footer>x y z",
    f"<aside>never closed words words<article>{BODY}</article>",
])
def test_boilerplate_goes(page):
    assert html_mss.extract(page, html_mss.DEFAULT_WEIGHTS) == TEXT


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "a < b <> \"c"), (4, "u", "a < b <> \"c"),
            (None, "u", "<p>" + "word " * 30000), (5, "u", "<a href=\"x>text</a>")]
    df = spark.createDataFrame([(*r, 9) for r in rows], PAGE + ", text int")
    out = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_mss.main_text(df).collect())
    assert out[0][1] == "" and out[1][1] == "" and out[2][1] == "" and out[3] == out[4] and out[3][1] == "a < b <> \"c"
    assert out[-1][2] == 5 * 30000 - 1
    assert html_mss.main_text(df.limit(0)).count() == 0


def test_tags_that_the_sample_has_only_outside_end_no_region():
    words = "one two three four five six seven eight nine ten eleven twelve"
    tables = "<table>" + f"<tr><td>{'x ' * 3}</td></tr>" * 150 + "</table>"
    sample = [f"<body><div><article><h1>Title</h1><p>{words} {i}</p></article></div>{tables if i == 3 else ''}</body>"
              for i in range(60)]
    got = sum((html_mss.count_labelled(p) for p in sample), html_mss.Counter())
    w = html_mss.weights_from(got)
    assert got["td", False] == 1 and got["div", False] == 60
    assert {k for k, v in w.items() if v < -6} == html_mss.ENDS
    page = (f"<body><div><article><h1>Head line</h1><div><p>{words}</p></div><table><tr><td>cell a</td><td>cell b</td></tr>"
            f"</table><div><p>{words} end</p></div></article></div></body>")
    assert html_mss.extract(page, w) == f"Head line {words} cell a cell b {words} end"
    page = f"<body><main><h1>Head line</h1><p>{words}</p><table><tr><td>cell a</td></tr></table><p>{words} end</p></main></body>"
    assert html_mss.extract(page, w) == f"Head line {words} cell a {words} end"


@pytest.mark.parametrize("page", [
    f"<article><h2 id='related-work'>Head of this text</h2>{BODY}</article>",
    f"<article><h2 class='header'>Head of this text</h2>{BODY}</article>",
    f"<article><section id='search-strategy'><h2>Head of this text</h2>{BODY}</section></article>",
    f"<article><div id='social-effects' class='response-rates'><p class=notice>Head of this text</p>{BODY}</div></article>",
    f"<main><div class='header'><h1>Head of this text</h1></div><div data-id=search title='a class=ad'>{BODY}</div></main>",
    f"<article class='post category-social-media' id='search-strategy'><p>Head of this text</p>{BODY}</article>",
    f"<body><section id='response-rates'><h2 id='related-work'>Head of this text</h2>{BODY}</section></body>",
    f"<body><div data-id='search' data-class=ad><h2>Head of this text</h2>{BODY}</div></body>",
    f"<article><h2>Head of this text</h2>{BODY}<div id='comments'><p>{'I agree ' * 20}</p></div></article>",
    f"<article><h2>Head of this text</h2>{BODY}<div class='box related'>More</div><div role=search>Find</div></article>",
    f"<article><h2>Head of this text</h2>{BODY}</article><div id='comments'><article class='comment-body'>{'I agree ' * 50}</article></div>",
])
def test_words_that_only_contain_a_hint_stay(page):
    assert html_mss.extract(page, html_mss.DEFAULT_WEIGHTS) == "Head of this text " + TEXT


@pytest.mark.parametrize("page,want", [
    ("<article><p>Alpha beta.</p><svg class=i/><p>One two</p></article>", "Alpha beta. One two"),
    ("<article><p>Alpha <svg><text>x</text></svg>beta.</p><math/><p>One two</p></article>", "Alpha beta. One two"),
    ("<article><ul><li class=share>Share this<li>A real item</ul><p>More text</p></article>", "A real item More text"),
    ("<article><dl><dt class=ad>Buy<dd class=ad>now<dt>Term<dd>Its meaning</dl></article>", "Term Its meaning"),
    ("<article><table><tr><td>one<td>two<tr><td>three</table><p>after</p></article>", "one two three after"),
    ("<body><p class=notice>note<p>Real text</body>", "Real text"),
    ("<div class='layout has-sidebar'><p>The text of a page</p><div class=sidebar>links here</div></div>", "The text of a page"),
    ("<div class=widget><p>A page of words in one widget</p><div class=share>share it</div></div>", "A page of words in one widget"),
    ("<article><p>Before</p><blockquote><article>quoted words</article></blockquote><p>After</p></article>", "Before quoted words After"),
    ("<main><h1>Head line</h1><article><p>Its text is here</p></article></main>", "Head line Its text is here"),
    ("<article><p title=O'Neil>para one</p><p>it's two</p></article>", "para one it's two"),
    ("<article><p data-x='a>b\" c' title=\"d'>e\">text</p></article>", "text"),
    ("<div><article><p>One two three four</p></div><p>Tail</p>", "One two three four"),
    ("<div class='site-footer'>About us</div><p>Text of a page with no article</p>", "Text of a page with no article"),
    ("<p>one two</p><article>a b</article><article>c d</article>", "one two"),
    ("<article>a b</article><article>c d</article>", "a b"),
])
def test_text_of_ordinary_html_stays(page, want):
    assert html_mss.extract(page, html_mss.DEFAULT_WEIGHTS) == want


@pytest.mark.parametrize("part,times", [
    ("<a '", 500_000), ("<a b='", 300_000), ("<div>", 200_000), ("<ul><li>", 100_000), ("<head>", 200_000), ("<p><td><div>", 100_000),
    ("<", 2_000_000), ("<!--", 500_000), ("<svg>", 200_000), ("</b ", 500_000), ("<script>", 200_000), ("<a =", 300_000)])
def test_hostile_pages_take_linear_time(part, times):
    import time
    took = []
    for n in (times // 8, times):
        t = time.process_time()
        html_mss.extract(part * n, html_mss.DEFAULT_WEIGHTS)
        took.append(time.process_time() - t)
    assert took[1] < 0.3 + 16 * took[0]         # eight times the page, not sixty-four times the time


def test_the_sample_is_named_by_hashes(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("html")
    few = html_mss.fit_weights(pages.unionByName(pages).repartition(7), max_labelled=10)
    assert few == html_mss.fit_weights(pages.coalesce(1), max_labelled=10)
    assert html_mss.fit_weights(pages.limit(0)) == html_mss.DEFAULT_WEIGHTS


def test_urls_come_back_as_they_were(spark):
    urls = ["http://x/a%20b?q=%2Fz", "http://x/a b", "http://x/\u00e9", "x\r\nWARC-Type: y", "", " lead ", None, "http://x/%"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], PAGE)
    assert {r["page_id"]: r["url"] for r in warc.round_trip(pages).collect()} == dict(enumerate(urls))
