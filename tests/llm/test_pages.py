import random

import pytest
import zstandard
from pyspark.sql import functions as F

from pitstop.llm import html_text, warc

PAGES = "page_id long, url string, html string"

ARTICLE = """<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{}</style><script>var a = "</p><p>no";</script></head>
<body class="page-12"><header><h2>Site name</h2></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- no <p>no</p> -->
<div class="cookie-notice">We use no cookies</div><aside><p>Sidebar no text here that is quite long indeed</p></aside>
<div id="main-7"><article class="post-7"><h1>Caf&eacute; &lt;b&gt; &amp;amp; more</h1>
<p>First <b>bold   text</b>,<br>next&nbsp;line<p>Second &#233; &#x4e2d; a<a href="#">link</a>s
<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table><div class="ad banner">Buy no things</div>
<form><p>Your no mail</p><input name=q></form><p style="display: none">no</p><p>Last &copy 3 < 4</p></article>
<div class="comments"><article><p>A reader's no comment that is longer than all of the article's own text, to make sure that it
is not taken for the article by its length alone, no.</p></article></div></div>
<footer>&copy; no</footer></body></html>"""
TEXT = "Café <b> &amp; more\nFirst bold text, next line\nSecond é 中 alinks\none\ntwo\nc1\nc2\nLast © 3 < 4"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "cast(null as string) as host", "cast(1 as int) as path",
                                                         "page_id as digest", "url as text", "url as row").repartition(3)


def test_article_text(spark):
    rows = [(i, f"http://h.example/{i}", ARTICLE) for i in range(3)]
    # A page on which the article is short follows its host; a page of another host, a cut and an odd one stand alone.
    short = ARTICLE[:ARTICLE.index("<p>First")] + "</article><div><p>" + "an unrelated block without a name " * 9 + "</p></div></body>"
    rows += [(3, "http://h.example/3", short), (4, None, ARTICLE[:ARTICLE.index("<div class=\"comments")]), (5, "::", None), (6, "http://x/", ""),
             (7, "http://x/", "plain text &amp; no tags"), (7, "http://x/", "<p>a<p>b <i>c"), (None, "http://x/", "<div><p>x</div>" * 3),
             (8, "http://y/", "<nav>only a menu</nav>"), (9, "http://z/", "<p>" + "long text " * 50_000), (10, "http://q/", "<a href='x>y\">broken")]
    got = {}
    for r in html_text.extract(pages(spark, rows)).collect():
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) and all(r.n_chars == len(r.text) for x in got.values() for r in x)
    for i in (0, 1, 2, 4):
        assert got[i][0].text == TEXT
    assert got[3][0].text == TEXT.split("\n")[0] and got[3][0].path.endswith("article.post")
    assert got[5][0].text == got[6][0].text == got[8][0].text == ""
    assert sorted(r.text for r in got[7]) == ["a\nb c", "plain text & no tags"]
    assert got[None][0].text == "x\nx\nx" and got[9][0].text == ("long text " * 50_000).strip()
    assert html_text.extract(pages(spark, [])).collect() == []


def test_nothing_around_an_inner_container_is_lost(spark):
    inner = "<h1>Title</h1><p>A lead.</p><div class='content'><p>" + "The text of it. " * 20 + "</p></div>"
    links = "<div class='top'><a href='/'>Home page</a> <a href='/b'>Other page</a></div>"
    rows = [(k, f"http://h{k}/", f"<html><body>{links}{start}{inner}{end}</body></html>") for k, (start, end) in enumerate(
        (("<article>", "</article>"), ("<main><div>", "</div></main>"), ("<div class='page'>", "</div>"), ("<div><section>", "</section></div>")))]
    want = "Title\nA lead.\n" + ("The text of it. " * 20).strip()
    assert [r.text for r in html_text.extract(pages(spark, rows)).orderBy("page_id").collect()] == [want] * 4


def test_names_do_not_drop_the_text_itself(spark):
    inner, ad = "<h1>Title</h1><p>" + "The text of it. " * 20 + "</p>", "<div class='sidebar'><p>Buy things.</p></div>"
    bodies = [f"<body class='no-sidebar'>{inner}{ad}</body>", f"<body><div class='main has-sidebar'>{inner}{ad}</div></body>",
              f"<body><article id='post-promo'>{inner}{ad}</article></body>", f"<html class='cookie'><body><main role='search'>{inner}</main></body></html>",
              f"<body><div class='has-sidebar'><article>{inner}</article><div class='comments'><p>{'Me too. ' * 200}</p></div></div></body>",
              f"<table><tr><td class='main has-sidebar'>{inner}</td><td class='sidebar'>Buy things.</td></tr></table>",
              f"<body><article hidden>{ad * 9}<p>No.</p></article><div>{inner}</div></body>"]
    rows = [(k, f"http://h{k}/", body) for k, body in enumerate(bodies)]
    want = "Title\n" + ("The text of it. " * 20).strip()
    assert [r.text for r in html_text.extract(pages(spark, rows)).orderBy("page_id").collect()] == [want] * len(rows)


KEPT = ["<section id='discussion'><p>{}</p></section>", "<h2 id='search-algorithms'>{}</h2>", "<p class='dialog'>{}</p>",
        "<div class='social-history'>{}</div>", "<p>a <span class='related-term'>{}</span></p>", "<p>x <math><mi>{}</mi></math></p>",
        "<p><label>{}</label> y</p>", "<!--><p>{}</p><!-- -->", "<!---><p>{}</p><!-- -->", "<section class='comments'><p>{}</p></section>"]


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", "<div class='page'><article>%s</article></div>"])
def test_content_keeps_its_odd_names(around):
    for k, form in enumerate(KEPT):
        sentences = [f"<p>Sentence {j} of the text.</p>" for j in range(12)]
        html = "<body><nav><p>menu</p></nav>" + around % "".join([*sentences[:6], form.format("KEPT WORDS"), *sentences[6:]]) + "</body>"
        page = html_text.Page(html)
        text = page.text(page.best()[0])
        assert "KEPT WORDS" in text and text.count("Sentence") == 12 and "menu" not in text, (k, text)


def test_what_is_beside_a_short_article_stays():
    for share in (5, 35, 80):
        article, rest = "word " * share, "other " * (100 - share)
        page = html_text.Page(f"<body><article><p>{article}</p></article><div class='content'><p>{rest}</p></div></body>")
        assert page.text(page.best()[0]) == article.strip() + "\n" + rest.strip()


def test_whole_names_drop_what_is_not_the_article():
    own = "<h1>T</h1><p>" + "The text. " * 9 + "</p>"
    for junk in ("<div class='ad'>no</div>", "<div class='ads-box'>no</div>", "<div id='sidebar'><p>no</p></div>", "<div role='search'>no</div>",
                 "<p class='advertisement'>no</p>", "<div class='cookieBanner x'>no</div>", "<ul class='share-list'><li>no</ul>",
                 "<div class='comments'><section><p>no</p></section></div>", "<footer>no</footer>", "<form><label>no</label></form>"):
        page = html_text.Page(f"<body><article>{own}{junk}</article></body>")
        assert page.text(page.best()[0]) == "T\n" + ("The text. " * 9).strip(), junk


def test_deep_and_broad_pages_take_linear_time():
    import time
    deep = "<div class='a'>" * 100_000 + "<p>text</p>" + "</div>" * 100_000
    broad = "".join(f"<article class='promo-{k}'><p>text {k}</p></article></i></ul>" for k in range(30_000))
    mixed = ("<div><p>x" + "</b></span></section>" * 3) * 30_000
    for html in (deep, broad, mixed, "<p>" * 200_000, "<a title='>" * 50_000, "<" * 200_000, "&amp" * 100_000):
        start = time.process_time()
        page = html_text.Page(html)
        best = page.best()
        assert best is None or page.text(best[0])
        assert time.process_time() - start < 20


def test_a_heavy_host_and_light_ones_follow_their_own_votes(spark, monkeypatch):
    monkeypatch.setattr(html_text, "HEAVY", 4)
    odd = "<body><section><p>own {0}</p></section><div><p>junk {0}</p></div></body>"
    even = "<body><section><p>own {0}</p></section></body>"
    rows = [(k, f"http://{host}/{k}", (odd if k % 5 == 0 else even).format(k))
            for k, host in enumerate(["big"] * 30 + ["a", "b", "c"] * 4)]
    got = {r.page_id: r.text for r in html_text.extract(pages(spark, rows)).collect()}
    assert got == {k: f"own {k}" for k, *_ in rows}


def test_votes_decide_by_count(spark):
    rows = [("h", "<main><p>text of some length</p></main>")] * 3 + [("h", "<section><p>" + "more " * 99 + "</p></section>")]
    got = html_text.host_paths(spark.createDataFrame(rows, "host string, html string")).collect()
    assert [(r.host, r.path) for r in got] == [("h", "#>main")]


def web(rng):
    body = "".join(rng.choice("abcdefgh \n<>é") for _ in range(400))
    rows = [(i, f"http://h/{i}\r\nX: y", body if i in (3, 5, 9) else "".join(rng.choice("abc <>") for _ in range(rng.randint(0, 900)))) for i in range(40)]
    return rows + [(41, None, None), (42, "u", ""), (43, "u", "short"), (44, "u", "short"), (None, "u", body), (None, None, None),
                   (45, "u", "é" * 300_000), (45, "u", "é" * 300_000)]


@pytest.mark.parametrize("size", [warc.ARCHIVE_BYTES, 2_000])
def test_round_trip(spark, size):
    import hashlib
    rows = web(random.Random(1))
    got = warc.round_trip(pages(spark, rows), archive_bytes=size).collect()
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == body and j is not None]
        first = min(same) if len(body) >= 100 and same else i
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) == sorted(map(str, want))
    assert warc.round_trip(pages(spark, [])).collect() == []


def test_archives_are_as_the_format_says(spark, tmp_path):
    folder = str(tmp_path / "w")
    manifest = warc.write_archives(pages(spark, web(random.Random(2))), folder).agg(F.sum("records")).first()[0]
    files = sorted((tmp_path / "w").glob("*.warc.zst"))
    assert manifest == 48 and files and len(files) == len(list((tmp_path / "w").iterdir())) - len(list((tmp_path / "w").glob(".*")))
    n = 0
    for f in files:
        content = f.read_bytes()
        assert content[:4] == (0x184D2A5D).to_bytes(4, "little")
        size = int.from_bytes(content[4:8], "little")
        one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8:8 + size])).decompressobj()
        assert one.decompress(content[8 + size:]).endswith(b"\r\n\r\n")          # the first record alone is a frame
        n += len(list(warc.read_archive(content)))
    assert n == 48


def test_dictionary_helps():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    records = [warc.record(i, f"http://h/{i}", " ".join(rng.choices(words, k=60)).encode(), "0" * 64, None) for i in range(400)]
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(warc.archive(records)) < 0.9 * alone
    assert [b for _, b in warc.read_archive(warc.archive(records))] == [r.split(b"\r\n\r\n", 1)[1][:-4] for r in records]
