import re
import time
from html import unescape

from cases import SF001
from feedlens.llm import html_extract as hx
from feedlens.llm import queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>x</article>";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, a great many of them, for every purpose you can think of and more.</div>
<div class="ad">Buy now! Buy now! Buy now! Buy now! Buy now! Buy now! Buy now!</div>
<div class="%s"><h1>A &amp; B</h1><p>First  paragraph,
 with <b>bold</b> and <a href="#">a link</a>.<p>Second &eacute;t&eacute; &#8212; one.<br>More.
<!-- hidden > comment --><form><label>Name</label><input name=q><button>Send</button></form>
<ul><li>one</li><li>two</li></ul><aside>See also</aside><pre>x  =
 1</pre></div>
<div id="comments"><p>I have read this and I do not agree with a word of it, not at all, and I say so here at length.</p></div>
<footer>&copy; Site</footer></body></html>"""
TEXT = "A & B\n\nFirst paragraph, with bold and a link.\n\nSecond été — one. More.\n\none\n\ntwo\n\nx = 1"


def test_one_page():
    assert hx.extract(PAGE % "post-12") == TEXT
    assert hx.vote(PAGE % "post-12")[0] == "/html/body.has-sidebar/div.post-#"


def test_broken_markup():
    assert hx.extract("<p>open <b>bold<p>next < 3 and <") == "open bold\n\nnext < 3 and <"
    assert hx.extract("<div><p>a</div></span></div><p>b") in ("a", "b", "a\n\nb")
    assert hx.extract("<article><p>kept</p><script>never closed <p>x") == "kept"
    assert hx.extract("plain text &lt;only&gt;") == "plain text <only>"
    for empty in (None, "", "   ", "<html></html>", "<nav>menu</nav>", "<!-- x -->", "<"):
        assert hx.extract(empty) in ("", "<")


def test_reader_comments_inside_the_article():
    page = "<article><h1>T</h1><p>Body text.</p><section class='comments'><p>Long reply " + "no " * 300 + "</p></section></article>"
    assert hx.extract(page) == "T\n\nBody text."


def test_article_header_keeps_its_headline():
    page = "<article><header><h1>Title</h1><span>by someone</span></header><p>Body text.</p></article>"
    assert hx.extract(page) == "Title\n\nBody text."


def test_host_paths_outvote_a_single_page(spark):
    """On one page of the host a teaser is longer than the text; the host's path still finds the text."""
    def page(n, body, teaser):
        return (n, f"https://h.example/{n}", f"<body><div class='c t{n}'><p>{body}</p></div><div class='x'><p>{teaser}</p></div></body>")

    rows = [page(n, "the story " * 30, "short") for n in range(5)] + [page(5, "brief", "a long teaser " * 40)]
    rows += [(6, "https://other.example/", "<body><div class='x'><p>another layout altogether</p></div></body>"),
             (7, None, "<p>no url</p>"), (8, "not a url", None), (None, "https://h.example/9", ""), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, text string, host int")
    got = hx.main_text(pages).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[5].text == "brief" and by_id[0].text == ("the story " * 30).strip()
    assert by_id[6].text == "another layout altogether" and by_id[7].text == "no url"
    assert by_id[8].text == by_id[None].text == "" and all(r.n_chars == len(r.text) for r in got)
    assert hx.main_text(pages.where("false")).count() == 0
    # more hosts than are broadcast: the same by host and salt
    assert sorted(map(str, hx.main_text(pages, broadcast_hosts=1).collect())) == sorted(map(str, got))


def test_formulas_drawings_and_fallback_text():
    assert hx.extract("<article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>") == "where x=2 holds"
    assert hx.extract("<p>a <math><semantics><mrow><mi>x</mi></mrow><annotation encoding='application/x-tex'>{x}</annotation>"
                      "</semantics></math> b</p>") == "a x b"
    assert hx.extract("<p><math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr></mtable></math></p>") == "1 2"
    svg = "<svg><title>icon</title><style>a{}</style><path d='M0 0'/><text x='1'>left</text><text>right</text></svg>"
    assert hx.extract(f"<article><p>See {svg}.</p></article>") == "See left right ."
    for tag in ("object", "canvas", "video", "audio"):
        assert hx.extract(f"<article><p>Sales: <{tag} id='f'><param name='a'>rose by 4%</{tag}> a year</p></article>") == "Sales: rose by 4% a year"
    assert hx.extract(f"<body><nav>{svg}</nav><p>text</p></body>") == "text"


def test_text_split_over_containers():
    """Without an article element: the larger part must not stand for the whole."""
    a, b = "first part " * 70, "second part " * 25
    both = f"{a.strip()}\n\n{b.strip()}"
    for tag in ("div class='part p1'", "section", "td"):
        row = ("<table><tr>%s</tr></table>" if tag == "td" else "%s") % f"<{tag}>{a}</{tag.split()[0]}><{tag}>{b}</{tag.split()[0]}>"
        page = f"<body><div class='content'><h2>Title</h2>{row}<p>End.</p></div><div class='x'>teaser</div></body>"
        assert hx.extract(page) == f"Title\n\n{both}\n\nEnd."
        assert hx.vote(page)[0] == "/body/div.content"
        # equal parts
        assert hx.extract(page.replace(b, a)) == f"Title\n\n{a.strip()}\n\n{a.strip()}\n\nEnd."
    assert hx.extract("<div>a</div><div>b</div>") == "a\n\nb"
    # parts in rows, two levels up
    rows = f"<div class=row><div class=part>{a}</div><div class=part>{b}</div></div>" * 2
    assert hx.extract(f"<body><div class=content>{rows}</div></body>") == f"{both}\n\n{both}"


def test_all_containers_on_the_path():
    articles = "<main><article><p>one of two</p></article><p>mid</p><article><header><h1>T</h1><i>by x</i></header>the longer one, two of two</article></main>"
    assert hx.extract(articles) == "one of two\n\nmid\n\nT\n\nthe longer one, two of two"
    assert hx.extract(articles, "/main/article") == "one of two\n\nT\n\nthe longer one, two of two"
    page = "<body><div class='c'><div class='part'>one, the longest</div><div class='x'>no</div><div class='part'>two</div></div></body>"
    assert hx.extract(page, "/body/div.c/div.part") == "one, the longest\n\ntwo"
    links = "<body><div class='part'><a>menu</a></div><div class='c'>text</div></body>"
    assert hx.extract(links, "/body/div.part") == "text"


def test_split_pages_of_a_host(spark):
    """Pages with one part outvote those with several, whose other parts still stay."""
    def page(n, *parts):
        inner = "".join(f"<section class='part'>{p}</section>" for p in parts)
        return (n, f"https://h.example/{n}", f"<body><div class='content'>{inner}</div></body>")

    rows = [page(n, "a story " * 40) for n in range(4)] + [page(4, "b " * 300, "c " * 100, "b " * 300), page(5, "d " * 9, "e " * 9)]
    got = {r.page_id: r.text for r in hx.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == ("a story " * 40).strip()
    assert got[4] == "\n\n".join(("b " * 300, "c " * 100, "b " * 300)).replace(" \n", "\n").strip()
    assert got[5] == "\n\n".join((("d " * 9).strip(), ("e " * 9).strip()))


def _plain(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = (" ".join(unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split())
              for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = queries.QUERIES["op5_consensus_extraction"](spark, SF001).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == _plain(pages[r.page_id]) and r.n_chars == len(r.text)


def test_names_made_from_titles_stay():
    """Ids of headings and words of other names are no boilerplate; the article stays whole."""
    words = "some words of the text " * 6
    for part in ("<h2 id='related-work'>{}</h2>", "<h2 id='search'>{}</h2>", "<section id='social-history'><p>{}</p></section>",
                 "<div class='share-of-votes'><p>{}</p></div>", "<table id='form'><tr><td>{}</td></tr></table>",
                 "<h3 id='cookies' class='title'>{}</h3>", "<p id='notice'>{}</p>", "<section id='comments-on-the-law'><p>{}</p></section>",
                 "<div class='header-compression'><p>{}</p></div>", "<ul class='menu-of-the-day'><li>{}</li></ul>"):
        inner = f"<p>{words}</p>{part.format('This part')}<p>{words}</p>"
        want = f"{words.strip()}\n\nThis part\n\n{words.strip()}"
        for page in (f"<article>{inner}</article>", f"<main>{inner}</main>", f"<body><div class='content'>{inner}</div></body>",
                     f"<body><nav>menu</nav>{inner}<footer>end</footer></body>"):
            assert hx.extract(page) == want, (part, page)


def test_names_of_boilerplate_go():
    words = "some words of the text " * 6
    for name in ("ad", "ad-slot-12", "AdBox", "sidebar", "right_sidebar", "share-buttons", "related-posts", "comments-list", "newsletter",
                 "cookie-banner", "social links", "comment", "widget_search", "main-nav"):
        for where in ("<article>{}{}</article>", "<body><div class='content'>{}{}</div></body>"):
            assert hx.extract(where.format(f"<p>{words}</p>", f"<div class='{name}'><p>buy, share, reply</p></div>")) == words.strip(), name
            assert hx.extract(where.format(f"<p>{words}</p>", f"<div id='{name}'><p>buy, share, reply</p></div>")) == words.strip(), name
    # other words beside a boilerplate one: outside an article the links decide
    links = "<div class='menu-of-the-site'><a href=/>one</a> <a href=/>two</a> or</div>"
    assert hx.extract(f"<body><div class='content'><p>{words}</p>{links}</div></body>") == words.strip()
    assert hx.extract(f"<body><div class='content'><p>{words}</p>{links.replace('<a href=/>', '').replace('</a>', '')}</div></body>") \
        == f"{words.strip()}\n\none two or"


def test_a_dominant_section_does_not_stand_for_the_article():
    def lines(n, what):
        return "".join(f"<p>{what} line {i}.</p>" for i in range(n))

    for shape in ("<section class='{}'>", "<div class='{}'>", "<section id='{}'>"):
        for sizes in ((5, 40, 8), (5, 4, 8), (0, 40, 0), (30, 1, 1)):
            parts = "".join(f"{shape.format(k)}{lines(n, k)}</{shape[1:].split()[0]}>" for k, n in zip(("intro", "method", "result"), sizes))
            page = f"<body><nav>menu</nav><div class=content><p>The lead.</p>{parts}</div><div class='x'>teaser</div></body>"
            want = ["The lead.", *(f"{k} line {i}." for k, n in zip(("intro", "method", "result"), sizes) for i in range(n))]
            assert hx.extract(page) == "\n\n".join(want)
            assert hx.vote(page)[0] == "/body/div.content"
    assert hx.extract(f"<main><h1>Title</h1><article>{lines(9, 'text')}</article></main>").startswith("Title\n\ntext line 0.")
    beside = f"<body><div class=a>before<div class=b>{lines(9, 'text')}</div>after</div><div class=x>teaser</div></body>"
    got = hx.extract(beside)
    assert got.startswith("before\n\ntext line 0.") and got.endswith("text line 8.\n\nafter")
    sections = f"<body><div><section>{lines(2, 'a')}</section><section class=t>{lines(30, 'b')}</section></div><div class=x>teaser</div></body>"
    assert hx.extract(sections).startswith("a line 0.") and "teaser" not in hx.extract(sections)


def test_a_host_without_articles(spark):
    """Page text in plain boxes, each page with parts of other lengths: all of it comes back."""
    rows, want = [], {}
    for n in range(24):
        parts = [f"Part {k} of page {n} says this. " * (1 + (n * 7 + k * 5) % 11) for k in range(3)]
        inner = "".join(f"<div class='{c}'><h2 id='{c}'>{c}</h2><p>{t}</p></div>" for c, t in zip(("intro", "related-work", "end"), parts))
        rows.append((n, f"https://h.example/{n}", f"<body><div class='menu'><a href=/>Home</a></div><div id='page'><h1>Title {n}</h1>{inner}</div>"
                                                  f"<div class='footer'>About us</div></body>"))
        want[n] = "\n\n".join([f"Title {n}", *(x for c, t in zip(("intro", "related-work", "end"), parts) for x in (c, t.strip()))])
    got = hx.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_deep_and_broken_markup_in_time():
    began = time.perf_counter()
    assert hx.extract("<body>" + "<font color=red>a " * 50_000 + "<p>end") == ("a " * 50_000).strip() + "\n\nend"
    assert hx.extract("<div>" * 50_000 + "text") == "text"
    assert hx.extract("<font><p>x</span></b></i>" * 20_000).count("x") == 20_000
    assert hx.extract("<div class='ad-thing'>" * 20_000 + "text" + "</div>" * 20_000) == "text"
    assert hx.extract("<ul>" + "<li><b>x" * 30_000).count("x") == 30_000
    assert time.perf_counter() - began < 20


def test_long_page():
    body = "".join(f"<p>Paragraph number {i}.</p>" for i in range(20000))
    assert hx.extract(f"<main>{body}</main>").count("\n\n") == 19999
