import re

from ledgerlink.llm import main_text as M

PROSE = "This is the story of a town that was built by the river, and of the people who came to live in it for a while."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style></head><body>{body}</body></html>"


def test_article_without_its_surroundings():
    p = page(f"""<header><h1>Site of the day</h1></header><nav><ul><li><a href="/a">{PROSE}</a></li></ul></nav>
      <div class="cookie-notice">We use cookies and it is the law that you are told of it in a notice like this one here.</div>
      <article><h1>Title &amp; more</h1><p>{PROSE}<p>Short.<p>A&nbsp;b\n  c &lt;d&gt;</p><div class="ad">{PROSE}</div>
      <form><label>Name</label></form><script>var t = "</p>";</script><p>{PROSE}</article>
      <section id="comments"><p>{PROSE}</p></section><aside>{PROSE}</aside><footer>&copy; {PROSE}</footer>""")
    assert M.main_text(p).split("\n\n") == ["Title & more", PROSE, "Short.", "A b c <d>", PROSE]


def test_without_an_article_element_rules_decide():
    p = page(f"""<div><a href="/x">Home page of the site</a> <a href="/y">About the people in it</a></div><h2>Title</h2><p>{PROSE}</p>
      <p>Near.</p><p>{PROSE}</p><div><a href="/z">Read more of the same kind here, it is good for you and for us</a></div><p>Tel 123</p>""")
    assert M.main_text(p).split("\n\n") == ["Title", PROSE, "Near.", PROSE]


def test_defined_cases():
    assert M.main_text(None) == "" and M.main_text("") == "" and M.main_text("<p></p>") == ""
    assert M.main_text(PROSE) == PROSE
    assert M.main_text("<p>" + PROSE + "<!-- open") == PROSE
    assert M.main_text("<div><nav>" + PROSE) == ""
    assert len(M.main_text("<article>" + "<p>x y</p>" * 20_000)) == 20_000 * 5 - 2
    assert M.main_text("a < b <3 and the rest of it") == "a < b <3 and the rest of it"


def test_names_count_as_a_whole():
    for name in ("post has-sidebar", "no-sidebar", "post comments-open", "search-engine-intro"):
        assert M.main_text(page(f'<article class="{name}"><p>{PROSE}</p></article>')) == PROSE
        assert M.main_text(page(f'<article><div class="{name}"><p>{PROSE}</p></div></article>')) == PROSE
    assert M.main_text(page(f'<article><div class="entry-header"><h1>Title</h1></div><p>{PROSE}</p></article>')) == f"Title\n\n{PROSE}"
    for name in ("sidebar", "cookie-notice", "site-footer", "post_comments", "widget widget-2", "x comment-list", "ad-slot-3", "main-nav", "related-posts", "js-ad-banner-300x250"):
        assert M.main_text(page(f'<article><p>{PROSE}</p><div class="{name}"><p>Other. {PROSE}</p></div></article>')) == PROSE
    assert M.main_text(page(f'<main><p>{PROSE}</p><article class="comment"><p>Other. {PROSE}</p></article></main>')) == PROSE


def test_a_long_text_may_hold_a_copyright_sign():
    p = page(f"<h2>Law</h2><p>The sign © is a part of it. {PROSE}</p><p>© 2020 Some Company</p>")
    assert M.main_text(p) == f"Law\n\nThe sign © is a part of it. {PROSE}"


def test_broken_markup_takes_linear_time():
    import time
    n = 200_000
    for p in ("<a " * n, "<a x='" * n, '<a ">" ' * n + "'", "<![CDATA[" * n, "<!" * n, "<" * n, "<div>" * n + "</p>" * n, "<p class=" * n + ">", "</" * n + ">", "<!--" * n):
        t = time.process_time()
        M.main_text(p)
        assert time.process_time() - t < 4, p[:20]
    assert M.main_text(f'<p title="a > b">{PROSE}</p><p title="x>Open. {PROSE}</p>') == f"{PROSE}\n\nOpen. {PROSE}"


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", f"<p>{PROSE}</p>", 7), (1, "u", f"<p>{PROSE}</p>", 7), (None, None, None, None)],
                               "page_id long, url string, html string, n_chars int")
    rows = sorted(map(tuple, M.extract(df).collect()), key=str)
    assert rows == [(1, "u", PROSE, len(PROSE))] * 2 + [(None, None, "", 0)]
    assert M.extract(df.limit(0)).count() == 0


def test_table_against_the_marked_up_articles(spark, qs):
    """In the given pages the article element holds all of the main text."""
    import html
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r.text for r in qs["op8_main_text"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x)
