import random

import pytest

from shelfcast.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="layout"><div class="sidebar">Related things</div><{home}><h1>Title {n}</h1><p>First &amp; long text number {n} of the page, with&nbsp;words &lt;b&gt;.</p>
<p>Second   text<br>of {n} <a href="x">linked</a> words.<p>Third, <b>unclosed {n}
<form><input value="x">Sign up</form><section class="comments"><p>Reader says hi {n}</p></section></{end}></div><footer>&copy; site</footer></body></html>"""


def page(n, home="article", end=None):
    return PAGE.format(n=n, home=home, end=end or home.split(" ")[0])


def expected(n):
    return f"Title {n}\n\nFirst & long text number {n} of the page, with words <b>.\n\nSecond text of {n} linked words.\n\nThird, unclosed {n}"


def test_articles_of_marked_and_unmarked_pages(frame):
    rows = [(n, f"http://one.example.com/{n}", page(n), "old") for n in range(12)] + [(100 + n, f"https://two.example.com:80/{n}?q", page(n, 'div class="post"', "div"), "old") for n in range(12)]
    found = html.main_text(frame(rows, "page_id long, url string, html string, text string"))
    assert found.columns == ["page_id", "url", "html", "text"]
    for row in found.collect():
        assert row["text"] == expected(row["page_id"] % 100)


def test_odd_pages(frame):
    rows = [
        (1, None, None), (2, "no url", ""), (3, "http://a.example/", "<"), (4, "http://a.example/", "plain text only"), (5, "http://a.example/", "<article><p>cut &am"),
        (6, "http://a.example/", "<article>" + "<div>" * 3000 + "deep"), (7, "http://a.example/", "<script>alert(1)"), (8, "http://a.example/", "<article><p>x</p><aside>y</aside>"),
        (9, "http://b.example/", "<article><p>" + "word " * 200_000 + "</p>"),
    ]
    found = {row["page_id"]: row["text"] for row in html.main_text(frame(rows, "page_id long, url string, html string")).collect()}
    assert found[1] == found[2] == found[7] == ""
    assert found[4] == "plain text only" and found[5] == "cut &am" and found[6] == "deep" and found[8] == "x"
    assert found[9] == ("word " * 200_000).strip()


def test_no_pages(frame):
    assert html.main_text(frame([], "page_id long, url string, html string")).count() == 0


def test_expression_of_a_host():
    whole = None
    for n in range(5):
        extra = "<ul><li>a</li><li>b</li></ul>" if n % 2 else ""
        whole = html.merge(whole, html.expression(html.parse(f"<body><p>fixed</p>{'<div>x%d</div>' % n * (n + 1)}{extra}</body>")))
    body = whole[4][0]
    kinds = {part[0].split("|")[0]: part for part in body[4]}
    assert kinds["div"][2] and not kinds["div"][3]  # repeated, on every page
    assert kinds["ul"][3] and kinds["ul"][4][0][2]  # optional, with a repeated item
    assert kinds["p"][4][0][2] == "fixed" and kinds["div"][4][0][2] is None  # a constant and a slot


@pytest.mark.parametrize("order", [1, -1])
def test_merging_covers_all_pages_in_any_order(order):
    pages = [html.expression(html.parse(page(n))) for n in range(9)][::order]
    whole = None
    for one in pages:
        whole = html.merge(whole, one)
    assert whole[1] == 9 and [sign.split("|")[0] for sign in html.regions(whole)["path"]][-1] == "article"


def texts_of(frame, pages, schema="page_id long, url string, html string"):
    return {row["page_id"]: row["text"] for row in html.main_text(frame(pages, schema)).collect()}


@pytest.mark.parametrize("names", ["content no-sidebar", "post has-comments", "article-body with-tags", "post share-enabled"])
def test_names_that_say_how_a_page_is_laid_out(frame, names):
    rows = [(n, "http://a.example/x", f'<body><div class="{names}"><p>Words of {n}.</p></div><div class="post-comments"><p>Hi {n}</p></div></body>') for n in range(6)]
    assert texts_of(frame, rows) == {n: f"Words of {n}." for n in range(6)}


def test_readers_comments_of_an_article(frame):
    rows = [(n, "http://a.example/x", f'<article><p>Words of {n}.</p><div class="reader-thoughts"><p>Nice {n}</p></div></article>') for n in range(6)]
    assert texts_of(frame, rows) == {n: f"Words of {n}." for n in range(6)}


@pytest.mark.parametrize("home", ["article", "div"])
@pytest.mark.parametrize("count", [2, 40])
def test_a_line_that_all_pages_have_is_no_article_text(frame, home, count):
    line = "Sign in &amp; read on &copy; us"
    rows = [(n, "http://a.example/x", f"<body><{home}><p>Text {n} of a page, of some length.</p><p>{line}</p><p>More of {n} here.</p></{home}></body>") for n in range(count)]
    assert texts_of(frame, rows) == {n: f"Text {n} of a page, of some length.\n\nMore of {n} here." for n in range(count)}


def test_long_constant_text_beside_short_articles(frame):
    legal = "Terms of all pages. " * 120
    rows = [(n, "http://a.example/x", f"<body><div><p>{legal}</p></div><div><p>{f'Word{n} ' * 100}</p></div></body>") for n in range(8)]
    assert texts_of(frame, rows) == {n: (f"Word{n} " * 100).strip() for n in range(8)}


def test_repeated_pages_are_no_constants(frame):
    one = "<body><div><p>Only article.</p><p>Second block.</p></div></body>"
    rows = [(n, "http://a.example/x", one) for n in range(5)] + [(9, "http://b.example/x", one)]
    assert set(texts_of(frame, rows).values()) == {"Only article.\n\nSecond block."}


def test_clashing_columns(frame):
    rows = [(1, "http://a.example/", "<article><p>x</p></article>", "h", "r", "f")]
    found = html.main_text(frame(rows, "page_id long, url string, html string, host string, regions string, fixed string")).collect()
    assert [tuple(row) for row in found] == [(*rows[0], "x")]


def test_names_of_a_page_alone_keep_the_expression_small():
    whole, sizes = None, []
    for n in range(400):
        whole = html.merge(whole, html.expression(html.parse(f'<body><div class="c{chr(97 + n % 26)}{chr(97 + n // 26)}x"><p>text {n}</p></div></body>')))
        if n in (199, 399):
            sizes.append(len(str(whole)))
    assert sizes[1] < 1.2 * sizes[0]


def test_generated_hosts_against_their_plan(frame):
    """Pages are written from a plan of article blocks and template parts; the plan is the brute force."""
    chance = random.Random(8)
    words = ["".join(chance.choice("abcdefghij") for _ in range(chance.randint(2, 8))) for _ in range(400)]
    say = lambda least, most: " ".join(chance.choice(words) for _ in range(chance.randint(least, most)))
    rows, plan = [], {}
    for host in range(8):
        notice, legal, menu = say(5, 9), say(30, 60), "".join(f"<li>{say(1, 2)}</li>" for _ in range(6))
        home = chance.choice(["article", 'div class="post"', "main", "div"])
        for n in range(chance.choice([2, 3, 25])):
            key = host * 100 + n
            blocks = [say(8, 50) for _ in range(chance.randint(2, 6))]
            inner = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{block}</p>" for block in blocks[1:])
            at = chance.randint(0, 1)
            inner = f"<p>{notice}</p>{inner}" if at else f"{inner}<p>{notice}</p>"
            rows.append((key, f"https://h{host}.example/{n}", f"<html><body><nav><ul>{menu}</ul></nav><{home}>{inner}</{home.split()[0]}><div>{legal}</div><footer>{say(2, 4)}</footer></body></html>"))
            plan[key] = "\n\n".join(blocks)
    assert texts_of(frame, rows) == plan
