import pytest

from opsmart.llm import html

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>one</a><li><a href=/b>two</a></ul></nav><div class="sidebar"><p>side, text, with
commas, and many words here, really</p></div><div id=content><h2>Title</h2><p>First  para, with some text, long
enough to be counted.<p>Second &amp; last&nbsp;one, <a href=x>link</a>ed, also long enough.<ul><li>item one<li>item
two</ul></div><div class="comments"><p>I agree, this is so true, really, really, great post.</p></div>
<div class="cookie-notice"><p>We use cookies, ok, fine, sure, yes, no problem.</p></div><form><p>mail me, please,
now, soon, ok, thanks a lot</p></form><script>var a="<p>no</p>";</script><footer>end</footer></body></html>"""


def test_article_only():
    assert html.main_text(PAGE) == (
        "Title First para, with some text, long enough to be counted. Second & last one, linked, also long "
        "enough. item one item two"
    )


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("plain text", "plain text"), ("<div><p>short</p></div>", "short"), ("a<br>b", "a b"),
        ("x<b>y</b>z", "xyz"), ("<p>1 < 2", "1 < 2"), ("<script>x", ""), ("<!-- a", ""), ("</p></div>x", "x"),
        ("<a title='x>y'>t</a>", "t"), ("<table><tr><td>a<td>b</table>", "a b"), ("<nav>only</nav>", ""),
        ("&lt;b&gt; &#233;", "<b> é"),
    ],
)
def test_small_pages(page, text):
    assert html.main_text(page) == text


def test_deep_and_broken_pages():
    assert html.main_text("<div>" * 20000 + "x") == "x"
    html.main_text("<p>a" * 20000 + '<a href="' * 20000 + "<" * 50000 + "<!--" * 1000)


def test_query_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (2, None, None), (None, "u", ""), (1, "u", "<p>a</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text")
    out = html.extract(df).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out) == [(0, "", 0), (1, "a", 1), (1, "a", 1), (2, "", 0)]
    assert html.extract(df.limit(0)).count() == 0


BODY = "".join(f"<p>Paragraph {i} of the article, with commas, and words enough to be counted.</p>" for i in range(4))
TEXT = " ".join(f"Paragraph {i} of the article, with commas, and words enough to be counted." for i in range(4))


@pytest.mark.parametrize("mark", ["class='content with-sidebar'", "class=no-sidebar", "class=has-header", "class=layout--nav-left", "id=form1", "id='sidebar'"])
@pytest.mark.parametrize("tag", ["div", "article"])
def test_layout_words_do_not_remove_the_page(mark, tag):
    side = "<div class='sidebar'><p>Side text, short, and long enough to count.</p></div>"
    page = f"<body><nav>menu</nav><div {mark}><{tag}>{BODY}</{tag}>{side}</div><div class=comments>{BODY}{BODY}</div>"
    assert html.main_text(page.replace(f"<div class=comments>{BODY}{BODY}</div>", "")) == TEXT
    if tag == "article":
        assert html.main_text(page) == TEXT


def test_an_article_keeps_its_small_parts():
    end = "<section><h3>Sources</h3><ul><li><a href=a>First source</a><li><a href=b>Second source</a></ul></section>"
    page = f"<body><article><div>{BODY}</div>Loose text. {end}<section>Short end.</section><div class=share>Share</div></article>"
    assert html.main_text(page) == f"{TEXT} Loose text. Sources First source Second source Short end."


def test_attributes_of_any_length():
    for quote in "\"'":
        value = "x" * 12_000 + " > " + "y" * 12_000
        assert html.main_text(f"<div><img alt={quote}{value}{quote}><p>Text {BODY}</p></div>") == f"Text {TEXT}"
    assert html.main_text('<a href=x"y>t</a> <b title=a=\'b\'>u</b><i a="1"b="2>3">v</i>') == "t uv"
    assert html.main_text('<p title="never closed>text</p>') == "text"
    assert html.main_text("<span/>a<a href=x/>b</a>") == "ab"


@pytest.mark.parametrize(
    "part",
    [
        "<h2 class='section-header'>{}</h2>", "<section id='search-results'><p>{}</p></section>",
        "<div class='related-work'>{}</div>", "<div class='share-price-table'><table><tr><td>{}</table></div>",
        "<div class='notice-of-intent'>{}</div>", "<p class='form-factor'>{}</p>", "<ul class=sources><li><a href=x>{}</a></ul>",
    ],
)
@pytest.mark.parametrize("outer", ["<article>{}</article>", "<div>{}</div>", "<main><div>{}</div></main>"])
def test_one_word_of_a_name_drops_nothing_inside(part, outer):
    page = "<body><nav>menu</nav>" + outer.format(BODY + part.format("kept part") + BODY)
    assert html.main_text(page) == f"{TEXT} kept part {TEXT}"


@pytest.mark.parametrize(
    "name", ["share", "social-share-buttons", "comments-section", "related-posts", "sidebar right", "ad", "cookie-notice", "newsletter_box"]
)
def test_whole_names_go_inside(name):
    page = f"<body><article>{BODY}<div class='{name}'><p>Side part, long enough to be counted.</p></div>{BODY}</article>"
    assert html.main_text(page) == f"{TEXT} {TEXT}"


def test_siblings_of_the_best_container():
    end = "<h3>Sources</h3>Loose text.<p>Short end.</p>"
    page = f"<body><ul><li><a href=a>one</a><li><a href=b>two</a></ul><h1>Head</h1><div>{BODY}<ul><li><a href=x>A source</a></ul></div>{end}"
    assert html.main_text(page) == f"Head {TEXT} A source Sources Loose text. Short end."


def test_nested_tags_cost_linear_time():
    import time

    def seconds(n):
        start = time.perf_counter()
        for page in ("<i>" * n + "<tr>" * n, "<b>" * n + "<li>" * n, "<table>" + "<i>" * n + "<td>" * n, "<p title='" * n):
            html.main_text(page)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(40_000) < 60 * max(seconds(2000), 0.01)
    text = "word, and more words. " * 1_300_000  # 28 MB
    assert html.main_text(f"<body><nav>menu</nav><article><p>{text}</p></article>") == text.strip()


def _page(pick):
    """A page and its article, which is known: the text of ``real`` parts in order."""
    said = []

    def words(n):
        return " ".join(pick.choice(["alpha", "beta", "gamma,", "delta", "éta", "x&lt;y", "a&amp;b"]) for _ in range(n))

    def real(tag):
        text = words(pick.randint(1, 30))
        said.append(text.replace("&lt;", "<").replace("&amp;", "&"))
        inner = text if pick.random() < 0.6 else f"<b>{text}</b>" if pick.random() < 0.5 else f"<a href='?a>b'>{text}</a>"
        return f"<{tag} class='{pick.choice(['text', 'section-header', 'related-work', ''])}'>{inner}</{tag}>"

    def side():
        text = words(pick.randint(1, 40))
        return pick.choice([
            f"<nav><ul><li><a href=x>{text}</a></ul></nav>", f"<aside><p>{text}</p></aside>", f"<div class=sidebar><p>{text}</p></div>",
            f"<div class='comments'><p>{text}</p></div>", f"<form><p>{text}</p></form>", f"<script>'<p>{text}</p>'</script>",
            f"<div role=navigation>{text}</div>", f"<div class='ad banner'>{text}</div>", f"<!-- {text} -->", f"<footer>{text}</footer>",
        ])

    def inside(depth):
        out = []
        for _ in range(pick.randint(1, 4)):
            kind = pick.random()
            if kind < 0.15:
                out.append(side())
            elif kind < 0.35 and depth < 3:
                tag = pick.choice(["div", "section"])
                out.append(f"<{tag}>{inside(depth + 1)}</{tag}>")
            else:
                out.append(real(pick.choice(["p", "h2", "blockquote", "pre", "p"])))
        return "".join(out)

    before = "".join(side() for _ in range(pick.randint(0, 3)))
    tag = pick.choice(["article", "main"])
    lead = f"<p>{BODY[3:-4]}</p>"
    said.extend(TEXT.split("\n"))
    body = inside(0)
    after = "".join(side() for _ in range(pick.randint(0, 3)))
    wrap = pick.choice(["{}", "<div class='layout with-sidebar'>{}</div>", "<div><div>{}</div></div>"])
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{before}{wrap.format(f'<{tag}>{lead}{body}</{tag}>')}{after}", " ".join(said)


def test_random_pages_with_a_known_article():
    import random

    pick = random.Random(11)
    for _ in range(400):
        page, text = _page(pick)
        assert html.main_text(page) == " ".join(text.split()), page
