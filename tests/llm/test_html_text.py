import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelsieve.llm import html_text

ARTICLE = "<article><h1>Title &amp; more</h1><p>First   para\n with <b>bold</b> and <a href='x'>link</a>.</p><p>Short.</p><p>" + "Long text here. " * 30 + "</p></article>"
WANT = "Title & more\n\nFirst para with bold and link.\n\nShort.\n\n" + ("Long text here. " * 30).strip()


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href='/'>Home</a></li></ul></nav>{}<footer>&copy; x</footer>",
        "<header><h2>Site</h2></header>{}<aside><p>Side text that is rather long, with many words in it, and so on and on.</p></aside>",
        "<div class='cookie-notice'><p>We use cookies. " + "Really. " * 80 + "</p></div>{}",
        "{}<div id='comments'><article class='comment'><p>" + "I do not agree. " * 60 + "</p></article></div>",
        "<div class='page has-content'>{}</div><div class='ad'>Buy!</div>",
        "<form><label>Mail</label><input><button>Go</button></form>{}<script>var a='<p>no</p>';</script><style>p{{}}</style>",
        "<div class='sidebar'><p>x</p></div><main>{}</main><div role='complementary'>y</div>",
        "{}<section class='relatedPosts'><p>" + "More of it. " * 50 + "</p></section>",
    ],
)
def test_only_the_article_is_left(around):
    page = "<!DOCTYPE html><html><head><title>t</title></head><body>" + around.format(ARTICLE) + "</body></html>"
    assert html_text.main_text(page) == WANT


def test_page_without_article_element():
    body = "<div id='top'><a href='1'>a</a> <a href='2'>b</a></div><div class='content'><h1>Title</h1><p>" + "Some long sentence. " * 20 + "</p><p>Ok.</p><p>" + "Another long one. " * 20 + "</p></div><div><a href='3'>c</a></div>"
    got = html_text.main_text(f"<html><body>{body}</body></html>")
    assert got == "Title\n\n" + ("Some long sentence. " * 20).strip() + "\n\nOk.\n\n" + ("Another long one. " * 20).strip()


INTRO, BODY = ("An introduction of some words. " * 7).strip(), ("Some long sentence. " * 100).strip()


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div id=content><h1>Title</h1><div class=intro>{i}</div><div class=body>{b}</div></div>", "Title\n\n{i}\n\n{b}"),
        ("<div id=content><h1>Title</h1><div class=intro><p>{i}</p></div><div class=body><p>{b}</p><p>{b}</p></div></div><div><a href=1>more of this</a></div>", "Title\n\n{i}\n\n{b}\n\n{b}"),
        ("<div><div><p>{b}</p></div></div><div><h2>After</h2><p>{i}</p></div><div><a href=1>x</a> <a href=2>y</a></div>", "{b}\n\nAfter\n\n{i}"),
        ("<article><h1>One</h1><p>{b}</p></article><article><h1>Two</h1><p>{i}</p></article>", "One\n\n{b}\n\nTwo\n\n{i}"),
        ("<div class='page no-sidebar'><p>{b}</p></div>", "{b}"),
        ("<div class='has-header'><p>{b}</p><div class=sidebar>{i}</div></div>", "{b}"),
        ("<div class='widget-area'><p>{b}</p></div><div><a href=1>x</a></div>", "{b}"),
        ("<form action=x><nav>n</nav><article><p>{b}</p></article><div class=sidebar>{i}</div></form>", "{b}"),
        ("<div class=content><p>{i}</p></div><div id=comments><p>{b}</p></div>", "{i}"),
    ],
)
def test_whole_text_whatever_its_containers(page, want):
    assert html_text.main_text(f"<html><body>{page.format(i=INTRO, b=BODY)}</body></html>") == want.format(i=INTRO, b=BODY)


def test_unclosed_and_broken_markup():
    assert html_text.main_text("<article><p>one<p>two<br>three <b>four<p>five &amp six") == "one\n\ntwo three four\n\nfive & six"
    assert html_text.main_text("<article><ul><li>a<li>b</ul>c<![if x]>d<!-- e -->") == "a\n\nb\n\ncd"
    assert html_text.main_text("") == html_text.main_text("<html>") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("just text &eacute;") == "just text é"


def test_generated_pages_hold_their_article(spark, small):
    for r in html_text.extract(spark.read.parquet(f"{small}/pages.parquet")).join(spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(x for x in parts if x)
        assert r.n_chars == len(r.text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "<nav>", "</nav>", "<b>", "</b>", "<li>", "<table>", "<td>", "text ", "&amp;", "&#x", "<", ">", "<!--", "-->", "<![", "<script>", "</script>", "\x00", "é"]), max_size=40))
def test_any_markup_gives_a_text(parts):
    text = html_text.main_text("".join(parts))
    assert text == text.strip() and "\n\n\n" not in text


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "v", "<p>x"), (2, None, "")], "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("z"))
    assert sorted(map(tuple, html_text.extract(df).collect()), key=repr) == sorted([(1, "u", "", 0), (2, None, "", 0), (2, None, "", 0), (None, "v", "x", 1)], key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


def test_smoothing_and_threshold():
    assert html_text.smooth([3.0] * 7) == pytest.approx([3.0] * 7)
    assert html_text.smooth([0, 0, 9.0, 0, 0])[2] == max(html_text.smooth([0, 0, 9.0, 0, 0]))
    assert 2 < html_text.threshold([1, 1, 2, 40, 50]) < 40


LONG = ("This is running text of an article, with commas, and so on. " * 12).strip()


@pytest.mark.parametrize(
    "page, want",
    [
        # Labelled by hand: words of the mark list in names that say something else.
        ('<article><div class="article-header"><h1>Title</h1><p>Lead</p></div><p>{x}</p><div class="comment-on-policy"><p>On policy.</p></div><section id="social-science"><p>On science.</p></section></article>', "Title\n\nLead\n\n{x}\n\nOn policy.\n\nOn science."),
        # Menus and labels in plain containers of a page without an article element.
        ("<body><div><a href=1>Home</a></div><div><a href=2>News</a></div><div><h1>Title</h1><p>{x}</p><p>Short one.</p><p>{x}</p></div><div>Accept all now</div></body>", "Title\n\n{x}\n\nShort one.\n\n{x}"),
        ("<table><tr><td><a href=1>A</a><a href=2>B</a></td><td><b>Head</b><p>{x}</p><p>{x}</p></td></tr></table><p>Terms</p>", "Head\n\n{x}\n\n{x}"),
        # What follows the article inside of it.
        ("<article><header class='entry-header'><h1>T</h1></header><p>{x}</p><div class='share-buttons'>Tweet</div><div class='post-comments'><p>{x}</p></div><section id='comments'><p>{x}</p></section></article>", "T\n\n{x}"),
        ("<main><div class='page-header'><h1>T</h1></div><p>{x}</p><aside>{x}</aside><div class='newsletter-signup'><p>Get it by mail.</p></div></main>", "T\n\n{x}"),
        ("<div class='site-header'>Paper of the day</div><div class=story><p>{x}</p><ul><li>one thing</li><li>another <a href=1>thing</a></li></ul><p>{x}</p></div><div class='cookie-banner-wrapper'>{x}</div>", "{x}\n\none thing\n\nanother thing\n\n{x}"),
        ("<div><p>{x}</p></div><div><p>Yes.</p></div><div><p>{x}</p></div><div><p>The end.</p></div><div><p>Log in</p></div>", "{x}\n\nYes.\n\n{x}\n\nThe end."),
        ("<div class='ad'><div class='menu'><div class='widget'><p>{x}</p></div></div></div>", "{x}"),
    ],
)
def test_pages_labelled_by_hand(page, want):
    assert html_text.main_text(page.replace("{x}", LONG)) == want.replace("{x}", LONG)


@pytest.mark.parametrize("page", ["<div>" * 200_000 + "x", "<div><p>x" * 100_000, "<div class=ad>" * 100_000 + LONG, "<b>" * 200_000 + LONG, "<a>x" * 100_000, "<li><ul>x" * 60_000, "<article><p>x" * 60_000, "<form>x" * 100_000, "</p>" * 200_000, "<p>a</p>" * 100_000])
def test_time_is_linear_in_the_page(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 20


PARAGRAPH = "This is a paragraph of the story with quite a few words in it, number {}."


def test_comments_in_articles_of_their_own_go():
    story = [PARAGRAPH.format(k) for k in range(3)]
    comment = "A reader says hello and writes a comment of more than ten words in here."
    body = "".join(f"<p>{x}</p>" for x in story)
    pages = [
        f'<main><article>{body}<div class="comments"><article><p>{comment}</p></article></div></article></main>',
        f'<main><article>{body}</article><section class="comments"><article class="c1"><p>{comment}</p></article></section></main>',
        f'<article>{body}</article><div class="user-responses"><article class="response"><p>{comment}</p></article></div>',
    ]
    for page in pages:
        assert html_text.main_text(f"<html><body>{page}</body></html>") == "\n\n".join(story)


def test_an_articles_subject_is_no_mark():
    one, two, three = (PARAGRAPH.format(k) for k in range(3))
    for name in ("social", "cookies"):
        page = f'<article><p>{one}</p><section class="{name}"><p>{two}</p><p>{three}</p></section></article>'
        assert html_text.main_text(page) == f"{one}\n\n{two}\n\n{three}"
        # Links and buttons, or one line of text, are no subject; nor is a part of the comments.
        page = f'<article><p>{one}</p><div class="{name}"><a href="#">Share</a><p>{two}</p></div><p>{three}</p></article>'
        assert html_text.main_text(page) == f"{one}\n\n{three}"
        page = f'<article><p>{one}</p><div class="comments"><div class="{name}"><p>{two}</p><p>{three}</p></div></div></article>'
        assert html_text.main_text(page) == one


@pytest.mark.parametrize("piece", ["<!--", "<a ", '<a b="', "<a b='", "<![", "<!d ", "</a ", "<?x ", "<script>", "<a b=", "&", "&#", "<"])
@pytest.mark.parametrize("end", ["", ">", '">', "-->"])
def test_unfinished_markup_in_time_and_with_its_text(piece, end):
    import time

    start = time.perf_counter()
    text = html_text.main_text("<article><p>" + PARAGRAPH.format(1) + "</p></article>" + piece * (240_000 // len(piece)) + end)
    assert time.perf_counter() - start < 3 and text.startswith(PARAGRAPH.format(1))


def test_text_after_unfinished_markup_is_kept():
    assert html_text.main_text(f"<article><p>{PARAGRAPH.format(1)}</p><p>a < b and <!-- no end {PARAGRAPH.format(2)}</p></article>").endswith(PARAGRAPH.format(2))
