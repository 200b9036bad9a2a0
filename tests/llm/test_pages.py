"""Elements that are not read, left open or self-closed, and formulas."""

from __future__ import annotations

import pytest

from fareflow.llm import pages

ARTICLE = "<article><p>The first paragraph has some words in it.</p><p>And the second one has some more of them.</p></article>"
TEXT = "The first paragraph has some words in it.\nAnd the second one has some more of them."


@pytest.mark.parametrize("above", [
    '<svg viewBox="0 0 1 1"/>', "<svg />", "<math/>", '<a href="/"><svg class="i"/></a>', "<svg><path d='M0 0'/>", "<svg><title/><path/></svg>",
    "<svg><style/><text>no</text></svg>", "<svg><foreignObject><div>no</div></foreignObject></svg>",
    "<datalist><option value=a><option value=b></datalist>", "<div><option>no</div>", "<div><button>no</div>", "<div><select><option>no</div>",
    "<div><object data=x></div>", "<div><video src=x></div>", "<div><canvas></div>", "<div><noscript>no</div>",
    "<button>no</button>", "<select><option>no<option>no</select>", "<noscript><p>no</p></noscript>", "<template><article>no</article></template>",
    "<script>'<svg>'</script>", "<style>p{}</style>", "<title>no</title>"])
def test_what_is_not_read_ends(above):
    tree = pages.trained()
    assert pages.main_text(f"<html><body>{above}{ARTICLE}</body></html>", tree) == TEXT
    inside = ARTICLE.replace("<p>And", f"{above}<p>And")
    assert pages.main_text(f"<html><body>{inside}</body></html>", tree) == TEXT


def test_unread_elements_do_not_split_a_paragraph():
    page = ARTICLE.replace("some words", "some <svg><path/></svg><button>no</button>words")
    assert pages.main_text(page, pages.trained()) == TEXT


def test_formulas_are_text():
    page = ARTICLE.replace("some words", "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math> words")
    assert pages.main_text(page, pages.trained()) == TEXT.replace("some words", "x=2 words")


@pytest.mark.parametrize("page", [
    '<body class="no-sidebar">{}</body>', '<html class="nav-open"><body>{}</body></html>', '<body class="cookie comments">{}</body>',
    '<div class="has-sidebar">{}</div>', '<main class="with-related">{}</main>', "<form action=x>{}</form>", '<div role="dialog">{}</div>',
    "<form><div>{}</div></form><nav><a href=/>x</a></nav>"])
def test_outer_elements_do_not_hide_the_article(page):
    assert pages.main_text(page.format(ARTICLE), pages.trained()) == TEXT


@pytest.mark.parametrize("start", ['<article class="post has-comments">', '<article id="share-42">', "<article title=don't>", '<article data-x="a>b">'])
def test_attributes_of_the_article(start):
    page = f"<body>{ARTICLE.replace('<article>', start)}</body>"
    assert pages.main_text(page, pages.trained()) == TEXT


@pytest.mark.parametrize("rest", ['<article class="comment"><p>What a nice article this is to read.</p></article>', '<aside><article><p>Another story.</p></article></aside>',
                                  '<section id="comments"><article><p>I agree with all of it.</p></article></section>',
                                  "<form><p>Write a comment to this article here.</p></form>"])
def test_what_stands_beside_the_article_goes(rest):
    assert pages.main_text(f"<body>{ARTICLE}{rest}</body>", pages.trained()) == TEXT


def test_a_quote_in_an_attribute_is_no_text():
    assert pages.main_text(ARTICLE.replace("<p>", "<p title=don't>"), pages.trained()) == TEXT


@pytest.mark.parametrize("piece", ["<b>x ", "<div>x ", "<div>x</p>", '<a href="x>y ', "<p title='x>y ", "<button><p>x ", "<i></b>", "<!-- x ", "<svg><p>"])
def test_long_broken_pages_take_time_in_proportion(piece):
    import time
    began = time.perf_counter()
    pages.main_text(piece * (2_000_000 // len(piece)), pages.trained())
    assert time.perf_counter() - began < 20
