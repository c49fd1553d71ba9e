"""Wrappers that are named for the layout around or inside them."""

import pytest

from bramble.llm import html_extract


@pytest.mark.parametrize("attribute", ["class='content-sidebar-wrap'", "class='has-sidebar'", "class='no-sidebar'",
                                       "class='comments-open'", "id='page-with-nav'", "class='sidebar layout'"])
def test_article_in_a_layout_wrapper_stays(attribute):
    html = f"<body><div {attribute}><div><article><h1>Title</h1><p>Text</p><div class='sidebar'>side</div></article></div><div class='sidebar'>links</div></div></body>"
    assert html_extract.page_text(html, set()) == "Title\nText"


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "no-sidebar", "comments-open", "page-with-nav"])
def test_text_in_a_layout_wrapper_stays(name):
    assert html_extract.page_text(f"<div class='{name}'><p>Text</p><div class='sidebar'>links</div></div>", set()) == "Text"


@pytest.mark.parametrize("html, want", [
    ("<article>Main</article><div class='sidebar'><article>teaser</article></div>", "Main"),
    ("<p>Main</p><div class='comments'><article>reply</article></div>", "Main"),
    ("<p>Main</p><div class='sidebar'><p>links</p></div>", "Main"),
    ("<p>Main</p><div hidden><article>other</article></div>", "Main"),
])
def test_marked_parts_still_go(html, want):
    assert html_extract.page_text(html, set()) == want


@pytest.mark.parametrize("html, want", [
    ("<article class='post category-cookies'><p>Text</p></article>", "Text"),
    ("<article class='post has-comments comments-open'><p>Text</p></article>", "Text"),
    ("<article>Main<article class='comment'>reply</article></article>", "Main"),
    ("<div class='no-ads'><p>Text</p><div class='ads'>ad</div></div>", "Text"),
    ("<div class='post with-share'><p>Text</p><div class='share'>Share</div></div>", "Text"),
    ("<p>Text</p><div class='no-js-notice'>Switch it on</div><div class='ad-with-image'>ad</div>", "Text"),
    ("<div class='sidebar-right-page'><p>Text</p><div class='sidebar-right'>links</div></div>", "Text"),
    ("<div class='sidebar'><p>Text</p></div>", "Text"),
    ("<body><form action=x><div class='header'>top</div><p>Text</p><input><select><option>o</select></form></body>", "Text"),
    ("<body><form><div id=nav>n</div><article><p>Text</p><form><p>mail</p></form></article></form></body>", "Text"),
    ("<body><form><p>Search</p></form><div><p>Text</p><form><p>mail</p></form></div></body>", "Text"),
    ("<body><form><p>Search</p></form><article></article></body>", ""),
    ("<article><h2 id='related-work'>Related work</h2><p>Text</p><section id='discussion'><p>We discuss</p></section></article>", "Related work\nText\nWe discuss"),
    ("<section id='discussion'><p>We discuss</p></section><div id='comments'>reply</div>", "We discuss"),
    ("<div>" + "<p>" + "long main text " * 20 + "</p></div><article><p>Read next</p></article>", ("long main text " * 20).strip()),
    ("<div>a few links beside it</div><article><p>Read this</p></article>", "Read this"),
])
def test_names_that_do_not_remove_main_text(html, want):
    assert html_extract.page_text(html, set()) == want


def test_same_headings_in_all_articles_stay(spark):
    rows = [(i, "http://cook.example/x", f"<article><h1>Dish {i}</h1><h2>Ingredients</h2><p>flour {i} and salt</p><h3>Method</h3><p>bake {i} min</p>"
             "<div class='box'><h4>More dishes</h4><p>every day here</p></div></article>") for i in range(30)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Dish {i}\nIngredients\nflour {i} and salt\nMethod\nbake {i} min" for i in range(30)}


def test_deep_nesting_takes_linear_time():
    import time
    t = time.time()
    for tag in ("div", "b", "ul"):
        deep = "".join(f"<{tag}>w{i} " for i in range(50_000))
        assert len(html_extract.page_text(deep, {1}).split()) == 50_000
    assert time.time() - t < 30
