"""Main text of pages: markup, deduced templates, odd input."""

import random

import pytest
from odd_rows import clashing, sentence
from tessera.llm import template as tp

PAGES = [
    ("<article><h1>T &amp; U</h1><p>a<b>b</b> c<br>d<p>e\n  f</article><footer>x</footer>", "T & U ab c d e f"),
    ("<nav>menu</nav><main><p>text</p><aside>side</aside><div class='comments'>no</div></main>", "text"),
    ("<header>top</header><article><header><h1>Title</h1></header><p>x</p><form>f<input></form></article>", "Title x"),
    ("<script>var t='</p>';</script><style>p{}</style><article>a<!-- <p>no</p> -->b</article>", "ab"),
    ("<article><p>1 &lt; 2 &#233; &nbsp; z</article>", "1 < 2 é z"),
    ("<article><a href='x>y'>link</a> tail <span class=\"ad-box\">buy</span>end", "link tail end"),
    ("<body class='with-sidebar'><div role=navigation>n</div><div id=content><p>plain page</p></div>", "plain page"),
    ("<div class=cookie-notice>c</div><p>body text</p><ul class='pagination'><li>1<li>2</ul>", "body text"),
    ("<article>cut off <b>here &am", "cut off here &am"),
    ("<article>open tag <a href=\"", "open tag"),
    ("<title>t</title><p>no article</p>", "no article"),
    ("just text & no markup", "just text & no markup"),
    ("<article><div class='shadow header-x'>kept</div></article>", "kept"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one two a b"),
    ("", ""), (None, ""), ("<nav>only menu</nav>", ""), ("<article></article>", ""),
]


def frame(spark, pages, host="h.test"):
    return spark.createDataFrame([(i, f"http://{host}/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")


def test_markup(spark):
    out = tp.extract(frame(spark, [p for p, _ in PAGES])).orderBy("page_id").collect()
    assert [r["text"] for r in out] == [t for _, t in PAGES]


def site(n, seed=1):
    """Pages without any telling tag or class: menu links, a repeated notice, the story, a repeated footer line."""
    rng = random.Random(seed)
    pages, truth = [], []
    for i in range(n):
        story = [sentence(rng, 40) for _ in range(3)]
        menu = "".join(f"<li><a href=/{k}>{sentence(rng, 2)} {k}</a></li>" for k in range(6))
        pages.append(f"<html><body><div class=x1><ul>{menu}</ul></div><div class=x2>We use your data.</div>"
                     f"<div class=x3>{''.join(f'<p>{s}</p>' for s in story)}</div><div class=x4>All rights reserved by us</div></body></html>")
        truth.append(" ".join(story))
    return pages, truth


def test_template_is_deduced_from_the_pages_of_a_host(spark):
    pages, truth = site(12)
    out = tp.extract(frame(spark, pages)).orderBy("page_id").collect()
    assert [r["text"] for r in out] == truth


def test_single_pages_of_many_hosts_share_a_template(spark):
    pages, truth = site(12, 2)
    df = spark.createDataFrame([(i, f"http://h{i}.test/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert [r["text"] for r in tp.extract(df).orderBy("page_id").collect()] == truth


def test_text_repeated_inside_articles_stays(spark):
    pages = [f"<nav>m</nav><article><p>same line</p><p>{w}</p></article>" for w in "abcdefgh"]
    out = tp.extract(frame(spark, pages)).orderBy("page_id").collect()
    assert [r["text"] for r in out] == [f"same line {w}" for w in "abcdefgh"]


def test_template_of_articles_goes(spark):
    rng = random.Random(7)
    story = [sentence(rng, 30) for _ in range(12)]
    pages = [f"<div class='layout has-sidebar'><article><h1>{i}</h1><p>{w}</p><div class=x1>Read our rules.</div>"
             f"<ul class=x2><li><a href=/a>one</a><li><a href=/{i}>two {i}</a></ul></article></div>" for i, w in enumerate(story)]
    out = tp.extract(frame(spark, pages)).orderBy("page_id").collect()
    assert [r["text"] for r in out] == [f"{i} {w}" for i, w in enumerate(story)]


def test_copies_of_an_article_keep_their_text(spark):
    page = "<article><h1>title</h1><p>some story</p></article>"
    assert {r["text"] for r in tp.extract(frame(spark, [page] * 6)).collect()} == {"title some story"}
    page = "<div><h1>title</h1><p>some story</p></div>"
    assert {r["text"] for r in tp.extract(frame(spark, [page] * 6)).collect()} == {"title some story"}


@pytest.mark.parametrize("page, text", [
    ("<div class='layout has-sidebar'><article>story here</article><div class=comments><article>no</article></div></div>", "story here"),
    ("<form><article>story</article><aside>x</aside></form>", "story"),
    ("<main><h1>T</h1><div class=has-sidebar><article>long story</article></div></main>", "T long story"),
    ("<article>story</article><div class=comments><article>a long comment on it</article></div>", "story"),
    ("<div>a long story in a plain container</div><div class=related><article>teaser</article></div>", "a long story in a plain container"),
])
def test_class_words_around_articles(page, text):
    assert tp.main_text(page, {}, set()) == text


def test_null_urls_repeats_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "http://h/", None)], "page_id long, url string, html string")
    assert sorted(r["text"] for r in tp.extract(df).collect()) == ["", "a", "a"]
    assert tp.extract(df.limit(0)).count() == 0
    out = tp.extract(clashing(df, "text", "host", "row", "slots", "words", "tpl_key"))
    assert {r["slots"] for r in out.collect()} == {"own slots"} and out.columns[-1] == "text"


@pytest.mark.parametrize("page", ["<" * 5000, "<a " * 3000, "<p \"" * 2000, "<!--" * 2000, "&" * 5000, "<div>" * 3000 + "x", "</p>" * 3000])
def test_hostile_markup_takes_linear_time(page):
    tp.blocks(page)


def test_very_long_page(spark):
    story = sentence(random.Random(4), 100_000)
    (r,) = tp.extract(frame(spark, [f"<nav>n</nav><article>{story}</article>"])).collect()
    assert r["text"] == story
