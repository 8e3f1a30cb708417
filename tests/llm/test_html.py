import html
import re

import pytest

from salesmart.llm import html_main as h


def by_markup(page):
    """The blocks of the article of a generated page, by its known markup."""
    inside = page[page.index("<article>") + 9 : page.rindex("</article>")]
    blocks = (html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))) for b in re.split("</?p>|</?h1>", inside))
    return "\n".join(t for b in blocks if (t := " ".join(b.split())))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    want = {r["page_id"]: (r["url"], by_markup(r["html"])) for r in df.collect()}
    rows = h.extract_main(df).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r["url"], r["text"]) == want[r["page_id"]] and r["n_chars"] == len(r["text"])


PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="page home">
<header><a href=/>Site</a></header><div class="cookie-notice">We use cookies</div><ul class="menu"><li>A<li>B</ul>
<div id="content"><div class="post post-{i}"><h2>Head {i} &amp; more</h2><p>First <b>bold</b>word {i}&nbsp;x
 y<p>Second &lt;tag&gt; {i}<br>line</p><ul><li>one<li>two</ul><script>var a="</p>";</script>
<form>mail <input name=a></form><div class="comments"><p>Nice {i}!</p></div></div></div>
<div class="zone-a">Short extra</div><aside>Side</aside><footer>&copy; us</footer></body></html>"""


def test_host_without_article_elements(spark):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", PAGE.format(i=i), "x") for i in range(8)], "page_id int, url string, html string, text string")
    rows = {r["page_id"]: r["text"] for r in h.extract_main(df, how=h.Template(main_share=0.8)).collect()}
    for i in range(8):
        assert rows[i] == f"Head {i} & more\nFirst boldword {i} x y\nSecond <tag> {i} line\none\ntwo"
    template = h.templates(df, how=h.Template(main_share=0.8))
    valid = {r["path"]: r for r in template.collect()}
    post = valid["/html/body.home.page/div.content/div.post.post-N"]
    assert post["once"] and post["main"] and post["n_pages"] == 8
    # Tokens that occur alike are one class; the paragraphs, twice on a page, are another.
    assert post["class_id"] == valid["/html/body.home.page/div.content"]["class_id"]
    assert valid[post["path"] + "/p"]["class_id"] != post["class_id"] == valid[post["path"] + "/p"]["parent"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain & text", "plain & text"), ("<p>a<p>b", "a\nb"), ("<p>a <!-- x <p>", "a"), ("<script>x", ""),
        ("<article>a<nav>b</nav>c</article>d", "a\nc"), ("<article>one</article><article>two</article>", "one\ntwo"),
        ("<div class='ad'>x</div>y", "y"), ("</div></p>z", "z"), ("<main><header>h</header>m</main>", "h\nm"), ("<b>x", "x"),
        ('<p title="a>b">q</p>', "q"), ('<p title="a<b>">q</p>', "q"), ("<p title=it's>q</p>r", "q\nr"), ('<div class="content no-sidebar">c</div>', "c"),
        ("a < b <c", "a < b <c"), ('<img src="data:' + "x" * 90_000 + '">i', "i"), ("<td>1<td>2", "1\n2"), ("&#x41;&lt;b&gt;", "A<b>"), ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_single_pages(page, text):
    assert h.main_text(page or "", None) == text


def test_edge_rows(spark):
    rows = [(None, None, None), (1, "x", None), (1, "x", None), (2, None, "<p>t</p>"), (3, "http://a/b", "<p>" + "w " * 200_000)]
    out = h.extract_main(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in out) == [("1", 0), ("1", 0), ("2", 1), ("3", 399_999), ("None", 0)]
    assert h.extract_main(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_identical_pages_keep_their_text(spark):
    page = "<html><body><nav>n</nav><article><h1>h</h1><p>same</p></article></body></html>"
    out = h.extract_main(spark.createDataFrame([(i, "http://h/x", page) for i in range(30)], "page_id int, url string, html string")).collect()
    assert {r["text"] for r in out} == {"h\nsame"}


@pytest.mark.parametrize("piece", ['<a title="', "<a ", "<!", "<p class='x", "<script", "<b c=\"d\" e='"])
def test_broken_markup_takes_linear_time(piece):
    """Twenty thousand broken tags: a scan to the end for each would take minutes."""
    import time

    began = time.process_time()
    h.main_text(piece * 20_000, None)
    assert time.process_time() - began < 20


def test_repeated_words_of_opaque_elements_are_template(spark):
    page = """<html><body><div class="q1"><ul><li><a href=/>Home page</a><li><a href=/b>All books</a></ul></div><div class="z9"><div class="k2">
    <p>The story {w} begins the {i} way.</p><p>Signed by {w}{w}</p></div><div class="k3">All the rights of the owner</div></div>
    <div class="q8">Written for you by the team</div></body></html>"""
    names = ["amber", "birch", "cedar", "daisy", "elder", "ferns", "grass", "hazel", "ivory", "jasmin", "kale", "lilac"]
    rows = [(i, f"http://h.example/{i}", page.format(i=i, w=w)) for i, w in enumerate(names)]
    rows += [(100 + i, "http://h.example/copy", rows[0][2]) for i in range(5)]  # copies say nothing about the template
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r["page_id"]: r["text"] for r in h.extract_main(df).collect()}
    for i, _, _ in rows:
        n = 0 if i >= 100 else i
        assert got[i] == f"The story {names[n]} begins the {n} way.\nSigned by {names[n]}{names[n]}"
    words = {(r["path"].rpartition("/")[2], r["word"]): r for r in h.templates(df).collect() if r["word"]}
    assert words["a", "Home"]["once"] and words["a", "Home"]["class_id"] == words["a", "Home"]["parent"] and ("p", "amber") not in words
    few = df.where("page_id < 9 or page_id >= 100")  # under ten distinct pages nothing is known of words
    assert not any(r["word"] for r in h.templates(few).collect())


def test_a_task_keeps_the_words_of_all_pages_with_a_path():
    host = h._Host()
    for page in ("<p>a b b c</p><i>x</i>", "<p>b a b</p>", "<p>d b</p><p>b a</p>"):
        host.add(page)
    assert host.words == {"": set(), "/p": {"a", "b"}, "/i": {"x"}} or host.words == {"": set(), "/p": {"a", "b"}, "/p/i": {"x"}}
    assert host.paths["/p"][:3] == [1, 3, 4]


@pytest.mark.parametrize("name", ["layout sidebar-right", "elementor-widget-theme-post-content", "social-science post", "alert-level-3 content"])
def test_names_around_the_article_do_not_drop_it(spark, name):
    page = '<body><div class="{c}"><{e}><p>Text {i} of many words.</p><div class="share">Share it</div></{e}></div><div class="related">More {i}</div><p>x</p></body>'
    for e in ("article", "div"):
        rows = [(i, f"http://{e}/{i}", page.format(c=name, e=e, i=i)) for i in range(4)]
        out = h.extract_main(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
        assert {r["text"] for r in out} == {f"Text {i} of many words." for i in range(4)}
        assert h.main_text(rows[0][2], None) == "Text 0 of many words."


@pytest.mark.parametrize("quote", ['"', "'"])
def test_quoted_values_of_any_length(quote):
    value = "<b class=ad>x</b>{y: [1 > 0]} " * 3000
    assert h.main_text(f"<div data-cfg={quote}{value}{quote} class=c><p>text</p></div>", None) == "text"
    assert h.main_text(f"<article data-cfg ={quote}{value}{quote}>in</article>out", None) == "in"
    assert h.main_text("<p title=it's>q</p>" + "r " * 5000 + "don't", None) == "q\n" + "r " * 5000 + "don't"


@pytest.mark.parametrize("piece", ["<a b=\"<c d='", "<a x='\"' ", "<a b=\"<c d=\"'", "<a =  ", "<a b='x'"])
def test_nested_broken_quotes_take_linear_time(piece):
    import time

    began = time.process_time()
    h.main_text(piece * 20_000, None)
    assert time.process_time() - began < 20


def test_article_blocks_with_names_that_hold_a_listed_word():
    """Inside the article a name drops a branch only when it is made of listed words."""
    body = "".join(
        f'<div class="{name}">{text}</div>'
        for name, text in (("share-price", "A b"), ("related-work", "C d"), ("ad-hoc", "E f"), ("user-comments-policy", "G"), ("related-posts", "no"), ("comments", "no"), ("ad-slot ad-slot-2", "no"))
    )
    page = f"<html><body><nav>Home</nav><div class='content sidebar'>x</div><article><h1>T</h1>{body}<p>Z</p></article></body></html>"
    assert h.main_text(page, None) == "T\nA b\nC d\nE f\nG\nZ"
