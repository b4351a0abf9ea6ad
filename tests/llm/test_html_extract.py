"""Main text of pages: fixtures of many makes, malformed markup, and the rules by themselves."""

import re
import time

import pytest
from gridloom.llm import op12_html_extract as pages
from gridloom.llm.html_blocks import blocks
from hypothesis import given, settings
from hypothesis import strategies as st

LONG = "It was the best of times, it was the worst of times, and the age of all that is in the book was not yet over for them."
MORE = "There is a house on the hill that was built by the old man, and all of the people in the town have been to see it at night."
LABELS = "Tempus fugit " * 8

PAGES = {
    "no marks at all": (
        f"<body><div>Home | About</div><p><a href=/>Home</a> <a href=/a>Articles of the week</a></p><h1>A title</h1><p>{LONG}</p><p>Short one.</p><p>{MORE}</p>"
        "<p>More to read: <a href=/x>the ten best of all the articles in the week</a></p><p>© 2020 Someone</p></body>",
        ["A title", LONG, "Short one.", MORE],
    ),
    "parts by element": (
        f"<header><h1>Site</h1></header><nav>{LONG}</nav><main><h1>T</h1><p>{LONG}</p></main><aside><p>{MORE}</p></aside><form>{MORE}</form><footer>{MORE}</footer>",
        ["T", LONG],
    ),
    "parts by name": (
        f"<div id=top-menu>{LONG}</div><div class='cookie-notice'><p>{LONG}</p></div><div class='content no-sidebar'><p>{LONG}</p><div class=adBox>{MORE}</div><p>{MORE}</p></div>"
        f"<div class='post-comments'><p>{MORE}</p></div><div class=sidebar>{MORE}</div>",
        [LONG, MORE],
    ),
    "short article": ("<div class=ad>Buy the of and in</div><article><h1>One</h1><p>two</p><p>three</article><footer>f</footer>", ["One", "two", "three"]),
    "comments as inner articles": (f"<article><h1>T</h1><p>{LONG}</p><section><article><p>{MORE}</p></article></section><p>end</p></article>", ["T", LONG, "end"]),
    "comments after a heading": (f"<h1>T</h1><p>{LONG}</p><h3>3 comments</h3><div><p>{MORE}</p></div>", ["T", LONG]),
    "link lists in an article": (f"<article><p>{LONG}</p><ul><li><a href=1>one two three</a><li><a href=2>four five six</a></ul><p>{MORE}</p></article>", [LONG, MORE]),
    "linked title": (f"<article><header><h2><a href=/t>The title</a></h2></header><p>{LONG}</p></article>", ["The title", LONG]),
    "references and white space": ("<article><p>a&nbsp;&eacute;&#8217;&#x27;&lt;b&gt; &amp;amp;\n\t x<b>y</b>z<br>w &copy &unknown;</p></article>", ["a é’'<b> &amp; xyz w © &unknown;"]),
    "double line breaks": ("<article>one<br>two<br> <br/>three</article>", ["one two", "three"]),
    "scripts and comments": (f"<article><script>if (a<b) '<p>{LONG}</p>'</script><style>p{{}}</style><!-- <p>{LONG}</p> --><p>x</p><noscript>on!</noscript><textarea><p>t</textarea></article>", ["x"]),
    "open comment": ("<article><p>kept</p><!-- <p>gone</p></article>", ["kept"]),
    "open tag at the end": ("<article><p>kept</p><div class=", ["kept"]),
    "quoted angle": ("<article><p title='a>b' data-x=\"<p>\">kept</p>it's < 3 <b</article>", ["kept", "it's < 3"]),
    "upper case": (f"<BODY><NAV>{LONG}</NAV><ARTICLE><P>kept</P></ARTICLE>", ["kept"]),
    "advert left open before the article": ("<div class=advert>Buy<article><p>kept</p></article>", ["kept"]),
    "page in a form": ("<form><label>Find</label><main><p>kept</p></main></form>", ["kept"]),
    "an article in a sidebar": (f"<div class=sidebar><article><p>{MORE}</p></article></div><article><p>{LONG}</p></article><div class=promo><article>{MORE}</article></div>", [LONG]),
    "a wrapper named after the sidebar": (f"<div class='content-sidebar-wrap'><main><p>{LONG}</p></main><div class=sidebar>{MORE}</div></div>", [LONG]),
    "hidden": ("<article><p>kept <span style='display: none'>gone</span>on</p><div hidden>gone</div></article>", ["kept on"]),
    "long text of no known language": (f"<div><a href=1>one</a></div><div>{LABELS}</div><div>{LABELS}</div>", [LABELS.strip()] * 2),
    "open text between texts and boilerplate": (f"<p>{LONG}</p><p>{LABELS}</p><p>{LONG}</p><p><a href=1>{MORE}</a></p><p>{LABELS}</p><p><a href=1>{MORE}</a></p>", [LONG, LABELS.strip(), LONG]),
    "nothing but boilerplate": (f"<nav>{LONG}</nav><footer>{MORE}</footer>", []),
    "one line": ("Hello", ["Hello"]),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    html, want = PAGES[name]
    assert pages.main_text(html).split("\n\n") == (want or [""])


def test_second_pass_against_a_plain_search():
    def nearest(labels, headings, edge, i):
        up = next(((i - k, labels[k]) for k in range(i - 1, -1, -1) if labels[k] is not None), (i + 1, edge))
        down = next(((k - i, labels[k]) for k in range(i + 1, len(labels)) if labels[k] is not None), (len(labels) - i, edge))
        if up[1] == down[1] or headings[i]:
            return down[1]
        return min(up, down)[1] if up[0] != down[0] else edge

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from([0, 1, None]), st.booleans()), max_size=14), st.sampled_from([0, 1]))
    def holds(blocks_, edge):
        labels, headings = [b[0] for b in blocks_], [b[1] for b in blocks_]
        want = [nearest(labels, headings, edge, i) if x is None else x for i, x in enumerate(labels)]
        assert pages.second_pass(labels, headings, edge) == want

    holds()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <div> </div> <a href=x> </a> <li> <ul> </ul> < > \" ' = <!-- --> & &amp; x y <article> </article> <br> <td> <table> <script> </script> <b".split(" ")), max_size=30))
def test_any_markup_gives_blocks_in_order(parts):
    found = blocks("".join(parts))
    assert all(b.text == " ".join(b.text.split()) != "" and 0 <= b.link_chars for b in found)


@pytest.mark.parametrize("piece", ["<a ", '<p class="', "<!--", "&", "<", "<div>", "<p>", "<li>", "<ul><li>", "<p ='", "<script>", "<a href=x>", "<table><td>", "</p>"])
def test_hostile_pages_take_linear_time(piece):
    began = time.process_time()
    pages.main_text(piece * 40_000)
    assert time.process_time() - began < 10


def test_table_with_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "u", "<p>y</p>"), (3, "u", "<p>y</p>"), (4, "u", f"<article>{'<p>' + LONG + '</p>' + 'w ' * 100_000}</article>")]
    table = spark.createDataFrame([(*r, "c", "c") for r in rows], "page_id long, url string, html string, text string, n_chars string").repartition(2)
    found = sorted(((r["page_id"] or 0), r["url"], r["text"]) for r in pages.extract(table).collect())
    assert [r[2] for r in found][:5] == ["x", "", "", "y", "y"] and found[5][2] == LONG + "\n\n" + "w " * 99_999 + "w"
    assert pages.extract(table.limit(0)).count() == 0


def test_query_keeps_every_page_and_all_of_its_article(spark):
    sf = "/root/testdata/sf0.001"
    found = {r["page_id"]: r for r in pages.op12_html_extract(spark, sf).collect()}
    table = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(found) == len(table)
    for r in table:
        words = re.sub(r"<[^>]*>", " ", re.search(r"(?s)<article>(.*)</article>", r["html"])[1]).replace("&quot;", '"').replace("&amp;", "&").split()
        assert found[r["page_id"]]["text"].split() == words and found[r["page_id"]]["n_chars"] == len(found[r["page_id"]]["text"])
