"""HTML extraction: windows and points against a plain version, given pages, malformed and unmarked pages, long ones."""

import random
import time

import pytest

from spanlake.llm import html_extract, queries
import brute
from rows_of_text import DATA, docs  # noqa: F401


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_points_equal_a_plain_version(window):
    rng = random.Random(window)
    for _ in range(500):
        lengths = [rng.choice([0, 0, 0, 5, 80]) for _ in range(rng.randint(0, 14))]
        first, last = html_extract.points(lengths, window)
        assert [i for i in range(first, last) if lengths[i]] == brute.kept_lines(lengths, window)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op3_html_extraction(spark, DATA).collect()}
    assert len(got) == len(pages)
    for page in pages:
        found = html_extract.lines(page.html)
        weight = html_extract.weights(found)
        assert got[page.page_id].text == " ".join(found[i].text for i in brute.kept_lines(weight))
        assert got[page.page_id].text == brute.ArticleReader.read(page.html)
        assert got[page.page_id].n_chars == len(got[page.page_id].text) > 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>x</title><body><p>Text here</p>", "Text here"),
        ("<head><title>x</title><script>y</script><p>Text here", "Text here"),
        ("<div title='it's fine'>Text one</div><p>don't lose</p><p>three</p>", "Text one don't lose three"),
        ("<a href=x\"y>one</a> <b title=\"a>b\" 'c>two</b>", "one two"),
        ("<p class=ad>Buy<div>Article</div>", "Article"),
        ("<b><article>one </b>two</article>three", "one two"),
        ("<ul><li class=ad>x<li>kept</ul>", "kept"),
        ("<p>a<!-->b<!--->c<!-- > -- --!>d<!x>e</ f>g", "abcdeg"),
        ("<p>kept<script>if (a</b) '</scripty>'</SCRIPT x>more<title>t</title >end", "keptmoreend"),
        ("kept <svg/>more <object data=x />end", "kept more end"),
        ("a < b &lt; c &amp &notin; d<", "a < b < c & ∉ d<"),
        ("kept<p unfinished='", "kept"),
        ("kept<!-- unfinished", "kept"),
    ],
)
def test_malformed_markup(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize(
    "part",
    [
        '<article class="comment">x</article>',
        '<article class="related promo">x</article>',
        "<article hidden>x</article>",
        "<article id=comment-12>x</article>",
        "<div role=complementary>x</div>",
        "<div role=search>x</div>",
        '<ol class="commentlist"><li>x</ol>',
        "<ins class=adsbygoogle>x</ins>",
        "<div id=respond>x</div>",
        '<div style="color:red; display : none">x</div>',
        "<aside><h1>x</h1></aside>",
        "<dialog>x</dialog><template>x</template><select><option>x</select>",
        '<div class="cookie-consent">x</div>',
        "<footer><div><p>x</div><p>x</footer>",
    ],
)
def test_parts_left_out(part):
    kept = "<p>Text before.</p>{}<p>Text behind.</p>"
    assert html_extract.main_text(kept.format(part)) == "Text before. Text behind."
    assert html_extract.main_text("<article>" + kept.format(part) + "</article>") == "Text before. Text behind."


@pytest.mark.parametrize(
    "page, text",
    [
        ("<h1>Heading</h1><article><p>Text</p></article>", "Heading Text"),
        ("<header><h1>Heading</h1><nav>Menu</nav><p>Motto</p></header><article><p>Text</p></article>", "Heading Text"),
        ("<header><h1>Heading</h1></header><div><p>Text</p></div>", "Heading Text"),
        ("<header><h1>Site</h1></header><article><h1>Heading</h1><p>Text</p></article>", "Heading Text"),
        ("<header><h1>Site</h1></header><h1>Heading</h1><p>Text</p>", "Heading Text"),
        ("<article><header><h1>Heading</h1><p>Motto</p></header><p>Text</p></article>", "Heading Motto Text"),
        ("<header class=site-header><h1>Heading</h1></header><p>Text</p>", "Heading Text"),
        ("<header class=hidden hidden><h1>Site</h1></header><p>Text</p>", "Text"),
        ("<p><a href=1>One link</a> <a href=2>two</a></p><p>Text</p>", "One link two Text"),
        ("<h2><a href=1>One</a> <a href=2>two</a></h2><p>Text</p>", "One two Text"),
        ("<div><a href=1>Home</a> <a href=2>News</a></div><p>Text</p>", "Text"),
        ("<article><ul><li><a href=1>Reference</a></ul></article>", "Reference"),
    ],
)
def test_headings_and_links(page, text):
    assert html_extract.main_text(page) == text


LINKS = "<a href=1>one</a> <a href=2>two</a>"


@pytest.mark.parametrize(
    "page, text",
    [
        # lines of links inside the text, which the sums do not leave
        (f"Sources:<br>{LINKS}<br>are named.", "Sources: one two are named."),
        (f"<div>First.<br>{LINKS}<br>{LINKS}<br>Last.</div>", "First. one two one two Last."),
        ("<ul><li>Intro<br><a href=1>one</a><br>end</ul>", "Intro one end"),
        # apart from it, before, behind, or between two blocks
        (f"{LINKS}<br>Text", "Text"),
        (f"Text<br>{LINKS}", "Text"),
        (f"Site<br>{LINKS}<br>{LINKS}<br>{LINKS}<br>Text", "Site Text"),
        (f"<div>Site</div><div>{LINKS}</div><p>Text</p>", "Site Text"),
        ("<div>Site</div><ul><li><a href=1>Home</a><li><a href=2>News</a></ul><p>Text</p>", "Site Text"),
        # not in a marked article, or in a part that is none
        (f"<article>First.</article>{LINKS}<article>Last.</article>", "First. Last."),
        (f"First.<br><nav>{LINKS}</nav>Last.", "First. Last."),
        (LINKS, ""),
    ],
)
def test_surge_and_dive_points_decide_on_lines_of_links(page, text):
    assert html_extract.main_text(page) == text


def test_blocks_end_where_the_sums_are_zero():
    assert html_extract.blocks([0, 5, 0, 0, 3, 0, 0, 0, 2, 0]) == [(1, 5), (8, 9)]
    assert html_extract.blocks([0, 0]) == html_extract.blocks([]) == []


@pytest.mark.parametrize("tags", ['<a "', "<div>x", "</x>", "<b><i>", "<i><div><b></i>", '<a x="', "<!--", "<p><b>x</i>", "<li><a>x", "<h1>"])
def test_time_grows_with_the_page(tags):
    def took(n):
        began = time.process_time()
        html_extract.main_text(tags * n)
        return time.process_time() - began

    # eight times the page: 64 times the time if every tag looked at all others
    assert took(64_000) < 24 * max(took(8000), 0.05)


def test_extraction_needs_no_other_operator_before(spark):
    rows = [(1, "u", "<p>x"), (2, "u", None)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert sorted(map(tuple, got.collect())) == [(1, "u", "x", 1), (2, "u", "", 0)]
