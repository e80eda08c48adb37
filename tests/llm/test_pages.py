import html
import re

import pytest

from lakesteward.llm import pages as pg
from lakesteward.llm.tables import table


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return pg.trained(table(spark, sf_dir, "pages"))


def _article(page):
    """The pages of the table have one article; its blocks end at the tags of headings and paragraphs."""
    inner = re.search(r"(?s)<article>(.*?)(</article>|$)", page)[1]
    blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1|h2)>", inner)]
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def test_pages_of_the_table(spark, sf_dir, weights):
    # Trained on the small table, held against the next larger one, of which most pages are new.
    larger = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "pages")
    expected = {r.page_id: _article(r.html) for r in larger.collect()}
    for r in pg.main_text(larger, weights).collect():
        assert r.text == expected[r.page_id] and r.n_chars == len(r.text)


LAYOUT = """<!doctype html><html><head><title>No title</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
<header><div class="logo">Site name</div></header><div id="main-menu"><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></div>
<div class="cookie-notice">We use cookies on this site. <button>Accept</button></div>
<{main}><h1>A title &amp; more</h1><p>First   paragraph of the <b>story</b> goes on
for a while here.<p>Second one, with a <a href="x">link</a> inside, and it ends here.<div class="ad-banner">Buy this now!</div>
<ul><li>One point of the list</li><li>Another point</li></ul><blockquote>Somebody said this sentence.</blockquote></{end}>
<aside class="sidebar"><h3>Popular</h3><ul><li><a href=/c>Other story</a></li></ul></aside>
<form action=/s><label>Your mail</label><input type=text><textarea>write here</textarea></form>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked the story very much, it was a good read indeed.</p></div></section>
<footer>&copy; 2024 Site name. All rights reserved.</footer></body></html>"""
MAIN = """A title & more
First paragraph of the story goes on for a while here.
Second one, with a link inside, and it ends here.
One point of the list
Another point
Somebody said this sentence."""


@pytest.mark.parametrize("main", ["article", "main", 'div class="post-content"', 'div id="content"', 'section class="story"'])
def test_other_layouts(spark, weights, main):
    page = LAYOUT.format(main=main, end=main.split()[0])
    row = pg.main_text(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), weights).first()
    assert row.text == MAIN


def test_accuracy_on_held_out_layouts(spark, sf_dir, weights):
    sample = [r.html for r in table(spark, sf_dir, "pages").limit(40).collect()]
    held = pg.training_pages(sample, seed=99)[len(sample):]
    found = pg.label(weights, held)
    right = sum(int((f == [b.label for b in p]).sum()) for f, p in zip(found, held))
    assert right / sum(map(len, held)) > 0.97


def test_odd_pages(spark, weights):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", "<article><p>x &lt; y &#233;&nbsp;z <1"), (4, "u", "plain"),
            (5, "u", "<article><p>cut off <b"), (6, "u", "<" * 50_000), (7, "u", "<div>" * 30_000 + "<article>deep</article>"),
            (8, "u", '<a "' * 30_000), (9, "u", "<article>" + "<p>word word word.</p>" * 20_000)]
    found = pg.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), weights).collect()
    texts = {(r.page_id, r.url): r.text for r in found}
    assert len(found) == len(rows) and texts[1, None] == "" and texts[2, "u"] == ""
    assert texts[None, "u"] == "x < y é z <1" and texts[5, "u"] == "cut off" and texts[9, "u"].count("\n") == 19_999
    assert pg.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def _texts(page):
    return [b.text for b in pg.read_blocks(page)]


@pytest.mark.parametrize("tag", ['<p class="a"">', "<p title=it's>", '<p "x>', "<p title='a'b'>", "<p title=a\"b'c>", '<p class = "a>b" \'>', "<p =\">",
                                 '<p title=>', '<p title=a="b>', "<p/'>", '<p title="a>b"c="d">', '<p title="open>', "<p title='open>"])
def test_text_behind_stray_quotes_stays(tag):
    assert _texts(f"<div>before{tag}inside</p>after</div><i>it goes on</i>") == ["before", "inside", "after", "it goes on"]
    assert _texts(f"<div>before{tag}inside") == ["before", "inside"]


def test_text_behind_signs_that_are_no_tag_stays():
    assert _texts("<p>a <é b</p><p>c </é> d</p>") == ["a <é b", "c d"]
    assert _texts('<p title="a>text one <b class="c') == ["text one"]
    assert _texts("<p>cut off <b class='x") == ["cut off"]


def test_many_odd_tags_take_time_in_proportion():
    import time

    start = time.time()
    for odd in ('<a b="><"', "<a b='", '<a ="', "<a '\">", '<a b = ', "<a\"'"):
        pg.read_blocks(odd * 60_000)
    assert time.time() - start < 20


def _long_page(i):
    noise = "<nav><ul>" + "<li><a href=x>menu entry</a></li>" * 40 + "</ul></nav>"
    body = "".join(f"<p>Sentence {i} {j} of the story goes on for quite a while and says something of its own.</p>" for j in range(900))
    return f"<html><body>{noise}<article>{body}</article><footer><p>All rights reserved by somebody</p></footer></body></html>"


def test_a_table_of_long_pages_only_trains_too(spark):
    pages = spark.createDataFrame([(i, "u", _long_page(i)) for i in range(6)], "page_id long, url string, html string")
    assert min(len(r.html) for r in pages.collect()) > pg.TRAIN_CHARS
    for r in pg.main_text(pages).collect():
        lines = r.text.split("\n")
        # Without a model every block would stay.
        assert lines.count("menu entry") <= 4 and len(lines) > 850


def test_sample_of_a_long_page_is_bounded():
    blocks = pg.sample_blocks(_long_page(1) + "<p>" + "x" * 200_000)
    assert blocks and sum(len(b.text) for b in blocks) <= 2 * pg.TRAIN_CHARS
    assert [b.text for b in pg.sample_blocks("<p>a<p>b")] == ["a", "b"]


def test_names_of_outer_containers_are_kept():
    deep = "<article class=x>" + "<div>" * 60 + "<p>inside</p>" + "</div>" * 60 + "</article><nav>" + "<div>" * 60 + "<p>outside"
    inside, outside = pg.read_blocks(deep)
    assert len(inside.path) == pg.MAX_PATH + 1 and pg.container_label(inside.path) == 1
    assert ("nav",) in outside.path and pg.container_label(outside.path) == 0
