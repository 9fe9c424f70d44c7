import html
import random
import re

import numpy as np
import pytest

from custseg.llm import html_text


@pytest.fixture(scope="module")
def model():
    return html_text.train()


def text_of(model, page):
    blocks = html_text.blocks_of(page)
    label = model.label([html_text.inputs_of(blocks, html_text.WordCodes())])[0]
    return " ".join(b.text for b, p in zip(blocks, label) if p >= 0.5)


def test_blocks():
    page = ("<body><nav><ul><li><a href=x>A &amp; B<li>C</ul></nav><!-- <p>no --><script>var t='</p>'</script>"
            "<p>one <b>two</b>three<br>four\n\t five<p>six &copy; &notanentity; &quo<table><tr><td>x<td>y</table>"
            "<textarea>no</textarea><div class='a\"b'>z</div tail")
    assert [b.text for b in html_text.blocks_of(page)] == [
        "A & B", "C", "one twothree four five", "six © ¬anentity; &quo", "x", "y", "z"]
    assert html_text.blocks_of("") == [] and html_text.blocks_of("<p></p><script>x") == []
    assert [b.text for b in html_text.blocks_of("plain < text > here")] == ["plain < text > here"]
    deep = html_text.blocks_of("<div>" * 3000 + "deep" + "</div>" * 10)
    assert [b.text for b in deep] == ["deep"]


def test_gradients():
    rng = np.random.default_rng(0)
    model = html_text.Labeller()
    d = html_text.PATH_DIM + html_text.WORD_DIM + html_text.NUMBERS
    x = rng.normal(size=(5, 3, d)).astype(np.float32)
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    y = rng.integers(0, 2, (5, 3)).astype(np.float32)

    def loss():
        s = model.scores(x, mask).astype(float)
        return (np.logaddexp(0, s) - y * s)[mask].sum()

    grad, _ = model.gradients(x, mask, y)
    for name in ("xf", "hf", "cb", "hb", "out", "bias"):
        w = model.p[name]
        at = tuple(rng.integers(0, n) for n in w.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = loss()
        w[at] = old - 1e-2
        down = loss()
        w[at] = old
        assert (up - down) / 2e-2 == pytest.approx(grad[name][at], rel=0.05, abs=2e-2)


def test_unseen_layouts(model):
    right = total = 0
    for k in range(150):
        page, main = html_text.PageGrammar(random.Random(5_000_000 + k)).page()
        blocks = html_text.blocks_of(page)
        label = model.label([html_text.inputs_of(blocks, html_text.WordCodes())])[0]
        want = np.array([any(a <= b.at < z for a, z in main) for b in blocks])
        right += ((label >= 0.5) == want).sum()
        total += len(blocks)
    assert right / total > 0.99


def test_pages_against_their_article(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        article = r.html.split("<article>", 1)[1].split("</article>")[0]
        want[r.page_id] = " ".join(html.unescape(re.sub("<[^>]+>", " ", article)).split())
    got = html_text.extract(pages, model).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


def test_common_layouts(model):
    story = "".join(f"<p>This is paragraph {k} of the story, which tells what happened in the town that day.</p>" for k in range(6))
    page = f"""<html><body><header><h2>The Daily Site</h2></header><nav><a href=a>Home</a> <a href=b>News</a></nav>
      <div class="cookie-notice"><p>We use cookies to improve this site.</p><button>Accept</button></div>
      <div class="content"><h1>A town wakes up</h1>{story}</div>
      <div class="comments"><div class="comment"><p>I was there and did not see any of it at all.</p></div></div>
      <aside><h3>Related</h3><ul><li><a href=c>Another story</a></li></ul></aside>
      <form><label>Search</label><input><button>Go</button></form>
      <div id="footer">&copy; 2020 The Daily Site. All rights reserved.</div></body></html>"""
    got = text_of(model, page)
    assert got.startswith("A town wakes up This is paragraph 0") and got.endswith("in the town that day.")


def test_null_empty_repeated_and_no_pages(spark, model):
    rows = [(1, "u", None, 5), (2, None, "", 5), (3, "u", "<p>", 5), (None, "u", "<article><p>Hi there, all of you.</p></article>", 5),
            (3, "u", "<p>", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_text.extract(pages, model).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, "Hi there, all of you."), (1, ""), (2, ""), (3, ""), (3, "")]
    assert html_text.extract(pages.limit(0), model).count() == 0
