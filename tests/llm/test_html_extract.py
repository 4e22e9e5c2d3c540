import time

import numpy as np
import pytest
from pages_by_hand import PAGES
from pyspark.sql import functions as F

from eventlake.llm import html_extract as x


@pytest.fixture(scope="module")
def net():
    return x.trained()


def texts(source):
    return x.Blocks(source).texts


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        ("<p>a <b>b</b>c<p>d", ["a bc", "d"]),
        ("<p>&lt;x&gt; &amp; &eacute;&#233;&#x41; &copy; &nbsp; z</p>", ["<x> & ééA © z"]),
        ("<script>var t='</p>';</script><style>p{}</style>x<!-- <p>no</p> -->y", ["xy"]),
        ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
        ("<div class='a>b'>in</div>", ["in"]),
        ("a<br>b", ["a", "b"]),
        ("1 < 2 <3", ["1 < 2 <3"]),
        ("<head><title>t</title></head><body>b", ["b"]),
        ("<!-- open <p>x", []),
        ("<script>open", []),
        ("</div></p>x", ["x"]),
        ("<p title=\"unclosed>x</p>", ["x"]),
        ("", []),
    ],
)
def test_blocks(source, blocks):
    assert texts(source) == blocks


@pytest.mark.parametrize(
    "source",
    ["<div>x" * 100_000, "<span>x" * 100_000, "<span><p>x" * 50_000, "<ul><li>x" * 50_000, "<table><tr><td>x" * 30_000, "<b>" * 100_000 + "</i>" * 100_000, "<svg>x" * 100_000, "<!" * 100_000, "<a" * 100_000, "<!-- " * 100_000, "<a 'x>y \"" * 50_000],
)
def test_linear_in_the_page(source):
    """100 000 tags that nest, or never end, take seconds."""
    began = time.process_time()
    x.Blocks(source)
    assert time.process_time() - began < 10


def test_open_elements_as_a_walk_over_the_stack_tells():
    """Paths, leaves and depths that are kept up as elements come and go are those of the elements that are open."""
    for seed in range(60):
        source = x.page(seed)[0]
        found, open_ = x.Blocks(source), []
        keep = x._Open.push, x._Open.cut

        def push(self, tag, path):
            keep[0](self, tag, path)
            open_.append((tuple(self.stack), dict(self.path), self.leaf))

        def cut(self, place):
            keep[1](self, place)
            open_.append((tuple(self.stack), dict(self.path), self.leaf))

        x._Open.push, x._Open.cut = push, cut
        try:
            assert x.Blocks(source).paths == found.paths
        finally:
            x._Open.push, x._Open.cut = keep
        for stack, path, leaf in open_:
            assert set(path) == {h for _, hashes in stack for h in hashes}
            assert leaf == next((t for t, _ in reversed(stack) if t in x._BLOCK), "")


@pytest.mark.parametrize(("source", "main"), PAGES)
def test_pages_by_hand(net, source, main):
    assert x.main_texts(net, [source]) == [main]


def test_a_long_page_is_read_in_parts(net, monkeypatch):
    """However few vectors are there at once, a page's labels are the same."""
    sources = [PAGES[0][0], "<article>" + "<p>One more paragraph of plain words here.</p>" * 300 + "</article>", None, PAGES[1][0]]
    whole = x.main_texts(net, sources)
    monkeypatch.setattr(x, "VECTORS_AT_ONCE", 7)
    monkeypatch.setattr(x, "BLOCKS_AT_ONCE", 10)
    assert x.main_texts(net, sources) == whole
    assert whole[1].count("paragraph") == 300


def test_every_word_counts():
    """Blocks that differ in a word after the 64th, or the 2000th, alone have other word features."""
    words = lambda block: x.Blocks(f"<p>{block}</p>").vectors()[0, x.PATH : x.PATH + x.WORDS]
    for n in (70, 2001):
        same = "plain " * n
        assert (words(same + "alpha") != words(same + "gamma")).any()
        assert (words(same + "alpha alpha") != words(same + "alpha plain")).any()


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(0)
    net = x.Labeller(1)
    vectors, mask = x._padded([rng.random((4, x.SIZE)), rng.random((2, x.SIZE))])
    vectors, y = vectors.astype(float), np.array([[1.0, 0], [0, 1], [1, 0], [0, 0]])

    def loss():
        p = net.probabilities(vectors, mask)
        return float(-(np.log(np.where(y > 0, p, 1 - p)) * mask).sum() / mask.sum())

    slopes = net.gradients(vectors, mask, y)
    for name, values in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in values.shape)
            kept = values[at]
            values[at] = kept + 1e-5
            up = loss()
            values[at] = kept - 1e-5
            down = loss()
            values[at] = kept
            assert slopes[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_held_out_pages(net):
    right = total = 0
    for seed in range(50_000, 50_120):
        vectors, y = x.labelled(seed)
        if len(y):
            v, mask = x._padded([vectors])
            right += int(((net.probabilities(v, mask)[:, 0] >= 0.5) == y).sum())
            total += len(y)
    assert right / total > 0.97


PAGE = (
    "<html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav><header class='site-header'><p>The daily</p></header>"
    "<article><h1>A title of some words</h1><p>First paragraph with a good number of words in it, and a <a href='/l'>link</a> too.</p><div class='ad'>Buy now</div>"
    "<p>Second &amp; last paragraph,\n over   two lines.</p></article><aside class='sidebar'><h3>Related</h3><a href='/r'>Other story</a></aside>"
    "<section class='comments'><p>Great article, thanks!</p></section><form><label>Your name</label></form><footer>&copy; 2020 All rights reserved</footer></body></html>"
)


def test_main_text(spark, net):
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (1, "u", PAGE), (None, "w", "<p>"), (4, "x", "<article>" + "<p>One more paragraph of plain words here.</p>" * 4000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("text", "n_chars", "label")})
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in x.extract(df, net).collect()), key=repr)
    main = "A title of some words First paragraph with a good number of words in it, and a link too. Second & last paragraph, over two lines."
    long = " ".join(["One more paragraph of plain words here."] * 4000)
    assert got == sorted([(1, "u", main, len(main))] * 2 + [(2, None, "", 0), (3, "v", "", 0), (None, "w", "", 0), (4, "x", long, len(long))], key=repr)
    assert x.extract(df.limit(0), net).count() == 0
