import html as H
import re

import numpy as np
import pytest

from daystream.llm import block_lstm as L
from daystream.llm import html_extract as X
from daystream.llm.html_blocks import Block, blocks
from daystream.llm.page_makes import MARK, Maker


@pytest.fixture(scope="module")
def model(spark):
    return X.fit(X.pool_of(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")), made=700)


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_odd_markup():
    assert texts(None) == texts("") == texts("<p></p> \n<div>&nbsp;</div>") == []
    assert texts("plain &lt;b&gt; &eacute;&#233;&#xe9; a &amp b") == ["plain <b> ééé a & b"]
    assert texts("<p>a<b>b</b>\n c<p>d<ul><li>e<li>f</ul>g<br>h") == ["ab c", "d", "e", "f", "g h"]
    assert texts("<script>if (a<b) '<p>x</p>'</script><style>p{}</style><!-- <p>no</p> -->yes<title>t</title>") == ["yes"]
    assert texts("<p title='a > b' class=\"x\">in</p><p hidden>no</p><div style='display: none'>no<p>no</p></div>out") == ["in", "out"]
    assert texts("a < b and 3<4 <p>done</p") == ["a < b and 3<4", "done"]
    assert texts("x</p></div></table>y<td>z") == ["x", "y", "z"]
    assert texts("start <p class='cut") == ["start"] and texts("<p>x <!-- never closed") == ["x"]
    (b,) = blocks('<div class="main-content fooBar" id=top><p>a <a href=x>link</a>')
    assert b.path == (("div", ("main", "content", "foo", "bar", "top")), ("p", ())) and b.linked == 4


def test_gradients():
    r = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in L.start().items()}
    x, mask = L.pad([r.random((5, L.INPUT)), r.random((3, L.INPUT))])
    y = (r.random(mask.shape) > .5) * mask
    _, g = L.gradients(w, x, mask, y)
    for k in w:
        i = tuple(r.integers(0, s) for s in w[k].shape)
        up, down = ({**w, k: w[k].copy()} for _ in range(2))
        up[k][i] += 1e-3
        down[k][i] -= 1e-3
        slope = (L.gradients(up, x, mask, y)[0] - L.gradients(down, x, mask, y)[0]) / 2e-3
        assert g[k][i] == pytest.approx(slope, abs=2e-5, rel=2e-2)


def test_held_out_pages(model):
    maker = Maker(["some words of a text", "and others, of another one."], 987)
    right = total = 0
    for _ in range(200):
        page = blocks(maker.page())
        y = np.array([MARK in b.text for b in page])
        p = L.predict(model, [L.inputs([Block(b.text.replace(MARK, "") or "-", b.path, b.linked) for b in page])])[0] >= .5
        right, total = right + (p == y).sum(), total + len(y)
    assert right / total > 0.95


def gold(page):
    m = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    parts = re.sub(r"<[^>]*$", "", re.sub(r"<(b|/b|br)>", " ", re.sub(r"</?(p|h1)>", "\0", m[1] if m else ""))).split("\0")
    return "\n".join(x for x in (" ".join(H.unescape(p).split()) for p in parts) if x)


def test_provided_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: (r.url, gold(r.html)) for r in pages.collect()}
    out = X.extract(pages, model=model).collect()
    assert len(out) == len(want) and all(r.n_chars == len(r.text) and r.url == want[r.page_id][0] for r in out)
    assert sum(r.text == want[r.page_id][1] for r in out) / len(out) > 0.98


def test_odd_rows(spark, model):
    body = "<p>" + "A sentence of the article, long enough. " * 5 + "</p>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><h1>A title of the article</h1>" + body + "</article>"), (4, "u", "<nav>" + "<a href=x>y</a>" * 9 + "</nav>"),
            (5, "u", "<article>" + body * 3000 + "</article>"), (5, "u", "<article>" + body + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "'x' as n_chars")
    out = X.extract(df, model=model).collect()
    by = {(r.page_id, r.n_chars > 10000): r for r in out}
    assert len(out) == 6 and by[(1, False)].text == by[(2, False)].text == "" and by[(2, False)].url is None
    assert by[(None, False)].text.startswith("A title of the article\nA sentence") and by[(5, True)].text.count("\n") == 2999
    assert X.extract(df.limit(0), model=model).count() == 0


def test_elements_that_are_never_shown_take_no_more_than_they_hold():
    def texts(page):
        return [b.text for b in blocks(page)]
    for odd in ("<svg-icon></svg-icon>", "<template-card></template-card>", "<title-bar></title-bar>", "<svg class=i />", "<object data=x>", "<canvas>", "<math/>",
                "<svg><path d=m></svg>", "<object><section>no<p>no</object>", "<template><div>no</div></template>", "<script>no</script >", "<style>no</style>"):
        assert texts(f"<p>a</p>{odd}<p>rest</p>") == ["a", "rest"], odd
    assert texts("<p>a</p><svg class=i /><p>b</p><svg><text>no</text></svg><p>c</p>") == ["a", "b", "c"]
    assert texts("<p>a <object><p>no</p></object> b</p>c") == ["a b", "c"]
    assert texts("<div>a<svg><text>no<p>b</p></div>c<svg></svg>") == ["a", "b", "c"]


def test_deep_pages_cost_what_they_hold():
    import time

    from daystream.llm import block_lstm
    page = lambda n: "<div>x" * n + "</section></b>" * n
    cost = []
    for n in (10_000, 100_000):
        t = time.process_time()
        b = blocks(page(n))
        assert len(b) == n and block_lstm.inputs(b).shape[0] == n and b[-1].path.depth == n
        cost.append(time.process_time() - t)
    assert cost[1] < 40 * cost[0] + 1  # ten times the page; copied paths would take a hundred times
    assert len(blocks("<noscript>" + "<div>x" * 50_000 + "</noscript><p>y")) == 1


def test_nothing_visible_is_left_out_before_the_labeller():
    b = blocks('<article><p aria-hidden="true">seen</p><p class="' + " ".join(f"c{i} x" for i in range(30)) + ' last">named</p></article>')
    assert [x.text for x in b] == ["seen", "named"]
    assert "last" in b[1].path.names and b[0].path == (("article", ()), ("p", ()))
