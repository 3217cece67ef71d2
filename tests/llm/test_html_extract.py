import pyarrow.dataset as ds
import pytest

from badgeflow.llm import layouts
from badgeflow.llm.dom import leaf_blocks
from badgeflow.llm.html_extract import Field, extract, features, fit, labelled_pages, op5_html_text, stated, train

PAGES = "page_id bigint, url string, html string"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def htmls():
    return [r["html"] for r in ds.dataset(f"{SF}/pages.parquet").to_table(columns=["html"]).to_pylist()]


@pytest.fixture(scope="module")
def field(htmls):
    return fit(labelled_pages(htmls[:120]))


def plain_text(html):
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, main in zip(blocks, stated(blocks)) if main)


def test_whole_table(spark):
    rows = {r.page_id: r for r in op5_html_text(spark, SF).collect()}
    pages = ds.dataset(f"{SF}/pages.parquet").to_table().to_pylist()
    assert sorted(rows) == sorted(p["page_id"] for p in pages)
    for p in pages:
        row = rows[p["page_id"]]
        assert (row.url, row.text, row.n_chars) == (p["url"], plain_text(p["html"]), len(row.text))


def test_unseen_layouts(htmls, field):
    """Held-out texts, and names of elements that no training page has."""
    plain = [(b, stated(b)) for b in map(leaf_blocks, htmls[150:])]
    articles = [[b.text for b, y in zip(*page) if y] for page in plain]
    others = [b.text for page in plain for b, y in zip(*page) if not y]
    wrong = total = 0
    for html in layouts.set_anew([a for a in articles if a], others, each=2, seed=77):
        blocks = leaf_blocks(html)
        for block, got in zip(blocks, field.decode(blocks)):
            wrong += got != (block.label or 0)
            total += 1
    assert total > 1000 and wrong / total < 0.01
    page = """<body><div id="top-navigation"><a href=/>Home</a> <a href=/x>News</a></div>
      <div class="gdprConsent"><p>We value your privacy and use cookies on this site, as you may know.</p></div>
      <main><h1>A title &amp; more</h1><p>The first paragraph has a good number of words, and it ends.</p>
      <aside class="pull"><p>Read also: ten things to do, and another one.</p></aside>
      <p>The second one,&nbsp;too, has <b>some</b> words in it.<br>Really.</p></main>
      <section class="reader-comments"><div class="comment"><p>I did not like this text at all, to be honest.</p></div></section>
      <div class="site-footer">&copy; 2024 Somebody. All rights reserved.</div><script>var x = "<p>no</p>";</script></body>"""
    blocks = leaf_blocks(page)
    text = [b.text for b, y in zip(blocks, field.decode(blocks)) if y]
    assert text == [
        "A title & more",
        "The first paragraph has a good number of words, and it ends.",
        "The second one, too, has some words in it. Really.",
    ]


@pytest.mark.parametrize(
    "html, texts",
    [
        (None, []),
        ("", []),
        ("plain words", ["plain words"]),
        ("<p>a<p>b</p>c", ["a", "b", "c"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
        ("<div>a <b>b</b>c<br>d\n\t e&eacute;&#x41;&lt;</div>", ["a bc d eéA<"]),
        ("<script>x</script><style>y</style><title>t</title><p>z", ["z"]),
        ("<p>a<!-- b --><![endif]>c<![CDATA[d]]></p>", ["ac"]),
        ("<svg><svg>x</svg>y</svg><p>z</p><select><option>q</select>", ["z"]),
        ("</div></p><p>unmatched</div>", ["unmatched"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p>open <a href=x>link", ["open link"]),
        ("<p>1 < 2 & 3 > 2</p>", ["1 < 2 & 3 > 2"]),
        ("<article><p>one</p><button>x<p>two</p></article><p>three</p>", ["one", "two", "three"]),
        ("<article><p>one</p><video src=a><p>two</p></article><p>three</p>", ["one", "two", "three"]),
        ("<div><select><option>z<p>two</p></div>three", ["two", "three"]),
        ("<p>one</p><button>x<p>y</p></button><video><p>no</p></video><canvas>n</canvas><p>two</p>", ["one", "two"]),
        ("<div>one<button>x</div>two<button>y", ["one", "two"]),
        ("<div><svg><path></div><p>two", ["two"]),
        ("<div><template><div>x</div>y</template>two</div>", ["two"]),
        ("<div><noscript><p>x</div><p>two</p>", ["two"]),
        ("<object><video>x</object>y</video><p>z", ["y", "z"]),
    ],
)
def test_leaf_blocks(html, texts):
    assert [b.text for b in leaf_blocks(html)] == texts


def test_viterbi_finds_the_most_likely_labelling(htmls, field):
    from itertools import product

    for html in htmls[:15]:
        blocks = leaf_blocks(html)[:9]
        emit = [sum(field.weights.get(f, 0.0) for f in own) for own in features(blocks)]

        def value(labels):
            total = field.first[labels[0]] + sum(e for e, y in zip(emit, labels) if y)
            return total + sum(field.step[a, b] for a, b in zip(labels, labels[1:]))

        best = max(product((0, 1), repeat=len(blocks)), key=value)
        assert value(tuple(field.decode(blocks))) == pytest.approx(value(best))


def test_training_raises_the_likelihood_of_its_labels():
    blocks = leaf_blocks("<nav>a</nav><p>b c d</p><p>e f g</p><footer>h</footer>")
    trained = fit([(blocks, [0, 1, 1, 0])] * 3)
    assert trained.decode(blocks) == [0, 1, 1, 0]
    assert Field({}, trained.step * 0, trained.first * 0).decode([]) == []


def test_edges(spark, htmls):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<nav>only</nav>"), (None, "u", htmls[0]), (4, "v", htmls[1]), (4, "v", htmls[1]), (5, "w", "<p>x" * 3000)]
    rows += [(i + 10, "s", h) for i, h in enumerate(htmls[2:40])]
    df = spark.createDataFrame(rows, PAGES)
    field = train(df)
    out = extract(df, field).collect()
    assert len(out) == len(rows)
    assert all(r.text == "" for r in out if r.page_id in (1, 2, 3))
    assert [r.text for r in out if r.page_id is None] == [plain_text(htmls[0])]
    assert len([r for r in out if r.page_id == 4]) == 2
    clash = df.selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS `order`")
    assert sorted(map(str, extract(clash, field).collect())) == sorted(map(str, out))
    none = spark.createDataFrame([], PAGES)
    assert extract(none, train(none)).count() == 0


PLAIN = """<body><div class="menu"><a href=/>Home</a> <a href=/n>News</a></div>
<div class="c{n}"><h1>Title number {n}</h1><p>The first paragraph of page {n} has a number of words, as they do.</p>
<p>Then comes a second one, which says something else about {n}, and that is that.</p></div>
<div class="footer">&copy; 2024 Copyright of somebody</div></body>"""


def test_pages_without_article_elements(spark):
    """A table in which no page says where its article is: menus and footers still go."""
    rows = [(n, "u", PLAIN.replace("{n}", str(n))) for n in range(20)]
    pages = spark.createDataFrame(rows, PAGES)
    for r in extract(pages, train(pages)).collect():
        assert r.text.split("\n")[1:] == [
            f"The first paragraph of page {r.page_id} has a number of words, as they do.",
            f"Then comes a second one, which says something else about {r.page_id}, and that is that.",
        ]
        assert r.text.split("\n")[0] == f"Title number {r.page_id}"
    empty = pages.limit(0)
    assert extract(empty, train(empty)).collect() == []


# Written by hand: (html, main blocks). "|" stands before each block that is main text.
BY_HAND = [
    """<div id=wrap><ul class=topnav><li><a href=1>Start</a><li><a href=2>Blog</a></ul><h2>|Growing tomatoes indoors</h2>
    <div class=post><p>|Tomatoes need light, warmth and more water than you would think.<p>|I keep mine by the south window, and turn the
    pots every other day.</div><div id=sidebar><h3>Archive</h3><ul><li><a href=3>May</a><li><a href=4>June</a></ul></div>
    <div class=comments><p>Anna wrote: thanks a lot for this, mine died last year!</p></div></div>""",
    """<table width=100%><tr><td class=left><a href=a>Products</a><br><a href=b>Prices</a></td><td class=text><b>|The history of the mill</b>
    <p>|The mill was built in 1742 by two brothers, who had come from the coast.</p><p>|It burned down twice, and each time
    the town paid for a new one.</p></td></tr><tr><td colspan=2 class=bottom>&copy; Mill Museum, all rights reserved</td></tr></table>""",
    """<header><a href=/>The Daily</a><form action=/search><input><button>Search</button></form></header>
    <main><h1>|Council votes for new bridge</h1><p>|After five hours of debate, the council voted for the bridge on Tuesday.</p>
    <aside><p>Subscribe to our newsletter, and never miss a story again.</p></aside>
    <p>|Work is to start in spring, the mayor said, if the money comes.</p></main><footer><p>Imprint and privacy policy</p></footer>""",
    """<div class=cookie-banner><p>We use cookies to improve this site, please accept them.</p><button>Accept</button></div>
    <div class=page-content><p>|There are three ways to sharpen a knife, and two of them are wrong.</p><blockquote>|A dull knife is more dangerous
    than a sharp one, said my father.</blockquote><p>|Start with the coarse stone, then take the fine one.</p></div>
    <div class=related-links><a href=x>Ten best pans</a> <a href=y>How to cook rice</a></div>""",
]


def test_pages_labelled_by_hand(field):
    """Layouts that are in neither the table nor the training generator."""
    right = total = 0
    for html in BY_HAND:
        blocks = leaf_blocks(html)
        for block, got in zip(blocks, field.decode(leaf_blocks(html.replace("|", "")))):
            right += got == block.text.startswith("|")
            total += 1
    assert total >= 25 and right / total >= 0.9, (right, total)
