"""Main text: parsing by cases, decoding by brute force, trees on pages they have not seen."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sequon.llm import dom, main_text, queries
from sequon.llm.layouts import Layout

FOLDER = "/root/testdata/sf0.01"


def runs(text):
    return [r for r in dom.parsed(text).run if r is not None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a <b>b</b>c<br>d<p>e", ["a bc d", "e"]),
        ("<p>a\n\t b</p>tail", ["a b", "tail"]),
        ("<ul><li>x<li>y</ul>", ["x", "y"]),
        ("<table><tr><td>1<td>2<tr><th>3</table>", ["1", "2", "3"]),
        ("x<script>var a='</p>';</script>y", ["xy"]),
        ("x<!-- <p>no</p> -->y<!-- open", ["xy"]),
        ("<div title='a>b'>in</div>", ["in"]),
        ("<p hidden>no</p><p style='display: none'>no</p>yes", ["yes"]),
        ("<form><select><option>o</select><button>b</button>text</form>", ["text"]),
        ("<head><title>t</title><body>b", ["b"]),
        ("<title>t</title><p>&eacute;&#8212;&lt;p&gt;", ["é—<p>"]),
        ("<textarea>never ends", []),
        ("a < b and </ c", ["a < b and"]),
        ("</p></div>x<p", ["x"]),
        ("<a href='x'>l</a><p class=\"it's\">m", ["l", "m"]),
    ],
)
def test_runs(text, expected):
    assert runs(text) == expected


def test_nodes_are_in_page_order():
    page = dom.parsed("<div><p>a</p>b<ul><li>c</ul></div><p>d")
    assert page.tag == ["#page", "div", "p", "#text", "#text", "ul", "li", "#text", "p", "#text"]
    assert page.end == [10, 8, 4, 4, 5, 8, 8, 8, 10, 10]
    assert page.parent == [-1, 0, 1, 2, 1, 1, 5, 6, 0, 8]


def test_deep_and_long_pages():
    page = dom.parsed("<div>" * 20_000 + "x")
    rows = dom.measured([page], dom.TokenOdds({}))
    assert len(rows) == 20_002
    assert all(dom.decoded(page, rows[:, 4] - 0.5))
    assert runs("x<p " + "a='" * 3_000) == ["x"]
    assert len(runs("word " * 400_000)[0]) == 1_999_999


def test_measures_of_one_page_do_not_depend_on_others():
    odds = dom.TokenOdds({"<p>": 1.0, "menu": -2.0})
    pages = [dom.parsed(Layout(s, [], []).page()) for s in range(30)]
    whole, begin = dom.measured(pages, odds), 0
    for page in pages:
        end = begin + len(page.tag)
        assert (whole[begin:end] == dom.measured([page], odds)).all()
        begin = end


def test_unknown_tokens_may_hold_known_ones():
    odds = dom.TokenOdds({"comment": -3.0, "list": -1.0, "<p>": 2.0})
    assert odds.of(("commentlist",)) == (-2.0, -2.0)
    assert odds.of(("<p>", "xyz")) == (2.0, 0.0) and odds.of(()) == (0, 0)


def test_decoding_by_every_choice():
    dice = random.Random(1)
    for _ in range(40):
        page = dom.Page()
        page.open("#page", -1, ())
        for _ in range(8):
            page.open("p", dice.randrange(len(page.tag)), ())
        import numpy as np

        odds = np.array([dice.uniform(-3, 2) for _ in page.tag])
        # Nodes below the last are opened in any order here; only parents matter.
        best = max(
            sum(o for o, k in zip(odds[1:], kept) if k)
            for kept in itertools.product([False, True], repeat=8)
            if all(not k or page.parent[i] == 0 or kept[page.parent[i] - 1] for i, k in enumerate(kept, 1))
        )
        kept = dom.decoded(page, odds)
        assert abs(sum(o for o, k in zip(odds[1:], kept[1:]) if k) - best) < 1e-9
        assert all(not k or kept[page.parent[i]] for i, k in enumerate(kept) if i)


HAND = [
    (
        '<header class="site-header"><p>The best site for gardeners everywhere.</p></header>'
        '<div id="cookie-notice"><p>We use cookies to make this site better for you.</p><button>OK</button></div>'
        '<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav><div class="post-body"><h1>Beans</h1>'
        '<p>Beans grow quickly in warm soil. Sow them in May.</p><div class="ad-banner">Buy cheap beans now.</div>'
        "<p>Water them &amp; wait.</p><ul><li>Soil</ul></div><aside><p>Peas are a good choice as well, in cold soil.</p>"
        '</aside><section id="comments"><h2>Comments</h2><div><p>I loved this article, thank you!</p></div></section>'
        "<footer><p>Copyright 2024. All rights reserved.</p></footer>",
        "Beans Beans grow quickly in warm soil. Sow them in May. Water them & wait. Soil",
    ),
    (
        '<div class="sidebar">Some prose in the sidebar. It goes on.</div><div class="content"><h2>Title</h2>First text'
        ' without any paragraph.<br>Second line.<div class="promo">Special offer for you.</div><p>More text, here.</p>'
        '</div><div class="footer">Contact us at this address, any day of the week.</div>',
        "Title First text without any paragraph. Second line. More text, here.",
    ),
    ("<nav><a href=1>Home</a></nav><footer>&copy; 2020</footer>", ""),
]


@pytest.fixture(scope="module")
def extractor(spark):
    return main_text.learn(spark.read.parquet(f"{FOLDER}/pages.parquet").select("html"))


def test_pages_of_the_table(spark, extractor):
    """Against the article that each page marks."""
    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").select(
        "html", main_text.extract(spark, "html", extractor).alias("text")
    )
    right = 0
    found = rows.collect()
    for row in found:
        page = dom.parsed(row.html)
        main = main_text.marked_by_itself(page)
        right += row.text == " ".join(r for r, m in zip(page.run, main) if m and r is not None)
    assert right >= 0.98 * len(found)


def test_layouts_not_learnt_from(extractor):
    pages = [dom.parsed(Layout(10**6 + s, [], []).page()) for s in range(150)]
    main = [main_text.marked_by_sign(p) for p in pages]
    begin = wrong = right = 0
    odds = extractor.log_odds(dom.measured(pages, extractor.odds))
    for page, marks in zip(pages, main):
        kept = dom.decoded(page, odds[begin : begin + len(page.tag)])
        begin += len(page.tag)
        wrong += sum(len(r) for r, k, m in zip(page.run, kept, marks) if r and k != m)
        right += sum(len(r) for r, k, m in zip(page.run, kept, marks) if r and k and m)
    assert wrong < 0.06 * right


@pytest.mark.parametrize("html, expected", HAND)
def test_pages_by_hand(extractor, html, expected):
    assert " ".join(extractor.runs([dom.parsed(html)])[0]) == expected


def test_query(spark, tmp_path, extractor, monkeypatch):
    monkeypatch.setattr(main_text, "learn", lambda pages: extractor)
    rows = [(1, "u", HAND[0][0], "x"), (1, "u", HAND[0][0], "x"), (None, None, None, None), (2, "v", "", "y")]
    schema = "page_id long, url string, html string, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.op12_main_text(spark, str(tmp_path))
    assert found.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    text = HAND[0][1]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr
    )


def test_no_pages(spark, monkeypatch):
    monkeypatch.setattr(main_text, "TREES", 3)
    monkeypatch.setattr(main_text, "LAYOUTS", 60)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    learnt = main_text.learn(pages)
    assert len(learnt.trees) == 3
    assert pages.select(main_text.extract(spark, "html", learnt)).collect() == []


def test_trees_as_arrays(spark, monkeypatch):
    """Arrays give what Spark's own model gives."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    import numpy as np

    rows = np.random.default_rng(1).normal(size=(300, 4))
    table = spark.createDataFrame(
        [(r.tolist(), float(r[0] * r[1] > 0)) for r in rows], "f array<double>, label double"
    ).select("f", array_to_vector("f").alias("features"), "label")
    model = GBTClassifier(maxIter=4, maxDepth=main_text.DEPTH, seed=1).fit(table)
    own = main_text.Extractor(dom.TokenOdds({}), main_text._arrays(model))
    got = model.transform(table).select("f", vector_to_array("probability")[1].alias("p")).collect()
    odds = own.log_odds(np.array([r.f for r in got]))
    assert np.allclose(1 / (1 + np.exp(-odds)), [r.p for r in got])
