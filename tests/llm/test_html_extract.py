import html as references
import re
import time

import numpy as np

from tickerlake.llm import html_extract as X

PAGES = "page_id long, url string, html string"


def plain_article(page):
    """Text of the given tables' pages: one article of flat paragraphs."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(references.unescape(re.sub("<b>|<br>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def fitted(pages):
    return X.Weights(*X.counted(pages))


MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>All news</a></li></ul></nav>"
LABELLED = [f"<html><body>{MENU}<article><h1>Title {i}</h1><p>{'some words of the article ' * (i + 2)}<p>more of it</article>"
            f"<div class=ad>buy now and save</div><footer>all rights {i}</footer></body></html>" for i in range(20)]


def test_given_pages_equal_their_articles(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in X.extract(df, X.fit(df)).collect()}
    rows = df.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]]["text"] == plain_article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(plain_article(r["html"]))
        assert got[r["page_id"]]["url"] == r["url"]


def test_region_is_the_best_of_all_runs():
    weights = fitted(LABELLED)
    rng = np.random.default_rng(2)
    parts = ["<p>", "</p>", "<li>", "<a href=x>", "</a>", "<div>", "</div>", "one two three", "word", "<td>", "<b>"]
    for _ in range(200):
        page = X.Page(" ".join(rng.choice(parts, rng.integers(1, 25))))
        scores = [weights.of[k][s] * c for k, s, c in zip(page.kinds, page.sides, page.counts)]
        runs = [(sum(scores[i:j]), -j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        first, last = X.region(page, weights)
        best = max(runs, default=(0, 0))
        assert (first < last) == (best[0] > 0)
        if first < last:
            assert abs(sum(scores[first:last]) - best[0]) < 1e-9


def test_page_without_label_by_weights():
    page = ("<body><div id=top><a href=/>Home</a> <a href=x>About us</a></div><div><h2>A title</h2><p>A long\n paragraph &amp; "
            "text&nbsp;with <a href=y>a link</a> in it.<p>Another <b>pa</b>ra of words.<div class=comments><p>First comment with many words</div>"
            "<p>And the last one of them.</div><ul><li><a>x</a><li><a>y</a></ul><div class='cookie-notice'>We use cookies on it</div>")
    assert X.main_text(page, fitted(LABELLED)) == ("A title\n\nA long paragraph & text with a link in it.\n\nAnother para of words.\n\n"
                                                   "And the last one of them.")


def test_elements_that_are_no_content_inside_the_article():
    page = (f"<body>{MENU}<main><article><h1>T</h1><p>One &lt;b&gt; &am<br>two&copy</p><aside>side</aside><form><p>name<input value='>'></form>"
            "<script>var a='</p><p>no';</script><!-- <p>no --><div class='x advert'>buy</div><ul><li>1</li><li><a href=q>2</a></li></ul>"
            "<section id=comments><p>nice</section></article><article class='related'>other</article></main><footer>f</footer>")
    assert X.main_text(page, fitted(LABELLED)) == "T\n\nOne <b> &am two©\n\n1\n\n2"


def test_broken_empty_and_odd_pages():
    weights = fitted(LABELLED)
    assert [X.main_text(p, weights) for p in (None, "", "<p></p>", "<!-- x", "<script>a b c", " \n ")] == [""] * 6
    assert X.main_text("just words < 3 & more", weights) == "just words < 3 & more"
    assert X.main_text("<nav>never closed<p>the words of a page stand here", weights).endswith("the words of a page stand here")
    assert X.main_text("<a title='x>y'>one two</a> three four five six seven eight nine ten eleven twelve of words", weights).startswith("one two")
    assert X.main_text("a b c</p></div></article>b c d", X.Weights({}, {})) == "a b c\n\nb c d"
    page = "<div><div><h1>A title</h1></div><div><p>And the words of the text stand here.</div></div>"
    assert X.main_text(page, weights) == "A title\n\nAnd the words of the text stand here."


def test_long_broken_pages_are_linear():
    weights, start = fitted(LABELLED), time.time()
    for page in ('<a "' * 250_000, "<b>" * 250_000 + "x", '<a x="' + "<p>" * 250_000, "<!--" * 250_000, "<a x='" + '"= "' * 250_000, "<div" * 250_000):
        X.main_text(page, weights)
    long = "<article>" + "<p>word and word</p>" * 100_000 + "</article>"
    assert X.main_text(long, weights).count("\n\n") == 99_999
    assert time.time() - start < 30


def test_tables_and_other_columns(spark):
    weights = fitted(LABELLED)
    rows = [(1, "u", LABELLED[3]), (1, "u", LABELLED[3]), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' as text", "1 as n_chars", "2 as _html")
    got = sorted((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in X.extract(df.drop("_html"), weights).collect())
    text = X.main_text(LABELLED[3], weights)
    assert got == sorted([(0, None, "", 0), (1, "u", text, len(text)), (1, "u", text, len(text)), (2, "v", "", 0)], key=lambda r: r[0])
    empty = df.limit(0)
    assert X.extract(empty, X.fit(empty)).count() == 0


def test_sample_of_labelled_pages_gives_the_same_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    few = X.fit(df, sample_pages=50)
    assert [X.main_text(r["html"], few) for r in df.limit(40).collect()] == [plain_article(r["html"]) for r in df.limit(40).collect()]
