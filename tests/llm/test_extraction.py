"""Regions against brute force, fixtures of page layouts, held-out pages, odd rows."""

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rawgate.llm.extraction import IS_WORD, KINDS, PRIOR, best_region, examples_of, extract, extracted, learn, train
from rawgate.llm.registry import QUERIES
from tests.llm.conftest import prose

PAGES = "/root/testdata/sf0.01/pages.parquet"


def test_best_region_against_all_regions():
    rng = np.random.default_rng(6)
    for _ in range(300):
        scores = rng.integers(-4, 5, rng.integers(0, 12)).astype(float)
        best = max([0.0] + [scores[i:j].sum() for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
        first, stop = best_region(scores)
        assert scores[first:stop].sum() == best
        assert (first, stop) == (0, 0) or best > 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("words alone", "words alone"),
        ("<p>One.<p>Two<br>lines &amp; <b>bold</b>.</p>", "One.\n\nTwo lines & bold."),
        ("<p>a&nbsp;b \n\t c&#x41;&lt;d &am e&amp</p>", "a b cA<d &am e&"),
        ("<p>x < y and <!-- hidden --> z</p><!-- open", "x < y and z"),
        ("<script>var t='</p>words words';</script><p>kept</p><style>p{}</style><script>open words", "kept"),
        ("<nav><ul><li><a>Home</a><li><a>News</a></ul></nav><p>The story of it.</p><footer>foot words</footer>", "The story of it."),
        ("<article><h1>T</h1><p>One two.</p><div class='comments'><p>A long reader comment.</p></div></article>", "T\n\nOne two."),
        ("<p>Before it.</p><div class='ad-box'>Buy this</div><p>After it.</p>", "Before it.\n\nAfter it."),
        ("<main><p>Some words.</p></main><div>Other words here too.</div>", "Some words."),
        ("<div class='layout no-sidebar'><p>Kept words here.</p></div>", "Kept words here."),
        ("<div hidden>secret words</div><p>seen</p><div style='display: none'>more</div>", "seen"),
        ("<p>tail <a title='a>b' href=don't>link</a><p>end of it", "tail link\n\nend of it"),
        ("<form><label>Name</label><input><select><option>x</select></form><p>Text.</p>", "Text."),
        ("<div role=navigation>Go here and there</div><p>Body text.</p>", "Body text."),
        ("<P>Upper <B>case</B> tags</P>", "Upper case tags"),
        ("<p>unended tag <b", "unended tag"),
    ],
)
def test_layouts(page, text):
    assert extract(page) == text


def test_most_of_a_page_is_not_boilerplate_for_its_class():
    body = "<p>The only text of this page stands here.</p>" * 4
    assert extract(f"<div class='sidebar'>{body}</div>").count("only text") == 4
    assert extract(f"<div class='comments'>{body}</div><p>Short article.</p>") == "Short article."


def test_long_page_is_whole():
    words = prose(random.Random(1), 200_000)
    assert extract(f"<nav><a>x</a></nav><article><p>{words}</p></article>") == words


def test_deep_and_broken_markup_ends():
    assert extract("<div>" * 3000 + "word" + "</p>" * 3000) == "word"
    assert extract("<a title='" * 2000 + "x") in ("", "x")


def truth(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_query_on_pages(spark):
    """Every page of the given table, against its article cut out by hand."""
    want = {r["page_id"]: (r["url"], truth(r["html"])) for r in spark.read.parquet(PAGES).collect()}
    got = {r["page_id"]: r for r in QUERIES["op13_html_extraction"](spark, "/root/testdata/sf0.01").collect()}
    assert {i: (r["url"], r["text"]) for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_learned_weights_need_no_marks_and_no_names(spark):
    """Learned on one half of the pages, tried on the other, without article tags and without names of boilerplate."""
    pages = [r["html"] for r in spark.read.parquet(PAGES).orderBy("page_id").collect()]
    weights = learn([x for page in pages[::2] for x in examples_of(page)])
    assert ((weights > 0) == IS_WORD).all()
    assert len(weights) == len(KINDS)
    wrong = 0
    for page in pages[1::2]:
        plain = re.sub(r"(</?)(article|nav|footer)>", r"\1div>", page).replace(' class="ad"', "")
        wrong += extract(plain, weights) != truth(page)
    assert wrong <= len(pages) // 100
    assert sum(extract(re.sub(r"(</?)(article|nav|footer)>", r"\1div>", p).replace(' class="ad"', ""), PRIOR) != truth(p) for p in pages[1::2]) > wrong


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "n", "<p>null id</p>"), (3, "r", "<p>again</p>"), (3, "r", "<p>again</p>"), (4, "e", "<nav>x</nav>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("id", F.lit(0))
    got = sorted((tuple(r) for r in extracted(frame).collect()), key=str)
    want = [(1, "u", ""), (2, None, ""), (None, "n", "null id"), (3, "r", "again"), (3, "r", "again"), (4, "e", "")]
    assert got == sorted(want, key=str)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extracted(none).collect() == []
    assert (train(none) == PRIOR).all()
