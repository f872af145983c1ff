import html
import itertools
import random
import re

import numpy as np
import pytest

from twinledger.llm import main_text as M


def wanted(source):
    """What the article of a test page says; blocks there are h1, p, br and div."""
    article = re.search(r"<article>(.*?)(?:</article>|\Z)", source or "", re.S)
    if not article:
        return ""
    blocks = re.sub(r"</?(?:p|h1|br|div)>", " ", article[1])
    return " ".join(html.unescape(re.sub(r"</?b>", "", blocks)).split())


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@pytest.fixture(scope="module")
def trees(pages):
    return M.learn(M.training_pages(pages))


def test_every_page_of_the_table(spark, pages, sf_dir):
    for folder in (sf_dir, "/root/testdata/sf0.01"):
        frame = spark.read.parquet(f"{folder}/pages.parquet")
        sources = {r.page_id: r.html for r in frame.collect()}
        got = M.main_texts(frame).collect()
        assert len(got) == len(sources)
        wrong = [r.page_id for r in got if r.text != wanted(sources[r.page_id]) or r.n_chars != len(r.text)]
        assert wrong == []


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body>
<header><a href="/">Logo</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-consent">We use cookies.</div>{open}<h1>Big &amp; small</h1>
<p>It was a bright <b>c</b>old day, and the clocks were striking thirteen. <!-- not this -->Winston went.</p>
<script>var x = "<p>no</p>";</script><div class="ad">Buy this now.</div><p>Second&nbsp;paragraph,
with <a href="/x">a link</a> in it; it goes on for a while.<p>Unclosed third one, short.
<form><label>Mail</label><input name="m"><button>Send</button></form>
<section class="comments"><p>Great article, thanks a lot for it.</p><p>Me too, I think.</p></section>{close}
<aside class="sidebar"><ul><li><a href="/p">Popular</a></li></ul></aside><footer>&copy; us. All rights reserved.</footer></body></html>"""
TEXT = "Big & small It was a bright cold day, and the clocks were striking thirteen. Winston went. Second paragraph, with a link in it; it goes on for a while. Unclosed third one, short."


@pytest.mark.parametrize("mark", ["article", "main", 'div class="post-content"', 'div id="main"', "section", "div"])
def test_other_layouts(trees, mark):
    source = PAGE.format(open=f"<{mark}>", close=f"</{mark.split()[0]}>")
    assert list(M.extract([source], trees)) == [TEXT]


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 9)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        logits = np.array([rng.uniform(-3, 3) for _ in range(n)])
        kept = M.decode(parent, logits)
        assert all(kept[parent[i]] or not kept[i] for i in range(1, n))
        best = max(sum(logits[i] for i in range(n) if c[i]) for c in itertools.product((True, False), repeat=n) if c[0] and all(c[parent[i]] or not c[i] for i in range(1, n)))
        assert sum(logits[i] for i in range(n) if kept[i]) == pytest.approx(best)


def test_trees_learn_what_they_are_shown():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(4000, 5)).astype(np.float32)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 1] * rows[:, 2] > 0)).astype(float)
    trees = M.fit(rows[:3000], labels[:3000])
    assert ((trees.logits(rows[3000:]) > 0) == labels[3000:]).mean() > 0.95
    again = M.fit(rows[:3000], labels[:3000])
    assert (again.leaf == trees.leaf).all() and (again.feature == trees.feature).all()


def test_held_out_variants(pages, trees):
    """Nodes of pages that the trees have not seen, in layouts they have not seen."""
    sources = [r.html for r in pages.sparkSession.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()][:60]
    right = total = 0
    for number, source in enumerate(sources):
        page = M.parse(source)
        own, told = M.variant(page, M.seeds(page), random.Random(1000 + number))
        rows = M.features(own)
        kept = M.decode(own.parent, np.where(rows[:, M.CHARS] > 0, trees.logits(rows), 0.0))
        runs = [i for i, t in enumerate(own.tag) if t == "#text" and own.text[i].strip()]
        right += sum(kept[i] == told[i] for i in runs)
        total += len(runs)
    assert right / total > 0.98


def test_hard_pages(spark, pages, trees):
    deep = "<div>" * 20_000 + "deep" + "</section>" * 20_000
    long = "<article><p>" + "word, " * 300_000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (None, None, "<article><p>No id here, a sentence.</p></article>"), (3, "u", "plain text without a tag"), (4, "u", deep), (5, "u", long), (5, "u", long),
            (6, "u", "<article><p>cut of&am"), (7, "u", "<article><p>a < b and c > d, so what</p><p class='x"), (8, "u", "<!-- only"), (9, "u", "<"), (10, "u", "<article></article>")]
    made = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars", "2 as source").repartition(2)
    got = sorted(M.main_texts(made, trees).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and by[1].text == by[2].text == by[8].text == by[10].text == "" and by[1].n_chars == 0
    assert by[5].text == ("word, " * 300_000).strip() and by[5].n_chars == len(by[5].text)
    assert by[6].text == "cut of&am" and by[None].text == "No id here, a sentence." and by[7].text == "a < b and c > d, so what"
    assert M.main_texts(pages.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, "u", "<p>no mark in the only page</p>")], "page_id long, url string, html string")
    assert M.main_texts(nothing).first().text == "no mark in the only page"


def test_text_behind_a_block_is_parted(trees):
    page = M.parse("<article>one<div>two</div>three <i>fo</i>ur<br>five</article>")
    assert M.text_of_nodes(page, [True] * len(page.tag)) == "one two three four five"
