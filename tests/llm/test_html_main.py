import pytest

from tallyboard.llm import html_main
from tallyboard.llm.html_tree import Nodes, Pages

LONG = "Words that make up a paragraph of some length, as an article has many of them. It goes on for a while, and ends here."


@pytest.fixture(scope="module")
def model():
    return html_main.train()


def one(model, page):
    return model.texts([page])[0]


def page(main, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{before}{main}{after}</body></html>"


def test_decoding_is_the_best_of_all_choices():
    """On trees of up to 12 nodes: no choice that keeps children below their parents is likelier than the decoded one."""
    import itertools
    from types import SimpleNamespace

    import numpy as np

    rng = np.random.default_rng(5)
    for n in [1, 2, 3] + [int(x) for x in rng.integers(4, 13, 40)]:
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        flat = SimpleNamespace(page=[0] * n, parent=parent, kind=[6] * n, hints=[0] * n, **{c: [0] * n for c in ("chars", "words", "links", "stops", "tags", "controls")})
        p = rng.uniform(0.02, 0.98, n)
        got = Nodes(flat).decode(p)
        value = lambda chosen: sum(np.log(p[i] if c else 1 - p[i]) for i, c in enumerate(chosen))
        allowed = [c for c in itertools.product((False, True), repeat=n) if all(not c[i] or c[parent[i]] for i in range(1, n))]
        assert all(not got[i] or got[parent[i]] for i in range(1, n))
        assert abs(value(got) - max(map(value, allowed))) < 1e-9


def test_a_deep_page_takes_time_by_its_length(model):
    """Open elements of one name, of several, and ends without a beginning: a hundred thousand deep."""
    import time

    deep = 100_000
    start = time.time()
    for source in ("<div>" * deep + f"<p>{LONG}</p>", "<div>" * deep + LONG + "</div>" * deep, "<ul><li>" * (deep // 2) + LONG, "<div>" * deep + "</nav>" * deep + LONG):
        pages = Pages()
        pages.add(source)
        found = pages.arrays()
        assert len(found.levels) == len(set(found.depth.tolist())) > deep // 2 and max(pages.words) == len(LONG.split())
    assert time.time() - start < 60


def test_article_without_what_is_around_it(model):
    nav = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
    after = (f'<section class="comments"><h3>Comments</h3><div class="comment"><p>{LONG}</p></div></section><aside><p>{LONG}</p></aside>'
             f'<form><label>Mail</label><input><button>Go</button></form><footer>&copy; me {LONG}</footer>')
    main = f"<article><h1>Title &amp; more</h1><p><b>First\n  part<br>and second<p>{LONG}</p><ul><li>item one.</li><li>item two.</ul><p>Short.</p></article>"
    for before in (nav, nav + f'<div class="ad">{LONG}</div>', nav + f'<div class="cookie-notice"><p>{LONG}</p></div>', "<!-- ad -->" + nav):
        assert one(model, page(main, before, after)) == "\n\n".join(["Title & more", "First part and second", LONG, "item one.", "item two.", "Short."])


def test_article_in_a_plain_div(model):
    main = f'<div class="post-content"><h1>Heading here</h1><p>{LONG}</p><p>{LONG} &lt;again&gt;</p><div class="ad"><p>{LONG}</p></div><p>{LONG}</p></div>'
    assert one(model, page(main, '<div class="menu"><a href=x>A</a> <a href=y>B</a></div>', '<div class="footer"><p>Imprint</p></div>')) == "\n\n".join(
        ["Heading here", LONG, f"{LONG} <again>", LONG])


def test_broken_pages(model):
    for text in ("", "<", "<a", "<p", "</", "<!--", "<script>x", "<p class='", "&", "<>", "<p a=\"<b>\">"):
        assert isinstance(one(model, text), str)
    assert LONG in one(model, f"<article><h1>A title</h1><p>{LONG}<p>{LONG}")
    deep = "<div>" * 3000 + f"<p>{LONG}</p>"
    assert isinstance(one(model, deep), str)


def read(source):
    pages = Pages()
    pages.add(source)
    return " ".join(t for t in pages.texts if t)


def test_head_without_its_end(model):
    for top in ("<head><title>T</title>", "<html><head><meta charset=x><!-- <p> --><script>var a='<p>x</p>';</script><link href=a>\n<style>b{}</style>"):
        assert one(model, f"{top}<article><h1>A title</h1><p>{LONG}<p>{LONG}</article>") == "\n\n".join(["A title", LONG, LONG])
        assert read(f"{top}words <p>more") == "words more"
    assert read("<head><title>T</title></head ><p>a") == read("<head><meta a=b></meta><body><p>a") == "a" and read("<head><title>T") == ""


def test_math_is_text():
    assert read("<p>For <math><mi>x</mi> <mo>=</mo> <mn>2</mn><annotation encoding=tex>x=2</annotation></math> it holds.") == "For x = 2 it holds."


def test_table(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "v", page(f"<article><h1>Caf&eacute; &#8364;</h1><p>{LONG}</p></article>"), "x"), (3, "v", "<p></p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_main.extract(df).collect()), key=str)
    text = f"Café €\n\n{LONG}"
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (3, "v", text, len(text)), (3, "v", "", 0)], key=str)
    assert html_main.extract(df.limit(0)).count() == 0


def test_held_out_made_up_pages(model):
    maker, pages = html_main._Maker(123), Pages()
    for _ in range(80):
        pages.add(maker.page())
    nodes, keep = pages.arrays(), []
    for mark, parent in zip(pages.marks, pages.parent):
        keep.append(mark == "1" or mark == "" and parent >= 0 and keep[parent])
    chosen = nodes.decode(model.trees.probability(nodes.features()))
    leaves = [i for i, t in enumerate(pages.texts) if t]
    assert sum(chosen[i] == keep[i] for i in leaves) >= 0.97 * len(leaves)
    assert all(chosen[pages.parent[i]] for i in range(len(keep)) if chosen[i] and pages.parent[i] >= 0)
