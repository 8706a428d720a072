"""Main text of pages of several shapes, scored from labelled pages."""

import random
import time

import pytest

from farelake.llm import extraction

rng = random.Random(3)
words = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}" for _ in range(n))
MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">{words(1)}</a></li>' for i in range(6)) + "</ul></nav>"
HEAD = '<!DOCTYPE html><html><head><title>t u v w x</title><style>p{}</style><script>var t="</p>";</script></head><body>'
FOOT = "<footer>&copy; someone else entirely; all rights</footer></body></html>"


def page(article, before="", after=""):
    return f'{HEAD}{MENU}<!-- ad --><div class="ad">{words(12)}</div>{before}<article>{article}</article>{after}{FOOT}'


def labelled():
    out = []
    for _ in range(20):
        parts = [words(20) for _ in range(4)]
        out.append((page("<h1>" + parts[0][:30] + "</h1>" + "".join(f"<p>{p}</p>" for p in parts)), "\n".join(parts)))
    return out


SCORES = extraction.fit_scores(labelled())
A, B, C = words(25), words(30), words(8)


def test_scores():
    assert SCORES["word"] > 0 and SCORES["aside"] == 0 <= SCORES["link"] <= SCORES["word"]
    assert all(v < 0 for k, v in SCORES.items() if k[0] == "<")
    assert SCORES["<li"] < SCORES["<p"]


@pytest.mark.parametrize("html,text", [
    (page(f"<h1>{C}</h1><p>{A}</p><p>{B}</p>"), f"{C}\n{A}\n{B}"),
    (page(f"<p><b>{A}<br><p>{B}</p>"), f"{A}\n{B}"),
    (page(f"<p>a&amp;b &lt;x&gt;&nbsp; {A}\n\t y &eacute; &#233; &quot</p>"), f'a&b <x> {A} y é é "'),
    (page(f"<p>{A}</p><aside>{words(80)}</aside><form><label>{words(9)}</label><input></form><p>{B}</p>"), f"{A}\n{B}"),
    (page(f"<p>{A}</p>", before=f"<header><h1>{words(3)}</h1></header>", after=f'<section id="comments"><div class="comment"><p>{words(60)}</p></div></section>'), A),
    (page(f"<p>{A}</p><ul><li><a href=x>{C}</a></li><li>one</li></ul>"), f"{A}\n{C}\none"),
    (page(f"<p>{A}</p>", before=f'<div class="cookie-notice">{words(50)}</div>', after=f'<div role="complementary"><p>{words(50)}</p></div>'), A),
    (f'{HEAD}{MENU}<div class="content"><h2>{C}</h2><p>{A} <a href="x">in a link</a> on</p><p>{B}</p></div><div class="sidebar"><p>{words(40)}</p></div>{FOOT}', f"{C}\n{A} in a link on\n{B}"),
    (f"<p>{A}<p>{B}", f"{A}\n{B}"), (A, A), ("", ""), (None, ""), ("<p></p>", ""), (MENU, ""),
    (page(f'<p title="a > b">{A}</p><p>1 < 2 and <3 {C}</p>'), f"{A}\n1 < 2 and <3 {C}"),
    (page(f"<p>{A}</p><script>if (a < b) {{ document.write('<p>no</p>') }}</script><p>{B}</p>"), f"{A}\n{B}"),
    (f"{HEAD}<p>{A}</p><script>never closed", A),
])
def test_pages(html, text):
    assert extraction.main_text(html, SCORES) == text


@pytest.mark.parametrize("html", ["<a " * 100_000, '<a "' * 100_000, "<!--" * 100_000, "<script>" * 50_000, "<div>" * 100_000 + "x", "<p>w</p>" * 50_000, "&amp;<" * 100_000])
def test_linear_time(html):
    start = time.process_time()
    extraction.main_text(html, SCORES)
    assert time.process_time() - start < 5


def test_region_is_the_best(monkeypatch):
    """Without marks, the scan finds the stretch with the largest sum."""
    scores = {"word": 1.0, "link": 0.2, "aside": 0.0, "<div": -3.0, "</div": -3.0}
    for seed in range(30):
        r = random.Random(seed)
        html = "".join(f"<div>{' '.join('w' + str(r.randrange(99)) for _ in range(r.randrange(9)))}</div>" for _ in range(7))
        tokens = list(extraction.page_tokens(html))
        value = [scores[f"<{v}"] if k == "tag" else len(v.split()) for k, v, _ in tokens]
        best = max(sum(value[i:j]) for i in range(len(tokens)) for j in range(i, len(tokens) + 1))
        got = extraction.main_text(html, scores)
        gaps = got.count("\n")
        assert len(got.split()) - 6 * gaps <= best or not got
        if best > 0:
            assert len(got.split()) >= best


def test_table(spark):
    html = page(f"<p>{A}</p>")
    rows = [(1, "http://x/en/5", html), (None, None, None), (2, "u", ""), (1, "http://x/en/5", html)]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, n_chars int")
    got = sorted((tuple(r) for r in extraction.extracted_pages(pages, SCORES).collect()), key=str)
    assert got == sorted([(1, "http://x/en/5", A, len(A)), (None, None, "", 0), (2, "u", "", 0), (1, "http://x/en/5", A, len(A))], key=str)
    docs = spark.createDataFrame([(5, A), (6, None)], "doc_id long, text string")
    assert extraction.labelled_pages(pages, docs) == [(rows[0][2], A)] * 2
    assert extraction.fit_scores([])["word"] > 0
    assert extraction.extracted_pages(pages.where("false"), SCORES).count() == 0


def test_given_pages(spark):
    """The text of every given page is its document, after the title."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scores = extraction.fit_scores(extraction.labelled_pages(pages, docs))
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in extraction.extracted_pages(pages, scores).collect():
        number = int(extraction.re.search(r"//[^/]*/[a-z]+/(\d+)", r["url"])[1])
        want = "\n".join(filter(None, (" ".join(x.split()) for x in texts[number].split("\n"))))
        title, _, body = r["text"].partition("\n")
        assert body == want and want.startswith(title[:30])


P, Q = words(100), words(120)


@pytest.mark.parametrize("html,text", [
    (f"{HEAD}<main><p>{P}</p><article><p>{Q}</p></article></main>{FOOT}", f"{P}\n{Q}"),
    (f"{HEAD}<main><article><p>{Q}</p></article><p>{P}</p></main>{FOOT}", f"{Q}\n{P}"),
    (f"{HEAD}<article><p>{Q}</p></article><article><p>{P}</p></article>{FOOT}", f"{Q}\n{P}"),
    (f"{HEAD}<article><p>{Q}</p></article><p>{P}</p>{FOOT}", f"{Q}\n{P}"),
])
def test_text_outside_one_holder(html, text):
    assert extraction.main_text(html, SCORES) == text


@pytest.mark.parametrize("html,text", [
    (f"{HEAD}<div class='elementor-widget'><p>{P}</p><p>{Q}</p></div>{FOOT}", f"{P}\n{Q}"),
    (f"{HEAD}<div class='widget'><article><p>{Q}</p></article></div>{FOOT}", Q),
    (page(f"<div class='elementor-widget'><p>{P}</p></div>"), P),
    (page(f"<header class='entry-header'><h1 class='entry-header'>{C}</h1></header><p>{A}</p>"), f"{C}\n{A}"),
    (page(f"<p>{A}</p><p class='notice'>{C}<p>{B}</p>"), f"{A}\n{B}"),
    (page(f"<p>{A}</p><ul><li class='ad'>{words(5)}<li>{C}</ul><p>{B}</p>"), f"{A}\n{C}\n{B}"),
    (page(f"<p>{A}</p><table><tr><td class='ad'>x<td>{C}<tr><td>{B}</table>"), f"{A}\n{C}\n{B}"),
])
def test_marks_are_weighed_and_ended(html, text):
    assert extraction.main_text(html, SCORES) == text


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'data-hidden="false"', 'title="who plays role=search here"', "data-class='comment ad'", 'data-role="search"',
    'alt="id=sidebar"', "xhidden", 'style="display: block; visibility: visible"'])
def test_attributes_are_parsed(attributes):
    """Words inside other attributes' names and values mark nothing."""
    assert extraction.main_text(f"{HEAD}<div {attributes}><p>{P}</p></div>{FOOT}", SCORES) == P
    assert extraction.main_text(page(f"<p {attributes}>{C}</p><p>{A}</p>"), SCORES) == f"{C}\n{A}"


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN=''", 'style="color: red; display:none"', "style='visibility : hidden'", 'aria-hidden="true"', "role=search", 'class="x" class="y" hidden'])
def test_unshown(attributes):
    assert extraction.main_text(page(f"<p>{A}</p><div {attributes}>{words(70)}</div><p>{B}</p>"), SCORES) == f"{A}\n{B}"


def test_forms_are_weighed():
    inner = f"{MENU}<h1>{C}</h1><p>{P}</p><p>{Q}</p><div><label>{words(2)}</label><input></div>"
    assert P in extraction.main_text(f"{HEAD}<form action=x>{inner}</form>{FOOT}", SCORES)
    assert extraction.main_text(f"{HEAD}<form id=aspnetForm>{MENU}<article><p>{P}</p><form>{words(5)}</form><p>{Q}</p></article></form>{FOOT}", SCORES) == f"{P}\n{Q}"
    assert extraction.main_text(page(f"<p>{P}</p><form class=search><fieldset>{words(9)}</fieldset></form>"), SCORES) == P


@pytest.mark.parametrize("comments", [
    '<article class="comment-body"><p>{0}</p></article><article class="comment-body"><p>{0}</p></article>',
    '<article id="comment-7"><p>{0}</p></article>',
    "<section><h2>Comments</h2><p>{0}</p><div><p>{0}</p></div></section>",
    "<section><header><h3>12 comments</h3></header><article><p>{0}</p></article></section>",
    "<div><h2>3 Replies to this</h2><article><p>{0}</p></article></div>",
])
def test_reader_comments(comments):
    said = comments.format(words(30))
    for html in (page(f"<p>{P}</p><p>{Q}</p>", after=said), page(f"<p>{P}</p><p>{Q}</p>{said}")):
        assert extraction.main_text(html, SCORES) == f"{P}\n{Q}"


def test_fitted_scores_decide():
    """Without article and main, and without telling names, fitted scores find the text where constants don't."""
    constant = {k: -1.0 if k[0] == "<" else 1.0 for k in SCORES} | {"aside": 0.0}
    right = wrong = 0
    for _ in range(40):
        links = "<ul>" + "".join(f"<li><a href=x>{words(7)}</a></li>" for _ in range(12)) + "</ul>"
        parts = [words(rng.randint(8, 40)) for _ in range(5)]
        body = "".join(f"<p>{p}</p>" for p in parts)
        html = f"{HEAD}<div>{links}</div><div>{body}</div><div>{links}</div>{FOOT}"
        right += extraction.main_text(html, SCORES) == "\n".join(parts)
        wrong += extraction.main_text(html, constant) == "\n".join(parts)
    assert right == 40 and wrong == 0


def test_labelled_pages_are_picked_by_content(spark):
    rows = [(i % 3, "http://x/en/5", page(f"<p>{i} {A}</p>")) for i in range(60)] + [(9, "http://x/en/5", "x" * (extraction.LABELLED_BYTES + 1))]
    docs = spark.createDataFrame([(5, A), (5, B)], "doc_id long, text string")
    schema = "page_id long, url string, html string"
    some = extraction.labelled_pages(spark.createDataFrame(rows, schema), docs, most=20)
    assert len(some) == 20
    assert some == extraction.labelled_pages(spark.createDataFrame(rows[::-1], schema).repartition(5), docs, most=20)
