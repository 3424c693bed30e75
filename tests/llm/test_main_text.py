"""Main text against the pages' own article markup, on awkward markup, and on labelled pages held out."""

from __future__ import annotations

import html
import re

import numpy as np

from curbside.llm import main_text, page_examples, queries

SCHEMA = "page_id bigint, url string, html string, text string, n_chars int, blocks int"


def article(page: str) -> str:
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split(r"<h1>|</h1>|<p>|</p>", inner.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_all_pages_give_their_article(spark):
    folder = "/root/testdata/sf0.01"
    wanted = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.op13_main_text(spark, folder).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        assert r.text == article(wanted[r.page_id].html) and r.n_chars == len(r.text) and r.url == wanted[r.page_id].url


def test_awkward_pages(spark):
    words = "word " * 30
    cases = {
        "": "", "   ": "", None: "", "<nav><p>x</p></nav>": "", "<article>": "", "<p": "", "<!-- only": "", "&": "",
        f"<ARTICLE><P>a{words}&amp;&nbsp;&#233;&lt;p&gt;<P>b\t{words}</ARTICLE>": f"a{words}& é<p>\nb {words}".replace(" \n", "\n").rstrip(),
        f'<article><p title="a > b">{words}<i>it</i>al<br>ic</p></article>': f"{words}ital ic",
        f"<main><p>{words}<script>var a='</p>';</script><style>p{{}}</style>end</p></main>": f"{words}end",
        f"<article><p>{words}</p><div class='reader-comments'><p>{words}</p></div><form><p>{words}</p></form></article>": words.strip(),
        f"<article><h1>Ti<b>tle</b></h1><p>{words} 1 < 2 & 3</p></article><aside><p>{words}</p></aside>": f"Title\n{words}1 < 2 & 3",
        f"<article><p>{words}</p><p>So.</p><ul><li>{words}<li>{words}</ul></article>": "\n".join([words.strip(), "So.", words.strip(), words.strip()]),
        f"<article><div class='left'><p>{words}</p></div><div class='sidebar'><p>{words}</p></div><ul class='commentlist'><li>{words}</ul></article>": words.strip(),
        f"<div class='with-sidebar col'><div id='cookiebar'>{words}</div><form><main><header><h1>T</h1></header><p>{words}</main></form></div>": f"T\n{words.strip()}",
        f"<article>{'<p>' + words * 9000}</article>": (words * 9000).strip(),
        f"<div>{'<div>' * 3000}<article><p>{words}</article>": words.strip(),
    }
    data = [(i, "u", page, "clash", 1, 2) for i, page in enumerate(cases)] + [(None, None, None, None, None, None)] * 2
    rows = main_text.extract(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    assert len(rows) == len(data)
    for r in rows:
        want = "" if r.page_id is None else list(cases.values())[r.page_id]
        assert r.text == want and r.n_chars == len(want), (r.page_id, r.text[:200])


def test_no_pages(spark):
    assert main_text.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_labelled_pages_held_out():
    right = total = 0
    for k in range(len(page_examples.PAGES)):
        x, y = main_text.labelled_blocks([p for i, p in enumerate(page_examples.PAGES) if i != k])
        held_x, held_y = main_text.labelled_blocks([page_examples.PAGES[k]])
        right += int((main_text.grow(x, y).predict(held_x) == held_y).sum())
        total += len(held_y)
    assert right / total > 0.85, right / total


def test_tree_follows_the_labels():
    x = np.array([[i % 7, i % 5] for i in range(70)], dtype=float)
    y = ((x[:, 0] > 3) & (x[:, 1] <= 2)).astype(float)
    assert (main_text.grow(x, y).predict(x) == y).all()
    assert main_text.grow(x, np.zeros(70)).predict(x).sum() == 0
