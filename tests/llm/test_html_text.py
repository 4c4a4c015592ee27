"""Main text: blocks, the field's arithmetic, held-out accuracy."""

import itertools
import random

import numpy as np

from sentinela.llm.html_text import extract, examples, fit_field, leaf_blocks, log_likelihood, main_text

VOCAB = "river stone light morning paper garden window winter market road".split()


def _sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n)).capitalize() + "."


def _page(i, main="article", attrs=""):
    rng = random.Random(i)
    paras = [_sentence(rng, rng.randint(1, 60)) for _ in range(rng.randint(1, 12))]
    title = _sentence(rng, 6)
    body = "".join(f"<p>{p.replace('.', ' &amp; co.')}</p>" if i % 2 else f"<p><b>{p}</b><br>" for p in paras)
    page = (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body><nav><ul>"
        + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in VOCAB[:5])
        + f"</ul></nav><!-- x --><div class=\"ad\">{_sentence(rng, 9)}</div><{main}{attrs}><h1>{title}</h1>{body}</{main}>"
        + f"<footer>&copy; {_sentence(rng, 7)}</footer><script>var a = '<p>no</p>';</script></body></html>"
    )
    lines = [title] + [p.replace(".", " & co.") if i % 2 else p for p in paras]
    return page, "\n".join(lines)


def test_leaf_blocks():
    got = leaf_blocks(
        "<p>a&nbsp;&lt;b <b>c</b>\n d<p>e<br>f<ul><li>g<li>h <a href='x>y'>i</a></ul>j<!-- <p>k --><script>l</p></script>m"
        "<table><tr><td>n<td>o<tr><td>p</table><div class='x-side' id=main>q<style>r</style></div> 1 < 2"
    )
    assert [b.text for b in got] == ["a <b c d", "e f", "g", "h i", "j", "m", "n", "o", "p", "q", "1 < 2"]
    assert [b.tag for b in got][:4] == ["p", "p", "li", "li"] and got[9].words == {"x", "side", "main"}
    assert got[3].link > 0 == got[2].link
    assert leaf_blocks(None) == leaf_blocks("") == leaf_blocks("<script>never closed") == leaf_blocks("<!-- open") == []
    assert [b.text for b in leaf_blocks("<a " * 3 + "x")] == ["<a <a <a x"]
    assert len(leaf_blocks("<p>x" * 50_000)) == 50_000


def test_forward_backward_and_viterbi_against_enumeration():
    rng = np.random.default_rng(1)
    e, step, first = rng.normal(size=(1, 6, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    score = lambda y: first[y[0]] + sum(e[0, i, a] for i, a in enumerate(y)) + sum(step[a, b] for a, b in zip(y, y[1:]))
    all_y = list(itertools.product((0, 1), repeat=6))
    p = np.exp([score(y) for y in all_y])
    y = np.array([all_y[13]])
    value, nodes, edges = log_likelihood(e, y, np.ones((1, 6), bool), step, first)
    assert abs(value - np.log(p[13] / p.sum())) < 1e-9
    for i in range(6):
        assert abs(nodes[0, i, 1] - sum(q for q, s in zip(p, all_y) if s[i]) / p.sum()) < 1e-9
    assert abs(edges.sum() - 5) < 1e-9
    names = [[f"f{i}"] for i in range(6)]
    from sentinela.llm.html_text import Field

    field = Field({f"f{i}": i for i in range(6)}, e[0], step, first)
    assert tuple(field.decode(names)) == all_y[int(np.argmax(p))]


def test_held_out_pages_with_known_and_other_markup():
    field = fit_field([x for i in range(40) for x in examples(_page(i)[0], i)])
    for i in range(100, 160):
        page, text = _page(i)
        assert extract(field, page) == text
    good = sum(extract(field, page) == text for page, text in (_page(i, "div", ' class="post"') for i in range(200, 240)))
    assert good >= 32
    side = '<div class="comments"><p>Nice page. I like it very much.</p></div><aside>More of this.</aside><form><label>Mail</label></form><div class="cookie">We use them.</div>'
    page, text = _page(300)
    assert extract(field, page.replace("<footer>", side + "<footer>")) == text


def test_main_text(spark):
    rows = [(i, f"u{i}", _page(i)[0]) for i in range(40)]
    rows += [(90, "u", None), (91, None, ""), (92, "u", "<nav>only</nav>"), (None, "u", _page(3)[0]), (5, "u5", _page(5)[0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text")
    got = main_text(spark, df, keep=["page_id", "url"])
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = {i: _page(i)[1] for i in range(40)} | {90: "", 91: "", 92: "", None: _page(3)[1]}
    rows = got.collect()
    assert len(rows) == 45 and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in rows)
    assert main_text(spark, df.limit(0)).count() == 0
    bare = df.where("page_id = 92").selectExpr("page_id", "html")
    assert main_text(spark, bare).first().text == ""
