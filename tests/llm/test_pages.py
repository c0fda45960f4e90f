"""Blocks of pages, the network's gradients, and its accuracy on pages it was not fitted on."""

import random

import numpy as np
import pytest

from clickstrata.llm import pages

SCHEMA = "page_id long, url string, html string, text string, n_blocks string"


def sentence(r):
    return " ".join(r.choice(["Ouleou", "river", "the", "of", "été", "wind", "house", "stone", "und"]) for _ in range(r.randint(8, 60))) + "."


def page(r):
    article = [sentence(r) for _ in range(r.randint(1, 9))]
    menu = "".join(f'<li><a href="/{k}">{sentence(r)[:9]}</a></li>' for k in range(6))
    html = f'<html><head><title>{article[0]}</title><script>var t="</p>";</script></head><body><nav><ul>{menu}</ul></nav>'
    html += f'<!-- x --><div class="ad">{sentence(r)}</div><article><h1>{article[0]}</h1>' + "".join(f"<p><b>{p}<br>" for p in article[1:])
    return html + f"</article><footer>&copy; {sentence(r)}</footer></body></html>", "\n\n".join(article)


@pytest.fixture(scope="module")
def network():
    r = random.Random(1)
    return pages.train(pages.examples([pages.blocks_of(page(r)[0]) for _ in range(200)]))


def test_blocks():
    html = "<p>a &amp;&nbsp; b<br>c<p>d <i>e</i>f<ul><li>g<li>h</ul>i<script>no</script>j<textarea>no</textarea></p><!-- no -->k"
    assert [b.text for b in pages.blocks_of(html)] == ["a & b c", "d ef", "g", "h", "i", "j", "k"]


@pytest.mark.parametrize("html", [None, "", " ", "<", "<p", "</p></div>", "<!--", "<script>", "&#x110000;", "<div>" * 3000 + "x"])
def test_odd_pages_have_blocks_or_none(html):
    assert isinstance(pages.blocks_of(html), list)


def test_gradients():
    r = random.Random(3)
    group = [pages.blocks_of(page(r)[0]) for _ in range(3)]
    labels = np.array([b.article for own in group for b in own], float)
    network = pages.Network.new(4)
    _, grads = network.gradients(group, labels)
    for name, weights in network.weights.items():
        at = np.unravel_index(int(np.abs(grads[name]).argmax()), weights.shape)
        before = weights[at]
        weights[at] = before + 1e-5
        up = network.gradients(group, labels)[0]
        weights[at] = before - 1e-5
        down = network.gradients(group, labels)[0]
        weights[at] = before
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-6 + 1e-4 * abs(grads[name][at])


def test_unseen_pages_and_layouts(network):
    r = random.Random(7)
    made = [page(r) for _ in range(100)]
    found = [pages.blocks_of(html) for html, _ in made]
    assert ["\n\n".join(b.text for b, p in zip(own, s, strict=True) if p >= 0.5) for own, s in zip(found, network.scores(found), strict=True)] == [text for _, text in made]
    dressed = pages.examples(found, 300, seed=11)[len(found) :]
    scores = network.scores([own for own, _ in dressed])
    wrong = sum(int(((s >= 0.5) != np.array(own)).sum()) for s, (_, own) in zip(scores, dressed, strict=True))
    assert wrong <= 0.02 * sum(len(own) for _, own in dressed)


def test_query_columns_and_odd_rows(spark, network):
    r = random.Random(8)
    made = [page(r) for _ in range(40)]
    rows = [(k, f"http://x/{k}", html, "t", "n") for k, (html, _) in enumerate(made)]
    rows += [(0, "http://x/0", made[0][0], "t", "n"), (None, None, made[1][0], "t", "n"), (90, "u", None, "t", "n"), (91, "u", "", "t", "n")]
    long = "<article>" + "<p>one two three four</p>" * 20_000 + "</article>"
    rows.append((92, "u", long, "t", "n"))
    found = {(x["carried"]["page_id"], x["text"]) for x in pages.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {(k, text) for k, (_, text) in enumerate(made)} | {(None, made[1][1]), (90, ""), (91, "")}
    assert want <= found and len(found) == len(want) + 1
    assert pages.extract(spark.createDataFrame(rows, SCHEMA), network=network).count() == len(rows)
    assert pages.extract(spark.createDataFrame([], SCHEMA)).collect() == []
