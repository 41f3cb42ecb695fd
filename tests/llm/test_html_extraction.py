from __future__ import annotations

import random
import time
from collections import Counter

import pyarrow as pa
import pytest

from tillwork.llm import html_extraction

BODY = "Then the man walked to the market, bought bread, and came home. It was a long day, and he was tired of all of it."


def page(k: int) -> str:
    paragraphs = "".join(f"<p>Paragraph {j} of page {k}: {BODY}" + ("</p>" if j % 2 else "") for j in range(2 + k % 4))
    return (
        f"<!DOCTYPE html><html><head><title>t{k}</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></li>"
        f"<li><a href=/b>About</a></li></ul></nav><div class=\"ad\">Buy now, cheap.</div><article><h1>Title {k}</h1>{paragraphs}</article>"
        f"<footer>&copy; site {k}</footer></body></html>"
    )


@pytest.fixture(scope="module")
def model():
    batch = pa.RecordBatch.from_arrays([pa.array([page(k) for k in range(200)])], ["html"])
    counts = next(html_extraction._counted(iter([batch]))).to_pydict()
    return html_extraction.Potentials(Counter(dict(zip(zip(counts["name"], counts["label"], counts["above"]), counts["count"]))))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p", ""),
        (f"<article><p>{BODY}</p><p class=", BODY),
        ("<script>x", ""),
        (f"<article><p>{BODY}", BODY),
        (f"<article><p>a<br>b <b>bo<i>ld</b></i>c</p><div class=ad>Buy</div><p>x &lt;tag&gt; &#233; &nbsp; y</p>", "a b boldc x <tag> é y"),
        (f"<header><h1>Site</h1></header><nav>n</nav><article><h1>T</h1><p>{BODY}</p><div class='comments'><p>Nice post.</p></div></article>", f"T {BODY}"),
        (f"<body><h1>T</h1><p>{BODY}<p>{BODY}<div class='cookie-notice'>We use cookies.</div><form><p>Sign up</p></form>", f"T {BODY} {BODY}"),
        (f"<div class='menu'><a href=a>A</a></div><div class='post-content'><p>{BODY}</p></div><div class='sidebar'><p>Buy</p></div>", BODY),
        (f"<article><p>{BODY}</p></article><footer>f", BODY),
        (f"<article><!-- {BODY} --><p>x<![CDATA[ y ]]></p></article>", "x y"),
    ],
)
def test_main_text(model, source, text):
    assert html_extraction.main_text(source, model) == text


@pytest.mark.parametrize(
    "start",
    [
        "<html><head><title>t</title><body>",
        "<head><meta charset=x><title>t</title><style>p{}</style>",
        "<html><head><head><title>t</title><noframes>n</noframes><template><p>x</p></template></head><body>",
        "<html><head><script>a</script><img src=a><a href=b></a>",
        "<html><head><title>t</title></body>",
    ],
)
def test_a_head_left_open_ends_where_the_body_starts(model, start):
    assert html_extraction.main_text(f"{start}<article><p>{BODY}</p></article>", model) == BODY


def test_text_ends_a_head(model):
    assert html_extraction.Page("<head> <title>t</title> Words<p>more").text[-3:] == ["Words", "", "more"]
    assert html_extraction.Page("<head> <title>t</title> <![CDATA[c]]></head> ").text == [""] * 3


@pytest.mark.parametrize("name", ["math", "object", "map", "canvas", "audio", "video"])
def test_elements_that_hold_text_are_read(model, name):
    source = f"<article><p>{BODY} Then <{name} a=b><i>x</i>=1</{name}> holds.</p></article>"
    assert html_extraction.main_text(source, model) == f"{BODY} Then x=1 holds."


def test_whole_article_of_generated_pages(model):
    for k in range(200, 260):
        expected = [f"Title {k}"] + [f"Paragraph {j} of page {k}: {BODY}" for j in range(2 + k % 4)]
        assert html_extraction.main_text(page(k), model) == " ".join(expected)


def test_deep_and_long_pages(model):
    assert html_extraction.main_text("<div>" * 20_000 + BODY, model) == BODY
    assert html_extraction.main_text("<article>" + f"<p>{BODY}</p>" * 5_000, model) == " ".join([BODY] * 5_000)


def test_marginals_as_by_enumeration(model):
    """Sum-product on a small tree against the sum over all labellings."""
    import itertools
    import math

    tree = html_extraction.Page("<div><p>ab</p><nav>cd</nav></div>")
    count = len(tree.tag)
    pairs = [model.pair(tree.kind(k, False)) for k in range(count)]
    own = [model.unary(tree.evidence(k, False)) if k else 0.0 for k in range(count)]
    total, content = 0.0, [0.0] * count
    for labels in itertools.product((0, 1), repeat=count):
        weight = math.exp(sum(own[k] * labels[k] for k in range(count)) + sum(pairs[k][labels[tree.parent[k]]][labels[k]] for k in range(1, count)))
        total += weight
        for k in range(count):
            content[k] += weight * labels[k]
    assert html_extraction.marginals(tree, model) == pytest.approx([one / total for one in content])


@pytest.mark.parametrize(
    "piece", ['<a x="1" ', "<div>", "</section>", "<p title='it\"s>x", "<li>x", "</script ", "<", "<!--", '<a b="c>d', "<blockquote>", "&amp;", "<p>\"'"],
)
@pytest.mark.parametrize("before", ["", "<blockquote>" * 20_000, "<article>"])
def test_a_megabyte_of_anything_takes_seconds(model, before, piece):
    began = time.monotonic()
    html_extraction.main_text(before + piece * (1_000_000 // len(piece)), model)
    assert time.monotonic() - began < 30


def test_tags_end_outside_of_quotes():
    ends = html_extraction.TagEnds
    assert ends("<a x='>'>").after(2) == 8 and ends("<a x=\">'\">").after(2) == 9
    # A quote that is never closed is no quote.
    assert ends("<a x='>text").after(2) == 6 and ends("<a x=").after(2) == -1


def plain_page(k: int) -> tuple[str, str]:
    """A page without article or main, its text in divisions that say little, and that text."""
    rng = random.Random(k)
    body = [f"Part {j} of page {k}: {BODY}" for j in range(2 + k % 5)]
    name = rng.choice(["c1", "wrap", "post-content", "story", "x9", ""])
    links = "".join(f"<li><a href=/{j}>Section {j}</a></li>" for j in range(6))
    around = rng.choice(['<div class="menu"><ul>%s</ul></div>', "<nav><ul>%s</ul></nav>", '<div id="sidebar"><ul>%s</ul></div>', "<ul>%s</ul>"]) % links
    end = rng.choice(["<footer>&copy; site</footer>", '<div class="footer"><p>&copy; site, all rights reserved</p></div>', '<div class="comments"><p>Nice one, thanks.</p></div>'])
    paragraphs = "".join(f"<p>{one}</p>" for one in body)
    return f'<html><head><title>t</title></head><body>{around}<div class="{name}"><h1>Title {k}</h1>{paragraphs}</div>{end}</body></html>', f"Title {k} " + " ".join(body)


def test_pages_without_article_or_main(model):
    """Words of the text that are found, and words found that are of the text, over pages that do not label themselves."""
    kept = wanted = found = 0
    for k in range(300):
        source, text = plain_page(k)
        have, expected = Counter(html_extraction.main_text(source, model).split()), Counter(text.split())
        kept += (have & expected).total()
        wanted += expected.total()
        found += have.total()
    assert kept / wanted > 0.95 and kept / found > 0.95, (kept / wanted, kept / found)
