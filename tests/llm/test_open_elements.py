"""Elements without end tags ahead of and inside an article, and formulas in it."""

import time

import pytest

from lodestrata.llm import html_text

ARTICLE = "<article><p>First words.</p><p>Last words.</p></article>"


def texts(page):
    return [b.text for b in html_text.blocks(page)]


@pytest.mark.parametrize("before", [
    "<datalist><option value=a><option value=b></datalist>",
    "<datalist><option value=a>A<option value=b>B</datalist>",
    "<select><option>A<option>B</select>",
    "<select><optgroup><option>A<optgroup><option>B</select>",
    "<form><select><option>A<option>B</form>",
    "<div><svg><path d='M0'><text>x</text></div>",
    "<svg><path d='M0'>",
    "<div><object data=x><param name=a></div>",
    "<div><template><p>t</p></div>",
    "<div><canvas>c</div>",
    "<div><video><source src=x></div>",
    "<svg><title>t</title><script>'</svg>'</script><foreignObject><p>in it</p></foreignObject></svg>",
    "<object><object>a</object>b</object>",
    "<div><button>go</button></div>",
])
@pytest.mark.parametrize("after", ["", "<select><option>C</option></select><svg></svg><object></object><template></template><canvas></canvas><video></video>"])
def test_article_after_open_elements(before, after):
    assert texts(f"<body>{before}{ARTICLE}{after}</body>") == ["First words.", "Last words."]


def test_elements_that_hold_the_rest_still_do():
    for tag in ("script", "style", "iframe", "textarea"):
        assert texts(f"<body><p>a</p><{tag}>{ARTICLE}") == ["a"]


def test_no_end_in_sight_loses_nothing():
    for tag in ("object", "svg", "template", "canvas", "option", "button", "head"):
        assert texts(f"<p>a</p><{tag}>{ARTICLE}") == ["a", "First words.", "Last words."]


def test_formulas_are_text_of_their_paragraph():
    math = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='application/x-tex'>x=2</annotation></semantics></math>"
    assert texts(f"<article><p>If {math} then stop.</p></article>") == ["If x=2 then stop."]


@pytest.mark.parametrize("tag", sorted(html_text.RAW - {"script", "style", "iframe", "textarea"}))
def test_time_goes_with_length(tag):
    clock = time.perf_counter()
    for page in (f"<{tag}><p>x</p>" * 4000, f"<{tag}><p>x</p>" * 4000 + f"</{tag}>", f"<div><{tag}>y</div>" * 4000):
        html_text.blocks(page)
    assert time.perf_counter() - clock < 3
