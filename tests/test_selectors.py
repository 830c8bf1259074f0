"""CSS selectors of the monitor's scope."""
import pytest

from webloom.functions.html import Document
from webloom.functions.selectors import Selector

PAGE = """<html><body><header><p>noise</p></header>
<div id="top" class="box wide"><p class="lead">one</p><nav><p>menu</p></nav><p>two</p><span lang="en-GB">three</span></div>
<ul><li>a</li><li class="on x">b</li><li data-k="Hello World">c</li><li><b>d</b></li><li>e</li></ul>
<section><h2>f</h2><p>g</p><p>h <i></i></p><div><p title='quo"te'>i</p></div></section>
<a href="https://x.org/a.pdf">j</a><a href="/k">k</a></body></html>"""

CASES = [
    ("p", "one"), ("div > p + p", "two"), (".box.wide", "onemenutwothree"), ("#top span", "three"), ("[lang|=en]", "three"),
    ("li:first-child", "a"), ("li:nth-child(2)", "b"), ("li:nth-child(2n+4)", "d"), ("li:nth-child(-n+1)", "a"), ("li:last-child", "e"),
    ("li:nth-last-child(2)", "d"), ("li:not(:first-child):not(.on)", "c"), ("li:not(.on, :first-child, [data-k])", "d"),
    ('li[data-k="Hello World"]', "c"), ("li[data-k='hello world' i]", "c"), ("[data-k~=World]", "c"), ("[data-k^=Hel]", "c"),
    ("[data-k$=rld]", "c"), ("[data-k*=\"lo W\"]", "c"), ("li.x", "b"), ("li ~ li > b", "d"), ("h2 ~ p", "g"), ("h2+p+p", "h "),
    ("section > p:nth-of-type(2)", "h "), ("section p:last-of-type", "h "), ("section div p", "i"), ("section>div>p", "i"),
    ("missing, span", "three"), ("section, #top", "onemenutwothree"), ("i:empty", ""), (":is(h2, h3)", "f"), ("a[href$='.pdf']", "j"),
    ("a:not([href^=http])", "k"), ("[title='quo\"te']", "i"), ("LI.on", "b"), ("ul *:nth-child(odd):not(:first-child)", "c"),
    (":root > body > ul > li:nth-child(5)", "e"), ("span:only-child, b:only-child", "d"), ("*", None), ("header p, nav p", None),
    ("section > p > p", None), ("li:nth-child(9)", None), (".lead ~ .lead", None), ("ul + p", None),
]


@pytest.mark.parametrize("selector,text", CASES)
def test_first_match(selector, text):
    d = Document(PAGE, Selector(selector))
    if selector == "*":
        assert d.selected.tag == "html"
    elif text is None:
        assert d.selected is None
    else:
        assert d.text_of(d.selected) == text


@pytest.mark.parametrize("selector", ["", " ", "a,", ",a", "a >", "> a", "a > > b", "a:hover", "a::before", "[x", "[x=]", "a:nth-child(x)",
                                      "a:nth-child", "a:not(", "a:not()", "a)", ":first-child(2)", "a[x='y]", "..a", "a b,"])
def test_unsupported_is_refused(selector):
    with pytest.raises(ValueError, match="unsupported selector"):
        Selector(selector)


def test_deep_and_wide_pages_take_one_walk():
    deep = Document("<div>" * 3_000 + "<p>x</p>", Selector("div div div div div div p i"))
    wide = Document("<ul>" + "<li>x</li>" * 3_000 + "</ul>", Selector("li.a ~ li ~ li ~ li:nth-child(2n)"))
    assert deep.selected is None and wide.selected is None
