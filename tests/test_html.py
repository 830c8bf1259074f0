"""Tokeniser goldens (reference cases: scrape formats, noise, selector)."""
import hashlib

from webloom.functions.html import Document, to_markdown
from webloom.functions.selectors import Selector

MOCK = ('<html><head><title>Harbour Notes</title><meta name="description" content="Notes of a harbour">'
        '</head><body><nav><a href="/nav">Nav</a></nav><main><h1>Tide Tables</h1>'
        '<p>Some <b>bold</b> and <a href="/a">a link</a>.</p><ul><li>one<li>two</ul>'
        '<pre><code>x = 1</code></pre></main><div class="tariff">$9/mo</div>'
        '<footer>Footer</footer></body></html>')


def test_title_meta_links():
    d = Document(MOCK)
    assert d.title == "Harbour Notes"
    assert d.meta("name", "description") == "Notes of a harbour"
    assert d.hrefs == ["/nav", "/a"]


def test_root_priority():
    assert Document("<body><article>A</article><main>M</main></body>").content_root().tag == "main"
    assert Document("<body><div role='main'>R</div><article>A</article></body>").content_root().tag == "article"
    d = Document("<body><div role='main'>R</div></body>")
    assert d.content_root().attrs["role"] == "main"
    assert Document("<p>no body</p>").content_root() is None


def test_markdown():
    d = Document(MOCK)
    md = to_markdown(d, d.content_root())
    assert md.startswith("# Tide Tables")
    assert "**bold**" in md and "[a link](/a)" in md
    assert "-   one\n-   two" in md
    assert "```\nx = 1\n```" in md
    assert "Nav" not in md and "Footer" not in md


def test_markdown_blocks():
    html = ('<main><h2>A_b</h2><p>- x <br>y</p><ol start="3"><li>p</li><li>q<ul><li>r</li></ul></li></ol>'
            '<blockquote><p>q1</p><p>q2</p></blockquote><hr><img src="i.png" alt="I"><p><em>e</em></p></main>')
    d = Document(html)
    assert to_markdown(d, d.content_root()) == (
        "## A\\_b\n\n\\- x  \ny\n\n3.  p\n4.  q\n    -   r\n\n> q1\n> \n> q2\n\n* * *\n\n![I](i.png)\n\n_e_")


def test_text_glues_blocks_and_keeps_script():
    d = Document("<article><p>a</p><p>b</p><script>s()</script></article>")
    assert d.text_of(d.content_root()) == "abs()"


def test_entities_and_comments():
    d = Document("<title>A &amp; B</title><body><!-- c --><p>x &copy; y</p></body>")
    assert d.title == "A & B"
    assert d.text_of(d.content_root()) == "x © y"


def test_monitor_noise_and_hash():
    d = Document(MOCK)
    text = d.text_of(d.monitor_root(), True)
    assert "Nav" not in text and "Footer" not in text and "Tide Tables" in text
    h = hashlib.sha256(text.encode()).hexdigest()
    assert len(h) == 64


def test_selector_scope():
    d = Document(MOCK, Selector("div.tariff"))
    assert d.text_of(d.monitor_root(), True) == "$9/mo"
    d = Document(MOCK, Selector(".missing"))
    assert d.monitor_root().tag == "body"
    assert Selector("main p").matches is not None


def test_script_with_closing_tag_text():
    d = Document('<head><script>var t="</p>";</script></head><body><article>ok</article></body>')
    assert d.text_of(d.content_root()) == "ok"


def test_light_scan_equals_full_scan():
    docs = [MOCK,
            '<html><body><div role="main"><p>r</p></div><main>M<nav>n</nav></main></body></html>',
            '<header><main>in header</main></header><body><article>A<script>s</script></article></body>',
            '<p>no body <a href=x>l</a><meta name=description content="d &amp; e"><time datetime=t>x</time>',
            '<title>T &amp; U</title><body><main><img src=a><br/>x<main>inner</main></main></body>']

    def parts(d):
        r = d.content_root()
        return (d.title, d.hrefs, d.metas, d.text_of(r), d.inner_html(r),
                d.text_of(d.monitor_root(), True), None if r is None else r.tag)
    for h in docs:
        assert parts(Document(h)) == parts(Document(h, light=True))
