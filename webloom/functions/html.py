"""Single-pass HTML tokeniser used inside the Arrow parse job.

It is not a DOM. One regex scan produces a flat event list (start tag, end
tag, text); an open-element stack tracks nesting well enough to find element
boundaries. Every extracted part (title, metas, hrefs, content root text and
HTML slice, Markdown, monitor text) is read off that one scan.

Nesting rules: void elements never open; an end tag closes the nearest open
element with the same name (and everything opened after it); an end tag with
no open match is ignored; ``<p>`` closes an open ``<p>`` directly above it;
``<li>`` closes an open ``<li>``. Comments are dropped. ``script``/``style``/
``textarea``/``title`` bodies are raw text up to their end tag.
"""

from __future__ import annotations

import html as _html
import re

# Element lists that decide what the reference keeps or drops.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT_TAGS = frozenset(["script", "style", "textarea", "title"])
# Dropped before Markdown conversion (scrape).
MARKDOWN_NOISE = frozenset(
    ["script", "style", "noscript", "svg", "iframe", "nav", "footer", "header", "aside"])
# Removed before snapshot text extraction (monitor) -- a different list.
MONITOR_NOISE = frozenset(["script", "style", "noscript", "nav", "footer", "header"])

# Nothing here backtracks, and a tag that never closes is one match up to where
# it breaks off (its last character is no ">"), so no part is scanned again from
# every "<" inside it: a scan takes linear time on any input.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"                       # comment
    r"|<[!?][^>]*+>?"                          # doctype / processing instruction
    r"|</([A-Za-z][^\s/>]*+)[^>]*+>?"          # end tag -> group 1
    r"|<([A-Za-z][^\s/>]*+)"                   # start tag name -> group 2
    r"((?:\s++[^\s\"'>/=]++(?:\s*+=\s*+(?:\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])|[^\s>]++))?+|\s*+/(?!>))*+)"
    r"\s*+(/?)>?",                             # attrs -> 3, self-close -> 4
    re.S)
_RAW_CLOSE = {t: re.compile(r"</" + t + r"\s*>", re.I) for t in RAW_TEXT_TAGS}
_ROOT_TAGS = frozenset(["main", "article", "body"])
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


def _unescape(s: str) -> str:
    return _html.unescape(s) if "&" in s else s


def parse_attrs(raw: str) -> dict[str, str]:
    attrs: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        name = m.group(1).lower()
        if name in attrs:
            continue
        val = m.group(2)
        if val is None:
            val = m.group(3)
        if val is None:
            val = m.group(4)
        attrs[name] = _unescape(val) if val is not None else ""
    return attrs


class Element:
    __slots__ = ("tag", "attrs", "ev_start", "ev_end", "src_inner_start",
                 "src_inner_end", "in_md_noise", "in_mon_noise", "parent", "children",
                 "index", "top")

    def __init__(self, tag, attrs, ev_start, src_inner_start, parent):
        self.tag = tag
        self.attrs = attrs
        self.ev_start = ev_start          # index of first event inside
        self.ev_end = None                # index one past the last event inside
        self.src_inner_start = src_inner_start
        self.src_inner_end = None
        self.parent = parent
        self.children = []                # without monitor noise; filled for selectors only
        self.in_md_noise = False
        self.in_mon_noise = False

    @property
    def classes(self):
        return self.attrs.get("class", "").split()


# Event kinds
START, END, TEXT = 0, 1, 2


class Document:
    """Flat event list plus the elements we need to look up by rule."""

    def __init__(self, src: str, selector=None, light: bool = False):
        self.src = src
        self.light = light and selector is None
        self.events: list[tuple] = []     # (kind, payload, element)
        self.title: str | None = None
        self.metas: list[dict] = []       # attribute dicts of every <meta>
        self.first_time: Element | None = None
        self.hrefs: list[str] = []
        self.first: dict[str, Element] = {}       # main / article / role / body
        self.first_mon: dict[str, Element] = {}   # same, outside monitor noise
        self.selector = selector
        self.selected: Element | None = None
        self.elements: list[Element] = []         # outermost ones, for selectors only
        if self.light:
            self._scan_light()
        else:
            self._scan()
        if selector is not None:
            self.selected = selector.first(ev[2] for ev in self.events if ev[0] == START and not ev[2].in_mon_noise)

    # -- scanning -----------------------------------------------------------
    def _scan(self):
        src = self.src
        events = self.events
        append = events.append
        stack: list[Element] = []
        md_noise = 0
        mon_noise = 0
        opened: dict[str, int] = {}  # open elements by name
        pos = 0
        n = len(src)
        finditer = _TOKEN.finditer
        note = self._note
        unescape = _html.unescape

        def close(el, at_event, src_at):
            nonlocal md_noise, mon_noise
            el.ev_end = at_event
            el.src_inner_end = src_at
            tag = el.tag
            if tag in MARKDOWN_NOISE:
                md_noise -= 1
            if tag in MONITOR_NOISE:
                mon_noise -= 1
            opened[tag] -= 1

        it = finditer(src, pos)
        while True:
            m = next(it, None)
            if m is None:
                break
            start, end = m.span()
            if src[end - 1] != ">" and not src.startswith("<!--", start):
                continue  # a tag that never closes is text
            if start > pos:
                t = src[pos:start]
                append((TEXT, unescape(t) if "&" in t else t, None, md_noise > 0, mon_noise > 0))
            pos = m.end()
            end_name, start_name, raw_attrs, selfclose = m.groups()
            if end_name is not None:
                tag = end_name.lower()
                for k in range(len(stack) - 1, -1, -1) if opened.get(tag) else ():
                    if stack[k].tag == tag:
                        while len(stack) > k:
                            close(stack.pop(), len(events), start)
                        append((END, tag, None, md_noise > 0, mon_noise > 0))
                        break
                continue
            if start_name is None:
                continue  # comment / doctype
            tag = start_name.lower()
            attrs = parse_attrs(raw_attrs) if raw_attrs else {}
            if stack:
                top = stack[-1].tag
                if (tag == "p" and top == "p") or (tag == "li" and top == "li"):
                    el = stack.pop()
                    close(el, len(events), start)
                    append((END, el.tag, None, md_noise > 0, mon_noise > 0))
            el = Element(tag, attrs, len(events) + 1, pos, stack[-1] if stack else None)
            el.in_md_noise = md_noise > 0 or tag in MARKDOWN_NOISE
            el.in_mon_noise = mon_noise > 0 or tag in MONITOR_NOISE
            append((START, tag, el, md_noise > 0, mon_noise > 0))
            note(el, tag, attrs)
            if selfclose or tag in VOID_TAGS:
                el.ev_end = len(events)
                el.src_inner_end = pos
                continue
            if tag in MARKDOWN_NOISE:
                md_noise += 1
            if tag in MONITOR_NOISE:
                mon_noise += 1
            opened[tag] = opened.get(tag, 0) + 1
            close_re = _RAW_CLOSE.get(tag)
            if close_re is None:
                stack.append(el)
                continue
            cm = close_re.search(src, pos)
            body_end = cm.start() if cm else n
            raw = src[pos:body_end]
            if tag == "title" and self.title is None:
                self.title = unescape(raw) if "&" in raw else raw
            if raw:
                append((TEXT, unescape(raw) if "&" in raw else raw, None,
                        md_noise > 0, mon_noise > 0))
            close(el, len(events), body_end)
            if cm:
                append((END, tag, None, md_noise > 0, mon_noise > 0))
                pos = cm.end()
            else:
                pos = n
            it = finditer(src, pos)
        if pos < n:
            t = src[pos:]
            append((TEXT, unescape(t) if "&" in t else t, None, md_noise > 0, mon_noise > 0))
        while stack:
            close(stack.pop(), len(events), n)

    def _scan_light(self):
        """The same nesting rules as ``_scan`` but only text events are kept
        and only content-root candidates get an element record: enough for
        title, metas, hrefs, root text / inner HTML and monitor text (not for
        Markdown or selectors)."""
        src = self.src
        events = self.events
        append = events.append
        stack: list = []            # [tag, Element-or-None]
        md_noise = 0
        mon_noise = 0
        opened: dict[str, int] = {}  # open elements by name
        pos = 0
        n = len(src)
        finditer = _TOKEN.finditer
        unescape = _html.unescape
        first, first_mon = self.first, self.first_mon

        def close(entry, src_at):
            nonlocal md_noise, mon_noise
            tag, el = entry
            if el is not None:
                el.ev_end = len(events)
                el.src_inner_end = src_at
            if tag in MARKDOWN_NOISE:
                md_noise -= 1
            if tag in MONITOR_NOISE:
                mon_noise -= 1
            opened[tag] -= 1

        it = finditer(src, pos)
        while True:
            m = next(it, None)
            if m is None:
                break
            start, end = m.span()
            if src[end - 1] != ">" and not src.startswith("<!--", start):
                continue  # a tag that never closes is text
            if start > pos:
                t = src[pos:start]
                append((TEXT, unescape(t) if "&" in t else t, None, md_noise > 0, mon_noise > 0))
            pos = m.end()
            end_name, start_name, raw_attrs, selfclose = m.groups()
            if end_name is not None:
                tag = end_name.lower()
                for k in range(len(stack) - 1, -1, -1) if opened.get(tag) else ():
                    if stack[k][0] == tag:
                        while len(stack) > k:
                            close(stack.pop(), start)
                        break
                continue
            if start_name is None:
                continue
            tag = start_name.lower()
            attrs = parse_attrs(raw_attrs) if raw_attrs else None
            if stack:
                top = stack[-1][0]
                if (tag == "p" and top == "p") or (tag == "li" and top == "li"):
                    close(stack.pop(), start)
            el = None
            if attrs is not None:
                if tag == "a":
                    if "href" in attrs:
                        self.hrefs.append(attrs["href"])
                elif tag == "meta":
                    self.metas.append(attrs)
                if attrs.get("role") == "main" and "role" not in first:
                    el = Element(tag, attrs, len(events), pos, None)
                    first["role"] = el
            if tag == "time" and self.first_time is None:
                self.first_time = Element(tag, attrs or {}, len(events), pos, None)
            if tag in _ROOT_TAGS and (tag not in first or (tag not in first_mon and mon_noise == 0
                                                           and tag not in MONITOR_NOISE)):
                if el is None:
                    el = Element(tag, attrs or {}, len(events), pos, None)
                first.setdefault(tag, el)
                if mon_noise == 0:
                    first_mon.setdefault(tag, el)
            if selfclose or tag in VOID_TAGS:
                if el is not None:
                    el.ev_end = len(events)
                    el.src_inner_end = pos
                continue
            if tag in MARKDOWN_NOISE:
                md_noise += 1
            if tag in MONITOR_NOISE:
                mon_noise += 1
            opened[tag] = opened.get(tag, 0) + 1
            close_re = _RAW_CLOSE.get(tag)
            if close_re is None:
                stack.append((tag, el))
                continue
            cm = close_re.search(src, pos)
            body_end = cm.start() if cm else n
            raw = src[pos:body_end]
            if tag == "title" and self.title is None:
                self.title = unescape(raw) if "&" in raw else raw
            if raw:
                append((TEXT, unescape(raw) if "&" in raw else raw, None,
                        md_noise > 0, mon_noise > 0))
            close((tag, el), body_end)
            pos = cm.end() if cm else n
            it = finditer(src, pos)
        if pos < n:
            t = src[pos:]
            append((TEXT, unescape(t) if "&" in t else t, None, md_noise > 0, mon_noise > 0))
        while stack:
            close(stack.pop(), n)

    def _note(self, el: Element, tag: str, attrs: dict):
        if tag == "a":
            if "href" in attrs:
                self.hrefs.append(attrs["href"])
        elif tag == "meta":
            self.metas.append(attrs)
        elif tag == "time":
            if self.first_time is None:
                self.first_time = el
        elif tag in _ROOT_TAGS:
            self.first.setdefault(tag, el)
            if not el.in_mon_noise:
                self.first_mon.setdefault(tag, el)
        if attrs and attrs.get("role") == "main":
            self.first.setdefault("role", el)
        if self.selector is not None and not el.in_mon_noise:
            row = self.elements if el.parent is None else el.parent.children
            el.index, el.top = len(row), self.elements
            row.append(el)

    # -- parts --------------------------------------------------------------
    def meta(self, attr: str, value: str) -> str | None:
        """``content`` of the first ``meta[attr=value]`` (None if absent)."""
        for a in self.metas:
            if a.get(attr) == value:
                return a.get("content")
        return None

    def content_root(self) -> Element | None:
        for key in ("main", "article", "role", "body"):
            el = self.first.get(key)
            if el is not None:
                return el
        return None

    def text_of(self, el: Element | None, skip_monitor_noise=False) -> str:
        lo, hi = (0, len(self.events)) if el is None else (el.ev_start, el.ev_end)
        out = []
        for ev in self.events[lo:hi]:
            if ev[0] == TEXT and not (skip_monitor_noise and ev[4]):
                out.append(ev[1])
        return "".join(out)

    def inner_html(self, el: Element | None) -> str:
        if el is None:
            return self.src
        return self.src[el.src_inner_start:el.src_inner_end]

    def monitor_root(self) -> Element | None:
        if self.selector is not None:
            if self.selected is not None:
                return self.selected
            return self.first_mon.get("body")
        for key in ("main", "article", "body"):
            el = self.first_mon.get(key)
            if el is not None:
                return el
        return None


# ---------------------------------------------------------------------------
# Markdown rendering of the content root (headings atx, fenced code, "-" bullets).
_BLOCK = frozenset(
    "address article aside blockquote body dd div dl dt fieldset figcaption figure form "
    "h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th "
    "thead tr ul".split())
# Markdown escapes applied to text (the converter's defaults);
# patterns starting with ^ only apply at the start of a text run.
_MD_ESCAPES = [
    (re.compile(r"\\"), r"\\\\"),
    (re.compile(r"\*"), r"\\*"),
    (re.compile(r"^-"), r"\\-"),
    (re.compile(r"^\+ "), r"\\+ "),
    (re.compile(r"^(=+)"), r"\\\1"),
    (re.compile(r"^(#{1,6}) "), r"\\\1 "),
    (re.compile(r"`"), r"\\`"),
    (re.compile(r"^~~~"), r"\\~~~"),
    (re.compile(r"\["), r"\\["),
    (re.compile(r"\]"), r"\\]"),
    (re.compile(r"^>"), r"\\>"),
    (re.compile(r"_"), r"\\_"),
    (re.compile(r"^(\d+)\. "), r"\1\\. "),
]
BULLET = "-"
_WS = re.compile(r"[ \t\r\n\f]+")


def _md_escape(s: str) -> str:
    for rx, rep in _MD_ESCAPES:
        s = rx.sub(rep, s)
    return s


def _build_tree(events, lo, hi):
    """Nested (tag, attrs, children) tuples for the event slice, with noise
    elements dropped. Element extents come from the scan (``ev_end``)."""
    root = ("#root", {}, [])
    stack = [(root, hi)]
    i = lo
    while i < hi:
        while len(stack) > 1 and stack[-1][1] <= i:
            stack.pop()
        ev = events[i]
        if ev[0] == START:
            el = ev[2]
            if el.tag in MARKDOWN_NOISE:
                i = max(el.ev_end, i + 1)
                continue
            node = (el.tag, el.attrs, [])
            stack[-1][0][2].append(node)
            if el.ev_end > el.ev_start:
                stack.append((node, el.ev_end))
        elif ev[0] == TEXT:
            stack[-1][0][2].append(ev[1])
        i += 1
    return root


def _rendered(children, ctx) -> str:
    """The children as Markdown. ``_children`` and ``_render`` are generators
    that hand out the nodes they need and get their texts sent back, so depth
    of nesting costs a list entry, not a Python frame."""
    waiting, text = [_children(children, ctx)], None
    while waiting:
        try:
            node, inner_ctx = waiting[-1].send(text)
        except StopIteration as done:
            waiting.pop()
            text = done.value
        else:
            waiting.append(_render(node, inner_ctx))
            text = None
    return text


def _children(children, ctx):
    """Concatenate rendered children; text that follows a block boundary
    (a newline) loses its leading spaces, as whitespace collapsing does."""
    out = ""
    for c in children:
        if isinstance(c, tuple):
            if c[0] == "br" and not ctx.get("pre"):
                out = out.rstrip(" ")
            out += yield c, ctx
        elif ctx.get("pre"):
            out += c
        else:
            piece = _md_escape(_WS.sub(" ", c))
            out += piece.lstrip(" ") if not out or out.endswith("\n") else piece
    return out


def _render(node, ctx):
    tag, attrs, children = node
    if tag == "pre":
        inner = yield from _children(children, {**ctx, "pre": True})
        return "\n\n```\n" + inner.rstrip("\n") + "\n```\n\n"
    if tag in ("ul", "ol"):
        items = [c for c in children if isinstance(c, tuple) and c[0] == "li"]
        start = attrs.get("start", "")
        first = int(start) if tag == "ol" and start.isdigit() else 1
        out = []
        for k, li in enumerate(items):
            prefix = f"{first + k}.  " if tag == "ol" else BULLET + "   "
            body = yield from _children(li[2], {**ctx, "li": True})
            body = re.sub(r"\n{3,}", "\n\n", body)
            body = re.sub(r"^\n+", "", body).lstrip(" ")
            body = re.sub(r"\n+$", "\n", body)
            body = body.replace("\n", "\n    ")
            nxt = "\n" if k < len(items) - 1 and not body.endswith("\n") else ""
            out.append(prefix + body + nxt)
        content = "".join(out)
        return ("\n" + content) if ctx.get("li") else ("\n\n" + content + "\n\n")
    inner = yield from _children(children, ctx)
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return "\n\n" + "#" * int(tag[1]) + " " + inner.strip() + "\n\n"
    if tag == "br":
        return "  \n"
    if tag == "hr":
        return "\n\n* * *\n\n"
    if tag in ("b", "strong"):
        return f"**{inner}**" if inner.strip() else ""
    if tag in ("i", "em"):
        return f"_{inner}_" if inner.strip() else ""
    if tag == "code":
        if ctx.get("pre"):
            return inner
        return f"`{inner}`" if inner else ""
    if tag == "a":
        href = attrs.get("href")
        if href:
            title = attrs.get("title")
            tpart = f' "{title}"' if title else ""
            return f"[{inner}]({href}{tpart})"
        return inner
    if tag == "img":
        src = attrs.get("src", "")
        title = attrs.get("title")
        tpart = f' "{title}"' if title else ""
        return f"![{attrs.get('alt', '')}]({src}{tpart})" if src else ""
    if tag == "blockquote":
        body = re.sub(r"\n{3,}", "\n\n", inner).strip("\n")
        return "\n\n" + re.sub(r"(?m)^", "> ", body) + "\n\n"
    if tag in _BLOCK:
        return "\n\n" + inner.strip(" ") + "\n\n"
    return inner


_TRAILING = re.compile(r"(?m)(?<!^>)[ \t]+\n")


def to_markdown(doc: Document, el: Element | None) -> str:
    lo, hi = (0, len(doc.events)) if el is None else (el.ev_start, el.ev_end)
    tree = _build_tree(doc.events, lo, hi)
    out = _rendered(tree[2], {})
    # Trailing spaces go, except a line break's two; blocks are separated by
    # at most one blank line.
    out = _TRAILING.sub(lambda m: m.group(0) if m.group(0) == "  \n" else "\n", out)
    out = re.sub(r"\n[ \t]+\n", "\n\n", out)
    out = re.sub(r"\n{3,}", "\n\n", out)
    return out.strip()
