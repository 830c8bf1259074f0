"""CSS selectors for the monitor's scope.

A selector is compiled on the driver once (an unsupported one is a ValueError
there) and matched inside the parse pass against the elements of a page that
remain when the monitor's noise is taken out, so positions count these only.

Supported: lists; the combinators blank, ``>``, ``+``, ``~``; names, ``*``,
``.class``, ``#id``; attributes present or compared by ``=``, ``~=``, ``|=``,
``^=``, ``$=``, ``*=`` with bare or quoted values and the flag ``i``;
``:first-child``, ``:last-child``, ``:only-child``, ``:nth-child()``,
``:nth-last-child()``, the same ``-of-type``, ``:empty``, ``:root``, ``:not()``
and ``:is()`` with lists. Names compare without case, the rest with it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

NAME = r"(?:[-_a-zA-Z0-9\u0080-\U0010ffff]|\\.)+"
_PART = re.compile(
    rf"(?P<tag>{NAME}|\*)|\.(?P<cls>{NAME})|\#(?P<id>{NAME})"
    rf"|\[\s*(?P<attr>{NAME}(?::{NAME})?)\s*(?:(?P<op>[~|^$*]?=)\s*"
    rf"(?:\"(?P<double>[^\"]*)\"|'(?P<single>[^']*)'|(?P<bare>[^\]\s\"']+))\s*(?P<flag>[iIsS])?\s*)?\]"
    rf"|:(?P<pseudo>[-a-zA-Z]+)(?P<open>\()?", re.S)
_COMBINATOR = re.compile(r"\s*([>+~])\s*|\s+")
_NTH = re.compile(r"\s*(?:(odd|even)|([+-]?\d*)n\s*(?:([+-])\s*(\d+))?|([+-]?\d+))\s*$", re.I)

Test = Callable[[object], bool]


def _unescape(name: str) -> str:
    return re.sub(r"\\(.)", r"\1", name)


def _siblings(el) -> list:
    return el.parent.children if el.parent is not None else el.top


def _place(el, last: bool, same_type: bool) -> int:
    """Position from 1 among the element's siblings, from the front or the end."""
    row = _siblings(el)
    if not same_type:
        return len(row) - el.index if last else el.index + 1
    return sum(x.tag == el.tag for x in (row[el.index:] if last else row[:el.index + 1]))


def _previous(el):
    return _siblings(el)[el.index - 1] if el.index else None


def _nth(text: str) -> Callable[[int], bool]:
    m = _NTH.match(text)
    if not m:
        raise ValueError(text)
    if m[1]:
        step, start = 2, 1 if m[1].lower() == "odd" else 0
    elif m[5]:
        step, start = 0, int(m[5])
    else:
        step = int(m[2] + "1") if m[2] in ("", "+", "-") else int(m[2])
        start = int((m[3] or "") + (m[4] or "0"))
    if step == 0:
        return lambda n: n == start
    return lambda n: (n - start) % step == 0 and (n - start) // step >= 0


def _attribute(name: str, op: str | None, value: str, fold: bool) -> Test:
    name = name.lower()
    if fold:
        value = value.lower()

    def holds(found: str) -> bool:
        if fold:
            found = found.lower()
        match op:
            case None:
                return True
            case "=":
                return found == value
            case "~=":
                return value != "" and value in found.split()
            case "|=":
                return found == value or found.startswith(value + "-")
            case "^=":
                return value != "" and found.startswith(value)
            case "$=":
                return value != "" and found.endswith(value)
        return value != "" and value in found

    return lambda el: name in el.attrs and holds(el.attrs[name])


class Selector:
    def __init__(self, text: str):
        self.text = text
        self._known: dict[tuple, bool] = {}
        try:
            self._complex, at = self._list(0, nested=False)
            if at != len(text):
                raise ValueError(text)
        except ValueError as e:
            raise ValueError(f"unsupported selector: {text!r}") from e

    # -- compiling ------------------------------------------------------------
    def _list(self, at: int, nested: bool) -> tuple[list, int]:
        found = []
        while True:
            one, at = self._chain(at, nested)
            found.append(one)
            if at >= len(self.text) or self.text[at] != ",":
                return found, at
            at += 1

    def _chain(self, at: int, nested: bool) -> tuple[list, int]:
        """[(combinator to the compound before, tests), ...] from left to right."""
        text = self.text
        at = len(text) - len(text[at:].lstrip())
        chain: list[tuple[str, list[Test]]] = []
        link = " "
        while True:
            tests, end = self._compound(at)
            if end == at:
                raise ValueError(text)
            chain.append((link, tests))
            m = _COMBINATOR.match(text, end)
            stop = m.end() if m else end
            if stop >= len(text) or text[stop] == "," or (nested and text[stop] == ")"):
                if m and m[1]:
                    raise ValueError(text)
                return chain, stop
            if not m:
                raise ValueError(text)
            link, at = m[1] or " ", stop

    def _compound(self, at: int) -> tuple[list[Test], int]:
        tests: list[Test] = []
        while m := _PART.match(self.text, at):
            if m["tag"]:
                if tests:
                    raise ValueError(self.text)
                tag = _unescape(m["tag"]).lower()
                tests.append(lambda el, tag=tag: tag in ("*", el.tag))
            elif m["cls"]:
                tests.append(lambda el, c=_unescape(m["cls"]): c in el.classes)
            elif m["id"]:
                tests.append(lambda el, i=_unescape(m["id"]): el.attrs.get("id") == i)
            elif m["attr"]:
                value = next((m[k] for k in ("double", "single", "bare") if m[k] is not None), "")
                tests.append(_attribute(_unescape(m["attr"]), m["op"], value, (m["flag"] or "") in "iI" and bool(m["flag"])))
            else:
                test, at = self._pseudo(m["pseudo"].lower(), m.end(), bool(m["open"]))
                tests.append(test)
                continue
            at = m.end()
        return tests, at

    def _pseudo(self, name: str, at: int, opened: bool) -> tuple[Test, int]:
        if opened and name in ("not", "is", "where"):
            inner, at = self._list(at, nested=True)
            if self.text[at:at + 1] != ")":
                raise ValueError(self.text)
            wanted = name != "not"
            return (lambda el: any(self._holds(c, len(c) - 1, el) for c in inner) == wanted), at + 1
        kind = re.fullmatch(r"(first|last|only|nth|nth-last)-(child|of-type)", name)
        if kind and opened == kind[1].startswith("nth"):
            typed = kind[2] == "of-type"
            if opened:
                end = self.text.find(")", at)
                fits = _nth(self.text[at:end] if end >= 0 else "(")
                return (lambda el, last=kind[1] == "nth-last": fits(_place(el, last, typed))), end + 1
            if kind[1] == "only":
                return (lambda el: _place(el, False, typed) == 1 == _place(el, True, typed)), at
            return (lambda el, last=kind[1] == "last": _place(el, last, typed) == 1), at
        if name == "empty" and not opened:
            return (lambda el: el.ev_end <= el.ev_start), at
        if name == "root" and not opened:
            return (lambda el: el.tag == "html" and el.parent is None), at
        raise ValueError(name)

    # -- matching -------------------------------------------------------------
    def _holds(self, chain: list, i: int, el) -> bool:
        link, tests = chain[i]
        if not all(t(el) for t in tests):
            return False
        if i == 0:
            return True
        if link in ">+":
            other = el.parent if link == ">" else _previous(el)
            return other is not None and self._holds(chain, i - 1, other)
        return self._any(chain, i - 1, el, _previous if link == "~" else lambda x: x.parent)

    def _any(self, chain: list, i: int, el, step) -> bool:
        """Whether an element that ``step`` leads to from ``el`` matches. What is
        found for an element is kept, so a page is walked once for each compound."""
        path, x = [], el
        while x is not None and (id(chain), i, id(x)) not in self._known:
            path.append(x)
            x = step(x)
        for x in reversed(path):
            before = step(x)
            self._known[id(chain), i, id(x)] = before is not None and (
                self._known[id(chain), i, id(before)] or self._holds(chain, i, before))
        return self._known[id(chain), i, id(el)]

    def matches(self, el) -> bool:
        return any(self._holds(c, len(c) - 1, el) for c in self._complex)

    def first(self, elements: Iterable):
        """The first match in document order, or None."""
        self._known = {}
        return next((el for el in elements if self.matches(el)), None)
