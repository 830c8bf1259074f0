"""Required literals of regular expressions, and hashes of text n-grams."""

from __future__ import annotations

import re

import numpy as np

#: Lengths of the n-grams that stand for a literal; the longest that fits is used.
GRAMS = (12, 6, 3)
#: Bits of the bitmap of n-gram hashes.
BITS = 1 << 24

_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def required_literal(pattern: str) -> str:
    """The longest run of characters that every match of a Java pattern
    contains, A-Z lower-cased; empty if none is certain. Only the outermost
    sequence is looked at: groups, classes and optional characters end a run,
    and alternation there or an unusual flag means no literal."""
    if pattern.startswith("(?i)"):
        pattern = pattern[4:]
    runs, run, at, n = [], "", 0, len(pattern)

    def end(drop: int = 0):
        nonlocal run
        runs.append(run[:len(run) - drop])
        run = ""

    while at < n:
        c = pattern[at]
        if c == "|":
            return ""
        if c == "\\":
            nxt = pattern[at + 1:at + 2]
            if nxt in ("Q", "E", ""):
                return ""
            if nxt.isalnum():
                end()
                if nxt in "xucpPkN0":  # escapes with arguments
                    return ""
            else:
                run += nxt
            at += 2
        elif c in "([":
            end()
            if pattern.startswith("(?", at) and pattern[at + 2:at + 3] not in (":", "=", "!", "<", ">"):
                return ""
            depth, inside = 0, False
            while at < n:  # to the end of the group or class
                d = pattern[at]
                if d == "\\":
                    if pattern[at + 1:at + 2] in ("Q", "E"):
                        return ""
                    at += 1
                elif inside:
                    if d == "[":
                        return ""  # nested classes
                    inside = d != "]"
                elif d == "[":
                    inside = True
                    at += pattern.startswith("^", at + 1)
                    at += pattern.startswith("]", at + 1)
                elif d == "(":
                    depth += 1
                elif d == ")":
                    depth -= 1
                at += 1
                if depth == 0 and not inside:
                    break
        elif c in "?*{":
            end(drop=1)
            m = re.match(r"[?*]|\{(\d*),?\d*\}", pattern[at:])
            if m is None:
                return ""
            at += m.end()
            at += pattern[at:at + 1] in ("?", "+")
        elif c == "+":
            end()
            at += 1
            at += pattern[at:at + 1] in ("?", "+")
        elif c in ".^$":
            end()
            at += 1
        else:
            run += c
            at += 1
    end()
    return max(runs, key=len).translate(_ASCII_LOWER)


def gram_hashes(text: str, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` characters of a text, A-Z lower-cased."""
    chars = np.frombuffer(text.translate(_ASCII_LOWER).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(chars) < size:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(len(chars) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + chars[i:len(out) + i]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def literal_gram(literal: str) -> int | None:
    """The hash that stands for a literal: the least of its n-grams of the
    longest size that fits. None if it is shorter than the shortest size."""
    for size in GRAMS:
        if len(literal) >= size:
            return int(gram_hashes(literal, size).min().view(np.int64))
    return None
