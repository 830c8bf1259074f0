"""Required literals and the lexicon index against plain matching."""
import random
import re

import pytest

from webloom.functions.literals import gram_hashes, literal_gram, required_literal
from webloom.operators.compliance import tos_flags

CASES = [
    ("no scraping", "no scraping"), ("No Scraping", "no scraping"), ("(?i)No Data", "no data"), ("a|b", ""), ("abc(d|e)fgh", "abc"),
    ("colou?r words", "r words"), ("ab*cdef", "cdef"), ("ab+cdef", "cdef"), ("abcd{2}ef", "abc"), (r"automat\w+ access", "automat"),
    (r"\bterms of use\b", "terms of use"), (r"a\.b\.c", "a.b.c"), ("[Tt]erms and", "erms and"), (r"x[\]a]yz", "yz"), ("[^]a]long run", "long run"),
    (r"\Qa.b\E", ""), ("(?x)a b c", ""), (r"\x41bcd", ""), ("", ""), (".*", ""), ("^start.end$", "start"), ("(?:abc)+tail", "tail"),
    ("a(?=b)cde", "cde"), ("lazy.*?words", "words"), ("poss++essive", "essive"), ("x{0,3}yes", "yes"),
]


@pytest.mark.parametrize("pattern,literal", CASES)
def test_required_literal(pattern, literal):
    assert required_literal(pattern) == literal


def test_every_match_contains_the_literal():
    rng = random.Random(8)
    for _ in range(4000):
        pattern = "".join(rng.choice(["a", "b", "ab", "c", "B", ".", "a?", "b*", "c+", "[ab]", "(ab)", "(a|b)?", r"\\.", "c{2}", "^", "$", "(?:c|a)"])
                          for _ in range(rng.randint(1, 6)))
        literal = required_literal(pattern)
        for _ in range(6):
            text = "".join(rng.choice("abcB.") for _ in range(rng.randint(0, 12)))
            if re.search(pattern, text):
                assert literal in text.lower(), (pattern, text)


def test_grams():
    assert literal_gram("ab") is None
    assert literal_gram("abcdefgh") in set(gram_hashes("xx ABCDEFGH yy", 6).view("int64").tolist())
    assert len(gram_hashes("\U0001F600a", 3)) == 0


def test_a_hundred_thousand_patterns(spark):
    rng = random.Random(4)
    rows = [(f"c{i}", rng.choice([f"word{i:06d}", f"(?i)WORD{i:06d}", rf"\bword{i:06d}\b", f"word{i:06d}s?", f"[xw]ord{i:06d}"]),
             rng.choice(["warn", "block"])) for i in range(100_000)]
    rows += [("short", "qz", "warn"), ("digits", r"\d{9}", "block"), ("either", "zebra|okapi", "warn"), ("null", None, "warn")]
    texts = [(i % 40, " ".join(f"{rng.choice(['word', 'Word', 'xord'])}{rng.randrange(100_000):06d}" for _ in range(rng.randint(0, 60))))
             for i in range(50)]
    texts += [(50, "a qz 123456789 okapi"), (51, None), (52, "")]
    lexicon = spark.createDataFrame(rows, "clause string, pattern string, severity string").repartition(8)
    got = sorted(tuple(r) for r in tos_flags(spark.createDataFrame(texts, "doc long, content string"), lexicon, "doc").collect())
    want, compiled = [], {}
    for k, text in texts:
        numbers = {int(x) for x in re.findall(r"ord(\d{6})", text or "", re.I)}
        for i in [*numbers, *range(100_000, 100_003)]:
            clause, pattern, severity = rows[i]
            if text is not None and compiled.setdefault(pattern, re.compile(pattern)).search(text):
                want.append((k, clause, severity))
    assert got == sorted(want) and len(want) > 500
