"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, homoglyphs of Latin letters, digits and
signs that stand for letters, invisible characters removed. The lexicon is
learned from labelled rows: word beginnings and whole words that are far more
frequent in toxic than in clean texts, weighted by their log odds. A term must
occur in ``support`` different contexts, so a group of copies cannot vouch for
a word. Exception phrases, also learned, are two-word phrases around a term
that clean texts use. The score is a logistic function of the matched weight,
whole and normalised by the text's length.

Training uses at most ``sample`` labelled rows (chosen by a hash of doc_id, the
bound is a parameter); scoring reads every whole text. The inputs of a score are the text
alone.

Rows: one output row per input row; null and empty texts score like a text
without matches. Rows with a null doc_id are never used for training. A
doc_id with several labels counts as toxic if any label is 1; null labels are
ignored. With no usable labels the lexicon is empty and all scores are 0.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import require

# Look-alikes of Latin letters, and digits and signs used for
# letters. l, 1, | and i look alike, so they become one letter.
HOMOGLYPHS = dict(zip("авсеһіјкмнорԛтухѕԁԝαβεηικνορτυχ", "abcehijkmhopqtyxsdwabenikvoptux", strict=True))
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "i", "l": "i"}
INVISIBLE = "­​‌‍⁠﻿"
FULL_WIDTH = {chr(0xFF01 + i): chr(0x21 + i).lower() for i in range(94)}

_ASCII = str.maketrans(SIGNS)
_ALL = str.maketrans({**HOMOGLYPHS, **{k: SIGNS.get(v, v) for k, v in FULL_WIDTH.items()}, **SIGNS,
                      **dict.fromkeys(INVISIBLE, None)})
_WORD = re.compile(r"[^\W_]+")
SHORTEST, LONGEST = 4, 8
CUT = 0.3


def fold(text: str) -> str:
    text = text.lower()
    return text.translate(_ASCII if text.isascii() else _ALL)


@dataclass
class Lexicon:
    """Weights of terms (``idiot$`` a whole word, ``idio`` a beginning),
    exception phrases, and the logistic coefficients."""
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    coef: tuple[float, ...] = ()

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.terms.items():
            self.automaton.add_word(term.rstrip("$"), (len(term.rstrip("$")), term.endswith("$"), weight, term))
        if lexicon.terms:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float, str]]:
        """(start, end, weight, term) of the matches at word starts; of the terms
        that match one word the first to end counts."""
        if not self.lexicon.terms:
            return []
        out, last, n = [], -1, len(folded)
        for end, (size, whole, weight, term) in self.automaton.iter(folded):
            start, end = end - size + 1, end + 1
            if start == last or (start and folded[start - 1].isalnum()):
                continue
            if whole and end < n and folded[end].isalnum():
                continue
            last = start
            out.append((start, end, weight, term))
        return out

    def phrases(self, folded: str, start: int) -> list[str]:
        """The word at ``start`` with the word before and the word after it."""
        word = _WORD.match(folded, start)
        before = _WORD.findall(folded, max(0, start - 40), start)[-1:]
        after = _WORD.search(folded, word.end(), word.end() + 40)
        return [f"{b} {word[0]}" for b in before] + ([f"{word[0]} {after[0]}"] if after else [])

    def features(self, text: str | None) -> tuple[float, float]:
        folded = fold(text or "")
        total = 0.0
        for start, _, weight, _ in self.hits(folded):
            if self.lexicon.exceptions and self.lexicon.exceptions.intersection(self.phrases(folded, start)):
                continue
            total += weight
        if not total:
            return 0.0, 0.0
        return float(np.log1p(total)), float(np.log1p(100 * total / (len(folded.split()) + 10)))

    def score(self, text: str | None) -> float:
        if not self.lexicon.coef:
            return 0.0
        x = self.features(text)
        a = self.lexicon.coef
        return float(1 / (1 + np.exp(-(a[0] + a[1] * x[0] + a[2] * x[1]))))


def terms_of(text: str) -> set[str]:
    """Candidate terms of a text: the words and their beginnings."""
    out = set()
    for w in set(_WORD.findall(fold(text))):
        out.add(w + "$")
        out.update(w[:k] for k in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return out


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, toxic) of at most about ``sample`` labelled rows that are
    not held out. A label is for a doc_id, so each gives one row: of several
    texts with the same doc_id the one with the lowest hash."""
    known = (labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
             .where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, sample / max(1, known.count()))
    part = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select("doc_id", "text").join(F.broadcast(part), "doc_id")
    pick = F.struct(F.xxhash64("text").alias("h"), "text")
    return rows.groupBy("doc_id", "toxic").agg(F.min(pick).alias("row")).select("doc_id", "row.text", "toxic")


def _count_terms(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic > 0].update(terms_of(text or ""))
            names = list(counts[0].keys() | counts[1].keys())
            for lo in range(0, len(names), 50_000):
                part = names[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array([counts[0][t] for t in part], pa.int64()),
                     pa.array([counts[1][t] for t in part], pa.int64())], names=["term", "clean", "toxic"])
    return rows.select("text", "toxic").mapInArrow(run, "term string, clean bigint, toxic bigint")


def _contexts(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(kind, term or phrase, context, toxic) of every match in the rows."""
    def run(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = fold(text or "")
                for start, _, _, term in matcher.hits(folded):
                    found = matcher.phrases(folded, start)
                    out.append(("t", term, " ".join(found), int(toxic > 0)))
                    out += [("p", p, folded[max(0, start - 30):start + 40], int(toxic > 0)) for p in found]
            kind, what, context, toxic = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.string()), pa.array(what, pa.string()), pa.array(context, pa.string()),
                 pa.array(toxic, pa.int32())], names=["kind", "what", "context", "toxic"])
    return rows.select("text", "toxic").mapInArrow(run, "kind string, what string, context string, toxic int")


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Newton's method with a small ridge on the slopes."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([1e-3] + [ridge * 1e-2] * (x.shape[1] - 1))
    a = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ a)
        a = a + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in a)


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000, support: int = 10,
          least_odds: float = 3.0) -> Lexicon:
    """Learn the lexicon. Terms need log odds of ``least_odds`` and ``support``
    different contexts; of a term and its beginnings the one with the larger
    (rounded) odds is taken, the shorter one where they are equal. What reaches the driver is bounded by the sample."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    rows = training_rows(docs, labels, sample).cache()
    try:
        n = {r["toxic"]: r["count"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
        if len(n) < 2:
            return Lexicon()
        odds = (F.log((F.col("toxic") + 0.5) / (n[True] + 1)) - F.log((F.col("clean") + 0.5) / (n[False] + 1)))
        found = (_count_terms(rows).groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
                 .where(F.col("toxic") >= support).withColumn("odds", odds).where(F.col("odds") >= least_odds)
                 .select("term", "odds", "clean").collect())
        weights = {r["term"]: r["odds"] for r in found}
        matched = _contexts(rows, Lexicon(weights)).groupBy("kind", "what").agg(
            F.countDistinct(F.when(F.col("toxic") == 1, F.col("context"))).alias("toxic"),
            F.countDistinct(F.when(F.col("toxic") == 0, F.col("context"))).alias("clean")).collect()
        vouched = {r["what"] for r in matched if r["kind"] == "t" and r["toxic"] >= support}
        terms: dict[str, float] = {}
        taken: set[str] = set()  # beginnings of the taken terms
        for term in sorted(vouched, key=lambda t: (-round(weights[t]), len(t.rstrip("$")), t)):
            word = term.rstrip("$")
            if word not in taken and not any(word[:k] in terms for k in range(SHORTEST, len(word) + 1)):
                terms[term] = float(weights[term])
                taken.update(word[:k] for k in range(1, len(word) + 1))
        exceptions = frozenset(r["what"] for r in matched if r["kind"] == "p" and r["clean"] >= 3
                               and r["clean"] / n[False] > r["toxic"] / n[True])
        lexicon = Lexicon(terms, exceptions)

        def run(batches):
            matcher = lexicon.matcher()
            for batch in batches:
                x = [matcher.features(t) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()),
                     batch.column(1).cast(pa.int32())], names=["a", "b", "toxic"])

        points = (rows.select("text", "toxic").mapInArrow(run, "a double, b double, toxic int").collect())
        data = np.array([[p["a"], p["b"], p["toxic"] > 0] for p in points], dtype=float)
        lexicon.coef = _logistic(data[:, :2], data[:, 2])
        return lexicon
    finally:
        rows.unpersist()


def score(docs: DataFrame, lexicon: Lexicon, name: str = "score") -> DataFrame:
    """The rows with a ``score`` column (replacing one of that name); no shuffle."""
    require(docs, "text")
    rest = docs.drop(name)
    at = rest.columns.index("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)

    def run(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            out = [matcher.score(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())],
                                             names=[*batch.schema.names, name])

    return rest.mapInArrow(run, f"{fields}, `{name}` double")
