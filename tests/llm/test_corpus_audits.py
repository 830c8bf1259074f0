"""Source divergence, repeated byte strings and hard negatives against brute
force, on odd rows: nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with the names of results."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webloom.llm import divergence, hard_negatives, suffix_dedup

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---------------------------------------------------------------- divergence

def audit_brute(rows, min_docs, top):
    docs = [(lang or "", source or "", TERM.findall(lower(text or ""))) for lang, source, text in rows]
    seen, counts = collections.Counter(), collections.Counter()
    for lang, source, terms in docs:
        seen.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = set()
    for lang in {d[0] for d in docs}:
        kept = sorted(t for (x, t), n in seen.items() if x == lang and n >= min_docs)
        sources = sorted({s for x, s, _ in docs if x == lang})
        total = {s: sum(counts[lang, s, t] for t in kept) for s in sources}

        def p(n, of):
            return 1 + 1_000_000_000 * (n + 2) // (of + 2 * len(kept))

        def f(a, b):
            return (a - b) * (a - b) // (a + b)

        for s in sources:
            pairs = [(-sum(f(p(counts[lang, s, t], total[s]), p(counts[lang, o, t], total[o])) for t in kept), o)
                     for o in sources if o != s]
            terms = []
            for t in kept:
                a = p(counts[lang, s, t], total[s])
                b = p(sum(counts[lang, o, t] for o in sources), sum(total.values()))
                if counts[lang, s, t] and a > b:
                    terms.append((-f(a, b), t.encode()))
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(sorted(pairs))}
            out |= {(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(sorted(terms)[:top])}
    return out


def audit_rows():
    rng = random.Random(3)
    words = ["the", "The,", "a b", "x-y", "été", "ÉTÉ", "zoë", "don't", "a1b2c", "http://a.com/the", "🙂", "z" * 40, "İ", " ", "-", "1"]
    words += ["w" + "".join(rng.choice("abc") for _ in range(3)) for _ in range(60)]
    rows = [(rng.choice(["en", "fr"]), f"s{rng.randrange(6)}", rng.choice([" ", "\n", "\t", "\x0b "]).join(rng.choices(words, k=rng.randrange(60))))
            for _ in range(120)]
    rows += [(None, None, "alone the"), ("xx", "one", None), ("xx", "two", ""), ("yy", "only", "a b"), ("en", "s1", None), ("en", "empty", "")]
    rows += [("en", "dup", "same words here")] * 7 + [("fr", "long", "the big " * 20_000), ("fr", "long", "u" * 300_000)]
    return rows


@pytest.mark.parametrize("blocks", [(2048, 512), (16, 2)])
def test_audit_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", blocks[0])
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", blocks[1])
    rows = audit_rows()
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("term", F.lit(1)).withColumn(
        "value", F.lit("x")).withColumn("n", F.lit(2)).repartition(4)
    got = [tuple(r) for r in divergence.audit(df, min_docs=5, top=4).collect()]
    assert len(got) == len(set(got)) and set(got) == audit_brute(rows, 5, 4)


def test_audit_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, lang string, source string, text string")
    assert divergence.audit(df).collect() == []


def test_counts_of_a_block_move_as_one_row_a_part(monkeypatch):
    rows = [(lang or "", source or "", text or "") for lang, source, text in audit_rows()]
    want = collections.Counter((lang, source, t) for lang, source, text in rows for t in TERM.findall(lower(text)))
    docs = collections.Counter((lang, source, t) for lang, source, text in rows for t in set(TERM.findall(lower(text))))
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i::3], strict=True)], names=["lang", "source", "text"]) for i in range(3)]
    for parts, held in ((1, 1 << 20), (5, 1 << 20), (5, 1)):
        monkeypatch.setattr(divergence, "PART_BYTES", held)
        dealt = [b for batch in batches for b in divergence._counted(iter([batch]), parts)]
        assert all(b.num_rows <= parts for b in dealt)
        pieces = pa.Table.from_batches(dealt).sort_by("part").combine_chunks().to_batches()
        n, most, least = collections.Counter(), collections.Counter(), {}
        for b in divergence._tokenized(iter(pieces)):
            for r in b.to_pylist():
                key = r["lang"], r["source"], r["term"]
                n[key] += r["n"]
                most[key] += r["most"]
                least[key] = max(least.get(key, 0), r["least"])
        assert n == want
        assert all(least[k] <= docs[k] <= most[k] for k in want)


# -------------------------------------------------------------- suffix dedup

def spans_brute(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        spans = []
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append([tuple(s) for s in spans])
    return out


def dedup_texts(seed):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefghij klmnop\né") for _ in range(n))

    shared = [noise(rng.randint(380, 900)) for _ in range(4)]
    texts = [noise(rng.randint(0, 300)) + (shared[0] if rng.random() < 0.9 else "") + noise(rng.choice([0, 3, 400]))
             + (shared[rng.randint(1, 3)] if rng.random() < 0.3 else "") + noise(rng.randint(0, 300)) for _ in range(200)]
    texts += ["x" * 3000, "ab" * 900, "x" * 401 + "y" + "x" * 500, "", None, shared[0], shared[0][:399], shared[0][:400], "\0" * 1000,
              "\0" * 700 + "a", noise(37) * 60, texts[5], texts[5], texts[6] + "t", "t" + texts[7], noise(100) + texts[8][100:]]
    return texts


@pytest.mark.parametrize("block", [256, 4])
def test_removed_bytes_equal_brute_force(spark, block):
    texts = dedup_texts(block)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "q" * 500)]
    want = collections.defaultdict(list)
    for (i, t), spans in zip(rows, spans_brute([(t or "").encode() for _, t in rows], 400), strict=True):
        data, at, kept = (t or "").encode(), 0, b""
        for a, b in spans:
            kept, at = kept + data[at:a], b
        want[i].append((spans, kept + data[at:]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("core", F.lit("x")).withColumn("spans", F.lit(1)).repartition(5)
    got = collections.defaultdict(list)
    for r in suffix_dedup.remove_repeats(df, 400, block).collect():
        got[r.doc_id].append(([(x["from"], x["to"]) for x in r.spans], bytes(r.kept)))
    assert got == want


def test_phrases_cover_all_starts_across_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    rng = np.random.default_rng(1)
    sizes = [0, 399, 400, 401, 7_000, 0, 2_500, 650]
    data = np.concatenate([rng.integers(97, 100, n, dtype=np.uint8) if n != 2_500 else np.full(n, 120, dtype=np.uint8) for n in sizes])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    covered, anchors = [], set()
    for row, t, s, e in suffix_dedup.phrases(data, bounds, 400):
        assert (s <= e).all() and (t >= e).all() and (t - s < suffix_dedup.REACH).all()
        for r, trigger, a, b in zip(row.tolist(), t.tolist(), s.tolist(), e.tolist(), strict=True):
            covered += range(a, b + 1)
            assert bounds[r] <= a and b + 400 <= bounds[r + 1] and (r, trigger) not in anchors
            anchors.add((r, trigger))
    assert sorted(covered) == [i for lo, hi in zip(bounds, bounds[1:], strict=False) for i in range(lo, hi - 399)]


def test_dedup_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_dedup.remove_repeats(df).collect() == []


# ------------------------------------------------------------ hard negatives

def mine_brute(rows, anchor, relabel):
    rows = [(i, relabel(i, label), [math.floor(256 * x) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, x) in enumerate(rows):
        if not anchor(i):
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=False)), j, m) for b, (j, m, y) in enumerate(rows) if b != a]
        for s, j, _ in sorted(t for t in scored if t[2] == label)[:5]:
            fit = sorted((t, k) for t, k, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s)
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fit[:3])]
    return collections.Counter(out)


@pytest.mark.parametrize("block,stride", [(1024, 128), (64, 128)])
def test_mined_rows_equal_brute_force(spark, monkeypatch, block, stride):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "BATCH", 20)
    rng = np.random.default_rng(block)
    centers = rng.normal(size=(5, 12))
    rows = [(int(i), int(i % 5), [float(np.float32(v)) for v in centers[i % 5] * 0.3 + rng.normal(size=12) * 0.4]) for i in range(600)]
    rows += [(700 + i, 2, rows[10][2]) for i in range(300)]  # one common vector
    rows += [rows[20], rows[20], (1000, 1, [0.0] * 12), (1005, 1, [0.1] * 5), (1010, 3, []), (1015, None, [1.0] * 12), (None, 1, [1.0] * 12),
             (1020, 1, None), (1025, 1, [1.0, None]), (1030, 1, [float("nan")] * 12), (1035, 1, [float("inf")] * 12), (1040, 77, [0.5] * 12),
             (-5, 2, [-0.2] * 12)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").withColumn("score", F.lit("a")).withColumn(
        "rank", F.lit(1)).withColumn("x", F.lit(1)).repartition(4)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = collections.Counter(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 5 == 0, label).collect())
    f32 = [(i, m, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, m, v in rows]
    assert got == mine_brute(f32, lambda i: i % 5 == 0, lambda i, m: (m + 1) % 10 if i % 7 == 0 else m)


def test_walks_end_early_without_loss():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 16)) * 40
    x[:400] += 200
    x = np.floor(x)
    own = {"x": np.floor(x[:5] + 3), "uid": np.arange(5) + 10_000, "label": np.zeros(5, dtype=np.int64)}
    lists = {"x": x, "uid": np.arange(4000), "vec_id": np.arange(4000), "label": np.zeros(4000, dtype=np.int64)}
    none, everything = np.full((5, 1), hard_negatives.NONE), np.full((5, 1), -hard_negatives.NONE)
    member, _, cand, score = hard_negatives._walk(own, lists, none, everything, none, 5, True)
    for i in range(5):
        want = sorted(zip((-(own["x"][i] @ x.T)).tolist(), range(4000), strict=True))[:5]
        assert sorted(zip((-score[member == i]).tolist(), cand[member == i].tolist(), strict=True)) == want


def test_mining_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>")
    assert hard_negatives.mine(df, F.col("vec_id") % 50 == 0).collect() == []
