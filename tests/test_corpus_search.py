"""Exact top-k search against brute force, and how little of it is scored."""
import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from webloom.operators.search import corpus_search, search_candidates


def brute(queries, docs, limit):
    tokens = {i: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w] for i, t in docs}
    n, avg = len(docs), sum(map(len, tokens.values())) / max(1, sum(t is not None for _, t in docs))
    tf = {i: collections.Counter(t) for i, t in tokens.items()}
    df = collections.Counter(w for c in tf.values() for w in c)
    out = {}
    for q, text in queries:
        scores = collections.Counter()
        for w in set(re.split(r"[\W_]+", (text or "").lower())) - {""}:
            idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
            for i, c in tf.items():
                if c[w]:
                    scores[i] += idf * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * len(tokens[i]) / avg))
        best = sorted(((round(-s, 6), i) for i, s in scores.items()))[:limit]
        out[q] = [(i, r + 1) for r, (_, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("limit", [1, 10])
def test_equals_brute_force(spark, limit):
    rng = random.Random(limit)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 20, 200])))) for i in range(400)]
    docs += [(400 + i, docs[7][1]) for i in range(15)] + [(500, None), (501, ""), (502, "w0 " * 3_000)]
    queries = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(30)]
    queries += [(50, docs[7][1]), (51, "unknown words"), (52, ""), (53, None), (54, "w0"), (55, "W0, w1")]
    got = collections.defaultdict(list)
    for r in corpus_search(spark.createDataFrame(queries, "query_id long, query string"),
                           spark.createDataFrame(docs, "doc_id long, text string"), limit).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r["rank"]))
    want = brute(queries, docs, limit)
    assert {q: w for q, w in want.items() if w} == dict(got)


def test_few_pairs_are_scored(spark):
    sf = "/root/testdata/sf0.01"
    q = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    scores, postings = search_candidates(q, d, 10)
    terms = q.select("query_id", F.explode(F.split(F.lower("query"), r"[^\p{L}\p{N}]+")).alias("term")).distinct()
    pairs = terms.join(postings, "term").select("query_id", "doc_id").distinct().count()
    scored = scores.count()
    assert pairs == 28_948 and 400 <= scored < pairs * 0.35, (scored, pairs)
