"""Search (Q1-Q12) over captured result pages and over the corpus itself.

The result page is tokenised once (Arrow job) into raw result blocks; ad
filtering, redirect unwrapping, date extraction, ranking and the limit are
native SQL. Ranking windows are per query (a result page holds a bounded
number of results), and enrichment scrapes each distinct URL once and joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from webloom.functions.text import js_trim
from webloom.operators.scrape import scrape
from webloom.sources.captures import latest_captures
from webloom.options import SearchOptions

# The result-page provider's redirect marker and own domain.
REDIRECT_MARK = "duckduckgo.com/l/"
SELF_PREFIX = "https://duckduckgo.com"
SELF_DOMAIN = "duckduckgo.com"

_BLOCK = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("has_title", T.BooleanType()),
    T.StructField("href", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("snippet", T.StringType()),
])
_ANCHOR = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("text", T.StringType()),
])


def build_query(queries: DataFrame) -> DataFrame:
    """Q1: ``queries`` has query_id, query and optional site / after /
    before columns. Adds ``q`` (the provider query string) and ``error``
    (INVALID_URL for a blank query)."""
    def opt(name):
        return F.col(name) if name in queries.columns else F.lit(None).cast("string")
    base = js_trim(F.col("query"))
    q = F.when(opt("site").isNotNull(), F.concat(F.lit("site:"), opt("site"), F.lit(" "), base)) \
        .otherwise(base)
    q = F.when(opt("after").isNotNull(),
               F.concat(q, F.lit(" after:"), F.substring(opt("after"), 1, 10))).otherwise(q)
    q = F.when(opt("before").isNotNull(),
               F.concat(q, F.lit(" before:"), F.substring(opt("before"), 1, 10))).otherwise(q)
    blank = F.coalesce(base, F.lit("")) == ""
    return queries.select("*", F.when(blank, F.lit(None)).otherwise(q).alias("q"),
                          F.when(blank, F.lit("INVALID_URL")).alias("error"))


def _parse_serp(serps: DataFrame) -> DataFrame:
    schema = T.StructType([f for f in serps.schema.fields if f.name != "html"] + [
        T.StructField("blocks", T.ArrayType(_BLOCK)),
        T.StructField("anchors", T.ArrayType(_ANCHOR))])
    keep = [f.name for f in serps.schema.fields if f.name != "html"]

    def run(batches):
        import pyarrow as pa

        from webloom.functions.html import START, Document

        def descendants(doc, el):
            for ev in doc.events[el.ev_start:el.ev_end]:
                if ev[0] == START:
                    yield ev[2]

        block_t = pa.list_(pa.struct([(f.name, pa.string() if isinstance(f.dataType, T.StringType)
                                       else pa.int32() if isinstance(f.dataType, T.IntegerType)
                                       else pa.bool_() if isinstance(f.dataType, T.BooleanType)
                                       else pa.list_(pa.string())) for f in _BLOCK.fields]))
        anchor_t = pa.list_(pa.struct([("idx", pa.int32()), ("href", pa.string()),
                                       ("text", pa.string())]))
        for batch in batches:
            blocks_col, anchors_col = [], []
            for h in batch.column("html").to_pylist():
                if h is None:
                    blocks_col.append(None)
                    anchors_col.append(None)
                    continue
                doc = Document(h)
                blocks, anchors = [], []
                elements = [ev[2] for ev in doc.events if ev[0] == START]
                for el in elements:
                    cls = el.classes
                    if "result" in cls:
                        inner = list(descendants(doc, el))
                        title_el = None
                        for d in inner:
                            if d.tag == "a" and any("result__title" in a.classes
                                                    for a in _ancestors_within(d, el)):
                                title_el = d
                                break
                        if title_el is None:
                            title_el = next((d for d in inner if "result__a" in d.classes), None)
                        snip = next((d for d in inner if "result__snippet" in d.classes), None)
                        blocks.append({
                            "idx": len(blocks), "classes": cls,
                            "has_title": title_el is not None,
                            "href": (title_el.attrs.get("href", "") if title_el is not None else None),
                            "title": doc.text_of(title_el) if title_el is not None else None,
                            "snippet": doc.text_of(snip) if snip is not None else None})
                    if el.tag == "a" and ("result__a" in cls or "result__url" in cls):
                        anchors.append({"idx": len(anchors), "href": el.attrs.get("href", ""),
                                        "text": doc.text_of(el)})
                blocks_col.append(blocks)
                anchors_col.append(anchors)
            arrays = [batch.column(n) for n in keep]
            arrays += [pa.array(blocks_col, type=block_t), pa.array(anchors_col, type=anchor_t)]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + ["blocks", "anchors"])

    from webloom.session import spread
    return spread(serps, "query_id").mapInArrow(run, schema)


def _ancestors_within(node, stop):
    p = node.parent
    while p is not None and p is not stop:
        yield p
        p = p.parent


def unwrap_redirect(href) -> F.Column:
    """Q5: the provider's redirect target (decoded as a query parameter, then
    once more as a URI component); ``http...`` as is; ``//x`` as ``https://x``;
    otherwise NULL."""
    h = F.col(href) if isinstance(href, str) else href
    uddg = F.regexp_extract(h, r"[?&]uddg=([^&#]*)", 1)
    once = F.try_url_decode(uddg)
    twice = F.try_url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))
    direct = (F.when(h.startswith("http"), h)
              .when(h.startswith("//"), F.concat(F.lit("https:"), h)))
    return F.when(h.contains(REDIRECT_MARK) & (F.coalesce(once, F.lit("")) != "")
                  & twice.isNotNull(), twice).otherwise(direct)


def extract_date(snippet, as_of) -> F.Column:
    """Q7: first ``YYYY-MM-DD`` in the snippet, else ``N day/week/month/year(s)
    ago`` counted back from ``as_of`` (a date), with JavaScript's month
    overflow (31 Mar - 1 month = 2 or 3 Mar)."""
    s = F.col(snippet) if isinstance(snippet, str) else snippet
    d = F.to_date(as_of) if not isinstance(as_of, str) else F.to_date(F.col(as_of))
    iso = F.regexp_extract(s, r"\d{4}-\d{2}-\d{2}", 0)
    rel = r"(?i)(\d+)\s+(day|week|month|year)s?\s+ago"
    n = F.regexp_extract(s, rel, 1).try_cast("int")
    unit = F.lower(F.regexp_extract(s, rel, 2))

    def back_months(k):
        return F.date_add(F.add_months(F.trunc(d, "MM"), -k), F.dayofmonth(d) - 1)
    relative = (F.when(unit == "day", F.date_sub(d, n))
                .when(unit == "week", F.date_sub(d, n * 7))
                .when(unit == "month", back_months(n))
                .when(unit == "year", back_months(n * 12)))
    return (F.when(iso != "", iso)
            .when(unit != "", F.date_format(relative, "yyyy-MM-dd")))


def parse_serps(serp_captures: DataFrame, limit: int = 10) -> tuple[DataFrame, DataFrame]:
    """Q2-Q8 (+Q4 fallback). Returns (results, errors): results are query_id,
    position, url, title, description, published_at; a non-2xx capture is an
    error row (NETWORK_ERROR)."""
    SearchOptions(limit=limit)
    cols = serp_captures.columns
    status = F.col("status_code") if "status_code" in cols else F.lit(200)
    ok = serp_captures.filter(status.between(200, 299))
    errors = serp_captures.filter(~status.between(200, 299)).select(
        "query_id", F.lit("NETWORK_ERROR").alias("code"),
        F.concat(F.lit("Search request failed: HTTP "), status.cast("string")).alias("message"))
    parsed = _parse_serp(ok.select("query_id", "html", "fetched_at"))
    # A result page's blocks and anchors are judged within its row: one parse, no exchange.
    kept = F.filter("blocks", lambda r: ~F.array_contains(r["classes"], "result--ad")
                    & ~F.array_contains(r["classes"], "result--more") & r["has_title"])
    main = F.transform(kept, lambda r: F.struct(
        unwrap_redirect(r["href"]).alias("url"), js_trim(r["title"]).alias("title"),
        F.coalesce(js_trim(r["snippet"]), F.lit("")).alias("description"),
        extract_date(F.coalesce(r["snippet"], F.lit("")), F.col("fetched_at")).alias("published_at")))
    main = F.filter(main, lambda r: r["url"].isNotNull() & ~r["url"].startswith(SELF_PREFIX))
    fallback = F.transform("anchors", lambda r: F.struct(
        unwrap_redirect(r["href"]).alias("url"), js_trim(r["text"]).alias("title"),
        F.lit("").alias("description"), F.lit(None).cast("string").alias("published_at")))
    fallback = F.filter(fallback, lambda r: r["url"].isNotNull() & ~r["url"].contains(SELF_DOMAIN))
    fallback = F.transform(fallback, lambda r: F.struct(
        r["url"].alias("url"), F.when(r["title"] == "", r["url"]).otherwise(r["title"]).alias("title"),
        r["description"].alias("description"), r["published_at"].alias("published_at")))
    listed = parsed.select("query_id", main.alias("main"), fallback.alias("fallback")).select(
        "query_id", F.slice(F.when(F.size("main") > 0, F.col("main")).otherwise(F.col("fallback")), 1, limit).alias("listed"))
    results = (listed.select("query_id", F.posexplode("listed").alias("position", "r"))
               .select("query_id", "r.url", "r.title", "r.description", "r.published_at",
                       (F.col("position") + 1).alias("position")))
    return results, errors


PAGE_FIELDS = ("title", "format", "status_code", "crawled_at", "description", "og_image", "author",
               "published_at", "links", "word_count")


def enrich(results: DataFrame, captures: DataFrame, format: str = "markdown") -> DataFrame:
    """Q9: attach the scraped page of each result URL, its latest capture:
    ``content`` and, named ``page_...``, the other fields of the page; results
    whose page is not captured keep NULLs. Each distinct URL is scraped once."""
    # The results feed two branches (distinct URLs, final join); materialise
    # them once (they are at most ``limit`` rows per query) so the result-page
    # parse is not run twice.
    from webloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(results.sparkSession)
    results = results.checkpoint(eager=True)
    urls = results.select("url").distinct()
    pages = scrape(latest_captures(captures.join(urls, "url", "left_semi")), format)
    p = pages.select("url", "content", *[F.col(c).alias(f"page_{c}") for c in PAGE_FIELDS])
    return results.join(p, "url", "left")


def search_summary(results: DataFrame, queries: DataFrame, errors: DataFrame) -> DataFrame:
    """Q10: results per query (0 for a page without results), error code."""
    n = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    return (queries.select("query_id", "query").join(n, "query_id", "left")
            .join(errors.select("query_id", F.col("code").alias("error")), "query_id", "left")
            .select("query_id", "query", F.coalesce("total", F.lit(0)).alias("total"), "error"))


def filter_results(results: DataFrame, site: str | None = None, after: str | None = None,
                   before: str | None = None) -> DataFrame:
    """Q11: keep results on ``site`` (host or a subdomain of it) and with a
    known ``published_at`` inside (after, before)."""
    from webloom.functions.urls import url_host
    r = results
    if site:
        h = url_host("url")
        r = r.filter((h == site.lower()) | h.endswith("." + site.lower()))
    if after:
        r = r.filter(F.col("published_at") > F.lit(after[:10]))
    if before:
        r = r.filter(F.col("published_at") < F.lit(before[:10]))
    return r


@dataclass
class SearchResult:
    queries: DataFrame   # query_id, query, q (the provider's query string), error
    results: DataFrame   # query_id, position, url, title, description, published_at (+ content, page_...)
    summary: DataFrame   # query_id, query, total, error


def search(queries: DataFrame, serp_captures: DataFrame, captures: DataFrame | None = None,
           opts: SearchOptions = SearchOptions()) -> SearchResult:
    """One search with all its options: query strings with site, after and
    before; the captured result pages parsed, kept to that site and those
    dates, ranked anew and cut at the limit; the pages themselves attached in
    ``opts.format`` with ``scrape_content`` (needs ``captures``)."""
    if opts.scrape_content and captures is None:
        raise ValueError("scrape_content needs captures")
    asked = queries.select("query_id", "query", *[
        F.lit(getattr(opts, name)).cast("string").alias(name) for name in ("site", "after", "before")])
    built = build_query(asked).select("query_id", "query", "q", "error")
    narrow = any((opts.site, opts.after, opts.before))
    found, errors = parse_serps(serp_captures, SearchOptions.MOST if narrow else opts.limit)
    if narrow:
        by_rank = Window.partitionBy("query_id").orderBy("position")  # one result page
        found = (filter_results(found, opts.site, opts.after, opts.before)
                 .withColumn("position", F.row_number().over(by_rank)).filter(F.col("position") <= opts.limit))
    summary = search_summary(found, built, errors)
    results = enrich(found, captures, opts.format) if opts.scrape_content else found
    return SearchResult(built, results, summary)


# ------------------------------------------------------------ corpus search ---

BM25_K1 = 1.2
BM25_B = 0.75
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
#: Documents of a posting block, on average; blocks hold documents of like length.
BLOCK_DOCS = 32
#: Length classes per doubling of the length; a class number is below 31 times this.
LENGTH_CLASSES = 8
#: Rare postings (as a multiple of the limit) that give the first bound, and
#: documents (likewise) that are scored in full for it.
RARE_POSTINGS, SEEDS = 10, 3
#: Scores are rounded to 6 places, so a bound that misses by less may still tie.
SLACK = 2e-6


def _terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (df.select(id_col, F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)).alias("term"))
            .filter(F.col("term") != ""))


def _postings(corpus: DataFrame, vocabulary: DataFrame, k1: float, b: float) -> DataFrame:
    """(term, doc_id, block, s): the score that a term of the vocabulary gives
    to each of its documents. Documents of like length share a block of about
    BLOCK_DOCS (by a hash within a length class), since length bounds scores."""
    from webloom.session import spread, stored
    toks = F.filter(F.split(F.lower(F.col("text")), TOKEN_SPLIT), lambda t: t != "")
    docs = spread(corpus.select("doc_id", "text"), "doc_id").select("doc_id", toks.alias("toks"))
    size_class = F.floor(F.log2(F.col("dl") + 1.0) * LENGTH_CLASSES).cast("int")
    # At most 31 * LENGTH_CLASSES rows: documents and words of each length class.
    length = F.when(F.col("toks").isNotNull(), F.size("toks"))
    classes = (docs.select(length.alias("words"), F.coalesce(length, F.lit(0)).alias("dl")).groupBy(size_class.alias("c"))
               .agg(F.count("*").alias("n"), F.count("words").alias("texts"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
               .collect())
    n_docs = sum(r.n for r in classes)
    avgdl = sum(r.words for r in classes) / max(1, sum(r.texts for r in classes))
    parts = [1] * (1 + max([r.c for r in classes], default=0))
    for r in classes:
        parts[r.c] = -(-r.n // BLOCK_DOCS)
    tf = (docs.select("doc_id", F.size("toks").alias("dl"), F.explode("toks").alias("term"))
          .join(vocabulary, "term", "left_semi")
          .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl")))
    tf = stored(tf, "term-frequencies")
    idf = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
           .select("term", "df", F.ln(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")))
    part = F.pmod(F.xxhash64("doc_id"), F.element_at(F.array(*map(F.lit, parts)), F.col("c") + 1))
    weight = (F.col("idf") * F.col("tf") * (k1 + 1)
              / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.lit(avgdl))))
    return stored(tf.join(idf, "term").withColumn("c", size_class)
                  .select("term", "doc_id", (F.col("c").cast("long") * (1 << 40) + part).alias("block"),
                          weight.alias("s"), "df"), "postings")


def _top(scores: DataFrame, limit: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def _first_bound(qt: DataFrame, postings: DataFrame, limit: int) -> DataFrame:
    """(query_id, bound): a lower bound on each query's ``limit``-th score. The
    rarest terms, up to RARE_POSTINGS * limit postings, point to documents; the
    best of these are scored in full."""
    df = postings.groupBy("term").agg(F.first("df").alias("df"))
    by_df = Window.partitionBy("query_id").orderBy("df", "term")  # the terms of one query
    rare = (qt.join(df, "term")
            .withColumn("before", F.sum("df").over(by_df.rowsBetween(Window.unboundedPreceding, -1)))
            .filter(F.coalesce("before", F.lit(0)) < RARE_POSTINGS * limit).select("query_id", "term"))
    partial = (rare.join(postings, "term").groupBy("query_id", "doc_id").agg(F.sum("s").alias("score")))
    seeds = _top(partial, SEEDS * limit).select("query_id", "doc_id")
    full = (seeds.join(qt, "query_id").join(postings.select("term", "doc_id", "s"), ["term", "doc_id"])
            .groupBy("query_id", "doc_id").agg(F.sum("s").alias("score")))
    return (_top(full, limit).groupBy("query_id")
            .agg(F.when(F.count("*") >= limit, F.min("score")).otherwise(0.0).alias("bound")))


def search_candidates(queries: DataFrame, corpus: DataFrame, limit: int = 10,
                      k1: float = BM25_K1, b: float = BM25_B) -> tuple[DataFrame, DataFrame]:
    """The two steps of ``corpus_search``: all (query_id, doc_id, score) that
    are scored in full, and the postings they come from. Block by block, the
    query's terms are ordered by their largest score in the block; the lowest
    ones that together stay below the query's bound cannot bring a document
    into the result alone. Only documents with another term are looked at, and
    only those whose score so far plus the rest of the block's maxima reaches
    the bound get the scores of the common terms."""
    from webloom.session import stored
    qt = stored(_terms(queries, "query_id", "query").distinct(), "query-terms")
    postings = _postings(corpus, qt.select("term").distinct(), k1, b)
    bound = stored(_first_bound(qt, postings, limit), "bounds")
    maxima = postings.groupBy("term", "block").agg(F.max("s").alias("most"))
    lowest = (Window.partitionBy("query_id", "block").orderBy("most", "term")  # the terms of one query
              .rowsBetween(Window.unboundedPreceding, 0))
    blocks = (qt.join(maxima, "term").join(bound, "query_id")
              .withColumn("reach", F.sum("most").over(lowest))
              .withColumn("total", F.sum("most").over(Window.partitionBy("query_id", "block")))
              .filter(F.col("total") >= F.col("bound") - SLACK)
              .withColumn("leads", F.col("reach") >= F.col("bound") - SLACK))
    blocks = stored(blocks.select("query_id", "term", "block", "most", "leads", "bound"), "query-blocks")
    rest = (blocks.filter(~F.col("leads")).groupBy("query_id", "block").agg(F.sum("most").alias("rest")))
    started = (blocks.filter("leads").join(postings.select("term", "block", "doc_id", "s"), ["term", "block"])
               .groupBy("query_id", "doc_id", "block").agg(F.sum("s").alias("s"), F.first("bound").alias("bound")))
    alive = (started.join(rest, ["query_id", "block"], "left")
             .filter(F.col("s") + F.coalesce("rest", F.lit(0.0)) >= F.col("bound") - SLACK)
             .select("query_id", "doc_id", "block", "s"))
    alive = stored(alive, "candidates")
    more = (alive.select("query_id", "doc_id", "block")
            .join(blocks.filter(~F.col("leads")).select("query_id", "block", "term"), ["query_id", "block"])
            .join(postings.select("term", "doc_id", "s"), ["term", "doc_id"])
            .select("query_id", "doc_id", "s"))
    scores = (alive.select("query_id", "doc_id", "s").unionByName(more)
              .groupBy("query_id", "doc_id").agg(F.round(F.sum("s"), 6).alias("score")))
    return scores, postings


def corpus_search(queries: DataFrame, corpus: DataFrame, limit: int = 10,
                  k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Q12: the ``limit`` best documents of each query by BM25, exactly, over
    the whole corpus. ``queries``: query_id, query; ``corpus``: doc_id, text.
    Postings lie in blocks with the largest score of each term; a first bound
    on each query's last result comes from its rare terms, and postings of
    common terms are added only where it can still be reached. Lists of
    frequent terms are split by block."""
    SearchOptions(limit=limit)
    scores, _ = search_candidates(queries, corpus, limit, k1, b)
    return _top(scores, limit)
