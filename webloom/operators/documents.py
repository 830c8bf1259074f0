"""Document and agent projections (P1-P9): typed and all-string documents,
text renderings of search results, pages, crawls, maps and batches, and
context-size caps.

Renderings that fold many rows into one text fold one query's results (at most
50), one crawl's pages (its page limit), the first 100 URLs of a map (and a
count), or one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.functions.text import iso_ts

# Rendering templates and caps of the projections.
SEARCH_STYLES = {
    # style: (content cap, item separator, empty-result template)
    "bracket": (1500, "\n\n---\n\n", "No results found for: {q}"),
    "bold": (1200, "\n---\n", 'No results found for: "{q}"'),
    "dash": (1500, "\n\n---\n\n", 'No results for: "{q}"'),
    "bold_py": (1500, "\n\n---\n\n", 'No results found for: "{q}"'),
    "plain_py": (1200, "\n\n---\n\n", 'No web results found for: "{q}"'),
}
CRAWL_DIGEST_CHARS = 1000
BATCH_DIGEST_CHARS = 800
MAP_DIGEST_URLS = 100
SEARCH_TRUNCATED = "\n\n[truncated — scrape the URL for full content]"


def to_documents(pages: DataFrame) -> DataFrame:
    """page_content plus typed metadata; missing values become ''."""
    return pages.select(
        F.col("content").alias("page_content"), F.col("url").alias("source"), "url",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.col("word_count").cast("long").alias("word_count"),
        iso_ts("crawled_at").alias("crawled_at"),
        F.coalesce("og_image", F.lit("")).alias("og_image"))


def to_string_documents(pages: DataFrame) -> DataFrame:
    """id = url, text, metadata as map<string,string> (no og image)."""
    meta = F.create_map(
        F.lit("url"), F.col("url"),
        F.lit("title"), F.coalesce("title", F.lit("")),
        F.lit("description"), F.coalesce("description", F.lit("")),
        F.lit("wordCount"), F.col("word_count").cast("string"),
        F.lit("crawledAt"), iso_ts("crawled_at"),
        F.lit("source"), F.col("url"))
    return pages.select(F.col("url").alias("id"), F.col("content").alias("text"),
                        meta.alias("metadata"))


def load(mode: str, documents: str = "typed", **frames) -> DataFrame:
    """Documents from a scrape / crawl / search result, ``typed`` (P1) or
    all-``string`` (P2). ``search`` keeps only results that carry a page; any
    other mode or kind is refused. ``iterate`` reads them one by one."""
    if documents not in ("typed", "string"):
        raise ValueError(f"unknown documents {documents!r}; expected typed or string")
    if mode == "scrape":
        pages = frames["pages"]
    elif mode == "crawl":
        pages = frames["result"].pages
    elif mode == "search":
        pages = frames["enriched"].filter(F.col("content").isNotNull()).select(
            "url", "content", *[F.col(f"page_{c}").alias(c) for c in
                                ("title", "description", "word_count", "crawled_at", "og_image")])
    else:
        raise ValueError(f"unknown mode {mode!r}; expected scrape, crawl or search")
    return to_documents(pages) if documents == "typed" else to_string_documents(pages)


def iterate(documents: DataFrame):
    """The documents as dictionaries, a partition at a time: an iterator
    for consumers on the driver that does not hold them all."""
    for row in documents.toLocalIterator(prefetchPartitions=True):
        yield row.asDict(recursive=True)


def _item(style: str, cap: int) -> F.Column:
    i = F.col("position").cast("string")
    content = F.col("content")
    has = content.isNotNull() & (content != "")
    c = F.substring(content, 1, cap)
    if style == "bracket":
        parts = [F.concat(F.lit("["), i, F.lit("] "), "title"),
                 F.concat(F.lit("URL: "), "url"),
                 F.concat(F.lit("Summary: "), "description"),
                 F.when(has, F.concat(F.lit("Content:\n"), c))]
    elif style == "bold":
        parts = [F.concat(i, F.lit(". **"), "title", F.lit("**")),
                 F.concat(F.lit("   URL: "), "url"),
                 F.concat(F.lit("   "), "description"),
                 F.when(has, F.concat(F.lit("\n"), c, F.lit("\n")))]
    elif style == "dash":
        parts = [F.concat(i, F.lit(". **"), "title", F.lit("** — "), "url"),
                 F.when(F.col("description") != "", F.col("description")),
                 F.when(has, F.concat(F.lit("\n"), c))]
    elif style == "bold_py":
        parts = [F.concat(i, F.lit(". **"), "title", F.lit("**\n   URL: "), "url",
                          F.lit("\n   "), "description"),
                 F.when(has, F.concat(F.lit("\n"), c))]
    elif style == "plain_py":
        parts = [F.concat(i, F.lit(". "), "title"), F.concat(F.lit("   "), "url"),
                 F.concat(F.lit("   "), "description"),
                 F.when(has, F.concat(F.lit("\n"), c))]
    else:
        raise ValueError(f"unknown style {style!r}")
    # Empty parts are dropped (filter(Boolean)); concat_ws skips NULLs.
    return F.concat_ws("\n", *[F.when(p != "", p) for p in parts])


def render_search(results: DataFrame, queries: DataFrame, style: str = "bracket",
                  limit: int = 5) -> DataFrame:
    """One text per query from its first ``limit`` results."""
    cap, sep, empty = SEARCH_STYLES[style]
    r = results
    if "content" not in r.columns:
        r = r.withColumn("content", F.lit(None).cast("string"))
    r = r.filter(F.col("position") <= limit)
    items = r.groupBy("query_id").agg(F.array_sort(F.collect_list(
        F.struct("position", _item(style, cap).alias("text")))).alias("items"))
    text = F.array_join(F.transform("items", lambda x: x["text"]), sep)
    pre, post = empty.split("{q}")
    return (queries.select("query_id", "query").join(items, "query_id", "left")
            .select("query_id", F.when(F.col("items").isNull(),
                                       F.concat(F.lit(pre), "query", F.lit(post)))
                    .otherwise(text).alias("text")))


def render_page(pages: DataFrame) -> DataFrame:
    """P5: ``# title-or-url`` then the content."""
    return pages.select("url", F.concat(F.lit("# "), F.coalesce("title", "url"), F.lit("\n\n"),
                                        "content").alias("text"))


def crawl_digest(result, max_pages: int) -> DataFrame:
    """Per crawl, ``Crawled x of y discovered pages.`` then each page as
    ``## title`` / ``**URL:** url`` / first 1000 characters, in crawl order."""
    p = result.pages.select("crawl_id", "depth", "key", F.concat(
        F.lit("## "), F.coalesce("title", "url"), F.lit("\n**URL:** "), "url", F.lit("\n\n"),
        F.substring("content", 1, CRAWL_DIGEST_CHARS)).alias("text"))
    items = p.groupBy("crawl_id").agg(
        F.array_sort(F.collect_list(F.struct("depth", "key", "text"))).alias("items"))
    s = result.summary.join(items, "crawl_id", "left")
    head = F.concat(F.lit("Crawled "), F.col("pages_crawled").cast("string"), F.lit(" of "),
                    F.col("pages_discovered").cast("string"), F.lit(" discovered pages.\n\n"))
    body = F.coalesce(F.array_join(F.transform("items", lambda x: x["text"]), "\n\n---\n\n"),
                      F.lit(""))
    return s.select("crawl_id", F.concat(head, body).alias("text"))


def map_digest(mapped: DataFrame, seeds: DataFrame) -> DataFrame:
    """``Found N URLs on u:`` then the first 100 URLs in discovery order
    and ``…and k more``. Only 100 URLs per site are ever collected."""
    w = Window.partitionBy("site").orderBy("ord", "url")
    first = (mapped.withColumn("_r", F.row_number().over(w))
             .filter(F.col("_r") <= MAP_DIGEST_URLS)
             .groupBy("site").agg(F.array_sort(F.collect_list(F.struct("_r", "url"))).alias("u")))
    total = mapped.groupBy("site").agg(F.count(F.lit(1)).alias("total"))
    s = (seeds.select(F.col("crawl_id").alias("site"), "url").join(total, "site", "left")
         .join(first, "site", "left").fillna(0, ["total"]))
    listing = F.coalesce(F.array_join(F.transform("u", lambda x: x["url"]), "\n"), F.lit(""))
    more = F.when(F.col("total") > MAP_DIGEST_URLS, F.concat(
        F.lit("\n…and "), (F.col("total") - MAP_DIGEST_URLS).cast("string"), F.lit(" more")))
    return s.select("site", F.concat(
        F.lit("Found "), F.col("total").cast("string"), F.lit(" URLs on "), "url",
        F.lit(":\n\n"), listing, F.coalesce(more, F.lit(""))).alias("text"))


def batch_digest(results: DataFrame, failed: DataFrame, summary: DataFrame) -> DataFrame:
    """``Scraped s/t URLs successfully.`` then ``## title`` and 800
    characters per page, then the failed URLs. ``results`` / ``failed`` carry
    ``seq`` (request order)."""
    p = results.select("job_id", "seq", F.concat(
        F.lit("## "), F.coalesce("title", "url"), F.lit("\n"),
        F.substring("content", 1, BATCH_DIGEST_CHARS)).alias("text"))
    items = p.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("it"))
    errs = (failed.select("job_id", "seq", F.concat("url", F.lit(" — "), "error").alias("e"))
            .groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("seq", "e"))).alias("er")))
    s = summary.join(items, "job_id", "left").join(errs, "job_id", "left")
    head = F.concat(F.lit("Scraped "), F.col("succeeded").cast("string"), F.lit("/"),
                    F.col("total").cast("string"), F.lit(" URLs successfully.\n\n"))
    body = F.coalesce(F.array_join(F.transform("it", lambda x: x["text"]), "\n\n---\n\n"), F.lit(""))
    tail = F.when(F.size(F.coalesce("er", F.array())) > 0, F.concat(
        F.lit("\n\nFailed: "), F.array_join(F.transform("er", lambda x: x["e"]), ", ")))
    return s.select("job_id", F.concat(head, body, F.coalesce(tail, F.lit(""))).alias("text"))


def context_caps(pages: DataFrame, kind: str) -> DataFrame:
    """Size caps applied before results go to an agent's context.
    scrape: first 50 links; search: content 2000 chars; crawl: content 3000
    chars + ``[truncated]``; batch: content 2000 chars."""
    if kind == "scrape":
        return pages.withColumn("links", F.slice("links", 1, 50))
    if kind == "batch":
        return pages.withColumn("content", F.substring("content", 1, 2000))
    if kind == "search":
        c = F.col("content")
        return pages.withColumn("content", F.when(
            F.length(c) > 2000, F.concat(F.substring(c, 1, 2000), F.lit(SEARCH_TRUNCATED)))
            .otherwise(c))
    if kind == "crawl":
        c = F.col("content")
        return pages.withColumn("content", F.when(
            F.length(c) > 3000, F.concat(F.substring(c, 1, 3000), F.lit("\n\n[truncated]")))
            .otherwise(c))
    raise ValueError(f"unknown kind {kind!r}")


# The agent-context caps.
MAP_CONTEXT_URLS = 500
CRAWL_CONTEXT_SKIPS = 20
CRAWL_CONTEXT_MAX_PAGES = 50
CRAWL_CONTEXT_DEFAULT_PAGES = 20
BATCH_CONTEXT_URLS = 20


def map_context(mapped: DataFrame) -> DataFrame:
    """P9 (map): per site the first 500 URLs in discovery order, the total
    and a ``truncated`` flag. Only 500 URLs per site are ever collected."""
    w = Window.partitionBy("site").orderBy("ord", "url")
    first = (mapped.withColumn("_r", F.row_number().over(w))
             .filter(F.col("_r") <= MAP_CONTEXT_URLS)
             .groupBy("site").agg(F.array_sort(F.collect_list(F.struct("_r", "url"))).alias("u")))
    total = mapped.groupBy("site").agg(F.count(F.lit(1)).alias("total"))
    return total.join(first, "site").select(
        "site", F.transform("u", lambda x: x["url"]).alias("urls"), "total",
        (F.col("total") > MAP_CONTEXT_URLS).alias("truncated"))


def crawl_skips_context(skips: DataFrame) -> DataFrame:
    """P9 (crawl): the first 20 skips of each crawl, in crawl order."""
    w = Window.partitionBy("crawl_id").orderBy("depth", "url")
    return skips.withColumn("_r", F.row_number().over(w)).filter(
        F.col("_r") <= CRAWL_CONTEXT_SKIPS).drop("_r")


def crawl_context_max_pages(max_pages: int | None) -> int:
    """P9 (crawl): requested page cap, default 20, never above 50."""
    return min(CRAWL_CONTEXT_DEFAULT_PAGES if max_pages is None else max_pages,
               CRAWL_CONTEXT_MAX_PAGES)


def batch_context_requests(requests: DataFrame) -> DataFrame:
    """P9 (batch): only the first 20 URLs of each batch request (by ``seq``)
    are scraped."""
    w = Window.partitionBy("job_id").orderBy("seq")
    return requests.withColumn("_r", F.row_number().over(w)).filter(
        F.col("_r") <= BATCH_CONTEXT_URLS).drop("_r")
