"""Derived inputs (FIXTURES.md §2), computed by Spark from the driver tables.

The driver's tables hold raw pages only; the captured robots files, sitemaps,
search-result pages, link graph and second snapshot a real deployment would
read from storage are derived here by deterministic rules so that every
operator can run over the whole ``pages`` / ``documents`` / ``benchmark``
tables. The same rules are written in SQL for the DuckDB oracle
(``webloom.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from webloom.functions.urls import url_host
from webloom.operators.scan import SEGMENT, SEGMENT_ROWS, earlier, segments, within
from webloom.sources.captures import read_table

EPOCH_2024_MS = 1704067200000  # 2024-01-01T00:00:00Z


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-CAP: pages as captures; 404 when page_id % 17 = 0; fetched 700 ms apart."""
    p = pages(spark, sf_dir)
    return p.select(
        "page_id", "url", "html",
        F.when(F.col("page_id") % 17 == 0, 404).otherwise(200).cast("int").alias("status_code"),
        F.timestamp_millis(F.lit(EPOCH_2024_MS) + F.col("page_id") * 700).alias("fetched_at"),
        F.lit(None).cast("string").alias("error"))


def page_count(spark: SparkSession, sf_dir: str) -> int:
    """Scalar used by the link-graph rule (a single aggregate row)."""
    return int(pages(spark, sf_dir).agg(F.count(F.lit(1))).first()[0])


SITEMAP_PART = 50_000   # URLs per sitemap file (the protocol's limit)


LINK_FANOUT = 10        # pages of its host that a page links to


def host_ranks(p: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Adds ``rank``, from 0, of each page (page_id, host, ...) within its host
    by page_id: row numbers within ordered segments plus the rows of the host in
    earlier segments, so a host owning a third of all pages is never ordered in
    one task."""
    placed = segments(p, ["host"], ["page_id"], segment_rows, "host-ranks")
    sizes = placed.groupBy("host", SEGMENT).agg(F.count("*").alias("_n"))
    sizes = sizes.select("host", SEGMENT, F.coalesce(F.sum("_n").over(earlier(["host"])), F.lit(0)).alias("_before"))
    return (placed.join(sizes, ["host", SEGMENT])
            .withColumn("rank", F.col("_before") + F.row_number().over(within(["host"], ["page_id"])) - 1)
            .drop("_before", SEGMENT))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-EDGE: the pages of a host are a tree in page_id order: the page of rank
    r links to the ranks 10r + 1 to 10r + 10, so depth 3 reaches 1,111 pages of a
    host and what a crawl reaches grows with the pages; plus one cross-host link
    to page (page_id*7+3) % n."""
    p = pages(spark, sf_dir).select("page_id", "url", url_host("url").alias("host"))
    ranked = host_ranks(p)
    below = ranked.filter("rank > 0").select(
        "host", F.expr(f"(rank - 1) div {LINK_FANOUT}").alias("rank"),
        F.expr(f"(rank - 1) % {LINK_FANOUT}").cast("int").alias("pos"), F.col("url").alias("dst"))
    same = (below.join(ranked.select("host", "rank", F.col("url").alias("src")), ["host", "rank"])
            .select("src", "pos", "dst"))
    n = page_count(spark, sf_dir)
    tgt = p.select(F.col("page_id").alias("dst_id"), F.col("url").alias("dst"))
    cross = (p.select(F.col("url").alias("src"),
                      ((F.col("page_id") * 7 + 3) % n).alias("dst_id"))
             .join(tgt, "dst_id")
             .select("src", F.lit(LINK_FANOUT).cast("int").alias("pos"), "dst"))
    return same.unionByName(cross)


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-SEED: one crawl per host, seeded at its lowest page_id."""
    p = pages(spark, sf_dir).select("page_id", "url", url_host("url").alias("host"))
    return p.groupBy("host").agg(F.min_by("url", "page_id").alias("url")).select(
        F.col("host").alias("crawl_id"), "url")


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select(url_host("url").alias("host")).distinct()


# The four robots.txt bodies of F-ROB, chosen by length(host) % 4.
ROBOTS_BODIES = (
    None,
    "User-agent: *\nDisallow: /fr",
    "User-agent: *\nDisallow: /\nAllow: /en",
    "User-agent: *\nCrawl-delay: 2\nDisallow: /*.html$",
)


def robots_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-ROB: one robots capture per host, body chosen by length(host) % 4
    (class 0 is a 404). Hosts with length(host) % 3 = 0 are captured again
    a minute later with the next class's body (a second round)."""
    h = hosts(spark, sf_dir)

    def round_(k, offset_ms):
        body = (F.when(k == 1, F.lit(ROBOTS_BODIES[1])).when(k == 2, F.lit(ROBOTS_BODIES[2]))
                .when(k == 3, F.lit(ROBOTS_BODIES[3])).otherwise(F.lit("")))
        return F.struct(
            body.alias("body"), F.when(k == 0, 404).otherwise(200).cast("int").alias("status_code"),
            F.timestamp_millis(F.lit(EPOCH_2024_MS + offset_ms) + (F.length("host") % 5) * 40000)
            .alias("fetched_at"))

    first = h.select("host", round_(F.length("host") % 4, 0).alias("c"))
    second = (h.filter(F.length("host") % 3 == 0)
              .select("host", round_((F.length("host") + 1) % 4, 60000).alias("c")))
    return first.unionByName(second).select("host", "c.body", "c.status_code", "c.fetched_at")


def sitemap_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-MAP: hosts with an even-length name have a sitemap listing their
    pages (odd page_ids padded with spaces) plus one external URL. A host's
    list is split into parts of at most 50,000 URLs (page_id ranges), one
    capture row per part, so no group grows with the data."""
    p = pages(spark, sf_dir).select("page_id", "url", url_host("url").alias("host"))
    loc = F.concat(F.lit("<url><loc>"),
                   F.when(F.col("page_id") % 2 == 1, F.concat(F.lit(" "), "url", F.lit(" ")))
                   .otherwise(F.col("url")),
                   F.lit("</loc></url>"))
    per_part = (p.filter(F.length("host") % 2 == 0)
                .withColumn("part", F.floor(F.col("page_id") / SITEMAP_PART).cast("int"))
                .groupBy("host", "part")
                .agg(F.array_sort(F.collect_list(F.struct("page_id", loc.alias("line"))))
                     .alias("lines")))
    external = F.when(F.col("part") == 0, F.lit(
        "\n<url><loc>https://external.example.net/about</loc></url>")).otherwise(F.lit(""))
    body = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<urlset>\n'),
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n"),
        external, F.lit("\n</urlset>"))
    with_map = per_part.select("host", "part", body.alias("body"), F.lit(200).alias("status_code"))
    without = (hosts(spark, sf_dir).filter(F.length("host") % 2 == 1)
               .select("host", F.lit(0).alias("part"), F.lit("").alias("body"),
                       F.lit(404).alias("status_code")))
    return with_map.unionByName(without).select(
        "host", F.col("part").cast("int"), "body", F.col("status_code").cast("int"))


def meta_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-META: pages with metadata tags inserted by page_id % 5."""
    p = pages(spark, sf_dir)
    k = F.col("page_id") % 5
    pid = F.col("page_id").cast("string")
    dd = F.lpad(((F.col("page_id") % 28) + 1).cast("string"), 2, "0")
    metas = (
        F.when(k == 1, F.concat(
            F.lit('<meta name="description" content="Tips &amp; notes for page '), pid,
            F.lit('"><meta property="og:image" content="https://img.example.com/'), pid,
            F.lit('.png"><meta name="author" content="Author '), (F.col("page_id") % 7).cast("string"),
            F.lit('"><meta property="article:published_time" content="2024-01-'), dd,
            F.lit('T10:00:00Z">')))
        .when(k == 2, F.concat(
            F.lit('<meta property="og:description" content="Open graph summary '), pid,
            F.lit('"><meta property="og:image" content="https://img.example.com/'), pid,
            F.lit('.png">')))
        .when(k == 3, F.concat(
            F.lit('<meta name="description" content=""><meta property="og:description" '
                  'content="Not used '), pid, F.lit('">')))
        .when(k == 4, F.concat(
            F.lit('<meta name="author" content="Author '), (F.col("page_id") % 7).cast("string"),
            F.lit('">')))
        .otherwise(F.lit("")))
    times = (F.when(k == 3, F.concat(F.lit('<time datetime="2023-12-'), dd, F.lit('">Dec</time>')))
             .when(k == 4, F.concat(F.lit('<time>undated</time><time datetime="2023-11-'), dd,
                                    F.lit('">Nov</time>')))
             .otherwise(F.lit("")))
    html = F.replace(F.replace("html", F.lit('<meta charset="utf-8">'),
                               F.concat(F.lit('<meta charset="utf-8">'), metas)),
                     F.lit("<article>"), F.concat(F.lit("<article>"), times))
    return p.select("page_id", "url", html.alias("html"))


def snapshot2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-SNAP2: a second capture a day later: page_id % 5 = 0 gets a line
    added, % 7 = 0 its heading replaced, % 11 = 0 is absent."""
    c = captures(spark, sf_dir).filter(F.col("page_id") % 11 != 0)
    pid = F.col("page_id").cast("string")
    h = F.when(F.col("page_id") % 7 == 0,
               F.regexp_replace("html", "<h1>[^<]*</h1>",
                                F.concat(F.lit("<h1>Replaced heading "), pid, F.lit("</h1>"))))\
        .otherwise(F.col("html"))
    h = F.when(F.col("page_id") % 5 == 0,
               F.replace(h, F.lit("</article>"),
                         F.concat(F.lit("<p>\nUpdated line "), pid, F.lit("</p></article>"))))\
        .otherwise(h)
    return c.select("page_id", "url", h.alias("html"), "status_code",
                    (F.col("fetched_at") + F.expr("INTERVAL 1 DAY")).alias("fetched_at"),
                    "error")


# F-SERP result classes, cycled by (query_id + j) % 7.
SERP_CLASSES = ("ad", "untitled", "relative", "iso", "plain", "direct", "self")
SERP_UNITS = ("day", "week", "month", "year")
REDIRECT_PREFIX = "//duckduckgo.com/l/?uddg="


def serp_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-SERP: one captured result page per ``benchmark`` item, pointing at
    ``pages`` URLs. Items with query_id % 9 = 4 only have fallback anchors;
    query_id % 13 = 7 is a failed (503) capture."""
    b = read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    n = page_count(spark, sf_dir)
    urls = pages(spark, sf_dir).select(F.col("page_id").alias("target"), "url")
    slots = (b.select("query_id", F.explode(F.sequence(F.lit(0), 2 + F.col("query_id") % 10))
                      .alias("j"))
             .withColumn("target", (F.col("query_id") * 13 + F.col("j") * 7) % n)
             .join(urls, "target"))
    j = F.col("j").cast("string")
    cls = (F.col("query_id") + F.col("j")) % 7
    redirect = F.concat(F.lit(REDIRECT_PREFIX), F.url_encode("url"), F.lit("&amp;rut=r"), j)
    nn = (F.col("j") + 1)
    unit = F.element_at(F.array(*[F.lit(u) for u in SERP_UNITS]),
                        ((F.col("query_id") + F.col("j")) % 4 + 1).cast("int"))
    rel = F.concat(nn.cast("string"), F.lit(" "), unit,
                   F.when(nn > 1, F.lit("s")).otherwise(F.lit("")), F.lit(" ago"))
    iso = F.concat(F.lit("2023-"), F.lpad(((F.col("j") % 12) + 1).cast("string"), 2, "0"),
                   F.lit("-"), F.lpad(((F.col("query_id") % 28) + 1).cast("string"), 2, "0"))
    snippet = (F.when(cls == 2, F.concat(rel, F.lit(" &middot; snippet ")))
               .when(cls == 3, F.concat(F.lit("Published "), iso, F.lit(" snippet ")))
               .otherwise(F.lit("Snippet ")))
    snippet = F.concat(snippet, j, F.lit(" for "), F.col("url"))
    href = (F.when(cls == 5, F.col("url"))
            .when(cls == 6, F.concat(F.lit("https://duckduckgo.com/y.js?ad="), j))
            .otherwise(redirect))
    block = (
        F.when(cls == 0, F.concat(
            F.lit('<div class="result results_links result--ad"><h2 class="result__title">'
                  '<a class="result__a" href="'), redirect, F.lit('">Sponsored '), j,
            F.lit('</a></h2><a class="result__snippet">Buy now</a></div>')))
        .when(cls == 1, F.concat(
            F.lit('<div class="result results_links"><a class="result__snippet">Untitled '), j,
            F.lit("</a></div>")))
        .otherwise(F.concat(
            F.lit('<div class="result results_links results_links_deep web-result">'
                  '<div class="result__body"><h2 class="result__title"><a rel="nofollow" '
                  'class="result__a" href="'), href, F.lit('">Result '), j,
            F.lit(" &amp; more</a></h2>\n<a class=\"result__snippet\" href=\""), href,
            F.lit('">'), snippet, F.lit('</a>\n<a class="result__url" href="'), href,
            F.lit('">'), F.col("url"), F.lit("</a></div></div>"))))
    fallback = F.concat(
        F.lit('<a class="result__a" href="'), redirect, F.lit('">Fallback '), j,
        F.lit('</a> <a class="result__url" href="'), redirect, F.lit('"></a>'))
    piece = F.when(F.col("query_id") % 9 == 4, fallback).otherwise(block)
    per_q = (slots.groupBy("query_id")
             .agg(F.array_sort(F.collect_list(F.struct("j", piece.alias("piece")))).alias("ps")))
    body = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>results</title></head><body><div id="links">'),
        F.array_join(F.transform("ps", lambda x: x["piece"]), "\n"),
        F.lit("</div></body></html>"))
    out = per_q.join(b, "query_id").select(
        "query_id", "query", body.alias("html"),
        (F.timestamp_millis(F.lit(EPOCH_2024_MS + 30 * 86400000 + 12 * 3600000))
         + F.make_dt_interval(F.col("query_id") % 60)).alias("fetched_at"),
        F.when(F.col("query_id") % 13 == 7, 503).otherwise(200).cast("int").alias("status_code"))
    return out


def tos_lexicon(spark: SparkSession) -> DataFrame:
    """F-LEX: the terms-of-service lexicon (clause, Java/RE2-compatible
    pattern, severity)."""
    rows = [
        ("arbitration", "(?i)binding arbitration", "block"),
        ("copyleft_license", "(?i)GNU General Public License", "block"),
        ("permissive_license", "(?i)Apache License", "warn"),
        ("tracking_token", "(?i)\\btoken\\b", "warn"),
        ("no_scraping", "(?i)(no|prohibits?) (scraping|crawling)", "block"),
        ("liability", "(?i)limitation of liability", "warn"),
    ]
    return spark.createDataFrame(rows, "clause string, pattern string, severity string")
