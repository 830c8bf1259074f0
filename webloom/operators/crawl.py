"""Crawl (C1-C12) and map / discovery (M1-M5) over captured link graphs.

Many crawls run at once, keyed by ``crawl_id``. One BFS level is one Spark
job: classify the frontier (cheap predicates first, then the robots join,
then the captures join), expand successful pages through the link table,
keep for each newly found URL the smallest order key, and drop URLs already
visited (anti-join). Links, captures and visited URLs lie in the shared
checkpoint folder by their join keys, so only the rows of the level move; each
level is checkpointed there too, so lineage stays flat and a lost executor only
costs one level.

Order is deterministic: a node's key is the path of link positions from its
crawl's seed (``array<int>``), so within a level, lexicographic key order is
"parent order, then link position" -- the FIFO order of the queue -- and no
global ``row_number`` over a whole crawl is ever needed. The ``max_pages``
cap is the k-th page on (depth, key), found from counts per level and sampled
key ranges, so a crawl holding a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from webloom.functions.text import js_trim
from webloom.functions.urls import url_host, valid_url
from webloom.operators.parse import extract_parts
from webloom.operators.pacing import fetch_schedule
from webloom.operators.robots import crawl_delays, parse_robots, robots_check, rules_by_host
from webloom.operators.scan import SEGMENT_ROWS, nth
from webloom.operators.scrape import NOT_CAPTURED, scrape
from webloom.options import CrawlOptions, MapOptions
from webloom.session import ensure_checkpoint_dir, placed_tables, stored
from webloom.sources.captures import latest_captures, ok_only

# Skip reasons and details, in the order the checks run.
REASON_EXCLUDED, REASON_ROBOTS, REASON_ERROR = "excluded", "robots", "error"
DETAIL_DOMAIN = "different domain"
DETAIL_EXCLUDE = "matched exclude pattern"
DETAIL_INCLUDE = "did not match include pattern"
DETAIL_NOT_CAPTURED = NOT_CAPTURED
_KEY_T = T.ArrayType(T.IntegerType())


@dataclass
class CrawlResult:
    nodes: DataFrame     # every processed URL: crawl_id, url, depth, key, reason, detail
    pages: DataFrame     # scraped pages of the crawl (lazy)
    skips: DataFrame     # crawl_id, url, reason, detail, depth
    summary: DataFrame   # one row per valid seed
    rejects: DataFrame   # invalid seeds: crawl_id, url, code


def _checkpoint(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _seed_frontier(seeds: DataFrame):
    s = seeds.select("crawl_id", "url")
    ok = valid_url("url")
    frontier = s.filter(ok).select(
        "crawl_id", "url", F.lit(0).alias("depth"), F.array().cast(_KEY_T).alias("key"),
        url_host("url").alias("seed_host"))
    rejects = s.filter(~ok).select("crawl_id", "url", F.lit("INVALID_URL").alias("code"))
    return frontier, rejects


def classify(frontier: DataFrame, captures: DataFrame, opts: CrawlOptions,
             rules: DataFrame | None) -> DataFrame:
    """The ordered skip chain. Returns the frontier with ``reason``,
    ``detail`` (NULL for a page) and the capture's ``status_code``."""
    url = F.col("url")
    pre = F.lit(None).cast("string")
    pre_detail = F.lit(None).cast("string")
    conds = []
    if opts.same_domain:
        conds.append((url_host("url") != F.col("seed_host"), DETAIL_DOMAIN))
    if opts.exclude:
        conds.append((reduce(lambda a, b: a | b, [url.rlike(p) for p in opts.exclude]),
                      DETAIL_EXCLUDE))
    if opts.include:
        conds.append((~reduce(lambda a, b: a | b, [url.rlike(p) for p in opts.include]),
                      DETAIL_INCLUDE))
    for cond, detail in reversed(conds):
        pre = F.when(cond, F.lit(REASON_EXCLUDED)).otherwise(pre)
        pre_detail = F.when(cond, F.lit(detail)).otherwise(pre_detail)
    cols = ["crawl_id", "url", "depth", "key", "seed_host"]
    c = frontier.select(*cols, pre.alias("_pre"), pre_detail.alias("_pre_detail"))
    if opts.respect_robots and rules is not None:
        c = robots_check(c, rules, opts.user_agent)
    else:
        c = c.withColumn("allowed", F.lit(True)).withColumn(
            "robots_reason", F.lit(None).cast("string"))
    cap = captures.select("url", "status_code", "error", F.lit(True).alias("_captured"))
    j = c.join(cap, "url", "left")
    pre_ok = F.col("_pre").isNull()
    reason = (F.when(~pre_ok, F.col("_pre"))
              .when(~F.col("allowed"), F.lit(REASON_ROBOTS))
              .when(F.col("_captured").isNull() | F.col("error").isNotNull(), F.lit(REASON_ERROR)))
    detail = (F.when(~pre_ok, F.col("_pre_detail"))
              .when(~F.col("allowed"), F.col("robots_reason"))
              .when(F.col("_captured").isNull(), F.lit(DETAIL_NOT_CAPTURED))
              .when(F.col("error").isNotNull(), F.col("error")))
    status = F.when(pre_ok & F.col("allowed"), F.col("status_code"))
    return j.select(*cols, reason.alias("reason"), detail.alias("detail"),
                    status.cast("int").alias("status_code"))


def capture_index(captures: DataFrame) -> DataFrame:
    """The narrow capture columns a crawl joins on every level: those of the
    latest capture of each URL."""
    newest = F.max_by(F.struct("status_code", "error"), F.struct("fetched_at", "status_code", "error"))
    return captures.groupBy("url").agg(newest.alias("_c")).select("url", "_c.*")


def _expand(ok_nodes: DataFrame, links: list[DataFrame], visited: list[DataFrame], depth: int,
            host_filter: bool) -> DataFrame:
    """The URLs that ``ok_nodes`` link to and no level has visited. ``links``
    lie by url, ``visited`` by (crawl_id, url), as ``placed_tables`` writes them:
    only the level's own rows are exchanged, once by url and once by (crawl, url)."""
    start = ok_nodes.select("crawl_id", "url", "key", "seed_host")
    kids = reduce(DataFrame.unionByName, [start.join(e, "url") for e in links])
    if host_filter:
        kids = kids.filter(url_host("dst") == F.col("seed_host"))
    kids = (kids.groupBy("crawl_id", F.col("dst").alias("url"))
            .agg(F.min(F.concat("key", F.array(F.col("pos").cast("int")))).alias("key"),
                 F.first("seed_host").alias("seed_host")))
    for v in visited:
        kids = kids.join(v, ["crawl_id", "url"], "left_anti")
    return kids.select("crawl_id", "url", F.lit(depth).alias("depth"), "key", "seed_host")


def links_of(captures: DataFrame) -> DataFrame:
    """Link table (src, pos, dst) extracted from the latest capture of each page."""
    p = extract_parts(latest_captures(captures).select("url", "html"), ["links"])
    return p.select(F.col("url").alias("src"),
                    F.posexplode("links").alias("pos", "dst")).select(
        "src", F.col("pos").cast("int"), "dst")


def _cap_cut(nodes: DataFrame, k: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Per crawl, (depth, key) of the k-th successful page in crawl order;
    crawls with fewer than k pages get no row. Counts per (crawl, depth) tell
    the depth of the cut and its place there; among the pages of that depth the
    place is found by sampled key ranges, so no crawl is ever ordered whole."""
    ok = nodes.filter(F.col("reason").isNull()).select("crawl_id", "depth", "key")
    levels = ok.groupBy("crawl_id", "depth").agg(F.count("*").alias("_n"))
    by_depth = (Window.partitionBy("crawl_id").orderBy("depth")  # one row a level, at most the depth limit
                .rowsBetween(Window.unboundedPreceding, -1))
    cut = (levels.withColumn("_above", F.coalesce(F.sum("_n").over(by_depth), F.lit(0)))
           .filter((F.col("_above") < k) & (F.col("_above") + F.col("_n") >= k))
           .select("crawl_id", "depth", (F.lit(k) - F.col("_above")).alias("_want")))
    cut = stored(cut, "cap-depths")
    if cut.isEmpty():
        return cut.select("crawl_id", F.col("depth").alias("cut_depth"), F.lit(None).cast(_KEY_T).alias("cut_key"))
    at = nth(ok.join(cut, ["crawl_id", "depth"]), ["crawl_id"], ["key"], "_want", segment_rows, "cap")
    return at.select("crawl_id", F.col("depth").alias("cut_depth"), F.col("key").alias("cut_key"))


def _link_rows(edges: DataFrame, canonicalize: bool = False) -> DataFrame:
    e = edges.select(F.col("src").alias("url"), F.col("pos").cast("int").alias("pos"), "dst")
    if canonicalize:
        from webloom.functions.urls import canonical_url
        e = e.withColumn("dst", canonical_url("dst"))
    return e


class _Links:
    """The link tables a level is joined with: the given edges, or else the
    links of the pages reached so far, each parsed at the first level that
    reaches it."""

    def __init__(self, place, captures: DataFrame, edges: DataFrame | None, canonicalize: bool):
        self._place, self._captures, self._canonicalize = place, captures, canonicalize
        self._parsed: list[DataFrame] = []
        self._fixed = edges is not None
        self.tables = [place(_link_rows(edges, canonicalize), "links", "url")] if self._fixed else []

    def of(self, reached: DataFrame) -> list[DataFrame]:
        """The tables that hold the links of the pages ``reached`` (column url)."""
        if not self._fixed:
            fresh = reached.select("url").distinct()
            for old in self._parsed:
                fresh = fresh.join(old, "url", "left_anti")
            fresh = self._place(fresh, "parsed", "url")
            self._parsed.append(fresh)
            links = links_of(self._captures.join(fresh, "url", "left_semi"))
            self.tables.append(self._place(_link_rows(links, self._canonicalize), "links", "url"))
        return self.tables


def crawl(seeds: DataFrame, captures: DataFrame, opts: CrawlOptions = CrawlOptions(),
          edges: DataFrame | None = None, robots_captures: DataFrame | None = None,
          tos_lexicon: DataFrame | None = None) -> CrawlResult:
    """C8-C12. ``seeds``: crawl_id, url. ``captures``: url, html,
    status_code, fetched_at, error. ``edges`` (src, pos, dst) defaults to the
    links of the pages that the crawls reach; no other page is parsed. The
    capture index, the links and the visited URLs are stored by their join keys,
    so a level moves its own rows only. With
    ``opts.canonicalize`` link targets are compared in normalised form
    (fragment dropped); by default URL identity is the raw string. Of several
    captures of a URL the latest counts.
    ``opts.pii_filter`` redacts page content (G1) and adds ``pii_redacted``
    to the summary; ``opts.scan_tos`` (with ``tos_lexicon``) turns pages
    with a blocking clause into ``tos`` skips and adds ``compliant`` (G2/G3).
    """
    if opts.scan_tos and tos_lexicon is None:
        raise ValueError("scan_tos needs a tos_lexicon DataFrame (clause, pattern, severity)")
    frontier, rejects = _seed_frontier(seeds)
    rules = (_checkpoint(rules_by_host(parse_robots(robots_captures), opts.user_agent))
             if opts.respect_robots and robots_captures is not None else None)
    levels: list[DataFrame] = []
    visited: list[DataFrame] = []
    with placed_tables(seeds.sparkSession) as place:
        links = _Links(place, captures, edges, opts.canonicalize)
        index = place(capture_index(captures), "captures", "url")
        for d in range(opts.depth + 1):
            frontier = place(frontier, "visited", "crawl_id", "url")
            if d > 0 and frontier.isEmpty():
                break
            visited.append(frontier.select("crawl_id", "url"))
            level = _checkpoint(classify(frontier, index, opts, rules))
            levels.append(level)
            if d == opts.depth:
                break
            done = reduce(DataFrame.unionByName, levels)
            capped = (done.filter(F.col("reason").isNull()).groupBy("crawl_id").count()
                      .filter(F.col("count") >= opts.max_pages).select("crawl_id"))
            ok_nodes = level.filter(F.col("reason").isNull()).join(capped, "crawl_id", "left_anti")
            frontier = _expand(ok_nodes, links.of(ok_nodes), visited, d + 1, False)
    nodes = reduce(DataFrame.unionByName, levels)
    cut = _cap_cut(nodes, opts.max_pages)
    in_cap = (F.col("cut_depth").isNull()
              | (F.struct("depth", "key") <= F.struct("cut_depth", "cut_key")))
    processed = nodes.join(cut, "crawl_id", "left").filter(in_cap).drop("cut_depth", "cut_key")
    processed = _checkpoint(processed.drop("seed_host"))
    ok_urls = processed.filter(F.col("reason").isNull()).select("crawl_id", "url", "depth", "key")
    reached = latest_captures(captures.join(ok_urls.select("url").distinct(), "url", "left_semi"))
    pages = ok_urls.join(reached, "url").transform(
        lambda df: scrape(df, opts.format, pii_filter=opts.pii_filter))
    skips = processed.filter(F.col("reason").isNotNull()).select(
        "crawl_id", "url", "reason", "detail", "depth")
    compliance = None
    if opts.scan_tos:
        from webloom.operators.compliance import compliance_gate, tos_flags
        pages = _checkpoint(pages)
        flags = tos_flags(pages, tos_lexicon, key_col="url", text_col="content")
        compliance, tos_skips = compliance_gate(pages.select("crawl_id", "url"), flags)
        tos_skips = tos_skips.join(pages.select("crawl_id", "url", "depth"), ["crawl_id", "url"])
        pages = pages.join(tos_skips.select("crawl_id", "url"), ["crawl_id", "url"], "left_anti")
        skips = skips.unionByName(tos_skips.select("crawl_id", "url", "reason", "detail", "depth"))
        processed = processed.join(tos_skips.select("crawl_id", "url", F.col("reason").alias("_t"),
                                                    F.col("detail").alias("_td")),
                                   ["crawl_id", "url"], "left").select(
            *[F.coalesce("_t", "reason").alias("reason") if c == "reason" else
              F.coalesce("_td", "detail").alias("detail") if c == "detail" else F.col(c)
              for c in processed.columns])
    counts = processed.groupBy("crawl_id").agg(
        F.count(F.when(F.col("reason").isNull(), 1)).alias("pages_crawled"),
        F.count(F.when(F.col("reason").isNotNull(), 1)).alias("pages_skipped"))
    summary = (seeds.select("crawl_id", F.col("url").alias("seed_url"))
               .join(rejects.select("crawl_id"), "crawl_id", "left_anti")
               .join(counts, "crawl_id", "left")
               .select("crawl_id", "seed_url",
                       F.coalesce("pages_crawled", F.lit(0)).alias("pages_crawled"),
                       F.coalesce("pages_skipped", F.lit(0)).alias("pages_skipped"))
               .withColumn("pages_discovered",
                           F.col("pages_crawled") + 2 * F.col("pages_skipped"))
               .withColumn("status", F.when(F.col("pages_crawled") > 0, "complete")
                           .otherwise("failed")))
    if opts.pii_filter:
        red = pages.groupBy("crawl_id").agg(F.sum("pii_redacted").alias("pii_redacted"))
        summary = summary.join(red, "crawl_id", "left").fillna(0, ["pii_redacted"])
    if compliance is not None:
        summary = summary.join(compliance.select("crawl_id", "compliant"), "crawl_id", "left") \
            .fillna(True, ["compliant"])
    return CrawlResult(processed, pages, skips, summary, rejects)


def crawl_schedule(nodes: DataFrame, started_at, opts: CrawlOptions = CrawlOptions(),
                   robots_captures: DataFrame | None = None) -> DataFrame:
    """When a polite fetcher would have asked for each URL of crawls that all
    start at ``started_at``: crawl_id, url, depth, host, start_at, for the URLs
    that are fetched (pages and failed fetches). A host is asked in crawl order,
    ``opts.crawl_delay_ms`` apart, or by its robots Crawl-delay where robots
    files are respected."""
    asked = nodes.filter(F.col("reason").isNull() | (F.col("reason") == REASON_ERROR)).select(
        "crawl_id", "url", "depth", url_host("url").alias("host"), F.lit(started_at).cast("timestamp").alias("arrival"),
        F.struct("depth", "key", "crawl_id", "url").alias("seq"))
    delays = (crawl_delays(parse_robots(robots_captures), opts.user_agent)
              if opts.respect_robots and robots_captures is not None else None)
    return fetch_schedule(asked, delays, opts.crawl_delay_ms).select("crawl_id", "url", "depth", "host", "start_at")


def skip_counts(skips: DataFrame) -> DataFrame:
    """Counters by reason."""
    return skips.groupBy("crawl_id", "reason").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------- map ---

def sitemap_urls(sitemap_captures: DataFrame) -> DataFrame:
    """M1: every ``<loc>...</loc>`` on one line, trimmed, in file order; no
    entity decoding; 2xx captures only. Output: host, part, pos, url."""
    part = F.col("part") if "part" in sitemap_captures.columns else F.lit(0)
    s = ok_only(sitemap_captures).select("host", part.cast("int").alias("part"), "body")
    return (s.select("host", "part",
                     F.posexplode(F.regexp_extract_all("body", F.lit("<loc>(.*?)</loc>"), 1))
                     .alias("pos", "loc"))
            .select("host", "part", F.col("pos").cast("int").alias("pos"),
                    js_trim("loc").alias("url")))


def discover(seeds: DataFrame, captures: DataFrame, edges: DataFrame | None = None,
             opts: MapOptions = MapOptions()) -> DataFrame:
    """M3: breadth-first link discovery. Pages up to ``depth`` hops that
    answered 2xx are read; URLs up to depth+1 hops are listed (also those
    whose fetch failed). ``edges`` defaults to the links of the pages read.
    Tables are stored as in ``crawl``. Returns (site, url, depth, key)."""
    f = seeds.filter(valid_url("url")).select(
        F.col("crawl_id"), "url", F.lit(0).alias("depth"), F.array().cast(_KEY_T).alias("key"),
        url_host("url").alias("seed_host"))
    levels: list[DataFrame] = []
    with placed_tables(seeds.sparkSession) as place:
        links = _Links(place, captures, edges, False)
        readable = place(ok_only(capture_index(captures)).select("url"), "readable", "url")
        for d in range(opts.depth + 2):
            f = place(f, "visited", "crawl_id", "url")
            levels.append(f)
            if d == opts.depth + 1 or f.isEmpty():
                break
            read = f.join(readable, "url", "left_semi")
            visited = [x.select("crawl_id", "url") for x in levels]
            f = _expand(read, links.of(read), visited, d + 1, not opts.include_external)
    found = reduce(DataFrame.unionByName, levels)
    return found.select(F.col("crawl_id").alias("site"), "url", "depth", "key")


def map_sites(seeds: DataFrame, sitemap_captures: DataFrame, captures: DataFrame,
              edges: DataFrame | None = None, opts: MapOptions = MapOptions()) -> DataFrame:
    """M4: a site's sitemap when it lists any ``<loc>`` (even if all are then
    filtered out), otherwise link discovery. Distinct (site, url, source)."""
    s = seeds.filter(valid_url("url")).select(
        F.col("crawl_id").alias("site"), url_host("url").alias("host"))
    locs = sitemap_urls(sitemap_captures)
    from_map = s.join(locs, "host")
    if not opts.include_external:
        from_map = from_map.filter(url_host("url") == F.col("host"))
    from_map = from_map.select("site", "url", F.lit("sitemap").alias("source"),
                               F.struct(F.lit(0).alias("depth"),
                                        F.array("part", "pos").alias("key")).alias("ord"))
    with_map = s.join(locs.select("host").distinct(), "host", "left_semi").select("site")
    rest = seeds.withColumnRenamed("crawl_id", "site").join(with_map, "site", "left_anti")
    disc = discover(rest.withColumnRenamed("site", "crawl_id"), captures, edges, opts)
    disc = disc.select("site", "url", F.lit("links").alias("source"),
                       F.struct("depth", "key").alias("ord"))
    both = from_map.unionByName(disc)
    return both.groupBy("site", "url").agg(
        F.min_by("source", "ord").alias("source"), F.min("ord").alias("ord"))


def map_summary(mapped: DataFrame) -> DataFrame:
    """M5: distinct URL count per site."""
    return mapped.groupBy("site").agg(F.countDistinct("url").alias("total"))
