"""Scrape: page extraction over a captures table.

One parse pass per page, then native expressions. Output is one row per
capture with the Page fields flattened: url, title, content, format,
status_code, crawled_at, description, og_image, author, published_at,
word_count, links. Extra input columns (keys such as ``page_id``) pass
through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import collapse_ws, js_trim, word_count
from webloom.operators.parse import PART_FIELDS, extract_parts
from webloom.options import check_format
from webloom.sources.captures import latest_captures

# Error text of a requested URL that was never captured.
NOT_CAPTURED = "not captured"

_CONTENT_PART = {"markdown": "markdown", "html": "html", "text": "text", "json": "text"}


def scrape(captures: DataFrame, format: str = "markdown", pii_filter: bool = False) -> DataFrame:
    """E14. ``captures`` needs url and html; status_code / fetched_at / error
    are used when present. HTTP errors are pages, not failures. With
    ``pii_filter`` the content is redacted (G1) before it is counted and
    returned, and ``pii_redacted`` says how many items were replaced."""
    fmt = check_format(format)
    parsed = extract_parts(captures, ["title", "meta", "links", _CONTENT_PART[fmt]])
    title = js_trim("title_raw")  # NULL when there is no <title>
    description = F.coalesce("meta_description", "meta_og_description")
    text = collapse_ws("content_text_raw") if fmt in ("text", "json") else None
    if fmt == "markdown":
        content = F.col("content_markdown")
    elif fmt == "html":
        content = F.col("content_html")
    elif fmt == "text":
        content = text
    else:
        opts = {"ignoreNullFields": "false"}
        with_desc = F.to_json(F.struct(title.alias("title"), description.alias("description"),
                                       text.alias("text"), F.col("links")), opts)
        without = F.to_json(F.struct(title.alias("title"), text.alias("text"),
                                     F.col("links")), opts)
        content = F.when(description.isNull(), without).otherwise(with_desc)
    cols = parsed.columns
    passthrough = [c for c in cols if c not in _PARSE_COLS and c not in
                   ("url", "status_code", "fetched_at", "error")]
    status = F.col("status_code") if "status_code" in cols else F.lit(200)
    fetched = F.col("fetched_at") if "fetched_at" in cols else F.current_timestamp()
    out = parsed.select(
        *passthrough, "url", title.alias("title"), content.alias("content"),
        F.lit(fmt).alias("format"), status.cast("int").alias("status_code"),
        fetched.alias("crawled_at"), description.alias("description"),
        F.col("meta_og_image").alias("og_image"), F.col("meta_author").alias("author"),
        F.coalesce("meta_published_time", "time_datetime").alias("published_at"),
        "links")
    if pii_filter:
        from webloom.operators.compliance import redact_pii
        out = redact_pii(out, "content").drop("n_email", "n_ssn", "n_phone")
    return out.withColumn("word_count", word_count("content"))


_PARSE_COLS = {name for fields in PART_FIELDS.values() for name, _ in fields}


def extract_links(captures: DataFrame, keys=("url",)) -> DataFrame:
    """Every ``a[href]`` of the whole document, in document order,
    duplicates kept; ``dst`` is the href resolved against the page URL in the
    same worker call (NULL when it would not resolve)."""
    cols = list(dict.fromkeys([*keys, "url", "html"]))
    parsed = extract_parts(captures.select(*cols), ["links"])
    return (parsed.select(*dict.fromkeys([*keys, "url"]),
                          F.posexplode(F.arrays_zip(F.col("hrefs").alias("href"),
                                                    F.col("hrefs_resolved").alias("dst"))))
            .select(*dict.fromkeys([*keys, "url"]), F.col("pos").cast("int").alias("pos"),
                    F.col("col.href").alias("href"), F.col("col.dst").alias("dst")))


def batch_scrape(requests: DataFrame, captures: DataFrame, format: str = "markdown"):
    """E15. ``requests``: job_id, url. A URL with no capture, or whose capture
    carries an ``error``, lands in ``failed``; everything else is scraped.
    Of several captures of a URL the latest counts. Returns (results, failed, summary)."""
    cap = captures.select("url", "html", "status_code", "fetched_at", "error")
    cap = latest_captures(cap.join(requests.select("url").distinct(), "url", "left_semi"))
    joined = requests.select("job_id", "url").join(cap, "url", "left")
    ok = joined.filter(F.col("html").isNotNull() & F.col("error").isNull())
    failed = (joined.filter(F.col("html").isNull() | F.col("error").isNotNull())
              .select("job_id", "url",
                      F.coalesce("error", F.lit(NOT_CAPTURED)).alias("error")))
    results = scrape(ok, format)
    good = F.when(F.col("html").isNotNull() & F.col("error").isNull(), 1)
    summary = (joined.groupBy("job_id")
        .agg(F.count(F.lit(1)).alias("total"), F.count(good).alias("succeeded"))
        .withColumn("status", F.when(F.col("succeeded") == F.col("total"), "complete")
                    .when(F.col("succeeded") > 0, "partial").otherwise("failed")))
    return results, failed, summary


def batch_errors(failed: DataFrame, job_id) -> DataFrame:
    """Per-URL errors of one batch job."""
    return failed.filter(F.col("job_id") == F.lit(job_id))
