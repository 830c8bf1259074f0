"""SQL building blocks for the DuckDB oracle: the fixture rules of
``webloom.sources.fixtures`` and a few scalar idioms, written in DuckDB SQL.

The oracle side never tokenises HTML: it reads the fixed shape of the driver's
pages with regular expressions (FIXTURES.md §1), so it is an independent
check of the Spark tokeniser."""

from __future__ import annotations

AUTH_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^@/?#]*@)?([^/?#]*)"


def host(col: str) -> str:
    a = f"lower(regexp_extract({col}, '{AUTH_RE}', 1))"
    s = f"lower(regexp_extract({col}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1))"
    return (f"(CASE WHEN {s} IN ('http','ws') AND {a} LIKE '%:80' THEN regexp_replace({a}, ':80$', '') "
            f"WHEN {s} IN ('https','wss') AND {a} LIKE '%:443' THEN regexp_replace({a}, ':443$', '') "
            f"ELSE {a} END)")


def decode(col: str) -> str:
    """The four entities that occur in the driver's pages; &amp; last."""
    return (f"replace(replace(replace(replace({col}, '&quot;', '\"'), '&copy;', '©'), "
            f"'&middot;', '·'), '&amp;', '&')")


def strip_tags(col: str) -> str:
    return (f"regexp_replace(regexp_replace({col}, '(?s)<!--.*?-->', '', 'g'), "
            f"'<[^>]*>', '', 'g')")


def collapse(col: str) -> str:
    return f"trim(regexp_replace({col}, '\\s+', ' ', 'g'))"


def words(col: str) -> str:
    return f"len(list_filter(string_split_regex({col}, '\\s+'), lambda x: x <> ''))"


def iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def article(col: str) -> str:
    return f"regexp_extract({col}, '(?s)<article>(.*?)</article>', 1)"


def title(col: str) -> str:
    inner = decode(f"regexp_extract({col}, '(?s)<title>(.*?)</title>', 1)")
    return f"CASE WHEN {col} LIKE '%<title>%' THEN trim({inner}) END"


CAP = """cap AS (
  SELECT page_id, url, html,
         CAST(CASE WHEN page_id % 17 = 0 THEN 404 ELSE 200 END AS INTEGER) AS status_code,
         epoch_ms(1704067200000 + page_id * 700) AS fetched_at,
         CAST(NULL AS VARCHAR) AS error
  FROM pages)"""

PAGE_HOSTS = f"""ph AS (SELECT page_id, url, {host('url')} AS host FROM pages)"""

EDGES = f"""{PAGE_HOSTS},
npages AS (SELECT count(*) AS n FROM pages),
ranked AS (SELECT page_id, url, host, row_number() OVER (PARTITION BY host ORDER BY page_id) - 1 AS r FROM ph),
edges AS (
  SELECT p.url AS src, (c.r - 1) % 10 AS pos, c.url AS dst FROM ranked c JOIN ranked p ON p.host = c.host AND p.r = (c.r - 1) // 10
  WHERE c.r > 0
  UNION ALL SELECT a.url, 10, b.url FROM ph a, npages, ph b
            WHERE b.page_id = (a.page_id * 7 + 3) % npages.n)"""

SEEDS = f"""seeds AS (SELECT host AS crawl_id, arg_min(url, page_id) AS url FROM ph GROUP BY host)"""

HOSTS = f"""hosts AS (SELECT DISTINCT host FROM ph)"""

ROBOTS = f"""rr AS (
  SELECT host, length(host) % 4 AS k, 0 AS off_ms FROM hosts
  UNION ALL SELECT host, (length(host) + 1) % 4, 60000 FROM hosts WHERE length(host) % 3 = 0),
robots_captures AS (
  SELECT host,
         CASE k WHEN 1 THEN 'User-agent: *' || chr(10) || 'Disallow: /fr'
              WHEN 2 THEN 'User-agent: *' || chr(10) || 'Disallow: /' || chr(10) || 'Allow: /en'
              WHEN 3 THEN 'User-agent: *' || chr(10) || 'Crawl-delay: 2' || chr(10) || 'Disallow: /*.html$'
              ELSE '' END AS body,
         CASE WHEN k = 0 THEN 404 ELSE 200 END AS status_code,
         epoch_ms(1704067200000 + off_ms + (length(host) % 5) * 40000) AS fetched_at
  FROM rr)"""

SITEMAPS = f"""sitemap_captures AS (
  SELECT host, CAST(page_id // 50000 AS INTEGER) AS part,
         '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<urlset>' || chr(10) ||
         string_agg('<url><loc>' || CASE WHEN page_id % 2 = 1 THEN ' ' || url || ' ' ELSE url END
                    || '</loc></url>', chr(10) ORDER BY page_id) ||
         CASE WHEN page_id // 50000 = 0 THEN chr(10) || '<url><loc>https://external.example.net/about</loc></url>' ELSE '' END
         || chr(10) || '</urlset>' AS body,
         200 AS status_code
  FROM ph WHERE length(host) % 2 = 0 GROUP BY host, page_id // 50000
  UNION ALL
  SELECT host, 0 AS part, '' AS body, 404 AS status_code FROM hosts WHERE length(host) % 2 = 1)"""
