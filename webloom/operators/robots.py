"""Robots exclusion (R1-R4) as joins and aggregates.

Rules are parsed with native string functions (one robots file per host is
small and bounded, so a per-host window over its lines is cheap). The check
joins URLs to the rules of their host: Spark/AQE broadcasts the rules side
when its runtime size is under the broadcast threshold and otherwise falls
back to a shuffle join with skew splitting, so a host owning a third of the
URLs does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.functions.text import js_trim
from webloom.functions.urls import url_host
from webloom.operators.scan import SEGMENT, SEGMENT_ROWS, earlier, segments, within
from webloom.options import DEFAULT_AGENT, ROBOTS_TTL_SECONDS
from webloom.sources.captures import ok_only

# The reason text of a robots skip ({agent} = product token).
BLOCKED_REASON = 'Blocked by robots.txt rule for user-agent "{agent}"'


def agent_token(user_agent: str) -> str:
    """Product token of a user agent, lower-cased, version dropped."""
    return user_agent.split("/")[0].strip().lower()


def latest_robots(robots_captures: DataFrame) -> DataFrame:
    """The most recent robots capture of each host (whatever its status: a
    later failed fetch means no rules)."""
    cols = [c for c in robots_captures.columns if c != "host"]
    return (robots_captures.groupBy("host")
            .agg(F.max_by(F.struct(*cols), "fetched_at").alias("_c"))
            .select("host", "_c.*"))


def parse_robots(robots_captures: DataFrame, latest: bool = True) -> DataFrame:
    """One row per directive line that matters:
    host, group_id, line_no, agent (for user-agent lines), kind
    ('allow'/'disallow'/'crawl-delay'), pattern, delay_sec. With ``latest``
    (the default) only each host's most recent capture is parsed; otherwise
    ``host`` must already identify one capture."""
    src = latest_robots(robots_captures) if latest else robots_captures
    ok = ok_only(src).select("host", "body")
    lines = ok.select("host", F.posexplode(F.split(F.regexp_replace("body", "^\uFEFF", ""), r"\r?\n")).alias("line_no", "line"))
    stripped = js_trim(F.regexp_replace("line", "#.*$", ""))
    d = (lines.select("host", "line_no", stripped.alias("line"))
         .filter(F.col("line").contains(":"))
         .select("host", "line_no",
                 F.lower(js_trim(F.regexp_extract("line", r"^([^:]*):", 1))).alias("key"),
                 js_trim(F.regexp_extract("line", r"^[^:]*:(.*)$", 1)).alias("value"))
         .filter(F.col("key").isin("user-agent", "allow", "disallow", "crawl-delay")))
    w = Window.partitionBy("host").orderBy("line_no")
    is_ua = F.col("key") == "user-agent"
    new_group = is_ua & (F.coalesce(F.lag("key").over(w), F.lit("")) != "user-agent")
    d = d.withColumn("group_id", F.sum(new_group.cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.filter(F.col("group_id") > 0).select(
        "host", F.col("group_id").cast("int").alias("group_id"), "line_no",
        F.when(is_ua, F.lower(F.trim(F.split("value", "/").getItem(0)))).alias("agent"),
        F.when(is_ua, F.lit("user-agent")).otherwise(F.col("key")).alias("kind"),
        F.when(F.col("key").isin("allow", "disallow"), F.col("value")).alias("pattern"),
        F.when(F.col("key") == "crawl-delay", F.expr("try_cast(value AS DOUBLE)"))
        .alias("delay_sec"))


def _with_effective(rules: DataFrame, user_agent: str) -> DataFrame:
    """Marks each rule row whose group applies to the agent: the groups
    naming it, or else the ``*`` groups. Windows over one robots file (per
    host) -- a single pass, no self-join."""
    ua = agent_token(user_agent)
    by_group = Window.partitionBy("host", "group_id")
    by_host = Window.partitionBy("host")
    agents = F.collect_set("agent").over(by_group)
    has_ua = F.max((F.col("agent") == ua).cast("int")).over(by_host)
    eff = F.when(F.coalesce(has_ua, F.lit(0)) == 1, F.array_contains(agents, ua)) \
        .otherwise(F.array_contains(agents, "*"))
    return rules.withColumn("_eff", eff)


def agent_rules(rules: DataFrame, user_agent: str = DEFAULT_AGENT) -> DataFrame:
    """host, kind, pattern, line_no of the allow/disallow rules for the
    agent (empty ``Disallow:`` is no rule)."""
    return (_with_effective(rules, user_agent)
            .filter(F.col("_eff") & F.col("kind").isin("allow", "disallow") & (F.col("pattern") != ""))
            .select("host", "kind", "pattern", "line_no"))


def crawl_delays(rules: DataFrame, user_agent: str = DEFAULT_AGENT) -> DataFrame:
    """Host, delay_sec for the agent's groups (last value wins); hosts
    without one are absent (NULL after a left join)."""
    return (_with_effective(rules, user_agent)
            .filter(F.col("_eff") & (F.col("kind") == "crawl-delay") & F.col("delay_sec").isNotNull())
            .groupBy("host").agg(F.max_by("delay_sec", "line_no").alias("delay_sec")))


def _path_query(url_col) -> F.Column:
    p = F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    return F.when(p == "", F.lit("/")).when(p.startswith("?"), F.concat(F.lit("/"), p)) \
        .otherwise(p)


def _pattern_regex(pat) -> F.Column:
    """Robots pattern to an anchored Java regexp: ``*`` any run, trailing
    ``$`` end of path, everything else literal."""
    esc = F.regexp_replace(pat, r"([\\.\[\]{}()+?^|])", r"\\$1")
    body = F.regexp_replace(F.regexp_replace(esc, r"\$(?!$)", r"\\\$"), r"\*", ".*")
    return F.concat(F.lit("^"), body)


def rules_by_host(rules: DataFrame, user_agent: str = DEFAULT_AGENT) -> DataFrame:
    """The agent's allow/disallow rules compiled once per robots file: host,
    _rules, an array in order of precedence (longest pattern first, Allow before
    Disallow) of the literal prefix, or the regexp of a pattern with wildcards."""
    wild = F.col("pattern").rlike(r"[*$]")
    rule = F.struct((-F.length("pattern")).alias("rank"), (F.col("kind") != "allow").alias("deny"),
                    F.when(~wild, F.col("pattern")).alias("prefix"),
                    F.when(wild, _pattern_regex(F.col("pattern"))).alias("regex"))
    return (agent_rules(rules, user_agent).groupBy("host")
            .agg(F.array_sort(F.collect_set(rule)).alias("_rules")))


def _verdict(path: F.Column, rules_col: F.Column) -> F.Column:
    """The first rule in order of precedence that matches decides; nothing
    matches or no rules: allowed. Evaluated per row with higher-order functions."""
    hits = F.filter(rules_col, lambda r: F.when(r["regex"].isNull(), path.startswith(r["prefix"]))
                    .otherwise(F.regexp_like(path, r["regex"])))
    return F.coalesce(~F.get(hits, F.lit(0))["deny"], F.lit(True))


def robots_check(urls: DataFrame, rules: DataFrame, user_agent: str = DEFAULT_AGENT,
                 url_col: str = "url") -> DataFrame:
    """R2: adds ``allowed`` and ``robots_reason`` to every row of ``urls``.
    ``rules``: parsed rules, or those of ``rules_by_host``, which a caller with
    many checks compiles once. Each URL is left-joined to its host's rule array
    (the small side is the build side, so AQE can broadcast it and the URL side
    is not shuffled) and judged in place -- no per-URL aggregation."""
    compiled = rules if "_rules" in rules.columns else rules_by_host(rules, user_agent)
    per_host = compiled.withColumnRenamed("host", "_rhost")
    u = urls.withColumn("_host", url_host(url_col))
    m = u.join(per_host, F.col("_host") == F.col("_rhost"), "left")
    allowed = _verdict(_path_query(F.col(url_col)), F.col("_rules"))
    reason = F.when(~allowed, F.lit(BLOCKED_REASON.format(agent=agent_token(user_agent))))
    return m.select(*urls.columns, allowed.alias("allowed"), reason.alias("robots_reason"))


def _fresh_capture(requests: DataFrame, captures: DataFrame, ttl_seconds: int, time_col: str,
                   segment_rows: int) -> DataFrame:
    """An as-of merge: every request (``_req``, a struct of its columns, and
    ``_host``) with ``robots_fetched_at``, the time of the last capture of its
    host at or before it, NULL if older than the TTL. Requests and captures are
    one ordered run of (host, time); the last capture is carried forward within
    a segment, and from the segments before by one row each."""
    asked = requests.select(F.struct("*").alias("_req"), url_host(F.col("_url")).alias("_host"),
                            F.col(time_col).cast("timestamp").alias("_t"))
    events = (asked.withColumn("_cap", F.lit(None).cast("timestamp"))
              .unionByName(captures.select(F.col("host").alias("_host"), F.col("fetched_at").alias("_t"),
                                           F.col("fetched_at").alias("_cap")), allowMissingColumns=True)
              .withColumn("_asks", F.col("_cap").isNull())
              .withColumn("_tie", F.monotonically_increasing_id()))
    order = ["_t", "_asks", "_tie"]  # a capture comes before the requests of its instant
    run = segments(events, ["_host"], order, segment_rows, "asof")
    upto = within(["_host"], order).rowsBetween(Window.unboundedPreceding, 0)
    run = run.withColumn("_near", F.last("_cap", ignorenulls=True).over(upto))
    carry = (run.groupBy("_host", SEGMENT).agg(F.max("_cap").alias("_cap"))
             .withColumn("_far", F.max("_cap").over(earlier(["_host"])))
             .filter(F.col("_far").isNotNull()).select("_host", SEGMENT, "_far"))
    at = F.coalesce("_near", "_far")
    age = F.unix_micros("_t") - F.unix_micros(at)
    return (run.filter("_asks").join(carry, ["_host", SEGMENT], "left")
            .select("_req", "_host", F.when(age <= ttl_seconds * 1_000_000, at).alias("robots_fetched_at")))


def robots_asof(requests: DataFrame, robots_captures: DataFrame,
                ttl_seconds: int = ROBOTS_TTL_SECONDS, user_agent: str = DEFAULT_AGENT,
                url_col: str = "url", time_col: str = "requested_at",
                segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Judge each request with the robots file that was fresh at request
    time: the latest successful capture of its host with
    0 <= t - fetched_at <= ttl. None fresh: allowed, ``robots_known`` false.
    Found by one ordered merge of requests and captures, never by pairing the
    times of a host with its captures; repeated requests are rows of their own.
    Rules are parsed once per capture, keyed by (host, fetched_at)."""
    caps = ok_only(robots_captures).filter("host is not null and fetched_at is not null").select(
        "host", "fetched_at", "body")
    chosen = _fresh_capture(requests.withColumn("_url", F.col(url_col)), caps.select("host", "fetched_at"),
                            ttl_seconds, time_col, segment_rows)

    def cap_key(h, ts):
        return F.concat_ws("@", h, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))

    rules = parse_robots(caps.select(cap_key(F.col("host"), F.col("fetched_at")).alias("host"),
                                     "body", F.lit(200).alias("status_code")), latest=False)
    per_cap = rules_by_host(rules, user_agent).withColumnRenamed("host", "_rk2")
    m = (chosen.withColumn("_rk", cap_key(F.col("_host"), F.col("robots_fetched_at")))
         .join(per_cap, F.col("_rk") == F.col("_rk2"), "left"))
    allowed = _verdict(_path_query(F.col("_req._url")), F.col("_rules"))
    return m.select(*[F.col("_req")[c].alias(c) for c in requests.columns], "robots_fetched_at",
                    allowed.alias("allowed"), F.col("robots_fetched_at").isNotNull().alias("robots_known"))
