"""Hand-written schemas of the captured inputs (applied on read, never
inferred)."""

from pyspark.sql import types as T

CAPTURES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("error", T.StringType()),
])

ROBOTS_CAPTURES = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampType()),
])

SITEMAP_CAPTURES = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
])

SERP_CAPTURES = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("status_code", T.IntegerType()),
])

SEEDS = T.StructType([
    T.StructField("crawl_id", T.StringType()),
    T.StructField("url", T.StringType()),
])

EDGES = T.StructType([
    T.StructField("src", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("dst", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("clause", T.StringType()),
    T.StructField("pattern", T.StringType()),
    T.StructField("severity", T.StringType()),
])
