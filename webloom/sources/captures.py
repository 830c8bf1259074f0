"""Readers for captured web data (stand-ins for the network) and the sinks.

Every reader applies an explicit schema (no inference) so Parquet column
pruning and predicate pushdown reach the scan."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom import schemas


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Url, html, status_code, fetched_at, error."""
    return spark.read.schema(schemas.CAPTURES).parquet(path)


def ok_only(df: DataFrame) -> DataFrame:
    """A 2xx capture: robots, sitemap and discovery treat anything else as
    absent."""
    return df.filter(F.col("status_code").between(200, 299))


def latest_captures(df: DataFrame) -> DataFrame:
    """One capture per URL: the most recent (ties broken by status code).
    Crawls and batch scrapes join captures on url and expect it unique."""
    cols = [c for c in df.columns if c != "url"]
    latest = F.max_by(F.struct(*cols), F.struct("fetched_at", "status_code"))
    return df.groupBy("url").agg(latest.alias("_c")).select("url", "_c.*")


def read_robots(spark: SparkSession, path: str) -> DataFrame:
    """Host, body, status_code, fetched_at."""
    return spark.read.schema(schemas.ROBOTS_CAPTURES).parquet(path)


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """S3: host, body, status_code."""
    return spark.read.schema(schemas.SITEMAP_CAPTURES).parquet(path)


def read_serps(spark: SparkSession, path: str) -> DataFrame:
    """query_id, query, html, fetched_at (+ status_code, optional)."""
    return spark.read.schema(schemas.SERP_CAPTURES).parquet(path)


#: The tables of a stored crawl, and the most files of a bucket of each.
CRAWL_TABLES = ("pages", "skips", "summary")
BUCKETS, FILES_PER_BUCKET = 16, 8
MANIFEST = "number long, version string, tables map<string,string>"


def write_crawl(result, path: str, buckets: int = BUCKETS, files_per_bucket: int = FILES_PER_BUCKET) -> None:
    """The three crawl outputs as one version of Parquet tables. Crawls are
    dealt over ``buckets`` folders by a hash of crawl_id, a large one over
    ``files_per_bucket`` files, so files are bounded however many crawls there
    are. A version is staged under a name of its own and counts once its
    manifest is written, after all its tables; what a failed run left, and the
    version before, goes then. Readers see one version or the other."""
    spark, base, version = result.pages.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    for name in CRAWL_TABLES:
        df = getattr(result, name).withColumn("bucket", F.pmod(F.xxhash64("crawl_id"), F.lit(buckets)).cast("int"))
        salt = F.pmod(F.xxhash64(*[c for c in ("crawl_id", "url") if c in df.columns]), F.lit(files_per_bucket))
        (df.repartition(buckets * files_per_bucket, "bucket", salt)
         .write.partitionBy("bucket").parquet(f"{base}/data/{version}/{name}"))
    last = _manifest(spark, base)
    number = 1 + (last.number if last else 0)
    tables = {name: getattr(result, name).schema.json() for name in CRAWL_TABLES}
    spark.createDataFrame([(number, version, tables)], MANIFEST).coalesce(1).write.parquet(
        f"{base}/manifests/{number:012d}-{version}")
    fs, folder = _folder(spark, f"{base}/data")
    for old in fs.listStatus(folder):
        if old.getPath().getName() != version:
            fs.delete(old.getPath(), True)
    fs, folder = _folder(spark, f"{base}/manifests")
    for old in fs.listStatus(folder):
        if not old.getPath().getName().endswith(version):
            fs.delete(old.getPath(), True)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _manifest(spark: SparkSession, base: str):
    """The newest complete manifest, or None."""
    fs, folder = _folder(spark, f"{base}/manifests")
    done = [s.getPath().toString() for s in (fs.listStatus(folder) if fs.exists(folder) else [])
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return spark.read.schema(MANIFEST).parquet(*done).orderBy(F.desc("number")).first() if done else None


def read_crawl(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the crawl stored at ``path`` by name (pages, skips, summary)."""
    base = path.rstrip("/")
    manifest = _manifest(spark, base)
    if manifest is None:
        raise ValueError(f"no stored crawl at {path}")
    schemas_ = {name: T.StructType.fromJson(json.loads(text)) for name, text in manifest.tables.items()}
    return {name: spark.read.schema(schemas_[name]).parquet(f"{base}/data/{manifest.version}/{name}").drop("bucket")
            for name in CRAWL_TABLES}
