"""Session helpers: building a local session for tests/bench and locating the
shared checkpoint folder on a real cluster."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Parse-heavy stages move whole HTML documents through Arrow; keep batches
# small enough that a batch of 60 kB pages stays far below executor memory.
ARROW_BATCH_ROWS = 256
SPREAD_CONF = "webloom.parse.partitions"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "webloom") -> SparkSession:
    """A local session configured the way the library expects (UTC, AQE,
    Arrow, no UI). On a cluster, build the session with the same confs."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Test tables are single row groups; without this one task would parse them.
    spark.conf.set(SPREAD_CONF, str(2 * spark.sparkContext.defaultParallelism))
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Session settings every operator relies on; safe to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``webloom`` importable in executor Python workers (the Arrow
    functions import its helpers there): zip the package once per
    application and distribute it with ``addPyFile``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    sc.addPyFile(package_zip())
    _SHIPPED.add(app)


def package_zip() -> str:
    """Zip the ``webloom`` sources (``.py`` files, package layout kept)."""
    import zipfile

    import webloom
    pkg_dir = os.path.dirname(os.path.abspath(webloom.__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="webloom-pkg-", dir=os.environ.get("TMPDIR", "/tmp"))
    path = os.path.join(out_dir, "webloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``. Only a local
    master (tests, bench) may fall back to a private temporary folder; on a
    cluster the setting is required because executors can be lost."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="webloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def stored(df, name: str):
    """Write ``df`` as Parquet to a fresh folder below the shared checkpoint
    folder and read it back: lineage ends there, a lost executor costs
    nothing, and every later branch reads only the columns it needs."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def placed_tables(spark: SparkSession):
    """Yields ``place(df, name, *keys)``: ``df`` written to the shared checkpoint
    folder as a table bucketed and sorted by ``keys`` (one file a bucket, as many
    buckets as shuffle partitions), so joins and groupings on the keys read it
    without an Exchange. Plans made from the tables stay valid when their names
    are dropped at the end; the files stay with the checkpoints."""
    made: list[str] = []

    def place(df, name: str, *keys: str):
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"webloom_{name}_{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
        made.append(table)
        (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path)
         .format("parquet").saveAsTable(table))
        return spark.table(table)

    try:
        yield place
    finally:
        for table in made:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def spread(df, *keys):
    """Spread CPU-heavy per-row work (HTML parsing, regex scans, tokenising)
    over as many partitions as the session asks for with
    ``webloom.parse.partitions``, by hash of the row key. Unset (the default on
    a cluster, where file splits outnumber cores) the rows stay where they are.
    Only the setting decides: no plan is run to find out."""
    wanted = df.sparkSession.conf.get(SPREAD_CONF, None)
    if df.isStreaming or not wanted:
        return df
    return df.repartition(int(wanted), *keys)
