"""Structured Streaming versions of scrape (S6/T1), visited-once (T2) and
change monitoring (T3/D9).

Every stream writes through a checkpointed sink, so a restarted query
resumes where it stopped. ``on_batch`` callbacks get each micro-batch as a
DataFrame (``foreachBatch``), never as collected rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from webloom.operators.monitor import snapshot
from webloom.operators.scrape import scrape
from webloom.session import ensure_checkpoint_dir


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state (visited keys, last hash per URL) in RocksDB on
    local disk instead of executor heap, unless the session chose a store."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB_PROVIDER)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex}"


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """A table as a stream of its files. ``path`` is a folder or a single file;
    Spark streams folders only, so a file is its folder cut down to its name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(place) and fs.getFileStatus(place).isFile():
        path, glob = place.getParent().toString(), place.getName()
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(files_per_trigger))
    return r.load(path)


def stream_pages(captures_stream: DataFrame, format: str = "markdown",
                 on_batch: Callable[[DataFrame, int], None] | None = None,
                 sink_path: str | None = None, checkpoint: str | None = None):
    """Scrape pages as captures arrive. Either ``on_batch(df, epoch)``
    is called per micro-batch, or pages are appended to ``sink_path``.
    Returns the started ``StreamingQuery``."""
    pages = scrape(captures_stream, format)
    w = pages.writeStream.option("checkpointLocation", checkpoint)
    if on_batch is not None:
        return w.foreachBatch(on_batch).trigger(availableNow=True).start()
    return w.format("parquet").option("path", sink_path).outputMode("append") \
        .trigger(availableNow=True).start()


def visited_once(links_stream: DataFrame, watermark_col: str | None = None,
                 delay: str = "1 hour") -> DataFrame:
    """Each (crawl_id, url) once. Without a watermark the state keeps
    every key; with one, keys are forgotten once the watermark passes."""
    use_rocksdb_state(links_stream.sparkSession)
    if watermark_col is None:
        return links_stream.dropDuplicates(["crawl_id", "url"])
    return (links_stream.withWatermark(watermark_col, delay)
            .dropDuplicatesWithinWatermark(["crawl_id", "url"]))


_CHANGE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("prev_hash", T.StringType()),
    T.StructField("hash", T.StringType()),
])
_STATE_SCHEMA = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("micros", T.LongType()),
])


def _tracker(ttl_ms: int | None):
    def track(key, pdfs, state):
        """Per URL: compare each new snapshot (in fetch order, over the whole
        micro-batch) with the last one kept in state; emit a row when the hash
        changed. A snapshot older than the last one of an earlier micro-batch
        is late: it gives no event and leaves the state, so events of a URL
        never go back in time. Snapshots without a time are left out, as in
        the batch history. With a TTL the state expires ``ttl_ms`` of event
        time after the URL's last snapshot."""
        if state.hasTimedOut:
            state.remove()
            return
        last_hash, last = (state.get if state.exists else (None, None))
        seen = last
        out = []
        snaps = pd.concat(list(pdfs)).dropna(subset=["fetched_at"])
        for row in snaps.sort_values(["fetched_at", "hash"]).itertuples(index=False):
            micros = row.fetched_at.value // 1000
            if seen is not None and micros < seen:
                continue
            if last_hash is not None and row.hash != last_hash:
                out.append((row.url, row.fetched_at, last_hash, row.hash))
            last_hash, last = row.hash, micros
        if last is None:
            return
        state.update((last_hash, last))
        if ttl_ms is not None:
            state.setTimeoutTimestamp(last // 1000 + ttl_ms)
        if out:
            yield pd.DataFrame(out, columns=["url", "fetched_at", "prev_hash", "hash"])
    return track


def stream_monitor(captures_stream: DataFrame, selector: str | None = None,
                   ttl_ms: int | None = None) -> DataFrame:
    """Change events (url, fetched_at, prev_hash, hash) as snapshots
    arrive; one state row (last hash) per URL. With ``ttl_ms`` a watermark on
    ``fetched_at`` lets a URL's state expire that long (event time) after its
    last snapshot."""
    use_rocksdb_state(captures_stream.sparkSession)
    snaps = snapshot(captures_stream, selector).select("url", "fetched_at", "hash")
    if ttl_ms is None:
        timeout = GroupStateTimeout.NoTimeout
    else:
        snaps = snaps.withWatermark("fetched_at", f"{int(ttl_ms)} milliseconds")
        timeout = GroupStateTimeout.EventTimeTimeout
    return snaps.groupBy("url").applyInPandasWithState(
        _tracker(ttl_ms), _CHANGE_SCHEMA, _STATE_SCHEMA, "append", timeout)


_ORDERED_SCHEMA = T.StructType([*_CHANGE_SCHEMA.fields, T.StructField("late", T.BooleanType())])


def _ordered_changes() -> StatefulProcessor:
    # Defined in here, so it is shipped by value: the process that sets up the
    # state on the driver does not import this package.
    columns = _ORDERED_SCHEMA.fieldNames()

    class OrderedChanges(StatefulProcessor):
        """Per URL: snapshots wait in state until the watermark has passed them,
        then they are compared in order of time with the last one released. Rows
        that arrive behind the watermark come out as they are, marked late."""

        def init(self, handle) -> None:
            self._handle = handle
            self._last = handle.getValueState("last", "hash string")
            self._held = handle.getMapState("held", "micros bigint, hash string", "at timestamp")

        def handleInputRows(self, key, rows, timerValues):
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            for snaps in rows:  # Arrow chunks of the micro-batch, one at a time
                late = []
                for at, micros, digest in zip(snaps["fetched_at"], snaps["micros"], snaps["hash"], strict=True):
                    if micros < passed:
                        late.append((key[0], at, None, digest, True))
                    else:
                        self._held.updateValue((int(micros), digest), (at,))
                        self._handle.registerTimer(int(micros) // 1000 + 1)
                if late:
                    yield pd.DataFrame(late, columns=columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            due = sorted((tuple(k), v[0]) for k, v in self._held.iterator() if k[0] < passed)
            state = self._last.get()
            last, out = state[0] if state is not None else None, []
            for (micros, digest), at in due:
                if last is not None and digest != last:
                    out.append((key[0], at, last, digest, False))
                last = digest
                self._held.removeKey((micros, digest))
            if due:
                self._last.update((last,))
            if out:
                yield pd.DataFrame(out, columns=columns)

        def close(self) -> None:
            pass

    return OrderedChanges()


def stream_changes(captures_stream: DataFrame, lateness: str = "1 hour", selector: str | None = None) -> DataFrame:
    """T3/D9 with unordered arrival: change events (url, fetched_at, prev_hash,
    hash, late) as the batch history gives them, in whatever order captures
    arrive, as long as none is later than ``lateness`` behind the newest. A
    snapshot is released when the watermark has passed it; one that comes after
    that gives a row with ``late`` true and changes nothing. State per URL: the
    last hash and the snapshots not yet released. Time moves with the data, so
    the end of a finite input is released by later captures (of any URL).
    Snapshots without a time are left out, as in the batch history."""
    use_rocksdb_state(captures_stream.sparkSession)
    snaps = (snapshot(captures_stream, selector).filter("fetched_at is not null")
             .withColumn("_event", F.col("fetched_at")).withWatermark("_event", lateness))
    # Without the watermark's mark on its columns the operator gets late rows too.
    rows = snaps.select("url", F.unix_micros("_event").alias("micros"), F.timestamp_micros(F.unix_micros("_event")).alias("fetched_at"),
                        "hash")
    return rows.groupBy("url").transformWithStateInPandas(
        statefulProcessor=_ordered_changes(), outputStructType=_ORDERED_SCHEMA, outputMode="Append",
        timeMode="EventTime")


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> None:
    """Drain a streaming DataFrame into Parquet at ``path`` (availableNow)."""
    q = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
