"""Change events of captures that arrive out of order."""
import datetime as dt
import os
import random
import time

from webloom import schemas
from webloom.operators.monitor import snapshot, snapshot_history
from webloom.streaming.streams import read_stream, run_to_table, stream_changes, work_dir

BASE = dt.datetime(2024, 1, 1)


def capture(url, body, minute):
    return (url, f"<body><p>{body}</p></body>", 200, None if minute is None else BASE + dt.timedelta(minutes=minute), None)


def events(spark, batches, lateness):
    wd = work_dir(spark, "test-changes")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schemas.CAPTURES).coalesce(1).write.parquet(f"{wd}/part{i}")
        name = next(f for f in os.listdir(f"{wd.removeprefix('file:')}/part{i}") if f.endswith(".parquet"))
        os.makedirs(f"{wd.removeprefix('file:')}/in", exist_ok=True)
        target = f"{wd.removeprefix('file:')}/in/{i}.parquet"
        with open(f"{wd.removeprefix('file:')}/part{i}/{name}", "rb") as f, open(target, "wb") as out:
            out.write(f.read())
        os.utime(target, (time.time() - 1000 + i, time.time() - 1000 + i))  # read in this order
    src = read_stream(spark, f"{wd}/in", schemas.CAPTURES, files_per_trigger=1)
    run_to_table(stream_changes(src, lateness), f"{wd}/out", f"{wd}/ckpt")
    return spark.read.parquet(f"{wd}/out").collect()


def test_rows_in_the_order_a_c_b(spark):
    batches = [[capture("u", "A", 1)], [capture("u", "C", 3), capture("v", "A", 3), capture("u", "C", None)], [capture("u", "B", 2)],
               [capture("end", "", 300)], [capture("u", "Q", 2.5)], [capture("end", "", 600)]]
    got = events(spark, batches, "1 hour")
    minute = {r.fetched_at: (r.fetched_at - BASE).total_seconds() / 60 for r in got}
    assert sorted((r.url, minute[r.fetched_at]) for r in got if not r.late) == [("u", 2.0), ("u", 3.0)]
    assert [(r.url, minute[r.fetched_at], r.prev_hash) for r in got if r.late] == [("u", 2.5, None)]


def test_shuffled_stream_equals_the_batch_history(spark):
    rng = random.Random(5)
    rows = [capture(f"u{rng.randrange(4)}", rng.choice("xyz"), m) for m in rng.sample(range(1000), 120)]
    shuffled = sorted(rows, key=lambda r: r[3] + dt.timedelta(minutes=rng.randrange(200)))
    batches = [shuffled[i:i + 30] for i in range(0, 120, 30)] + [[capture("end", "", 5_000)]]
    got = events(spark, batches, "200 minutes")
    batch = snapshot_history(snapshot(spark.createDataFrame(rows, schemas.CAPTURES)).select("url", "fetched_at", "hash")).collect()
    assert not [r for r in got if r.late]
    assert sorted((r.url, r.fetched_at, r.prev_hash, r.hash) for r in got) == sorted(tuple(r) for r in batch)


def test_stream_scrape_reads_a_table_of_files_as_it_reads_one_file(spark, tmp_path):
    from webloom.plans.queries import stream_scrape
    pages = [(i, f"https://h.example/{i}", f"<html><head><title>T{i}</title></head><body><article><p>one two {i}</p></article></body></html>")
             for i in range(7)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    df.repartition(3).write.parquet(str(tmp_path / "many" / "pages.parquet"))
    df.limit(0).write.parquet(str(tmp_path / "none" / "pages.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "written"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "written").glob("part-*.parquet")).rename(tmp_path / "one" / "pages.parquet")
    want = [(i, f"https://h.example/{i}", f"T{i}", 3) for i in range(7)]
    for name, rows in (("many", want), ("one", want), ("none", [])):
        assert sorted(map(tuple, stream_scrape(spark, str(tmp_path / name)).collect())) == rows, name
