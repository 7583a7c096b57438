"""Streams: resolution by keyed state against the batch, page scans that go on where they stopped, late rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from gridlode.functions.schemas import RAW
from gridlode.operators import snapshot
from gridlode.operators.identity import with_identities
from gridlode.plans import streamed
from gridlode.sources import html, pages
from gridlode.sources.buckets import Table
from gridlode.streaming import resolution, updates
from tests.test_sources import HEAD, served
from tests.test_store import record


def files(spark, folder, *batches):
    for rows in batches:
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_resolution_by_state_equals_the_batch(spark, tmp_path):
    rng = random.Random(2)
    made = [
        record(n, tu_number=f"{n % 9}", requested_power_kw=rng.choice([None, 5.0, 7.5]), voltage_raw=rng.choice([None, "10"]), rem=rng.choice(["a", "b"]), connection_point_raw=rng.choice(["ТП №55", None]))
        for n in range(60)
    ]
    rng.shuffle(made)
    batches = [made[:20], made[20:45], made[10:30] + made[45:], made[:5]]  # the third repeats rows of both, the last brings nothing new
    table = Table(spark, str(tmp_path / "t"))
    mark = str(tmp_path / "mark")
    for n in (2, 4):  # the query stops after two batches and goes on from its state
        stream = files(spark, tmp_path / "in", *batches[n - 2 : n])
        resolution.resolution_stream(spark, with_identities(stream), table, mark).awaitTermination()
        want = snapshot.resolve(with_identities(spark.createDataFrame([r for k, r in enumerate(made) if n == 4 or k < 45], RAW)))
        key = lambda r: r["logical_tu_key"]
        assert [r.asDict() for r in sorted(table.read().collect(), key=key)] == [r.asDict() for r in sorted(want.collect(), key=key)]
    assert table.manifest().number <= 5 and spark.conf.get(resolution.STATE_STORE[0], "") != resolution.STATE_STORE[1]


def page(n, last):
    return f"<table>{HEAD}<tr><td>T{n}</td><td>01-06-2026</td><td>генерація</td><td>ТП №{n}</td><td>10</td><td>5</td></tr></table><a href='?page={last}'>{last}</a>"


def test_a_page_stream_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pages, "PAUSE", 0.0)
    last, out, mark = [3], str(tmp_path / "out"), str(tmp_path / "mark")
    broken = {5}

    def scan(url, open_pages):
        found = html.table_records(pages.scan_stream(spark, url, open_pages=open_pages), "reg")
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
        found.writeStream.foreachBatch(write).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()

    with served(lambda n, k: 503 if n in broken else page(n, last[0])) as (url, seen):
        scan(url, 0)
        assert seen == {1: 2, 2: 1, 3: 1}  # the first page once more, for its links
        scan(url, 0)
        assert seen == {1: 3, 2: 1, 3: 1}
        last[0] = 6
        with pytest.raises(Exception):
            scan(url, 0)
        broken.clear()
        scan(url, 0)
        assert seen[2] == seen[3] == 1 and seen[5] > 1
        last[0] = 9
        scan(url, 2)  # the last two may still grow
        assert max(seen) == 7
    got = spark.read.schema(RAW).parquet(f"{out}/batch=*").collect()
    assert sorted((r["source_page"], r["tu_number"]) for r in got) == [(n, f"T{n}") for n in range(1, 8)]


@pytest.mark.parametrize("ids", [range(250), (0, 3, 60)])
def test_pages_are_served_while_tasks_hold_all_cores(spark, tmp_path, ids):
    """More pages than cores: each page's task waits for its answer. Missing ids leave their places empty."""
    url = lambda n: None if n == 3 else f"http://h/{n}"
    spark.createDataFrame([(n, url(n)) for n in ids], "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = streamed.page_stream(spark, str(tmp_path)).collect()
    want = [(n // 25 + 1, n % 25 + 1, f"P{n}", f"TP-{n}", url(n) and len(url(n)) + 0.5, 3 if n < 25 else 1) for n in ids]
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == want


def test_links_of_a_page():
    assert html.last_linked("<a href='/x?a=1&amp;page=7'>z</a><a href=\"/y\"> 12 </a>") == 12 and html.last_linked("", 4) == 4


def test_late_rows_are_left_out(spark, tmp_path):
    day = lambda d, h=0: datetime.datetime(2026, 8, d, h)
    at = lambda *days: [record(n, fetched_at=day(*x)) for n, x in enumerate(days)]
    # the second batch moves the watermark to the 18th, which holds for the batches after the next
    stream = files(spark, tmp_path / "in", at((1,), (1, 5)), at((20,)), at((20, 3), (1, 7)), at((2,), (19, 5), (21,)))
    found = updates.activity_windows(stream)
    done = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).outputMode("append").trigger(availableNow=True).start()
    done.awaitTermination()
    got = spark.read.schema(found.schema).parquet(str(tmp_path / "out")).orderBy("window").collect()
    assert [(r["window"]["start"].day, r["records"], r["power_kw"]) for r in got if r["window"]["start"].day < 19] == [(1, 3, 15.0)]  # the 2nd comes too late


def test_a_stream_keeps_its_scratch_folder_empty(spark, tmp_path):
    from gridlode.sources.files import scratch_dir
    from gridlode.sources.store import Store

    kept = Store(spark, str(tmp_path / "store"))
    before = {n for n, _ in kept.files.names(scratch_dir(spark))}
    updates.update_stream(files(spark, tmp_path / "in", [record(1)]), kept, "reg", str(tmp_path / "mark"), datetime.date(2026, 8, 31)).awaitTermination()
    assert {n for n, _ in kept.files.names(scratch_dir(spark))} <= before and kept.read("tu_raw").count() == 1
    assert kept.runs().select(F.map_values("counts").alias("v")).first()["v"]
