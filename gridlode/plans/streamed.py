"""Queries that run streams to their end: incremental resolution, paged scans and event-time windows.

Their inputs are files that Spark writes from the driver's tables, in the order of
their arrival, with rows that come late and batches that come twice.
"""

from __future__ import annotations

import contextlib
import functools
import http.server
import threading
import uuid
from collections.abc import Iterator
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlode.functions.schemas import RAW
from gridlode.operators.identity import with_identities
from gridlode.plans import adapter
from gridlode.plans.catalogue import query
from gridlode.plans.stored import _RESOLVED
from gridlode.sources import html, pages
from gridlode.sources.buckets import Files, Table
from gridlode.sources.files import scratch_dir
from gridlode.streaming import resolution, updates


def _folder(spark: SparkSession, what: str) -> str:
    return f"{scratch_dir(spark)}/{what}-{uuid.uuid4().hex}"


def arrivals(spark: SparkSession, batches: list[DataFrame], what: str) -> DataFrame:
    """A stream of files that come one after the other, each a micro-batch of its own."""
    folder = _folder(spark, what)
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query(
    f""", {_RESOLVED} SELECT logical_tu_key, CASE WHEN sigs = 1 THEN 'canonical' ELSE 'ambiguous' END AS status, CASE WHEN sigs = 1 THEN fp END AS representative_fingerprint, observation_count, row_version_count,
    sigs AS material_signature_count, CASE WHEN sigs = 1 THEN '' ELSE conflicts END AS conflict_fields, CASE WHEN sigs > 1 THEN lo END AS low, CASE WHEN sigs > 1 THEN hi END AS high FROM res""",
    records="observed",
)
def resolution_stream(spark, d):
    """Late records come in the second batch, the whole first batch comes again in the third, with the rest."""
    rows = adapter.observed(spark, d)
    third = F.col("source_page") % 7 % 3
    batches = [rows.where(third == 0), rows.where(third == 2), rows.where(third != 2)]
    table = Table(spark, _folder(spark, "resolutions"))
    ided = with_identities(arrivals(spark, batches, "observed"))
    resolution.resolution_stream(spark, ided, table, _folder(spark, "mark")).awaitTermination()
    counts = ("observation_count", "row_version_count", "material_signature_count")
    ends = (F.col("ambiguous_capacity_min_kw").alias("low"), F.col("ambiguous_capacity_max_kw").alias("high"))
    return table.read().select("logical_tu_key", "status", "representative_fingerprint", *counts, F.array_join("conflict_fields", ",").alias("conflict_fields"), *ends)


_ARRIVAL = "CASE WHEN event_id % 11 = 5 THEN 3 WHEN event_id % 7 = 3 THEN least(3, part + 1) ELSE part END"


@query(
    f"""WITH e AS (SELECT *, 1 + (3 * event_id) // (SELECT max(event_id) + 1 FROM events) AS part FROM events), a AS (SELECT *, {_ARRIVAL} AS batch, date_trunc('hour', ts) AS start FROM e),
    marks AS (SELECT batch + 2 AS batch, max(epoch_ms(ts)) OVER (ORDER BY batch) - 12 * 3600000 AS mark FROM (SELECT batch, max(ts) AS ts FROM a GROUP BY batch))
    SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type AS kind, count(*) AS rows, CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS total FROM a LEFT JOIN marks USING (batch)
    WHERE epoch_ms(start) + 3600000 > coalesce(mark, 0) AND epoch_ms(start) + 3600000 <= (SELECT max(epoch_ms(ts)) FROM events) - 12 * 3600000 GROUP BY 1, 2""",
    records=False,
)
def event_windows(spark, d):
    """Hours by kind of event, with a watermark of 12 hours, in append mode.

    The events come in three batches; some come a batch late, some in the last one. A batch
    leaves out rows of hours that the batch before it has given out, which is as far as
    the batches before that one have moved the watermark.
    """
    events = adapter.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    last = events.agg((F.max("event_id") + 1).alias("_n"))  # one row
    e = events.crossJoin(F.broadcast(last)).withColumn("part", F.expr("1 + (3 * event_id) div _n")).withColumn("batch", F.expr(_ARRIVAL)).drop("_n")
    stream = arrivals(spark, [e.where(F.col("batch") == b) for b in (1, 2, 3)], "events")
    found = updates.event_windows(stream, "ts", F.col("event_type"), F.col("value"), "1 hour", "12 hours")
    out = _folder(spark, "windows")
    done = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(spark, "mark")).outputMode("append").trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.schema(found.schema).parquet(out).select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "kind", "rows", "total")


PAGE_ROWS = 25
BLOCK = 64  # pages of a registry in one file


def page_files(rows: DataFrame) -> str:
    """A folder of the registry's pages: their rows of the pages table in HTML, a line each behind their number, BLOCK of them in a file.

    A page_id that is missing leaves an empty row, so that the others keep their places.
    """
    row = F.concat(*(F.coalesce(x, F.lit("")) for x in (
        F.lit("<tr><td>P"), F.col("page_id").cast("string"), F.lit("</td><td>ТП №"), F.col("page_id").cast("string"), F.lit("</td><td>"), F.concat(F.col("size").cast("string"), F.lit(",5")), F.lit("</td></tr>"),
    )))
    number = F.floor(F.col("page_id") / PAGE_ROWS).cast("bigint") + 1
    found = rows.groupBy(number.alias("n")).agg(F.collect_list(F.struct((F.col("page_id") % PAGE_ROWS).alias("k"), row.alias("row"))).alias("rows"))  # PAGE_ROWS rows
    places = F.transform(F.sequence(F.lit(0), F.lit(PAGE_ROWS - 1)), lambda k: F.filter("rows", lambda r: r["k"] == k)["row"])
    lines = F.concat(F.col("n").cast("string"), F.lit("\t"), F.array_join(F.transform(places, lambda p: F.when(F.size(p) > 0, F.array_join(p, "")).otherwise("<tr></tr>")), ""))
    folder = _folder(rows.sparkSession, "pages")
    found.select(F.floor(F.col("n") / BLOCK).cast("bigint").alias("block"), lines.alias("line")).repartition("block").write.partitionBy("block").text(folder)
    return folder


@contextlib.contextmanager
def served_pages(spark: SparkSession, rows: DataFrame, last: list[int]) -> Iterator[tuple[str, dict[int, int]]]:
    """A registry on the driver that answers a page with PAGE_ROWS rows of the pages table; its address and its requests by page.

    It reads its answers from files that are written before, and needs no task for
    them: those that ask may hold all cores until they are answered.
    """
    asked: dict[int, int] = {}
    heads = ("Номер ТУ", "Точка забезпечення потужності", "Потужність замовлена до приєднання")
    folder = page_files(rows)
    files = Files(spark, folder)

    @functools.lru_cache(maxsize=8)
    def block(k: int) -> dict[int, str]:
        names = [n for n, _ in files.names(f"{folder}/block={k}") if n.startswith("part-")]
        lines = [line.split("\t", 1) for n in names for line in files.read(f"{folder}/block={k}/{n}").splitlines()]
        return {int(n): cells for n, cells in lines}

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            n = int(parse_qs(urlsplit(self.path).query)["page"][0])
            asked[n] = asked.get(n, 0) + 1
            cells = block(n // BLOCK).get(n, "")
            body = f"<table><tr>{''.join(f'<th>{h}</th>' for h in heads)}</tr>{cells}</table><a href='?page={last[0]}'>last</a>".encode()
            self.send_response(200)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args) -> None:
            pass

    host = spark.conf.get("spark.driver.host")
    server = http.server.ThreadingHTTPServer((host, 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        yield f"http://{host}:{server.server_port}/list?kind=1", asked
    finally:
        server.shutdown()


@query(
    f"""SELECT CAST(page_id // {PAGE_ROWS} + 1 AS INTEGER) AS source_page, CAST(page_id % {PAGE_ROWS} + 1 AS INTEGER) AS source_row_index, 'P' || page_id AS tu_number, 'TP-' || page_id AS canonical_node_id,
    length(url) + 0.5::DOUBLE AS requested_power_kw, CAST(CASE WHEN page_id // {PAGE_ROWS} + 1 = 1 THEN 3 ELSE 1 END AS INTEGER) AS requests FROM pages""",
    records=False,
)
def page_stream(spark, d):
    """A registry is scanned twice, by one checkpoint; when the scan starts again, it has twice the pages.

    Each page is fetched once, and the first one besides at each start, for its links.
    """
    from gridlode.operators.points import parse_points

    rows = adapter.table(spark, d, "pages").select("page_id", F.length("url").alias("size"))
    whole = (rows.agg(F.max("page_id")).first()[0] or 0) // PAGE_ROWS + 1
    out, mark, last = _folder(spark, "records"), _folder(spark, "mark"), [0]
    with served_pages(spark, rows, last) as (url, asked):
        for last[0] in (max(1, whole // 2), whole):
            found = html.table_records(pages.scan_stream(spark, url), "reg")
            # a batch that runs again replaces its own folder
            write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
            found.writeStream.foreachBatch(write).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
        requests = spark.createDataFrame(sorted(asked.items()), "page int, requests int")
    records = spark.read.schema(RAW).parquet(f"{out}/batch=*")
    parsed = parse_points(records).join(F.broadcast(requests), F.col("source_page") == F.col("page"))  # a row a page of PAGE_ROWS records
    return parsed.select("source_page", "source_row_index", "tu_number", "canonical_node_id", "requested_power_kw", "requests")
