"""Scans, sinks, the command line, the stream and exact number texts."""

import contextlib
import datetime
import http.client
import http.server
import json
import math
import random
import struct
import threading

import pytest
from pyspark.sql import functions as F

import gridlode
from gridlode import cli
from gridlode.functions import values
from gridlode.functions.schemas import PARSED, RAW
from gridlode.operators import points
from gridlode.sources import export, pages
from gridlode.sources.store import Store, create_tables
from gridlode.streaming import updates

HEAD = "<tr><th>Номер ТУ</th><th>Дата Видачі ТУ</th><th>Тип електроустановки</th><th>Точка забезпечення потужності</th><th>Напруга в точці приєднання</th><th>Потужність замовлена до приєднання</th></tr>"


def page(n, last=3):
    rows = "".join(f"<tr><td>T{n}-{k}</td><td>0{k}-06-2026 12:00:00</td><td>генерація</td><td>ПС 35/10 кВ №{n} Страдч</td><td>10</td><td>{n}00,5</td></tr>" for k in (1, 2))
    return f"<table>{HEAD}{rows}</table><a href='/list?page={last}'>last</a>"


@contextlib.contextmanager
def served(answers):
    """A registry on this machine: page number -> html, an HTTP status, or "cut"; counts requests by page."""
    seen = {}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            n = int(self.path.rsplit("page=", 1)[1])
            seen[n] = seen.get(n, 0) + 1
            answer = answers(n, seen[n])
            if isinstance(answer, int):
                self.send_error(answer)
                return
            body = answer.encode()
            self.send_response(200)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(body) + 100 * answer.startswith("cut")))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        yield f"http://127.0.0.1:{server.server_port}/list?kind=1", seen
    finally:
        server.shutdown()


@pytest.fixture(autouse=True)
def no_pause(monkeypatch):
    monkeypatch.setattr(pages, "PAUSE", 0.0)


def test_scan_finds_the_last_page_and_fetches_each_once(spark):
    with served(lambda n, k: page(n)) as (url, seen):
        got = pages.collect_pages(spark, url, "reg").orderBy("source_page", "source_row_index").collect()
    assert [r["tu_number"] for r in got] == [f"T{n}-{k}" for n in (1, 2, 3) for k in (1, 2)]
    assert got[0]["requested_power_kw"] == 100.5 and got[1]["tu_date"] == "2026-06-02" and seen == {1: 1, 2: 1, 3: 1}


def test_a_failing_page_leaves_the_records_before_it(spark):
    with served(lambda n, k: page(n, 4) if n < 3 else 503) as (url, seen):
        with pytest.raises(pages.CollectError) as e:
            pages.collect_pages(spark, url, "reg")
    assert e.value.page == 3 and {r["source_page"] for r in e.value.partial.collect()} == {1, 2} and seen[3] == pages.RETRIES + 1


def test_cut_transfers_and_client_errors_are_tried_again():
    with served(lambda n, k: ("cut", 404, page(n))[min(k, 3) - 1]) as (url, seen):
        assert "T7-1" in pages.fetch(url + "&page=7")
    assert seen == {7: 3}

    def cut(_):
        raise http.client.IncompleteRead(b"x")

    with pytest.raises(http.client.IncompleteRead):
        pages.fetch("http://x", retries=1, get=cut)


def test_a_lenient_scan_has_error_rows(spark):
    with served(lambda n, k: page(n) if n != 2 else "cut") as (url, _):
        rows = {r["source_page"]: r for r in pages.scan(spark, url, 1, 3, on_error="row").collect()}
    assert rows[2]["html"] is None and "IncompleteRead" in rows[2]["error"] and rows[3]["error"] is None


def test_command_line(spark, tmp_path, capsys):
    data, kept = tmp_path / "data", tmp_path / "store"
    with served(lambda n, k: page(n)) as (url, _):
        assert cli.main(["collect", "--base-url", url, "--output-dir", str(data)]) == 0
        assert cli.main(["update", "--base-url", url, "--store", str(kept), "--as-of", "2026-06-30"]) == 0
    out = capsys.readouterr().out
    assert "raw=6 parsed=6 nodes=6 review=0" in out and "INTEGRITY fetched=6 observations=6" in out and "QUALITY_V2 total=6" in out
    raw = json.loads((data / "raw.json").read_text())
    assert [r["tu_number"] for r in raw] == [f"T{n}-{k}" for n in (1, 2, 3) for k in (1, 2)] and raw[0]["rem"] is None
    assert (data / "parsed.csv").read_text().splitlines()[0].split(",")[:2] == ["source", "source_url"]
    assert cli.main(["aggregate", "--input", str(data / "parsed.json"), "--output", str(tmp_path / "nodes.json")]) == 0
    nodes = json.loads((tmp_path / "nodes.json").read_text())
    assert [n["canonical_node_id"] for n in nodes] == ["PS-1-STRADCH", "PS-2-STRADCH", "PS-3-STRADCH"] and nodes[0]["generation_tu_count"] == 2
    assert "as_of=2026-06-02 nodes=3" in capsys.readouterr().out
    for more, label in (([], "QUALITY"), (["--run-id", "1"], "QUALITY_V2")):
        assert cli.main(["quality", "--store", str(kept), "--output-dir", str(data), *more]) == 0
        assert f"{label} total=6 mapped=6 (100.0%)" in capsys.readouterr().out
    assert json.loads((data / "quality.json").read_text())["summary"]["total_records"] == 6 and (data / "review.csv").read_text().count("\n") == 1
    assert cli.main(["quality", "--output-dir", str(data)]) == 2
    with pytest.raises(SystemExit):
        cli.main(["aggregate", "--input", "x", "--output", "y", "--as-of", "30.06.2026"])


def test_collect_with_a_failing_page_writes_the_rest(spark, tmp_path):
    with served(lambda n, k: page(n) if n != 3 else 500) as (url, _):
        assert cli.main(["collect", "--base-url", url, "--output-dir", str(tmp_path)]) == 1
    assert len(json.loads((tmp_path / "raw.json").read_text())) == 4


def test_saved_pages(spark, tmp_path):
    for n in (1, 12):
        (tmp_path / f"page-{n}.html").write_text(page(n))
    assert {r["source_page"] for r in pages.saved_pages(spark, str(tmp_path)).collect()} == {1, 12}


@pytest.mark.parametrize("text", ['{"source": "x"}', "", "  \n 7"])
def test_json_scan_takes_a_list_only(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ValueError):
        pages.parsed_json(spark, str(tmp_path / "x.json"))


def test_json_scan_takes_objects_only(spark, tmp_path):
    (tmp_path / "x.json").write_text(' [{"source": "x", "more": 1, "fetched_at": "2026-01-02T03:04:05Z"}]')
    assert [r["fetched_at"] for r in pages.parsed_json(spark, str(tmp_path / "x.json")).collect()] == [datetime.datetime(2026, 1, 2, 3, 4, 5)]
    (tmp_path / "y.json").write_text("[1, 2]")
    with pytest.raises(Exception):
        pages.parsed_json(spark, str(tmp_path / "y.json")).collect()


def test_empty_files(spark, tmp_path):
    none = spark.createDataFrame([], "a int, b array<int>")
    export.write_json(none, str(tmp_path / "a.json"))
    export.write_csv(none, str(tmp_path / "a.csv"))
    assert json.loads((tmp_path / "a.json").read_text()) == [] and (tmp_path / "a.csv").read_text() == ""


def test_distributed_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, [1, 2])], "a int, b string, c array<int>")
    export.json_lines(rows, str(tmp_path / "j"))
    export.csv_folder(rows, str(tmp_path / "c"))
    assert [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "j")).collect()] == [{"a": 1, "b": None, "c": [1, 2]}]
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["c"] == "[1, 2]"  # as write_csv() has it


def test_stream_updates_the_store(spark, tmp_path):
    row = ["s", "u", 1, 1, datetime.datetime(2026, 8, 30), "7", "2026-08-30", "генерація", "ТП №55", "10", 5.0, "c", "r", None, None, None, None]
    source = tmp_path / "in"
    kept = Store(spark, str(tmp_path / "store"))
    for n in (1, 2):
        spark.createDataFrame([[*row[:3], n, *row[4:]]], RAW).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(RAW).parquet(str(source))
        updates.update_stream(stream, kept, "reg", str(tmp_path / "mark"), datetime.date(2026, 8, 31)).awaitTermination()
    assert [r["status"] for r in kept.runs().orderBy("id").collect()] == ["success", "success"] and kept.read_runs("tu_observations").count() == 2
    windows = updates.activity_windows(spark.readStream.schema(RAW).parquet(str(source)))
    query = windows.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("windows").collect()
    assert [(r["activity_type"], r["records"], r["power_kw"]) for r in got] == [("generation", 2, 10.0)]


# Texts of doubles as JSON writes them, and to 12 significant digits.
NUMBERS = [
    (0.0, "0.0", "0"), (-0.0, "-0.0", "-0"), (1.0, "1.0", "1"), (300.0, "300.0", "300"), (3000.5, "3000.5", "3000.5"), (-2.5, "-2.5", "-2.5"), (0.1, "0.1", "0.1"), (1e12, "1000000000000.0", "1e+12"),
    (999999999999.0, "999999999999.0", "999999999999"), (1234567.1234567, "1234567.1234567", "1234567.12346"), (1e-05, "1e-05", "1e-05"), (0.0001, "0.0001", "0.0001"), (1e16, "1e+16", "1e+16"),
    (1e15, "1000000000000000.0", "1e+15"), (123456789012345680.0, "1.2345678901234568e+17", "1.23456789012e+17"), (1 / 3, "0.3333333333333333", "0.333333333333"), (0.1 + 0.2, "0.30000000000000004", "0.3"),
    (2e-3, "0.002", "0.002"), (1.5e300, "1.5e+300", "1.5e+300"), (1e23, "1e+23", "1e+23"), (-7.25e-9, "-7.25e-09", "-7.25e-09"), (999999999999.5, "999999999999.5", "1e+12"),
]


def test_number_texts(spark):
    rows = spark.createDataFrame([(n, x) for n, (x, _, _) in enumerate(NUMBERS)] + [(-1, None)], "n int, x double")
    got = {r["n"]: (r["f"], r["g"]) for r in rows.select("n", values.float_text(F.col("x")).alias("f"), values.general_text(F.col("x")).alias("g")).collect()}
    assert got.pop(-1) == (None, None) and [got[n] for n in range(len(NUMBERS))] == [(f, g) for _, f, g in NUMBERS]


def test_twelve_digits_are_exact(spark):
    """Halves of the twelfth digit, which the binary value decides, subnormal numbers, and any bits."""
    rng = random.Random(1)
    some = [float(f"{rng.randrange(10**11, 10**12)}5e{rng.choice((rng.randrange(-335, 295), rng.randrange(-20, 10)))}") * rng.choice((1, -1)) for _ in range(3000)]
    some += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(bits)))[0] for bits in (52, 64) for _ in range(1000)] + [5e-324, 2.2250738585072014e-308, 100000000000.5, 999999999999.5, 99999999999.95]
    some = [x for x in some if math.isfinite(x)]
    got = spark.createDataFrame(list(enumerate(some)), "n int, x double").repartition(4).select("n", values.general_text(F.col("x"))).collect()
    assert [(some[n], t) for n, t in got if t != "%.12g" % some[n]] == []


def test_digits_of_other_scripts(spark):
    row = spark.createDataFrame([("ПС ٣٥/١٠ кВ №5 А", "٣,٥")], "p string, v string")
    assert points.parse_points(row, "p").first()["parent_voltage_levels_kv"] == [35.0, 10.0] and row.select(values.power(F.col("v"))).first()[0] == 3.5


def test_a_failing_parser_makes_review_records(spark):
    def broken(text):
        raise ValueError("broken source text")

    raw = spark.createDataFrame([["s", "u", 1, 1, None, "1", "2026-06-03", "споживання", "x", "6", 1.0, "c", "r", None, None, None, None]], RAW)
    r = points.parse_records_with(raw, broken).first()
    assert (r["needs_review"], r["confidence"], r["flags"], r["parse_error"], r["activity_type"]) == (True, 0.0, ["parse_error"], "broken source text", "consumption")


def test_tables_of_the_catalogue(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS ddl_test")
    for _ in range(2):
        names = create_tables(spark, str(tmp_path), "ddl_test")
    assert spark.table("ddl_test.tu_parsed").columns == ["record_key", *(c.split()[0] for c in PARSED.split(", ")), "_bucket"] and len(names) == 11
    assert all(spark.table(f"ddl_test.{n}").count() == 0 for n in names)
    spark.sql("DROP DATABASE ddl_test CASCADE")


def test_package_exports():
    assert all(getattr(gridlode, name) is not None for name in gridlode.__all__)
    with pytest.raises(AttributeError):
        gridlode.nothing


def test_iso_dates(spark):
    texts = ["2026-08-28", "20260828", "2026-W35-5", "2026W355", "2026-W35", "2020-W53-7", "2021-W53-1", "2026-W00-1", "2026-W35-8", "2026-02-30", "2026-08-28T10:00", "2026-W3-1", "0000-W01-1", "x", None, "2025-W01-1"]

    def plain(t):
        try:
            return datetime.date.fromisoformat((t or "")[:10])
        except ValueError:
            return None

    got = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").select("n", values.iso_date(F.col("t")).alias("d")).collect()
    assert [r["d"] for r in sorted(got)] == [plain(t) for t in texts]
