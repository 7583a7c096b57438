"""Snapshots, metrics, integrity, quality, storage and the update as a whole."""

import datetime

import pytest
from pyspark.sql import functions as F

from gridlode.functions.schemas import RAW
from gridlode.operators import ambiguity, integrity, metrics, snapshot
from gridlode.operators.identity import with_identities
from gridlode.plans import update
from gridlode.sources import html
from gridlode.sources.store import Store, current_view, violations

DAY = datetime.datetime(2026, 8, 31)
BASE = {"source": "reg", "source_url": "u", "source_page": 1, "source_row_index": 1, "fetched_at": DAY, "tu_number": "ТУ 123", "tu_date": "2026-08-30", "installation_type": "генерація", "connection_point_raw": "РУ-10 кВ ПС 35/10 кВ №201 Чишки", "voltage_raw": "10", "requested_power_kw": 1000.0, "connection_type": "нестандартне", "rem": "ЛМЕМ", "contract_number": "D-1", "contract_date": "2026-08-20", "commissioning_stages": "2026", "payment_date": "2026-08-21"}
FIELDS = [c.split()[0] for c in RAW.split(", ")]


def raw(spark, *changes):
    return spark.createDataFrame([[(BASE | c)[f] for f in FIELDS] for c in changes], RAW)


def resolved(spark, *changes):
    return snapshot.resolve(with_identities(raw(spark, *changes))).collect()[0]


def test_metadata_collapses(spark):
    r = resolved(spark, {}, {"payment_date": "2026-09-01", "rem": "X", "source_row_index": 2})
    assert (r["status"], r["observation_count"], r["row_version_count"], r["material_signature_count"], r["conflict_fields"]) == ("canonical", 2, 2, 1, [])


def test_power_conflict(spark):
    r = resolved(spark, {}, {"requested_power_kw": 1500.0})
    assert (r["status"], r["conflict_fields"], r["ambiguous_capacity_min_kw"], r["ambiguous_capacity_max_kw"]) == ("ambiguous", ["requested_power_kw"], 1000.0, 1500.0)


def test_unknown_range_and_null_as_a_value(spark):
    r = resolved(spark, {"requested_power_kw": None}, {"requested_power_kw": None, "voltage_raw": "6"})
    assert (r["status"], r["conflict_fields"], r["ambiguous_capacity_min_kw"]) == ("ambiguous", ["voltage_raw"], None)
    assert resolved(spark, {}, {"voltage_raw": None})["conflict_fields"] == ["voltage_raw"]


def test_order_of_rows_changes_nothing(spark):
    rows = [{}, {"rem": "B", "source_row_index": 2}, {"rem": "C", "source_row_index": 3}]
    assert resolved(spark, *rows) == resolved(spark, *reversed(rows))


def test_ambiguity_by_node(spark):
    ided = with_identities(raw(spark, {}, {"requested_power_kw": 1500.0}, {"tu_number": "2"}, {"tu_number": "2", "connection_point_raw": "ТП №5"}))
    res = snapshot.resolve(ided)
    found = ambiguity.attributed(snapshot.ambiguous_variants(ided, res), res)
    assert [tuple(r) for r in ambiguity.by_node(found).collect()] == [("PS-201-CHYSHKY", 1, 1.0, 1.5)]
    assert tuple(ambiguity.unassigned(found).first()) == (1, 1.0, 1.0)


def parsed(spark, *rows):
    cols = "canonical_node_id string, activity_type string, requested_power_kw double, tu_date string, fetched_at timestamp, confidence double, needs_review boolean"
    return spark.createDataFrame([(n, a, p, d, DAY, c, r) for n, a, p, d, c, r in rows], cols)


def test_windows_are_inclusive_calendar_months(spark):
    rows = [("N", "generation", p, d, 1.0, False) for p, d in ((1000.0, "2026-08-30"), (2000.0, "2026-05-30"), (4000.0, "2026-05-29"))]
    rows += [("N", "consumption", 500.0, "2026-02-28", 1.0, False), ("N", "bess", 300.0, "2025-08-30", 1.0, False), ("N", "bess", 700.0, "2025-08-29", 1.0, False)]
    n = metrics.aggregate_nodes(parsed(spark, *rows), datetime.date(2026, 8, 30)).collect()[0]
    assert (n["generation_3m_mw"], n["generation_6m_mw"], n["load_6m_mw"], n["bess_12m_mw"], n["bess_mw"]) == (3.0, 7.0, 0.5, 0.3, 1.0)


def test_pressure(spark):
    rows = [("LOW", "generation", 100.0, "2025-01-01", 0.9, True), ("MID", "generation", 1000.0, "2026-07-01", 0.9, False), ("HIGH", "generation", 4000.0, "2026-07-01", 0.9, False), ("HIGH", "generation", 4000.0, "2026-08-01", 0.9, False), (None, "generation", 1.0, "x", 0.5, True)]
    df = parsed(spark, *rows)
    n = {r["canonical_node_id"]: r for r in metrics.aggregate_nodes(df, datetime.date(2026, 8, 30)).collect()}
    assert n["LOW"]["generation_pressure"] == 0 and 0 < n["MID"]["generation_pressure"] < 100 and n["HIGH"]["generation_pressure"] == 100
    assert n["HIGH"]["generation_tu_velocity_3m_per_month"] == pytest.approx(2 / 3) and n["LOW"]["review_count"] == 1
    assert tuple(metrics.stats(df).first()) == (5, 4, 1, 1)


def test_mid_rank_against_the_formula(spark):
    values = [0.0, 0.0, 1.0, 2.0, 2.0, 2.0, 5.0, 7.5, 7.5] * 11
    df = spark.createDataFrame([(str(n), v) for n, v in enumerate(values)], "canonical_node_id string, v double")
    for r in metrics.mid_rank(df, {"v": "p"}).collect():
        less, equal = sum(x < r["v"] for x in values), values.count(r["v"])
        assert r["p"] == pytest.approx(0 if r["v"] <= 0 else 100 * (less + (equal - 1) / 2) / (len(values) - 1))


def test_audit(spark):
    ided = with_identities(raw(spark, {}, {}, {"contract_date": "x"}, {"tu_number": "other"}))
    a = integrity.audit(ided).first()
    assert (a["fetched_rows"], a["legacy_unique_records"], a["legacy_collision_loss"], a["unique_row_versions"], a["unique_logical_tus"], a["duplicate_observations"], a["logical_tus_with_multiple_versions"]) == (4, 2, 2, 3, 2, 1, 1)
    g = integrity.collision_groups(ided).collect()[0]
    assert (g["observation_count"], g["distinct_row_versions"], g["differing_fields"]) == (3, 2, ["contract_date"])


PAGE = """<table><thead><tr><th>Номер ТУ</th><th>Дата Видачі ТУ</th><th>Потужність замовлена до приєднання</th></tr></thead>
<tbody><tr><td>ТУ&nbsp;1</td><td>03-06-2026 12:06:00</td><td>3000,5</td></tr><tr></tr><tr><td>svc</td><th>ТУ 2</th><td>х</td><td>Дані відсутні</td></tr></tbody></table>"""


def test_html_table(spark):
    pages = spark.createDataFrame([(PAGE, "u", 3, DAY), ("<p>none</p>", "u", 4, DAY), (None, "u", 5, DAY)], "html string, source_url string, source_page int, fetched_at timestamp")
    a, b = html.table_records(pages, "reg").orderBy("source_row_index").collect()
    assert (a["tu_number"], a["tu_date"], a["requested_power_kw"], a["source_row_index"], a["rem"]) == ("ТУ 1", "2026-06-03", 3000.5, 1, None)
    assert (b["tu_number"], b["tu_date"], b["requested_power_kw"], b["source_row_index"]) == ("ТУ 2", "х", None, 3)


def test_page_addresses(spark):
    assert html.page_url("http://h/x?a=&page=1&b=2#f", 7) == "http://h/x?a=&page=7&b=2#f"
    df = spark.createDataFrame([('<a href="?page=12">x</a><a href="/">15</a>',), ("",)], "h string")
    assert [r[0] for r in df.select(html.last_page(F.col("h"), 2)).collect()] == [15, 2]


def test_update_is_idempotent_and_failures_stay_hidden(spark, tmp_path):
    store, day = Store(spark, str(tmp_path / "s")), datetime.date(2026, 8, 30)
    rows = raw(spark, {}, {"source_row_index": 2, "payment_date": "z"}, {"source_row_index": 3, "tu_number": "9"}, {"source_row_index": 4, "tu_number": "9", "requested_power_kw": 5.0})
    one = update.run_update(spark, rows, store, "reg", day)
    assert (one.raw_count, one.observation_count, one.row_version_count, one.canonical_count, one.ambiguous_count, one.metadata_collapsed_count) == (4, 4, 4, 1, 1, 1)
    two = update.run_update(spark, rows, store, "reg", day)
    assert store.read("tu_row_versions").count() == 4 and store.read_runs("tu_observations").count() == 8 and two.run_id == 2
    bad = rows.withColumn("tu_date", F.expr("raise_error('no')").cast("string"))
    with pytest.raises(Exception):
        update.run_update(spark, bad, store, "reg", day)
    assert [r["status"] for r in store.runs().orderBy("id").collect()] == ["success", "success", "failed"]
    view = current_view(store.read_runs("node_metrics_v2"), store.runs())
    assert {r["run_id"] for r in view.collect()} == {2}
    assert violations(store.read_run("tu_snapshot_resolution", 2), store.runs()).count() == 0
    text = update.reports(store, two)
    assert "INTEGRITY fetched=4" in text and "CANONICAL run_id=2 canonical=1 ambiguous=1" in text and "QUALITY_V2 total=1" in text


def test_finish_takes_two_states_only(spark, tmp_path):
    with pytest.raises(ValueError):
        Store(spark, str(tmp_path / "x")).finish_run(1, "done", {})


def test_settled_records_equal_the_snapshot(spark):
    """One exchange gives what versions, resolution, variants and canonical records give together."""
    import random

    from gridlode.operators.points import parse_records
    from tests.test_store import record

    rng = random.Random(5)
    made = [
        record(n, tu_number=rng.choice([None, "", f"{n % 19}"]), requested_power_kw=rng.choice([None, 0.0, 5.0]), voltage_raw=rng.choice([None, "10"]), rem=rng.choice(["a", "b"]), connection_point_raw=rng.choice(["ТП №55", "ТП 55", "ТП №56", None]))
        for n in range(80)
    ]
    ided = with_identities(spark.createDataFrame(made, RAW))
    snap = snapshot.Snapshot(ided)
    got = snapshot.settled(parse_records(spark.createDataFrame(made, RAW)))
    rows = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert rows(got.select("logical_tu_key", "status", "row_fingerprint")) == rows(snap.resolved.select("logical_tu_key", "status", "representative_fingerprint"))
    fields = ("logical_tu_key", "row_fingerprint", "canonical_node_id", "activity_type", "confidence", "needs_review", "tu_date", "requested_power_kw")
    assert rows(got.where("status = 'canonical'").select(*fields)) == rows(snap.canonical().select(*fields))
    want = ambiguity.attributed(snap.variants(), snap.resolved)
    assert rows(ambiguity.of_settled(got)) == rows(want.select("canonical_node_id", "min_mw", "max_mw")) and want.count() > 5


def test_observations_are_dealt_out_once(spark):
    from gridlode.plans import adapter

    records = adapter.records(spark, "/root/testdata/sf0.001")
    for found in (snapshot.resolve(with_identities(records)), snapshot.settled(records)):
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
