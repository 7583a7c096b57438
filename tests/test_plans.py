"""Shapes of plans: how often the headline queries deal rows out, and what their scans read."""

import re

import pytest

from gridlode.plans import catalogue

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "most"), [("metrics_with_ambiguity", 8), ("snapshot_resolution", 3), ("node_metrics", 4), ("node_pressure", 8), ("parse_point", 2), ("record_key", 0), ("integrity_audit", 4)])
def test_exchanges(spark, name, most):
    assert len(re.findall(r"Exchange hashpartitioning", plan(spark, name))) <= most


def test_scans_are_narrow(spark):
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(spark, "material_distinct"))
    assert read and all("l_extendedprice" not in r and "l_discount" not in r for r in read)


def test_pages_are_parsed_on_all_cores(spark):
    """Orders are one small file, but each of its pages costs a parser's run."""
    assert "RoundRobinPartitioning(4)" in plan(spark, "html_table_rows")


def test_no_cross_join_of_tables(spark):
    for name in ("metrics_with_ambiguity", "node_pressure", "flag_counts"):
        assert "CartesianProduct" not in plan(spark, name)


@pytest.mark.parametrize("name", ["node_pressure", "node_pressure_by_customer"])
def test_ends_of_ranges_are_computed_once(spark, name):
    """Approximate quantiles depend on the order in which parts arrive: evaluated again, they are others."""
    assert "percentile_approx" not in plan(spark, name)


@pytest.mark.parametrize("name", ["integrity_audit", "quality_summary", "flag_counts", "quick_wins"])
def test_one_scan_for_a_report_s_sections(spark, name):
    """Each section, and the audit, reads its records once; what parse_records() has written is no scan of the source."""
    assert plan(spark, name).count("FileScan parquet [l_") == 1


def test_a_report_reads_its_rows_twice(spark, tmp_path, monkeypatch):
    """Once for all counts, once for the examples."""
    from gridlode.operators import quality
    from gridlode.plans import adapter

    adapter.parsed(spark, SF).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans(quality.profiles(rows)) == 1 and scans(quality.examples(rows)) == 1
    found = quality.report(rows)
    assert found["summary"]["total_records"] == rows.count()
    counted = quality.profiles(rows)
    for section in (quality.summary, quality.confidence_buckets, quality.flag_counts, quality.quick_wins, quality.family_counts, quality.pattern_counts):
        assert [r.asDict() for r in section(rows).collect()] == [r.asDict() for r in section(counted).collect()]
