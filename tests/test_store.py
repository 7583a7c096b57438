"""Bucketed tables, their versions and writers, constraints held at the write, and the catalogue's tables."""

import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F

from gridlode.functions.schemas import RAW
from gridlode.plans import update
from gridlode.sources import buckets, export, files, store
from gridlode.sources.buckets import CommitConflict, Table
from gridlode.sources.store import Store, create_tables


def rows(spark, *values):
    return spark.createDataFrame(values, "id long, v string")


def content(df):
    return {r["id"]: r["v"] for r in df.collect()}


def folders(table):
    return {f"{w}/{n}" for w, _ in table.files.names(f"{table.path}/data") for n, _ in table.files.names(f"{table.path}/data/{w}") if n.startswith("_bucket")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    assert table.read() is None and table.upsert(spark.range(500).select("id", F.lit("a").alias("v")), ["id"]) == 500
    first, old = table.manifest(), table.read()
    before = folders(table)
    assert table.upsert(rows(spark, (3, "b"), (900, "c")), ["id"]) == 2
    now = table.manifest()
    assert len(now.written()) <= 2 and len(folders(table) - before) == len(now.written()) and now.number == first.number + 1
    assert all(now.folders[b] == first.folders[b] for b in first.folders if b not in now.written())
    assert len(content(table.read())) == 501 and content(table.read())[3] == "b" and sum(now.rows.values()) == 501
    assert content(old)[3] == "a" and content(table.read(first.number))[3] == "a"  # a reader of the version before
    assert table.read(buckets=now.written()[:1]).count() == now.rows[now.written()[0]]


def test_versions_go_when_they_have_been_out_of_use_for_long(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    for v in "abc":
        table.upsert(rows(spark, *((n, v) for n in range(40 if v == "a" else 2))), ["id"])
    assert [m.number for m in table.history()] == [1, 2, 3]
    table.vacuum()
    assert len(table.history()) == 3  # the time isn't up
    table.vacuum(-1.0)
    found = table.history()
    assert [m.number for m in found] == [3] and folders(table) == set(found[0].folders.values()) and len(content(table.read())) == 40


def test_more_rows_get_more_buckets(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), rows_per_bucket=10, fewest=2)
    sizes = []
    for n in (15, 100, 101):
        table.upsert(spark.range(n).select("id", F.lit(str(n)).alias("v")), ["id"])
        sizes.append(table.manifest().buckets)
        assert table.read().count() == n
    assert sizes == [2, 16, 32] and set(content(table.read()).values()) == {"101"}


def test_empty_upserts_null_keys_and_rules(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    assert table.upsert(rows(spark).limit(0), ["id"]) == 0 and table.read().count() == 0
    table.upsert(rows(spark, (1, "x"), (2, None)), ["id"], {"v": "coalesce"})
    table.upsert(rows(spark, (1, None), (2, "y")), ["id"], {"v": "coalesce"})
    assert content(table.read()) == {1: "x", 2: "y"} and table.upsert(rows(spark).limit(0), ["id"]) == 0 and len(content(table.read())) == 2


def test_the_second_of_two_writers_fails(spark, tmp_path):
    one, two = (Table(spark, str(tmp_path / "t")) for _ in range(2))
    one.upsert(rows(spark, (1, "a")), ["id"])
    seen = two.manifest()
    one.upsert(rows(spark, (1, "b")), ["id"])
    with pytest.raises(CommitConflict):
        two._commit(seen, buckets.Manifest(0, "w", 0.0, seen.schema, ["id"], 16))
    one.files.create(f"{one.path}/commits/{one.manifest().number + 1:012d}", "")  # a writer that has got no further
    assert content(two.read()) == {1: "b"}
    two.upsert(rows(spark, (1, "c")), ["id"])
    assert content(one.read()) == {1: "c"}


def test_a_failed_write_leaves_the_version(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.upsert(rows(spark, (1, "a")), ["id"])
    with pytest.raises(Exception, match="no such row"):
        table.upsert(rows(spark, (1, "b")).withColumn("v", F.raise_error(F.lit("no such row")).cast("string")), ["id"])
    assert content(table.read()) == {1: "a"} and table.files.names(f"{table.path}/staged") == []


def record(n=1, **changes):
    base = dict(source="s", source_url="u", source_page=n, source_row_index=1, fetched_at=datetime.datetime(2026, 8, 30), tu_number=str(n), tu_date="2026-08-30", installation_type="генерація", connection_point_raw="ТП №55", voltage_raw="10", requested_power_kw=5.0, connection_type="c", rem="r", contract_number=None, contract_date=None, commissioning_stages=None, payment_date=None) | changes
    return [base[c.split()[0]] for c in RAW.split(", ")]


DAY = datetime.date(2026, 8, 31)


def test_a_row_that_breaks_a_constraint_ends_the_run(spark, tmp_path):
    kept = Store(spark, str(tmp_path / "store"))
    update.run_update(spark, spark.createDataFrame([record(1), record(2)], RAW), kept, "reg", DAY)
    version = kept.table("tu_row_versions").manifest().number
    with pytest.raises(Exception, match="source_url is missing"):
        update.run_update(spark, spark.createDataFrame([record(3, source_url=None)], RAW), kept, "reg", DAY)
    assert [r["status"] for r in kept.runs().orderBy("id").collect()] == ["success", "failed"]
    assert kept.table("tu_raw").manifest().number == 1 and kept.read("tu_raw").count() == 2 and kept.table("tu_row_versions").manifest().number == version + 1
    assert kept.read_runs("tu_observations").count() == 2  # what the failed run has left is not seen


@pytest.mark.parametrize(
    ("changes", "name"),
    [({"status": "lost"}, "status"), ({"observation_count": 0}, "counts"), ({"ambiguous_capacity_min_kw": 2.0, "ambiguous_capacity_max_kw": 1.0}, "range"), ({"representative_fingerprint": None}, "representative"), ({"representative_fingerprint": "x"}, "representative_fingerprint names no row"), ({"logical_tu_key": None}, "logical_tu_key is missing")],
)
def test_each_check_is_held(spark, changes, name):
    good = dict(logical_tu_key="k", status="canonical", representative_fingerprint="f", observation_count=1, row_version_count=1, material_signature_count=1, conflict_fields=[], ambiguous_capacity_min_kw=None, ambiguous_capacity_max_kw=None)
    schema = store.TABLES["tu_snapshot_resolution"][0].removesuffix(", run_id long")
    frame = lambda r: spark.createDataFrame([[r[c.split()[0]] for c in schema.split(", ")]], schema)
    parents = {"representative_fingerprint": spark.createDataFrame([("f",)], "row_fingerprint string")}
    assert store.held("tu_snapshot_resolution", frame(good), parents).count() == 1
    assert store.held("tu_snapshot_resolution", frame(good), parents).collect()[0].asDict() == good
    with pytest.raises(Exception, match=f"{name} in the row of"):
        store.held("tu_snapshot_resolution", frame(good | changes), parents).collect()


def test_a_run_must_be_in_the_log(spark, tmp_path):
    kept = Store(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError):
        kept.write_run("tu_observations", 7, spark.createDataFrame([], store.TABLES["tu_observations"][0]))


def test_a_run_s_part_is_replaced_whole(spark, tmp_path):
    kept = Store(spark, str(tmp_path / "store"))
    assert kept.write_run("staged", 1, rows(spark, (1, "a")), n=F.count("*")) == {"n": 1}
    with pytest.raises(Exception, match="half"):
        kept.write_run("staged", 1, rows(spark, (1, "b")).withColumn("v", F.raise_error(F.lit("half")).cast("string")))
    assert content(kept.read_run("staged", 1)) == {1: "a"}
    kept.write_run("staged", 1, rows(spark, (2, "c")))
    assert content(kept.read_run("staged", 1)) == {2: "c"} and [n for n, _ in kept.files.names(f"{kept.path}/staged")] == ["run_id=1"]


def test_scratch_tables_go_with_their_run(spark, tmp_path):
    made = []
    with files.erased_after(spark):
        made.append(files.written(rows(spark, (1, "a"))).inputFiles()[0])
        with files.erased_after(spark):
            made.append(files.written(rows(spark, (1, "a"))).inputFiles()[0])
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        there = lambda p: path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path(p))
        assert there(made[0]) and not there(made[1])
    assert not there(made[0])


def test_current_metrics_read_the_latest_runs_alone(spark, tmp_path):
    kept = Store(spark, str(tmp_path / "store"))
    for n in (1, 2):
        update.run_update(spark, spark.createDataFrame([record(k) for k in range(n)], RAW), kept, "reg", DAY)
    kept.finish_run(kept.start_run("reg"), "failed", {}, "x")
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        assert create_tables(spark, kept.path, name) == create_tables(spark, kept.path, name) == [*store.TABLES, store.VIEW]
        found = spark.table(f"{name}.{store.VIEW}")
        assert {r["run_id"] for r in found.collect()} == {2}
        plan = found._jdf.queryExecution().executedPlan()
        scans = [s for s in plan.toString().split("\n") if "dynamicpruning" in s]
        assert scans and "run_id" in scans[0]
        found.collect()
        leaves = plan.collectLeaves()
        sizes = [leaves.apply(k).metrics().get("numPartitions").get().value() for k in range(leaves.size()) if leaves.apply(k).metrics().contains("numPartitions") and "run_id" in leaves.apply(k).toString()]
        assert sizes in ([], [1])  # of two runs' folders
        assert spark.table(f"{name}.tu_parsed").count() == kept.read("tu_parsed").count() and spark.table(f"{name}.node_metrics").count() == 1
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_lists_and_cells_of_distributed_files(spark, tmp_path):
    df = spark.range(40).select("id", F.array(F.lit('a"b'), F.lit(None)).alias("t"), F.array(F.col("id") * 0.5).alias("x"), F.struct("id").alias("s")).repartition(3)
    export.json_lists(df, str(tmp_path / "l"))
    found = [json.loads(f.read_text()) for f in (tmp_path / "l").glob("part-*")]
    assert len(found) >= 3 and sorted(r["id"] for f in found for r in f) == list(range(40)) and found[0][0]["t"] == ['a"b', None]
    export.json_lists(df.limit(0), str(tmp_path / "e"))
    assert [f.read_text() for f in (tmp_path / "e").glob("part-*")] in ([""], ["[]\n"])  # no rows, no task
    export.csv_folder(df.where("id = 3"), str(tmp_path / "c"))
    row = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).first()
    assert (row["t"], row["x"], row["s"]) == ('["a\\"b", null]', "[1.5]", '{"id":3}')


def test_first_of_points_keeps_the_best_records(spark):
    """Ties go by page, row and fingerprint, and few rows are left to be parsed and dealt out."""
    from gridlode.operators.identity import order, with_identities
    from gridlode.operators.points import parse_records
    from gridlode.sources import store

    made = [record(n % 7, source_page=n % 3, connection_point_raw=("ТП №55", "ТП 55", "РП №6 Північ КТП-5", None)[n % 4], voltage_raw=(None, "10", "35")[n % 3], rem=f"{n % 5}") for n in range(60)]
    ided = with_identities(spark.createDataFrame(made, RAW))
    first = store.first_of_points(ided, order())
    best = lambda rows: sorted(map(str, store.best_by_node(parse_records(rows), order()).select("canonical_node_id", "record_key", "confidence", "row_fingerprint", "source_page").collect()))
    assert first.count() == 12 and best(first) == best(ided) != []
