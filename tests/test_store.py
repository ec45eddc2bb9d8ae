import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.calendar import month_spine, month_spine_of, training_windows
from riskmart.operators import bronze
from riskmart.schemas import raw_schema
from riskmart.session import scratch_path, shared_folder
from riskmart.sources import store
from riskmart.streaming.ingest import arriving, ingest_available
from tests.rows import frame, values

D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def source(spark):
    return frame(spark, "Customer_ID string, v string, snapshot_date date", ("a", "1_", D1), ("b", None, D1), ("a", "3", D2), ("c", "4", D3))


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_backfill_equals_single_snapshots(spark):
    whole, single = scratch_path(spark, "a"), scratch_path(spark, "b")
    assert bronze.ingest(source(spark), "s", whole).get["rows"] == 4
    for day, rows in ((D1, 2), (D2, 1), (D3, 1)):
        assert bronze.ingest(source(spark), "s", single, day, day).get["rows"] == rows
    a, b = (values(store.read_table(spark, f"{root}/s"), "Customer_ID", "v", "snapshot_date") for root in (whole, single))
    assert a == b == values(source(spark), "Customer_ID", "v", "snapshot_date")


def test_rerun_of_a_snapshot_leaves_the_others(spark):
    root = scratch_path(spark, "rerun")
    bronze.ingest(source(spark), "s", root)
    changed = frame(spark, "Customer_ID string, v string, snapshot_date date", ("z", "9", D1))
    for _ in range(2):
        bronze.ingest(changed, "s", root, D1, D1)
    table = store.read_table(spark, f"{root}/s")
    assert values(table, "Customer_ID", "snapshot_date") == [("a", D2), ("c", D3), ("z", D1)]


def test_a_rerun_drops_snapshots_that_the_source_lost(spark):
    root = scratch_path(spark, "emptied")
    bronze.ingest(source(spark), "s", root)
    bronze.ingest(source(spark).filter(F.col("snapshot_date") != D2), "s", root, D1, D2)
    assert values(store.read_table(spark, f"{root}/s"), "Customer_ID", "snapshot_date") == [("a", D1), ("b", D1), ("c", D3)]
    bronze.ingest(source(spark).limit(0), "s", root, start=D3)
    assert values(store.read_table(spark, f"{root}/s"), "Customer_ID", "snapshot_date") == [("a", D1), ("b", D1)]


def rows_in(spark, root):
    return values(store.read_table(spark, root), "Customer_ID", "snapshot_date")


OLD = [("a", D1), ("a", D2), ("b", D1), ("c", D3)]


def test_a_write_that_dies_leaves_the_old_version(spark, monkeypatch):
    """It dies after its files are in place, before they are published; and again while the list is written."""
    root = scratch_path(spark, "dies")
    store.write_snapshots(source(spark), root)
    new = frame(spark, "Customer_ID string, v string, snapshot_date date", ("z", "9", D1))

    def dies(*_):
        raise RuntimeError("lost")

    for step in ("publish", "_renamed"):
        with monkeypatch.context() as patch:
            patch.setattr(store, step, dies)
            with pytest.raises(RuntimeError, match="lost"):
                store.write_snapshots(new, root, replace=store.days(None, None))
        assert rows_in(spark, root) == OLD
    store.write_snapshots(new, root, replace=store.days(None, None))
    assert rows_in(spark, root) == [("z", D1)]


def test_a_reader_keeps_the_version_it_began_with(spark):
    root = scratch_path(spark, "reader")
    store.write_snapshots(source(spark), root)
    reader = store.read_table(spark, root)
    for i in range(store.KEPT_VERSIONS - 1):
        store.write_snapshots(frame(spark, "Customer_ID string, v string, snapshot_date date", (f"n{i}", "9", D1)), root, replace=store.days(None, None))
    assert values(reader, "Customer_ID", "snapshot_date") == OLD
    assert rows_in(spark, root) == [("n0", D1)]


def test_two_writers_both_count(spark, monkeypatch):
    """One publishes between the other's look at the table and its rename."""
    root = scratch_path(spark, "two")
    store.write_snapshots(source(spark), root)
    schema = "Customer_ID string, v string, snapshot_date date"
    one = store.stage(frame(spark, schema, ("x", "1", D1)), root)
    two = store.stage(frame(spark, schema, ("y", "2", D2)), root)
    renamed, interrupted = store._renamed, []

    def late(session, where, version):
        if not interrupted:
            interrupted.append(True)
            monkeypatch.setattr(store, "_renamed", renamed)
            store.publish(session, two)
        return renamed(session, where, version)

    monkeypatch.setattr(store, "_renamed", late)
    assert store.publish(spark, one) == 3
    assert rows_in(spark, root) == [("c", D3), ("x", D1), ("y", D2)]


def test_old_versions_go_and_new_columns_come(spark):
    root = scratch_path(spark, "old")
    for i in range(5):
        store.write_snapshots(frame(spark, "Customer_ID string, snapshot_date date, n int", (f"c{i}", D1, i), ("k", D2, i)), root)
    assert len(store._versions(spark, root)) == store.KEPT_VERSIONS
    folders = store._folders(spark, root, 2)
    assert len(folders) == 2 * store.KEPT_VERSIONS
    store.write_snapshots(frame(spark, "Customer_ID string, snapshot_date date, more string", ("e", D3, "x")), root)
    table = store.read_table(spark, root)
    assert set(table.columns) == {"Customer_ID", "snapshot_date", "n", "more"}
    assert values(table, "Customer_ID", "n", "more") == [("c4", 4, None), ("e", None, "x"), ("k", 4, None)]


def test_a_table_of_no_rows_can_be_read(spark):
    root = scratch_path(spark, "none")
    store.write_snapshots(source(spark).limit(0), root)
    assert store.read_table(spark, root).columns == ["Customer_ID", "v", "snapshot_date"] and rows_in(spark, root) == []


def test_range_is_closed(spark):
    assert store.between(source(spark), D2, None).count() == 2
    assert store.between(source(spark), None, D2).count() == 3
    assert store.between(source(spark), None, None).count() == 4
    assert store.between(source(spark), "2024-01-01", "2024-02-01").count() == 3
    assert store.snapshot(source(spark), D2).count() == 1


def test_date_filter_prunes_folders(spark):
    root = scratch_path(spark, "prune")
    store.write_snapshots(source(spark), root)
    plan = store.between(store.read_table(spark, root), D2, D3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_a_large_snapshot_is_written_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        rows = spark.range(400_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit(D1)).otherwise(F.lit(D2)).alias("snapshot_date"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        root = scratch_path(spark, "hot")
        store.write_snapshots(rows, root)
        files = spark.read.parquet(root).select("snapshot_date", F.input_file_name().alias("file")).distinct()
        assert all(r["count"] > 1 for r in files.groupBy("snapshot_date").count().collect())
        assert spark.read.parquet(root).count() == 400_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_formats(spark, fmt):
    root = scratch_path(spark, fmt)
    store.write_snapshots(source(spark), root, fmt=fmt)
    back = store.read_table(spark, root, fmt, source(spark).schema)
    assert values(back, "Customer_ID", "v", "snapshot_date") == values(source(spark))


def test_csv_source_has_no_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer_ID,Age,SSN,Occupation,snapshot_date\nc1,28_,007, Lawyer,2024-01-01\n")
    df = store.read_source(spark, str(tmp_path / "a.csv"), raw_schema("attributes"))
    assert values(df) == [("c1", "28_", "007", " Lawyer", D1)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer_ID,Age,SSN,Occupation,snapshot_date\nc1,28,007,Lawyer,2024-01-01\n")
    (tmp_path / "b.csv").write_text("Age,Customer_ID,extra,snapshot_date,occupation,SSN\n30,c2,x,2024-02-01,Writer,s2\n")
    (tmp_path / "empty.csv").write_text("")
    df = store.read_source(spark, str(tmp_path), raw_schema("attributes"))
    assert df.columns == raw_schema("attributes").names
    assert values(df) == [("c1", "28", "007", "Lawyer", D1), ("c2", "30", "s2", "Writer", D2)]
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("SSN,Customer_ID,Age,Occupation,snapshot_date\ns3,c3,31,Chef,2024-03-01\n")
    assert values(store.read_source(spark, f"{tmp_path}/c*", raw_schema("attributes"))) == [("c3", "31", "s3", "Chef", D3)]
    (tmp_path / "d.csv").write_text("Customer_ID,Age\nc4,3\n")
    with pytest.raises(ValueError, match="no column occupation"):
        store.read_source(spark, str(tmp_path), raw_schema("attributes"))


def test_snapshot_counts(spark):
    assert values(store.snapshot_counts(source(spark))) == [(D1, 2), (D2, 1), (D3, 1)]


def test_month_spine(spark):
    spine = month_spine(spark, "2023-01-15", "2023-04-01")
    assert [r[0] for r in spine.collect()] == [date(2023, m, 1) for m in (1, 2, 3, 4)]
    assert month_spine(spark, "2023-01-15", "2023-03-31").count() == 3
    assert [r[0] for r in month_spine_of(source(spark)).collect()] == [D1, D2, D3]


def test_training_windows(spark):
    row = spark.range(1).select(*training_windows("2024-09-01").columns()).first()
    assert tuple(row) == (date(2023, 7, 1), date(2024, 6, 30), date(2024, 7, 1), date(2024, 8, 31))
    row = spark.range(1).select(*training_windows(F.lit("2024-04-30").cast("date"), 2, 12).columns()).first()
    assert tuple(row) == (date(2023, 2, 28), date(2024, 2, 28), date(2024, 2, 29), date(2024, 4, 29))


def test_stream_reads_each_file_once(spark, tmp_path):
    arrivals, root, progress = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "progress")
    arrivals.mkdir()
    header = "Customer_ID,Age,SSN,Occupation,snapshot_date\n"

    def run():
        return ingest_available(arriving(spark, str(arrivals), raw_schema("attributes")), root, progress)

    (arrivals / "1.csv").write_text(header + "c1,28,1,X,2024-01-01\nc2,29,2,Y,2024-02-01\n")
    assert run() == 2
    (arrivals / "2.csv").write_text(header + "c3,30,3,Z,2024-02-01\n")
    assert run() == 1
    assert run() == 0
    assert values(store.read_table(spark, root), "Customer_ID", "snapshot_date") == [("c1", D1), ("c2", D2), ("c3", D2)]
    (arrivals / "3.csv").write_text("Age,Customer_ID,SSN,Occupation,snapshot_date\n30,c4,3,Z,2024-02-01\n")
    with pytest.raises(Exception, match="header"):
        run()


def test_stream_counts_every_batch_and_shares_its_table(spark, tmp_path):
    arrivals, root, progress = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "progress")
    arrivals.mkdir()
    for i in range(105):
        (arrivals / f"{i}.csv").write_text(f"Customer_ID,Age,SSN,Occupation,snapshot_date\nc{i},1,2,X,2024-01-01\n")
    stream = arriving(spark, str(arrivals), raw_schema("attributes"), maxFilesPerTrigger="1")
    assert ingest_available(stream, f"{root}/s", progress) == 105
    batch = frame(spark, "Customer_ID string, Age string, SSN string, Occupation string, snapshot_date date", ("b", "1", "2", "Y", D1))
    for _ in range(2):
        assert bronze.ingest(batch, "s", root, D1, D1).get["rows"] == 1
    assert store.read_table(spark, f"{root}/s").count() == 106
    # A batch that is run again replaces itself.
    bronze.write_load(batch, f"{root}/s", "stream-x-0")
    bronze.write_load(batch, f"{root}/s", "stream-x-0")
    assert store.read_table(spark, f"{root}/s").count() == 107
