"""Types found from values; first lines and headers; counts from footers."""

import gzip
import random
from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskmart.schemas import raw_schema
from riskmart.sources import inference, store
from riskmart.streaming.ingest import arriving_files, by_header, ingest_available
from tests.rows import frame, values

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


def types(spark, *column):
    df = spark.createDataFrame([(v,) for v in column], "c string")
    return tuple(inference.inferred_types(df).select("type", "n_values", "n_missing", "widened_by").first())


@pytest.mark.parametrize(
    ("column", "found"),
    [
        (["1", "-2", " +3 ", None, ""], ("int", 3, 2, None)),
        (["1", "2147483648", "3000000000"], ("bigint", 3, 0, "2147483648")),
        (["1", "9223372036854775808"], ("double", 2, 0, "9223372036854775808")),
        (["1", ".5", "2.", "1e5"], ("double", 4, 0, ".5")),
        (["2024-02-29", "2024-01-01"], ("date", 2, 0, None)),
        (["2023-02-29", "2024-01-01"], ("string", 2, 0, "2023-02-29")),
        (["2024-01-01", "2024-01-01 10:00:00"], ("timestamp", 2, 0, "2024-01-01 10:00:00")),
        (["1", "2024-01-01"], ("string", 2, 0, "2024-01-01")),
        (["1", "1_", "0_", "b"], ("string", 4, 0, "0_")),
        ([None, "  "], ("string", 0, 2, None)),
        ([], ("string", 0, 0, None)),
        (["1", "1\n"], ("string", 2, 0, "1\n")),
    ],
)
def test_lattice(spark, column, found):
    assert types(spark, *column) == found


def test_rungs_are_what_casts_take(spark):
    rng = random.Random(7)
    values = [f"{rng.choice(['', '+', '-'])}{'0' * rng.choice([0, 0, 15])}{rng.randrange(10 ** rng.randint(1, 21))}" for _ in range(300)]
    values += [str(s * (1 << b) + d) for s in (1, -1) for b in (31, 63) for d in (-1, 0, 1)] + ["+", "-", "1.", ".", "1e", "1E-7", "12\t", "１２", "NaN", "é"]
    values += [f"{y}-{m:02d}-{d:02d}{t}" for y in ("0000", "1900", "2000", "2023") for m in (0, 2, 4, 13) for d in (0, 28, 29, 30, 31) for t in ("", " 23:59:59", "T24:00:00", " 00:60:00.5", " 1:00:00", "T01:00:00.1234567")]
    values = list(dict.fromkeys(values))
    v = F.col("v")
    whole, day, time = v.rlike(r"^[+-]?[0-9]+\z"), r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?"
    want = (
        F.when(whole & v.try_cast("int").isNotNull(), "int")
        .when(whole & v.try_cast("bigint").isNotNull(), "bigint")
        .when(v.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"), "double")
        .when(v.rlike(rf"^{day}\z") & v.try_cast("date").isNotNull(), "date")
        .when(v.rlike(rf"^{day}{time}\z") & v.try_cast("timestamp_ntz").isNotNull(), "timestamp")
        .otherwise("string")
    )
    by_casts = {r.v: r.want for r in spark.createDataFrame([(x,) for x in values], "v string").select("v", want.alias("want")).collect()}
    found = inference.rungs(pa.array(values)).tolist()
    assert {x: inference.RUNGS[k] for x, k in zip(values, found)} == by_casts and set(found) == set(range(6))


def test_a_column_is_one_aggregate_of_few_parts(spark):
    """Values are not told apart by one expression that grows with columns and rungs."""
    df = spark.createDataFrame([tuple(str(i) for i in range(40))], [f"c{i}" for i in range(40)])
    plan = inference.inferred_types(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "RLIKE" not in plan


def test_parts_merge_in_any_order(spark):
    rows = [(str(i), f"2024-01-{1 + i % 28:02d}", "x" if i == 777 else str(i / 4)) for i in range(1000)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "a string, b string, c string").repartition(1 + 5 * seed)
        got = values(inference.inferred_types(df), "position", "column", "type", "widened_by")
        want = want or got
        assert got == want == [(1, "a", "int", None), (2, "b", "date", None), (3, "c", "string", "x")]


def test_typed_rows(spark):
    df = spark.createDataFrame([("1", "2024-01-01", ""), ("2", None, "y ")], "`a.b` string, d string, t string")
    read = inference.typed(df, inference.inferred_schema(df))
    assert [f.dataType.simpleString() for f in read.schema] == ["int", "date", "string"]
    assert {tuple(r) for r in read.collect()} == {(1, D1, None), (2, None, "y")}


def test_read_text_by_header(spark, tmp_path):
    (tmp_path / "a b%20[1].csv").write_text("﻿x,y\n1,2\n3,\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only_header.csv").write_text("y,x\n")
    (tmp_path / "_hidden.csv").write_text("q\n1\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as out:
        out.write("z,x\n" + "".join(f"{i},9\n" for i in range(30000)))
    read = store.read_text(spark, str(tmp_path))
    assert read.columns == ["x", "y", "z"]
    assert read.filter("z IS NULL").count() == 2 and read.count() == 30002
    assert values(read.filter("y = '2'"), "x", "y", "z") == [("1", "2", None)]
    assert store.read_text(spark, str(tmp_path / "empty.csv")).columns == []


def test_first_line_of_long_files(spark, tmp_path):
    (tmp_path / "long.csv").write_text("h1,h2\n" + "1,2\n" * 2_000_000)
    (tmp_path / "short.csv").write_text("h1,h2\n")
    assert values(store._first_lines(spark, [str(tmp_path)]), "line") == [("h1,h2",), ("h1,h2",)]


def test_stream_by_header(spark, tmp_path):
    arrivals, root, progress = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "progress")
    arrivals.mkdir()

    def run():
        return ingest_available(arriving_files(spark, str(arrivals)), root, progress, by_header(raw_schema("attributes")))

    (arrivals / "1.csv").write_text("Customer_ID,Age,SSN,Occupation,snapshot_date\nc1,28,1,X,2024-01-01\nc2,29,2,Y,2024-02-01\n")
    (arrivals / "2.csv").write_text("extra,snapshot_date,occupation,SSN,Age,Customer_ID\n-,2024-02-01,Z,3,30,c3\n")
    (arrivals / "3.csv").write_text("")
    assert run() == 3
    assert run() == 0
    got = values(store.read_table(spark, root), "Customer_ID", "Age", "Occupation", "snapshot_date")
    assert got == [("c1", "28", "X", D1), ("c2", "29", "Y", D2), ("c3", "30", "Z", D2)]
    (arrivals / "4.csv").write_text("Customer_ID,Age,SSN,snapshot_date\nc4,1,2,2024-02-01\n")
    with pytest.raises(Exception, match="(?i)occupation"):
        run()
    # The batch is done again once the file is right.
    (arrivals / "4.csv").write_text("Age,Customer_ID,SSN,Occupation,snapshot_date\n31,c4,4,W,2024-02-01\n")
    assert run() == 1
    assert store.read_table(spark, root).count() == 4


def test_counts_come_from_footers(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = frame(spark, "k string, n int, day date, snapshot_date date", ("a", 5, D2, D1), ("b", None, D1, D1), ("a", 7, D1, D2))
    store.write_snapshots(rows, root)
    store.write_snapshots(rows.filter(F.col("snapshot_date") == D2).withColumn("n", F.lit(9)), root)
    counts = store.stored_counts(spark, root, ["n", "day"])
    assert values(counts, "snapshot_date", "row_count", "min_n", "max_n", "min_day", "max_day") == [(D1, 2, 5, 5, D1, D2), (D2, 1, 9, 9, D1, D1)]
    assert "PushedAggregation: [COUNT(*)" in counts._jdf.queryExecution().toString()
    assert values(store.stored_counts(spark, root), "snapshot_date", "row_count") == values(
        store.snapshot_counts(store.read_table(spark, root)), "snapshot_date", "row_count"
    )
    with pytest.raises(TypeError, match="k is neither"):
        store.stored_counts(spark, root, ["k"])
    plain = str(tmp_path / "plain")
    rows.write.partitionBy("snapshot_date").parquet(plain)
    assert values(store.stored_counts(spark, plain), "snapshot_date", "row_count") == [(D1, 2), (D2, 1)]
    store.write_snapshots(rows.limit(0), root, replace=store.days(None, None))
    assert store.stored_counts(spark, root, ["n"]).collect() == []


def test_counts_of_a_column_without_values(spark, tmp_path):
    root = str(tmp_path / "t")
    store.write_snapshots(frame(spark, "n int, snapshot_date date", (None, D1)), root)
    assert values(store.stored_counts(spark, root), "snapshot_date", "row_count") == [(D1, 1)]
    with pytest.raises(Exception, match="No min/max"):
        store.stored_counts(spark, root, ["n"]).collect()
