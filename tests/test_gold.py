from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.operators import gold
from riskmart.plans import jobs
from riskmart.session import file_system, scratch_path, shared_folder
from riskmart.sources import adapters, store
from tests.rows import frame, values

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)
SF = "/root/testdata/sf0.001"


def tables(spark):
    clicks = frame(
        spark,
        "fe_1 float, Customer_ID string, snapshot_date date",
        (1.0, "both", D1), (2.0, "both", D2), (3.0, "clicks-only", D1), (4.0, None, D1),
    )
    attributes = frame(
        spark,
        "Customer_ID string, age int, snapshot_date date",
        ("both", 30, D1), ("both", 31, D2), ("static-only", 40, D1), (None, 50, D1),
    )
    financials = frame(spark, "Customer_ID string, income float, snapshot_date date", ("both", 9.0, D1), ("fin-only", 8.0, D2))
    return clicks, attributes, financials


def test_v2_joins_every_static_snapshot(spark):
    clicks, attributes, financials = tables(spark)
    static = gold.static_features(attributes, financials)
    store_v2 = gold.feature_store_v2(clicks, static)
    columns = ("Customer_ID", "snapshot_date", "fe_1", "age", "income")
    assert values(store_v2, *columns) == sorted(
        [
            ("both", D1, 1.0, 30, 9.0), ("both", D1, 1.0, 31, None),
            ("both", D2, 2.0, 30, 9.0), ("both", D2, 2.0, 31, None),
            ("clicks-only", D1, 3.0, None, None), (None, D1, 4.0, None, None),
            ("static-only", D1, None, 40, None), (None, D1, None, 50, None),
        ],
        key=repr,
    )


def test_v2_range_equals_the_same_rows_of_the_whole(spark):
    clicks, attributes, financials = tables(spark)
    static = gold.static_features(attributes, financials)
    whole = gold.feature_store_v2(clicks, static)
    for day in (D1, D2):
        one = gold.feature_store_v2(clicks, static, day, day)
        assert values(one) == values(store.snapshot(whole, day))


def test_v2_keeps_static_rows_without_clicks_in_that_snapshot(spark):
    clicks, attributes, financials = tables(spark)
    static = gold.static_features(attributes, financials)
    only_first = gold.feature_store_v2(store.snapshot(clicks, D1), static)
    assert ("both", D2, None, 31, None) in values(only_first, "Customer_ID", "snapshot_date", "fe_1", "age", "income")


def test_v1_keeps_every_side(spark):
    found = gold.feature_store_v1(*tables(spark))
    assert found.columns == ["Customer_ID", "snapshot_date", "fe_1", "income", "age"]
    assert values(found) == sorted(
        [
            ("both", D1, 1.0, 9.0, 30), ("both", D2, 2.0, None, 31), ("clicks-only", D1, 3.0, None, None),
            (None, D1, 4.0, None, None), ("fin-only", D2, None, 8.0, None), ("static-only", D1, None, None, 40),
            (None, D1, None, None, 50),
        ],
        key=repr,
    )


def test_backfill_over_a_range_equals_single_snapshots(spark):
    sources = {name: adapters.source(spark, SF, name) for name in jobs.FEATURE_SOURCES}
    days = ["2024-01-01", "2024-01-08"]
    whole, single = scratch_path(spark, "whole"), scratch_path(spark, "single")
    counts = jobs.backfill_features(spark, sources, whole, days[0], days[-1], version=1)
    for day in days:
        jobs.backfill_features(spark, sources, single, day, day, version=1)
    a, b = (store.read_table(spark, f"{root}/gold/feature_store") for root in (whole, single))
    assert counts["gold/feature_store"] == a.count()
    assert values(a, *sorted(a.columns)) == values(b, *sorted(a.columns))


def test_rerun_of_one_snapshot_gives_the_same_store(spark):
    sources = {name: adapters.source(spark, SF, name) for name in jobs.FEATURE_SOURCES}
    root, day = scratch_path(spark, "rerun"), "2024-01-08"
    jobs.backfill_features(spark, sources, root)
    before = values(store.read_table(spark, f"{root}/gold/feature_store"))
    counts = jobs.backfill_features(spark, sources, root, day, day)
    after = store.read_table(spark, f"{root}/gold/feature_store")
    assert values(after) == before
    assert counts["gold/feature_store"] == store.snapshot(after, day).count() > 0


def _gold(spark, root):
    table = store.read_table(spark, f"{root}/gold/feature_store")
    return values(table, *sorted(table.columns))


def test_a_refresh_equals_a_backfill_and_rewrites_no_more_than_it_must(spark, monkeypatch):
    """A changed snapshot, a lost one, none; and a run that dies before gold is made up for by the next."""
    sources = {name: adapters.source(spark, SF, name) for name in jobs.FEATURE_SOURCES}
    root, whole = scratch_path(spark, "refresh"), scratch_path(spark, "whole")
    assert set(jobs.refresh_features(spark, sources, root)) == {f"{t}/{n}" for t in ("bronze", "silver") for n in sources} | {"gold/feature_store"}
    jobs.backfill_features(spark, sources, whole)
    assert _gold(spark, root) == _gold(spark, whole)
    assert jobs.refresh_features(spark, {n: df.repartition(5) for n, df in sources.items()}, root) == {}
    day = date(2024, 1, 8)
    moved = F.when((F.col("snapshot_date") == day) & (F.col("Customer_ID").cast("int") % 2 == 0), F.col("Customer_ID").cast("int") + 1_000_000)
    changed = sources | {"attributes": sources["attributes"].withColumn("Customer_ID", F.coalesce(moved.cast("string"), F.col("Customer_ID")))}
    published = store.write_snapshots

    def dies(df, path, *args, **options):
        if path.endswith("gold/feature_store"):
            raise RuntimeError("lost")
        return published(df, path, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(store, "write_snapshots", dies)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.refresh_features(spark, changed, root)
    written = jobs.refresh_features(spark, changed, root)
    assert written["bronze/attributes"] == written["silver/attributes"] == [day] and "bronze/financials" not in written
    jobs.backfill_features(spark, changed, whole)
    assert _gold(spark, root) == _gold(spark, whole)
    lost = changed | {"clickstream": changed["clickstream"].filter(F.col("snapshot_date") != day)}
    written = jobs.refresh_features(spark, lost, root)
    assert written == {"bronze/clickstream": [day], "silver/clickstream": [day], "gold/feature_store": [day]}
    jobs.backfill_features(spark, lost, whole)
    assert _gold(spark, root) == _gold(spark, whole)


def test_digests_tell_snapshots_apart(spark):
    rows = [("a", None, D1), (None, "a", D2), ("a", None, D2)]
    df = frame(spark, "x string, y string, snapshot_date date", *rows)
    one = dict(map(tuple, store.snapshot_digests(df).collect()))
    assert one == dict(map(tuple, store.snapshot_digests(df.select("y", "snapshot_date", "x").repartition(3)).collect()))
    swapped = frame(spark, "x string, y string, snapshot_date date", (None, "a", D1), *rows[1:])
    assert dict(map(tuple, store.snapshot_digests(swapped).collect()))[D1] != one[D1]


def test_open_bounds_and_no_scratch_left(spark):
    sources = {name: adapters.source(spark, SF, name) for name in jobs.FEATURE_SOURCES}
    whole, late, early = (scratch_path(spark, n) for n in ("all", "late", "early"))
    system, folder = file_system(spark, f"{shared_folder(spark)}/riskmart")

    def scratch():
        return {f.getPath().getName() for f in system.listStatus(folder)} - {r.rsplit("/", 1)[1] for r in (whole, late, early)}

    for name in ("a", "b"):
        store.write_snapshots(sources["clickstream"], scratch_path(spark, name))
    before = scratch()
    jobs.backfill_features(spark, sources, whole)
    jobs.backfill_features(spark, sources, late, start="2024-01-15", version=1)
    jobs.backfill_features(spark, sources, early, end="2024-01-08", version=1)
    assert scratch() == before
    days = [[r[0] for r in store.read_table(spark, f"{r}/gold/feature_store").select("snapshot_date").distinct().sort("snapshot_date").collect()] for r in (whole, late, early)]
    assert days[1] == [d for d in days[0] if d >= date(2024, 1, 15)] and days[2] == [d for d in days[0] if d <= date(2024, 1, 8)]
    assert days[1] and days[2]


def test_a_snapshot_that_the_source_lost_goes(spark):
    root, loans = scratch_path(spark, "lost"), adapters.source(spark, SF, "loans")
    jobs.backfill_labels(spark, loans, root)
    day = store.read_table(spark, f"{root}/gold/label_store").selectExpr("min(snapshot_date)").first()[0]
    jobs.backfill_labels(spark, loans.filter(loans.snapshot_date != day), root)
    for table in ("bronze/loans", "silver/loans", "gold/label_store"):
        assert store.snapshot(store.read_table(spark, f"{root}/{table}"), day).count() == 0
        assert store.read_table(spark, f"{root}/{table}").count() > 0


def test_label_backfill_counts(spark):
    root = scratch_path(spark, "labels")
    loans = adapters.source(spark, SF, "loans")
    counts = jobs.backfill_labels(spark, loans, root, "1998-01-01", "1998-12-01")
    assert counts["bronze/loans"] == counts["silver/loans"] == store.between(loans, "1998-01-01", "1998-12-01").count()
    labels = store.read_table(spark, f"{root}/gold/label_store")
    assert counts["gold/label_store"] == labels.count() > 0
    assert jobs.ingest_snapshot(loans, "loans", root, "1998-05-01") == store.snapshot(loans, "1998-05-01").count()
