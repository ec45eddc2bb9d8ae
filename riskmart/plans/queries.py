"""Registered queries: every operator over the sources of a test scale factor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.calendar import month_spine_of, training_windows
from riskmart.functions import cleaning as C
from riskmart.functions import features as X
from riskmart.operators import analysis, boosting, bronze, gold, imputation, modeling, silver
from riskmart.plans import jobs
from riskmart.schemas import CUSTOMER, DIRTY_NUMBERS, LOAN, SNAPSHOT, raw_schema
from riskmart.session import cut_lineage, scratch_path
from riskmart.sources import adapters, inference, store
from riskmart.streaming import ingest as stream

Query = Callable[[SparkSession, str], DataFrame]

TRAIN_DATE = "2001-09-01"
SNAPSHOT_DATE = "2000-03-01"
FINANCIAL_DAY = "2024-01-08"
CALENDAR = ("1995-01-01", "2001-12-01")
COHORT_CUTOFF = "2000-01-01"
CLICKS = [f"fe_{i}" for i in range(1, 21)]

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _loans(spark: SparkSession, sf: str, **options: bool) -> DataFrame:
    return silver.loans(adapters.source(spark, sf, "loans"), **options)


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return gold.label_store(_loans(spark, sf))


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clickstream(adapters.source(spark, sf, "clickstream"))


def _attributes(spark: SparkSession, sf: str, **options: bool) -> DataFrame:
    return silver.attributes(adapters.source(spark, sf, "attributes"), **options)


def _numeric(spark: SparkSession, sf: str) -> DataFrame:
    return silver.financials_numeric(adapters.source(spark, sf, "financials"))


def _financials(spark: SparkSession, sf: str, **options: int) -> DataFrame:
    return silver.financials(adapters.source(spark, sf, "financials"), **options)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A table of the mart: computed once, read several times."""
    return cut_lineage(df, name)


def _training_set(spark: SparkSession, sf: str) -> DataFrame:
    return modeling.training_set(_labels(spark, sf), adapters.source(spark, sf, "monthly_features"), TRAIN_DATE)


# --- loans and labels


@query
def loan_delinquency(spark: SparkSession, sf: str) -> DataFrame:
    return _loans(spark, sf)


@query
def loan_delinquency_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _loans(spark, sf, zero_due_is_missed=True)


@query
def default_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf)


@query
def bad_rate_by_mob(spark: SparkSession, sf: str) -> DataFrame:
    rates = analysis.bad_rate_by_mob(_loans(spark, sf), started_before=COHORT_CUTOFF)
    return rates.select("mob", F.round("bad_rate", 8).alias("bad_rate"))


@query
def final_instalments(spark: SparkSession, sf: str) -> DataFrame:
    """Loans at their last instalment, here the seventh."""
    return analysis.final_instalments(_loans(spark, sf), 7).select(LOAN, CUSTOMER, SNAPSHOT, "mob", "dpd")


@query
def default_rate_over_time(spark: SparkSession, sf: str) -> DataFrame:
    rates = analysis.default_rate_over_time(_labels(spark, sf), *CALENDAR)
    return rates.select("month", F.round("default_rate", 8).alias("default_rate"))


# --- calendar and store


@query
def month_spine(spark: SparkSession, sf: str) -> DataFrame:
    return month_spine_of(adapters.source(spark, sf, "loans"))


@query
def snapshot_counts(spark: SparkSession, sf: str) -> DataFrame:
    return store.snapshot_counts(adapters.source(spark, sf, "loans"))


@query
def snapshot_extract(spark: SparkSession, sf: str) -> DataFrame:
    return store.snapshot(adapters.source(spark, sf, "loans"), SNAPSHOT_DATE).select(LOAN, CUSTOMER, SNAPSHOT, "installment_num")


@query
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = store.between(adapters.source(spark, sf, "loans"), "2000-07-01", "2001-08-31")
    return rows.select(LOAN, CUSTOMER, SNAPSHOT, "installment_num")


@query
def snapshot_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """One snapshot on its own, read back from the store."""
    root = scratch_path(spark, "snapshot")
    jobs.ingest_snapshot(adapters.source(spark, sf, "loans"), "loans", root, SNAPSHOT_DATE)
    return store.read_table(spark, f"{root}/bronze/loans").select(LOAN, CUSTOMER, SNAPSHOT, "installment_num")


@query
def bronze_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze in one pass, read back."""
    root = scratch_path(spark, "bronze")
    bronze.ingest(adapters.source(spark, sf, "loans"), "loans", root)
    return store.snapshot_counts(store.read_table(spark, f"{root}/loans"))


@query
def rerun_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """A range ingested again from a source that has lost a snapshot."""
    root, loans = scratch_path(spark, "rerun"), adapters.source(spark, sf, "loans")
    bronze.ingest(loans, "loans", root)
    bronze.ingest(loans.filter(F.col(SNAPSHOT) != SNAPSHOT_DATE), "loans", root, "2000-01-01", "2000-06-30")
    return store.snapshot_counts(store.read_table(spark, f"{root}/loans"))


@query
def unpublished_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """A table whose rewrite died after its files were written and before they were published: the old rows, whole."""
    root, loans = scratch_path(spark, "dead"), adapters.source(spark, sf, "loans")
    store.write_snapshots(loans, root)
    store.stage(loans.filter(F.col("installment_num") == 7), root, replace=store.days(None, None))
    return store.snapshot_counts(store.read_table(spark, root))


@query
def csv_source(spark: SparkSession, sf: str) -> DataFrame:
    """Text files with headers in two orders, read under the declared schema and cleaned."""
    path = scratch_path(spark, "csv")
    rows = adapters.source(spark, sf, "attributes").select("Customer_ID", "Age", "SSN", "Occupation", SNAPSHOT)
    odd = F.col("Customer_ID").cast("int") % 2 == 1
    rows.filter(odd).write.option("header", True).csv(f"{path}/a")
    rows.filter(~odd).select(SNAPSHOT, "SSN", "Age", "Customer_ID", "Occupation").write.option("header", True).csv(f"{path}/b")
    return silver.attributes(store.read_source(spark, [f"{path}/a", f"{path}/b"], raw_schema("attributes")))


def _arriving_events(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    arrivals = stream.arriving(spark, sf, schema, "parquet", pathGlobFilter="events.parquet")
    return arrivals.withColumn(SNAPSHOT, F.col("ts").cast("date"))


@query
def streamed_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Events ingested as a stream of files, read back."""
    root = scratch_path(spark, "stream")
    stream.ingest_available(_arriving_events(spark, sf), f"{root}/events", f"{root}/progress")
    return store.snapshot_counts(store.read_table(spark, f"{root}/events"))


@query
def streamed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes of customers arriving as text files with headers in two orders, one stream; cleaned when read back."""
    path = scratch_path(spark, "arriving")
    rows = adapters.source(spark, sf, "attributes")
    odd = F.col(CUSTOMER).cast("int") % 2 == 1
    orders = ((odd, rows.columns), (~odd, [SNAPSHOT, "Occupation", "Age", "SSN", CUSTOMER]))
    for part, order in orders:
        rows.filter(part).select(*order).write.mode("append").option("header", True).csv(f"{path}/in")
        arrivals = stream.arriving_files(spark, f"{path}/in", pathGlobFilter="*.csv")
        stream.ingest_available(arrivals, f"{path}/bronze", f"{path}/progress", stream.by_header(raw_schema("attributes")))
    return silver.attributes(store.read_table(spark, f"{path}/bronze"))


@query
def stored_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts and bounds of a stored table, from footers alone."""
    root = scratch_path(spark, "counted")
    bronze.ingest(adapters.source(spark, sf, "loans"), "loans", root)
    return store.stored_counts(spark, f"{root}/loans", ["loan_start_date", "installment_num"])


INFERRED = ("attributes", "financials", "loans")


@query
def inferred_types(spark: SparkSession, sf: str) -> DataFrame:
    """Types of three sources written as text files, found from their values."""
    found = []
    for name in INFERRED:
        path = scratch_path(spark, name)
        adapters.source(spark, sf, name).write.option("header", True).csv(path)
        found.append(inference.inferred_types(store.read_text(spark, path)).select(F.lit(name).alias("source"), "*"))
    return found[0].unionAll(found[1]).unionAll(found[2])


@query
def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    """Declared types of a silver table, and how much of each column is there."""
    return inference.schema_report(_numeric(spark, sf))


@query
def first_complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A look at a table: its first 25 complete rows in the order of customer and snapshot."""
    rows = adapters.source(spark, sf, "financials").select(CUSTOMER, SNAPSHOT, "Type_of_Loan", "Num_of_Delayed_Payment")
    return C.complete_rows(rows, 25, (CUSTOMER, SNAPSHOT))


@query
def mixed_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Events ingested as a stream, then a batch into the same table: both are read back."""
    root = scratch_path(spark, "mixed")
    stream.ingest_available(_arriving_events(spark, sf), f"{root}/events", f"{root}/progress")
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn(SNAPSHOT, F.col("ts").cast("date"))
    bronze.ingest(events.filter(F.col("event_type") == "view"), "events", root, "2024-01-10", "2024-01-20")
    return store.snapshot_counts(store.read_table(spark, f"{root}/events"))


@query
def feature_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze, silver and gold through the store, read back."""
    root = scratch_path(spark, "mart")
    sources = {name: adapters.source(spark, sf, name) for name in jobs.FEATURE_SOURCES}
    jobs.backfill_features(spark, sources, root)
    return store.read_table(spark, f"{root}/gold/feature_store")


@query
def changed_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """What a refresh rewrites when the financials of one snapshot have changed: table and snapshot."""
    root = scratch_path(spark, "refresh")
    sources = {name: adapters.source(spark, sf, name) for name in jobs.FEATURE_SOURCES}
    jobs.refresh_features(spark, sources, root)
    day = F.col(SNAPSHOT) == FINANCIAL_DAY
    changed = sources["financials"].withColumn("Interest_Rate", F.when(day, F.col("Interest_Rate") + 1).otherwise(F.col("Interest_Rate")))
    written = jobs.refresh_features(spark, {**sources, "financials": changed}, root)
    rows = [(table, d) for table, days in written.items() for d in days]  # one row for each table and snapshot
    return spark.createDataFrame(rows, f"table_name string, {SNAPSHOT} date")


@query
def label_backfill(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "mart")
    jobs.backfill_labels(spark, adapters.source(spark, sf, "loans"), root)
    return store.read_table(spark, f"{root}/gold/label_store")


# --- silver features


@query
def clickstream_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _clicks(spark, sf)


@query
def attributes_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _attributes(spark, sf)


@query
def attributes_silver_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _attributes(spark, sf, strip_first=True)


@query
def financials_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _financials(spark, sf)


@query
def financials_silver_v1(spark: SparkSession, sf: str) -> DataFrame:
    return _financials(spark, sf, version=1)


@query
def financials_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _numeric(spark, sf).select(CUSTOMER, SNAPSHOT, *DIRTY_NUMBERS)


@query
def median_imputation(spark: SparkSession, sf: str) -> DataFrame:
    filled = imputation.impute_median(_numeric(spark, sf), ["Changed_Credit_Limit", "Num_of_Delayed_Payment"])
    return filled.select(CUSTOMER, SNAPSHOT, "Changed_Credit_Limit", "Num_of_Delayed_Payment")


@query
def snapshot_medians(spark: SparkSession, sf: str) -> DataFrame:
    return imputation.snapshot_medians(_numeric(spark, sf), DIRTY_NUMBERS)


@query
def loan_amount_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Medians of continuous amounts, with many different values per snapshot."""
    amounts = ["loan_amt", "due_amt", "balance"]
    # Two passes read the values, so the join behind them is run once.
    return imputation.snapshot_medians(_stored(_loans(spark, sf).select(SNAPSHOT, *amounts), "amounts"), amounts)


@query
def category_whitelist(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.source(spark, sf, "financials").select(
        CUSTOMER,
        C.whitelist("Payment_Behaviour", C.PAYMENT_BEHAVIOURS).alias("Payment_Behaviour"),
        C.whitelist("Credit_Mix", C.CREDIT_MIXES).alias("Credit_Mix"),
    )


@query
def history_age_years(spark: SparkSession, sf: str) -> DataFrame:
    years = X.parse_duration_years("Credit_History_Age")
    return adapters.source(spark, sf, "financials").select(CUSTOMER, years.alias("Credit_History_Age_num"))


def _late_days(spark: SparkSession, sf: str, **options: bool) -> DataFrame:
    days = X.days_per_late_payment("Delay_from_due_date", "Num_of_Delayed_Payment", **options)
    return _numeric(spark, sf).select(CUSTOMER, days.alias("days_overdue_per_late_payment"))


@query
def late_payment_days(spark: SparkSession, sf: str) -> DataFrame:
    return _late_days(spark, sf)


@query
def late_payment_days_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _late_days(spark, sf, keep_sign=True)


@query
def late_payment_days_v1(spark: SparkSession, sf: str) -> DataFrame:
    return _late_days(spark, sf, guard=False)


@query
def income_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return _financials(spark, sf).select(
        CUSTOMER, "debt_to_income_ratio", "monthly_repayment_to_income", "credit_inquiries_per_year"
    )


def _loan_counts(spark: SparkSession, sf: str, on_null: int) -> DataFrame:
    counts = X.multi_hot_counts("Type_of_Loan", on_null=on_null)
    return adapters.source(spark, sf, "financials").select(CUSTOMER, *[c.alias(n) for n, c in counts.items()])


@query
def loan_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _loan_counts(spark, sf, -1)


@query
def loan_type_counts_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _loan_counts(spark, sf, 0)


# --- gold features


@query
def static_features(spark: SparkSession, sf: str) -> DataFrame:
    return gold.static_features(_attributes(spark, sf), _financials(spark, sf))


@query
def gold_features_v1(spark: SparkSession, sf: str) -> DataFrame:
    clicks = _stored(_clicks(spark, sf), "clickstream")
    financials = _stored(_financials(spark, sf, version=1), "financials")
    return gold.feature_store_v1(clicks, _attributes(spark, sf), financials)


@query
def gold_features_v2(spark: SparkSession, sf: str) -> DataFrame:
    static = _stored(gold.static_features(_attributes(spark, sf), _financials(spark, sf)), "static")
    return gold.feature_store_v2(_stored(_clicks(spark, sf), "clickstream"), static)


@query
def complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    return C.complete_rows(gold_features_v2(spark, sf))


# --- analyses


def _rounded(rates: DataFrame) -> DataFrame:
    return rates.withColumn("default_rate_pct", F.round("default_rate_pct", 6))


@query
def default_rate_by_dti(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(analysis.default_rate_by_dti(_numeric(spark, sf), _labels(spark, sf)))


@query
def default_rate_by_delay(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(analysis.default_rate_by_delay(_numeric(spark, sf), _labels(spark, sf)))


@query
def default_rate_by_inquiry(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(analysis.default_rate_by_inquiry(_financials(spark, sf), _labels(spark, sf)))


@query
def default_rate_by_inquiry_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(analysis.default_rate_by_inquiry(_financials(spark, sf), _labels(spark, sf), gapless=True))


@query
def default_rate_by_emi(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(analysis.default_rate_by_emi(_numeric(spark, sf), _labels(spark, sf)))


@query
def default_rate_by_emi_v1(spark: SparkSession, sf: str) -> DataFrame:
    rates = analysis.default_rate_by_emi(_numeric(spark, sf), _labels(spark, sf), X.EMI_EDGES_V1, X.EMI_BINS_V1)
    return _rounded(rates)


@query
def feature_profile(spark: SparkSession, sf: str) -> DataFrame:
    profile = analysis.feature_profile(_clicks(spark, sf), _labels(spark, sf), CLICKS)
    return profile.select("period_num", *[F.round(c, 6).alias(c) for c in ("Non-Default", "Default")])


@query
def features_with_outcome(spark: SparkSession, sf: str) -> DataFrame:
    columns = _numeric(spark, sf).select(CUSTOMER, "Annual_Income", "Outstanding_Debt")
    return analysis.with_outcome(columns, _labels(spark, sf))


@query
def features_with_first_outcome(spark: SparkSession, sf: str) -> DataFrame:
    columns = _numeric(spark, sf).select(CUSTOMER, "Annual_Income", "Outstanding_Debt")
    return analysis.with_outcome(columns, _labels(spark, sf), dedup=True)


# --- modelling


@query
def train_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """The training windows of every snapshot month as the train date."""
    days = adapters.source(spark, sf, "loans").select(SNAPSHOT).distinct()
    return days.select(SNAPSHOT, *training_windows(F.col(SNAPSHOT)).columns())


@query
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    return _training_set(spark, sf)


@query
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return modeling.split_stats(_training_set(spark, sf), ("split", "label")).drop("default_rate")


@query
def split_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = modeling.split_stats(_training_set(spark, sf))
    return stats.withColumn("default_rate", F.round("default_rate", 8))


@query
def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    data = _training_set(spark, sf)
    columns = modeling.feature_columns(data)
    scaler = modeling.fit_scaler(data.filter(F.col("split") == "train"), columns)
    return scaler.apply(data).select(
        LOAN, CUSTOMER, SNAPSHOT, "label", "split", *[F.round(c, 6).alias(c) for c in columns]
    )


@query
def auc_gini(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of the splits, of one with defaults only and of one without rows."""
    scored = _training_set(spark, sf).select("split", "label", F.coalesce("fe_2", F.lit(0)).alias("score"))
    defaults = scored.filter("split = 'train' AND label = 1").withColumn("split", F.lit("defaults"))
    return modeling.auc_gini(scored.unionAll(defaults), "score", ("train", "test", "oot", "defaults", "empty"))


#: Small enough for plain SQL to grow the same trees.
FIXED_TREES = boosting.Params(maxIter=3, maxDepth=2, stepSize=0.3, minChildWeight=2, minInfoGain=0.05, regAlpha=0.5, regLambda=1.5)


@query
def boosted_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Three boosted trees with L1 and L2 penalties, grown on the train split, and their score of every row."""
    data = _stored(_training_set(spark, sf), "training")
    features = modeling.feature_columns(data)
    plain = modeling.Scaler(dict.fromkeys(features, 0.0), dict.fromkeys(features, 1.0))
    model = modeling.fit_trees(modeling.binned(data.filter(F.col("split") == "train"), features), FIXED_TREES, plain)
    return model.probability(data, "score").select(LOAN, CUSTOMER, SNAPSHOT, "split", F.round("score", 9).alias("score"))


_BANKS: dict[tuple[str, str], tuple[str, str]] = {}


def _trained(spark: SparkSession, sf: str) -> tuple[str, str]:
    """(bank, version) of the model of the whole search, 100 draws in three folds; one search for each session and folder."""
    key = spark.sparkContext.applicationId, sf
    if key not in _BANKS:
        bank = f"{scratch_path(spark, 'model')}/bank"
        features = adapters.source(spark, sf, "monthly_features")
        _BANKS[key] = bank, jobs.train_model(_labels(spark, sf), features, TRAIN_DATE, bank).version
    return _BANKS[key]


@query
def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The card of a banked model by split, and whether the reloaded model has the same areas and the same scores, row by row."""
    bank, version = _trained(spark, sf)
    card = modeling.load_card(spark, bank, version)
    model, data = modeling.load_model(bank, version, spark), _stored(_training_set(spark, sf), "training")
    again = modeling.evaluate(model, data, ("train", "test", "oot"))
    digest = modeling.score_digest(modeling.probability(model, data), (LOAN, SNAPSHOT))
    areas = F.create_map(*[F.lit(x) for split, area in again.items() for x in (split, area)])
    dates = ["train_date", "train_test_start_date", "train_test_end_date", "oot_start_date", "oot_end_date"]
    by_split = card.select("model_version", *dates, "rows", "default_rate", "score_digest", F.explode("auc").alias("split", "auc"))
    same = (F.abs(F.col("auc") - areas[F.col("split")]) < 1e-9) & F.col("auc").between(0, 1) & (F.col("score_digest") == digest)
    return by_split.select(
        "model_version",
        *dates,
        "split",
        F.col("rows")[F.col("split")].alias("row_count"),
        F.col("default_rate")[F.col("split")].alias("default_rate"),
        same.cast("int").alias("same_after_reload"),
    )


@query
def train_and_score(spark: SparkSession, sf: str) -> DataFrame:
    """Search, model bank, reload and scoring of every snapshot: keys, and whether each score is the share that a walk of the stored trees gives."""
    bank, version = _trained(spark, sf)
    features = adapters.source(spark, sf, "monthly_features")
    scores = jobs.score_range(features, bank, version, scratch_path(spark, "scores"))
    walk = modeling.load_model(bank, version, spark).walked(features, [CUSTOMER, SNAPSHOT])
    joined = scores.join(walk, [CUSTOMER, SNAPSHOT], "left")
    inside = F.col("model_predictions").between(0, 1) & (F.abs(F.col("model_predictions") - F.col("walk")) < 1e-9)
    return joined.select(CUSTOMER, SNAPSHOT, "model_name", F.coalesce(inside.cast("int"), F.lit(0)).alias("in_range"))
