"""Registered queries. Each reads the tables below ``sf_dir`` and returns a DataFrame."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import oracle  # noqa: E402
from plateward.operators import (  # noqa: E402
    boosting,
    counts,
    evaluate,
    explore,
    features,
    history,
    model,
    profile,
    quality,
)
from plateward.plans import compliance, daily  # noqa: E402
from plateward.plans.mart import build_mart, in_jurisdiction  # noqa: E402
from plateward.plans.staging import build_staging  # noqa: E402
from plateward.session import scratch_path, stored  # noqa: E402
from plateward.sources import inspections_csv, tables  # noqa: E402
from plateward.sources.demo import raw_inspections  # noqa: E402
from plateward.values import (  # noqa: E402
    FEATURES,
    JURISDICTION_CITY,
    MART_TESTS,
    STAGING_TESTS,
    TOP_TYPES,
)

# The training-data operators, or a package that they need, may be absent; then their queries are too.
try:
    from plateward.llm import oracle as llm_oracle, queries as llm_queries
except ImportError as missing:
    if not (isinstance(missing, ModuleNotFoundError) or missing.name == "plateward.llm"):
        raise
    llm_oracle = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]
BOOSTED_FEATURES = ("violation_count", "inspection_month", "license_total_fails", "days_since_previous_inspection")
# Rows of one CSV file that is read in splits, about 150 MB.
FILE_ROWS = 500_000
DAILY_LAYERS = daily.Layers("demo_raw", "demo_staging", "demo_marts")
# Trainings of this process by session and folder: the model queries share one.
_TRAINED: dict[tuple[str, str], compliance.Compliance] = {}
_BOOSTED: dict[tuple[str, str], tuple[boosting.Boosted, DataFrame, DataFrame]] = {}


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_staging(raw_inspections(spark, sf_dir))


def _inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_jurisdiction(_staging(spark, sf_dir))


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(_staging(spark, sf_dir))


def _explored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.load_mart(_mart(spark, sf_dir))


def _modelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.modelling_set(_mart(spark, sf_dir))


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.temporal_split(_modelled(spark, sf_dir))[0]


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score both sides can compute: fewer violations, more likely compliant."""
    return _modelled(spark, sf_dir).withColumn("score", -F.col("violation_count"))


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = (F.col("violation_count") < 2).cast("int")
    return _modelled(spark, sf_dir).withColumn("prediction", few)


def _on(source: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(source(spark, sf_dir))


def _rows_per(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(*columns).agg(F.count("*").alias("rows"))


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing-value texts written over known cells, then read as NULL."""
    token = (
        F.when(F.col("risk").isNull(), "N/A").when(F.col("risk") == "All", "nan").otherwise(F.col("aka_name"))
    )
    empty = F.when(F.col("inspection_id") % 5 == 0, "").otherwise(F.col("dba_name"))
    dirty = raw_inspections(spark, sf_dir).select(
        "inspection_id", empty.alias("dba_name"), token.alias("aka_name")
    )
    return inspections_csv.nullify(dirty)


def risk_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plateward.functions.inspection import invalid_risk, risk_level, risk_rank

    risk = F.col("risk")
    parsed = raw_inspections(spark, sf_dir).select(
        "risk",
        risk_level(risk).alias("risk_level"),
        risk_rank(risk).alias("risk_rank"),
        invalid_risk(risk).alias("flag_invalid_risk"),
    )
    return _rows_per("risk", "risk_level", "risk_rank", "flag_invalid_risk")(parsed)


def violation_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _staging(spark, sf_dir)
        .groupBy("violation_count")
        .agg(F.count("*").alias("rows"), F.count("violations_raw").alias("with_text"))
    )


def facility_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = counts.group_rare(_inside(spark, sf_dir), "facility_type", "facility_type_grouped")
    named = grouped.withColumnRenamed("facility_type", "facility_type_original")
    return _rows_per("facility_type_grouped", "facility_type_original")(named)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, staging = raw_inspections(spark, sf_dir), _staging(spark, sf_dir)
    return counts.row_counts(raw=raw, staging=staging, mart=build_mart(staging))


def dq_duplicates_injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging tests on a spoiled copy: repeated ids, foreign values, lost dates."""
    staging = _staging(spark, sf_dir)
    spoiled = staging.unionByName(staging.where(F.col("results") == "Not Ready")).withColumns(
        {
            "results": F.when(F.col("results") == "No Entry", "Closed").otherwise(F.col("results")),
            "risk_level": F.when(F.col("flag_invalid_risk"), "ALL").otherwise(F.col("risk_level")),
            "inspection_date": F.when(~F.col("flag_missing_license"), F.col("inspection_date")),
        }
    )
    return quality.run_suite(spoiled, STAGING_TESTS)


def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = {
        "risk": ("Risk 1 (High)", "Risk 2 (Medium)", "Risk 3 (Low)"),
        "state": ("IL",),
        "city": (JURISDICTION_CITY,),
    }
    return profile.domain_violations(raw_inspections(spark, sf_dir), domains)


def temporal_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sizes(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("rows"), F.sum("label").alias("positives")).select(
            F.lit(name).alias("part"), "rows", "positives"
        )

    train, test = features.temporal_split(_modelled(spark, sf_dir))
    return sizes("train", train).unionByName(sizes("test", test))


def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = compliance.encoded_set(_mart(spark, sf_dir))
    return rows.select("inspection_id", "label", *FEATURES)


def _trained(spark: SparkSession, sf_dir: str) -> compliance.Compliance:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        _TRAINED[key] = compliance.train(_mart(spark, sf_dir))
    return _TRAINED[key]


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir).scored.select("inspection_id", "label", "prediction", "score")


def gbt_scores_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each test row: whether its score is a probability and its prediction agrees with it."""
    return _properties(gbt_scores(spark, sf_dir))


def gbt_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.importances(spark, _trained(spark, sf_dir).model)


def gbt_importances_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importances as a whole: their number, signs, sum and order."""
    rows = gbt_importances(spark, sf_dir).withColumn("place", F.monotonically_increasing_id())
    largest_first = F.sort_array(F.collect_list("importance"), asc=False)
    as_given = F.transform(F.array_sort(F.collect_list(F.struct("place", "importance"))), lambda r: r["importance"])
    return rows.agg(
        F.count_distinct("feature").alias("features"),
        (F.min("importance") >= 0).alias("none_negative"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sum_is_one"),
        (largest_first == as_given).alias("largest_first"),
    )


def _boosted(spark: SparkSession, sf_dir: str) -> tuple[boosting.Boosted, DataFrame, DataFrame]:
    """The second-order model of all training rows, the AUC of each fold, and the test rows: one training."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BOOSTED:
        rows, _ = compliance.encoded_set(_mart(spark, sf_dir))
        training, test = features.temporal_split(rows)
        trained, aucs = boosting.train_and_validate(training)
        _BOOSTED[key] = trained, stored(aucs, "aucs"), test
    return _BOOSTED[key]


def gbt_cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boosted(spark, sf_dir)[1]


def cv_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fold's size, and whether its area and the summary of all are as they must be."""
    aucs = gbt_cross_validation(spark, sf_dir)
    summary = model.cv_summary(aucs).first()
    squares = F.avg(F.col("roc_auc") * F.col("roc_auc")).over(Window.partitionBy())
    mean = F.avg("roc_auc").over(Window.partitionBy())
    deviation = F.sqrt(F.greatest(squares - mean * mean, F.lit(0.0)))
    sizes = (
        features.stratified_folds(_training(spark, sf_dir))
        .groupBy("fold")
        .agg(F.count("*").alias("rows"), F.sum("label").alias("positives"))
    )
    return sizes.join(aucs, "fold").select(
        "fold",
        "rows",
        "positives",
        F.col("roc_auc").between(0.5, 1).alias("auc_in_range"),
        (F.abs(mean - summary["mean_auc"]) < 1e-9).alias("mean_agrees"),
        (F.abs(deviation - summary["std_auc"]) < 1e-6).alias("std_agrees"),
    )


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the model and by the model after it was saved and loaded."""
    trained, path = _trained(spark, sf_dir), scratch_path(spark, "saved-model")
    model.save(trained.model, path)
    given = trained.scored.withColumnRenamed("score", "score_before").drop("prediction")
    again = model.score(model.load(path), given)
    return again.agg(
        F.count("*").alias("rows"), F.count_if(F.col("score") != F.col("score_before")).alias("different")
    )


def _properties(scored: DataFrame) -> DataFrame:
    score = F.col("score")
    return scored.select(
        "inspection_id",
        "label",
        score.between(0, 1).alias("is_probability"),
        (F.col("prediction") == (score > 0.5).cast("int")).alias("agrees"),
    )


def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the job's 300 second-order trees."""
    trained, _, test = _boosted(spark, sf_dir)
    return boosting.score(trained, test).select("inspection_id", "label", "prediction", "score")


def boosted_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosting.importances(spark, _boosted(spark, sf_dir)[0])


def boosted_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of two second-order trees of depth 2, on features with and without missing values."""
    rows = features.with_weight(_training(spark, sf_dir))
    settings = boosting.Settings(trees=2, depth=2, rate=0.3, bins=16)
    trained, _ = boosting.train(rows, settings=settings, features=BOOSTED_FEATURES)
    return trained.nodes(spark).drop("gain", "value")


def features_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve features, read back out of the assembled vector."""
    rows, _ = compliance.encoded_set(_mart(spark, sf_dir))
    vector = vector_to_array("features")
    return model.assemble().transform(rows).select(
        "inspection_id", *(vector[k].alias(name) for k, name in enumerate(FEATURES))
    )


def _daily(spark: SparkSession, sf_dir: str) -> tuple[str, str, daily.Run]:
    """The demo data as CSV files, and a warehouse in which the daily job has run on them."""
    source, warehouse = scratch_path(spark, "csv"), scratch_path(spark, "warehouse")
    inspections_csv.write_csv(_with_location(raw_inspections(spark, sf_dir)), source)
    run = daily.run_daily(spark, source, warehouse, layers=DAILY_LAYERS, ingested_at=datetime(2026, 1, 1, 6))
    return source, warehouse, run


def _with_location(raw: DataFrame) -> DataFrame:
    """A place with quotes, a comma and a line break, as far as the row has coordinates."""
    place = F.concat(
        F.lit('("'), F.col("latitude").cast("string"), F.lit('",\n'), F.col("longitude").cast("string"), F.lit(")")
    )
    return raw.withColumn("location", place)


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the daily job counted and published, and that a spoiled source then publishes nothing."""
    source, warehouse, run = _daily(spark, sf_dir)
    repeated = scratch_path(spark, "csv")
    raw = _with_location(raw_inspections(spark, sf_dir))
    inspections_csv.write_csv(raw.where(F.col("results") == "Not Ready"), repeated)
    try:
        daily.run_daily(spark, [source, repeated], warehouse, layers=DAILY_LAYERS)
        stopped = False
    except daily.DataTestsFailed:
        stopped = True
    published = daily.current(spark, warehouse)
    tests = spark.read.parquet(published.tests_path).agg(F.count_if("passed").alias("tests_passed"))
    rows = spark.read.parquet(published.mart_path).agg(F.count("*").alias("mart_rows"))
    numbered = lambda df: df.withColumn("one", F.lit(1))
    return numbered(tests).join(numbered(rows), "one").select(
        F.lit(run.loaded).cast("bigint").alias("loaded"),
        F.lit(run.rejected).cast("bigint").alias("rejected"),
        "tests_passed",
        "mart_rows",
        F.lit(stopped).alias("spoiled_stopped"),
        F.lit(published == run).alias("first_still_published"),
    )


def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging layer of a warehouse, as another process reads it."""
    _, warehouse, _ = _daily(spark, sf_dir)
    return daily.current_staging(spark, warehouse)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw inspections written as CSV files and read back."""
    path = scratch_path(spark, "csv")
    inspections_csv.write_csv(_with_location(raw_inspections(spark, sf_dir)), path)
    records = inspections_csv.read_inspections(spark, path, ingested_at=datetime(2026, 1, 1, 6))
    return inspections_csv.accepted(records)


def _in_files(raw: DataFrame, rows: int = FILE_ROWS) -> DataFrame:
    """The rows in as few parts as hold about ``rows`` each, so that no task writes more however many there are."""
    parts = -(-raw.count() // rows)
    return raw.repartition(parts, "inspection_id", "license_number") if parts > 1 else raw.coalesce(1)


def csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw inspections in one CSV file, or few large ones, with line breaks in fields, read in splits."""
    path, raw = scratch_path(spark, "csv-one"), _with_location(raw_inspections(spark, sf_dir))
    inspections_csv.write_csv(_in_files(raw), path)
    given = datetime(2026, 1, 1, 6)
    return inspections_csv.accepted(inspections_csv.read_inspections(spark, path, ingested_at=given, split_files=True))


def _dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    """Raw inspections written without quotes, some with a bare comma or a worded id."""
    path = scratch_path(spark, "csv-bad")
    result = F.col("results")
    worded = F.concat(F.lit("no. "), F.col("inspection_id").cast("string"))
    place = F.concat_ws(", ", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    dirty = raw_inspections(spark, sf_dir).withColumns(
        {
            "inspection_id": F.when(result == "Business Not Located", worded).otherwise(
                F.col("inspection_id").cast("string")
            ),
            "location": F.when(result == "Not Ready", place),
        }
    )
    dirty.select(*inspections_csv.RAW_COLUMNS).write.options(header=True, quote="").csv(path)
    return path


def csv_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inspections_csv.read_inspections(spark, _dirty_csv(spark, sf_dir))
    reason = F.coalesce("reject_reason", F.lit("none")).alias("reject_reason")
    return records.groupBy(reason).agg(F.count("*").alias("rows"))


def csv_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landing keeps and counts when bad records are to be skipped."""
    target = scratch_path(spark, "skipped")
    loaded, rejected = daily.ingest(spark, _dirty_csv(spark, sf_dir), target, on_bad="skip")
    return daily.landed(spark, target).agg(F.count("*").alias("landed")).select(
        "landed",
        F.lit(loaded).cast("bigint").alias("loaded"),
        F.lit(rejected).cast("bigint").alias("rejected"),
        F.lit(daily.quarantined(spark, target).count()).cast("bigint").alias("set_aside"),
    )


def _stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as a stored table of the marts layer, read by name."""
    name = "mart_inspections_" + Path(scratch_path(spark, "t")).name[-12:]
    tables.as_table(
        _mart(spark, sf_dir),
        tables.namespace("marts", "default"),
        name,
        path=scratch_path(spark, "mart"),
        partition_by=["inspection_year"],
    )
    return tables.table(spark, "marts", name)


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspections inside the jurisdiction, bucketed by licence and day."""
    name = "inspections_by_licence_" + Path(scratch_path(spark, "t")).name[-12:]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layer = tables.namespace("marts", "default")
    return history.in_layout(_inside(spark, sf_dir), layer, name, buckets, scratch_path(spark, "layout"))


def sketched_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the years up to 2019 from stored yearly sketches, its estimates held against exact counts."""
    mart = _mart(spark, sf_dir)
    columns = [c for c in mart.columns if c not in ("inspection_year", "ingested_at")]
    sketches = stored(profile.yearly_sketches(mart, columns), "sketches")
    estimated = profile.profile_of_years(sketches, last=2019)
    exact = profile.distinct_profile(mart.where(F.col("inspection_year") <= 2019), columns).withColumnRenamed("distinct_values", "exact")
    off = F.abs(F.col("distinct_values") - F.coalesce("exact", F.lit(0))) <= 0.05 * F.coalesce("exact", F.lit(0))
    # One row per profiled column.
    return estimated.join(F.broadcast(exact), "column_name", "left").select("column_name", "nulls", "null_pct", off.alias("close"))


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All inspections of one licence, read from a table sorted by licence with bloom filters."""
    name = "inspections_to_look_up_" + Path(scratch_path(spark, "t")).name[-12:]
    layer, path = tables.namespace("marts", "default"), scratch_path(spark, "lookup")
    keys = ("license_number", "inspection_id")
    table = tables.as_table(
        _inside(spark, sf_dir), layer, name, path, bucket_by=keys[:1], buckets=8, sort_by=keys, bloom_on=keys
    )
    return explore.lookup(table, "license_number", "37")


def reload_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per result, whether a reload in another order has the same digest, and what one changed group shows."""
    raw = _staging(spark, sf_dir)
    before = stored(tables.digests(raw, "results", without=["ingested_at"]), "digests")
    again = tables.digests(raw.repartition("zip", "inspection_id"), "results", without=["ingested_at"])
    spoiled = raw.withColumn("zip", F.when((F.col("results") != "Fail") | F.col("zip").isNull(), F.col("zip")).otherwise("0"))
    same = tables.changed_parts(before, again).select(F.col("part").alias("moved"))
    other = tables.changed_parts(before, tables.digests(spoiled, "results", without=["ingested_at"]))
    found = before.join(same, F.col("part").eqNullSafe(F.col("moved")), "left").join(
        other.select(F.col("part").alias("changed")), F.col("part").eqNullSafe(F.col("changed")), "left"
    )
    return found.select(
        F.col("part").alias("results"),
        "rows",
        F.col("moved").isNull().alias("same_after_reload"),
        F.col("changed").isNotNull().alias("changed"),
    )


def table_year_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_mart(spark, sf_dir).where(F.col("inspection_year") >= 2015)


def entry(spark: SparkSession) -> DataFrame:
    """The mart over the smallest tables."""
    return _mart(spark, "/root/testdata/sf0.001")


def library_queries() -> dict[str, Query]:
    return {
        "raw_inspections": raw_inspections,
        "null_tokens": null_tokens,
        "stg_inspections": _staging,
        "quality_flags": _on(
            _staging,
            _rows_per(
                "flag_out_of_jurisdiction",
                "flag_fail_without_violations",
                "flag_invalid_risk",
                "flag_missing_license",
            ),
        ),
        "risk_parse": risk_parse,
        "violation_count": violation_count,
        "facility_type_counts": _on(_inside, lambda df: counts.category_counts(df, "facility_type")),
        "facility_grouping": facility_grouping,
        "license_history": _on(_inside, history.license_history),
        "previous_inspection": _on(_inside, history.previous_inspection),
        "days_since_previous": _on(_mart, _rows_per("days_since_previous_inspection")),
        "mart_inspections": _mart,
        "row_counts": row_counts,
        "explore_scan": _explored,
        "year_span": _on(_explored, explore.year_span),
        "inspection_type_counts": _on(_explored, lambda df: counts.value_counts(df, "inspection_type")),
        "results_distribution": _on(_explored, lambda df: counts.value_shares(df, "results")),
        "top_types": _on(
            lambda spark, sf_dir: explore.load_mart(_mart(spark, sf_dir), ["facility_type_original"]),
            lambda df: counts.top_k(df, "facility_type_original", TOP_TYPES),
        ),
        "top_type_rows": _on(
            lambda spark, sf_dir: explore.load_mart(
                _mart(spark, sf_dir), ["inspection_id", "facility_type_original"]
            ),
            lambda df: counts.keep_top_k(df, "facility_type_original", TOP_TYPES),
        ),
        "fail_rate_top_types": _on(_explored, lambda df: explore.fail_rate_by(df, "facility_type_grouped")),
        "fail_rate_all_types": _on(
            _mart, lambda df: explore.fail_rates(df, "facility_type_grouped").drop("rows")
        ),
        "yearly_trend": _on(_explored, explore.yearly_trend),
        "yearly_trend_rounded": _on(
            _explored,
            lambda df: explore.rounded(
                explore.yearly_trend(df).drop("passes", "fails"), "pass_rate", "fail_rate"
            ),
        ),
        "violations_by_risk": _on(_explored, explore.violations_by_risk),
        "flag_summary": _on(
            _explored,
            lambda df: explore.flag_summary(
                df, ["flag_fail_without_violations", "flag_missing_license", "repeat_fail_flag"]
            ),
        ),
        "dq_staging_suite": _on(_staging, lambda df: quality.run_suite(df, STAGING_TESTS)),
        "dq_mart_suite": _on(_mart, lambda df: quality.run_suite(df, MART_TESTS)),
        "dq_duplicates_injected": dq_duplicates_injected,
        "column_profile": _on(
            _staging, lambda df: profile.column_profile(df, df.columns)
        ),
        "domain_violations": domain_violations,
        "name_variants": _on(raw_inspections, lambda df: profile.variants(df, "dba_name")),
        "city_variants": _on(raw_inspections, lambda df: profile.variants(df, "city")),
        "collated_name_variants": _on(raw_inspections, lambda df: profile.collated_variants(df, "dba_name")),
        "collated_city_variants": _on(raw_inspections, lambda df: profile.collated_variants(df, "city")),
        "sketched_profile": sketched_profile,
        "point_lookup": point_lookup,
        "reload_digests": reload_digests,
        "roc_corners": _on(_scored, lambda df: evaluate.roc_curve(df, drop_intermediate=True)),
        "kpis": _on(_mart, profile.kpis),
        "calendar": _on(_mart, profile.calendar),
        "exclusion_audit": _on(_staging, profile.exclusion_audit),
        "license_history_asof": _on(_inside, history.license_history_asof),
        "bucketed_previous": _on(_layout, history.previous_inspection),
        "bucketed_history_asof": _on(_layout, history.license_history_asof),
        "modelling_set": _modelled,
        "modelling_set_asof": lambda spark, sf_dir: features.modelling_set(
            history.point_in_time(_mart(spark, sf_dir))
        ),
        "label_codes": _on(_modelled, features.label_codes),
        "encoded_features": encoded_features,
        "temporal_split_counts": temporal_split_counts,
        "class_weight": _on(_training, features.class_weight),
        "weighted_rows": _on(
            _training, lambda df: features.with_weight(df).select("inspection_id", "label", "weight")
        ),
        "stratified_folds": _on(
            _training, lambda df: features.stratified_folds(df).select("inspection_id", "label", "fold")
        ),
        "roc_auc_exact": _on(_scored, evaluate.roc_auc),
        "roc_points": _on(_scored, evaluate.roc_curve),
        "confusion": _on(_predicted, evaluate.confusion),
        "classification_report": _on(_predicted, evaluate.classification_report),
        "csv_roundtrip": csv_roundtrip,
        "csv_split": csv_split,
        "csv_bad_records": csv_bad_records,
        "csv_skip": csv_skip,
        "table_roundtrip": _stored_mart,
        "table_year_scan": table_year_scan,
        "daily_job": daily_job,
        "staging_view": staging_view,
        "features_vector": features_vector,
        "gbt_scores": gbt_scores,
        "gbt_scores_checked": gbt_scores_checked,
        "gbt_importances": gbt_importances,
        "gbt_importances_checked": gbt_importances_checked,
        "model_roundtrip": model_roundtrip,
        "boosted_scores": boosted_scores,
        "boosted_scores_checked": lambda spark, sf_dir: _properties(boosted_scores(spark, sf_dir)),
        "boosted_importances": boosted_importances,
        "boosted_nodes": boosted_nodes,
        "gbt_cross_validation": gbt_cross_validation,
        "cv_checked": cv_checked,
    }


def _with_workers(query: Query) -> Query:
    """The query, with Python workers that can import this repository wherever the session was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    added = llm_queries.queries() if llm_queries else {}
    return library_queries() | {name: _with_workers(query) for name, query in added.items()}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql() | (llm_oracle.oracle_sql() if llm_oracle else {})
