"""The classifier by its properties: few trees, and a signal it must find."""

import pytest
from pyspark.sql import functions as F

from plateward.operators import boosting, features, model
from plateward.plans import compliance
from plateward.values import FEATURES, MODEL_COLUMNS


@pytest.fixture(scope="module")
def mart(spark):
    """Failing depends on the violation count, with some noise."""
    i = F.col("id")
    many = (i * 7 % 11).cast("int")
    fails = (many > 6) != (i % 13 == 0)
    return spark.range(3000).select(
        i.alias("inspection_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (i % 4000).cast("int")).alias("inspection_date"),
        F.when(i % 3 == 0, "GROCERY").otherwise("RESTAURANT").alias("facility_type_grouped"),
        F.when(i % 2 == 0, "HIGH").otherwise("UNKNOWN").alias("risk_level"),
        F.when(i % 2 == 0, 1).alias("risk_rank"),
        F.when(i % 5 != 0, "CANVASS").alias("inspection_type"),
        F.when(i % 17 == 0, "No Entry").when(fails, "Fail").otherwise("Pass").alias("results"),
        many.alias("violation_count"),
        (2014 + i % 12).cast("int").alias("inspection_year"),
        (1 + i % 12).cast("int").alias("inspection_month"),
        (1 + i % 4).cast("int").alias("inspection_quarter"),
        (i % 9).alias("license_total_inspections"),
        (i % 4).alias("license_total_fails"),
        (i % 4 > 1).alias("repeat_fail_flag"),
        F.when(i % 6 != 0, (i % 300).cast("int")).alias("days_since_previous_inspection"),
    )


@pytest.fixture(scope="module")
def trained(spark, mart, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    return compliance.train(mart, path, trees=4), path


def test_modelling_set(mart):
    rows = features.modelling_set(mart)
    assert rows.where(~F.col("results").isin("Pass", "Fail")).count() == 0
    assert rows.agg(F.min("inspection_year")).first()[0] == 2015
    assert set(MODEL_COLUMNS) < set(rows.columns)
    train, test = features.temporal_split(rows)
    assert train.count() + test.count() == rows.count()
    assert train.agg(F.max("inspection_year")).first()[0] == 2023
    assert test.agg(F.min("inspection_year")).first()[0] == 2024


def test_features_hold_no_null(mart):
    rows, _ = compliance.encoded_set(mart)
    nulls = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in FEATURES)).first()
    assert set(nulls) == {0}
    assert rows.agg(F.min("days_since_previous_inspection"), F.min("risk_rank")).first()[:] == (-1, 0)


def test_finds_the_signal(spark, trained):
    result, _ = trained
    tables = result.tables
    assert tables["roc_auc"].first().roc_auc > 0.85
    importances = tables["importances"].collect()
    assert importances[0].feature == "violation_count" and len(importances) == 12
    assert sum(r.importance for r in importances) == pytest.approx(1)
    assert result.scored.where("score < 0 or score > 1 or prediction not in (0, 1)").count() == 0
    support = {r.row: r.support for r in tables["classification_report"].collect()}
    assert support["accuracy"] == result.scored.count() == support["Fail"] + support["Compliant"]


def test_stored_model_scores_the_same(spark, mart, trained):
    result, path = trained
    kept = compliance.current(spark, path)
    rows = features.encode(features.impute(features.modelling_set(mart)), kept.codes)
    _, test = features.temporal_split(rows)
    again = model.score(kept.model, test)
    first = {r.inspection_id: r.score for r in result.scored.collect()}
    assert {r.inspection_id: r.score for r in again.collect()} == first
    assert {r.inspection_id: r.score for r in kept.scored.collect()} == first


def test_a_failed_training_leaves_the_last_model_and_its_codes(spark, mart, trained, monkeypatch):
    result, path = trained
    before = {tuple(r) for r in result.codes.collect()}

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(compliance.classifier, "fit", fails)
    other = mart.withColumn("facility_type_grouped", F.lit("BAKERY"))
    with pytest.raises(RuntimeError):
        compliance.train(other, path, trees=2)
    kept = compliance.current(spark, path)
    assert {tuple(r) for r in kept.codes.select(*result.codes.columns).collect()} == before
    assert kept.scored.count() == result.scored.count()


def test_same_seed_same_model(mart, trained):
    result, _ = trained
    again = compliance.train(mart, trees=4)
    assert {(r.inspection_id, r.score) for r in again.scored.collect()} == {
        (r.inspection_id, r.score) for r in result.scored.collect()
    }


def test_cross_validation(mart):
    rows, _ = compliance.encoded_set(mart)
    train, _ = features.temporal_split(rows)
    folds = model.cross_validate(train, k=3, trees=2)
    values = [r.roc_auc for r in folds.collect()]
    assert len(values) == 3 and min(values) > 0.8
    summary = model.cv_summary(folds).first()
    mean = sum(values) / 3
    assert summary.mean_auc == pytest.approx(mean)
    assert summary.std_auc == pytest.approx((sum((v - mean) ** 2 for v in values) / 3) ** 0.5)


@pytest.fixture(scope="module")
def second_order(spark, mart, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("boosted"))
    return compliance.train(mart, path, trees=4, learner=compliance.SECOND_ORDER), path


def test_second_order_learner_finds_the_signal(second_order):
    result, _ = second_order
    tables = result.tables
    assert tables["roc_auc"].first().roc_auc > 0.85
    importances = tables["importances"].collect()
    assert importances[0].feature == "violation_count" and len(importances) == 12
    assert result.scored.where("score < 0 or score > 1 or prediction not in (0, 1)").count() == 0


def test_stored_second_order_model_scores_the_same(spark, mart, second_order):
    result, path = second_order
    kept = compliance.current(spark, path)
    assert kept.learner == compliance.SECOND_ORDER
    rows = features.encode(features.impute(features.modelling_set(mart)), kept.codes)
    _, test = features.temporal_split(rows)
    scores = lambda df: {r.inspection_id: r.score for r in df.collect()}
    assert scores(boosting.score(kept.model, test)) == scores(result.scored) == scores(kept.scored)


def test_folds_grow_with_the_model(spark, mart):
    rows, _ = compliance.encoded_set(mart)
    training, _ = features.temporal_split(rows)
    settings = boosting.Settings(trees=4, depth=3, rate=0.3)
    trained, together = boosting.train_and_validate(training, 3, settings)
    alone = boosting.cross_validate(training, 3, settings)
    assert {tuple(r) for r in together.collect()} == {tuple(r) for r in alone.collect()}
    assert together.count() == 3 and together.agg(F.min("roc_auc")).first()[0] > 0.8
    assert len(trained.models) == 4


def test_equal_rows_are_merged_before_training(spark, monkeypatch):
    i = F.col("id")
    few = {name: (i * (k + 3) % 4).cast("int") for k, name in enumerate(FEATURES)}
    rows = spark.range(400).select(*(c.alias(name) for name, c in few.items()), (i % 4 > 1).cast("int").alias("label"))
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, 1.5).otherwise(1.0))
    kept = model.merged(rows)
    assert kept.count() == rows.distinct().count() == 4
    assert kept.agg(F.sum("weight")).first()[0] == 200 * 1.5 + 200
    plain = model.score(model.fit(rows, trees=2), rows).agg(F.sum("score")).first()[0]
    monkeypatch.setattr(model, "MERGED_FROM", 1)
    assert model.score(model.fit(rows, trees=2), rows).agg(F.sum("score")).first()[0] == pytest.approx(plain)
