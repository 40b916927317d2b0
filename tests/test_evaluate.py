"""Evaluation against brute force."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from plateward.operators import counts, evaluate, explore, features


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def brute_auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


CASES = {
    "tied": [(0, 1), (1, 1), (0, 1), (1, 1)],
    "perfect": [(0, 1), (0, 2), (1, 3), (1, 4)],
    "inverted": [(1, 1), (1, 2), (0, 3), (0, 4)],
    "mixed": [(1, 1), (0, 1), (1, 2), (0, 3), (1, 3), (1, 5)],
}


@pytest.mark.parametrize("name", CASES)
def test_auc_cases(spark, name):
    assert evaluate.roc_auc(scored(spark, CASES[name])).first().roc_auc == brute_auc(CASES[name])


@pytest.fixture(scope="module")
def many():
    """Thousands of distinct scores, and one score that a third of the rows share."""
    pick = random.Random(1)
    return [
        (pick.random() < 0.3, 0.5 if i % 3 == 0 else pick.random() ** 3) for i in range(6000)
    ]


def test_auc_of_many_scores(spark, many):
    df = scored(spark, many)
    found = evaluate.roc_auc(df).first().roc_auc
    assert found == pytest.approx(brute_auc(many), rel=1e-12)
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert found == pytest.approx(ml.evaluate(df.withColumn("label", F.col("label").cast("double"))), rel=1e-9)


def test_curve_of_many_scores(spark, many):
    points = evaluate.roc_curve(scored(spark, many)).orderBy(F.desc("threshold")).collect()
    p, n = sum(y for y, _ in many), sum(not y for y, _ in many)
    assert (points[0].threshold, points[0].fpr, points[0].tpr) == (float("inf"), 0, 0)
    assert (points[-1].fpr, points[-1].tpr) == (1, 1)
    assert len(points) == len({s for _, s in many}) + 1
    for point in points[1::97]:
        above = [y for y, s in many if s >= point.threshold]
        assert point.tpr == pytest.approx(sum(above) / p)
        assert point.fpr == pytest.approx((len(above) - sum(above)) / n)


def test_report_and_confusion(spark):
    cells = {(0, 0): 5, (0, 1): 3, (1, 0): 2, (1, 1): 10}
    rows = [pair for pair, n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    table = {r.label: (r.predicted_0, r.predicted_1) for r in evaluate.confusion(df).collect()}
    assert table == {0: (5, 3), 1: (2, 10)}
    report = {r.row: r for r in evaluate.classification_report(df).collect()}
    assert report["Fail"].precision == 5 / 7 and report["Fail"].recall == 5 / 8
    assert report["Compliant"].f1 == 2 * 10 / (12 + 13) and report["Compliant"].support == 12
    assert report["accuracy"].f1 == 15 / 20
    assert report["macro avg"].recall == (5 / 8 + 10 / 12) / 2
    assert report["weighted avg"].precision == pytest.approx((5 / 7 * 8 + 10 / 13 * 12) / 20)


def test_report_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 1), (1, 1)], "label int, prediction int")
    report = {r.row: r for r in evaluate.classification_report(df).collect()}
    assert (report["Fail"].precision, report["Fail"].f1) == (0, 0)


def unshuffled_folds(labels, k):
    """Stratified folds without shuffling, as published for scikit-learn."""
    seen = list(dict.fromkeys(labels))
    encoded = sorted(seen.index(y) for y in labels)
    taken = [Counter(encoded[i::k]) for i in range(k)]
    queues = {y: [i for i in range(k) for _ in range(taken[i][seen.index(y)])] for y in seen}
    return [queues[y].pop(0) for y in labels]


@pytest.mark.parametrize("size,k", [(23, 5), (57, 5), (40, 3), (101, 4)])
def test_folds(spark, size, k):
    pick = random.Random(size)
    rows = [
        (i * 2**30, dt.date(2020, 1, 1) + dt.timedelta(days=0 if i % 3 else i), int(pick.random() < 0.7))
        for i in range(size)
    ]
    df = spark.createDataFrame(rows, "inspection_id bigint, inspection_date date, label int").repartition(5)
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    expected = dict(zip((r[0] for r in ordered), unshuffled_folds([r[2] for r in ordered], k)))
    found = {r.inspection_id: r.fold for r in features.stratified_folds(df, k).collect()}
    assert found == expected


def test_class_weight(spark):
    df = spark.createDataFrame([(1,)] * 8 + [(0,)] * 2, "label int")
    assert tuple(features.class_weight(df).first()) == (2, 8, 80.0, 0.25)
    weighted = {(r.label, r.weight) for r in features.with_weight(df).collect()}
    assert weighted == {(1, 0.25), (0, 1.0)}


def test_codes_are_sorted_and_unknown_values_get_none(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("B", "x"), ("ab", "y")], "f string, g string")
    found = {(r.column_name, r.value): r.code for r in features.label_codes(df, ["f", "g"]).collect()}
    assert found == {
        ("f", "B"): 0, ("f", "a"): 1, ("f", "ab"): 2, ("f", "b"): 3,
        ("g", "UNKNOWN"): 0, ("g", "x"): 1, ("g", "y"): 2,
    }
    codes = features.label_codes(df, ["f"])
    new = spark.createDataFrame([("zz",), ("ab",)], "f string")
    coded = {r.f: r.f_code for r in features.encode(new, codes, {"f": "f_code"}).collect()}
    assert coded == {"zz": -1, "ab": 2}


def test_top_k_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in ["c", "b", "a", "a", None, None, None]], "v string")
    assert [r.v for r in counts.top_k(df, "v", 2).collect()] == ["a", "b"]
    assert {r.v for r in counts.keep_top_k(df, "v", 2).collect()} == {"a", "b"}
    shares = {r.v: r.pct for r in counts.value_shares(df, "v").collect()}
    assert shares == {"a": 50.0, "b": 25.0, "c": 25.0}


def test_median_interpolates_and_rounding_is_half_even(spark):
    rows = [(i, "HIGH", v) for i, v in enumerate([1, 2, 4, 9])] + [(9, "UNKNOWN", 50)]
    df = spark.createDataFrame(rows, "inspection_id int, risk_level string, violation_count int")
    result = explore.violations_by_risk(df).collect()
    assert [(r.risk_level, r.avg_violations, r.median_violations, r.total) for r in result] == [("HIGH", 4.0, 3.0, 4)]
    half = spark.createDataFrame([(0.125,), (0.375,)], "x double")
    assert [r.x for r in explore.rounded(half, "x").collect()] == [0.12, 0.38]


def test_codes_of_many_values_with_one_prefix(spark):
    values = [f"RARE TYPE {i * 7919 % 10_000:05d}" for i in range(10_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(v,) for v in values], "f string")
        found = {r.value: r.code for r in features.label_codes(df, ["f"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {v: k for k, v in enumerate(sorted(values))}


def test_curve_without_points_inside_straight_runs(spark):
    rows = [(0.9, 1), (0.8, 1), (0.7, 1), (0.6, 0), (0.5, 0), (0.4, 1), (0.4, 0), (0.3, 1), (0.2, 0), (0.1, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    kept = evaluate.roc_curve(df, drop_intermediate=True).collect()
    whole = evaluate.roc_curve(df).collect()
    assert sorted(r.threshold for r in kept) == [0.1, 0.3, 0.4, 0.5, 0.7, float("inf")]
    assert set(kept) < set(whole)
