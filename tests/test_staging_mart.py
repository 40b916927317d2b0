"""Semantics at the edges: NULL, ties, thresholds, dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plateward.operators import history
from plateward.plans.mart import build_mart
from plateward.sources.demo import raw_inspections
from plateward.plans.staging import build_staging
from rows import column, raw, staged

SF = "/root/testdata/sf0.001"


def test_unknown_city_is_inside(spark):
    cities = [None, "CHICAGO", " chicago ", "CCHICAGO", "Evanston"]
    staging = staged(spark, [dict(city=c) for c in cities])
    assert column(staging, "flag_out_of_jurisdiction") == [False, False, False, True, True]
    assert column(build_mart(staging), "inspection_id") == [1, 2, 3]


def test_risk(spark):
    staging = staged(spark, [dict(risk=r) for r in ["1 and 2", "2 and 3", None, "All", " risk 3 "]])
    assert column(staging, "risk_level") == ["HIGH", "MEDIUM", "UNKNOWN", "UNKNOWN", "LOW"]
    assert column(staging, "risk_rank") == [1, 2, None, None, 3]
    assert column(staging, "flag_invalid_risk") == [False, False, False, True, False]


def test_violation_count(spark):
    staging = staged(spark, [dict(violations=v) for v in [None, "a", "a|b", "a|", "|"]])
    assert column(staging, "violation_count") == [0, 1, 2, 2, 2]


def test_fail_without_violations(spark):
    cases = [("Fail", None), (" Fail ", None), ("Fail", "x"), ("Pass", None), (None, None)]
    staging = staged(spark, [dict(results=r, violations=v) for r, v in cases])
    assert column(staging, "flag_fail_without_violations") == [True, True, False, False, False]


def test_trim_keeps_tabs(spark):
    assert column(staged(spark, [dict(dba_name="  \tA ")]), "dba_name") == ["\tA"]


def test_dates(spark):
    texts = ["01/02/2020", "1/2/2020", "02/30/2020", "", None]
    day = dt.date(2020, 1, 2)
    staging = staged(spark, [dict(inspection_date=t) for t in texts])
    assert column(staging, "inspection_date") == [day, day, None, None, None]


def test_rare_types(spark):
    sizes = {"nine": 9, "ten": 10, "eleven": 11}
    rows = [dict(facility_type=t) for t, n in sizes.items() for _ in range(n)]
    rows += [dict(facility_type="edge") for _ in range(9)] + [dict(facility_type="edge", city="X")]
    rows += [dict(facility_type=None)]
    mart = build_mart(staged(spark, rows))
    found = {
        (r.facility_type_original, r.facility_type_grouped)
        for r in mart.select("facility_type_original", "facility_type_grouped").distinct().collect()
    }
    assert found == {
        ("NINE", "OTHER"), ("TEN", "TEN"), ("ELEVEN", "ELEVEN"), ("EDGE", "OTHER"), (None, "UNKNOWN"),
    }


def test_repeat_flag_needs_two_fails(spark):
    fails = {"a": 0, "b": 1, "c": 2}
    rows = [dict(license_number=k) for k in fails]
    rows += [dict(license_number=k, results="Fail") for k, n in fails.items() for _ in range(n)]
    mart = build_mart(staged(spark, rows)).select("license_number", "repeat_fail_flag").distinct()
    assert {tuple(r) for r in mart.collect()} == {("a", False), ("b", False), ("c", True)}


def test_same_day_order_is_by_id(spark):
    days = ["03/10/2020", "03/01/2020", "03/10/2020"]
    mart = build_mart(staged(spark, [dict(inspection_date=d) for d in days]))
    assert column(mart, "days_since_previous_inspection") == [9, None, 0]


def test_undated_row_comes_last(spark):
    rows = [dict(inspection_date=None), dict(inspection_date="03/01/2020"), dict(inspection_date="03/05/2020")]
    staging = staged(spark, rows)
    assert column(build_mart(staging), "days_since_previous_inspection") == [None, None, 4]
    previous = history.previous_inspection(staging)
    assert column(previous, "previous_inspection_date") == [dt.date(2020, 3, 5), None, dt.date(2020, 3, 1)]


def test_rows_without_licence_stand_alone(spark):
    rows = [dict(license_number=None, results="Fail") for _ in range(3)]
    mart = build_mart(staged(spark, rows))
    for name, value in {
        "license_total_inspections": 1, "license_total_fails": 0, "license_total_passes": 0,
        "repeat_fail_flag": False, "days_since_previous_inspection": None, "fail_flag": 1,
    }.items():
        assert column(mart, name) == [value] * 3


def test_licence_text_is_not_normalised(spark):
    mart = build_mart(staged(spark, [dict(license_number=x) for x in ("12", " 12", "012")]))
    assert column(mart, "license_total_inspections") == [1, 1, 1]


def test_staging_keeps_every_row_and_drops_location(spark):
    staging = staged(spark, [dict(), dict(city="X", results=None)])
    assert staging.count() == 2 and len(staging.columns) == 23
    assert "location" not in staging.columns


@pytest.fixture(scope="module")
def demo(spark):
    return raw_inspections(spark, SF)


def test_mart_properties(spark, demo):
    staging = build_staging(demo)
    mart = build_mart(staging)
    inside = staging.where(~F.col("flag_out_of_jurisdiction")).count()
    totals = mart.agg(
        F.count("*"), F.count_distinct("inspection_id"), F.max(F.col("pass_flag") + F.col("fail_flag"))
    ).first()
    assert tuple(totals) == (inside, inside, 1)


def test_mart_does_not_depend_on_input_order(spark, demo):
    def rows(df):
        return sorted(map(repr, build_mart(build_staging(df)).collect()))

    first = rows(demo)
    assert rows(demo) == first
    assert rows(demo.repartition(7).orderBy(F.rand(3))) == first
    assert rows(demo.coalesce(1)) == first
