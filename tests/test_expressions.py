"""Expressions against Python on generated texts, and the pieces without a query."""

import csv
import io
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import DataFrameWriter, functions as F

from plateward.functions.inspection import us_date
from plateward.functions.text import clean_upper, normal_form, part_count
from plateward.operators import history, profile
from plateward.plans.mart import build_mart
from plateward.sources import tables
from plateward.sources.inspections_csv import field_count
from rows import column, staged

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXTS = st.lists(st.text(st.sampled_from("aZ9 |,\"'\n#1é/"), max_size=12), min_size=1, max_size=60)


def results(spark, texts, expression):
    rows = [(i, t) for i, t in enumerate(texts)]
    return column(spark.createDataFrame(rows, "i int, t string").select("i", expression(F.col("t")).alias("r")), "r", "i")


@FEW
@given(TEXTS)
def test_part_count(spark, texts):
    assert results(spark, texts, part_count) == [t.count("|") + 1 for t in texts]


@FEW
@given(TEXTS)
def test_normal_form(spark, texts):
    assert results(spark, texts, normal_form) == [re.sub("[^A-Z0-9]", "", t.upper()) or None for t in texts]


@FEW
@given(TEXTS)
def test_clean_upper(spark, texts):
    assert results(spark, texts, clean_upper) == [t.strip(" ").upper() for t in texts]


@FEW
@given(st.lists(st.lists(st.text(st.sampled_from("a,\"\n "), max_size=5), min_size=1, max_size=6), min_size=1, max_size=40))
def test_field_count(spark, records):
    lines = []
    for cells in records:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(cells)
        lines.append(out.getvalue())
    assert results(spark, lines, field_count) == [len(cells) for cells in records]


def test_us_date_rejects_other_texts(spark):
    texts = ["2020-01-02", "13/01/2020", "1/2", "1/2/20x", "x", " "]
    assert results(spark, texts, us_date) == [None] * len(texts)


def test_approximate_profile(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("many"), (F.col("id") % 7).cast("string").alias("few")
    )
    for exact in (True, False):
        found = {r.column_name: r for r in profile.column_profile(df, ["many", "few"], exact=exact).collect()}
        assert (found["many"].nulls, found["many"].null_pct, found["few"].nulls) == (1000, 20.0, 0)
        assert found["few"].distinct_values == 7
        assert abs(found["many"].distinct_values - 4000) <= (0 if exact else 600)


def test_variants(spark):
    names = ["McDonald's", "MCDONALDS", "McDonald's", "Wendys", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [tuple(r) for r in profile.variants(df, "n").collect()] == [("MCDONALDS", 2, 3, 1)]


def test_calendar_fills_gaps(spark):
    mart = build_mart(staged(spark, [dict(inspection_date=d) for d in ("02/27/2020", None, "03/02/2020")]))
    assert column(profile.calendar(mart), "day_of_month", "day") == [27, 28, 29, 1, 2]


def test_point_in_time_mart(spark):
    rows = [dict(inspection_date=f"01/0{d}/2020", results="Fail") for d in (1, 2, 3)] + [dict(license_number=None)]
    mart = build_mart(staged(spark, rows))
    then = history.point_in_time(mart)
    assert then.dtypes == mart.dtypes
    assert column(mart, "license_total_fails") == [3, 3, 3, 0]
    assert column(then, "license_total_fails") == [0, 1, 2, 0]
    assert column(then, "repeat_fail_flag") == [False, False, True, False]
    assert column(then, "days_since_previous_inspection") == [None, 1, 1, None]


def test_database_sink_options(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **given: seen.update(given) or self)
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, mode: seen.update(mode=mode) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: None)
    tables.write_database_table(spark.range(1), "jdbc:some://host/db", "raw.inspections", user="u")
    assert seen == {
        "mode": "overwrite", "url": "jdbc:some://host/db", "dbtable": "raw.inspections",
        "truncate": True, "batchsize": 5000, "user": "u",
    }
