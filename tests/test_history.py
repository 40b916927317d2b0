"""Licence history under skew, against a plain sequential computation."""

import datetime as dt
import random

import pytest

from plateward.operators import history
from plateward.operators.running import running_before

SCHEMA = "inspection_id bigint, license_number string, inspection_date date, results string"
PASSES = ("Pass", "Pass w/ Conditions")


def _cases(n=1500, seed=5):
    """A third of all rows belongs to one licence, and most of those to one day."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        # Ids are sparse, and not in date order.
        number = (i * 7919) % n * 2**30
        hot = i % 3 == 0
        licence = "hot" if hot else pick.choice([None, *map(str, range(40))])
        day = dt.date(2020, 1, 1) + dt.timedelta(days=0 if hot and i % 2 else pick.randrange(60))
        rows.append(
            (number, licence, pick.choice([day, day, day, None]), pick.choice(["Pass", "Fail", "No Entry", *PASSES, None]))
        )
    return rows


def _by_licence(rows):
    groups = {}
    for row in rows:
        if row[1] is not None:
            groups.setdefault(row[1], []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[2] is None, r[2] or dt.date.min, r[0]))
    return groups


@pytest.fixture(scope="module", params=["broadcast", "shuffle"])
def inspections(spark, request):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = _cases()
    yield rows, spark.createDataFrame(rows, SCHEMA).repartition(6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_previous_inspection(inspections):
    rows, df = inspections
    expected = {}
    for group in _by_licence(rows).values():
        for before, row in zip([None, *group], group):
            expected[row[0]] = before and before[2]
    found = {r.inspection_id: r.previous_inspection_date for r in history.previous_inspection(df).collect()}
    assert found == expected


def test_totals_on_every_row(inspections):
    rows, df = inspections
    groups = _by_licence(rows)
    joined = history.attach_license_days(df).collect()
    assert len(joined) == len(rows)
    for r in joined:
        if r.license_number is None:
            assert r.total_inspections is None and r.previous_inspection_date is None
            continue
        group = groups[r.license_number]
        assert r.total_inspections == len(group)
        assert r.total_fails == sum(x[3] == "Fail" for x in group)
        assert r.total_passes == sum(x[3] in PASSES for x in group)


def test_license_history(inspections):
    rows, df = inspections
    found = {r.license_number: r.total_inspections for r in history.license_history(df).collect()}
    assert found == {k: len(g) for k, g in _by_licence(rows).items()}


def test_history_as_of_the_row(inspections):
    rows, df = inspections
    expected = {r[0]: (0, 0, 0) for r in rows}
    for group in _by_licence(rows).values():
        for i, row in enumerate(group):
            earlier = group[:i]
            expected[row[0]] = (
                i, sum(x[3] == "Fail" for x in earlier), sum(x[3] in PASSES for x in earlier)
            )
    found = {
        r.inspection_id: (r.prior_inspections, r.prior_fails, r.prior_passes)
        for r in history.license_history_asof(df).collect()
    }
    assert found == expected


def test_history_as_of_example(spark):
    days = [dt.date(2020, 1, d) for d in (1, 2, 3)]
    rows = [(i, "a", day, r) for i, (day, r) in enumerate(zip(days, ("Fail", "Pass", "Fail")))]
    df = spark.createDataFrame(rows, SCHEMA)
    prior = history.license_history_asof(df).orderBy("inspection_id").collect()
    assert [r.prior_fails for r in prior] == [0, 1, 1]
    assert [r.total_fails for r in history.attach_license_days(df).collect()] == [2, 2, 2]


def test_no_window_holds_a_whole_licence(spark):
    """In the plan, no window over single inspections has the licence as its only key."""
    df = spark.createDataFrame(_cases(30), SCHEMA)
    for result in (history.attach_license_days(df), history.license_history_asof(df)):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        for line in (x for x in plan.splitlines() if "Window [" in x):
            spec = line.split("windowspecdefinition(")[1]
            if "inspection_id" in spec:
                assert "__part" in spec.split("ASC")[0]


def test_rows_without_id_or_date_are_kept(spark):
    rows = [(None, "a", None, "Fail"), (1, "a", dt.date(2020, 1, 1), "Fail"), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    prior = {(r.inspection_id, r.license_number): r.prior_fails for r in history.license_history_asof(df).collect()}
    assert prior == {(None, "a"): 1, (1, "a"): 0, (None, None): 0}
    assert history.attach_license_days(df).count() == 3


def test_running_before_with_one_level(spark):
    df = spark.createDataFrame([("a", 2, 10), ("a", 1, 5), ("b", 1, 7)], "k string, o int, v int")
    found = {tuple(r) for r in running_before(df, ["k"], ["o"], ["v"]).collect()}
    assert found == {("a", 1, 5, 0), ("a", 2, 10, 5), ("b", 1, 7, 0)}


@pytest.fixture
def several_parts(spark):
    """Ranges stay as many as the shuffle partitions, also of few rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_before_over_several_parts(spark, several_parts):
    pick = random.Random(9)
    rows = [("hot" if i % 3 else f"k{i % 7}", pick.choice([None, i * 2**30]), pick.randrange(9)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint").repartition(5)
    result = running_before(df, ["k"], ["o"], ["v"]).collect()
    for key in {r[0] for r in rows}:
        mine = [r for r in result if r["k"] == key]
        dated = sorted((r for r in mine if r["o"] is not None), key=lambda r: r["o"])
        undated = sorted((r for r in mine if r["o"] is None), key=lambda r: (r["v_before"], r["v"]))
        before = 0
        for r in [*undated, *dated]:  # NULL sorts first
            assert r["v_before"] == before
            before += r["v"]
    # A third of all rows in one key, spread over several parts.
    ranges = [path for path in running_before(df, ["k"], ["o"], ["v"]).inputFiles()]
    parts = spark.read.parquet(*ranges).where("k = 'hot'").groupBy("__part").count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 400


def test_history_over_several_parts(spark, several_parts):
    rows = _cases(600)
    expected = {}
    for group in _by_licence(rows).values():
        for k, row in enumerate(group):
            expected[row[0]] = (k, sum(r[3] == "Fail" for r in group[:k]))
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = history.license_history_asof(df).where("license_number IS NOT NULL").collect()
    assert {r.inspection_id: (r.prior_inspections, r.prior_fails) for r in found} == expected
