"""Records of split files against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from plateward.sources import inspections_csv as source, split_records
from test_csv import HEADER, LOADED_AT, record, write


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes, as a large file has splits of many megabytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in names:
        spark.conf.set(name, "300")
    yield
    for name in names:
        spark.conf.unset(name)


def rows(df):
    return sorted(map(repr, df.collect()))


def some_records(rng, n):
    def text():
        kind = rng.random()
        if kind < 0.3:
            return '"' + "\n".join("line " * rng.randint(0, 4) for _ in range(rng.randint(1, 5))) + '"'
        if kind < 0.4:
            return '"' + "long \n" * rng.randint(50, 200) + '"'
        if kind < 0.6:
            return '"said ""so"", and\n""left"""'
        return rng.choice(["Cafe", "", '""', "Ümlaut 漢字", '"a,b"'])

    return [record(str(k), name=text(), place=text()) for k in range(n)]


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    for k in range(3):
        lines = [HEADER, *some_records(rng, (0, 40, 25)[k])]
        text = end.join(x.replace("\n", end) for x in lines) + rng.choice(["", end, end + end])
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
    whole = source.read_inspections(spark, str(tmp_path), ingested_at=LOADED_AT)
    split = source.read_inspections(spark, str(tmp_path), ingested_at=LOADED_AT, split_files=True)
    assert split.schema == whole.schema
    assert rows(split) == rows(whole) and whole.count() > 0


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = write(tmp_path, *some_records(random.Random(5), 60))
    lines = split_records._lines(spark, path)
    assert lines.rdd.getNumPartitions() > 20
    parsed = source.read_inspections(spark, path, split_files=True)
    assert parsed.count() == 60
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "BroadcastHashJoin" in plan
    # Nothing but fragments is shuffled.
    wide = [x for x in plan.split("== Initial Plan ==")[0].splitlines() if "Exchange hashpartitioning" in x]
    assert all("file#" in x for x in wide)


def test_bad_records_are_marked_alike(spark, tmp_path, small_splits):
    good = record("1", name='"two\nlines"')
    path = write(tmp_path, good, good + ",extra", record("no. 7"), ",".join(["3"] * 4), record("5"))
    whole = source.read_inspections(spark, path, ingested_at=LOADED_AT)
    split = source.read_inspections(spark, path, ingested_at=LOADED_AT, split_files=True)
    columns = ["inspection_id", "dba_name", "reject_reason"]
    assert rows(split.select(*columns)) == rows(whole.select(*columns))
    assert split.where(F.col("reject_reason").isNotNull()).count() == 2


def test_a_lone_quote_is_refused(spark, tmp_path):
    path = write(tmp_path, record("1", name='12" pipe'), record("2"))
    with pytest.raises(ValueError, match="odd number of quotes.*part.csv"):
        source.read_inspections(spark, path, split_files=True)


def test_empty_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    write(tmp_path, name="header.csv")
    assert source.read_inspections(spark, str(tmp_path), split_files=True).count() == 0
