"""CSV files with the dirt that real extracts have."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plateward.sources import inspections_csv as source
from plateward.values import MISSING_TOKENS, RAW_COLUMNS

HEADER = ",".join(f'"Column {i}"' for i in range(17))
LOADED_AT = datetime(2026, 1, 1, 6)


def record(number="1", name="Cafe", licence="7", place="", lat="41.5", **_):
    cells = [number, name, "aka", licence, "Restaurant", "Risk 1 (High)", "1 Main St", "CHICAGO", "IL",
             "60601", "01/02/2020", "Canvass", "Pass", "1. dirty", lat, "-87.5", place]
    return ",".join(cells)


def write(folder, *lines, header=HEADER, name="part.csv"):
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def read(spark, folder, **options):
    return source.read_inspections(spark, folder, ingested_at=LOADED_AT, **options)


def test_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path, record(name='"Joe ""The Cook"", Inc"'), record("2", name='"two\nlines | x"'))
    rows = source.accepted(read(spark, path)).orderBy("inspection_id").collect()
    assert [r.dba_name for r in rows] == ['Joe "The Cook", Inc', "two\nlines | x"]


def test_types_and_leading_zeros(spark, tmp_path):
    row = source.accepted(read(spark, write(tmp_path, record(licence="0012")))).first()
    assert (row.inspection_id, row.license_number, row.zip, row.latitude) == (1, "0012", "60601", 41.5)
    assert row.ingested_at == LOADED_AT and row.location is None


@pytest.mark.parametrize("token", MISSING_TOKENS)
def test_missing_tokens(spark, token):
    df = spark.createDataFrame([(token, 1), ("kept", 2)], "a string, b int")
    assert [r.a for r in source.nullify(df).orderBy("b").collect()] == [None, "kept"]


def test_missing_token_in_a_number_column_is_null(spark, tmp_path):
    row = read(spark, write(tmp_path, record(number="NA", lat='"N/A"'))).first()
    assert (row.inspection_id, row.latitude, row.reject_reason) == (None, None, None)


def test_quoted_empty_is_null(spark, tmp_path):
    assert read(spark, write(tmp_path, record(name='""'))).first().dba_name is None


def test_tokens_can_be_chosen(spark, tmp_path):
    path = write(tmp_path, record(name="NA"))
    assert read(spark, path).first().dba_name is None
    assert read(spark, path, tokens=[""]).first().dba_name == "NA"


def test_bad_records_are_set_aside(spark, tmp_path):
    long, short = record("3", place="a,b"), ",".join(record("4").split(",")[:12])
    path = write(tmp_path, record("1"), record("x2"), long, short, record("5", lat="north"), record("6"))
    records = read(spark, path)
    assert [r.inspection_id for r in source.accepted(records).orderBy("inspection_id").collect()] == [1, 4, 6]
    bad = {(r.reject_reason, r.record) for r in source.rejected(records).collect()}
    assert {reason for reason, _ in bad} == {
        "too many fields", "inspection_id is not a number", "latitude is not a number"
    }
    assert ("too many fields", long) in bad


def test_short_rows(spark, tmp_path):
    path = write(tmp_path, ",".join(record("4").split(",")[:12]), record("5"))
    kept = source.accepted(read(spark, path)).orderBy("inspection_id").collect()
    assert [r.inspection_id for r in kept] == [4, 5]
    assert kept[0].inspection_type == "Canvass" and kept[0].results is None
    bad = source.rejected(read(spark, path, keep_short_rows=False)).collect()
    assert [r.reject_reason for r in bad] == ["too few fields"]


def test_counting_reasons_needs_no_other_column(spark, tmp_path):
    """Column pruning must not change which records are bad."""
    path = write(tmp_path, record("1"), record("2", place="a,b"), record("3", place=","))
    counts = read(spark, path).groupBy("reject_reason").count().collect()
    assert {tuple(r) for r in counts} == {(None, 1), ("too many fields", 2)}


@pytest.mark.parametrize("width", [16, 18])
def test_another_width_is_an_error(spark, tmp_path, width):
    header = ",".join(f"c{i}" for i in range(width))
    with pytest.raises(ValueError, match=f"\\({width}\\)"):
        read(spark, write(tmp_path, record(), header=header))


def test_rename_positional(spark):
    df = spark.range(1).select(*(F.col("id").alias(f"c{i}") for i in range(17)))
    assert source.rename_positional(df).columns == list(RAW_COLUMNS)
    with pytest.raises(ValueError):
        source.rename_positional(df.drop("c3"))


def test_several_files(spark, tmp_path):
    write(tmp_path, record("1"), name="a.csv")
    path = write(tmp_path, record("2"), record("3"), name="b.csv")
    assert source.accepted(read(spark, path)).count() == 3


def test_field_count(spark):
    texts = {"a,b": 2, '"a,b",c': 2, '"a"",""b",c,': 3, "": 1, '"x\n,y"': 1}
    df = spark.createDataFrame(list(texts.items()), "t string, n int")
    assert all(r.n == r.found for r in df.select("n", source.field_count(F.col("t")).alias("found")).collect())


def test_files_of_another_width_are_named(spark, tmp_path):
    fields = HEADER.split(",")
    (tmp_path / "a.csv").write_text("\n".join([HEADER, record("1"), record("2")]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([",".join(fields[:-1]), record("3")]) + "\n")
    (tmp_path / "c.csv").write_text("\n".join([HEADER + ",More", record("4")]) + "\n")
    for keep in (True, False):
        with pytest.raises(ValueError) as raised:
            source.read_inspections(spark, str(tmp_path), keep_short_rows=keep)
        assert "b.csv" in str(raised.value) and "c.csv" in str(raised.value) and "a.csv" not in str(raised.value)


def test_other_names_of_the_right_number_are_accepted(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, record("1")]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEADER.upper() + "X", record("2")]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    for multi_line in (True, False):
        records = source.read_inspections(spark, str(tmp_path), multi_line=multi_line)
        assert sorted(r.inspection_id for r in source.accepted(records).collect()) == [1, 2]


def test_a_header_further_down_does_not_excuse_the_first_line(spark, tmp_path):
    write(tmp_path, record(), name="good.csv")
    narrow = ",".join(f"c{i}" for i in range(16))
    write(tmp_path, record(), HEADER, record("2"), header=narrow, name="joined.csv")
    with pytest.raises(ValueError, match=r"joined\.csv \(16\)"):
        read(spark, str(tmp_path))
