"""The daily address file, run dates, staging appends and JDBC options."""

from datetime import date

import pytest

from dealerlake import schemas as S
from dealerlake.sources import (
    address_file_path,
    created_on,
    laid_out,
    read_address_file,
    read_jdbc_table,
    rejects,
    resolve_run_date,
    write_address_file,
)
from dealerlake.sources.address_files import FIELDS, LINE_ORDER, MALFORMED

DAY = date(2026, 3, 27)
HEADER = "id|@~customer_id|@~address|@~city|@~province|@~created_at"


def put(folder, *lines):
    (folder / "customer_address_20260327.csv").write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")


def test_file_name():
    assert address_file_path("/data/", DAY) == "/data/customer_address_20260327.csv"


def test_fields_are_plain_text(spark, tmp_path):
    put(
        tmp_path,
        '1|@~007|@~"Jl. Mawar|@~ Bekasi |@~Jawa Barat|@~2026-03-01 14:24:40.012',
        "2|@~8|@~Jl \\ é | @~ x|@~|@~Jawa|@~2026-03-01",
    )
    rows = read_address_file(spark, str(tmp_path), DAY).select(*FIELDS, MALFORMED).collect()
    assert [tuple(r) for r in rows] == [
        ("1", "007", '"Jl. Mawar', " Bekasi ", "Jawa Barat", "2026-03-01 14:24:40.012", None),
        ("2", "8", "Jl \\ é | @~ x", None, "Jawa", "2026-03-01", None),
    ]


def test_short_and_long_lines_are_flagged(spark, tmp_path):
    short, long = "1|@~2|@~3|@~4|@~5", "1|@~2|@~3|@~4|@~5|@~6|@~7"
    put(tmp_path, short, "1|@~2|@~3|@~4|@~5|@~6", long)
    rows = read_address_file(spark, str(tmp_path), DAY).select(*FIELDS, MALFORMED).collect()
    assert [r[MALFORMED] for r in rows] == [short, None, long]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_address_file(spark, str(tmp_path), DAY)


def test_line_order_follows_the_file_over_many_splits(spark, tmp_path):
    put(tmp_path, *[f"{i}|@~{i}|@~{'x' * (i % 50)}|@~c|@~p|@~t" for i in range(3000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_address_file(spark, str(tmp_path), DAY)
        assert lines.rdd.getNumPartitions() > 8
        assert [r.id for r in lines.orderBy(LINE_ORDER).collect()] == [str(i) for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_round_trip(spark, tmp_path):
    rows = [
        ("1", "7", '"quoted" \\ text|', " padded ", None, "2026-03-01 14:24:40.012"),
        ("2", "8", "#c", "'", "é", "x"),
    ]
    frame = spark.createDataFrame(rows, ",".join(f"{f} string" for f in FIELDS))
    path = write_address_file(frame, str(tmp_path), DAY)
    assert path == address_file_path(str(tmp_path), DAY)
    back = read_address_file(spark, str(tmp_path), DAY)
    assert [tuple(r) for r in back.orderBy(LINE_ORDER).select(*FIELDS, MALFORMED).collect()] == [(*r, None) for r in rows]


def test_run_dates():
    assert resolve_run_date("2026-03-27") == DAY
    assert resolve_run_date("2026-03-27T08:00:00+00:00") == DAY
    assert resolve_run_date("2026-03-28", requested="2026-03-27") == DAY
    for bad in ("2026-02-30", "27-03-2026", ""):
        with pytest.raises(ValueError):
            resolve_run_date(bad)


def test_rows_of_no_day_hold_up_no_other_day(spark):
    sale = ("v", "c", "m", "2026-03-27", "1")
    times = ["2026-03-27 23:59:59.999", "2026-03-28 00:00:00", None, "soon"]
    staged = laid_out(spark.createDataFrame([(*sale, t) for t in times], S.STG_SALES.struct), S.STG_SALES, "b1")
    assert [r.created_at for r in created_on(staged, DAY).collect()] == ["2026-03-27 23:59:59.999"]
    assert sorted((r.created_at or "", r.reason, r.batch) for r in rejects(staged).collect()) == [
        ("", "no creation time", "b1"),
        ("soon", "unreadable creation time", "b1"),
    ]


def test_unreadable_creation_time_fails_where_rows_are_not_laid_out(spark):
    rows = spark.createDataFrame([("v", "c", "m", "2026-03-27", "1", "soon")], S.STG_SALES.struct)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        created_on(rows, DAY).collect()


def test_jdbc_needs_bounds_to_split(spark):
    with pytest.raises(ValueError, match="bounds"):
        read_jdbc_table(spark, "jdbc:mysql://db/dwh", "stg_sales_raw", split_column="id", partitions=8)


def test_jdbc_reads_no_table_through_one_task_unasked(spark):
    with pytest.raises(ValueError, match="small"):
        read_jdbc_table(spark, "jdbc:mysql://db/dwh", "stg_sales_raw")


def test_jdbc_without_a_driver_fails_at_once(spark):
    with pytest.raises(ConnectionError, match="stg_sales_raw"):
        read_jdbc_table(spark, "jdbc:mysql://db/dwh", "stg_sales_raw", small=True)
