"""Plans that have to hold at scale: what is read, what is shuffled, what is split."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.operators import LoadRejected, dedupe_first_last, duplicate_keys, key_violations
from dealerlake.plans import (
    build_txf_customer_address,
    build_txf_customers,
    mart_cust_service_prio,
    mart_sales,
    mart_sales_rejects,
    typed_after_sales,
)
from dealerlake.sources import created_on
from dealerlake.warehouse import Warehouse

DAY = date(2025, 8, 2)
TS = datetime(2025, 8, 2, 8, 0)


@pytest.fixture
def settings(spark):
    """Set session values for one test."""
    before = {}

    def set_all(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    text = plan(frame)
    return text[: text.index("== Initial Plan ==")]


def shuffles(frame):
    return len(re.findall(r"Exchange hashpartitioning", plan(frame)))


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """Two days of sales, and some customers and addresses already loaded."""
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("scale") / "tables"), database="scale")
    people = spark.range(500).selectExpr(
        "CAST(id AS STRING) id", "concat('n', id) name", "'2001-01-01' dob", "'2025-08-01 10:00:00' created_at"
    )
    wh.append_staging(S.STG_CUSTOMERS, people)
    sales = spark.range(1000).selectExpr(
        "concat('V', id) vin",
        "CAST(id AS STRING) customer_id",
        "'VELOS' model",
        "IF(id < 600, '2025-08-01', '2025-08-02') invoice_date",
        "'390.000.000' price",
        "IF(id < 600, '2025-08-01 10:00:00', '2025-08-02 10:00:00') created_at",
    )
    wh.append_staging(S.STG_SALES, sales)
    services = spark.range(1000).selectExpr(
        "concat('T', id) service_ticket",
        "'V' vin",
        "CAST(id AS STRING) customer_id",
        "'VELOS' model",
        "'2025-08-01' service_date",
        "'PM' service_type",
        "IF(id < 600, '2025-08-01 10:00:00', '2025-08-02 10:00:00') created_at",
    )
    wh.append_staging(S.STG_AFTER_SALES, services)
    wh.load_txf_after_sales(date(2025, 8, 1))
    wh.load_txf_customers(date(2025, 8, 1))
    wh.load_txf_sales(date(2025, 8, 1))
    return wh


@pytest.fixture(autouse=True)
def full_paths(settings):
    settings(maxMetadataStringLength="2000", debug__maxToStringFields="100")


def test_daily_load_reads_only_its_day_of_staging(warehouse):
    scan = plan(created_on(warehouse.store.read(S.STG_SALES), DAY))
    assert "created_date=2025-08-02" in scan
    assert "created_date=2025-08-01" not in scan


def test_upsert_does_not_shuffle_its_target(warehouse, settings):
    settings(autoBroadcastJoinThreshold="-1")
    staged, target = warehouse.store.read(S.STG_CUSTOMERS), warehouse.store.read(S.TXF_CUSTOMERS)
    merged = build_txf_customers(staged, target, DAY, TS)
    assert shuffles(merged) == 1  # the deduplication of the staged rows
    assert "FullOuter" in plan(merged)


def test_each_bucket_of_a_loaded_table_is_one_file(warehouse):
    files = [path.rsplit("/", 1)[1] for path in warehouse.store.read(S.TXF_CUSTOMERS).inputFiles()]
    buckets = [re.search(r"_(\d{5})\.c000", name).group(1) for name in files]
    assert sorted(buckets) == [f"{n:05d}" for n in range(8)]


def test_a_run_is_written_without_a_shuffle_of_its_own(spark, warehouse, settings):
    """The upsert's own shuffle leaves each key where its bucket is written."""
    settings(autoBroadcastJoinThreshold="-1")
    staged, target = warehouse.store.read(S.STG_CUSTOMERS), warehouse.store.read(S.TXF_CUSTOMERS)
    run = warehouse.store.write_run(S.TXF_CUSTOMERS, build_txf_customers(staged, target, DAY, TS), from_upsert=True)
    try:
        files = warehouse.store.read_run(run).inputFiles()
        assert len(files) == 8
        ids = "CAST(regexp_extract(input_file_name(), '_([0-9]{5})[.]c000', 1) AS INT)"
        wrong = spark.read.parquet(run.path).where(f"pmod(hash(id), 8) <> {ids}")
        assert wrong.count() == 0
    finally:
        warehouse.store.discard(run)


def test_address_upsert_needs_no_shuffle_at_all(warehouse, settings):
    settings(autoBroadcastJoinThreshold="-1")
    staged, target = warehouse.store.read(S.STG_CUSTOMER_ADDRESS), warehouse.store.read(S.TXF_CUSTOMER_ADDRESS)
    assert shuffles(build_txf_customer_address(staged, target, DAY, TS)) == 0


def test_key_check_of_a_bucketed_table_needs_no_shuffle(warehouse):
    assert shuffles(duplicate_keys(warehouse.store.read(S.TXF_CUSTOMERS), ["id"])) == 0


def test_key_check_shuffles_the_batch_once_and_the_stored_table_never(spark, warehouse, tmp_path):
    stored = warehouse.store.read(S.TXF_SALES)
    rows = warehouse.store.read(S.STG_SALES).selectExpr("vin", "CAST(invoice_date AS DATE) invoice_date")
    rows.write.parquet(str(tmp_path / "run"))
    batch = spark.read.parquet(str(tmp_path / "run"))
    found = key_violations(stored, batch, S.TXF_SALES.key)
    assert found.count() == 600
    found.collect()
    final = final_plan(found)
    assert len(re.findall(r"[-:] Exchange hashpartitioning", final)) == 1
    assert "ReusedExchange" in final
    assert "BroadcastHashJoin" in final


def test_service_key_check_moves_no_stored_ticket(spark, warehouse, settings):
    """Stored tickets and the batch sit in the same buckets; only the batch is dealt to them."""
    settings(autoBroadcastJoinThreshold="-1")
    staged = warehouse.store.read(S.STG_AFTER_SALES).filter("service_ticket < 'T5'")
    batch = typed_after_sales(staged, TS)
    found = warehouse.ticket_violations(batch)
    stored = plan(key_violations(warehouse.store.read(S.TICKETS), batch.repartition(8, "service_ticket"), S.TXF_AFTER_SALES.key))
    assert "SortMergeJoin" in stored and "Bucketed: true" in stored
    assert len(re.findall(r"Exchange hashpartitioning\(service_ticket", stored)) == 2  # the batch's, in each of the two parts
    assert not re.search(r"Exchange[^\n]*\n[^\n]*(Filter|Project|FileScan)[^\n]*loaded_on", stored)
    assert found.count() == warehouse.store.read(S.TXF_AFTER_SALES).filter("service_ticket < 'T5'").count() > 0


def test_service_mart_splits_service_files_by_size_not_by_bucket(warehouse):
    services = warehouse.store.read(S.TXF_AFTER_SALES)
    text = plan(services.groupBy("vin", "customer_id").count())
    assert "FileScan parquet" in text and "Bucketed: true" not in text


def test_stored_keys_are_pruned_to_the_run(warehouse):
    """Catalog partitions outside the date and bucket filters of a key check are not listed."""
    stored = warehouse.store.read(S.TXF_SALES).filter((F.col("load_date") != F.lit(DAY)) & (F.col("inv_bucket") == "p2025"))
    text = plan(stored.filter(F.col("invoice_date").between(F.lit(DAY), F.lit(DAY))).select("vin", "invoice_date"))
    assert "PartitionFilters: [isnotnull(load_date" in text
    assert "GreaterThanOrEqual(invoice_date,2025-08-02)" in text


def scanned(frame):
    """Rows that came out of a frame's only scan, before any filter."""
    frame.collect()
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_a_small_batch_of_vehicles_skips_row_groups(spark, tmp_path, settings, monkeypatch):
    """Its vehicles lie anywhere, so no range skips a file; the Bloom filters do."""
    settings(files__maxRecordsPerFile="200")
    wh = Warehouse(spark, str(tmp_path / "tables"), database="bloom")
    rows = lambda n, salt, day: spark.range(n).selectExpr(
        f"substring(sha2(concat('{salt}', id), 256), 1, 20) vin", "'c' customer_id", "'VELOS' model",
        "'2025-08-01' invoice_date", "'390.000.000' price", f"'{day} 10:00:00' created_at",
    )
    wh.append_staging(S.STG_SALES, rows(4000, "a", "2025-08-01"))
    wh.load_txf_sales(date(2025, 8, 1))
    asked, stored_sales = [], wh._stored_sales
    monkeypatch.setattr(wh, "_stored_sales", lambda *args: asked.append(stored_sales(*args)) or asked[-1])
    wh.append_staging(S.STG_SALES, rows(5, "b", "2025-08-02"))
    wh.load_txf_sales(DAY)
    everything = wh.store.read(S.TXF_SALES).filter("load_date = DATE'2025-08-01'")
    assert scanned(everything) == 4000
    assert scanned(asked[0]) < 2000
    wh.append_staging(S.STG_SALES, rows(5, "a", "2025-08-03"))
    with pytest.raises(LoadRejected, match="5 keys in 5 rows already stored"):
        wh.load_txf_sales(date(2025, 8, 3))
    wh.store.drop_entries()


def test_the_largest_invoice_range_is_written_by_several_tasks(spark, tmp_path, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="20KB", adaptive__coalescePartitions__minPartitionSize="1KB")
    wh = Warehouse(spark, str(tmp_path / "tables"), database="ranges")
    wh.append_staging(S.STG_SALES, spark.range(20000).selectExpr(
        "sha2(CAST(id AS STRING), 0) long", "id",
    ).selectExpr("substring(long, 1, 20) vin", "substring(long, 1, 40) customer_id", "'VELOS' model",
                 "IF(id % 50 = 0, '2023-01-05', '2025-08-01') invoice_date", "'390.000.000' price", "'2025-08-02 10:00:00' created_at"))
    wh.load_txf_sales(DAY)
    sales = wh.store.read(S.TXF_SALES)
    places = sales.select("inv_bucket", F.input_file_name().alias("file")).distinct()
    files = {r.inv_bucket: r["count"] for r in places.groupBy("inv_bucket").count().collect()}
    assert max(files.values()) >= 4 and min(files.values()) <= 2 and sales.count() == 20000
    only = sales.filter(F.col("inv_bucket") == min(files, key=files.get))
    assert "PartitionFilters: [isnotnull(inv_bucket" in plan(only) and scanned(only) == only.count() == 400
    wh.store.drop_entries()


def test_marts_read_only_the_columns_they_need(warehouse):
    text = plan(mart_sales(warehouse.store.read(S.TXF_SALES)))
    assert "ReadSchema: struct<model:string,invoice_date:date,price:decimal(38,5)>" in text
    assert "HashAggregate" in text and "partial_sum" in text


def test_rejected_sales_are_found_by_skipping_row_groups(warehouse):
    text = plan(mart_sales_rejects(warehouse.store.read(S.TXF_SALES)))
    assert "LessThan(price,100000000.00000)" in text.split("PushedFilters")[1]


def test_first_last_reduces_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("'hot' AS k", "id AS a", "id AS b", "id AS at")
    one = dedupe_first_last(rows, "k", "at", first=["a"])
    assert [tuple(r) for r in one.collect()] == [("hot", 0, 999)]
    assert "partial_max_by" in plan(one)


def test_a_customer_with_a_third_of_all_groups_is_split(spark, settings):
    """Both joins of the service mart cut the hot customer's partition up, and lose nothing."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__minPartitionSize="1KB",
    )
    services = spark.range(60000).selectExpr(
        "concat('V', id) AS vin",
        "CASE WHEN id % 3 = 0 THEN 'fleet' ELSE CAST(id % 5000 AS STRING) END AS customer_id",
        "DATE'2025-01-01' AS service_date",
    )
    people = spark.range(5000).selectExpr("CAST(id AS STRING) AS id", "concat('n', id) AS name")
    people = people.unionByName(spark.sql("SELECT 'fleet' AS id, 'Fleet' AS name"))
    places = people.selectExpr("id AS customer_id", "concat('street of ', name) AS address")
    mart = mart_cust_service_prio(services, people, places)
    rows = mart.collect()
    assert len(rows) == 60000
    assert sum(r.customer_name == "Fleet" for r in rows) == 20000
    assert {r.address for r in rows if r.customer_name == "Fleet"} == {"street of Fleet"}
    assert final_plan(mart).count("SortMergeJoin(skew=true)") == 2
