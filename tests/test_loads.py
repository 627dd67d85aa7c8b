"""Loading through the catalog: reruns, rejected loads and what they leave behind."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from itertools import count

import pytest
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.operators import LoadRejected, tally
from dealerlake.warehouse import Warehouse

DAY = date(2025, 8, 2)
NEXT = DAY + timedelta(days=1)
_names = count()


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"), database=f"loads_{next(_names)}", buckets=4)


def sale(vin, day=DAY, price="390.000.000", created=None, model="VELOS", customer="6"):
    return (vin, customer, model, str(day), price, created or f"{day} 10:00:00.012")


def stage(wh, table, *rows):
    wh.append_staging(table, wh.spark.createDataFrame(list(rows), table.struct))


def restage_customers(wh, *rows):
    """Replace the raw customer table, which its owner may do between two loads."""
    path = f"{wh.store.root}/restaged-{next(_names)}"
    wh.spark.createDataFrame(list(rows), S.STG_CUSTOMERS.struct).write.parquet(path)
    wh.spark.sql(f"ALTER TABLE {wh.store.name(S.STG_CUSTOMERS)} SET LOCATION '{path}'")


def loaded(wh, table=S.TXF_SALES):
    """Key -> date of load."""
    key = table.key[0]
    return {r[key]: r.load_timestamp.date() for r in wh.table(table).collect()}


def put_addresses(tmp_path, day, *rows):
    header = "id|@~customer_id|@~address|@~city|@~province|@~created_at"
    lines = [header, *["|@~".join(row) for row in rows]]
    (tmp_path / f"customer_address_{day:%Y%m%d}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


def address(id, customer, street="Jl A", city="Bekasi", province="Jawa Barat"):
    return (id, customer, street, city, province, "2026-03-01 14:24:40.012")


# --- facts -----------------------------------------------------------------------------------


def test_daily_load_takes_the_rows_created_that_day(wh):
    stage(wh, S.STG_SALES, sale("a"), sale("b", NEXT), sale("late", DAY, created=f"{NEXT} 00:00:00"))
    assert wh.load_txf_sales(DAY).rows_written == 1
    assert loaded(wh) == {"a": DAY}
    wh.load_txf_sales(NEXT)
    assert loaded(wh) == {"a": DAY, "b": NEXT, "late": NEXT}


def test_daily_load_again_replaces_exactly_its_own_rows(wh):
    stage(wh, S.STG_SALES, sale("a"), sale("old", date(2022, 5, 1), created=f"{DAY} 09:00:00"), sale("b", NEXT))
    wh.load_txf_sales(DAY)
    wh.load_txf_sales(NEXT)
    before = sorted(map(tuple, wh.table(S.TXF_SALES).drop("load_timestamp").collect()))
    wh.load_txf_sales(DAY)
    assert sorted(map(tuple, wh.table(S.TXF_SALES).drop("load_timestamp").collect())) == before
    assert loaded(wh) == {"a": DAY, "old": DAY, "b": NEXT}


def test_rows_gone_from_staging_leave_their_bucket_on_a_rerun(wh, tmp_path):
    stage(wh, S.STG_SALES, sale("a"), sale("old", date(2022, 5, 1), created=f"{DAY} 09:00:00"))
    wh.load_txf_sales(DAY)
    kept = str(tmp_path / "kept")
    wh.store.read(S.STG_SALES).filter("vin = 'a'").drop("created_date").write.parquet(kept)
    wh.spark.sql(
        f"ALTER TABLE {wh.store.name(S.STG_SALES)} PARTITION (created_date=DATE'{DAY}') SET LOCATION '{kept}'"
    )
    wh.load_txf_sales(DAY)
    assert loaded(wh) == {"a": DAY}


def test_empty_day_empties_only_its_own_load(wh, tmp_path):
    stage(wh, S.STG_SALES, sale("a"), sale("b", NEXT))
    wh.load_txf_sales(DAY)
    wh.load_txf_sales(NEXT)
    empty = str(tmp_path / "empty")
    wh.store.read(S.STG_SALES).filter("false").drop("created_date").write.parquet(empty)
    wh.spark.sql(
        f"ALTER TABLE {wh.store.name(S.STG_SALES)} PARTITION (created_date=DATE'{DAY}') SET LOCATION '{empty}'"
    )
    report = wh.load_txf_sales(DAY)
    assert (report.rows_read, report.rows_written) == (0, 0)
    assert loaded(wh) == {"b": NEXT}


def test_a_day_with_nothing_staged_is_no_error(wh):
    assert wh.load_txf_sales(DAY).rows_written == 0
    assert wh.load_txf_after_sales(DAY).rows_written == 0
    assert wh.table(S.TXF_SALES).count() == 0


def test_initial_load_appends_everything_once(wh):
    stage(wh, S.STG_SALES, sale("a"), sale("b", NEXT))
    wh.load_txf_sales(date(2025, 1, 1), initial_load=True)
    assert loaded(wh) == {"a": date(2025, 1, 1), "b": date(2025, 1, 1)}
    with pytest.raises(LoadRejected, match="already stored"):
        wh.load_txf_sales(date(2025, 1, 1), initial_load=True)
    assert len(loaded(wh)) == 2


def test_second_initial_load_of_new_rows_keeps_the_first(wh, tmp_path):
    stage(wh, S.STG_SALES, sale("a"))
    wh.load_txf_sales(DAY, initial_load=True)
    other = str(tmp_path / "other")
    wh.spark.createDataFrame([sale("b"), sale("c", date(2021, 1, 1))], S.STG_SALES.struct).write.parquet(other)
    wh.spark.sql(
        f"ALTER TABLE {wh.store.name(S.STG_SALES)} PARTITION (created_date=DATE'{DAY}') SET LOCATION '{other}'"
    )
    wh.load_txf_sales(DAY, initial_load=True)
    assert loaded(wh) == {"a": DAY, "b": DAY, "c": DAY}
    assert wh.store.read(S.TXF_SALES).select("inv_bucket").distinct().count() == 2


def test_a_daily_load_on_the_date_of_an_initial_one_replaces_it(wh):
    """Why an initial load is stamped with a date that no daily load uses."""
    stage(wh, S.STG_SALES, sale("a"), sale("b", NEXT))
    wh.load_txf_sales(NEXT, initial_load=True)
    wh.load_txf_sales(NEXT)
    assert loaded(wh) == {"b": NEXT}


def test_daily_stamp_must_lie_on_the_run_date(wh):
    with pytest.raises(ValueError, match="stamped"):
        wh.load_txf_sales(DAY, load_ts=datetime(2025, 8, 3, 8, 0))


@pytest.mark.parametrize(
    "bad, reason",
    [
        ([sale("x"), sale("x")], "repeated in batch"),
        ([sale("old")], "already stored"),
        ([sale(None)], "vin is null"),
        ([sale("x" * 26)], "vin longer than 25"),
    ],
)
def test_rejected_sales_change_nothing(wh, bad, reason):
    earlier = DAY - timedelta(days=1)
    stage(wh, S.STG_SALES, sale("old", DAY, created=f"{earlier} 10:00:00"), sale("a"))
    wh.load_txf_sales(earlier)
    wh.load_txf_sales(DAY)
    stage(wh, S.STG_SALES, *[row[:5] + (f"{DAY} 11:00:00",) for row in bad])
    with pytest.raises(LoadRejected, match=reason):
        wh.load_txf_sales(DAY)
    assert loaded(wh) == {"old": earlier, "a": DAY}


def test_same_vehicle_may_be_sold_on_another_date(wh):
    stage(wh, S.STG_SALES, sale("a"), sale("a", NEXT, created=f"{DAY} 11:00:00"))
    assert wh.load_txf_sales(DAY).rows_written == 2


@pytest.mark.parametrize("field, value", [(4, ""), (3, "2025-02-30"), (5, f"{DAY} noon")])
def test_unreadable_text_fails_the_load(wh, field, value):
    row = list(sale("a"))
    row[field] = value
    stage(wh, S.STG_SALES, tuple(row))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        wh.load_txf_sales(DAY)
    assert loaded(wh) == {}


def test_service_load_leaves_sales_alone_and_can_be_repeated(wh):
    stage(wh, S.STG_SALES, sale("a"))
    stage(wh, S.STG_AFTER_SALES, ("T1", "a", "6", "VELOS", str(DAY), "PM", f"{DAY} 10:00:00"))
    wh.load_txf_sales(DAY)
    for _ in range(2):
        wh.load_txf_after_sales(DAY)
    assert loaded(wh, S.TXF_AFTER_SALES) == {"T1": DAY}
    assert loaded(wh) == {"a": DAY}


def test_second_initial_service_load_keeps_the_first(wh, tmp_path):
    ticket = ("T1", "a", "6", "VELOS", str(DAY), "PM", f"{DAY} 10:00:00")
    stage(wh, S.STG_AFTER_SALES, ticket)
    wh.load_txf_after_sales(DAY, initial_load=True)
    with pytest.raises(LoadRejected, match="already stored"):
        wh.load_txf_after_sales(NEXT, initial_load=True)
    other = str(tmp_path / "other")
    rest = [(f"T{i}", *ticket[1:]) for i in range(2, 40)]
    wh.spark.createDataFrame(rest, S.STG_AFTER_SALES.struct).write.parquet(other)
    wh.spark.sql(
        f"ALTER TABLE {wh.store.name(S.STG_AFTER_SALES)} PARTITION (created_date=DATE'{DAY}') SET LOCATION '{other}'"
    )
    wh.load_txf_after_sales(DAY, initial_load=True)
    assert len(loaded(wh, S.TXF_AFTER_SALES)) == 39
    tickets = wh.table(S.TXF_AFTER_SALES).groupBy("service_ticket").count()
    assert tickets.count() == 39


def test_service_constraints(wh):
    ticket = ("T1", "a", "6", "VELOS", str(DAY), "PM", f"{DAY} 10:00:00")
    stage(wh, S.STG_AFTER_SALES, ticket, ticket)
    with pytest.raises(LoadRejected, match="repeated in batch"):
        wh.load_txf_after_sales(DAY)
    stage(wh, S.STG_AFTER_SALES, ("T" * 11, *ticket[1:6], f"{NEXT} 10:00:00"))
    with pytest.raises(LoadRejected, match="service_ticket longer than 10"):
        wh.load_txf_after_sales(NEXT)
    later = NEXT + timedelta(days=1)
    stage(wh, S.STG_AFTER_SALES, (None, *ticket[1:6], f"{later} 10:00:00"))
    with pytest.raises(LoadRejected, match="service_ticket is null"):
        wh.load_txf_after_sales(later)
    assert wh.table(S.TXF_AFTER_SALES).count() == 0


def test_many_services_on_one_ticket_or_none_are_refused(wh):
    rows = [("hot", "v", "6", "VELOS", str(DAY), "PM", f"{DAY} 10:00:00")] * 50
    rows += [(None, "v", "6", "VELOS", str(NEXT), "PM", f"{NEXT} 10:00:00")] * 50
    stage(wh, S.STG_AFTER_SALES, *rows)
    for day, reason in ((DAY, "1 keys in 50 rows repeated in batch"), (NEXT, "service_ticket is null': 50")):
        with pytest.raises(LoadRejected, match=reason):
            wh.load_txf_after_sales(day)
    assert wh.table(S.TXF_AFTER_SALES).count() == 0 and wh.store.current(S.TXF_AFTER_SALES).version == 0


def service(ticket, day):
    return (ticket, "v", "6", "VELOS", str(day), "PM", f"{day} 10:00:00")


def test_tickets_are_refused_wherever_they_are_stored(wh, monkeypatch):
    """In the ticket table, in a day it does not cover yet, or in both; a day that was replaced counts as it is now."""
    monkeypatch.setattr("dealerlake.warehouse.OPEN_DAYS", 2)
    days = [DAY + timedelta(days=i) for i in range(7)]
    covered = set()
    for i, day in enumerate(days):
        stage(wh, S.STG_AFTER_SALES, service(f"T{i}", day))
        assert wh.load_txf_after_sales(day).rows_written == 1
        covered.add(wh.table(S.TICKETS).count())
    assert covered == {0, 3, 6}  # made anew whenever a third day was open
    last = days[-1] + timedelta(days=1)
    for i in range(7):
        stage(wh, S.STG_AFTER_SALES, service(f"T{i}", last))
        with pytest.raises(LoadRejected, match="1 keys in 1 rows already stored" if i == 0 else "already stored"):
            wh.load_txf_after_sales(last)
    for day in days:  # a day run again does not meet its own tickets
        wh.load_txf_after_sales(day)
    assert loaded(wh, S.TXF_AFTER_SALES) == {f"T{i}": d for i, d in enumerate(days)}


def test_a_ticket_that_left_a_covered_day_may_come_again(wh):
    stage(wh, S.STG_AFTER_SALES, service("T1", DAY), service("T2", DAY))
    wh.load_txf_after_sales(DAY, initial_load=True)
    assert wh.table(S.TICKETS).count() == 2
    kept = f"{wh.store.root}/kept-{next(_names)}"
    wh.store.read(S.STG_AFTER_SALES).filter("service_ticket = 'T2'").drop("created_date").write.parquet(kept)
    wh.spark.sql(f"ALTER TABLE {wh.store.name(S.STG_AFTER_SALES)} PARTITION (created_date=DATE'{DAY}') SET LOCATION '{kept}'")
    wh.load_txf_after_sales(DAY)
    stage(wh, S.STG_AFTER_SALES, service("T1", NEXT))
    wh.load_txf_after_sales(NEXT)
    assert loaded(wh, S.TXF_AFTER_SALES) == {"T1": NEXT, "T2": DAY}
    wh.compact_tickets()
    assert sorted(tuple(r) for r in wh.table(S.TICKETS).collect()) == [("T1", NEXT), ("T2", DAY)]


def test_small_days_leave_one_file_each(wh):
    days = [DAY + timedelta(days=i) for i in range(6)]
    stage(wh, S.STG_AFTER_SALES, *[service(f"{i}-{n}", day) for i, day in enumerate(days) for n in range(30)])
    for day in days:
        wh.load_txf_after_sales(day)
    assert len(wh.table(S.TXF_AFTER_SALES).inputFiles()) == len(days)
    wh.compact_tickets()
    assert len(wh.table(S.TICKETS).inputFiles()) <= wh.store.bucket_count(S.TICKETS)


# --- dimensions ------------------------------------------------------------------------------


def test_customers_upsert(wh):
    first = [("1", "Ann", "1998-08-04", "2025-03-01"), ("2", "Bob", "x", "2025-03-01")]
    restage_customers(wh, *first)
    report = wh.load_txf_customers(DAY)
    assert report.notes == {"unreadable birth dates": 1}
    restage_customers(wh, ("1", None, None, "2025-03-05 00:00:00.0126"), ("3", "Cas", "14/01/1995", "2025-03-01"))
    wh.load_txf_customers(NEXT)
    assert {r.id: (r.name, r.dob, r.created_at, r.load_timestamp.date()) for r in wh.table(S.TXF_CUSTOMERS).collect()} == {
        "1": (None, None, datetime(2025, 3, 5, 0, 0, 0, 13000), NEXT),
        "2": ("Bob", None, datetime(2025, 3, 1), DAY),
        "3": ("Cas", date(1995, 1, 14), datetime(2025, 3, 1), NEXT),
    }


def test_customer_loaded_on_the_run_date_and_gone_from_staging_is_removed(wh):
    restage_customers(wh, ("1", "Ann", None, "2025-03-01"), ("2", "Bob", None, "2025-03-01"))
    wh.load_txf_customers(DAY)
    restage_customers(wh, ("1", "Ann", None, "2025-03-01"))
    wh.load_txf_customers(DAY)
    assert loaded(wh, S.TXF_CUSTOMERS) == {"1": DAY}


def test_repeated_customer_takes_the_latest_row(wh):
    restage_customers(
        wh, ("1", "new", None, "2025-03-02"), ("1", "old", "2000-01-01", "2025-03-01"), ("2", "Bob", None, "2025-03-01")
    )
    assert wh.load_txf_customers(DAY).rows_written == 2
    assert {r.id: (r.name, r.dob) for r in wh.table(S.TXF_CUSTOMERS).collect()} == {"1": ("new", None), "2": ("Bob", None)}


def test_customer_without_id_is_rejected(wh):
    restage_customers(wh, ("1", "Ann", None, "2025-03-01"))
    wh.load_txf_customers(DAY)
    restage_customers(wh, (None, "Bob", None, "2025-03-01"))
    with pytest.raises(LoadRejected, match="id is null"):
        wh.load_txf_customers(NEXT)
    assert loaded(wh, S.TXF_CUSTOMERS) == {"1": DAY}
    tables = [r.tableName for r in wh.spark.sql(f"SHOW TABLES IN {wh.store.database}").collect()]
    assert sorted(tables) == sorted(t.name for t in S.ALL_TABLES)


def test_address_file_upsert_keeps_ids(wh, tmp_path):
    put_addresses(tmp_path, DAY, address("10", "7", "first"), address("11", "7", "last"), address("12", "8"))
    report = wh.ingest_stg_customer_address(str(tmp_path), DAY)
    assert (report.rows_read, report.rows_written) == (3, 2)
    put_addresses(tmp_path, NEXT, address("20", "7", "moved", city=""), address("21", "9"))
    wh.ingest_stg_customer_address(str(tmp_path), NEXT)
    rows = wh.table(S.STG_CUSTOMER_ADDRESS).collect()
    assert {r.customer_id: (r.id, r.address, r.city) for r in rows} == {
        "7": ("10", "moved", None),
        "8": ("12", "Jl A", "Bekasi"),
        "9": ("21", "Jl A", "Bekasi"),
    }


def test_typed_address_keeps_its_id_unless_loaded_on_the_run_date(wh, tmp_path):
    def staged_id(day, id):
        """Staging keeps ids too, so a new one needs staging emptied by its owner first."""
        wh.spark.sql(
            f"ALTER TABLE {wh.store.name(S.STG_CUSTOMER_ADDRESS)} SET LOCATION '{wh.store.root}/empty-{next(_names)}'"
        )
        put_addresses(tmp_path, day, address(id, "7", f"street {id}"))
        wh.ingest_stg_customer_address(str(tmp_path), day)

    def typed():
        return [(r.id, r.address) for r in wh.table(S.TXF_CUSTOMER_ADDRESS).collect()]

    staged_id(DAY, "10")
    wh.load_txf_customer_address(DAY)
    staged_id(NEXT, "20")
    wh.load_txf_customer_address(NEXT)
    assert typed() == [("10", "street 20")]
    staged_id(NEXT, "30")
    wh.load_txf_customer_address(NEXT)
    assert typed() == [("30", "street 30")]


@pytest.mark.parametrize(
    "row, reason",
    [
        (address("1", ""), "customer_id is null"),
        (address("1", "7", province="p" * 26), "province longer than 25"),
        (address("1", "7")[:5], "malformed lines"),
        (address("1", "7") + ("more",), "malformed lines"),
    ],
)
def test_bad_address_file_is_rejected_whole(wh, tmp_path, row, reason):
    put_addresses(tmp_path, DAY, address("10", "7"))
    wh.ingest_stg_customer_address(str(tmp_path), DAY)
    put_addresses(tmp_path, NEXT, address("11", "8"), row)
    with pytest.raises(LoadRejected, match=reason):
        wh.ingest_stg_customer_address(str(tmp_path), NEXT)
    assert [r.customer_id for r in wh.table(S.STG_CUSTOMER_ADDRESS).collect()] == ["7"]


def test_report_of_a_load_that_was_cut_and_repeated(wh, monkeypatch):
    """The first attempt computes everything and is lost before it is published."""
    stage(wh, S.STG_CUSTOMERS, ("1", "a", "1990-01-01", "2025-08-02 10:00:00"), ("1", "b", "30/02/1990", "2025-08-02 11:00:00"), ("2", "c", None, "2025-08-02 10:00:00"))
    with monkeypatch.context() as broken:
        broken.setattr(wh.store, "replace_table", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            wh.load_txf_customers(DAY)
    report = wh.load_txf_customers(DAY)
    assert (report.rows_read, report.rows_written, report.notes) == (3, 2, {"unreadable birth dates": 1})


def test_source_rows_are_counted_from_footers_alone(wh):
    stage(wh, S.STG_CUSTOMERS, ("1", "a", None, "2025-08-02 10:00:00"), ("2", "c", None, "2025-08-02 10:00:00"))
    staged = wh.store.read(S.STG_CUSTOMERS)
    assert tally(staged) == {"rows": 2}
    counted = staged.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in counted


# --- marts -----------------------------------------------------------------------------------


def test_sales_without_a_class_leave_the_old_mart_in_place(wh):
    stage(wh, S.STG_SALES, sale("a"), sale("cheap", NEXT, price="99.999.999"))
    wh.load_txf_sales(DAY)
    wh.load_mart_sales()
    wh.load_txf_sales(NEXT)
    with pytest.raises(LoadRejected, match="class is null"):
        wh.load_mart_sales()
    assert [r.total for r in wh.table(S.MART_SALES).collect()] == [Decimal("390000000.00000")]


def test_mart_is_rebuilt_not_added_to(wh):
    stage(wh, S.STG_SALES, sale("a"), sale("b"), sale("c", NEXT))
    wh.load_txf_sales(DAY)
    wh.load_mart_sales()
    wh.load_txf_sales(NEXT)
    for _ in range(2):
        wh.load_mart_sales()
    totals = [r.total for r in wh.table(S.MART_SALES).collect()]
    assert totals == [Decimal("1170000000.00000")]


def test_service_mart_bands_and_joins(wh, tmp_path):
    restage_customers(wh, *[(c, f"name {c}", None, "2025-03-01") for c in "1234"])
    put_addresses(tmp_path, DAY, address("10", "1"), address("11", "9"))
    wh.ingest_stg_customer_address(str(tmp_path), DAY)
    tickets = [
        (f"{customer}-{i}", "V", customer, "m", day, "PM", f"{DAY} 10:00:00")
        for customer, services, day in (
            ("1", 4, "2025-01-01"), ("2", 5, "2025-01-01"), ("3", 10, "2025-12-31"), ("4", 11, None), ("9999", 3, "2025-01-01")
        )
        for i in range(services)
    ]
    stage(wh, S.STG_AFTER_SALES, *tickets, ("none", "V", None, "m", "2025-01-01", "PM", f"{DAY} 10:00:00"))
    wh.load_txf_customers(DAY)
    wh.load_txf_customer_address(DAY)
    wh.load_txf_after_sales(DAY)
    wh.load_mart_cust_service_prio()
    assert {tuple(r)[:6] for r in wh.table(S.MART_CUST_SERVICE_PRIO).collect()} == {
        (2025, "V", "name 1", "Jl A", 4, "LOW"),
        (2025, "V", "name 2", None, 5, "MED"),
        (2025, "V", "name 3", None, 10, "MED"),
        (None, "V", "name 4", None, 11, "HIGH"),
    }


# --- tables ----------------------------------------------------------------------------------


def test_creating_tables_again_keeps_them_and_their_bucket_count(wh):
    restage_customers(wh, *[(str(i), f"n{i}", None, "2025-03-01") for i in range(50)])
    wh.load_txf_customers(DAY)
    again = Warehouse(wh.spark, wh.store.root, wh.store.database, buckets=7)
    again.load_txf_customers(NEXT)
    assert again.store.bucket_count(S.TXF_CUSTOMERS) == 4
    assert len(loaded(again, S.TXF_CUSTOMERS)) == 50
    assert again.table(S.TXF_CUSTOMERS).groupBy("id").count().count() == 50
