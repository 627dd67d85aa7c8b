"""The seven daily flows, from source to published table.

Each is an ordinary method a scheduler can call; it raises and changes nothing
when the input breaks a constraint.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake.functions.bands import invoice_bucket
from dealerlake.functions.clean import moment, parse_birth_date
from dealerlake.operators import LoadRejected, duplicate_keys, key_violations, tally
from dealerlake.operators.counting import ROWS
from dealerlake.plans import (
    build_stg_customer_address,
    build_txf_customer_address,
    build_txf_customers,
    mart_cust_service_prio,
    mart_sales,
    typed_after_sales,
    typed_sales,
)
from dealerlake.schemas import (
    BATCH,
    LOAD_DATE,
    MART_CUST_SERVICE_PRIO,
    MART_SALES,
    STG_AFTER_SALES,
    STG_CUSTOMER_ADDRESS,
    STG_CUSTOMERS,
    STG_SALES,
    TICKETS,
    TXF_AFTER_SALES,
    TXF_CUSTOMER_ADDRESS,
    TXF_CUSTOMERS,
    TXF_SALES,
    Table,
)
from dealerlake.session import configure
from dealerlake.sinks import REJECTED, Record, Run, TableStore
from dealerlake.sources import created_on, read_address_file, rejects
from dealerlake.sources.address_files import FIELDS, MALFORMED
from dealerlake.sources.staging import REASON


OPEN_DAYS = 32  # days of services whose tickets a key check reads from the services themselves, at most
PROBED_KEYS = 1000  # of so few keys the key check asks the stored files' Bloom filters


@dataclass(frozen=True)
class LoadReport:
    """What a load did: source rows read, rows in the written result, and further counts.

    Exact also where Spark had to run tasks again: source rows are counted by a query over the same files,
    rows written by the tasks that write them, of which each counts once.
    """

    table: str
    rows_read: int
    rows_written: int
    notes: dict[str, int] = field(default_factory=dict)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, database: str = "dwh", buckets: int | None = None):
        self.spark = configure(spark)
        self.store = TableStore(spark, root, database, buckets)
        self.store.create_tables()

    def vacuum(self, keep_for: timedelta = timedelta(days=7)) -> dict[str, int]:
        """Delete files of versions replaced longer ago than ``keep_for``, and of loads that failed; folders deleted by table."""
        return self.store.vacuum(keep_for)

    def table(self, table: Table) -> DataFrame:
        return self.store.read(table).select(*table.names)

    def append_staging(self, table: Table, rows: DataFrame, batch: str | None = None) -> LoadReport:
        """Add raw rows. A batch whose id was staged before is skipped; its report is that of then.

        Rows of services and sales without a readable day are staged and counted as rejected. Daily
        loads leave them out, ``staging_rejects`` lists them, an initial load meets them and fails.
        """
        told = self.store.append_batch(table, rows, batch)
        return LoadReport(table.name, told[ROWS], told[ROWS], {REJECTED: told[REJECTED]})

    def staging_rejects(self, table: Table) -> DataFrame:
        """Staged rows that no daily load can take, with batch and reason. Reads their own folder only."""
        return rejects(self.store.staged(table)).select(*table.names, BATCH.name, REASON)

    def ingest_stg_customer_address(
        self, base_path: str, run_date: date, load_ts: datetime | None = None
    ) -> LoadReport:
        """Apply the day's address file to staging. Any malformed line rejects the file."""
        lines = read_address_file(self.spark, base_path, run_date)
        # All fields have to be looked at: by itself, the parser would not split a line into fields nobody asks for.
        looked_at = F.coalesce(F.length(F.concat_ws("", *FIELDS)), F.lit(0)) >= 0
        read = tally(lines, {"malformed lines": looked_at & F.col(MALFORMED).isNotNull()})
        if read["malformed lines"]:
            raise LoadRejected(f"{STG_CUSTOMER_ADDRESS.name}: {read['malformed lines']} malformed lines")
        record, target = self.store.current(STG_CUSTOMER_ADDRESS), self.store.read(STG_CUSTOMER_ADDRESS)
        rows = build_stg_customer_address(lines, target, load_ts or _stamp(run_date))
        return self._replace(STG_CUSTOMER_ADDRESS, rows, read, record)

    def load_txf_customers(self, run_date: date, load_ts: datetime | None = None) -> LoadReport:
        dob = F.col("dob")
        unreadable = dob.isNotNull() & parse_birth_date(dob).isNull()
        staged = self.store.read(STG_CUSTOMERS)
        read = tally(staged, {"unreadable birth dates": unreadable})
        record, target = self.store.current(TXF_CUSTOMERS), self.store.read(TXF_CUSTOMERS)
        rows = build_txf_customers(staged, target, run_date, load_ts or _stamp(run_date))
        return self._replace(TXF_CUSTOMERS, rows, read, record)

    def load_txf_customer_address(self, run_date: date, load_ts: datetime | None = None) -> LoadReport:
        staged = self.store.read(STG_CUSTOMER_ADDRESS)
        read = tally(staged)
        record, target = self.store.current(TXF_CUSTOMER_ADDRESS), self.store.read(TXF_CUSTOMER_ADDRESS)
        rows = build_txf_customer_address(staged, target, run_date, load_ts or _stamp(run_date))
        return self._replace(TXF_CUSTOMER_ADDRESS, rows, read, record)

    def load_txf_sales(
        self, run_date: date, initial_load: bool = False, load_ts: datetime | None = None
    ) -> LoadReport:
        """See ``_load_fact``."""
        return self._load_fact(TXF_SALES, STG_SALES, typed_sales, run_date, initial_load, load_ts)

    def load_txf_after_sales(
        self, run_date: date, initial_load: bool = False, load_ts: datetime | None = None
    ) -> LoadReport:
        """See ``_load_fact``."""
        return self._load_fact(TXF_AFTER_SALES, STG_AFTER_SALES, typed_after_sales, run_date, initial_load, load_ts)

    def load_mart_sales(self, load_ts: datetime | None = None) -> LoadReport:
        """Rebuild the sales mart. Sales outside every price class reject it; the old mart stays."""
        record = self.store.current(MART_SALES)
        sales = self.store.read(TXF_SALES)
        return self._refresh(MART_SALES, mart_sales(sales), tally(sales), record, load_ts)

    def load_mart_cust_service_prio(self, load_ts: datetime | None = None) -> LoadReport:
        record = self.store.current(MART_CUST_SERVICE_PRIO)
        services = self.store.read(TXF_AFTER_SALES)
        rows = mart_cust_service_prio(
            services,
            self.store.read_unbucketed(TXF_CUSTOMERS),
            self.store.read_unbucketed(TXF_CUSTOMER_ADDRESS),
        )
        return self._refresh(MART_CUST_SERVICE_PRIO, rows, tally(services), record, load_ts)

    def _replace(self, table: Table, rows: DataFrame, read: dict[str, int], record: Record) -> LoadReport:
        run = self.store.write_run(table, rows, from_upsert=True)
        try:
            self.store.require_valid(run)
            repeated = duplicate_keys(self.store.read_run(run), table.key)
            _require_none(table, repeated.withColumn("reason", F.lit("repeated in result")))
            self.store.replace_table(run, record)
        finally:
            self.store.discard(run)
        return LoadReport(table.name, read[ROWS], run.rows, {name: n for name, n in read.items() if name != ROWS})

    def _refresh(
        self, table: Table, rows: DataFrame, read: dict[str, int], record: Record, load_ts: datetime | None
    ) -> LoadReport:
        stamp = load_ts or datetime.now(UTC).replace(tzinfo=None)
        run = self.store.write_run(table, rows.withColumn("load_timestamp", moment(stamp)))
        self.store.require_valid(run)
        self.store.replace_table(run, record)
        return LoadReport(table.name, read[ROWS], run.rows)

    def _load_fact(
        self, table: Table, staging: Table, typed, run_date: date, initial_load: bool, load_ts: datetime | None
    ) -> LoadReport:
        """Append everything staged, or make the rows created on ``run_date`` that day's load.

        Constraints are checked on the written run before it becomes part of the fact.

        A daily load is stamped on its run date, so running a day again replaces exactly
        its own rows. An initial load belongs under a date that no daily load uses.
        """
        load_ts = load_ts or _stamp(run_date)
        if not initial_load and load_ts.date() != run_date:
            raise ValueError(f"a daily load for {run_date} cannot be stamped {load_ts}")
        record = self.store.current(table)
        staged = self.store.read(staging)
        rows = typed(staged if initial_load else created_on(staged, run_date), load_ts)

        counts = [*_range(table)]
        split = table is TXF_SALES
        if split:
            rows = rows.withColumn("inv_bucket", invoice_bucket(F.col("invoice_date")))
            counts.append(F.collect_set("inv_bucket").alias("buckets"))  # five at most
        run = self.store.write_run(table, rows, counts, day=load_ts.date())
        try:
            self.store.require_valid(run)
            buckets = run.counted["buckets"] if split else None
            if run.rows:
                replaced = None if initial_load else run_date
                batch = self.store.read_run(run)
                few = _few(batch, table.key[0]) if run.rows <= PROBED_KEYS else None
                if split:
                    violations = self._stored_sales(record, run, buckets, replaced, few)
                    violations = key_violations(violations, batch, table.key)
                else:
                    violations = self.ticket_violations(batch, record, replaced, few)
                _require_none(table, violations)
            publish = self.store.append_load if initial_load else self.store.replace_load
            publish(run, load_ts.date(), buckets, record)
        finally:
            self.store.discard(run)
        if table is TXF_AFTER_SALES and (initial_load or len(self._ticket_days(self.store.current(table))[1]) > OPEN_DAYS):
            self.compact_tickets()
        return LoadReport(table.name, run.rows, run.rows)

    def _stored_sales(
        self, record: Record, run: Run, buckets: list[str], replaced: date | None, few: list[str] | None = None
    ) -> DataFrame:
        """Stored sales that may hold a key of the run: of its invoice ranges and dates, but for the day it replaces.

        ``few`` are all vehicles of a small run: row groups without any of them are skipped by Bloom filters.
        """
        existing = self.store.read(
            TXF_SALES, record, lambda p: p["inv_bucket"] in buckets and p[LOAD_DATE.name] != str(replaced)
        )
        for column in TXF_SALES.sorted_by:
            low, high = run.counted[f"first {column}"], run.counted[f"last {column}"]
            existing = existing.filter(F.col(column).between(F.lit(low), F.lit(high)))
        return existing if few is None else existing.filter(F.col("vin").isin(few))

    def ticket_violations(
        self, batch: DataFrame, record: Record | None = None, replaced: date | None = None, few: list[str] | None = None
    ) -> DataFrame:
        """Tickets that ``batch`` repeats or that are stored, but for those of the day it replaces; see ``key_violations``.

        The tickets of most days lie in a table bucketed on them. The batch is dealt to its buckets
        once, so however long the history, it is not moved. Days that table does not cover yet, a bounded
        number of them, are read from the services themselves. Of ``few``, all tickets of a small
        batch, only their buckets and row groups that may hold them are read.
        """
        record = record or self.store.current(TXF_AFTER_SALES)
        covered, open_days, outdated = self._ticket_days(record)
        key = TXF_AFTER_SALES.key
        unseen = [*outdated, *[d for d in covered if d == replaced]]
        stored = self.store.read(TICKETS).filter(~F.col("loaded_on").isin(unseen)) if unseen else self.store.read(TICKETS)
        recent = self.store.read(
            TXF_AFTER_SALES, record, lambda p: date.fromisoformat(p[LOAD_DATE.name]) in open_days and p[LOAD_DATE.name] != str(replaced)
        )
        if few is not None:
            stored, recent = (rows.filter(F.col("service_ticket").isin(few)) for rows in (stored, recent))
        dealt = batch.select(*key).repartition(self.store.bucket_count(TICKETS), *key)
        again = key_violations(recent, dealt, key).filter("reason = 'already stored'")
        return key_violations(stored, dealt, key).unionByName(again)

    def _ticket_days(self, record: Record) -> tuple[list[date], list[date], list[date]]:
        """Days whose tickets the ticket table holds as they are, days it does not hold so, and days it holds that are gone or replaced."""
        held = self.store.current(TICKETS).places or {}
        day = lambda spec: date.fromisoformat(spec.split("=")[1])
        covered = [day(s) for s, run in record.places.items() if held.get(s) == run]
        return covered, [day(s) for s in record.places if day(s) not in covered], [day(s) for s in held if day(s) not in covered]

    def compact_tickets(self) -> None:
        """Make the ticket table cover every stored day. Services and their loads are not touched by it.

        Done after an initial load and whenever more than ``OPEN_DAYS`` days have come since, so the files
        of both tables grow by one a small day, not by one a bucket and day.
        """
        tickets, services = self.store.current(TICKETS), self.store.current(TXF_AFTER_SALES)
        covered, open_days, outdated = self._ticket_days(services)
        if not open_days and not outdated:
            return
        new = self.store.read(TXF_AFTER_SALES, services, lambda p: date.fromisoformat(p[LOAD_DATE.name]) in open_days)
        rows = new.select("service_ticket", F.col(LOAD_DATE.name).alias("loaded_on"))
        if covered:
            held = self.store.read(TICKETS)
            rows = rows.unionByName(held.filter(~F.col("loaded_on").isin(outdated)) if outdated else held)
        run = self.store.write_run(TICKETS, rows)
        try:
            self.store.replace_table(run, tickets, services.places)
        except LoadRejected:  # another session has done so meanwhile
            pass
        finally:
            self.store.discard(run)


def _stamp(run_date: date) -> datetime:
    """The present time of day, on the run date."""
    return datetime.combine(run_date, datetime.now(UTC).time())


def _few(batch: DataFrame, column: str) -> list[str]:
    """The values of a key column in a batch of at most ``PROBED_KEYS`` rows."""
    return [r[0] for r in batch.select(column).distinct().collect()]


def _range(table: Table) -> list[Column]:
    """Smallest and largest values of the key column the files are sorted by, to skip files in the key check."""
    lows = [F.min(c).alias(f"first {c}") for c in table.sorted_by]
    return lows + [F.max(c).alias(f"last {c}") for c in table.sorted_by]


def _require_none(table: Table, violations: DataFrame) -> None:
    """Raise if there is any violation, with the number of keys and rows of each reason and its smallest key.

    One aggregate, whatever the number of partitions; ``violations`` itself lists every key.
    """
    found = (
        violations.groupBy("reason")
        .agg(F.count("*").alias("keys"), F.sum("copies").alias("rows"), F.min(F.struct(*table.key)).alias("least"))
        .orderBy("reason")
        .collect()
    )
    if found:
        told = [f"{r.keys} keys in {r.rows} rows {r.reason}, such as {tuple(r.least)}" for r in found]
        raise LoadRejected(f"{table.name}: duplicate keys: {'; '.join(told)}")
