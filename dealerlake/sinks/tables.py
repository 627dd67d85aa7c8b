"""Tables and how a finished run becomes visible in them.

A run is written to a folder of its own, checked there, and only then put in
place by one new record of the table (see ``records``). Readers keep the previous
files until that moment, a failed or lost job leaves the tables as they were, and
source rows are read once: row counts and constraint counts are collected by the
write itself.

The catalog's entries follow the records: a session brings them up to date when it
opens the warehouse and before it reads a table that another session has loaded.
"""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealerlake.operators import LoadRejected, broken_row, count_violations, counting, violation_counts
from dealerlake.operators.counting import ROWS
from dealerlake.schemas import ALL_TABLES, BATCH, CREATED_DATE, LOAD_DATE, Table
from dealerlake.sinks.records import Record, Records
from dealerlake.sources.staging import laid_out

BROKEN = "broken rows"
REJECTED = "rejected"
FOLLOWED = "record"  # table property: the version its catalog entries stand for
AT_ONCE = 500  # partitions added by one statement


@dataclass(frozen=True)
class Run:
    """Files written for one load, not yet part of the table."""

    table: Table
    run_id: str
    path: str
    counted: dict[str, object]

    @property
    def rows(self) -> int:
        return self.counted[ROWS]


class TableStore:
    """The warehouse tables as external Parquet under ``root``, entered in one catalog database.

    ``root`` is a folder every executor reaches. What it holds outlives the session: a store
    opened on it again, by any session, reads the same tables. ``buckets`` applies to tables
    created here and now; equal to ``spark.sql.shuffle.partitions`` it lets an upsert read its
    target without a shuffle.
    """

    def __init__(self, spark: SparkSession, root: str, database: str = "dwh", buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.records = Records(spark, self.root)
        self._followed: dict[str, Record] = {}

    def create_tables(self) -> None:
        """Enter all tables in the catalog; new ones are empty. Files of unknown origin are refused."""
        # In a folder of its own: Spark deletes the folder of a database that is dropped.
        self._sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self._database_folder()}'")
        for table in ALL_TABLES:
            if table.raw:
                self._enter(table)
                if table.layout and self.records.has_folder(f"{self.root}/{table.name}/base"):
                    self._sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
            else:
                self._enter(table, self._first_record(table))
                self.follow(table)

    def _first_record(self, table: Table) -> Record:
        record = self.records.current(table.name)
        if record is None:
            if self.records.holds_data(table.name):
                raise ValueError(f"{self.root}/{table.name} holds files but no record of which make up the table")
            empty = {"places": {}} if table.layout else {"location": f"{self.root}/{table.name}/base"}
            record = Record(0, buckets=self.buckets if table.bucketed else None, **empty)
            try:
                self.records.write(table.name, record)
            except LoadRejected:  # another session was first
                record = self.records.current(table.name)
        return record

    def _enter(self, table: Table, record: Record | None = None) -> None:
        """Make the table's entry if there is none, at the version of ``record`` unless partitions have to be added."""
        hidden = (BATCH,) if table.raw else ()
        columns = ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in table.columns + hidden + table.layout)
        ddl = f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet"
        if table.layout:
            ddl += f" PARTITIONED BY ({', '.join(c.name for c in table.layout)})"
        if record and record.buckets:
            ddl += f" CLUSTERED BY ({', '.join(table.key)}) INTO {record.buckets} BUCKETS"
        if record and not (table.layout and record.places):
            ddl += f" TBLPROPERTIES ('{FOLLOWED}' = '{record.version}')"
        base = f"{self.root}/{table.name}/base"
        self._sql(f"{ddl} LOCATION '{(record and record.location) or base}'")

    def name(self, table: Table) -> str:
        return f"{self.database}.{table.name}"

    def current(self, table: Table) -> Record:
        """The table's newest record. A load keeps the one it starts from and may only be followed by its own."""
        return self.records.current(table.name)

    def read(self, table: Table, record: Record | None = None, keep: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        """The rows of a table as of ``record``, else as they are now.

        A table whose loads touch several partitions is read by the record's own list of folders, so
        that a load is seen whole or not at all, whatever the catalog says. ``keep`` picks the
        partitions to list, by column values as text.
        """
        if table.raw:
            return self.staged(table).drop(BATCH.name)
        if record is None or table.bucketed or not table.layout:
            self.follow(table)
        if table.bucketed or not table.layout:
            return self.spark.table(self.name(table))
        places = (record or self.current(table)).places
        return self._read_places(table, {spec: run for spec, run in places.items() if keep is None or keep(_values(spec))})

    def staged(self, table: Table) -> DataFrame:
        """The rows of a raw table with the batches they came in."""
        return self.spark.table(self.name(table))

    def _read_places(self, table: Table, places: dict[str, str]) -> DataFrame:
        columns = [*table.names, *[c.name for c in table.layout]]
        if not places:
            return self.spark.table(self.name(table)).filter("false").select(*columns)
        schema = table.struct.fields + [T.StructField("run", T.StringType())]
        schema += [T.StructField(c.name, c.dtype) for c in table.layout]
        runs = f"{self.root}/{table.name}/runs"
        reader = self.spark.read.schema(T.StructType(schema)).option("basePath", runs)
        return reader.parquet(*[f"{runs}/{run}/{spec}" for spec, run in sorted(places.items())]).select(*columns)

    def read_unbucketed(self, table: Table) -> DataFrame:
        """The table's files without their bucketing.

        For joins against rows that may pile up on one key: a bucketed side pins each
        key to one task, a shuffled one lets Spark split it.
        """
        self.follow(table)
        return self.spark.read.schema(table.struct).parquet(self._described(table)["Location"])

    def bucket_count(self, table: Table) -> int:
        """Bucket count the table was created with, which its files must keep."""
        return self.current(table).buckets

    def follow(self, table: Table) -> None:
        """Bring the catalog's entries of a table to its newest record.

        A property of the entry names the version it stands for. It is taken away before several
        statements are needed and set after them, so entries that were left half changed are made anew.
        """
        record = self.current(table)
        if self._followed.get(table.name) == record:
            return
        before = self._followed.get(table.name)
        if before is None:
            stood_for = self._property(table)
            before = self.records.version(table.name, int(stood_for)) if stood_for else None
        if before != record:
            if not table.layout:
                self._sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{record.location}'")
            else:
                self._follow_places(table, before, record)
            self._sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('{FOLLOWED}' = '{record.version}')")
            self.spark.catalog.refreshTable(self.name(table))
        self._followed[table.name] = record

    def _follow_places(self, table: Table, before: Record | None, record: Record) -> None:
        if before is None:
            # Entries of unknown state. They are of an external table, so its files stay.
            self._sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            self._enter(table, record)
            self._add(table, record.places)
            return
        old, new = before.places, record.places
        self._sql(f"ALTER TABLE {self.name(table)} UNSET TBLPROPERTIES IF EXISTS ('{FOLLOWED}')")
        self._followed.pop(table.name, None)
        for spec in sorted(old.keys() - new.keys()):
            self._sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({_clause(spec)})")
        for spec in sorted(s for s in old.keys() & new.keys() if old[s] != new[s]):
            place = self._folder(table, new[spec], spec)
            self._sql(f"ALTER TABLE {self.name(table)} PARTITION ({_clause(spec)}) SET LOCATION '{place}'")
        self._add(table, {spec: run for spec, run in new.items() if spec not in old})

    def _add(self, table: Table, places: dict[str, str]) -> None:
        clauses = [f"PARTITION ({_clause(s)}) LOCATION '{self._folder(table, run, s)}'" for s, run in sorted(places.items())]
        for first in range(0, len(clauses), AT_ONCE):
            self._sql(f"ALTER TABLE {self.name(table)} ADD {' '.join(clauses[first : first + AT_ONCE])}")

    def _folder(self, table: Table, run: str, spec: str) -> str:
        return f"{self.root}/{table.name}/runs/{run}/{spec}"

    def _property(self, table: Table) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return {r.key: r.value for r in rows}.get(FOLLOWED)

    def _sql(self, statement: str) -> DataFrame:
        return self.spark.sql(statement)

    def append_batch(self, table: Table, rows: DataFrame, batch: str | None = None) -> dict[str, int]:
        """Add raw rows under the id of their batch, in one pass; how many, and how many of them no daily load can take.

        A batch staged to its end is known by its mark and not read again: the counts are those of then.
        Of one that was cut short, the files that came into place are deleted first. One session stages a
        batch at a time; an id names one content. Rows without an id are always added.
        """
        if batch is not None:
            if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
                raise ValueError(f"a batch id is of letters, digits, '_', '.' and '-': {batch!r}")
            known = self.records.batch(table.name, batch)
            if known:
                return known
            if not self.records.begin_batch(table.name, batch):
                self._delete_batch(table, batch)
        staged, flags = laid_out(rows, table, batch), {}
        if CREATED_DATE in table.layout:
            staged, flags = staged.hint("rebalance", CREATED_DATE.name), {REJECTED: F.col(CREATED_DATE.name).isNull()}
        counted, seen = counting(staged, flags)
        counted.write.mode("append").insertInto(self.name(table))
        told = {REJECTED: 0} | seen.get
        if batch is not None:
            self.records.finish_batch(table.name, batch, told)
        return told

    def _delete_batch(self, table: Table, batch: str) -> None:
        """Delete the files of a batch that was cut short. Row group statistics skip those of all others."""
        if table.layout:
            self._sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name(table))
        rows = self.spark.table(self.name(table)).filter(F.col(BATCH.name) == batch)
        files = [r.file for r in rows.select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
        self.records.delete(files)
        self.spark.catalog.refreshTable(self.name(table))

    def write_run(
        self, table: Table, rows: DataFrame, extra: Sequence[Column] = (), from_upsert: bool = False, day: date | None = None
    ) -> Run:
        """Write ``rows``, all loaded on ``day``, to a fresh folder, counting rows, broken rows and ``extra`` on the way."""
        run_id = f"run={uuid.uuid4().hex}"
        path = f"{self.root}/{table.name}/runs/{run_id}"
        if day:
            path += f"/{LOAD_DATE.name}={day}"
        inner = [c.name for c in table.layout if c != LOAD_DATE]
        rows = rows.select(*table.names, *inner)
        flags = {BROKEN: broken_row(table)}
        if table.bucketed:
            # Saved under a name of its own, since only a table can be written in buckets.
            # An upsert over as many shuffle partitions as buckets has every key in the task
            # of its bucket already, though a full outer join does not declare that.
            buckets = self.bucket_count(table)
            if not from_upsert or buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
                rows = rows.repartition(buckets, *table.key)
            counted, seen = counting(rows, flags, *extra)
            writer = counted.write.options(**_filters(table)).bucketBy(buckets, *table.key).option("path", path)
            if table.sorted_by:
                writer = writer.sortBy(*table.sorted_by)
            writer.saveAsTable(self._run_table(table, run_id))
        elif table.layout:
            # Even files whatever the input's split: a day thinly spread over staging does not
            # become thousands of crumbs, and a bucket holding most rows is cut up again.
            counted, seen = counting(rows.hint("rebalance", *inner), flags, *extra)
            order = [*inner, *table.sorted_by]
            counted = counted.sortWithinPartitions(*order) if order else counted
            counted.write.options(**_filters(table)).partitionBy(*inner).parquet(path)
        else:
            counted, seen = counting(rows, flags, *extra)
            counted.write.parquet(path)
        return Run(table, run_id, path, seen.get)

    def read_run(self, run: Run) -> DataFrame:
        if run.table.bucketed:
            return self.spark.table(self._run_table(run.table, run.run_id))
        inner = [c for c in run.table.layout if c != LOAD_DATE]
        schema = run.table.struct
        for column in inner:
            schema = schema.add(column.name, column.dtype)
        return self.spark.read.schema(schema).parquet(run.path)

    def require_valid(self, run: Run) -> None:
        """Raise if any row breaks a constraint, naming the rules. Only then the run is read again."""
        if run.counted[BROKEN]:
            counts = count_violations(self.read_run(run), violation_counts(run.table)).filter("violations > 0")
            raise LoadRejected(f"{run.table.name}: {dict(map(tuple, counts.collect()))}")

    def discard(self, run: Run) -> None:
        """Forget the run's own table entry. Files stay: in place if published, else for inspection."""
        if run.table.bucketed:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._run_table(run.table, run.run_id)}")

    def replace_table(self, run: Run, record: Record, covers: dict[str, str] | None = None) -> None:
        """Make the run's files the table; ``covers`` are the places of the table it is kept beside."""
        self._publish(run.table, replace(record, version=record.version + 1, location=run.path, places=covers))

    def replace_load(self, run: Run, load_date: date, buckets: Sequence[str] | None, record: Record) -> None:
        """Make the run the whole content of ``load_date``; an empty run empties it."""
        day = f"{LOAD_DATE.name}={load_date}"
        others = {spec: held for spec, held in record.places.items() if spec.split("/")[0] != day}
        self._publish_places(run.table, record, others | self._places(run, load_date, buckets))

    def append_load(self, run: Run, load_date: date, buckets: Sequence[str] | None, record: Record) -> None:
        """Add the run under ``load_date``. Partitions it shares with stored rows are written anew with both."""
        places = self._places(run, load_date, buckets)
        shared = places.keys() & record.places.keys()
        merged = None
        try:
            if shared:
                inner = [c.name for c in run.table.layout if c != LOAD_DATE]
                columns = [*run.table.names, *inner]
                values = [_values(spec) for spec in shared]
                stored = self.read(run.table, record, lambda p: p in values).filter(F.col(LOAD_DATE.name) == F.lit(load_date))
                for column in inner:
                    stored = stored.filter(F.col(column).isin([v[column] for v in values]))
                merged = self.write_run(run.table, stored.select(*columns).unionByName(self.read_run(run).select(*columns)), day=load_date)
                places = self._places(merged, load_date, buckets)
            self._publish_places(run.table, record, record.places | places)
        finally:
            if merged:
                self.discard(merged)

    def _publish_places(self, table: Table, record: Record, places: dict[str, str]) -> None:
        if places != record.places:
            self._publish(table, replace(record, version=record.version + 1, places=places))

    def _publish(self, table: Table, record: Record) -> None:
        """The switch: one new record. The load has happened then; entries that cannot follow now do so on the next read."""
        self.records.write(table.name, record)
        try:
            self.follow(table)
        except Exception as error:
            warnings.warn(f"{self.name(table)}: loaded, but its catalog entries are not up to date yet: {error}", stacklevel=2)

    def _places(self, run: Run, load_date: date, buckets: Iterable[str] | None) -> dict[str, str]:
        """Partition folder -> run folder. ``buckets`` are the non-empty inner folders, None where there are none."""
        day = f"{LOAD_DATE.name}={load_date}"
        if buckets is None:
            return {day: run.run_id} if run.rows else {}
        (inner,) = [c.name for c in run.table.layout if c != LOAD_DATE]
        return {f"{day}/{inner}={b}": run.run_id for b in buckets}

    def vacuum(self, keep_for: timedelta = timedelta(days=7)) -> dict[str, int]:
        """Delete run folders that no version of a table younger than ``keep_for`` refers to; how many of each table."""
        return {t.name: len(self.records.sweep(t.name, keep_for)) for t in ALL_TABLES if not t.raw}

    def drop_entries(self) -> None:
        """Take the tables out of the catalog. Files and records stay, so a store opened on them finds them again."""
        for table in ALL_TABLES:
            self._sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        told = {r.info_name: r.info_value for r in self.spark.sql(f"DESCRIBE DATABASE {self.database}").collect()}
        if told["Location"].endswith(self._database_folder()):  # never one that holds tables' files
            self._sql(f"DROP DATABASE {self.database}")
        self._followed.clear()

    def _database_folder(self) -> str:
        return f"{self.root}/_databases/{self.database}"

    def _run_table(self, table: Table, run_id: str) -> str:
        return f"{self.name(table)}__{run_id.removeprefix('run=')}"

    def _described(self, table: Table) -> dict[str, str]:
        return {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE EXTENDED {self.name(table)}").collect()}


def _filters(table: Table) -> dict[str, str]:
    """Writer options for Bloom filters of the probed columns, sized by the values each row group turns out to hold."""
    enabled = {f"parquet.bloom.filter.enabled#{column}": "true" for column in table.probed}
    return enabled | {"parquet.bloom.filter.adaptive.enabled": "true"} if enabled else {}


def _values(spec: str) -> dict[str, str]:
    """``a=1/b=x`` by column."""
    return dict(part.split("=", 1) for part in spec.split("/"))


def _clause(spec: str) -> str:
    """The partition as SQL names it."""
    return ", ".join(f"{name}=DATE'{value}'" if name == LOAD_DATE.name else f"{name}='{value}'" for name, value in _values(spec).items())
