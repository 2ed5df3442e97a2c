"""The star schema at rest: five typed Parquet tables, loaded all or nothing.

Loads follow the reference's rules (A6-A12):
  * dimensions: insert-if-absent on the business key, surrogate keys continue
    after the existing maximum;
  * facts: plain append that rejects the whole batch on any key problem (duplicate
    or NULL key, clash with a stored key, unknown dimension member, assay of an
    unknown reading);
  * full refresh: all five tables replaced.

Every load has an id and writes its rows as new partitions `load_id=<id>` of the stored
tables, through Spark's own insert and committer. Readers see the partitions of committed
loads only: the table names a user knows are views that keep the load ids listed in `loads`,
from the last one that replaced the table onwards. Committing is one insert of one row into
`loads` (which becomes visible as one catalog partition), after every check has passed, so a
refresh or an append of all five tables shows at once or not at all. A load that fails or
whose driver dies leaves partitions nobody reads; `vacuum` drops them, and those that later
refreshes replaced. One writer at a time is assumed, any number of readers.

Layout (A19, the reference's indexes re-aimed): the sensor fact is partitioned by month and
sorted by equipment, bench and time inside it, so lookups on any of them skip row groups and
pages by their statistics; a Parquet Bloom filter serves lookups of single readings. Assays
are sorted by sample date, with a Bloom filter on reading_id. With `buckets=n` both facts are
bucketed by reading_id into n buckets instead, so joining them needs no shuffle.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from orebridge import schemas
from orebridge.functions import month_start
from orebridge.operators import (assert_all_empty, declared_checks, failed_rows, fk_orphans,
                                 insert_if_absent, key_usage, key_violations, max_key)
from orebridge.operators.joins import all_of
from orebridge.plans import views
from orebridge.plans.dims import with_location_ids, with_time_ids
from orebridge.plans.views import VIEW_NAMES
from orebridge.session import reliable_checkpoint

PARTITION_COL = "reading_month"
LOAD_COL = "load_id"
LOADS = "loads"

# Catalog comments of the two facts.
TABLE_COMMENTS = {
    "fact_sensor_readings": (
        "Online sensor grade readings, one row per shovel load: every load, fast, "
        "less precise than the lab."),
    "fact_assay_results": (
        "Lab assays of samples taken from loads: about 8% of loads, precise, results "
        "2-5 working days later. reading_id refers to fact_sensor_readings."),
}

FACTS = ("fact_sensor_readings", "fact_assay_results")

# Sort order inside the files of each fact, and the column its Bloom filter covers.
LAYOUT = {
    "fact_sensor_readings": [PARTITION_COL, "equipment_id", "bench_id", "timestamp"],
    "fact_assay_results": ["sample_date"],
}
BLOOM_COLUMN = "reading_id"
# Time column of each fact, and its date, which is stored beside it (not in the view): Parquet
# keeps statistics of both, but Spark's scans use those of dates only.
DAY_COLS = {"fact_sensor_readings": ("timestamp", "reading_day"), "fact_assay_results": ("sample_date", "sample_day")}
BLOOM_BYTES = 4 << 20
# Rows of one day that one writing task takes.
ROWS_PER_TASK = 4_000_000


def run_concurrently(spark: SparkSession, *tasks):
    """Run independent driver-side steps (each submits its own Spark jobs) at once;
    Spark schedules their jobs side by side. Threads inherit the caller's local
    properties (job group, scheduler pool). Results in order; the first error raises."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
        return [f.result() for f in futures]


def _data_schema(name: str) -> T.StructType:
    schema = schemas.TABLES[name]
    if name == "fact_sensor_readings":
        schema = T.StructType(schema.fields + [T.StructField(PARTITION_COL, T.DateType(), True)])
    return schema


def _stored_columns(name: str) -> list[T.StructField]:
    """Columns of the stored table but its partition columns."""
    day = [T.StructField(DAY_COLS[name][1], T.DateType(), True)] if name in DAY_COLS else []
    return [f for f in _data_schema(name).fields if f.name != PARTITION_COL] + day


def _partitions(name: str) -> list[str]:
    return [LOAD_COL] + ([PARTITION_COL] if name == "fact_sensor_readings" else [])


@dataclass
class StagedFacts:
    """Facts written under a load that is not committed: its id, the rows and their counts."""
    load: str
    sensor: DataFrame
    assay: DataFrame
    counts: dict[str, int]


class Warehouse:
    """Typed tables under `root` (a shared-storage URI on a cluster), in the catalog database
    `database` (default: one named after the root).

    `buckets`: bucket both facts by reading_id, for shuffle-free joins between them.
    `write_options`: Parquet options of the facts (e.g. row group size), set at creation.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None,
                 database: str | None = None, tasks_per_bucket: int = 4,
                 write_options: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.database = database or "orebridge_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        self.tasks_per_bucket = tasks_per_bucket
        self.write_options = write_options or {}
        self._opened = False

    # ---- tables
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _bucketed(self, name: str) -> bool:
        return bool(self.buckets) and name in FACTS

    def catalog_name(self, name: str) -> str:
        """The table (a view over committed loads) or view as SQL knows it."""
        return f"{self.database}.{name}"

    def stored_name(self, name: str) -> str:
        """The stored table behind it, with the partitions of all loads."""
        return f"{self.database}.{name if name == LOADS else 'stored_' + name}"

    def _table_ddl(self, name: str) -> str:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _stored_columns(name))
        parts = f"{LOAD_COL} STRING" + (f", {PARTITION_COL} DATE" if PARTITION_COL in _partitions(name) else "")
        options, clustered = {}, ""
        if self._bucketed(name):
            clustered = f"CLUSTERED BY ({BLOOM_COLUMN}) SORTED BY ({BLOOM_COLUMN}) INTO {self.buckets} BUCKETS "
        elif name in FACTS:
            options = {f"parquet.bloom.filter.enabled#{BLOOM_COLUMN}": "true",
                       "parquet.bloom.filter.adaptive.enabled": "true",
                       "parquet.bloom.filter.max.bytes": str(BLOOM_BYTES)}
        if name in FACTS:
            options |= self.write_options
        listed = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
        comment = TABLE_COMMENTS.get(name, "").replace("'", "''")
        return (f"CREATE TABLE IF NOT EXISTS {self.stored_name(name)} ({cols}, {parts}) USING parquet "
                + (f"OPTIONS ({listed}) " if options else "")
                + f"PARTITIONED BY ({', '.join(_partitions(name))}) {clustered}"
                f"LOCATION '{self.path(name)}'" + (f" COMMENT '{comment}'" if comment else ""))

    def _live(self, name: str) -> str:
        """SQL: ids of the committed loads whose rows table `name` shows."""
        loads = self.stored_name(LOADS)
        since = f"SELECT max({LOAD_COL}) FROM {loads} WHERE array_contains(replaces, '{name}')"
        return f"SELECT collect_list({LOAD_COL}) FROM {loads} WHERE {LOAD_COL} >= coalesce(({since}), '')"

    def create(self) -> None:
        """CREATE TABLE / VIEW IF NOT EXISTS for the five tables (A6, A18) and the four analytic
        views (A17). Tables whose folders exist, but not their catalog entries (a session
        without a persistent metastore), are found again with the loads in them."""
        known = self.spark.catalog.databaseExists(self.database) and self.spark.catalog.tableExists(
            self.stored_name(LOADS))
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/_catalog'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.stored_name(LOADS)} (replaces ARRAY<STRING>, "
            f"committed_at TIMESTAMP_NTZ, n_rows MAP<STRING, BIGINT>, {LOAD_COL} STRING) USING parquet "
            f"PARTITIONED BY ({LOAD_COL}) LOCATION '{self.path(LOADS)}'")
        for name in schemas.TABLES:
            self.spark.sql(self._table_ddl(name))
        if not known:
            self._find_partitions(*schemas.TABLES, LOADS)
            for name in schemas.TABLES:
                cols = ", ".join(f.name for f in _data_schema(name).fields)
                comment = TABLE_COMMENTS.get(name, "").replace("'", "''")
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {self.catalog_name(name)} "
                    + (f"COMMENT '{comment}' " if comment else "")
                    + f"AS SELECT {cols} FROM {self.stored_name(name)} "
                    f"WHERE array_contains(({self._live(name)}), {LOAD_COL})")
            for ddl in views.view_ddl(self.database).values():
                self.spark.sql(ddl)
        self._opened = True

    def _folder(self, path: str):
        """Hadoop file system and path of a folder."""
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(sc._jsc.hadoopConfiguration()), folder

    def _find_partitions(self, *names: str) -> None:
        """Enter the partitions of existing table folders into the catalog."""
        for name in names:
            fs, folder = self._folder(self.path(name))
            if fs.exists(folder):
                self.spark.sql(f"MSCK REPAIR TABLE {self.stored_name(name)}")

    def _open(self) -> None:
        if not self._opened:
            self.create()

    def live_loads(self, name: str) -> list[str]:
        """Ids of the loads that make up table `name` now."""
        self._open()
        return sorted(self.spark.sql(self._live(name)).first()[0])

    def _stored(self, name: str, loads: list[str]) -> DataFrame:
        return self.spark.table(self.stored_name(name)).where(F.col(LOAD_COL).isin(loads))

    def _of_loads(self, name: str, loads: list[str]) -> DataFrame:
        return self._stored(name, loads).select(*_data_schema(name).fieldNames())

    def table(self, name: str) -> DataFrame:
        """A table as committed now; later loads do not change the frame. The load ids are
        literals, so other partitions are pruned and bucketing is kept."""
        return self._of_loads(name, self.live_loads(name))

    def rows_between(self, name: str, start, end) -> DataFrame:
        """Rows of a fact with start <= time < end (datetimes): the lookup its time index
        serves. Months and dates outside are pruned and skipped."""
        time, day = DAY_COLS[name]
        first, last = start.date(), end.date()

        def literal(t):          # by text: a datetime literal would be moved to the session's zone
            return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
        rows = self._stored(name, self.live_loads(name)).where(
            (F.col(time) >= literal(start)) & (F.col(time) < literal(end)) & F.col(day).between(first, last))
        if PARTITION_COL in _partitions(name):
            rows = rows.where(F.col(PARTITION_COL).between(first.replace(day=1), last))
        return rows.select(*_data_schema(name).fieldNames())

    def row_count(self, name: str) -> int:
        """SELECT COUNT(*) of a table, e.g. as a readiness check."""
        return self.table(name).count()

    # ---- loads
    def begin_load(self) -> str:
        """Id of a new load: ids sort in the order in which loads begin."""
        self._open()
        last = self.spark.table(self.stored_name(LOADS)).agg(F.max(LOAD_COL)).first()[0]
        number = int(last.split("-")[0]) + 1 if last else 1
        return f"{number:012d}-{uuid.uuid4().hex[:12]}"

    def _insert(self, name: str, df: DataFrame, load: str, busiest_day: int | None = None) -> int:
        """Add rows as partitions of `load` with Spark's committer; the number of rows, observed
        during the write (A15). Readers do not see them before the commit.

        Facts are dealt into contiguous ranges of their layout, which samples the rows first.
        Where the number of rows of the busiest day is known, they are dealt by day instead,
        each day to as many tasks as that one needs, which reads the rows once.
        """
        if name in DAY_COLS:
            time, day = DAY_COLS[name]
            df = df.withColumn(day, F.to_date(time))
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in _stored_columns(name)],
                       F.lit(load).alias(LOAD_COL), *[F.col(c) for c in _partitions(name)[1:]])
        if self._bucketed(name):
            # partition number modulo buckets is the bucket: several tasks share each bucket
            df = df.repartition(self.buckets * self.tasks_per_bucket, BLOOM_COLUMN)
        elif name in LAYOUT:
            # a task's rows lie together in the layout: few files per month folder
            if busiest_day is None:
                df = df.repartitionByRange(*LAYOUT[name])
            else:
                share = F.pmod(F.xxhash64(*schemas.TABLE_KEYS[name]), F.lit(busiest_day // ROWS_PER_TASK + 1))
                df = df.repartition(F.col(DAY_COLS[name][1]), share)
            df = df.sortWithinPartitions(*LAYOUT[name])
        # above the exchange: the range sampling job must not add to the count
        seen = Observation(f"{name}_rows")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        df.write.insertInto(self.stored_name(name))
        return int(seen.get["rows"])

    def commit_load(self, load: str, replaces: list[str], counts: dict[str, int]) -> None:
        """Show the load's rows: one row, one file, one catalog partition. `replaces`: tables
        that show nothing older from now on."""
        row = self.spark.range(1).select(
            F.array(*[F.lit(t) for t in replaces]).cast("array<string>").alias("replaces"),
            F.localtimestamp().alias("committed_at"),
            F.create_map(*[F.lit(x) for kv in counts.items() for x in kv]).cast("map<string,bigint>").alias("n_rows"),
            F.lit(load).alias(LOAD_COL))
        row.coalesce(1).write.insertInto(self.stored_name(LOADS))

    def drop_load(self, load: str) -> None:
        """Remove the partitions of a load that is not committed."""
        for name in schemas.TABLES:
            self._drop_partitions(name, [load])

    def _partition_specs(self, name: str) -> list[dict[str, str]]:
        """All partitions of a stored table (loads x months) as the catalog knows them."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.stored_name(name)}").collect()
        return [dict(level.split("=", 1) for level in r[0].split("/")) for r in listed]

    def _drop_partitions(self, name: str, loads: list[str]) -> None:
        for spec in self._partition_specs(name):
            if spec[LOAD_COL] in loads:
                values = ", ".join(f"{c} = null" if v == "__HIVE_DEFAULT_PARTITION__" else f"{c} = '{v}'"
                                   for c, v in spec.items())
                self.spark.sql(f"ALTER TABLE {self.stored_name(name)} DROP IF EXISTS PARTITION ({values})")
        for load in loads:
            fs, folder = self._folder(f"{self.path(name)}/{LOAD_COL}={load}")
            fs.delete(folder, True)

    def vacuum(self) -> dict[str, list[str]]:
        """Drop the partitions no reader of the current tables sees: loads that were replaced,
        and loads that were never committed. Loads in progress must have ended."""
        self._open()
        dropped = {}
        self._find_partitions(*schemas.TABLES)
        for name in schemas.TABLES:
            live = set(self.live_loads(name))
            dropped[name] = sorted({spec[LOAD_COL] for spec in self._partition_specs(name)} - live)
            self._drop_partitions(name, dropped[name])
        return dropped

    # ---- dimensions
    def load_dimensions(self, dim_equipment: DataFrame, dim_location: DataFrame,
                        dim_time: DataFrame, mode: str = "append") -> dict[str, int]:
        """Insert new members only; existing rows keep their attributes and keys.

        With mode="overwrite" the tables are replaced (keys restart at 1). The three
        tables are independent and load concurrently; each is checked before its write.
        """
        staged = self.stage_dimensions(dim_equipment, dim_location, dim_time, mode)
        load = self.begin_load()
        counts = self._insert_dimensions(staged, load)
        self.commit_load(load, list(staged) if mode == "overwrite" else [], counts)
        return counts

    def stage_dimensions(self, dim_equipment: DataFrame, dim_location: DataFrame,
                         dim_time: DataFrame, mode: str = "append") -> dict[str, DataFrame]:
        """The checked rows each dimension would gain; nothing is written to a table."""
        self._open()
        incoming = {"dim_equipment": dim_equipment, "dim_location": dim_location,
                    "dim_time": dim_time}
        names = list(incoming)
        staged = run_concurrently(self.spark, *[
            (lambda n=n: self._stage_dimension(n, incoming[n], mode == "overwrite"))
            for n in names])
        return dict(zip(names, staged))

    def _insert_dimensions(self, staged: dict[str, DataFrame], load: str) -> dict[str, int]:
        names = list(staged)
        counts = run_concurrently(self.spark, *[
            (lambda n=n: self._insert(n, staged[n], load)) for n in names])
        return dict(zip(names, counts))

    def _with_defaults(self, name: str, df: DataFrame) -> DataFrame:
        """Columns the rows lack get the table's default (A10)."""
        kinds = {f.name: f.dataType for f in schemas.TABLES[name].fields}
        absent = {c: F.lit(v).cast(kinds[c]) for c, v in schemas.TABLE_DEFAULTS.get(name, {}).items()
                  if c not in df.columns}
        return df.withColumns(absent) if absent else df

    def _stage_dimension(self, name: str, incoming: DataFrame, replace: bool) -> DataFrame:
        key = schemas.TABLE_KEYS[name]
        incoming = self._with_defaults(name, incoming)
        existing = None if replace else self.table(name)
        staged = reliable_checkpoint(
            incoming if existing is None else insert_if_absent(incoming, existing, key))
        assert_all_empty({f"{name}: duplicate or NULL keys": key_violations(staged, key)},
                         self._declared(name, staged))
        if name == "dim_location":
            start = None if existing is None else max_key(existing, "location_id")
            staged = with_location_ids(staged, start_after=start, materialized=True)
        elif name == "dim_time":
            start = None if existing is None else max_key(existing, "time_id")
            staged = with_time_ids(staged, start_after=start, materialized=True)
        if "created_at" in schemas.TABLES[name].fieldNames():
            staged = staged.withColumn("created_at", F.localtimestamp())
        return staged

    def _declared(self, name: str, rows: DataFrame) -> list[DataFrame]:
        """The table's NOT NULL and VARCHAR(n) declarations, checked in one scan of `rows`."""
        checks = declared_checks(schemas.TABLE_NOT_NULL[name], schemas.TABLE_VARCHAR[name])
        return [failed_rows(rows, {f"{name}: {k}": v for k, v in checks.items()})] if checks else []

    # ---- facts
    def _members(self, name: str, dims: dict[str, DataFrame] | None, replace: bool) -> DataFrame:
        """Keys of a dimension as they will be once `dims` are committed."""
        key = schemas.TABLE_KEYS[name]
        if not dims:
            return self.table(name).select(*key)
        new = dims[name].select(*key)
        return new if replace else self.table(name).select(*key).unionByName(new)

    def check_facts(self, sensor: DataFrame, assay: DataFrame, replace: bool = False,
                    dims: dict[str, DataFrame] | None = None) -> None:
        """Raise KeyCheckError if the batch breaks a constraint. `dims`: staged dimension rows
        that are to be committed with the facts.

        All checks run as one job; the error lists every failed check.
        """
        s_name, a_name = "fact_sensor_readings", "fact_assay_results"
        a_key = schemas.TABLE_KEYS[a_name]
        checks = {
            f"{a_name}: duplicate or NULL keys": key_violations(assay, a_key),
            f"{s_name}.equipment_id not in dim_equipment":
                fk_orphans(sensor, self._members("dim_equipment", dims, replace), ["equipment_id"]),
            f"{s_name}.bench_id not in dim_location":
                fk_orphans(sensor, self._members("dim_location", dims, replace), ["bench_id"]),
        }
        if not replace:
            checks[f"{a_name}: keys already stored"] = assay.select(*a_key).join(
                self.table(a_name).select(*a_key), a_key, "left_semi")
        row_checks = self._declared(s_name, sensor) + self._declared(a_name, assay)
        if self._bucketed(s_name):
            checks |= self._reading_checks(sensor, assay, replace)
        else:
            row_checks.append(self._failed_readings(sensor, assay, replace))
        assert_all_empty(checks, row_checks)

    def _reading_checks(self, sensor: DataFrame, assay: DataFrame, replace: bool) -> dict[str, DataFrame]:
        """The checks on reading_id, one by one: on bucketed facts none of them shuffles a fact."""
        s_name, a_name = "fact_sensor_readings", "fact_assay_results"
        s_key = schemas.TABLE_KEYS[s_name]
        checks = {f"{s_name}: duplicate or NULL keys": key_violations(sensor, s_key)}
        readings = sensor.select(*s_key)
        if not replace:
            stored = self.table(s_name).select(*s_key)
            checks[f"{s_name}: keys already stored"] = readings.join(stored, s_key, "left_semi")
            readings = readings.unionByName(stored)
        checks[f"{a_name}.reading_id not in {s_name}"] = fk_orphans(assay, readings, s_key)
        return checks

    def _failed_readings(self, sensor: DataFrame, assay: DataFrame, replace: bool) -> DataFrame:
        """The same checks from one table of the uses of each reading_id: without buckets each of
        them would shuffle the keys of the incoming or of all stored readings anew."""
        s_name, a_name = "fact_sensor_readings", "fact_assay_results"
        s_key = schemas.TABLE_KEYS[s_name]
        frames = {"__new": sensor, "__assays": assay} | ({} if replace else {"__stored": self.table(s_name)})
        new, assays = F.col("__new"), F.col("__assays")
        stored = F.lit(0) if replace else F.col("__stored")
        present = all_of(F.col(c).isNotNull() for c in s_key)
        return failed_rows(key_usage(frames, s_key), {
            f"{s_name}: duplicate or NULL keys":
                ((new > 1) | ((new > 0) & ~present), [*s_key, new.alias("n_rows")]),
            f"{s_name}: keys already stored": (present & (new > 0) & (stored > 0), s_key, new),
            f"{a_name}.reading_id not in {s_name}":
                (present & (assays > 0) & (new + stored == 0), [*s_key, assays.alias("n_rows")]),
        })

    def stage_facts(self, sensor: DataFrame, assay: DataFrame, load: str | None = None,
                    busiest_day: int | None = None) -> StagedFacts:
        """Compute both incoming facts once and write them, in their final layout, as
        partitions of a load that is not committed yet. `busiest_day`: an upper bound of the
        readings of any day, if known."""
        load = load or self.begin_load()
        sensor = self._with_defaults("fact_sensor_readings", sensor).select(*schemas.SENSOR_FACT_COLUMNS)
        assay = assay.select(*schemas.ASSAY_FACT_COLUMNS)
        now = F.localtimestamp()
        sensor = sensor.withColumns({"loaded_at": now,
                                     PARTITION_COL: F.to_date(month_start("timestamp"))})
        counts = run_concurrently(
            self.spark,
            lambda: self._insert("fact_sensor_readings", sensor, load, busiest_day),
            lambda: self._insert("fact_assay_results", assay.withColumn("loaded_at", now), load))
        return StagedFacts(load, *[self._of_loads(n, [load]) for n in FACTS], dict(zip(FACTS, counts)))

    def load_facts(self, sensor: DataFrame | None, assay: DataFrame | None,
                   mode: str = "append", staged: StagedFacts | None = None,
                   dims: dict[str, DataFrame] | None = None) -> dict[str, int]:
        """Checked append (or overwrite) of both facts; nothing is committed when a check
        fails. `staged`: the result of `stage_facts`, if already computed; `dims`: staged
        dimensions, committed together with the facts."""
        replace = mode == "overwrite"
        st = staged or self.stage_facts(sensor, assay)
        try:
            self.check_facts(st.sensor, st.assay, replace=replace, dims=dims)
            counts = {**(self._insert_dimensions(dims, st.load) if dims else {}), **st.counts}
        except Exception:
            self.drop_load(st.load)
            raise
        self.commit_load(st.load, [*(dims or {}), *FACTS] if replace else [], counts)
        return counts

    # ---- catalog and views
    def register_views(self) -> dict[str, DataFrame]:
        """The four analytic views (catalog views over the committed tables), by key."""
        self._open()
        return {key: self.spark.table(self.catalog_name(name)) for key, name in VIEW_NAMES.items()}
