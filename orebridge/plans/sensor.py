"""Sensor quality control: duplicate, imputation, outlier and QC flags.

Order of steps, as the reference runs them: medians and outlier bounds come from
all raw rows, duplicates included; imputation precedes the QC flag, so an imputed
row can pass.

The raw rows are read twice in all: once for the statistics and once for the rows
themselves. The statistics are one aggregation with grouping sets (`raw_statistics`):
the (equipment, tonnage) counts behind the exact medians, the global grade moments behind
the bounds, the distinct equipment, benches and dates behind the dimensions and, if asked
for, the keys that occur more than once with their first arrival. Only slim partial
aggregates are shuffled; flagging and imputing the rows is then a broadcast lookup.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from orebridge import schemas
from orebridge.functions import to_date
from orebridge.operators import (attach, flag_outliers, impute_group_median, keep_first,
                                 limits_from_moments, median_from_counts, moments, semi_reduce,
                                 sigma_bounds)
from orebridge.operators.joins import all_of
from orebridge.session import reliable_checkpoint

KEY, ORDER = ["reading_id"], ["ingest_seq"]
GROUP, MEASURE, GRADE = ["equipment_id"], "tonnage", "sensor_cu_grade"
_DATE = "full_date"
_DIMENSIONS = [*GROUP, MEASURE, "bench_id", _DATE, *KEY]


def _grouping(members: list[str]) -> int:
    """grouping_id() of a grouping set: one bit per dimension, set where it is left out."""
    return sum(1 << n for n, c in enumerate(reversed(_DIMENSIONS)) if c not in members)


@dataclass
class RawStatistics:
    """What one pass over the raw rows found (see `raw_statistics`), checkpointed."""
    table: DataFrame
    has_repeated: bool

    def _set(self, members: list[str]) -> DataFrame:
        return self.table.where(F.col("grouping") == _grouping(members))

    def medians(self) -> DataFrame:
        """Exact tonnage median per equipment."""
        present = all_of(F.col(c).isNotNull() for c in [*GROUP, MEASURE])
        return median_from_counts(self._set([*GROUP, MEASURE]).where(present), GROUP, MEASURE, materialized=True)

    def bounds(self) -> DataFrame:
        """The grade bounds."""
        return limits_from_moments(self._set([]).select("mean", "std"))

    def equipment(self) -> DataFrame:
        """The equipment that occurs (D17), NULL included."""
        return self._set([*GROUP, MEASURE]).select(*GROUP).distinct()

    def benches(self) -> DataFrame:
        return self._set(["bench_id"]).select("bench_id")

    def dates(self) -> DataFrame:
        """The dates of readings."""
        return self._set([_DATE]).select(_DATE)

    def busiest_day(self) -> int:
        """Readings of the date that has most."""
        return int(self._set([_DATE]).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])

    def repeated(self) -> DataFrame:
        """Keys that occur more than once, with their first arrival."""
        return self._set(KEY).select(*KEY, F.col("first").alias("__first"))

    def first_is_unique(self, raw: DataFrame) -> bool:
        """Whether one row of each reading arrives first (a slim pass over its key and arrival
        number): not where rows come twice with the same number, or without one."""
        arrivals = attach(raw.select(*KEY, *ORDER), self.repeated(), KEY, how="inner", null_safe=True)
        firsts = arrivals.where(F.col(ORDER[0]).eqNullSafe(F.col("__first"))).groupBy(*KEY)
        return firsts.agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def raw_statistics(raw: DataFrame, repeated: bool = False) -> RawStatistics:
    """One aggregation over the raw rows with a grouping set for each statistic; `repeated`
    adds the one per reading_id. Partial aggregation shrinks each set before the shuffle, and
    of the readings only those that occur more than once are kept."""
    sets = [[*GROUP, MEASURE], ["bench_id"], [_DATE], []] + ([KEY] if repeated else [])
    rows = raw.select(*KEY, *ORDER, *GROUP, "bench_id", MEASURE, GRADE, to_date("timestamp").alias(_DATE))
    stats = rows.groupingSets(sets, *_DIMENSIONS).agg(
        F.count(F.lit(1)).alias("n"), F.min(ORDER[0]).alias("first"), *moments(GRADE),
        F.grouping_id().alias("grouping"))
    kept = stats.where((F.col("grouping") != _grouping(KEY)) | (F.col("n") > 1))
    return RawStatistics(reliable_checkpoint(kept), repeated)


def tonnage_medians(raw: DataFrame) -> DataFrame:
    return raw_statistics(raw).medians()


def _qc(df: DataFrame) -> DataFrame:
    return df.withColumn("qc_passed", ~F.col("is_duplicate") & ~F.col("is_outlier")
                         & F.col(MEASURE).isNotNull())


def _filled_and_flagged(df: DataFrame, stats: RawStatistics) -> DataFrame:
    filled = impute_group_median(df, GROUP, MEASURE, medians=stats.medians())
    return _qc(flag_outliers(filled, GRADE, bounds=stats.bounds()))


def transform_sensor(raw: DataFrame, keep_raw_tonnage: bool = False,
                     stats: RawStatistics | None = None) -> DataFrame:
    """Every raw row plus is_duplicate, is_outlier, qc_passed; tonnage imputed.

    A row is a duplicate if its reading occurs more than once and it is not the first to
    arrive: a lookup in the (few) repeated readings, NULL being one key, so the rows
    themselves are not shuffled. Arrival numbers are unique within a reading.
    """
    if stats is None or not stats.has_repeated:
        stats = raw_statistics(raw, repeated=True)
    df = raw.withColumn("tonnage_raw", F.col(MEASURE)) if keep_raw_tonnage else raw
    looked_up = attach(df, stats.repeated().withColumn("__again", F.lit(True)), KEY, null_safe=True)
    later = F.col("__again").isNotNull() & ~F.col(ORDER[0]).eqNullSafe(F.col("__first"))
    flagged = looked_up.withColumn("is_duplicate", later).select(*df.columns, "is_duplicate")
    return _filled_and_flagged(flagged, stats)


def sensor_fact(raw: DataFrame, stats: RawStatistics | None = None) -> DataFrame:
    """The rows that reach fact_sensor_readings: the first of each reading_id,
    flagged as `transform_sensor` flags them (so is_duplicate is FALSE).

    With `stats` that know the repeated readings the first rows are picked by a lookup,
    without a shuffle. Otherwise they are kept with one group-limited shuffle on reading_id;
    the output then stays partitioned on reading_id for the joins with the assays.
    """
    if stats is not None and stats.has_repeated:
        return transform_sensor(raw, stats=stats).where(~F.col("is_duplicate")).select(*schemas.SENSOR_FACT_COLUMNS)
    stats = stats or raw_statistics(raw)
    first = keep_first(raw, KEY, ORDER).withColumn("is_duplicate", F.lit(False))
    return _filled_and_flagged(first, stats).select(*schemas.SENSOR_FACT_COLUMNS)


def first_sensor_fact(raw: DataFrame, stats: RawStatistics) -> DataFrame:
    """`sensor_fact` for a caller that uses it several times: the rows are picked by a lookup
    wherever that gives one row per reading (checked), else kept with the shuffle."""
    if stats.has_repeated and not stats.first_is_unique(raw):
        stats = replace(stats, has_repeated=False)
    return sensor_fact(raw, stats)


def paired_sensor_fact(raw: DataFrame, assay: DataFrame, stats: RawStatistics | None = None) -> DataFrame:
    """The rows of `sensor_fact` whose reading may have an assay, for joins with `assay`.

    Statistics cover all raw rows; then readings without an assay (about nine in ten) leave
    before the first rows are kept, so they are never shuffled. Where the assays' keys are too
    many for an exact reduction some others stay, and the join drops them.
    """
    stats = stats or raw_statistics(raw)
    first = keep_first(semi_reduce(raw, assay, KEY[0]), KEY, ORDER).withColumn("is_duplicate", F.lit(False))
    return _filled_and_flagged(first, stats).select(*schemas.SENSOR_FACT_COLUMNS)


def outlier_bounds(raw: DataFrame) -> DataFrame:
    """The bounds the outlier flag uses (D1): mean, std, lower_limit, upper_limit."""
    return sigma_bounds(raw, GRADE)


def qc_counters(raw: DataFrame, stats: RawStatistics | None = None) -> DataFrame:
    """The run counters the transform prints (D19), as one row."""
    t = transform_sensor(raw, keep_raw_tonnage=True, stats=stats)
    return t.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("is_duplicate").alias("duplicates"),
        F.count_if(F.col("tonnage_raw").isNull()).alias("null_tonnage"),
        F.count_if("is_outlier").alias("outliers"),
        F.count_if("qc_passed").alias("qc_passed"),
    )
