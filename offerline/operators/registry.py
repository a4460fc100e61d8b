"""Daily opportunity ids: which codes need one, and their numbering.

The registry holds (cod_sap, id_oportunidade, dt_oportunidade), partitioned
by date. Ids of a day are yyMMdd + a 6-digit running number. A run issues
ids only to codes without one on the run date and numbers them after the
day's highest number, so a re-run issues nothing and earlier ids stay.
The registry must have one writer per day (no transaction guards two
concurrent runs of the same day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerline.functions.numbers import id_sequence, opportunity_id

CODE = "cod_sap"
ID = "id_oportunidade"
DAY = "dt_oportunidade"

# Codes are numbered in buckets of this many consecutive code values; a
# bucket holds at most this many distinct codes, so no task sorts more.
DEFAULT_BUCKET_WIDTH = 1 << 16


def _day(run_date) -> Column:
    return F.lit(str(run_date)).cast("date")


def registry_of_day(registry: DataFrame, run_date) -> DataFrame:
    """Registry rows of the run date (pruned on the partition column)."""
    return registry.filter(F.col(DAY) == _day(run_date))


def new_codes(codes: DataFrame, registry: DataFrame, run_date, code: str = CODE) -> DataFrame:
    """Distinct codes with no id on the run date (anti join). A NULL code
    stops the job: it could get no id."""
    today = registry_of_day(registry, run_date).select(CODE)
    value = F.col(code).cast("bigint")
    checked = F.when(value.isNull(), F.raise_error(F.lit(f"NULL in {code}")).cast("bigint")).otherwise(value)
    return codes.select(checked.alias(CODE)).distinct().join(today, CODE, "left_anti")


def _bucket(value, width: int) -> Column:
    """Number of the bucket of ``width`` consecutive values, in integers."""
    c = F.col(value) if isinstance(value, str) else value
    return F.floor((c - F.pmod(c, F.lit(width))).cast("decimal(20,0)") / F.lit(width)).cast("bigint")


def _offsets(counts: DataFrame, levels: int) -> DataFrame:
    """(__bk, __off): rows in all lower buckets. Buckets are themselves summed
    in buckets of 65,536, ``levels`` times; a window sees one of those, and
    the top one at most 65,536 rows for codes of 64 bits."""
    before = Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    if not levels:
        return counts.select("__bk", F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"))
    counts = counts.withColumn("__up", _bucket("__bk", DEFAULT_BUCKET_WIDTH))
    up = _offsets(counts.groupBy(F.col("__up").alias("__bk")).agg(F.sum("__cnt").alias("__cnt")), levels - 1)
    up = up.select(F.col("__bk").alias("__up"), F.col("__off").alias("__base"))
    before = Window.partitionBy("__up").orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    own = counts.withColumn("__in", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
    return own.join(up, "__up").select("__bk", (F.col("__in") + F.col("__base")).alias("__off"))


def number_in_order(df: DataFrame, key: str = CODE, bucket_width: int = DEFAULT_BUCKET_WIDTH,
                    start: Column | int = 0, name: str = "n") -> DataFrame:
    """Global 1-based running number in ``key`` order (key values distinct)
    without a one-partition sort: rows are numbered inside buckets of
    ``bucket_width`` consecutive key values, and each bucket adds the row
    count of all lower buckets (summed level by level)."""
    keyed = df.withColumn("__bk", _bucket(key, bucket_width))
    offsets = _offsets(keyed.groupBy("__bk").agg(F.count(F.lit(1)).alias("__cnt")), 2)
    local = F.row_number().over(Window.partitionBy("__bk").orderBy(key))
    start = start if isinstance(start, Column) else F.lit(start)
    return (keyed.withColumn("__local", local).join(offsets, "__bk")
            .withColumn(name, F.col("__local") + F.col("__off") + start)
            .drop("__bk", "__local", "__off"))


def day_max_sequence(registry: DataFrame, run_date) -> Column:
    """Highest running number already issued on the run date (0 if none), as
    a scalar subquery evaluated once."""
    return registry_of_day(registry, run_date).select(
        F.coalesce(F.max(id_sequence(ID)), F.lit(0)).cast("bigint")).scalar()


def issue_ids(codes: DataFrame, registry: DataFrame, run_date, code: str = CODE,
              bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """New registry rows (cod_sap, id_oportunidade, dt_oportunidade) for the
    codes that have no id on the run date."""
    fresh = new_codes(codes, registry, run_date, code)
    numbered = number_in_order(fresh, CODE, bucket_width, day_max_sequence(registry, run_date))
    return numbered.select(
        CODE,
        opportunity_id(_day(run_date), F.col("n")).alias(ID),
        _day(run_date).alias(DAY),
    )
