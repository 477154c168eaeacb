"""Order within groups of any size: running sums, ranks, medians and as-of merges over range partitions (SMP1, SMP2, AGG3, AGG22).

A window over a whole group would hold the group in one task. Here rows are dealt by ranges of (group,
order) and written with the number of their range; a window never spans more than one range, and what the
ranges before it hold comes from a table of a row for each range and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.plans.materialize import materialize, release


def _ranged(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """rows in a table, dealt by ranges of (by, order), with the range's number as _part."""
    return materialize(rows.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), name)


def prefix_sums(rows: DataFrame, by: list[str], order: list[str], value: Column, name: str = "before") -> DataFrame:
    """rows with the sum of `value` over the rows before each, in order, within its group; rows of equal order come in any order."""
    r = _ranged(rows.withColumn("_v", value), by, order, "ranges")
    parts = r.groupBy(*by, "_part").agg(F.sum("_v").alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("_v").over(Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = r.withColumn("_i", inside).join(parts.select(*by, "_part", before.alias("_b")), [*by, "_part"])
    return r.select(*rows.columns, (F.col("_b") + F.col("_i")).alias(name))


def as_of(events: DataFrame, marks: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """events (*by, at, ..) with the `value` of the last mark (*by, at, value) of their group at or before them; null before a group's first mark. Of marks at one place the largest value counts."""
    own = [c for c in events.columns if c not in (*by, at)]
    marks = marks.groupBy(*by, at).agg(F.max(value).alias("_mark"))
    both = events.select(*by, at, F.struct(*own).alias("_own"), F.lit(1).alias("_kind"), F.lit(None).cast(marks.schema["_mark"].dataType).alias("_mark"))
    both = both.unionByName(marks.select(*by, at, F.lit(None).cast(both.schema["_own"].dataType).alias("_own"), F.lit(0).alias("_kind"), "_mark"))
    r = _ranged(both, by, [at, "_kind"], "as-of")
    last = r.where("_kind = 0").groupBy(*by, "_part").agg(F.max_by("_mark", at).alias("_last"))
    # a range without marks has none of its own to hand on
    parts = r.select(*by, "_part").distinct().join(last, [*by, "_part"], "left")
    carry = F.last("_last", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.last("_mark", ignorenulls=True).over(Window.partitionBy(*by, "_part").orderBy(at, "_kind"))
    r = r.withColumn("_in", inside).where("_kind = 1").join(parts.select(*by, "_part", carry.alias("_carry")), [*by, "_part"])
    return r.select(*by, at, "_own.*", F.coalesce("_in", "_carry").alias(value)).select(*events.columns, value)


def medians(rows: DataFrame, by: list[str], columns: list[str], large: int = 1 << 20) -> DataFrame:
    """(*by, n, *columns): each group's number of rows and exact medians, the mean of the middle two of an even number; nulls are left out of a column's.

    Groups of at most `large` rows are medians of one buffer each; those of larger ones are selected by their
    ranks over range partitions, a column at a time, so that no task holds a group.
    """
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"))
    big = materialize(sizes.where(F.col("n") > large).select(*by), "large-groups")
    plain = lambda r: r.groupBy(*by).agg(F.count("*").alias("n"), *(F.median(c).alias(c) for c in columns))
    if big.isEmpty():
        release(big)
        return plain(rows)
    out = sizes.join(big, by)
    of_big = rows.select(*by, *columns).join(big, by)
    for c in columns:
        ranked = prefix_sums(of_big.select(*by, c).where(F.col(c).isNotNull()), by, [c], F.lit(1).cast("long"), "_rank")
        total = ranked.groupBy(*by).agg((F.max("_rank") + 1).alias("_n"))
        middle = ranked.join(total, by).where((F.col("_rank") == F.expr("(_n - 1) div 2")) | (F.col("_rank") == F.expr("_n div 2")))
        out = out.join(middle.groupBy(*by).agg(F.avg(c).alias(c)), by, "left")
    return plain(rows.join(big, by, "left_anti")).unionByName(out)
