"""Dense row numbers in a given order, without a window over the whole table."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.plans.staging import stage

ROW_MASK = (1 << 33) - 1   # monotonically_increasing_id keeps the row within a partition here


def number_rows(df: DataFrame, order: list[Column | str], name: str = "n") -> DataFrame:
    """Add 0, 1, 2, ... in ``order``: sort by range, count per partition, add the running totals."""
    placed = stage(
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_MASK))),
        "numbered")
    # One row per sort partition, so the single-task window is bounded by the partition count.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
              .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    return (placed.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_row"))
            .drop("_part", "_row", "_start"))
