"""Broadcast only what was measured to be small, and keep another way for what is not."""

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from cohortlens.plans.spread import spread_join

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 16


def measured_bytes(df: DataFrame) -> int:
    """The size of a frame, observed while its rows are read and thrown away: one job for a frame without shuffles."""
    fixed, varying = ROW_OVERHEAD, []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            varying.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            varying.append(F.coalesce(F.octet_length(column.cast("string")), F.lit(0)))
        else:
            fixed += 8
    width = sum(varying, F.lit(fixed)).cast("bigint")
    seen = Observation()
    df.select(width.alias("bytes")).observe(seen, F.sum("bytes").alias("bytes")).write.format("noop").mode("overwrite").save()
    return seen.get["bytes"] or 0


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def lookup_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner",
                limit: int | None = None, measured: DataFrame | None = None) -> DataFrame:
    """Join rows to a table with one row per key (``how``: inner, left, left_semi or left_anti).

    A right side measured to be small is broadcast, so the left side is not shuffled. A larger one
    is shuffled, and keys that are hot on the left are spread over several tasks. ``measured`` is a frame that is
    at least as large as the right side and cheaper to read, such as its rows before they were made distinct.
    """
    if fits_broadcast(right if measured is None else measured, limit):
        return left.join(F.broadcast(right), on, how)
    weighted = (left.groupBy(on).agg(F.count(F.lit(1)).alias("_weight"))
                .join(right, on))
    if how == "inner":
        return spread_join(left, weighted, on, "_weight").drop("_weight")
    if how == "left":
        return spread_join(left, weighted, on, "_weight", "left").drop("_weight")
    keys = weighted.select(on, "_weight")
    if how == "left_semi":
        return spread_join(left, keys, on, "_weight").drop("_weight")
    return spread_join(left, keys, on, "_weight", "left").where("_weight IS NULL").drop("_weight")
