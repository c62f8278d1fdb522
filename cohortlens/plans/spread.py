"""Joins of many rows to one row per key that survive a key holding a large share of all rows."""

from pyspark.sql import Column, DataFrame, functions as F

# A key with more left rows than this is cut into pieces of about this many rows. At most
# |left| / HOT_ROWS keys can be hot, which bounds the broadcast below.
HOT_ROWS = 1_000_000
KEYLESS_PIECES = 4096


def row_hash(df: DataFrame) -> Column:
    """A hash of all values of a row."""
    columns = [F.to_json(f"`{c}`") if kind.startswith("map") else F.col(f"`{c}`") for c, kind in df.dtypes]
    return F.xxhash64(*columns)


def spread_join(left: DataFrame, right: DataFrame, on: str, weight: str, how: str = "inner",
                hot_rows: int | None = None) -> DataFrame:
    """Join ``left`` to ``right``, which has one row per key and the key's left row count in ``weight``.

    Adaptive execution splits a skewed join only if both sides come straight from a shuffle, and a
    side aggregated on the join key does not. So hot keys get a salt here: their left rows take
    one of n pieces, and their single right row is repeated n times. Rows without a key match nothing,
    so any salt will do for them and keeps them from meeting in one task.

    The salt is a hash of the row's own values, so a task that runs again deals its rows as before, in whatever order
    they arrive. Rows that are equal in all columns share a piece.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    pieces = F.ceil(F.col(weight) / F.lit(hot_rows)).cast("int")
    hot = right.where(F.col(weight) > hot_rows).select(on, pieces.alias("_pieces"))
    number = row_hash(left)
    spread = F.when(F.col(on).isNull(), F.lit(KEYLESS_PIECES)).otherwise(F.coalesce("_pieces", F.lit(1)))
    salted_left = (
        left.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.pmod(number, spread).cast("int")).drop("_pieces"))
    salted_right = right.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1)))
    return salted_left.join(salted_right, [on, "_salt"], how).drop("_salt")
