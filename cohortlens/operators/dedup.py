"""Choosing one row per key."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortlens.functions import nan_to_null
from cohortlens.model import KEY, ORDER
from cohortlens.operators.filters import is_numeric
from cohortlens.plans.spread import spread_join

RULES = ("min", "max")


def check_criteria(df: DataFrame, criteria: list[tuple[str, str]], check_values: bool = True) -> None:
    """Fail at once if a criterion names an unknown column or rule, or, with ``check_values``, a value that no row has."""
    if not criteria:
        raise TypeError("no criteria given: name a column and a rule, e.g. ('pcMapped', 'max')")
    for column, rule in criteria:
        if column not in df.columns:
            raise ValueError(f"invalid criterion '{column}': must be one of: {', '.join(df.columns)}")
        if is_numeric(df, column):
            if rule not in RULES:
                raise ValueError(f"invalid rule '{rule}' for the numeric column '{column}': min or max")
        elif check_values and df.where(F.col(column) == F.lit(rule)).isEmpty():
            raise ValueError(f"invalid rule '{rule}': no row of column '{column}' has this value")


def _preference(df: DataFrame, column: str, rule: str, key: str) -> list[Column]:
    """Ascending sort values that put the preferred rows first; rows without a key have no preference."""
    ranked = F.col(key).isNotNull()
    if not is_numeric(df, column):
        return [F.when(ranked, F.coalesce(F.col(column) != F.lit(rule), F.lit(True)))]
    value = nan_to_null(df, column)
    if rule == "max":   # reversed; the complement of an integer cannot overflow as its negative can
        value = F.bitwise_not(value) if isinstance(df.schema[column].dataType, T.IntegralType) else -value
    # A struct sorts NULL first, so a flag before each number puts missing ones last.
    return [F.when(ranked, value.isNull()), F.when(ranked, value)]


def with_values(best: DataFrame, df: DataFrame, criteria: list[tuple[str, str]]) -> DataFrame:
    """Fail while the rows are computed if no row of the input has a criterion's value; a subquery looks for one."""
    for column, rule in criteria:
        if not is_numeric(df, column):
            found = df.where(F.col(column) == F.lit(rule)).select(F.lit(1).alias("one")).limit(1).agg(F.count("one")).scalar()
            message = F.raise_error(F.lit(f"invalid rule '{rule}': no row of column '{column}' has this value")).cast("boolean")
            best = best.where(F.when(found == 0, message).otherwise(F.lit(True)))
    return best


def best_per_key(df: DataFrame, criteria: list[tuple[str, str]], key: str = KEY,
                 order: list[Column | str] = (ORDER,), check_values: bool = True) -> DataFrame:
    """One row per key by criteria in order of importance, then by row order.

    Each criterion keeps the best rows of those the one before left and never removes all, so the
    survivor is the first row in lexicographic order. ``min_by`` combines before the shuffle, so a hot
    key sends one row per task, and rows are sorted by the key alone. With ``check_values`` a text criterion whose value
    no row has fails the query that computes the rows; nothing runs before.
    """
    check_criteria(df, criteria, check_values=False)
    rank = F.struct(*[v for c, r in criteria for v in _preference(df, c, r, key)], *order)
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), rank).alias("_best"))
    best = best.select(*[F.col(c) if c == key else F.col("_best")[c].alias(c) for c in df.columns])
    return with_values(best, df, criteria) if check_values else best


def first_per_key(df: DataFrame, key: str, columns: list[str],
                  order: list[Column | str] = (ORDER,)) -> DataFrame:
    """The first row of each key in row order, reduced to a few columns."""
    first = F.min_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(key).agg(first.alias("_first")).select(key, "_first.*")


def stage_removals(df: DataFrame, column: str, rule: str, key: str = KEY,
                   hot_rows: int | None = None) -> DataFrame:
    """The rows that one criterion removes: those short of the best of their key.

    The best of each key comes from a partially combined aggregation and is joined back to the rows
    that can lose, with hot keys spread; a window would sort a whole hot key in one task.
    """
    check_criteria(df, [(column, rule)], check_values=False)
    rows, grouped = F.count(F.lit(1)), df.where(F.col(key).isNotNull()).groupBy(key)
    if is_numeric(df, column):
        value = nan_to_null(df, column)
        best = F.max(value) if rule == "max" else F.min(value)
        keys = (grouped.agg(best.alias("_best"), rows.alias("_weight"))
                .where("_best IS NOT NULL AND _weight > 1"))
        loses = value.isNull() | (value != F.col("_best"))
        candidates = df
    else:
        hit = F.coalesce(F.col(column) == F.lit(rule), F.lit(False))
        keys = (grouped.agg(F.bool_or(hit).alias("_best"), rows.alias("_weight"))
                .where("_best AND _weight > 1"))
        loses = F.lit(True)
        candidates = df.where(~hit)
    joined = spread_join(candidates, keys, key, "_weight", hot_rows=hot_rows)
    return joined.where(loses).select(*df.columns)
