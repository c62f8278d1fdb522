"""Row filters compiled from a specification to Catalyst predicates."""

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from cohortlens.model import DEFAULT_FILTER, ColumnTypeError
from cohortlens.plans.sizing import lookup_join

NEGATION = "not_"
# Longer value lists become a table that is joined, so that the plan stays small.
INLINE_VALUES = 10_000


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def target_column(df: DataFrame, name: str) -> tuple[str, bool]:
    """The column a rule speaks of and whether the rule is negated."""
    if name not in df.columns and name.startswith(NEGATION):
        return name.removeprefix(NEGATION), True
    return name, False


def range_predicate(df: DataFrame, ranges: dict) -> Column:
    """``min <= column <= max`` for every rule; NULL and NaN fail the test.

    NaN needs no extra expression, because it sorts above every upper bound, so the comparison
    stays one that the Parquet scan can push down.
    """
    tests = []
    for column, bounds in ranges.items():
        if column not in df.columns:
            raise KeyError(column)
        if not is_numeric(df, column):
            raise ColumnTypeError(column, "float or int")
        numbers = isinstance(bounds, (list, tuple)) and all(isinstance(b, (int, float)) for b in bounds)
        if not numbers or len(bounds) != 2 or bounds[0] >= bounds[1]:
            raise ValueError(f"the filter on '{column}' must be two numbers, the second above the first")
        tests.append(F.col(column).between(*bounds))
    return reduce(Column.__and__, tests, F.lit(True))


def _check_members(df: DataFrame, members: dict) -> None:
    for name, values in members.items():
        column, _ = target_column(df, name)
        if column not in df.columns:
            raise KeyError(column)
        if not is_text(df, column):
            raise ColumnTypeError(column, "string")
        if not isinstance(values, list) or not all(isinstance(v, str) for v in values):
            raise ValueError(f"the filter on '{name}' must be a list of strings")


def member_predicate(df: DataFrame, members: dict) -> Column:
    """Membership tests; a negated test keeps rows whose value is missing."""
    _check_members(df, members)
    tests = []
    for name, values in members.items():
        column, negated = target_column(df, name)
        found = F.col(column).isin(values) if values else F.lit(False)
        tests.append(~F.coalesce(found, F.lit(False)) if negated else found)
    return reduce(Column.__and__, tests, F.lit(True))


def range_filter(df: DataFrame, ranges: dict) -> DataFrame:
    return df.where(range_predicate(df, ranges)) if ranges else df


def member_filter(df: DataFrame, members: dict) -> DataFrame:
    """Keep rows by membership in value lists; very long lists are joined instead of inlined."""
    _check_members(df, members)
    long_lists = {n: v for n, v in members.items() if len(v) > INLINE_VALUES}
    out = df.where(member_predicate(df, {n: v for n, v in members.items() if n not in long_lists}))
    for name, values in long_lists.items():
        column, negated = target_column(df, name)
        keys = df.sparkSession.createDataFrame([(v,) for v in set(values)], f"`{column}` string")
        out = lookup_join(out, keys, column, "left_anti" if negated else "left_semi")
    return out.select(*df.columns)


def split_spec(df: DataFrame, spec: dict, default: dict | None = None) -> tuple[dict, dict]:
    """Divide a specification by column type, after adding the defaults it does not name."""
    default = DEFAULT_FILTER if default is None else default
    members = {c: v for c, v in default.items() if c not in spec}
    ranges = {}
    for name, value in spec.items():
        column, _ = target_column(df, name)
        if column not in df.columns:
            raise ValueError(f"invalid filter '{name}': must be one of: {', '.join(df.columns)}")
        (members if is_text(df, column) else ranges)[name] = value
    return members, ranges


def apply_filter(df: DataFrame, spec: dict, default: dict | None = None) -> DataFrame:
    """The combined filter. Without a rule on Outcome only passing rows are kept."""
    members, ranges = split_spec(df, spec, default)
    return range_filter(member_filter(df, members), ranges)


def require_rows(df: DataFrame, least: int = 2) -> DataFrame:
    """Fail if fewer rows are left; it stops reading once it has seen enough."""
    if len(df.select(F.lit(1)).take(least)) < least:
        raise ValueError(f"fewer than {least} samples meet the specified criteria")
    return df


def absent_values(df: DataFrame, members: dict) -> DataFrame:
    """(column, value) of each listed value that no row has; negated rules are not examined."""
    _check_members(df, members)
    spark = df.sparkSession
    out = spark.createDataFrame([], "column string, value string")
    for name, values in members.items():
        column, negated = target_column(df, name)
        if negated or not values:
            continue
        wanted = spark.createDataFrame([(name, v) for v in dict.fromkeys(values)], out.schema)
        present = df.where(F.col(column).isin(values)).select(F.col(column).alias("value")).distinct()
        out = out.unionByName(wanted.join(present, "value", "left_anti"))
    return out


def warn_absent_values(df: DataFrame, spec: dict) -> None:
    members, _ = split_spec(df, spec)
    missing = {}
    for row in absent_values(df, members).collect():   # at most the values the caller listed
        missing.setdefault(row["column"], []).append(row["value"])
    for column, values in missing.items():
        warnings.warn(f"column '{column}' does not contain the values '{', '.join(sorted(values))}'")


def filter_with_count(df: DataFrame, spec: dict, allow_wipe_out: bool = False,
                      default: dict | None = None) -> tuple[DataFrame, Observation]:
    """The combined filter with its row count, observed by whichever job writes the result."""
    passed = apply_filter(df, spec, default)
    if not allow_wipe_out:
        require_rows(passed)
    seen = Observation()
    return passed.observe(seen, F.count(F.lit(1)).alias("number_of_passed_samples")), seen
