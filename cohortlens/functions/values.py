"""Missing values: NaN and the null tokens of CSV files both become NULL."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortlens.model import NULL_TOKENS


def nan_to_null(df: DataFrame, column: str) -> Column:
    """A numeric column with NaN as NULL, because Spark sorts NaN above every number."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(column), F.lit(None).cast(kind))
    return F.col(column)


def null_tokens_to_null(text: Column) -> Column:
    return F.when(~text.isin(NULL_TOKENS), text)


def number(text: Column, permissive: bool = False) -> Column:
    """Text to double: null tokens are NULL and any other non-number fails, unless permissive."""
    clean = F.trim(null_tokens_to_null(text))
    value = clean.try_cast("double") if permissive else clean.cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))
