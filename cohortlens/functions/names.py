"""Sample names to submission keys."""

from pyspark.sql import Column, functions as F

from cohortlens.model import LABEL_SUFFIX, SUBMISSION_PATTERN, SUBMISSION_PREFIX


def submission_number(name: Column) -> Column:
    """The submission number inside a sample name, prefixed; other names pass through upper-cased."""
    found = F.regexp_extract(name, SUBMISSION_PATTERN, 0)
    return F.upper(F.when(found != "", F.concat(F.lit(SUBMISSION_PREFIX), found)).otherwise(name))


def matrix_label(label: Column) -> Column:
    """A matrix label as a submission key: one trailing suffix goes, then the number is taken."""
    return submission_number(F.regexp_replace(label, f"{LABEL_SUFFIX}$", ""))
