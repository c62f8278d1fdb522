"""Object locations: buckets, keys and directories."""

from pyspark.sql import Column, functions as F

from cohortlens.model import BUCKET_PATTERN, DEFAULT_BUCKET


def valid_uri(uri: Column, bucket_pattern: str = BUCKET_PATTERN) -> Column:
    return F.coalesce(uri.rlike(f"^s3://{bucket_pattern}/+"), F.lit(False))


def _checked(uri: Column, value: Column, bucket_pattern: str) -> Column:
    message = F.concat(F.lit("Incorrectly formatted s3 uri: '"), F.coalesce(uri, F.lit("null")), F.lit("'"))
    return F.when(valid_uri(uri, bucket_pattern), value).otherwise(F.raise_error(message).cast("string"))


def uri_bucket(uri: Column, bucket_pattern: str = BUCKET_PATTERN) -> Column:
    """The bucket of a URI; a malformed URI fails the query and is named in the error."""
    return _checked(uri, F.regexp_extract(uri, f"^s3://({bucket_pattern})/+", 1), bucket_pattern)


def consensus_key(uri: Column, sample: Column, bucket_pattern: str = BUCKET_PATTERN) -> Column:
    """The object key of a sample's consensus sequence below its result directory."""
    rest = F.regexp_replace(uri, f"^s3://{bucket_pattern}/+", "")
    joined = F.when((rest == "") | rest.endswith("/"), rest).otherwise(F.concat(rest, F.lit("/")))
    key = F.concat(joined, F.lit("consensus/"), sample, F.lit("_consensus.fas"))
    return _checked(uri, key, bucket_pattern)


def directory(key: Column) -> Column:
    """Everything before the last slash."""
    return F.regexp_extract(key, "^(.*)/[^/]*$", 1)


def result_location(key: Column, bucket: str = DEFAULT_BUCKET) -> Column:
    """The directory of an object key as a result location."""
    return F.concat(F.lit(f"s3://{bucket}/"), directory(key), F.lit("/"))


def key_in_bucket(path: Column, bucket: str) -> Column:
    """The object key within a full path of any scheme."""
    return F.regexp_replace(path, f"^.*?/{bucket}/+", "")


def last_token(line: Column) -> Column:
    """What follows the last blank of a listing line."""
    return F.substring_index(line, " ", -1)
