from cohortlens.functions.locations import (
    consensus_key, directory, key_in_bucket, last_token, result_location, uri_bucket, valid_uri,
)
from cohortlens.functions.names import matrix_label, submission_number
from cohortlens.functions.values import nan_to_null, null_tokens_to_null, number

__all__ = [
    "consensus_key", "directory", "key_in_bucket", "last_token", "matrix_label", "nan_to_null",
    "null_tokens_to_null", "number", "result_location", "submission_number", "uri_bucket",
    "valid_uri",
]
