"""The data model: schemas, fixed values and the row ordinal.

Row order decides ties (the first row in file order wins), and Spark keeps no implicit order,
so every source adds an ``_ord`` struct that sorts in file order.
"""

from pyspark.sql import types as T

# Columns of the samples table, in order.
TEXT_COLUMNS = ["Sample", "Outcome", "flag", "group", "ResultLoc", "ID", "Submission"]
SAMPLE_COLUMNS = [
    "Sample", "GenomeCov", "MeanDepth", "NumRawReads", "pcMapped", "Outcome", "flag", "group",
    "CSSTested", "matches", "mismatches", "noCoverage", "anomalous", "Ncount", "ResultLoc", "ID",
    "TotalReads", "Abundance", "Submission",
]

# Strings that mean "missing" in a CSV field.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Formats of keys and locations.
SUBMISSION_PATTERN = r"\d{2}-\d{4,5}-\d{2}"
SUBMISSION_PREFIX = "AF-"
BUCKET_PATTERN = r"s3-csu-\d{3}"
DEFAULT_BUCKET = "s3-csu-003"
DEFAULT_PREFIX = "v3-2"
BATCH_FILE_MARK = "FinalOut"
LABEL_SUFFIX = "_consensus"

# Default rules of the pipelines.
DEFAULT_FILTER = {"Outcome": ["Pass"]}
DEFAULT_CRITERIA = [
    ("Outcome", "Pass"), ("flag", "BritishbTB"), ("pcMapped", "max"), ("Ncount", "min"),
]
DEFAULT_QUANTILE = 0.85
UNBOUNDED_CLASSES = ["MicPin", "Microti", "Pinnipedii", "bTB", "nonbTB"]

KEY = "Submission"
ORDER = "_ord"
EXTRA = "_extra"     # columns beyond the known ones, by name

ORDER_TYPE = T.StructType([
    T.StructField("run", T.LongType()),      # which ingest wrote the row
    T.StructField("path", T.StringType()),   # the file it came from
    T.StructField("block", T.LongType()),    # the split within the file
    T.StructField("row", T.LongType()),      # the row within the split
])


def column_type(name: str) -> T.DataType:
    return T.StringType() if name in TEXT_COLUMNS else T.DoubleType()


SAMPLES = T.StructType([T.StructField(c, column_type(c)) for c in SAMPLE_COLUMNS])
STORED_SAMPLES = T.StructType([*SAMPLES.fields, T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType())), T.StructField(ORDER, ORDER_TYPE)])


class ColumnTypeError(TypeError):
    """A rule was given for a column of the wrong type."""

    def __init__(self, column: str, expected: str):
        super().__init__(f"column '{column}' must be of type {expected}")
