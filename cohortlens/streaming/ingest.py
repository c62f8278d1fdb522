"""Incremental ingest as a stream: each run appends the batch files that earlier runs have not seen."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlens.functions import key_in_bucket, result_location
from cohortlens.model import BATCH_FILE_MARK, DEFAULT_BUCKET
from cohortlens.sources.batches import load_batches, new_batches
from cohortlens.sources.store import (
    append_ingest, before_run, known_locations, mark_run, next_run, read_log, repair_log, unfinished_run,
)

# Files per micro-batch, which bounds the list of paths that the driver holds.
FILES_PER_BATCH = 10_000
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def batch_files(spark: SparkSession, root: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(path) of arriving batch result files; their contents are not read here."""
    return (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
        .load(root).select("path").where(F.col("path").contains(BATCH_FILE_MARK)))


def ingest_stream(spark: SparkSession, root: str, store: str, checkpoint: str, identity: str = "directory",
                  bucket: str = DEFAULT_BUCKET, permissive: bool = False,
                  files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Append all files that are new since the last run, wait until that is done, and return the stopped stream.

    ``identity="directory"`` skips files whose directory was a result location in the store before the run began;
    ``"file"`` trusts the stream's checkpoint alone. Each micro-batch replaces its own partition of the store, so a repeated
    one after a failure adds nothing twice. All micro-batches of a run carry one run number, kept beside
    the checkpoint until the run is complete: a run that failed is taken up under its number, so files of one directory
    load together however they fall into micro-batches and attempts. What is known comes from the store's log; no micro-batch
    reads stored samples.
    """
    if identity not in ("file", "directory"):
        raise ValueError("identity must be 'file' or 'directory'")

    repair_log(spark, store)
    marker = f"{checkpoint}-run"
    run = unfinished_run(spark, marker)
    if run is None:
        run = next_run(read_log(spark, store))
        mark_run(spark, marker, str(run))

    def append(files: DataFrame, batch_id: int) -> None:
        if identity == "directory":
            key = key_in_bucket(F.col("path"), bucket)
            listing = files.withColumn("location", result_location(key, bucket))
            files = new_batches(listing, known_locations(before_run(read_log(spark, store), run)))
        paths = [row.path for row in files.select("path").distinct().collect()]   # one micro-batch bounds them
        if paths:
            append_ingest(load_batches(spark, paths, run, permissive), store, f"stream-{batch_id}")

    query = (batch_files(spark, root, files_per_batch).writeStream.foreachBatch(append)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    mark_run(spark, marker, "")
    return query
