"""Results that follow the store ingest by ingest, without reading what was stored before.

*Best rows*: the survivor of a key among old and new rows is the survivor among its old survivor and the new rows, so a table of
survivors is enough. It is cut into buckets by key hash; an update rewrites the buckets of the keys it touches as a new version and then logs
it. A bucket's current rows are those of its last logged version, so a lost update leaves the former table as it was.

*Base masks*: the bases seen at each position combine by bitwise or. Each batch of sequences keeps its own masks and its sequences
reduced to the sites within the batch; a position that does not vary within a batch has the batch's only base there. So sites and the
reduced alignment of all batches follow from what the batches keep, and a sequence is read once.
"""

import json

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.model import DEFAULT_CRITERIA, KEY, ORDER
from cohortlens.operators.dedup import best_per_key
from cohortlens.operators.sites import (
    BASE_BITS, OTHER_BIT, combined_masks, masks_by_position, snp_alignment, tile_masks, variable_sites,
)
from cohortlens.sources.store import ingests_of, read_log, read_stored, stored_rows, with_extras

BUCKETS = 256
PIECE_ROWS = 1_000_000   # stored rows for each file of a bucket, so that no task holds more than a piece
VERSIONS = "version bigint, bucket int, rows bigint, ingest string, criteria string"


# --- Best rows -------------------------------------------------------------------------------

def read_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a table of survivors: the buckets that each version wrote, and the ingests it took in."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{folder.rstrip('/')}-log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def _current(versions: DataFrame) -> dict[int, tuple[int, int]]:
    """The last version of each bucket and its rows; there are as many as buckets."""
    last = F.max(F.struct("version", "rows")).alias("last")
    return {r.bucket: (r.last.version, r.last.rows) for r in versions.where("bucket IS NOT NULL").groupBy("bucket").agg(last).collect()}


def update_best(spark: SparkSession, store: str, folder: str, criteria: list[tuple[str, str]] | None = None, key: str = KEY,
                buckets: int = BUCKETS) -> dict:
    """Take the store's ingests that the table of survivors lacks into it; returns the step's metrics.

    Only the new ingests and the buckets of their keys are read. The criteria and the number of buckets are those of the first update;
    others fail.
    """
    criteria = DEFAULT_CRITERIA if criteria is None else criteria
    rules = json.dumps([criteria, key, buckets])
    versions = read_versions(spark, folder)
    taken = {r.ingest for r in versions.where("ingest IS NOT NULL").select("ingest").distinct().collect()}
    given = versions.where(F.col("criteria") != rules).select("criteria").first()
    if given:
        raise ValueError(f"{folder} was built by other rules: {given.criteria}")
    log = read_log(spark, store)
    fresh = [name for name in ingests_of(log) if name not in taken]
    current = _current(versions)
    rewritten = 0
    if fresh:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows = read_stored(spark, store, fresh)
        touched = sorted(r.bucket for r in rows.select(bucket.alias("bucket")).distinct().collect())
        paths = [f"{folder}/version={current[b][0]}/bucket={b}" for b in touched if b in current]
        if paths:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(*paths))
        version = max((v for v, _ in current.values()), default=-1) + 1
        best = best_per_key(rows, criteria, key, check_values=False).withColumn("bucket", bucket)
        pieces = -(-stored_rows(log) // (buckets * PIECE_ROWS))
        if pieces > 1:
            best = best.repartition(buckets * pieces, "bucket", F.pmod(F.hash(key), F.lit(pieces)))
        else:
            best = best.repartition("bucket")
        best.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/version={version}")
        written = (spark.read.parquet(f"{folder}/version={version}").groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(version).cast("bigint").alias("version"), F.col("bucket").cast("int"), "rows"))
        names = spark.createDataFrame([(version, name, rules) for name in fresh], "version bigint, ingest string, criteria string")
        entry = written.unionByName(names, allowMissingColumns=True).select(*[c.split()[0] for c in VERSIONS.split(", ")])
        entry.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}-log/entry={version}")
        rewritten = len(touched)
        current = _current(read_versions(spark, folder))
    kept = sum(n for _, n in current.values())
    return {"number_of_duplicate_WGS_submissions": stored_rows(log) - kept, "rewritten_buckets": rewritten}


def read_best(spark: SparkSession, store: str, folder: str) -> DataFrame:
    """The survivors, with the added columns typed as the store's log says."""
    paths = [f"{folder}/version={v}/bucket={b}" for b, (v, _) in sorted(_current(read_versions(spark, folder)).items())]
    rows = read_stored(spark, store, [])
    return with_extras(spark.read.schema(rows.schema).parquet(*paths) if paths else rows, read_log(spark, store))


# --- Sequences -------------------------------------------------------------------------------

def add_sequences(seqs: DataFrame, folder: str, batch: str) -> None:
    """Keep the masks and the reduced sequences of one batch (id, seq, order); repeating a batch replaces it."""
    spark = seqs.sparkSession
    tile_masks(seqs).write.mode("overwrite").parquet(f"{folder}/masks/batch={batch}")
    masks = spark.read.parquet(f"{folder}/masks/batch={batch}")
    sites = variable_sites(masks_by_position(masks))
    snp_alignment(seqs, sites).write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")


def stored_sites(spark: SparkSession, folder: str) -> DataFrame:
    """(pos, alleles): the sites of all batches, from their masks alone; batches of different lengths fail."""
    return variable_sites(masks_by_position(combined_masks(spark.read.parquet(f"{folder}/masks"))))


def _letters(sites: np.ndarray, own: np.ndarray, constant: np.ndarray):
    """Reduced sequences of a batch brought to all sites: own sites by place, the others by the batch's only base."""
    place = np.minimum(np.searchsorted(own, sites), max(len(own) - 1, 0))
    varies = own[place] == sites if len(own) else np.zeros(len(sites), bool)

    def widen(batches):
        for batch in batches:
            out = []
            for text in batch.column("snp_seq").to_pylist():
                letters = constant.copy()
                if varies.any():
                    letters[varies] = np.frombuffer(text.encode(), np.uint8)[place[varies]]
                out.append(letters.tobytes().decode())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "snp_seq"])
    return widen


def stored_alignment(spark: SparkSession, folder: str, order: str = ORDER) -> DataFrame:
    """(id, order, snp_seq): the sequences of all batches reduced to the sites of all, from what the batches keep.

    The positions of the sites come to the driver, at most as many as the genome has; the batches are one scan each.
    """
    sites = np.sort(stored_sites(spark, folder).select("pos").toArrow().column("pos").to_numpy())
    base = np.zeros(OTHER_BIT + 1, np.uint8)
    for letter, bit in BASE_BITS.items():
        base[bit] = ord(letter)
    names = sorted(r.batch for r in spark.read.parquet(f"{folder}/masks").select(F.col("batch").cast("string").alias("batch")).distinct().collect())
    out = None
    for name in names:
        masks = masks_by_position(spark.read.parquet(f"{folder}/masks/batch={name}")).toArrow().sort_by("pos")
        pos, alleles = masks.column("pos").to_numpy(), masks.column("alleles").to_numpy()
        own = pos[(alleles & OTHER_BIT == 0) & (np.bitwise_count(alleles) > 1)]
        at = alleles[np.searchsorted(pos, sites)] if len(sites) else alleles[:0]
        constant = np.where(np.bitwise_count(at) == 1, base[np.minimum(at, OTHER_BIT)], 0).astype(np.uint8)
        rows = spark.read.parquet(f"{folder}/rows/batch={name}").select(F.struct("id", order).alias("row"), "snp_seq")
        part = rows.mapInArrow(_letters(sites, own, constant), rows.schema).select("row.*", "snp_seq")
        out = part if out is None else out.unionByName(part)
    return out
