"""A corpus pipeline: each stage reads what the one before it kept and returns a DataFrame."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.llm import decontaminate, mixing, near_dedup, quality, token_output
from cohortlens.llm.queries import tokenizer
from cohortlens.plans.staging import fresh_path, stage

ORACLE_SQL = None    # hashed searches and a trained model have no SQL form; tests compare with brute force


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores at 0.7 or more; it never sees the held-out fold of the labels."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), usable=~quality.held_out())
    return quality.score(docs, model).where("predicted = 1").select(docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: sets of 5-word shingles of a similarity of 0.8 or more.

    Rows are told apart by numbers of their own, since ids may be missing or repeated. Of a group the row of the smallest
    id stays, one without an id only if no other has one.
    """
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = stage(near_dedup.near_duplicates(rows, "_row", width=5, percent=80)
                  .select(F.col("doc_id").alias("_row"), "component_id"), "found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "_row")).alias("first")
    stays = found.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id").agg(first).select("first._row")
    dropped = found.select("_row").join(stays, "_row", "left_anti")
    return rows.join(dropped, "_row", "left_anti").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark item, exact or with few edits; each row is decided by its own text."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by their weights: each document as often as it is taken."""
    sized = docs.withColumn("_size", mixing.word_count("text"))
    return (mixing.mixed(sized, size="_size").withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
            .select(docs.columns))


def token_id_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of what is left, read back: place, length and checksum of every document."""
    folder = fresh_path(spark, "tokens")
    return token_output.read_back(spark, folder, token_output.write(docs, folder, tokenizer()))


STAGES = [
    ("quality classifier", quality_classifier),
    ("minhash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-id / binary output", token_id_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
