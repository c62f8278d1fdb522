"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Every document of a source has the same expected number of copies, the source's target by its size. Documents of a
source are put in order of size and id, the expected copies are summed up in that order from one random
offset on, and a document is emitted once for each whole number that its sum crosses. Going up by size
spreads the sample over all sizes, so the words taken stay within a few documents of the target.
"""

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.plans.numbering import number_rows
from cohortlens.plans.sizing import lookup_join
from cohortlens.plans.staging import stage

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL = 1.5         # share of all sizes that the sources are given
MOST = 2.0          # no source gets more than so many times its size


def word_count(text: Column | str) -> Column:
    """The number of runs of characters other than the six ASCII white-space characters; 0 for a missing text."""
    column = F.col(text) if isinstance(text, str) else text
    body = F.btrim(column.cast("string"), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(body) > 0, F.size(F.split(body, r"[\x20\x09-\x0D]+"))).otherwise(0).cast("bigint")


def offset(source: Column, seed: str) -> Column:
    """A fixed number in [0, 1) for each source."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("s"), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in order of code points, the missing one last, weigh as in ``weights``, repeated. They share ``total`` times
    all sizes; a target stops at ``most`` times its source's size and the excess is shared again by weight. A round looks at
    the whole table, but only three sums reach the driver; rounds end when no further source is full.
    """
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = stage(number_rows(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], "place")
                   .select("source", "source_size", share.alias("weight"), (most * F.col("source_size")).alias("room")), "sources")
    level, full = 0.0, F.col("weight") * F.lit(0.0) > F.col("room")
    everything = total * float(placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    before = -1
    while True:
        n, room, weight = placed.agg(F.count_if(full), F.sum(F.when(full, F.col("room")).otherwise(0.0)),
                                     F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == before or not weight:
            break
        before, level = n, (everything - room) / weight
        full = F.col("weight") * F.lit(level) > F.col("room")
    return placed.select("source", "source_size",
                         F.least(F.col("weight") * F.lit(level) if weight else F.col("room"), "room").alias("target"))


def mixed(docs: DataFrame, id_column: str = "doc_id", source: str = "source", size: str = "size", seed: str = "mix",
          weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """``docs`` (which has ``size``, whole numbers of 0 or more) with source_size, target and copies of each row.

    Rows without a source form a source of their own. A missing size counts as 0; such rows get copies but take nothing.
    A source of size 0 has target 0 and no copies. Rows that repeat an id are rows of their own. Reruns agree, except
    which of several rows with the same source, size and id gets a copy. Columns of ``docs`` by the names of the result are
    replaced. One sort by range spreads a source of any size over tasks; the order's running sums come from its partitions.
    """
    docs = docs.drop("source_size", "target", "copies")
    sized = docs.withColumn(size, F.coalesce(F.col(size), F.lit(0)).cast("bigint"))
    ordered = number_rows(sized, [F.col(source).asc_nulls_last(), F.col(size), F.col(id_column)], "_n")
    sums = stage(ordered.groupBy(F.col(source).alias("source"))
                 .agg(F.sum(size).alias("source_size"), F.min("_n").alias("_first")), "source-sizes")
    targets = source_targets(sums, weights, total, most)
    rates = stage(
        targets.join(sums.select("source", "_first"), targets["source"].eqNullSafe(sums["source"]))
        .select(key(targets["source"]), "source_size", "target", "_first",
                F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"),
                offset(targets["source"], seed).alias("_offset")), "rates")
    rank = F.col("_n") - F.col("_first")
    copies = F.floor(F.col("_rate") * (rank + 1) + F.col("_offset")) - F.floor(F.col("_rate") * rank + F.col("_offset"))
    return (lookup_join(ordered.withColumn("_key", key(F.col(source))), rates, "_key")
            .select(*[F.col(f"`{c}`") for c in sized.columns], "source_size", "target", copies.cast("int").alias("copies")))


def key(source: Column) -> Column:
    """A key that a missing source has as well."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("_key")
