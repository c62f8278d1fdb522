"""Connected components of a link table: forests of each task's links, pointers that jump, forests by node."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.plans.staging import stage

MOST_ROUNDS = 60
CHUNK_LINKS = 1 << 20     # links that a task joins into one forest at once
TASK_LINKS = 1 << 18      # links of a task where there are more than the cores take


def smallest_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest one that links a[i] - b[i] lead to; every pass at least halves what is open."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]


def _forest(links: pa.Table) -> pa.RecordBatch:
    """Links (u, v) as (node, smallest node); ``moved`` says that they came in another form or with a jump."""
    u, v, moved = (links.column(c).to_numpy() for c in ("u", "v", "moved"))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = smallest_reachable(a, b, len(nodes))
    below = np.flatnonzero(label != np.arange(len(nodes)))
    changed = bool(moved.any() or (label[a] != b).any())
    return pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[label[below]]), pa.array(np.full(len(below), changed))],
                                      ["u", "v", "moved"])


def _forests(batches, chunk: int, together: bool):
    """Forests of a task's links, some ``chunk`` links at a time; ``together``: neighbouring links of one u share a forest."""
    held, size, most = [], 0, chunk
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= most:
            links = pa.Table.from_batches(held)
            cut = size
            if together:
                u = links.column("u").to_numpy()
                cut = int(np.max(np.flatnonzero(u != u[-1]), initial=-1)) + 1
            if cut:
                yield _forest(links.slice(0, cut))
            held, size = links.slice(cut).to_batches(), size - cut
            most = size + chunk
    if size:
        yield _forest(pa.Table.from_batches(held))


def forest(edges: DataFrame, chunk: int = CHUNK_LINKS) -> DataFrame:
    """(u, v) for every node u of ``edges`` (columns u, v) but the smallest of its component, which is v.

    Each task first replaces its links by a forest of them, so a node has at most one link to a smaller one for each task.
    A round moves every link from its smaller end to that end's smallest neighbour below, deals links by their larger end
    and makes forests again, until nothing moves. Only smaller ends can be hot; they are looked up by a join of two
    staged tables, which adaptive execution can split. Rounds use as many tasks as there are cores, or as many as the
    links fill. Links of a node to itself, repeated links and either direction are fine; no links give no rows.
    """
    def forests(links, together):
        return stage(links.mapInArrow(lambda b: _forests(b, chunk, together), "u long, v long, moved boolean"), "links")

    downwards = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.lit(False).alias("moved"))
    edges = forests(downwards, together=False).select("u", "v")
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-edges.count() // TASK_LINKS))
    for _ in range(MOST_ROUNDS):
        below = stage(edges.groupBy("u").agg(F.min("v").alias("to")).coalesce(tasks), "below").withColumnRenamed("u", "v")
        jumped = edges.join(below, "v", "left").select("u", F.coalesce("to", "v").alias("v"), F.col("to").isNotNull().alias("moved"))
        found = forests(jumped.repartition("u").coalesce(tasks).sortWithinPartitions("u"), together=True)
        edges = found.select("u", "v")
        if found.where("moved").isEmpty():      # every node had one smaller neighbour, which had none
            return edges
    raise RuntimeError("the components did not settle")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v): the smallest node reachable from it."""
    found = forest(edges)
    return (found.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(found.select("v", "v").distinct()))
