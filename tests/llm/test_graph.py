"""Connected components against union-find, and how many tasks they take."""

import random

import pyarrow as pa
import pytest

from cohortlens.llm import graph

NODES = 120


def smallest(pairs):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x
    for a, b in pairs:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    return {x: find(x) for x in top}


def shapes():
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(NODES)]
    return {"path": rng.sample(path, NODES), "down": [(NODES, i) for i in range(NODES)], "up": [(0, i) for i in range(1, NODES)],
            "sparse": [(rng.randrange(-NODES, NODES), rng.randrange(-NODES, NODES)) for _ in range(NODES)],
            "odd": [(3, 3), (5, 4), (4, 5), (4, 5), (None, 4), (7, None), (-1, 9)], "none": []}


@pytest.mark.parametrize("shape", shapes())
def test_components_equal_union_find(spark, shape):
    rows = shapes()[shape]
    edges = spark.createDataFrame(rows, "u long, v long").repartition(6)
    want = smallest([(a, b) for a, b in rows if None not in (a, b) and a != b])
    assert sorted(map(tuple, graph.components(edges).collect())) == sorted(want.items())


def test_forests_of_small_chunks(spark):
    rows = shapes()["sparse"]
    got = graph.forest(spark.createDataFrame(rows, "u long, v long").repartition(6), chunk=3).collect()
    assert sorted(map(tuple, got)) == sorted((x, y) for x, y in smallest(rows).items() if x != y)


def test_large_tables_of_pointers_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = shapes()["sparse"]
        got = graph.components(spark.createDataFrame(rows, "u long, v long").repartition(5)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert dict(map(tuple, got)) == smallest([r for r in rows if r[0] != r[1]])


def test_few_links_take_few_tasks_however_many_partitions(spark):
    """Rounds once ran every step in all shuffle partitions, so small graphs cost thousands of empty tasks."""
    context, tracker, held = spark.sparkContext, spark.sparkContext.statusTracker(), {}
    for key, value in {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}.items():
        held[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    context.setJobGroup("components", "components")
    try:
        edges = spark.createDataFrame([(i, i - i % 8) for i in range(NODES)], "u long, v long").repartition(6)
        assert graph.components(edges).where("component % 8 = 0").count() == NODES
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in held.items():
            spark.conf.set(key, value)
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    assert 0 < sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s))) < 200


def test_links_of_a_node_stay_in_one_forest():
    """A chunk that ended between two links of a node would hide that its neighbours belong together."""
    links = [(5, 1), (6, 2), (6, 3), (6, 4), (7, 1)]
    batches = [pa.RecordBatch.from_pydict({"u": [u], "v": [v], "moved": [False]}) for u, v in links]
    found = pa.Table.from_batches(graph._forests(batches, 2, together=True)).to_pylist()
    assert sorted((r["u"], r["v"]) for r in found) == [(3, 2), (4, 2), (5, 1), (6, 2), (7, 1)]
    assert all(r["moved"] for r in found if r["v"] == 2)
