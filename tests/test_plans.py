import pytest
from pyspark.sql import functions as F

from cohortlens.plans import sizing, staging
from cohortlens.plans.numbering import number_rows
from cohortlens.plans.spread import spread_join


@pytest.fixture
def sides(spark):
    left = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("2", 2), ("5", 3), ("none", 4)], "k string, v int")
    return left, right


@pytest.mark.parametrize("how, rows", [("inner", 3002), ("left", 9000)])
@pytest.mark.parametrize("hot_rows", [100, 1_000_000])
def test_spread_join_loses_and_adds_nothing(sides, how, rows, hot_rows):
    left, right = sides
    weighted = right.join(left.groupBy("k").agg(F.count("id").alias("w")), "k")
    out = spread_join(left, weighted, "k", "w", how, hot_rows)
    assert out.count() == rows == out.select("id").distinct().count()
    expected = {(r.k, r.id, r.v) for r in left.join(right, "k", how).collect()}
    assert {(r.k, r.id, r.v) for r in out.collect()} == expected


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_with_and_without_broadcast(sides, how):
    left, right = sides
    results = [{tuple(r) for r in sizing.lookup_join(left, right, "k", how, limit).collect()} for limit in (None, 0)]
    assert results[0] == results[1] == {tuple(r) for r in left.join(right, "k", how).collect()}


def test_hot_and_keyless_rows_spread_over_tasks(spark, sides):
    left, right = sides
    weighted = right.join(left.groupBy("k").agg(F.count("id").alias("w")), "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        out = spread_join(left, weighted, "k", "w", "left", 100).withColumn("p", F.spark_partition_id())
        sizes = {(r.k, r.p): r["count"] for r in out.where("k = 'hot' OR k IS NULL").groupBy("k", "p").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(sizes.values()) < 1800


def test_measured_size_counts_text_inside_structs(spark):
    df = spark.createDataFrame([("x" * 1000, ("y" * 1000, 1), ["z" * 1000])], "a string, b struct<c: string, d: int>, e array<string>")
    assert 3000 < sizing.measured_bytes(df) < 3200
    assert sizing.measured_bytes(df.limit(0)) == 0
    assert sizing.fits_broadcast(df) and not sizing.fits_broadcast(df, 100)


def test_dense_numbers(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    numbered = number_rows(df, ["x"])
    assert numbered.where("n <> x").count() == 0 and numbered.count() == 1000


def test_staged_tables_keep_their_schema(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    staged = staging.stage(df, "t")
    assert staged.schema == df.schema and sorted(map(tuple, staged.collect()))[0] == (1, "a")
    assert staging.fresh_path(spark, "t") != staging.fresh_path(spark, "t")


def jobs_of(spark, build):
    """How many jobs run while a query is built."""
    group = f"build-{build.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build(spark, "/root/testdata/sf0.001")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_operators_are_lazy(spark):
    from cohortlens import catalog
    for build, most in ((catalog.d1_best_per_key, 0), (catalog.c3_drop_excluded, 1), (catalog.c2_thresholds, 6), (catalog.c1_class_bounded, 2)):
        reads = 3        # schemas of the files that a query reads, one job each, at most
        assert jobs_of(spark, build) <= most + reads, build.__name__
