import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows with an ordinal in the order given."""
    def make(columns: str, rows: list[tuple]):
        data = [(*row, (i,)) for i, row in enumerate(rows)]
        return spark.createDataFrame(data, f"{columns}, _ord struct<n: int>")
    return make


@pytest.fixture
def rows():
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or [c for c in df.columns if c != "_ord"])).collect()),
                      key=repr)
    return collect


@pytest.fixture
def tasks(spark):
    """The number of tasks of each stage that some work runs, and what it returns."""
    def of(name, work):
        context = spark.sparkContext
        context.setJobGroup(name, name)
        try:
            out = work()
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        tracker = context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(name)]
        stages = [tracker.getStageInfo(s) for j in jobs for s in j.stageIds]
        return [s.numTasks for s in stages if s], out
    return of
