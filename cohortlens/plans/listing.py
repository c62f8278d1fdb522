"""Have many named files listed by as many tasks as the cluster has use for.

A scan that names more than a few files asks for them in a job of its own, by default with a task for each file. What such a task sends to the
driver beside its answer is many times the answer, and starting it takes longer than asking.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

TASKS_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
TASKS_PER_CORE = 2


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Scans that are made inside list their files by ``TASKS_PER_CORE`` tasks a core at most; a lower setting stays."""
    before = spark.conf.get(TASKS_SETTING, None)
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(TASKS_SETTING, str(min(tasks, int(spark.conf.get(TASKS_SETTING)))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(TASKS_SETTING)
        else:
            spark.conf.set(TASKS_SETTING, before)
