"""Session set-up shared by tests, the bench and the command line.

On a cluster the caller usually owns the session; ``get_session`` only adds
settings this library relies on where the cluster has not set them.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the operators are designed around: adaptive execution re-plans
# joins and partition counts from real shuffle sizes and splits skewed join
# partitions; the time zone is fixed so timestamp texts do not depend on the
# machine. Applied only where neither the cluster (spark-defaults, submit
# options, the builder) nor the caller's session has set them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Local runs (tests, bench) open no web UI and print no progress bars.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "tracelake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for k, v in LOCAL_DEFAULTS.items():
                builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    given = spark.conf.getAll
    for k, v in DEFAULTS.items():
        if k not in given:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  min_partition_bytes: str = "64k") -> SparkSession:
    """Session for tests and the bench.

    Test inputs are small, so adaptive coalescing would merge most shuffles
    into a single partition (its default floor is 1 MB) and leave the other
    cores idle; a lower floor keeps them busy. Cluster sessions keep Spark's
    defaults.
    """
    driver_mem = os.environ.get("TRACELAKE_DRIVER_MEMORY", "8g")
    return get_session(master=f"local[{cores}]", shuffle_partitions=shuffle_partitions,
                       extra={"spark.driver.memory": driver_mem,
                              "spark.sql.adaptive.coalescePartitions.minPartitionSize":
                                  min_partition_bytes})
