"""Fresh folders that the driver and all executors see."""

from __future__ import annotations

import os
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A local session that names none gets a scratch folder; a cluster session
    must name one, because executors do not see each other's local folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tracelake-", dir=os.environ.get("TMPDIR"))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"
